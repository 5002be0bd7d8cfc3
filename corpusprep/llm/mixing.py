"""Mixing sources to target weights by a min-cost flow.

A document may belong to several sources. Documents are added up by their membership pattern;
patterns, not documents, are the nodes of a flow network. A pattern can give its words once,
twice or up to ``MOST`` times, each further time at a higher cost, to the quotas of the sources
it belongs to. The cheapest flow that fills the quotas says how many words each pattern gives.
Whole documents are then chosen in a seeded order: every document of a pattern is taken as
often as the flow fills the pattern in full, and those up to a cut in the order once more.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.operators.rows import column, cut_lineage

# What counts as a word, and the weights of the sources in order.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
#: Most times a document is taken; cost per word of the first, second, ... time.
MOST = 3
COSTS = (1, 3, 9)
#: Steps in which the place of the cut is narrowed down: bits of the seeded order at a time.
BITS = 12


def capped_shares(total: float, capacity: list[float], weights: list[float]) -> list[float]:
    """Shares of a total by weight; what is above a capacity is shared again among the others."""
    target, open_ = [0.0] * len(capacity), set(range(len(capacity)))
    rest = total
    while open_:
        whole = sum(weights[k] for k in sorted(open_))
        over = [k for k in sorted(open_) if rest * weights[k] / whole > capacity[k]]
        if not over:
            for k in open_:
                target[k] = rest * weights[k] / whole
            break
        for k in over:
            target[k] = float(capacity[k])
            open_.discard(k)
        # Exact for integers of any size; shares themselves are rounded once.
        rest = total - sum(capacity[k] for k in range(len(capacity)) if k not in open_)
    return target


def cheapest_flow(patterns: dict[tuple, int], quotas: dict, costs: tuple[int, ...] = COSTS) -> dict[tuple, int]:
    """Words each pattern gives, by successive shortest paths.

    ``patterns``: size of each tuple of sources; ``quotas``: words wanted by each source. Paths
    are searched in the parts of the network that share no source one after the other, so that
    the work follows the size of a part.
    """
    given: dict[tuple, int] = {}
    for part in _parts(patterns):
        given |= _flow({p: patterns[p] for p in part}, quotas, costs)
    return given


def _parts(patterns: dict[tuple, int]) -> list[list[tuple]]:
    """Patterns that hang together by their sources; a pattern without a source by itself."""
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for pattern in patterns:
        for source in pattern:
            root[find(("s", source))] = find(("p", pattern))
    groups = defaultdict(list)
    for pattern in patterns:
        groups[find(("p", pattern))].append(pattern)
    return list(groups.values())


def _flow(patterns: dict[tuple, int], quotas: dict, costs: tuple[int, ...]) -> dict[tuple, int]:
    """The flow of one part of the network."""
    start, end = ("start",), ("end",)
    edges: list[list] = []  # to, capacity left, cost; the reverse edge follows each edge
    out = defaultdict(list)

    def edge(a, b, capacity: int, cost: int) -> None:
        for x, y, c, w in ((a, b, capacity, cost), (b, a, 0, -cost)):
            out[x].append(len(edges))
            edges.append([y, c, w])

    for pattern, size in patterns.items():
        for cost in costs:
            edge(start, ("p", pattern), size, cost)
        for source in pattern:
            edge(("p", pattern), ("s", source), len(costs) * size, 0)
    for source in dict.fromkeys(s for p in patterns for s in p):
        edge(("s", source), end, quotas.get(source, 0), 0)
    potential = defaultdict(int)
    while True:
        distance, via = {start: 0}, {}
        queue, order = [(0, 0, start)], 0
        while queue:
            d, _, node = heapq.heappop(queue)
            if d > distance[node]:
                continue
            for k in out[node]:
                to, capacity, cost = edges[k]
                reach = d + cost + potential[node] - potential[to]
                if capacity > 0 and reach < distance.get(to, float("inf")):
                    distance[to], via[to], order = reach, k, order + 1
                    heapq.heappush(queue, (reach, order, to))
        if end not in distance:
            break
        for node, d in distance.items():
            potential[node] += d
        path, node = [], end
        while node != start:
            path.append(via[node])
            node = edges[via[node] ^ 1][0]
        amount = min(edges[k][1] for k in path)
        for k in path:
            edges[k][1] -= amount
            edges[k ^ 1][1] += amount
    given = dict.fromkeys(patterns, 0)
    for k in out[start]:
        given[edges[k][0][1]] += edges[k ^ 1][1]
    return given


def place_of(seed: int, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Where a row stands in the seeded order: 60 bits."""
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), column(id_col).cast("bigint"), F.xxhash64(text)), 4)


def sized(docs: DataFrame, sources: Column, seed: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, members, size, place``: sources, words and place in the seeded order.

    ``sources`` is an array; a null in it is a source of its own. Rows that are equal in id and
    text have equal places and are taken equally often.
    """
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    return docs.select(
        column(id_col).cast("bigint").alias("doc_id"),
        members_of(sources),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        place_of(seed, id_col, text_col).alias("place"),
    )


def members_of(sources: Column) -> Column:
    return F.array_sort(F.array_distinct(sources.cast("array<string>"))).alias("members")


def mix(docs: DataFrame, sources: Column, seed: int = 5, id_col: str = "doc_id", text_col: str = "text",
        weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``doc_id, members, place, size, source_sizes, targets, times, taken`` of every row.

    Sources in the order of their code points, null last, have the weights in turn and share
    all words of the input; no target is above ``most`` times its source's size. ``members``
    is the sorted array of a row's sources, ``source_sizes`` and ``targets`` stand in the same
    order. A row is taken ``times`` times, which makes ``taken`` words. Null texts have size 0;
    rows equal in id, text and sources are taken equally often; an empty table gives an empty
    one. The driver holds one row per membership pattern and per source, none per document.
    """
    spark = docs.sparkSession
    rows = cut_lineage(sized(docs, sources, seed, id_col, text_col), "sized")
    totals = [(tuple(r["members"]), int(r["words"])) for r in rows.groupBy("members").agg(F.sum("size").alias("words")).collect()]
    names = sorted({s for members, _ in totals for s in members}, key=lambda s: (s is None, s or ""))
    held = {s: sum(words for members, words in totals if s in members) for s in names}
    whole = sum(words for _, words in totals)
    target = dict(zip(names, capped_shares(whole, [most * held[s] for s in names], [weights[k % len(weights)] for k in range(len(names))])))
    costs = tuple(3**k for k in range(most))
    given = cheapest_flow(dict(totals), {s: round(t) for s, t in target.items()}, costs)
    plan = [
        (
            list(members),
            given[members] // words if words else 0,
            given[members] % words if words else 0,
            [held[s] for s in members],
            [target[s] for s in members],
        )
        for members, words in totals
    ]
    schema = "members array<string>, every bigint, extra bigint, source_sizes array<bigint>, targets array<double>"
    plans = spark.createDataFrame(plan, schema)
    cuts = _cuts(rows, plans)
    # One row per membership pattern on the other side, written, so that the rows of a pattern
    # that holds most of them can be split.
    whole_plan = cut_lineage(plans.join(cuts, "members", "left"), "mix-plan")
    chosen = rows.join(whole_plan, "members", "left")
    times = F.col("every") + F.when(F.col("place") <= F.col("cut"), 1).otherwise(0)
    return chosen.select(
        "doc_id", "members", "place", "size", "source_sizes", "targets",
        times.alias("times"), (F.col("size") * times).alias("taken"),
    )


def _cuts(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """``members, cut``: the place up to which a pattern's documents are taken once more.

    The sum up to the cut is as near to ``extra`` as whole documents allow. The cut is found
    by sums over ranges of places: 4096 ranges of the whole order, then 4096 of the range the
    cut falls in, then the places of that one. No window sees more than 4096 rows of a
    pattern but the last, which sees the distinct places in a 2^24th of the order.
    """
    # Rows are added up by pattern and range, or meet a pattern by its range, so the rows of a
    # pattern that holds most of them are spread over many keys.
    wanted = plans.filter("extra > 0").select("members", F.col("extra").alias("left"))
    shift = 60 - BITS
    sums = rows.groupBy("members", F.shiftright("place", shift).alias("range")).agg(F.sum("size").alias("words"))
    state = _crossing(sums.join(wanted, "members"), "range")
    state = cut_lineage(state.select("members", F.col("range").alias("prefix"), "left"), "mix-ranges")
    within = rows.withColumn("prefix", F.shiftright("place", shift)).join(state, ["members", "prefix"])
    shift -= BITS
    sums = within.groupBy("members", "left", F.shiftright("place", shift).alias("range")).agg(F.sum("size").alias("words"))
    state = _crossing(sums, "range")
    state = cut_lineage(state.select("members", F.col("range").alias("prefix"), "left"), "mix-ranges")
    within = rows.withColumn("prefix", F.shiftright("place", shift)).join(state, ["members", "prefix"])
    sums = within.groupBy("members", "left", "prefix", "place").agg(F.sum("size").alias("words"))
    last = _crossing(sums, "place")
    # The document at the cut belongs to the part if that comes nearer.
    cut = F.when(F.col("words") <= 2 * F.col("left"), F.col("place")).otherwise(F.col("place") - 1)
    return cut_lineage(last.select("members", cut.alias("cut")), "mix-cuts")


def _crossing(sums: DataFrame, order: str) -> DataFrame:
    """The row of each pattern at which the running sum reaches ``left``, less what is before."""
    running = Window.partitionBy("members").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = sums.withColumn("upto", F.sum("words").over(running))
    reached = summed.filter((F.col("upto") >= F.col("left")) & (F.col("upto") - F.col("words") < F.col("left")))
    return reached.withColumn("left", F.col("left") - (F.col("upto") - F.col("words")))


def repeated(docs: DataFrame, sources: Column, seed: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; rows without words are left out."""
    times = mix(docs, sources, seed, id_col, text_col).filter("taken > 0").select("doc_id", "members", "place", "times").distinct()
    marked = docs.select(F.struct(*[column(c) for c in docs.columns]).alias("doc"), column(id_col).cast("bigint").alias("id"), members_of(sources).alias("of"), place_of(seed, id_col, text_col).alias("at"))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("of") == F.col("members")) & (F.col("at") == F.col("place"))
    taken = marked.join(times, same).select("doc", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("time"))
    return taken.select("doc.*")
