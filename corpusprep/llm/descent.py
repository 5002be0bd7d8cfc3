"""Near-duplicate vectors by nearest-neighbour descent.

1. Equal vectors of a label are one class. Classes close together are gathered in balls: all
   members lie within half the link angle of the ball's leader, so any two of them are linked
   and none of their pairs is ever listed.
2. Leaders get a neighbour graph. It starts from sign hashes and is refined by joins of
   neighbours of neighbours: everyone who is near one leader is compared with everyone else
   near it. A list holds the ``LIST`` nearest; when it is full of links it grows by all links
   found beyond it.
3. An audit asks how many links the graph holds. Drawn leaders have a planted twin each, in a
   random direction and just within the link angle, where links are hardest to find; a few more
   leaders are compared with all others of their label. While the graph lacks such links, new
   hashes and rounds are added, as many as lone pairs need to meet by their hashes alone. Only
   if links are still lacking then, all leaders of a label are compared.
4. Edges within reach are settled: two balls are linked as a whole where the angles prove it,
   otherwise their members are compared. Links are counted, components joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import key_runs, matrix_of, unit_rows
from corpusprep.llm.hnsw import finite_vectors
from corpusprep.operators.components import components
from corpusprep.operators.rows import column, cut_lineage

#: Neighbours of a leader that are not links but kept to explore from.
LIST = 8
#: Hash tables of the first graph and of each later try; rows a hash bucket should have.
TABLES, BUCKET = 6, 64
#: Most rows compared with each other in one group; larger ones are cut into tiles, and every two
#: tiles meet. Balls are looked for within parts of that size: that loses no link.
GROUP = 1024
#: Least sets of tables before all are compared, leaders that an audit compares with all others, recall asked.
SETS, AUDIT, RECALL = 4, 256, 0.999
#: Most planted twins, and the largest share of the leaders that get one.
PLANTED, PLANTED_SHARE = 4096, 0.25
#: Leaders of one side of a group where all are compared, and rows compared at a time.
TILE, STEP = 4096, 512
#: Places of the leaders in the order in which audits draw them.
PLACES = 1 << 20
#: Angles are bounds only up to rounding.
MARGIN = 1e-9


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def _signs(vectors: np.ndarray, table: int, bits: int) -> np.ndarray:
    planes = np.random.default_rng(1000 + table).standard_normal((bits, vectors.shape[1]))
    return ((vectors @ planes.T) > 0) @ (1 << np.arange(bits, dtype=np.int64))


def _even(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches cut into such that hold vectors of one length."""
    for batch in batches:
        lengths = pc.list_value_length(batch.column("vec")).to_numpy()
        found = np.unique(lengths)
        for length in found:
            yield batch if len(found) == 1 else batch.filter(pa.array(lengths == length))


def label_bits(classes: DataFrame) -> DataFrame:
    """``label, bits``: so many bits that a bucket of the label has about ``BUCKET`` classes."""
    bits = F.round(F.log2(F.count(F.lit(1)) / BUCKET))
    return cut_lineage(classes.groupBy("label").agg(F.least(F.lit(60), F.greatest(F.lit(1), bits)).cast("int").alias("bits")), "label-bits")


def hashed(nodes: DataFrame, tables: list[int], bits: DataFrame) -> DataFrame:
    """``node, label, vec`` with ``table, code``: a row for each hash table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _even(batches):
            matrix, own = matrix_of(batch.column("vec")), batch.column("bits").to_numpy().astype(np.int64)
            for table in tables:
                codes = _signs(matrix, table, int(own.max())) & ((1 << own) - 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in ("node", "label", "vec")] + [pa.array(np.full(batch.num_rows, table, np.int32)), pa.array(codes)],
                    names=["node", "label", "vec", "table", "code"],
                )

    return nodes.select("node", "label", "vec").join(bits, "label").mapInArrow(run, "node bigint, label string, vec array<double>, table int, code bigint")


def _parts(rows: DataFrame, keys: list[str], salt: int) -> DataFrame:
    """Rows with ``part``: groups of more than ``GROUP`` rows are cut into parts of about half.

    Rows of different parts do not meet: only for what need not be complete.
    """
    large = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > GROUP)
    parts = F.coalesce(F.ceil(F.col("n") / (GROUP // 2)), F.lit(1))
    return rows.join(large, keys, "left").withColumn("part", F.pmod(F.xxhash64("node", F.lit(salt)), parts).cast("int")).drop("n")


def _met(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with ``mine, low, high``: groups of more than ``GROUP`` rows are cut into tiles of about half.

    A row is in the group of every two tiles ``low, high`` of which one is its own, ``mine``.
    """
    large = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > GROUP)
    large = large.select(*keys, F.ceil(F.col("n") / (GROUP // 2)).cast("int").alias("tiles"))
    tiled = rows.join(large, keys, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    tiled = tiled.withColumn("mine", F.pmod(F.xxhash64("node", F.lit(3)), F.col("tiles")).cast("int"))
    met = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return met.withColumn("low", F.least("mine", "other")).withColumn("high", F.greatest("mine", "other")).drop("tiles", "other")


def _grouped(rows: DataFrame, keys: list[str], run, schema: str) -> DataFrame:
    """``run`` over the runs of equal keys."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in key_runs(batches, keys):
            yield from run(group.combine_chunks())

    return rows.repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(each, schema)


def balls(classes: DataFrame, half: float, bits: DataFrame) -> DataFrame:
    """``node, label, vec, leader, radius``: a leader within ``half`` of each class.

    Within a hash bucket leaders are chosen one after the other, in the order of the nodes:
    each takes all that are left within the angle.
    """

    def cover(group: pa.Table) -> Iterator[pa.RecordBatch]:
        nodes, vectors = group.column("node").to_numpy(), matrix_of(group.column("vec"))
        cosines = vectors @ vectors.T
        leader, angle = np.full(len(nodes), -1), np.zeros(len(nodes))
        for k in range(len(nodes)):
            if leader[k] < 0:
                near = (leader < 0) & (cosines[k] >= math.cos(half - MARGIN))
                near[k] = True
                leader[near], angle[near] = k, _angle(cosines[k][near])
                angle[k] = 0.0
        yield pa.RecordBatch.from_arrays(
            [*(group.column(c).combine_chunks() if isinstance(group.column(c), pa.ChunkedArray) else group.column(c) for c in ("node", "label", "vec")),
             pa.array(nodes[leader]), pa.array(angle)],
            names=["node", "label", "vec", "leader", "angle"],
        )

    keyed = _parts(hashed(classes, [0], bits), ["label", "code"], 0)
    return _grouped(keyed, ["label", "code", "part"], cover, "node bigint, label string, vec array<double>, leader bigint, angle double")


def _gathered(state: DataFrame, half: float, bits: DataFrame, table: int) -> DataFrame:
    """A further round: leaders covered by another leader pass on the members that it reaches.

    A ball moves as a whole or not at all.
    """
    leaders = state.filter("node = leader").select("node", "label", "vec")

    def cover(group: pa.Table) -> Iterator[pa.RecordBatch]:
        nodes, vectors = group.column("node").to_numpy(), matrix_of(group.column("vec"))
        near = vectors @ vectors.T >= math.cos(half - MARGIN)
        to = np.full(len(nodes), -1)
        for k in range(len(nodes)):
            if to[k] < 0:
                to[near[k] & (to < 0)] = k
                to[k] = k
        moved = to != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[to[moved]])], names=["old", "new"])

    keyed = _parts(hashed(leaders, [table], bits), ["label", "code"], table)
    moves = _grouped(keyed, ["label", "code", "part"], cover, "old bigint, new bigint")
    wanted = state.join(moves, state["leader"] == moves["old"]).join(
        leaders.select(F.col("node").alias("new"), F.col("vec").alias("new_vec")), "new"
    )
    cosine = _dot("vec", "new_vec")
    tried = cut_lineage(wanted.select("node", "old", "new", F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))).alias("moved_angle")), "ball-moves")
    good = tried.groupBy("old").agg(F.max("moved_angle").alias("widest")).filter(F.col("widest") <= half - MARGIN).select("old")
    taken = tried.join(good, "old").select("node", "new", "moved_angle")
    merged = state.join(taken, "node", "left")
    return merged.select(
        "node", "label", "vec", F.coalesce("new", "leader").alias("leader"), F.coalesce("moved_angle", "angle").alias("angle")
    )


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


# --- the graph -----------------------------------------------------------------------------


def _reach(one: np.ndarray, two: np.ndarray, angle: float) -> np.ndarray:
    """Cosine from which the balls of two leaders may have a linked pair, by their radii."""
    least = np.cos(np.minimum(np.pi, angle + one[:, None] + two[None, :] + MARGIN))
    return np.where((one[:, None] == 0) & (two[None, :] == 0), math.cos(angle) - MARGIN, least)


def _nearest_of(group: pa.Table, angle: float, old: np.ndarray | None, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a group worth keeping: each row's nearest, and all within reach.

    In a group of two tiles only rows of different tiles are pairs.
    With ``old`` only pairs with a new row count, and only those nearer than the list of
    either end reaches (column ``far``).
    """
    vectors, radius = matrix_of(group.column("vec")), group.column("radius").to_numpy()
    mine = group.column("mine").to_numpy()
    crossed = group.column("low")[0].as_py() != group.column("high")[0].as_py()
    met = mine[:, None] != mine[None, :] if crossed else ~np.eye(len(mine), dtype=bool)
    cosines = np.where(met, vectors @ vectors.T, -2.0)
    near = met & (cosines >= _reach(radius, radius, angle))
    best = np.zeros(cosines.shape, bool)
    if len(cosines) > 1:
        top = np.argpartition(-cosines, min(keep, len(cosines) - 1) - 1, axis=1)[:, :keep]
        np.put_along_axis(best, top, True, 1)
        best &= met
    if old is not None:
        far = group.column("far").to_numpy()
        best &= cosines > far[:, None]
        fresh = ~(old[:, None] & old[None, :])
        best, near = best & fresh, near & fresh
    left, right = np.nonzero(best | near)
    return left, right, cosines[left, right]


_EDGE = "a bigint, b bigint, cosine double, link boolean"


def _edges_of(group: pa.Table, angle: float, old: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    left, right, cosines = _nearest_of(group, angle, old, LIST)
    if len(left):
        nodes, radius = group.column("node").to_numpy(), group.column("radius").to_numpy()
        single = (radius[left] == 0) & (radius[right] == 0)
        least = np.where(single, math.cos(angle) - MARGIN, np.cos(np.minimum(np.pi, angle + radius[left] + radius[right] + MARGIN)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[left]), pa.array(nodes[right]), pa.array(cosines), pa.array(cosines >= least)],
            names=["a", "b", "cosine", "link"],
        )


def first_edges(leaders: DataFrame, angle: float, bits: DataFrame, tables: list[int]) -> DataFrame:
    """Edges between leaders that share a bucket of a hash table."""
    with_radius = hashed(leaders, tables, bits).join(leaders.select("node", "radius"), "node")
    return _grouped(_met(with_radius, ["table", "label", "code"]), ["table", "label", "code", "low", "high"], lambda g: _edges_of(g, angle, None), _EDGE)


def merged_lists(edges: DataFrame) -> DataFrame:
    """``a, b, cosine, link, old``: each node's list, its nearest and all its links."""
    both = edges.groupBy("a", "b").agg(F.max("cosine").alias("cosine"), F.max("link").alias("link"), F.max("old").alias("old"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("cosine"), "b"))
    return both.withColumn("rank", rank).filter((F.col("rank") <= LIST) | F.col("link")).drop("rank")


def descend(leaders: DataFrame, lists: DataFrame, angle: float) -> tuple[DataFrame, int]:
    """One round: the lists after everyone near a node met, and the number of new links."""
    far = lists.groupBy("a").agg(F.min("cosine").alias("far"), F.count(F.lit(1)).alias("n"))
    far = far.select(F.col("a").alias("node"), F.when(F.col("n") >= LIST, F.col("far")).otherwise(F.lit(-2.0)).alias("far"))
    nodes = leaders.select("node", "vec", "radius").join(far, "node", "left").withColumn("far", F.coalesce("far", F.lit(-2.0)))
    directed = lists.select(F.col("a").alias("centre"), F.col("b").alias("node"), "old").unionByName(
        lists.select(F.col("b").alias("centre"), F.col("a").alias("node"), "old")
    )
    members = directed.groupBy("centre", "node").agg(F.min("old").alias("old"))
    live = members.filter(~F.col("old")).select("centre").distinct()
    placed = _met(members.join(live, "centre", "left_semi"), ["centre"]).join(nodes, "node")

    def meet(group: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from _edges_of(group, angle, group.column("old").to_numpy(zero_copy_only=False))

    found = _grouped(placed, ["centre", "low", "high"], meet, _EDGE)
    now = lists.withColumn("old", F.lit(True)).unionByName(found.withColumn("old", F.lit(False)))
    result = cut_lineage(merged_lists(now), "neighbour-lists")
    return result, result.filter("link and not old").count()


def exact_edges(leaders: DataFrame, angle: float, asked: Column) -> DataFrame:
    """``a, b, cosine``: all links of the leaders ``asked`` with leaders of their label, tile by tile."""
    rows = leaders.select("node", "label", "vec", "radius", asked.alias("asked"))
    sizes = rows.groupBy("label").agg(
        F.ceil(F.sum(F.col("asked").cast("int")) / TILE).cast("int").alias("ta"), F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tb")
    )
    rows = rows.join(sizes.filter("ta > 0"), "label")
    mine = lambda t: F.pmod(F.xxhash64("node", F.lit(7)), F.col(t)).cast("int")
    left = rows.filter("asked").withColumn("i", mine("ta")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("tb") - 1)))
    right = rows.withColumn("j", mine("tb")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("ta") - 1)))
    names = ["label", "i", "j", "node", "vec", "radius"]
    both = left.select(*names, F.lit(0).alias("side")).unionByName(right.select(*names, F.lit(1).alias("side")))

    def compare(group: pa.Table) -> Iterator[pa.RecordBatch]:
        side, vectors = group.column("side").to_numpy(), matrix_of(group.column("vec"))
        nodes, radius = group.column("node").to_numpy(), group.column("radius").to_numpy()
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        for start in range(0, len(one), STEP):
            part = one[start : start + STEP]
            cosines = vectors[part] @ vectors[two].T
            row, col = np.nonzero((cosines >= _reach(radius[part], radius[two], angle)) & (nodes[part][:, None] != nodes[two][None, :]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[part][row]), pa.array(nodes[two][col]), pa.array(cosines[row, col])], names=["a", "b", "cosine"]
            )

    return _grouped(both, ["label", "i", "j"], compare, "a bigint, b bigint, cosine double")


def every_edge(leaders: DataFrame, angle: float) -> DataFrame:
    """All links of all leaders: the way left where the graph misses links after its last set of tables."""
    return cut_lineage(exact_edges(leaders, angle, F.lit(True)), "all-links")


def twins(leaders: DataFrame, rows: int, angle: float) -> DataFrame:
    """``node, label, vec, radius``: twins of drawn leaders, just within the angle in a random direction.

    The twin of ``node`` is ``-1 - node``. A vector of one component has no direction to go.
    """

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = max(0.0, angle - 1e-6)
        for batch in _even(batches):
            vectors, nodes = matrix_of(batch.column("vec")), batch.column("node").to_numpy()
            if not len(nodes) or vectors.shape[1] < 2:
                continue
            aside = np.stack([np.random.default_rng(int(n)).standard_normal(vectors.shape[1]) for n in nodes])
            aside = unit_rows(aside - (aside * vectors).sum(axis=1)[:, None] * vectors)
            turned = unit_rows(math.cos(inside) * vectors + math.sin(inside) * aside)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(nodes) + 1, dtype=np.int32) * vectors.shape[1]), pa.array(turned.ravel()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(-1 - nodes), batch.column("label"), flat, pa.array(np.zeros(len(nodes)))], names=["node", "label", "vec", "radius"]
            )

    last = math.ceil(PLACES * min(PLANTED_SHARE, PLANTED / max(rows, 1)))
    drawn = leaders.filter(F.pmod(F.xxhash64("node", F.lit(10)), F.lit(PLACES)) < last)
    return drawn.select("node", "label", "vec").mapInArrow(turn, "node bigint, label string, vec array<double>, radius double")


def audit(leaders: DataFrame, planted: DataFrame, lists: DataFrame, rows: int, angle: float, attempt: int) -> tuple[float, DataFrame]:
    """The smaller share that the lists hold of the planted links and of those of drawn leaders, and the latter.

    Planted links show what the graph does where true links are rare, true ones what it does where
    they are many.
    """
    place = F.pmod(F.xxhash64("node", F.lit(11 + attempt)), F.lit(PLACES))
    true = cut_lineage(exact_edges(leaders, angle, place < math.ceil(PLACES * AUDIT / max(rows, 1))), "audit")
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    asked = true.select(*ends, F.lit(0).alias("kind")).distinct().unionByName(
        planted.select(F.col("node").alias("a"), (-1 - F.col("node")).alias("b"), F.lit(1).alias("kind"))
    )
    held = lists.filter("link").select(*ends).distinct().withColumn("held", F.lit(1))
    shares = asked.join(held, ["a", "b"], "left").groupBy("kind").agg((F.count("held") / F.count(F.lit(1))).alias("share"))
    return min((r["share"] for r in shares.collect()), default=1.0), true


def attempts(bits: DataFrame, angle: float, recall: float) -> int:
    """Sets of tables after which two leaders at the angle have met in a bucket with the recall asked for."""
    most = bits.agg(F.max("bits")).first()[0] or 1
    same = min(1.0 - 1e-9, (1 - angle / math.pi) ** most)
    return max(SETS, math.ceil(math.log(1 - recall) / math.log1p(-same) / TABLES))


def searched(leaders: DataFrame, bits: DataFrame, rows: int, angle: float, recall: float) -> DataFrame:
    """``a, b, cosine, link``: the lists of the leaders once an audit finds the recall in them."""
    planted = cut_lineage(twins(leaders, rows, angle), "planted")
    field = cut_lineage(leaders.select("node", "label", "vec", "radius").unionByName(planted), "planted-leaders")
    lists = None
    for attempt in range(attempts(bits, angle, recall)):
        tables = list(range(200 + attempt * TABLES, 200 + (attempt + 1) * TABLES))
        found = first_edges(field, angle, bits, tables).withColumn("old", F.lit(False))
        if lists is not None:
            found = lists.withColumn("old", F.lit(True)).unionByName(found)
        lists = cut_lineage(merged_lists(found), "neighbour-lists")
        fresh = 1
        while fresh:
            lists, fresh = descend(field, lists, angle)
        share, true = audit(leaders, planted, lists, rows, angle, attempt)
        if share >= recall:
            own = lists.filter("a >= 0 and b >= 0").select("a", "b", "cosine", "link")
            return own.unionByName(true.withColumn("link", F.lit(True)))
    return every_edge(leaders, angle).withColumn("link", F.lit(True))


# --- settling ------------------------------------------------------------------------------


def settled(leaders: DataFrame, members: DataFrame, lists: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """``node, n`` links of each class into other balls, and ``a, b`` linked leaders."""
    angle = math.acos(cosine)
    ends = leaders.select("node", "radius", "rows")
    pairs = (
        lists.filter("link").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "cosine").dropDuplicates(["a", "b"])
        .join(ends.select(F.col("node").alias("a"), F.col("radius").alias("ra"), F.col("rows").alias("na")), "a")
        .join(ends.select(F.col("node").alias("b"), F.col("radius").alias("rb"), F.col("rows").alias("nb")), "b")
    )
    between = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("cosine"))))
    alone = (F.col("ra") == 0) & (F.col("rb") == 0)
    whole = F.when(alone, F.col("cosine") >= cosine).otherwise(between + F.col("ra") + F.col("rb") <= angle - MARGIN)
    pairs = cut_lineage(pairs.select("a", "b", "na", "nb", alone.alias("alone"), whole.alias("whole")), "ball-pairs")
    bulk = pairs.filter("whole")
    by_ball = bulk.select(F.col("a").alias("leader"), F.col("nb").alias("n")).unionByName(bulk.select(F.col("b").alias("leader"), F.col("na").alias("n")))
    by_ball = by_ball.groupBy("leader").agg(F.sum("n").alias("n"))
    # Members of pairs that the angles leave open, tile by tile.
    open_ = pairs.filter("not whole and not alone").select("a", "b")
    sizes = members.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / (GROUP // 2)).cast("int").alias("tiles"))
    open_ = open_.join(sizes.select(F.col("leader").alias("a"), F.col("tiles").alias("ta")), "a").join(
        sizes.select(F.col("leader").alias("b"), F.col("tiles").alias("tb")), "b"
    )
    side = members.select("leader", "node", "vec", "copies")
    mine = lambda t: F.pmod(F.xxhash64("node", F.lit(5)), F.col(t)).cast("int")
    left = open_.join(side.withColumnRenamed("leader", "a"), "a").withColumn("i", mine("ta")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("tb") - 1)))
    right = open_.join(side.withColumnRenamed("leader", "b"), "b").withColumn("j", mine("tb")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("ta") - 1)))
    names = ["a", "b", "i", "j", "node", "vec", "copies"]
    both = left.select(*names, F.lit(0).alias("side")).unionByName(right.select(*names, F.lit(1).alias("side")))

    def compare(group: pa.Table) -> Iterator[pa.RecordBatch]:
        where, vectors = group.column("side").to_numpy(), matrix_of(group.column("vec"))
        nodes, copies = group.column("node").to_numpy(), group.column("copies").to_numpy()
        one, two = where == 0, where == 1
        near = vectors[one] @ vectors[two].T >= cosine
        counts = np.concatenate([near @ copies[two], near.T @ copies[one]])
        hit = counts > 0
        size = int(hit.sum())
        a, b = group.column("a")[0].as_py(), group.column("b")[0].as_py()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([nodes[one], nodes[two]])[hit]), pa.array(counts[hit].astype(np.int64)), pa.array(np.full(size, a)), pa.array(np.full(size, b))],
            names=["node", "n", "a", "b"],
        )

    counted = cut_lineage(_grouped(both, ["a", "b", "i", "j"], compare, "node bigint, n bigint, a bigint, b bigint"), "member-links")
    by_node = counted.groupBy("node").agg(F.sum("n").alias("more"))
    links = (
        members.select("node", "leader").join(by_ball, "leader", "left").join(by_node, "node", "left")
        .select("node", "leader", (F.coalesce("n", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n"))
    )
    return links, bulk.select("a", "b").unionByName(counted.select("a", "b").distinct())


def near_vectors(df: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 recall: float = RECALL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    At least the share ``recall`` of the links is found, by an audit; with 1 all rows of a label
    are compared, as no audit can prove that. Two rows are linked if their labels are equal and not null and their cosine, in double
    precision, is at least ``cosine``; vectors of different lengths are not. ``n_links`` counts the other rows linked, copies
    included; ``component_id`` is the smallest id reachable; ``kept`` marks the row with that
    id. Vectors that ``finite_vectors`` rules out and rows without a label have no links and are
    kept. A row without an id takes part, but is never the smallest of a component with ids.
    """
    rows = df.select(column(id_col).cast("bigint").alias("vec_id"), column(label_col).cast("string").alias("label"), column(vec_col).cast("array<double>").alias("raw"))
    rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()), "vector-rows")
    # Vectors of different lengths have no cosine: each length of a label is a label of its own.
    valid = finite_vectors(rows.filter("label is not null"), "row", "raw", "label", "vec_id")
    valid = valid.withColumn("label", F.concat_ws(":", F.size("vec"), "label"))
    classes = valid.groupBy("label", "vec").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"), F.min("id").alias("node"))

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _even(batches):
            # Scaled by the largest component first, so that squares neither over- nor underflow.
            matrix = matrix_of(batch.column("vec"))
            scaled = unit_rows(matrix / np.abs(matrix).max(axis=1, initial=0.0)[:, None])
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(scaled) + 1, dtype=np.int32) * matrix.shape[1]), pa.array(scaled.ravel()))
            columns = [vectors if c == "unit" else batch.column(c) for c in ("node", "label", "vec", "unit", "copies", "least") if c == "unit" or c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "label", "vec", "unit", "copies", "least"])

    classes = cut_lineage(
        classes.select("node", "label", "vec", "copies", "least").mapInArrow(
            unit, "node bigint, label string, vec array<double>, unit array<double>, copies bigint, least bigint"
        ),
        "vector-classes",
    )
    half, angle = math.acos(cosine) / 2, math.acos(cosine)
    bits = label_bits(classes)
    units = classes.select("node", "label", F.col("unit").alias("vec"))
    state = cut_lineage(balls(units, half, bits), "balls")
    led = state.filter("node = leader").count()
    for table in (1, 2, 3):
        state = cut_lineage(_gathered(state, half, bits, 100 + table), "balls")
        before, led = led, state.filter("node = leader").count()
        if led > 0.99 * before:
            break
    members = cut_lineage(state.join(classes.select("node", "copies", "least"), "node"), "ball-members")
    sizes = members.groupBy("leader").agg(F.max("angle").alias("radius"), F.sum("copies").alias("rows"), F.min("least").alias("first"))
    leaders = cut_lineage(
        state.filter("node = leader").select("node", "label", "vec").join(sizes.withColumnRenamed("leader", "node"), "node"), "leaders"
    )
    if recall < 1:
        lists = searched(leaders, bits, led, angle, recall)
    else:
        lists = every_edge(leaders, angle).withColumn("link", F.lit(True))
    links, edges = settled(leaders, members, lists, cosine)
    joined = components(edges).withColumnRenamed("id", "leader")
    rooted = cut_lineage(leaders.select(F.col("node").alias("leader"), "rows", "first").join(joined, "leader", "left").withColumn("root", F.coalesce("label", "leader")), "roots")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    facts = rooted.join(smallest, "root").select("leader", "rows", "component_id")
    by_class = links.join(facts, "leader").join(classes.select("node", "label", "vec"), "node")
    by_class = by_class.select("label", "vec", (F.col("n") + F.col("rows") - 1).alias("n_links"), "component_id")
    found = valid.join(by_class, ["label", "vec"]).select(F.col("id").alias("row"), "n_links", "component_id")
    result = rows.select("row", "vec_id").join(found, "row", "left")
    component = F.coalesce("component_id", "vec_id")
    return result.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
