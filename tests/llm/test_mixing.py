import re
from collections import Counter
from itertools import product

from helpers import by_id, clashing, empty
from pyspark.sql import functions as F

from corpusprep.llm import mixing, queries


def targets(sizes):
    """Shares by weight with capacities, by moving the excess until none is left."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    whole = sum(sizes.values())
    target = {s: whole * weight[s] / sum(weight.values()) for s in names}
    while True:
        excess = sum(max(0, target[s] - 3 * sizes[s]) for s in names)
        target = {s: min(target[s], 3 * sizes[s]) for s in names}
        open_ = [s for s in names if target[s] < 3 * sizes[s]]
        if excess < 1e-9 or not open_:
            return target
        for s in open_:
            target[s] += excess * weight[s] / sum(weight[x] for x in open_)


def check(rows, texts, near):
    sizes, got = Counter(), Counter()
    for r in rows:
        source = r.members[0]
        sizes[source] += r["size"]
        got[source] += r.taken
        assert r.taken == r["size"] * r.times and 0 <= r.times <= 3
    assert sum(sizes.values()) == sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts)
    want = targets(dict(sizes))
    for r in rows:
        assert r.source_sizes == [sizes[r.members[0]]] and abs(r.targets[0] - want[r.members[0]]) < 1e-6 * (1 + want[r.members[0]])
    largest = {s: max(r["size"] for r in rows if r.members[0] == s) for s in sizes}
    for s in sizes:
        assert abs(got[s] - want[s]) <= near * largest[s] + 1


def test_targets_and_words_taken(spark, odd, sample):
    for docs in (odd, sample):
        rows = mixing.mix(docs, F.array("source")).collect()
        check(rows, [r.text for r in docs.collect()], 1)
    assert by_id(rows) == by_id(mixing.mix(sample, F.array("source")).collect())


def test_caps_are_shared_again():
    for sizes in ([1, 100, 3], [5, 5, 5, 5], [0, 10, 0], [1, 1, 1000], [7]):
        named = {str(k): v for k, v in enumerate(sizes)}
        got = mixing.capped_shares(sum(sizes), [3 * v for v in sizes], [(5, 2, 1)[k % 3] for k in range(len(sizes))])
        assert all(abs(a - b) < 1e-6 for a, b in zip(got, targets(named).values()))


def test_flow_is_the_cheapest():
    costs = (1, 3, 9)
    for patterns, quotas in (
        ({("a",): 2, ("a", "b"): 2, ("b",): 1}, {"a": 5, "b": 4}),
        ({("a", "b"): 3, ("b", "c"): 1}, {"a": 2, "b": 3, "c": 4}),
        ({("a",): 1, ("a", "b", "c"): 2, ("c",): 2}, {"a": 4, "b": 1, "c": 3}),
    ):
        given = mixing.cheapest_flow(patterns, quotas, costs)
        names = list(patterns)

        def price(amounts):
            return sum(sum(costs[min(w // max(patterns[p], 1), 2)] for w in range(n)) for p, n in zip(names, amounts))

        def routable(amounts):
            # Every set of sources takes no more than its quotas (the bound of a flow).
            sources = sorted({s for p in names for s in p})
            for mask in range(1, 1 << len(sources)):
                inside = {s for k, s in enumerate(sources) if mask >> k & 1}
                if sum(n for p, n in zip(names, amounts) if set(p) <= inside) > sum(quotas[s] for s in inside):
                    return False
            return True

        choices = [a for a in product(*[range(3 * patterns[p] + 1) for p in names]) if routable(a)]
        most = max(map(sum, choices))
        assert sum(given.values()) == most
        assert price([given[p] for p in names]) == min(price(a) for a in choices if sum(a) == most)


def test_overlapping_sources(spark):
    rows = [(k, " ".join(["w"] * (1 + k % 5)), ["a", "b"] if k % 3 == 0 else ["b"] if k % 3 == 1 else [None, "c"]) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, of array<string>")
    got = mixing.mix(docs, F.col("of")).collect()
    assert len(got) == 600 and all(r.taken <= 3 * r["size"] for r in got)
    wanted = sum({s: t for r in got for s, t in zip(r.members, r.targets)}.values())
    assert abs(sum(r.taken for r in got) - wanted) <= 15


def test_repeated_rows_and_names(spark, odd):
    wide = mixing.repeated(clashing(odd), F.array("source"))
    assert wide.columns == clashing(odd).columns
    times = {(r.doc_id, r.place): r.times for r in mixing.mix(odd, F.array("source")).collect()}
    assert wide.count() == sum(r.times for r in mixing.mix(odd, F.array("source")).collect() if r.taken)
    assert len(times) < odd.count()


def test_empty_tables(spark):
    assert mixing.mix(empty(spark), F.array("source")).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op5_mixing(spark, sf).collect()
    docs = {r.doc_id: r.source for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    sums = Counter()
    for r in got:
        sums[docs[r.doc_id]] += r["size"]
    assert len(got) == len(docs) and all(r.source_size == sums[docs[r.doc_id]] for r in got)
