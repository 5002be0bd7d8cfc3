import math

import numpy as np
import pytest
from helpers import empty
from pyspark.sql import functions as F

from corpusprep.llm import descent, hnsw, queries

SCHEMA = "vec_id bigint, embedding array<double>, label int"
ODD = [
    (1, None, 1), (2, [0.0, 0.0], 1), (3, [1.0, None], 1), (4, [1.0, float("nan")], 1), (5, [1.0, float("inf")], 1), (6, [1.0, 0.0], None),
    (7, [1.0, 0.0], 1), (8, [2.0, 0.0], 1), (9, [1.0, 0.0], 1), (9, [1.0, 0.0], 1), (10, [1.0, 0.1], 2), (11, [1.0], 1), (12, [], 1), (13, [-1.0, 0.0], 1),
    (None, [1.0, 0.01], 1),
]


def linked(rows, cosine=0.93):
    """Links and components by comparing all pairs."""
    good = [
        k for k, (_, v, label) in enumerate(rows)
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    unit = {k: np.array(rows[k][1]) / np.linalg.norm(rows[k][1]) for k in good}
    near = {k: [j for j in good if j != k and rows[j][2] == rows[k][2] and len(unit[j]) == len(unit[k]) and unit[j] @ unit[k] >= cosine] for k in good}
    out = []
    for k, row in enumerate(rows):
        seen, stack = {k}, [k]
        while stack:
            for j in near.get(stack.pop(), []):
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((row[0], len(near.get(k, [])), least, row[0] is None and least is None or row[0] == least))
    return out


def key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))


def test_links_of_odd_rows(spark):
    got = descent.near_vectors(spark.createDataFrame(ODD, SCHEMA)).collect()
    want = [r if r[0] is not None else r[:3] + (False,) for r in linked(ODD)]
    assert key((r.vec_id, r.n_links, r.component_id, bool(r.kept) and r.vec_id is not None) for r in got) == key(want)


@pytest.mark.parametrize("group", [1024, 32])
def test_links_equal_all_pairs(spark, monkeypatch, group):
    monkeypatch.setattr(descent, "GROUP", group)
    rng = np.random.default_rng(group)
    centres = rng.standard_normal((12, 16))
    rows = []
    for k in range(700):
        near = k % 3 == 0
        spread = 0.0 if k % 30 == 0 else [0.05, 0.12, 0.3][k % 7 % 3]
        vector = centres[0 if k % 2 else k % 12] + spread * rng.standard_normal(16) if near else rng.standard_normal(16)
        rows.append((k, (vector * (1 + k % 4)).tolist(), k % 2))
    got = descent.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    want = linked(rows)
    assert sum(w[1] for w in want) > 5000
    assert key(got) == key(want)


def test_links_in_a_cone(spark, monkeypatch):
    """All vectors share a large part, so hash buckets are far larger than a group; links are lone pairs."""
    monkeypatch.setattr(descent, "GROUP", 32)
    monkeypatch.setattr(descent, "SETS", 1)
    monkeypatch.setattr(descent, "ROUNDS", 0, raising=False)
    rng = np.random.default_rng(8)
    apart = rng.standard_normal((300, 48)) / math.sqrt(48)
    twins = np.concatenate([apart, apart + 0.5 * rng.standard_normal((300, 48)) / math.sqrt(48)])
    rows = [(k, v.tolist(), 1) for k, v in enumerate(twins + 2.6 / math.sqrt(48))]
    got = descent.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    want = linked(rows)
    assert 400 < sum(w[1] for w in want) < 6000
    assert key(got) == key(want)


@pytest.mark.parametrize("links", [1, 250])
def test_links_without_good_hashes(spark, monkeypatch, links):
    """One hash table and no lists to explore: the audit, or all pairs after it, finds the rest."""
    for name, value in {"SETS": 1, "TABLES": 1, "LIST": 1, "AUDIT": 60, "BUCKET": 4, "LINKS": links}.items():
        monkeypatch.setattr(descent, name, value, raising=False)
    rng = np.random.default_rng(9)
    first = rng.standard_normal((400, 32))
    twins = np.concatenate([first, first + 0.35 * rng.standard_normal((400, 32))])
    rows = [(k, v.tolist(), 1) for k, v in enumerate(twins)]
    want = linked(rows)
    assert 300 < sum(w[1] for w in want) < 900
    assert key(descent.near_vectors(spark.createDataFrame(rows, SCHEMA), recall=1.0).collect()) == key(want)


@pytest.mark.parametrize("kind", ["poor", "rich"])
def test_links_by_descent(spark, monkeypatch, kind):
    """The graph answers, where few vectors have a link and where most have many."""

    def never(*_):
        raise AssertionError("all pairs were compared")

    monkeypatch.setattr(descent, "every_edge", never)
    rng = np.random.default_rng(12)
    if kind == "poor":
        matrix = rng.standard_normal((20000, 32))
        matrix[-40:] = matrix[:40] + 0.3 * rng.standard_normal((40, 32))
    else:
        matrix = rng.standard_normal((2000, 32))[rng.integers(0, 2000, 20000)] + 0.25 * rng.standard_normal((20000, 32))
    unit = matrix / np.linalg.norm(matrix, axis=1)[:, None]
    want = np.concatenate([(unit[k : k + 2000] @ unit.T >= 0.93).sum(axis=1) - 1 for k in range(0, 20000, 2000)])
    assert (want.sum() < 100) if kind == "poor" else (want.sum() > 50000)
    df = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(matrix)], SCHEMA)
    got = {r.vec_id: r.n_links for r in descent.near_vectors(df).select("vec_id", "n_links").collect()}
    assert all(got[k] <= n for k, n in enumerate(want))
    assert sum(got.values()) >= 0.999 * want.sum()


def test_links_of_every_length_and_size(spark):
    """Lengths that few vectors have, components near the ends of the range, further columns."""
    rng = np.random.default_rng(6)
    rows = []
    for k in range(360):
        v = rng.standard_normal((2, 3, 16)[k % 3] if k % 10 else 5)
        rows.append((k, (v * (1e300, 1e-300, 1.0)[k % 7 % 3]).tolist(), k % 2))
    names = ["node", "leader", "vec", "copies", "least", "row", "raw", "code", "table", "bits", "n_links", "kept"]
    clash = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])
    want = linked([(i, (np.array(v) / np.abs(v).max()).tolist(), label) for i, v, label in rows])
    assert sum(w[1] for w in want) > 500
    assert key(descent.near_vectors(clash).collect()) == key(want)


def test_small_tables(spark):
    assert descent.near_vectors(empty(spark, SCHEMA)).count() == 0
    only = descent.near_vectors(spark.createDataFrame([(4, None, None)], SCHEMA)).first()
    assert tuple(only) == (4, 0, 4, True)


def test_neighbours_of_odd_rows(spark):
    rows = [(100 * k, v) for k, (_, v, _) in enumerate(ODD)] + [(None, [5.0, 5.0]), (700, [1.0, 0.0])]
    got = hnsw.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), lambda i: i % 100 == 0, k=3)
    part = {}
    for i, v in rows:
        if i is not None and v and len(v) == 2 and any(v) and all(x is not None and math.isfinite(x) for x in v):
            part[i] = np.array(v)
    want = []
    for q in part:
        near = sorted((float(np.sqrt(((part[q] - part[i]) ** 2).sum())), i) for i in part if i != q)[:3]
        want += [(q, rank + 1, i, d) for rank, (d, i) in enumerate(near)]
    assert key(got.collect()) == key(want)


def test_recall(spark):
    rng = np.random.default_rng(5)
    matrix = rng.standard_normal((3000, 24))
    matrix[1000:1400] = matrix[7]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(matrix)], "vec_id bigint, embedding array<double>")
    got = hnsw.nearest(df, lambda i: i % 20 == 0, shard_rows=700).collect()
    assert len(got) == 150 * 10
    hits = 0
    for q in range(0, 3000, 20):
        distance = np.sqrt(((matrix - matrix[q]) ** 2).sum(axis=1))
        order = [int(i) for i in np.lexsort((np.arange(3000), distance)) if i != q][:10]
        mine = [r for r in got if r.query_id == q]
        assert all(abs(r.score - distance[r.vec_id]) < 1e-12 for r in mine)
        hits += len({r.vec_id for r in mine} & set(order))
        if 1000 <= q < 1400:
            assert sorted(r.vec_id for r in mine) == order
    assert hits >= 0.97 * 1500


def test_no_rows(spark):
    assert hnsw.nearest(empty(spark, "vec_id bigint, embedding array<double>"), lambda i: i % 2 == 0).count() == 0


def test_queries(spark):
    sf = "/root/testdata/sf0.01"
    data = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    assert key(queries.op4_near_vectors(spark, sf).collect()) == key((r.vec_id, 0, r.vec_id, True) for r in data)
    got = queries.op7_neighbours(spark, sf).collect()
    matrix = np.array([r.embedding for r in data], float)
    names = [r.vec_id for r in data]
    hits = 0
    for k, name in enumerate(names):
        if name % 100 == 0:
            distance = np.sqrt(((matrix - matrix[k]) ** 2).sum(axis=1))
            hits += len({r.vec_id for r in got if r.query_id == name} & {names[i] for i in np.argsort(distance)[1:11]})
    assert hits >= 0.95 * len(got) > 0


@pytest.mark.parametrize("kind", ["plain", "shifted", "huge row", "tight clusters"])
def test_recall_of_one_shard(kind):
    """More than 4096 vectors in an index, also where squares lose their digits."""
    rng = np.random.default_rng(3)
    matrix = rng.standard_normal((4200, 32))
    if kind == "shifted":
        matrix += 1e4
    elif kind == "huge row":
        matrix[7] = 0
        matrix[7, 0] = 1e25
    elif kind == "tight clusters":
        matrix = 100 * rng.standard_normal((40, 32))[rng.integers(0, 40, 4200)] + 0.01 * matrix
    index = hnsw.Index.build(matrix, np.arange(len(matrix)))
    asked = np.arange(0, len(matrix), 20)
    hits = 0
    for query, nodes in zip(asked, index.search(matrix[asked], 11)):
        distance = ((matrix - matrix[query]) ** 2).sum(axis=1)
        hits += (distance[nodes[nodes >= 0]] <= np.sort(distance)[10]).sum()
    assert hits >= 0.95 * 11 * len(asked)
