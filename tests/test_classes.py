"""Similar rows as classes, against all pairs."""

import math

import numpy as np
import pyarrow as pa
import pytest

from corpusprep.operators import classes as C
from corpusprep.operators import neighbors as N
from corpusprep.operators.classes import similar_classes

SCHEMA = "row_index bigint, embedding array<double>"


def expanded(found):
    """All pairs that a compressed result stands for; none may come twice."""
    members = found.members.collect()
    rows, firsts = {}, {}
    for r in members:
        rows.setdefault(r.class_id, []).append(r.id)
        firsts.setdefault(r.first, []).append(r.id)
    pairs = [(a, b) for ids in rows.values() for a in ids for b in ids if a < b]
    pairs += [(min(a, b), max(a, b)) for p in found.class_pairs.collect() for a in rows[p.left_class] for b in rows[p.right_class]]
    pairs += [(min(a, b), max(a, b)) for p in found.row_pairs.collect() for a in firsts[p.left_id] for b in firsts[p.right_id]]
    assert len(pairs) == len(set(pairs))
    return set(pairs)


def brute(matrix, threshold):
    unit = matrix / np.linalg.norm(matrix, axis=1)[:, None]
    return {(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(unit @ unit.T >= threshold, 1)))}


def frame(spark, matrix):
    return spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(matrix)], SCHEMA)


@pytest.mark.parametrize("tile", [8192, 24])
def test_equal_to_all_pairs(spark, tile):
    rng = np.random.default_rng(tile)
    hubs = rng.standard_normal((15, 12))
    spread = rng.choice([0.02, 0.15, 0.4], 300)[:, None]
    matrix = hubs[rng.integers(0, 15, 300)] + spread * rng.standard_normal((300, 12))
    matrix[50:60] = matrix[7]
    want = brute(matrix, 0.9)
    found = similar_classes(frame(spark, matrix), "embedding", 0.9, tile=tile)
    assert expanded(found) == want
    assert found.row_pairs.count() > 0 and found.class_pairs.count() > 0
    counts = {r.id: r.n_links for r in found.link_counts().collect()}
    assert counts == {k: sum(k in p for p in want) for k in range(300)}


def test_near_copies_take_one_record_each(spark):
    rng = np.random.default_rng(4)
    matrix = np.concatenate([rng.standard_normal((1, 32)) + 1e-3 * rng.standard_normal((500, 32)), rng.standard_normal((40, 32))])
    found = similar_classes(frame(spark, matrix), "embedding", 0.9, tile=64)
    assert found.members.count() == 540
    assert found.class_pairs.count() + found.row_pairs.count() == 0
    assert {r.n_links for r in found.link_counts().filter("id < 500").collect()} == {499}


def test_odd_vectors(spark):
    rows = [(1, None), (2, [0.0, 0.0]), (3, [1.0, float("nan")]), (4, [1.0, 0.0]), (5, [2.0, 0.0]), (6, [1.0, 0.0]), (7, [0.0, 1.0]), (8, [0.0, 0.0])]
    found = similar_classes(spark.createDataFrame(rows, SCHEMA), "embedding", 0.99)
    assert expanded(found) == {(4, 5), (4, 6), (5, 6)}
    assert sorted(tuple(r) for r in found.link_counts().collect()) == [(4, 2), (5, 2), (6, 2), (7, 0)]


def test_no_rows(spark):
    found = similar_classes(spark.createDataFrame([], SCHEMA), "embedding", 0.9)
    assert found.members.count() == found.link_counts().count() == found.row_pairs.count() == 0


def test_groups_grow_with_the_rows():
    """Up to 2.4 million vectors of 64 components, copies of a vector stay as few as for a tenth of them."""
    rows = 2_461_536
    parts = [N._parts(n, n, N.TILE_ROWS, N.GROUP_BYTES // (8 * 64)) for n in (rows // 60, rows // 6, rows)]
    assert parts[0] <= 6 and parts[1] <= 6 and parts[2] <= 10


def test_steps_of_similarity(spark):
    rng = np.random.default_rng(8)
    cosines = rng.uniform(-1, 1, (40, 60))
    cosines[:, 20:50] = np.minimum(cosines[:, 20:50], 0.7)
    base, probe = {"id": np.arange(60)}, {"id": np.arange(100, 140)}
    got = {(int(p), int(b)) for p, b, _ in zip(*N.improving(0.8)(base, probe, cosines))}
    want = {(100 + r, c) for r in range(40) for c in range(60) if cosines[r, c] >= 0.8 and cosines[r, c] > max(cosines[r, :c], default=-2)}
    assert got == want
    assert [len(x) for x in N.improving(0.99)(base, probe, np.zeros((40, 60)))] == [0, 0, 0]


def test_a_row_meets_the_heads_once(spark, monkeypatch):
    """The head that removed a row is its class: vectors meet for pairs of classes and of rows, not for homes."""
    calls = []
    monkeypatch.setattr(C, "tile_join", lambda *a, **b: calls.append(1) or N.tile_join(*a, **b))
    rng = np.random.default_rng(16)
    matrix = rng.standard_normal((10, 16))[rng.integers(0, 10, 200)] + 0.1 * rng.standard_normal((200, 16))
    found = similar_classes(frame(spark, matrix), "embedding", 0.9, tile=32)
    assert expanded(found) == brute(matrix, 0.9)
    assert len(calls) == 2


def test_single_precision_decides_nothing_near_the_threshold(spark):
    """Cosines 1e-10 above and below it."""
    angles = math.acos(0.9) + np.array([-1e-10, 1e-10])
    rows = [(0, [1.0, 0.0])] + [(k + 1, [math.cos(a), math.sin(a)]) for k, a in enumerate(angles)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {(r.left_id, r.right_id) for r in N.similar_pairs(df, "embedding", 0.9).collect()} == {(0, 1), (1, 2)}
    assert expanded(similar_classes(df, "embedding", 0.9)) == {(0, 1), (1, 2)}


def test_lower_ids_only(spark):
    """Of each row, whether and which row of lower id is similar; later rows are not multiplied."""
    shapes = []
    rng = np.random.default_rng(18)
    matrix = rng.standard_normal((60, 4))
    unit = matrix / np.linalg.norm(matrix, axis=1)[:, None]
    cosines = unit @ unit.T
    ids = np.arange(60)
    part = pa.table({"id": ids, "vec": pa.array(matrix.tolist())})

    def watched(reducer):
        @N.single(lower=True)
        def reduce(base, probe, cosines, exact):
            shapes.append((probe["id"].max(), base["id"].max()))
            return reducer(base, probe, cosines, exact)

        return reduce

    below = np.tril(cosines >= 0.8, -1)
    got = N.multiplier(watched(N.has_lower(0.8)), "id bigint")(part, part)
    assert set(got["id"].to_pylist()) == set(np.flatnonzero(below.any(axis=1)))
    found = N.multiplier(watched(N.best_lower(0.8)), "id bigint, class_id bigint, cosine double")(part, part).to_pylist()
    best = {k: np.where(below[k], cosines[k], -2).argmax() for k in np.flatnonzero(below.any(axis=1))}
    assert {r["id"]: r["class_id"] for r in found} == best
    assert all(base < probe for probe, base in shapes)
