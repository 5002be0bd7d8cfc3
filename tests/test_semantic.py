"""Similarity joins and semantic deduplication against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.operators import neighbors as N
from corpusprep.operators import semantic as S


def unit(matrix):
    matrix = np.asarray(matrix, dtype=float)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def table(spark, matrix, **columns):
    rows = []
    for i, vector in enumerate(matrix):
        rows.append((i, [float(x) for x in vector], *(values[i] for values in columns.values())))
    extra = "".join(f", {name} string" for name in columns)
    return spark.createDataFrame(rows, f"row_index bigint, embedding array<double>{extra}")


def clustered(seed, centers, per, dim, spread):
    rng = np.random.default_rng(seed)
    hubs = rng.standard_normal((centers, dim))
    points = np.repeat(hubs, per, axis=0) + spread * rng.standard_normal((centers * per, dim))
    return unit(rng.permutation(points))


def sequential(keys, matrix, threshold):
    """The definition, row by row: kept rows and (row, match, similarity) of the others."""
    kept, matches, blank = [], {}, None
    reps, first = [], {}
    for i, key in enumerate(keys):
        if key == "":
            if blank is None:
                blank = i
                kept.append(i)
            else:
                matches[i] = (blank, 1.0)
            continue
        scores = np.array([matrix[i] @ matrix[r] for r in reps])
        if len(scores) and scores.max() >= threshold or key in first:
            best = int(scores.argmax())
            matches[i] = (reps[best], scores[best])
            first.setdefault(key, i)
        else:
            first[key] = i
            reps.append(i)
            kept.append(i)
    return kept, matches


def run(spark, keys, matrix, threshold, **options):
    df = table(spark, matrix, text=keys)
    outcome = S.semantic_dedup(df, threshold=threshold, **options)
    kept = sorted(r.row_index for r in outcome.kept().collect())
    found = {r.row_index: (r.duplicate_of_row_index, r.similarity) for r in outcome.matches().collect()}
    return outcome, kept, found


def same_matches(found, expected):
    assert found.keys() == expected.keys()
    for row, (match, similarity) in expected.items():
        assert found[row][0] == match, row
        assert found[row][1] == pytest.approx(similarity, abs=1e-9)


@pytest.mark.parametrize("cells", ["one", "many"])
def test_pairs_and_top_k(spark, cells):
    matrix = clustered(1, 8, 25, 6, 0.4)
    matrix[50:60] = matrix[3]
    df = table(spark, matrix)
    tile = 4096 if cells == "one" else 16
    got = {(r.left_id, r.right_id) for r in N.similar_pairs(df, "embedding", 0.9, tile=tile).collect()}
    distinct = [i for i in range(len(matrix)) if not 50 <= i < 60]
    dots = matrix @ matrix.T
    want = {(i, j) for i in distinct for j in distinct if i < j and dots[i, j] >= 0.9}
    want |= {(3, i) for i in range(50, 60)}
    assert got == want

    approx = {(r.left_id, r.right_id) for r in N.similar_pairs_approx(df, "embedding", 0.9, tile=tile).collect()}
    assert approx <= want and len(approx) > 0.8 * len(want)

    top = N.top_k_neighbors(df, df, 5, tile=tile).collect()
    for i in range(len(matrix)):
        mine = sorted((r.rank, r.similarity) for r in top if r.query_id == i)
        best = np.sort(dots[i])[::-1][:5]
        assert [rank for rank, _ in mine] == [1, 2, 3, 4, 5]
        assert np.allclose([s for _, s in mine], best, atol=1e-9)


def test_several_cells_are_used(spark):
    matrix = clustered(2, 8, 25, 6, 0.1)
    df = N.vector_table(table(spark, matrix), "embedding", "row_index")
    cells = N.PivotCells.choose(df, len(matrix), tile=16)
    assert len(cells.pivots) == 6
    base, probe = cells.place(df, df, math.acos(0.95))
    assert base.count() == 200 and 200 <= probe.count() < 1200


@pytest.mark.parametrize(
    "options",
    [{}, {"tile": 16}, {"tile": 16, "first_block": 8, "max_block": 32}],
    ids=["one-block", "tiles", "many-blocks"],
)
@pytest.mark.parametrize("threshold", [0.95, 0.7])
def test_equals_the_sequential_pass(spark, options, threshold):
    matrix = clustered(3, 12, 15, 5, 0.35)
    keys = [f"t{i}" for i in range(len(matrix))]
    for copy, original in ((20, 4), (90, 4), (170, 4), (60, 33), (61, 33)):
        matrix[copy], keys[copy] = matrix[original], keys[original]
    for i in (7, 30, 150):
        keys[i] = ""
    kept, matches = sequential(keys, matrix, threshold)
    outcome, got, found = run(spark, keys, matrix, threshold, **options)
    assert got == kept
    same_matches(found, matches)
    stats = outcome.stats().first()
    assert (stats.total_before, stats.total_after) == (180, len(kept))
    assert stats.duplicate_rows == 180 - len(kept) and stats.unique_values == len(kept)


def test_hot_group_of_near_copies(spark):
    rng = np.random.default_rng(5)
    matrix = unit(np.vstack([rng.standard_normal((60, 8)), np.ones((60, 8)) + 0.01 * rng.standard_normal((60, 8))]))
    keys = [f"t{i}" for i in range(120)]
    kept, matches = sequential(keys, matrix, 0.9)
    _, got, found = run(spark, keys, matrix, 0.9, tile=16, first_block=16, max_block=16)
    assert got == kept
    same_matches(found, matches)


def test_chain(spark):
    angles = np.arange(40) * 0.3
    matrix = np.column_stack([np.cos(angles), np.sin(angles)])
    keys = [f"t{i}" for i in range(40)]
    kept, matches = sequential(keys, matrix, math.cos(0.35))
    _, got, found = run(spark, keys, matrix, math.cos(0.35))
    assert got == kept
    same_matches(found, matches)


def test_categories_in_the_audit_table(spark):
    df = spark.createDataFrame(
        [
            (10, "where is my parcel", "post", [0.0, 2.0]),
            (11, "card was declined", "bank", [3.0, 0.1]),
            (12, "parcel, where?", "mail", [0.05, 1.0]),
            (13, "declined card", None, [1.0, 0.0]),
            (14, "my parcel please", "post", [-0.02, 1.5]),
        ],
        "row_index bigint, text string, label string, embedding array<float>",
    )
    outcome = S.semantic_dedup(df, threshold=0.98, category="label")
    assert sorted(r.row_index for r in outcome.kept().collect()) == [10, 11]
    rows = {r.row_index: r for r in outcome.matches().collect()}
    assert list(rows[12].asDict()) == [
        "row_index", "duplicate_of_row_index", "text", "matched_text",
        "label", "matched_label", "same_label", "similarity",
    ]
    assert [(k, r.duplicate_of_row_index, r.matched_label, r.same_label) for k, r in sorted(rows.items())] == [
        (12, 10, "post", False), (13, 11, "bank", False), (14, 10, "post", True),
    ]
    assert "category" not in S.semantic_dedup(df, threshold=0.98).matches().columns


def test_blank_texts(spark):
    df = spark.createDataFrame(
        [(3, "words", [0.0, -1.0]), (4, "\t", None), (6, None, None), (9, "", None)],
        "row_index bigint, text string, embedding array<float>",
    )
    outcome = S.semantic_dedup(df)
    assert sorted(r.row_index for r in outcome.kept().collect()) == [3, 4]
    assert sorted((r.row_index, r.duplicate_of_row_index, r.similarity) for r in outcome.matches().collect()) == [(6, 4, 1.0), (9, 4, 1.0)]
    assert outcome.stats().first().unique_values == 2


def test_unlike_rows_all_stay(spark):
    angles = [0.0, 0.5, 1.0, 1.6, 2.4]
    rows = [(k, f"row {k}", [math.cos(a), math.sin(a)]) for k, a in enumerate(angles)]
    df = spark.createDataFrame(rows, "row_index bigint, text string, embedding array<float>")
    outcome = S.semantic_dedup(df, threshold=0.9)
    assert outcome.kept().count() == 5 and outcome.matches().count() == 0


@pytest.mark.parametrize("tile", [4096, 16])
def test_known_representatives_equal_one_run(spark, tile):
    matrix = clustered(9, 10, 12, 5, 0.35)
    keys = [f"t{i}" for i in range(120)]
    keys[5] = keys[80] = keys[100] = ""
    keys[90], matrix[90] = keys[2], matrix[2]
    kept, matches = sequential(keys, matrix, 0.8)
    df = table(spark, matrix, text=keys)
    early = S.semantic_dedup(df.filter("row_index < 70"), threshold=0.8, tile=tile)
    late = S.semantic_dedup(df.filter("row_index >= 70"), threshold=0.8, tile=tile, known=early.representatives())
    got = sorted(r.row_index for part in (early, late) for r in part.kept().collect())
    found = {r.row_index: (r.duplicate_of_row_index, r.similarity) for part in (early, late) for r in part.matches().collect()}
    assert got == kept
    same_matches(found, matches)
    assert late.stats().first().unique_values == len(kept)
    assert late.representatives().count() == len(kept)


def test_approximate_index_never_drops_too_much(spark):
    matrix = clustered(11, 10, 12, 6, 0.2)
    keys = [f"t{i}" for i in range(120)]
    outcome, kept, found = run(spark, keys, matrix, 0.9, index="hnsw")
    for row, (match, similarity) in found.items():
        assert similarity >= 0.9 and match < row and match in kept
    assert sorted([*kept, *found]) == list(range(120))


def test_encoder_and_parameters(spark):
    def factory():
        known = {"退款怎么申请": [1, 0], "怎么申请退款": [0.99, 0.01], "我要开发票": [0, 1]}
        return lambda texts: np.array([known[t] for t in texts])

    texts = ["退款怎么申请", " 怎么申请退款", "我要开发票", "", "退款怎么申请"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_index bigint, text string")
    outcome = S.semantic_dedup(df, encoder=factory)
    assert sorted(r.row_index for r in outcome.kept().collect()) == [0, 2, 3]
    assert S.semantic_dedup(df, encoder="char-ngrams").kept().count() == 4
    for bad in (0, 1.5):
        with pytest.raises(ValueError):
            S.semantic_dedup(df, threshold=bad)
    with pytest.raises(ValueError):
        S.semantic_dedup(df, index="ivf")


def test_empty(spark):
    df = spark.createDataFrame([], "row_index bigint, text string, embedding array<float>")
    outcome = S.semantic_dedup(df)
    assert outcome.kept().count() == 0 and outcome.matches().count() == 0
    assert outcome.stats().first().unique_values == 0


def test_blocks_end_where_they_should(spark):
    ids = [2**53 + 1 + 2 * k for k in range(50)] + [-(2**62), 5, 2**62] + list(range(1000, 1400))
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    ordered = sorted(ids)
    for block in (1, 2, 3, 40, 200, 453):
        for buckets in (2, 7, 4096):
            last, size = S.block_end(df, block, buckets)
            assert size == sum(i <= last for i in ordered) and block >= size >= block / 2


@pytest.mark.parametrize("first", [0, 2**53 + 1])
def test_many_small_blocks_on_unlike_rows(spark, monkeypatch, first):
    matrix = unit(np.random.default_rng(8).standard_normal((1500, 24)))
    rows = [(first + 2 * k, row.tolist()) for k, row in enumerate(matrix)]
    df = spark.createDataFrame(rows, "id bigint, vec array<double>")
    cuts = []
    real = S.cut_lineage
    monkeypatch.setattr(S, "cut_lineage", lambda table, name="table": cuts.append(name) or real(table, name))
    kept = S.greedy_representatives(df, 0.95, N.PivotCells(np.empty((0, 0))), 1500, first_block=2, max_block=4)
    assert kept.count() == 1500 and cuts.count("kept") <= 12


def test_tiles_follow_their_own_tables(spark):
    rng = np.random.default_rng(9)
    base = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(unit(rng.standard_normal((400, 4))))], "id bigint, vec array<double>")
    probe = base.limit(10)
    met = N.tile_join(
        base, probe, N.PivotCells(np.empty((0, 0))), 0.5, lambda b, p, c: [np.array([len(b["id"])]), np.array([len(p["id"])])],
        "left bigint, right bigint", (400, 10), 40,
    ).collect()
    assert len(met) <= 10 and sum(r.left for r in met) == 400 and {r.right for r in met} == {10}


def test_cells_share_groups(spark):
    """Many small cells: each pair meets once, in few groups, and a vector is copied for groups only."""
    matrix = unit(np.random.default_rng(11).standard_normal((1500, 16)))
    df = N.vector_table(table(spark, matrix), "embedding", "row_index")
    cells = N.PivotCells.choose(df, len(matrix), tile=16)
    assert len(cells.pivots) == 46
    met = N.tile_join(
        df, df, cells, math.acos(0.2), lambda b, p, c: [np.array([len(b["id"])]), np.array([len(p["id"])])], "left bigint, right bigint", len(matrix), 16
    ).collect()
    assert len(met) <= 200 and sum(r.left + r.right for r in met) <= 40 * len(matrix)
    pairs = N.tile_join(df, df, cells, math.acos(0.2), N.lower_pairs(0.2), "a bigint, b bigint, s double", len(matrix), 16)
    got = [(r.a, r.b) for r in pairs.collect()]
    left, right = np.nonzero(np.triu(matrix @ matrix.T >= 0.2, 1))
    assert len(got) == len(set(got)) and set(got) == set(zip(left.tolist(), right.tolist()))


def test_bands_are_used_where_they_pay(spark):
    df = N.vector_table(table(spark, unit(np.random.default_rng(12).standard_normal((40, 4)))), "embedding", "row_index")
    assert isinstance(N.cells_for_recall(df, 1 << 20, 0.9), N.SignBands)
    assert isinstance(N.cells_for_recall(df, 100_000, 0.4, 0.9999), N.PivotCells)


def test_approximate_pairs_come_once(spark):
    """Rows that come twice, compared in exact cells."""
    df = table(spark, unit(np.array([[1.0, 0.0], [0.9, 0.1], [0.0, 1.0]])))
    found = N.similar_pairs_approx(df.unionByName(df), "embedding", 0.9, recall=0.9999).filter("left_id < right_id")
    assert [(r.left_id, r.right_id) for r in found.collect()] == [(0, 1)]


def test_every_dropped_row_has_its_match(spark):
    matrix = unit(np.random.default_rng(10).standard_normal((50, 7)))
    known = spark.createDataFrame([(k, f"t{k}", None, v.tolist()) for k, v in enumerate(matrix)], "row_index bigint, key string, category string, vec array<double>")
    again = spark.createDataFrame([(100 + k, f"t{k}", v.astype("float32").tolist()) for k, v in enumerate(matrix)], "row_index bigint, text string, embedding array<float>")
    outcome = S.semantic_dedup(again, threshold=1.0, known=known)
    assert outcome.kept().count() == 0
    assert sorted((r.row_index, r.duplicate_of_row_index) for r in outcome.matches().collect()) == [(100 + k, k) for k in range(50)]
