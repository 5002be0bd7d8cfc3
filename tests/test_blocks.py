"""Trigram vectors against Spark's own, packed blocks against brute force."""

import numpy as np
import pytest
from pyspark.ml.feature import IDF, HashingTF, NGram, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from corpusprep.operators import blocks as B
from corpusprep.operators import cluster_tables as T
from corpusprep.operators import density as D
from corpusprep.operators import encoding as E
from corpusprep.operators import neighbors as N
from corpusprep.operators import rows as R
from corpusprep.operators import semantic as S
from corpusprep.plans import cluster_texts as P
from corpusprep.plans.cluster_texts import cluster_texts

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau ypsilon phi chi psi omega".split()


def texts(seed, groups, per, length=12):
    """Groups of texts that differ in a word or two, mixed."""
    rng = np.random.default_rng(seed)
    found = []
    for _ in range(groups):
        base = list(rng.choice(WORDS, length))
        for _ in range(per):
            own = list(base)
            for k in rng.choice(length, rng.integers(0, 4)):
                own[k] = str(rng.choice(WORDS))
            found.append(" ".join(own))
    return [found[k] for k in rng.permutation(len(found))]


def frame(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "row_index bigint, text string").repartition(3)


def vectors(df):
    rows = sorted(E.encode(df, "text").select("row_index", "embedding").collect())
    return np.array([r.embedding for r in rows], dtype=np.float64)


def test_trigrams_are_those_of_spark(spark):
    """Also of more characters than the table of trigrams holds, and of counts over a byte and two."""
    wide = "".join(chr(0x4E00 + 7 * k) for k in range(400))
    rows = ["", "a", "ab", "Größe 退款怎么申请 😂", wide, wide[::-1], "x" * 300, "y" * 70000, *texts(1, 5, 4)]
    df = frame(spark, rows)
    chars = F.split(F.concat(F.lit(" "), F.col("text"), F.lit(" ")), "")
    table = HashingTF(numFeatures=1024, inputCol="g", outputCol="c").transform(NGram(n=3, inputCol="s", outputCol="g").transform(df.withColumn("s", chars)))
    table = Normalizer(p=2.0, inputCol="w", outputCol="u").transform(IDF(inputCol="c", outputCol="w").fit(table).transform(table))
    want = [r.v for r in table.select("row_index", vector_to_array("u", "float32").alias("v")).orderBy("row_index").collect()]
    assert np.abs(vectors(df) - np.array(want)).max() <= 6e-8


def sequential(matrix, threshold):
    unit = matrix / np.linalg.norm(matrix, axis=1)[:, None]
    kept = []
    for k in range(len(unit)):
        if not kept or (unit[kept] @ unit[k]).max() < threshold:
            kept.append(k)
    return kept


@pytest.mark.parametrize("size,first,most", [(8192, 1 << 17, 1 << 19), (7, 5, 20), (16, 64, 64)], ids=["one-block", "small-blocks", "rounds"])
def test_texts_are_kept_as_in_a_sequential_pass(spark, monkeypatch, size, first, most):
    monkeypatch.setattr(B, "BLOCK_ROWS", size)
    rows = texts(2, 30, 6)
    df = frame(spark, rows)
    order = {}
    for k, text in enumerate(rows):
        order.setdefault(text, k)
    firsts = sorted(order.values())
    matrix = vectors(df.filter(F.col("row_index").isin(firsts)))
    want = [firsts[k] for k in sequential(matrix, 0.8)]
    found = S.semantic_dedup(df, threshold=0.8, encoder="char-ngrams", first_block=first, max_block=most)
    assert 5 < len(want) < 150
    assert sorted(r.row_index for r in found.kept().collect()) == want


def test_wide_vectors_are_not_shuffled(spark, monkeypatch):
    """Texts are turned into counts once and compared where these lie: no tile of vectors is dealt out."""

    def none(*args, **options):
        raise AssertionError("vectors move")

    monkeypatch.setattr(S, "tile_join", none)
    rows = ["", "eins zwei drei", " ", "Eins  zwei drei", "vier fünf sechs sieben", "eins zwei drei!"]
    found = S.semantic_dedup(frame(spark, rows), threshold=0.3, encoder="char-ngrams")
    assert sorted(r.row_index for r in found.kept().collect()) == [0, 1, 4]
    assert found.stats().first().total_after == 3


def test_matches_of_texts(spark):
    rows = ["", "eins zwei drei", " ", "Eins  zwei drei", "vier fünf sechs sieben", "eins zwei drei!"]
    found = S.semantic_dedup(frame(spark, rows), threshold=0.3, encoder="char-ngrams")
    got = {r.row_index: (r.duplicate_of_row_index, r.similarity) for r in found.matches().collect()}
    assert {k: v[0] for k, v in got.items()} == {2: 0, 3: 1, 5: 1}
    assert got[3][1] == 1.0 and 0.3 <= got[5][1] < 1.0
    assert sorted(len(r.vec) for r in found.fresh.collect()) == [1024, 1024]


def test_nearest_of_packed_rows(spark, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_ROWS", 9)
    monkeypatch.setattr(B, "STRIP_VALUES", 40)
    df = frame(spark, texts(3, 10, 8))
    matrix = vectors(df)
    unit = matrix / np.linalg.norm(matrix, axis=1)[:, None]
    counted = E.trigram_counts(df.select(F.col("row_index").alias("id"), "text"), "text", "vec").drop("text")
    blocks = B.pack(counted, E.trigram_weights(counted, "vec"), 80)
    assert blocks.count > 5
    found = B.block_join(blocks, blocks, lambda: B.Nearest(4), B.Nearest.SCHEMA).collect()
    cosines = unit @ unit.T
    best = {}
    for q, m, s in found:
        assert abs(cosines[q, m] - s) < 1e-12
        best.setdefault(q, []).append(s)
    # Several tasks may answer for a row; the best of them are the nearest.
    for q, row in enumerate(cosines):
        assert np.allclose(sorted(best[q])[-4:], np.sort(row)[-4:], atol=1e-12)


def test_empty(spark):
    df = spark.createDataFrame([], "row_index bigint, text string")
    assert S.semantic_dedup(df, encoder="char-ngrams").kept().count() == 0
    assert N.margin(1024) < 1e-4


@pytest.mark.parametrize("listed,few,size", [(16, 64, 8192), (6, 2, 16)], ids=["one-block", "searches"])
def test_clusters_of_counts_are_those_of_vectors(spark, monkeypatch, listed, few, size):
    """The same clusters, facts and rows as by written vectors, though no tile of vectors is dealt out."""
    rows = [*texts(4, 6, 25, 20), "", *texts(4, 2, 5, 20)]
    df = frame(spark, rows)
    vectors_ = E.encode(df.filter("text <> ''"), "text")
    for name, value in {"LISTED": listed, "FEW": few}.items():
        monkeypatch.setattr(D, name, value)
    want = {r.row_index: r.cluster_id for r in D.hdbscan(vectors_, tile=32).collect()}
    monkeypatch.setattr(B, "BLOCK_ROWS", size)

    def none(*args, **options):
        raise AssertionError("vectors move")

    for module in (D, N):
        monkeypatch.setattr(module, "tile_join", none)
    found = cluster_texts(df)
    got = {r.row_index: r.cluster_id for r in found.rows.select("row_index", "cluster_id").collect()}
    assert len(set(want.values())) > 3 and got == want | {rows.index(""): -1}
    members = found.rows.collect()
    assert {r.row_index: r.text for r in members} == dict(enumerate(rows))
    made = {r.row_index: r.embedding for r in members}
    assert made.pop(rows.index("")) is None
    assert made == {r.row_index: r.embedding for r in vectors_.collect()}
    facts = {r.cluster_id: r.representative_text for r in found.facts.collect()}
    assert facts == {r.cluster_id: r.representative_text for r in T.cluster_representatives(found.rows).collect()}
    assert found.stats().first().total_before == len(rows)


def test_texts_and_vectors_are_not_written(spark, monkeypatch):
    """What clustering writes of a text are its counts."""
    kinds = []
    for module in (P, D, B, T):
        monkeypatch.setattr(module, "cut_lineage", lambda df, *a, _cut=R.cut_lineage, **b: kinds.extend((f.name, f.dataType.simpleString()) for f in df.schema) or _cut(df, *a, **b))
    cluster_texts(frame(spark, texts(5, 3, 8))).rows.select("row_index", "cluster_id").count()
    assert ("vec", "binary") in kinds
    assert not [k for k in kinds if k[0] == "text" or k[1].startswith("array<float")]


def test_a_missing_text_has_no_trigrams():
    """It is refused, as by ``NGram``, not taken for a word."""
    with pytest.raises(ValueError):
        E._Buckets(64).counts(["a", None])
    assert [len(c) for c in E._Buckets(64).counts(["a", "x" * 300])] == [64, 128]
