"""Row positions, exact deduplication, cleaning followed by deduplication."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusprep.functions.text import dedup_key, short_digest
from corpusprep.operators import dedup as D
from corpusprep.operators.rows import cut_lineage, with_row_index
from corpusprep.plans.clean_dedup import clean_then_dedup


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "row_index bigint, text string")


def test_fixture(spark):
    df = texts(spark, [" Hello   World ", "hello world", "HELLO\tWORLD", "Another Value"])
    assert [r.row_index for r in D.exact_dedup(df).orderBy("row_index").collect()] == [0, 3]
    stats = D.exact_dedup_stats(df).first().asDict()
    assert stats == {
        "total_before": 4, "total_after": 2, "duplicate_rows": 2, "unique_values": 2,
        "target_column": "text", "dedupe_mode": "exact",
    }


def test_default_target_alias(spark):
    df = spark.createDataFrame([(" Foo ", 1), ("foo", 2), ("Bar", 3)], "`用户输入` string, n bigint")
    assert sorted(r.n for r in D.exact_dedup(df, order="n").collect()) == [1, 3]


def test_blank_is_one_key_and_hot_keys_are_kept_once(spark):
    rng = random.Random(1)
    values = [rng.choice([None, "", "  ", "hot", "HOT", "hot "] + [f"t{i}" for i in range(50)]) for _ in range(2000)]
    df = texts(spark, values).repartition(7)
    seen, expected = set(), []
    for i, value in enumerate(values):
        key = (value or "").strip().casefold()
        if key not in seen:
            seen.add(key)
            expected.append(i)
    assert sorted(r.row_index for r in D.exact_dedup(df).collect()) == expected
    assert D.exact_dedup_stats(df).first().unique_values == len(seen)


def test_known_keys_carry_over(spark):
    early, late = texts(spark, ["a", "B", ""]), texts(spark, ["b ", "c", None, "C", "a"])
    known = D.known_digests(early)
    assert [r.text for r in D.exact_dedup(late, known_keys=known).collect()] == ["c"]
    stats = D.exact_dedup_stats(late, known_keys=known).first()
    assert (stats.total_before, stats.total_after, stats.duplicate_rows, stats.unique_values) == (5, 1, 4, 4)


def test_empty(spark):
    df = texts(spark, [])
    assert D.exact_dedup(df).count() == 0
    assert list(D.exact_dedup_stats(df).first())[:4] == [0, 0, 0, 0]


def test_row_index_is_dense_and_ordered(spark):
    rng = random.Random(2)
    values = rng.sample(range(10**6), 5000)
    df = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(9)
    got = {r.v: r.row_index for r in with_row_index(df, "v").collect()}
    assert got == {v: i for i, v in enumerate(sorted(values))}
    down = {r.v: r.position for r in with_row_index(df, F.desc("v"), name="position").collect()}
    assert down == {v: i for i, v in enumerate(sorted(values, reverse=True))}
    with pytest.raises(ValueError):
        with_row_index(df)


def test_cut_lineage_keeps_rows_and_schema(spark):
    df = spark.range(10).select("id", F.array(F.lit(1.5)).alias("a"))
    copy = cut_lineage(df)
    assert copy.dtypes == df.dtypes and copy.count() == 10


def test_clean_then_exact(spark):
    df = texts(spark, ["!!!", "A b", "a  B", "", "c"])
    result = clean_then_dedup(df)
    assert sorted((r.row_index, r.text) for r in result.kept.collect()) == [(0, "A b"), (2, "c")]
    assert result.cleaning_stats.first().total_removed == 2
    assert result.dedup_stats.first().duplicate_rows == 1


def test_clean_then_semantic(spark):
    df = spark.createDataFrame(
        [(0, "!!!", "x", None), (1, "退款怎么申请", "售后", [1.0, 0.0]), (2, "怎么申请退款", "售后", [0.99, 0.01])],
        "row_index bigint, text string, category string, embedding array<float>",
    )
    result = clean_then_dedup(df, mode="semantic")
    assert [r.text for r in result.kept.collect()] == ["退款怎么申请"]
    (match,) = result.semantic.matches().collect()
    assert (match.row_index, match.duplicate_of_row_index, match.same_category) == (1, 0, True)
    assert result.cleaning_stats.first().removed_symbol_rows == 1
    with pytest.raises(ValueError):
        clean_then_dedup(df, mode="fuzzy")


def test_numbered_rows_are_reduced_before_they_move(spark):
    rng = random.Random(3)
    values = [rng.choice([None, "", " ", "ß", "SS", "long " * 20, *(f"T{i % 40}" for i in range(60))]) for _ in range(4000)]
    df = with_row_index(texts(spark, values).withColumnRenamed("row_index", "n"), "n").repartition(3)
    want = sorted(map(tuple, D.exact_dedup(df).collect()))
    assert sorted(map(tuple, D.exact_dedup(df, numbered=True).collect())) == want
    known = D.known_digests(texts(spark, ["t1", "long " * 20]))
    left = sorted(map(tuple, D.exact_dedup(df, known_keys=known, numbered=True).collect()))
    assert left == sorted(map(tuple, D.exact_dedup(df, known_keys=known).collect())) and len(left) == len(want) - 2
    # A row per key and task: each row is shuffled to its number otherwise.
    batch = pa.RecordBatch.from_pydict({"__one": [5, 5, 7, 6], "__two": [1, 1, 1, 2], "__row": [3, 2, 4, 9]})
    later = pa.RecordBatch.from_pydict({"__one": [5, 7, 5], "__two": [1, 1, 1], "__row": [8, 1, 1]})
    early, late = (b.column("__row").to_pylist() for b in D._first_of_task(iter([batch, later])))
    assert early == [2, 4, 9] and late == [1, 1]


def test_positions_are_not_written(spark, monkeypatch):
    from corpusprep.operators import rows as R

    written = []
    monkeypatch.setattr(R, "cut_lineage", lambda df, name="table": written.append(df.columns) or cut_lineage(df, name))
    got = R.with_row_index(texts(spark, list("abc")).withColumnRenamed("row_index", "n"), F.desc("n"))
    assert sorted((r.n, r.row_index) for r in got.collect()) == [(0, 2), (1, 1), (2, 0)]
    assert written == [["n", "text", "__part"]]


def test_stats_move_short_keys_and_no_texts(spark):
    df = texts(spark, ["a", "A", "b" * 31, "b" * 32, "B" * 32, "é" * 20, "", None])
    assert list(D.exact_dedup_stats(df).first())[:4] == [8, 5, 3, 5]
    assert sorted(r.n for r in df.select(F.octet_length(short_digest(dedup_key(F.col("text")))).alias("n")).collect()) == [0, 0, 1, 1, 31, 32, 32, 32]


def test_counts_move_no_rows(spark, monkeypatch):
    """Counts of clean and repeated rows: equal short texts are counted before keys are made, rows are not numbered."""
    from corpusprep.plans import clean_dedup as P

    numbered, written = [], []
    monkeypatch.setattr(P, "with_row_index", lambda df, *order, **names: numbered.append(1) or with_row_index(df, *order, **names))
    monkeypatch.setattr(P, "cut_lineage", lambda df, name="table": written.append(cut_lineage(df, name)) or written[-1])
    values = ["a", "A", " a ", "!", None, "", "b" * 40, "B" * 40, "ß" * 16 + "aa", "s" * 32 + "AA", "x  y", "X Y"] * 30
    result = P.clean_then_dedup(texts(spark, values).repartition(5))
    cleaning, counts = result.cleaning_stats.first(), result.dedup_stats.first()
    assert not numbered and [table.count() for table in written] == [9]
    assert list(cleaning) == [360, 270, 60, 30, 0, 0, 90]
    assert list(counts) == [270, 4, 266, 4, "text", "exact"]
    assert [r.row_index for r in result.kept.orderBy("row_index").collect()] == [0, 3, 5, 7]
    assert result.cleaned.count() == 270 and len(numbered) == 1


def test_counts_of_nothing(spark):
    result = clean_then_dedup(texts(spark, []))
    assert list(result.cleaning_stats.first()) == [0] * 7
    assert list(result.dedup_stats.first())[:4] == [0, 0, 0, 0]
