"""Streams give what the batch operators give."""

import pytest

from corpusprep.operators.cleaning import cleaning_stats
from corpusprep.operators import stored
from corpusprep.sources.tables import CsvStream, read_csv, stream_table
from corpusprep.streaming import streams
from test_semantic import clustered, sequential, table


def parts(spark, df, folder, cuts):
    for low, high in zip(cuts, cuts[1:], strict=False):
        df.filter(f"row_index >= {low} AND row_index < {high}").coalesce(1).write.mode("append").parquet(folder)
    return stream_table(spark, folder, df.schema, "parquet")


def drain(stream, tmp_path, mode="append"):
    query = (
        stream.writeStream.format("memory").queryName("drained").outputMode(mode)
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.table("drained").collect()


TEXTS = ["A b", "!!!", "a  B", "", "c", "😂", "C ", "d", None, "a b"]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "row_index bigint, text string")


def test_clean(spark, rows, tmp_path):
    stream = parts(spark, rows, str(tmp_path / "in"), [0, 4, 10])
    assert sorted(r.row_index for r in drain(streams.clean_stream(stream), tmp_path)) == [0, 2, 4, 6, 7, 9]


def test_counts(spark, rows, tmp_path):
    stream = parts(spark, rows, str(tmp_path / "in"), [0, 4, 10])
    (counts,) = drain(streams.cleaning_stats_stream(stream), tmp_path, "complete")
    assert counts == cleaning_stats(rows).first()


def test_dedup(spark, rows, tmp_path):
    stream = parts(spark, rows, str(tmp_path / "in"), [0, 2, 4, 6, 10])
    kept = drain(streams.dedup_stream(stream), tmp_path)
    keys = sorted(" ".join((r.text or "").split()).casefold() for r in kept)
    assert keys == sorted(["a b", "!!!", "", "c", "😂", "d"])
    with pytest.raises(ValueError):
        streams.dedup_stream(stream, event_time="row_index")


def test_dedup_keeps_the_first_rows_and_survives_a_replay(spark, rows, tmp_path):
    stream = parts(spark, rows, str(tmp_path / "in"), [0, 2, 4, 6, 10])
    sink = streams.DedupStream(str(tmp_path / "out"))
    sink.start(stream, str(tmp_path / "cp")).awaitTermination()
    sink.process(rows.filter("row_index >= 6"), 3)  # the last batch once more
    assert sorted(r.row_index for r in sink.kept(spark).collect()) == [0, 1, 3, 4, 5, 7]
    with pytest.raises(ValueError):
        sink.process(rows, 0)
    with pytest.raises(ValueError):
        streams.DedupStream(str(tmp_path / "none")).kept(spark)


def test_csv_source(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("text\nx\nX\n", encoding="utf8")
    stream = stream_table(spark, str(tmp_path / "in"), "text string")
    assert len(drain(streams.dedup_stream(stream), tmp_path)) == 1


def test_csv_stream_keeps_blank_lines_and_splits_files(spark, tmp_path):
    """One file over many tasks, with quoted line breaks across the splits, equals the batch reader."""
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("a", "b"):
        cells = [f'"{name}{k}\n\nmore, ""and"" more {"x" * (k % 90)}",{k}' if k % 3 else "" if k % 2 else f"{name}{k},NA" for k in range(400)]
        (folder / f"{name}.csv").write_text("text,n\n" + "\n".join(cells) + "\n", encoding="utf8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        batches = {}

        def keep(rows, batch_id):
            batches[batch_id] = (rows.collect(), rows.rdd.getNumPartitions())

        CsvStream(spark, str(folder), "text string, n string").start(keep, str(tmp_path / "cp")).awaitTermination()
        want = read_csv(spark, str(folder / "*.csv")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = [row for rows, _ in batches.values() for row in rows]
    key = lambda r: (r.text or "", r.n or "")
    assert len(batches) == 2 and all(tasks > 4 for _, tasks in batches.values())
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr) and len(got) == 800
    assert sum(key(r) == ("", "") for r in got) == 2 * sum(k % 3 == 0 and k % 2 == 1 for k in range(400))


def test_exact_dedup_over_many_batches(spark, tmp_path):
    """Older batches of keys are merged; replays and results stay as they are."""
    rows = spark.createDataFrame([(k, f"t{k % 37}") for k in range(72)], "row_index bigint, text string")
    sink = streams.DedupStream(str(tmp_path / "out"), buckets=2)
    sink.keys.merge = lambda session, batch: stored.BucketTable.merge(sink.keys, session, batch, 3)
    for batch in range(6):
        sink.process(rows.filter(f"row_index >= {12 * batch} AND row_index < {12 * batch + 12}"), batch)
    sink.process(rows.filter("row_index >= 60"), 5)
    assert sorted(r.row_index for r in sink.kept(spark).collect()) == list(range(37))
    assert min(sink.keys.batches(spark)) < 0 and len(sink.keys.batches(spark)) <= 4


def test_semantic_stream_equals_the_sequential_pass_and_survives_a_replay(spark, tmp_path):
    matrix = clustered(41, 8, 10, 5, 0.35)
    keys = [f"t{i}" for i in range(80)]
    keys[3] = keys[50] = ""
    kept, matches = sequential(keys, matrix, 0.8)
    df = table(spark, matrix, text=keys)
    stream = parts(spark, df, str(tmp_path / "in"), [0, 30, 60, 80])
    sink = streams.SemanticDedupStream(str(tmp_path / "out"), threshold=0.8)
    sink.start(stream, str(tmp_path / "cp")).awaitTermination()
    sink.process(df.filter("row_index >= 60"), 2)  # the last batch once more
    assert sorted(r.row_index for r in sink.kept(spark).collect()) == kept
    found = {r.row_index: r.duplicate_of_row_index for r in sink.matches(spark).collect()}
    assert found == {row: match for row, (match, _) in matches.items()}
    assert sink.representatives(spark).count() == len(kept)
