"""Reading and writing."""

import csv
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from corpusprep.operators.cleaning import cleaning_stats
from corpusprep.operators.dedup import exact_dedup_stats
from corpusprep.operators.rows import with_file_order, with_row_index
from corpusprep.sources import tables as io


def test_csv_keeps_blank_lines(spark, tmp_path):
    folder = tmp_path / "in.csv"
    folder.mkdir()
    (folder / "a.csv").write_text('id,text\n1,"a ""b"", c"\n\n,2\n 007 ,NA\nid,text\n', encoding="utf8")
    (folder / "b.csv").write_text("id,text\n5,e\n", encoding="utf8")
    rows = sorted((tuple(r) for r in io.read_csv(spark, str(folder), na_values=()).collect()), key=str)
    expected = [("1", 'a "b", c'), (None, None), (None, "2"), (" 007 ", "NA"), ("id", "text"), ("5", "e")]
    assert rows == sorted(expected, key=str)
    table = io.read_csv(spark, str(folder))
    assert io.count_rows(table) == 6 and table.filter("text IS NULL").count() == 2
    assert io.read_csv(spark, str(folder), keep_blank_lines=False).count() == 5
    assert cleaning_stats(io.read_csv(spark, str(folder))).first().removed_blank_rows == 2


@pytest.mark.parametrize("split", [40, 300, 5000])
def test_csv_cells_with_line_breaks_in_any_split(spark, tmp_path, split):
    rng = random.Random(split)
    cells = ["a", 'say ""x"", y', "one\ntwo", "\n\n", 'q"in', "long " * 30 + "\n" + "line\n" * 20, "", "NA", 'end""', "  blanks  "]
    rows = [(str(k), rng.choice(cells), rng.choice(cells)) for k in range(300)]

    def cell(text):
        return '"' + text.replace('""', '"').replace('"', '""') + '"' if any(c in text for c in ',\n') or text[:1] == '"' else text

    lines = []
    for row in rows:
        lines.append(",".join(map(cell, row)))
        if rng.random() < 0.1:
            lines.append("")
    path = tmp_path / "x.csv"
    path.write_text("id,a,b\n" + "\n".join(lines) + "\n", encoding="utf8")
    with open(path, newline="", encoding="utf8") as file:
        want = [tuple(x or None for x in r) if r else (None, None, None) for r in csv.reader(file)][1:]
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        got = [tuple(r) for r in io.read_csv(spark, str(path), na_values=("",)).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got, key=str) == sorted(want, key=str)


def test_csv_stream_with_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([("1", "a\nb"), ("2", "NA"), ("3", "c")], "id string, text string")
    io.write_table(df.coalesce(1), str(tmp_path / "in.csv"))
    stream = io.stream_table(spark, str(tmp_path / "in.csv"), "id string, text string")
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True
    ).start().awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("1", "a\nb"), ("2", None), ("3", "c")]


def test_csv_in_several_splits_loses_only_headers(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("id,text\n" + "".join(f"{i},row {i}\n" for i in range(20000)), encoding="utf8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        table = io.read_csv(spark, str(path))
        assert sorted(int(r.id) for r in table.collect()) == list(range(20000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_chinese_header_multi_line_and_empty(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('用户问题,n\n"a\nb",1\n', encoding="utf8")
    (row,) = io.read_csv(spark, str(path)).collect()
    assert (row["用户问题"], row.n) == ("a\nb", "1")
    only_header = tmp_path / "h.csv"
    only_header.write_text("a,b\n", encoding="utf8")
    assert io.read_csv(spark, str(only_header)).count() == 0
    with pytest.raises(ValueError):
        io.read_table(spark, "x.xlsx")


def test_write_append_read(spark, tmp_path):
    df = spark.createDataFrame([("a, \"q\"", "1"), ("c", None)], "text string, n string")
    for kind in ("csv", "parquet"):
        path = str(tmp_path / f"out.{kind}")
        io.write_table(df, path)
        io.append_table(df, path)
        got = [tuple(r) for r in io.read_table(spark, path).collect()]
        assert sorted(got, key=str) == sorted(2 * [("a, \"q\"", "1"), ("c", None)], key=str)


def test_matches_are_written_only_if_there_are_any(spark, tmp_path):
    path = str(tmp_path / "matches.csv")
    matches = spark.createDataFrame([(1, 0, 0.95)], "row_index bigint, duplicate_of_row_index bigint, similarity double")
    assert io.write_matches(matches.limit(0), path) is False and not os.path.exists(path)
    assert io.write_matches(matches, path) is True
    io.write_matches(matches, path, append=True)
    assert io.read_csv(spark, path).count() == 2


def test_file_order(spark, tmp_path):
    path = tmp_path / "lines.parquet"
    spark.range(100, 200).coalesce(1).write.parquet(str(path))
    df = with_file_order(spark.read.parquet(str(path)))
    got = with_row_index(df, "file_path", "file_start", "file_row").orderBy("row_index")
    assert [r.id for r in got.collect()] == list(range(100, 200))


def test_run_metadata(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("A",), ("",)], "text string")
    record = io.run_metadata(
        spark, "clean-deduplicate", "in.csv", "out.csv", {"target_column": "text", "threshold": 0.9, "model": None},
        cleaning_stats=cleaning_stats(df), deduplication_stats=exact_dedup_stats(df), side_files={"match_file": "m.csv"},
    )
    path = tmp_path / "meta"
    io.write_run_metadata(record, str(path))
    (part,) = path.glob("part-*.json")
    document = json.loads(part.read_text(encoding="utf8"))
    assert document["parameters"] == {"target_column": "text", "threshold": 0.9}
    assert document["cleaning_stats"]["removed_blank_rows"] == 1
    assert document["deduplication_stats"]["unique_values"] == 2
    assert document["match_file"] == "m.csv" and document["generated_at"]
    assert "clustering_stats" not in document




def test_intermediate_tables_go_when_the_block_ends(spark):
    from corpusprep.operators.rows import cut_lineage, intermediate_tables, shared_folder

    with intermediate_tables(spark):
        table = cut_lineage(spark.range(5), "gone")
        assert table.count() == 5
        (folder,) = [f for f in os.listdir(f"{shared_folder(spark)}/corpusprep") if f.startswith("gone-")]
    assert not os.path.exists(f"{shared_folder(spark)}/corpusprep/{folder}")
