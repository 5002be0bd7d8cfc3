"""Tables in buckets and the index of representatives."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.operators import stored
from corpusprep.operators.semantic import semantic_dedup
from corpusprep.streaming import streams
from test_semantic import clustered, table
from test_streaming import parts


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def above(plan, name):
    """Operators on the way from the scan of a table up to the first join or co-group."""
    lines = plan.split("\n")
    at = next(k for k, line in enumerate(lines) if name in line)
    depth, found = len(lines[at]) - len(lines[at].lstrip(" :+-*")), []
    for line in reversed(lines[:at]):
        own = len(line) - len(line.lstrip(" :+-*"))
        if own < depth:
            depth = own
            found.append(line.strip(" :+-*"))
            if "Join" in line or "CoGroup" in line:
                return found
    raise AssertionError(f"no join above {name} in\n{plan}")


def test_buckets_replays_and_merges(spark, tmp_path):
    held = stored.BucketTable(str(tmp_path / "t"), "k BIGINT, v STRING", "k", 4)
    assert held.before(spark, 0).count() == 0
    for batch in range(6):
        held.write(spark.range(batch * 10, batch * 10 + 10).select(F.col("id").alias("k"), F.lit(f"b{batch}").alias("v")), batch)
    held.write(spark.range(50, 53).select(F.col("id").alias("k"), F.lit("again").alias("v")), 5)
    assert sorted((r.k, r.v) for r in held.before(spark, 6).collect()) == [(k, f"b{k // 10}") for k in range(50)] + [(k, "again") for k in range(50, 53)]
    assert held.before(spark, 5).count() == 50
    with pytest.raises(ValueError):
        held.before(spark, 4)
    held.merge(spark, 5, every=3)
    assert held.batches(spark) == [-6, 4, 5] and held.before(spark, 6).count() == 53
    held.merge(spark, 5, every=3)
    assert held.batches(spark) == [-6, 4, 5]
    # Another session object, or a table that the session has forgotten, reads the same files.
    spark.sql(f"DROP TABLE {held.name}")
    assert held.before(spark, 6).filter("k = 7").first().v == "b0"


def test_stored_side_is_not_shuffled(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held = stored.BucketTable(str(tmp_path / "t"), "k BIGINT", "k", 4)
        for batch in range(3):
            held.write(spark.range(batch * 100, batch * 100 + 100).select(F.col("id").alias("k")), batch)
        new = spark.range(250, 400).select(F.col("id").alias("k"))
        joined = new.join(held.before(spark, 3), "k", "left_anti")
        assert joined.count() == 100
        assert not any("Exchange" in line for line in above(plan_of(joined), held.name))
        index = stored.RepresentativeIndex(str(tmp_path / "index"), 0.8, 0.99, 200, 4)
        matrix = np.random.default_rng(1).standard_normal((200, 8))
        rows = table(spark, matrix).select("row_index", F.concat(F.lit("t"), "row_index").alias("key"), F.lit(None).cast("string").alias("category"), F.col("embedding").alias("vec"))
        index.add(rows.filter("row_index < 100"), 0)
        index.add(rows.filter("row_index >= 100"), 1)
        found = index.similar_ids(rows.select(F.col("row_index").alias("id"), "vec"), 2)
        assert sorted(r.id for r in found.collect()) == list(range(200))
        assert not any("Exchange" in line for line in above(plan_of(found), index.bands.name))
        # A small batch's cells are a condition of the scan, whose files are sorted by cell.
        one = index.bands.touched(index.bands.before(spark, 2), spark.createDataFrame([(5,)], "cell bigint"))
        assert "EqualTo(cell,5)" in plan_of(one)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("tile", [4096, 10])
def test_similar_ids_equal_all_pairs(spark, tmp_path, tile):
    matrix = np.random.default_rng(9).standard_normal((72, 4))
    index = stored.RepresentativeIndex(str(tmp_path / "index"), 0.8, 0.99999, 40, 3, tile=tile)
    rows = table(spark, matrix).select("row_index", F.concat(F.lit("t"), "row_index").alias("key"), F.lit(None).cast("string").alias("category"), F.col("embedding").alias("vec"))
    half = len(matrix) // 2
    index.add(rows.filter(f"row_index < {half}"), 0)
    probe = rows.filter(f"row_index >= {half}").select(F.col("row_index").alias("id"), "vec")
    unit = matrix / np.linalg.norm(matrix, axis=1)[:, None]
    near = (unit[:half] @ unit[half:].T >= 0.8).any(axis=1)
    assert 0 < near.sum() < half
    assert sorted(r.id for r in index.similar_ids(probe, 1).collect()) == np.flatnonzero(near).tolist()


def test_indexed_stream_equals_one_run(spark, tmp_path):
    matrix = clustered(42, 8, 10, 5, 0.35)
    keys = [f"t{i}" for i in range(80)]
    keys[3] = keys[50] = ""
    keys[70] = "T1 "
    df = table(spark, matrix, text=keys).withColumn("category", F.col("row_index").cast("string"))
    want = semantic_dedup(df, threshold=0.8)
    stream = parts(spark, df, str(tmp_path / "in"), [0, 30, 60, 80])
    sink = streams.IndexedSemanticStream(str(tmp_path / "out"), threshold=0.8, recall=0.99999, rows=80, buckets=2)
    sink.start(stream, str(tmp_path / "cp")).awaitTermination()
    sink.process(df.filter("row_index >= 60"), 2)  # the last batch once more
    assert sorted(r.row_index for r in sink.kept(spark).collect()) == sorted(r.row_index for r in want.kept().collect())
    columns = ["row_index", "duplicate_of_row_index", "text", "matched_text", "category", "matched_category"]
    assert sorted(map(tuple, sink.matches(spark).select(*columns).collect())) == sorted(map(tuple, want.matches().select(*columns).collect()))
    assert sink.representatives(spark).count() == want.kept().count()


def test_shards_where_bands_do_not_pay(spark, tmp_path):
    """At a recall near 1 and a low threshold a vector lies in the index once, and nothing is missed."""
    matrix = np.random.default_rng(4).standard_normal((60, 12))
    index = stored.RepresentativeIndex(str(tmp_path / "index"), 0.4, 1 - 1e-9, 100_000, 3)
    rows = table(spark, matrix).select("row_index", F.concat(F.lit("t"), "row_index").alias("key"), F.lit(None).cast("string").alias("category"), F.col("embedding").alias("vec"))
    index.add(rows.filter("row_index < 30"), 0)
    held = index.bands.before(spark, 1)
    assert held.count() == 30 and held.select("cell").distinct().count() == 3
    probe = rows.filter("row_index >= 30").select(F.col("row_index").alias("id"), "vec")
    unit = matrix / np.linalg.norm(matrix, axis=1)[:, None]
    near = (unit[:30] @ unit[30:].T >= 0.4).any(axis=1)
    assert 0 < near.sum() < 30
    assert sorted(r.id for r in index.similar_ids(probe, 1).collect()) == np.flatnonzero(near).tolist()
