from corpusprep.operators.skew import hot_join


def test_hot_keys_are_spread_and_nothing_is_lost(spark):
    rows = spark.range(1000).selectExpr("id AS row", "CASE WHEN id % 3 = 0 THEN -1 ELSE id % 50 END AS key")
    facts = spark.range(-1, 40).selectExpr("id AS key", "id * 2 AS fact")
    sizes = rows.groupBy("key").count().withColumnRenamed("count", "n")
    for how in ("inner", "left"):
        want = sorted(map(tuple, rows.join(facts, "key", how).select("row", "fact").collect()))
        got = sorted(map(tuple, hot_join(rows, facts, "key", "row", sizes, how, hot_rows=10).select("row", "fact").collect()))
        assert got == want
