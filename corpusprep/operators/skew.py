"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1 << 20


def hot_join(
    rows: DataFrame,
    facts: DataFrame,
    key: str,
    row: str,
    sizes: DataFrame,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join many ``rows`` with few ``facts`` per key.

    ``sizes`` (key, n) says how many rows a key has. The rows of a key with more than
    ``hot_rows`` are spread over as many parts as it takes, by a hash of their ``row``
    number, and the facts of that key are repeated once per part. The list of such keys has
    at most (all rows / hot_rows) entries, which bounds the broadcast, and no task receives
    much more than ``hot_rows`` rows of one key.
    """
    hot = F.broadcast(
        sizes.filter(F.col("n") > hot_rows).select(key, F.ceil(F.col("n") / hot_rows).cast("int").alias("__parts"))
    )
    parts = F.coalesce("__parts", F.lit(1))
    spread = rows.join(hot, key, "left").withColumn("__salt", F.pmod(F.xxhash64(row), parts).cast("int"))
    repeated = facts.join(hot, key, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), parts - 1)))
    return spread.drop("__parts").join(repeated.drop("__parts"), [key, "__salt"], how).drop("__salt")
