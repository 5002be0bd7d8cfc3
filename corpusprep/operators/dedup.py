"""Exact deduplication on normalised text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.functions.text import dedup_key, key_digest, raw_text, short_digest
from corpusprep.operators.rows import column, resolve_target_column, target_value

#: Keys that a task remembers (24 bytes each); others are passed on again.
TASK_KEYS = 1 << 20
#: Texts below this are no longer than the digest of their key.
SHORT_BYTES = 32


def first_rows(df: DataFrame, target: str = "text", order: str = "row_index") -> DataFrame:
    """One row per distinct key: ``digest, first_row, copies``.

    Partial aggregation leaves at most one 40-byte record per key and task, so a key that
    holds a third of all rows costs no more than any other.
    """
    keyed = df.select(
        key_digest(dedup_key(target_value(df, target))).alias("digest"), column(order).alias("row")
    )
    return keyed.groupBy("digest").agg(
        F.min("row").alias("first_row"), F.count(F.lit(1)).alias("copies")
    )


def exact_dedup(
    df: DataFrame,
    target: str = "text",
    order: str = "row_index",
    known_keys: DataFrame | None = None,
    numbered: bool = False,
) -> DataFrame:
    """Keep the first row of every key; ``order`` must be unique per row.

    ``known_keys`` (a table with a ``digest`` column, see ``known_digests``) holds keys that
    earlier data has already used: rows with such a key are dropped altogether.

    Only digests and row numbers are grouped. The rows themselves meet the kept row numbers
    in a semi join on a unique key, which stays even whatever the texts look like. Where
    ``order`` is known to come from ``with_row_index`` (``numbered``), each task first drops
    the rows that repeat a key of its own, and only the others are moved, once.
    """
    if numbered:
        return _numbered_dedup(df, target, order, known_keys)
    firsts = first_rows(df, target, order)
    if known_keys is not None:
        firsts = firsts.join(known_keys, "digest", "left_anti")
    kept = firsts.select(F.col("first_row").alias("__kept"))
    return df.join(kept, column(order) == F.col("__kept"), "left_semi")


def _numbered_dedup(df: DataFrame, target: str, order: str, known_keys: DataFrame | None) -> DataFrame:
    digest = short_digest if known_keys is None else key_digest
    keyed = (
        df.withColumn("__key", dedup_key(target_value(df, target)))
        .withColumn("__digest", digest(F.col("__key"))).drop("__key")
        .withColumns({"__one": F.xxhash64("__digest"), "__two": F.xxhash64(F.lit(1), "__digest"), "__row": column(order)})
    )
    few = keyed.mapInArrow(_first_of_task, keyed.schema).drop("__one", "__two")
    if known_keys is not None:
        few = few.join(known_keys.select(F.col("digest").alias("__digest")), "__digest", "left_anti")
    place = F.row_number().over(Window.partitionBy("__digest").orderBy("__row"))
    return few.withColumn("__place", place).filter("__place = 1").select(*(column(name) for name in df.columns))


def _first_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Without the rows whose key a lower row has that was passed on. Keys are 128 bits here."""
    one, two = np.zeros(TASK_KEYS, dtype=np.int64), np.zeros(TASK_KEYS, dtype=np.int64)
    least = np.full(TASK_KEYS, np.iinfo(np.int64).max)
    for batch in batches:
        a, b, row = (batch.column(name).to_numpy() for name in ("__one", "__two", "__row"))
        slot = a & (TASK_KEYS - 1)
        (left,) = np.nonzero((one[slot] != a) | (two[slot] != b) | (least[slot] >= row))
        left = left[np.lexsort((row[left], b[left], a[left]))]
        new = np.ones(len(left), dtype=bool)
        new[1:] = (a[left[1:]] != a[left[:-1]]) | (b[left[1:]] != b[left[:-1]])
        left = np.sort(left[new])
        # Of several keys with the same slot the last one stays, in all three.
        one[slot[left]], two[slot[left]], least[slot[left]] = a[left], b[left], row[left]
        yield batch.take(pa.array(left))


def known_digests(df: DataFrame, target: str = "text") -> DataFrame:
    """The distinct key digests of a table, to be carried over to later data."""
    return df.select(key_digest(dedup_key(target_value(df, target))).alias("digest")).distinct()


def counted_texts(df: DataFrame, target: str = "text", known_keys: DataFrame | None = None, *by: str) -> DataFrame:
    """``text, digest, rows``, and the columns ``by``: how often each text occurs.

    A short text stands as it is, one of ``SHORT_BYTES`` or more as the digest of its key, so
    that no long text is shuffled and only one row of each short one gets its key.
    """
    make = short_digest if known_keys is None else key_digest
    text, short = F.col("__text"), F.octet_length("__text") < SHORT_BYTES
    texts = df.select(*by, raw_text(target_value(df, target)).alias("__text")).select(
        *by, F.when(short, text).alias("text"), F.when(~short, make(dedup_key(text))).alias("digest")
    )
    return texts.groupBy("text", "digest", *by).agg(F.count(F.lit(1)).alias("rows"))


def exact_dedup_stats(
    df: DataFrame, target: str = "text", known_keys: DataFrame | None = None
) -> DataFrame:
    """One row of counts for ``exact_dedup`` on the same input.

    ``unique_values`` counts the known keys too, as one running set would.
    """
    return counted_stats(counted_texts(df, target, known_keys), resolve_target_column(df, target), known_keys)


def counted_stats(counted: DataFrame, name: str, known_keys: DataFrame | None = None) -> DataFrame:
    """``exact_dedup_stats`` of the rows that ``counted_texts`` counted in the column ``name``."""
    make = short_digest if known_keys is None else key_digest
    keyed = counted.select(F.coalesce("digest", make(dedup_key(F.col("text")))).alias("digest"), "rows")
    groups = keyed.groupBy("digest").agg(F.sum("rows").alias("rows"))
    groups = groups.withColumn("known", F.lit(False))
    extra = F.lit(0).cast("bigint")
    if known_keys is not None:
        known = known_keys.select("digest").distinct().withColumn("__known", F.lit(True))
        groups = (
            groups.drop("known")
            .join(known, "digest", "full_outer")
            .select(
                F.coalesce("rows", F.lit(0)).alias("rows"),
                F.coalesce("__known", F.lit(False)).alias("known"),
            )
        )
        extra = F.count_if("known")
    after = F.count_if(~F.col("known"))
    before = F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint")
    return groups.agg(
        before.alias("total_before"),
        after.alias("total_after"),
        (before - after).alias("duplicate_rows"),
        (after + extra).alias("unique_values"),
    ).withColumns(
        {"target_column": F.lit(name), "dedupe_mode": F.lit("exact")}
    )
