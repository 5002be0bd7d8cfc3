"""Dropping rows without usable text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpusprep.functions.text import removal_reason
from corpusprep.operators.rows import target_value

REASONS = ("blank", "symbol", "emoji", "garbled")


def with_removal_reason(df: DataFrame, target: str = "text", name: str = "removal_reason") -> DataFrame:
    """Add why each row should be removed; null for rows worth keeping."""
    return df.withColumn(name, removal_reason(target_value(df, target)))


def clean(df: DataFrame, target: str = "text") -> DataFrame:
    """Keep the rows with usable text. Works on batch and streaming tables alike."""
    return df.filter(removal_reason(target_value(df, target)).isNull())


def removed_rows(df: DataFrame, target: str = "text") -> DataFrame:
    """The rows that ``clean`` drops, with the reason."""
    return with_removal_reason(df, target).filter(F.col("removal_reason").isNotNull())


def counters(reason: Column, rows: Column | None = None) -> list[Column]:
    """The counts over a column of reasons, as aggregates; ``rows`` says how many rows one stands for."""

    def count(which: Column) -> Column:
        return F.count_if(which) if rows is None else F.coalesce(F.sum(F.when(which, rows)), F.lit(0))

    kept = count(reason.isNull())
    total = count(F.lit(True))
    return [
        total.alias("total_before"),
        kept.alias("total_after"),
        *(count(F.coalesce(reason == why, F.lit(False))).alias(f"removed_{why}_rows") for why in REASONS),
        (total - kept).alias("total_removed"),
    ]


def cleaning_stats(df: DataFrame, target: str = "text") -> DataFrame:
    """One row of counts: before, after, removed by reason, removed."""
    return df.agg(*counters(removal_reason(target_value(df, target))))


def clean_observed(df: DataFrame, target: str = "text") -> tuple[DataFrame, Observation]:
    """Cleaned rows plus an ``Observation`` that holds the counts after the first action.

    One pass over the data gives both. ``observation.get`` waits for that action.
    """
    observation = Observation()
    cleaned = (
        with_removal_reason(df, target, "__reason")
        .observe(observation, *counters(F.col("__reason")))
        .filter(F.col("__reason").isNull())
        .drop("__reason")
    )
    return cleaned, observation


def merge_stats(stats: DataFrame) -> DataFrame:
    """Add up the one-row counts of several runs."""
    return stats.agg(*(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in stats.columns))
