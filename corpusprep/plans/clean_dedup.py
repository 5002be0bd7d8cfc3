"""Cleaning followed by deduplication of the rows that are left."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.operators.cleaning import counters, with_removal_reason
from corpusprep.operators.dedup import counted_stats, counted_texts, exact_dedup
from corpusprep.operators.rows import cut_lineage, resolve_target_column, with_row_index
from corpusprep.operators.semantic import SemanticDedup, semantic_dedup


@dataclass
class CleanDedup:
    """``cleaned`` has the column ``row_index``, counted over the cleaned rows.

    Tables are made when they are first asked for, once. No count depends on the order of the
    rows: the counts come from one pass that counts equal texts, and rows are sorted and
    numbered for ``cleaned`` and ``kept``.
    """

    number: Callable[[], DataFrame]
    keep: Callable[[DataFrame], DataFrame]
    count: Callable[[], tuple[DataFrame, DataFrame]]
    semantic: SemanticDedup | None = None

    @cached_property
    def cleaned(self) -> DataFrame:
        return self.number()

    @cached_property
    def kept(self) -> DataFrame:
        return self.keep(self.cleaned)

    @cached_property
    def _counts(self) -> tuple[DataFrame, DataFrame]:
        return self.count()

    @property
    def cleaning_stats(self) -> DataFrame:
        return self._counts[0]

    @property
    def dedup_stats(self) -> DataFrame:
        return self._counts[1]


def clean_then_dedup(
    df: DataFrame, target: str = "text", order: str = "row_index", mode: str = "exact", **options
) -> CleanDedup:
    """Drop unusable rows, number the rest in ``order``, drop repeats.

    ``options`` go to ``semantic_dedup`` (mode ``semantic``) or ``exact_dedup``.
    """
    if mode not in ("exact", "semantic"):
        raise ValueError(f"unknown mode: {mode}")
    known = options.get("known_keys")
    reasons = with_removal_reason(df, target, "__reason")

    def usable(marked: DataFrame) -> DataFrame:
        rows = marked.filter(F.col("__reason").isNull()).drop("__reason")
        if order != "row_index":
            return with_row_index(rows, order)
        return with_row_index(rows.withColumnRenamed("row_index", "__order"), "__order").drop("__order")

    if mode == "exact":

        def count() -> tuple[DataFrame, DataFrame]:
            counted = cut_lineage(counted_texts(reasons, target, known, "__reason"), "counted")
            clean = counted.filter(F.col("__reason").isNull())
            return (
                counted.agg(*counters(F.col("__reason"), F.col("rows"))),
                counted_stats(clean, resolve_target_column(df, target), known),
            )

        return CleanDedup(
            lambda: usable(cut_lineage(reasons, "marked")),
            lambda cleaned: exact_dedup(cleaned, target, numbered=True, **options),
            count,
        )
    # One pass over the input marks every row; counts and clean rows come from the marks.
    marked = cut_lineage(reasons, "marked")
    cleaned = usable(marked)
    semantic = semantic_dedup(cleaned, target, order="row_index", **options)
    return CleanDedup(
        lambda: cleaned, lambda _: semantic.kept(), lambda: (marked.agg(*counters(F.col("__reason"))), semantic.stats()), semantic
    )
