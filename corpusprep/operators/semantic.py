"""Semantic deduplication: first come, first kept, decided in parallel.

The definition is sequential: walk the rows in order; a row is a duplicate when its best
similarity with a representative kept so far reaches the threshold, else it becomes one.
Equivalently, a row is kept exactly when no similar row before it is kept. That needs no
walk: a row without a similar *undecided* row before it can be decided at once.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.functions.text import dedup_key, key_digest
from corpusprep.operators.blocks import pack, packed_representatives
from corpusprep.operators.encoding import encode, trigram_counts, trigram_weights
from corpusprep.operators.neighbors import (
    TILE_ROWS,
    PivotCells,
    Reducer,
    SignBands,
    best_lower,
    cells_for_recall,
    check_threshold,
    has_lower,
    improving,
    tile_join,
)
from corpusprep.operators.rows import column, cut_lineage, resolve_target_column, small_batches, target_value
from corpusprep.operators.skew import hot_join

FIRST_BLOCK = 1 << 17
MAX_BLOCK = 1 << 19
#: Ranges of ids that are counted at a time to find where a block ends.
BUCKETS = 4096


def greedy_representatives(
    units: DataFrame,
    threshold: float,
    cells: PivotCells | SignBands,
    rows: int,
    tile: int = TILE_ROWS,
    first_block: int = FIRST_BLOCK,
    max_block: int = MAX_BLOCK,
) -> DataFrame:
    """Ids and vectors of the rows a sequential pass over ``units`` (id, vec) would keep.

    Each round takes the undecided rows of lowest id (a block), finds those without a similar
    row before them in the block - they are kept - and drops every undecided row similar to
    a newly kept one. Blocks double: once a first part of the rows is decided, few similar
    pairs are left among the rest. A huge group of near-copies is therefore never compared
    with itself; its first member removes it. Past ``max_block`` rows a block grows only
    while most of it is kept, when the comparisons are needed anyway.

    Every join returns at most one record per row and tile, never the pairs. The lowest
    undecided row is always decided, so the loop ends; there is no cap on the rounds.
    """
    return greedy_homes(units, threshold, cells, rows, tile, first_block, max_block, has_lower)[0]


def greedy_homes(
    units: DataFrame,
    threshold: float,
    cells: PivotCells | SignBands,
    rows: int,
    tile: int = TILE_ROWS,
    first_block: int = FIRST_BLOCK,
    max_block: int = MAX_BLOCK,
    removing: Callable[[float], Reducer] = best_lower,
) -> tuple[DataFrame, DataFrame]:
    """The representatives, and of each other row one that removed it: ``id, class_id, cosine``.

    With several tiles a row may have several records, the most similar one of each. With
    ``has_lower`` for ``removing`` the second table has only ids.
    """
    radius = math.acos(threshold)
    ids = "id bigint"
    homes = ids if removing is has_lower else "id bigint, class_id bigint, cosine double"
    kept: list[DataFrame] = []
    gone: list[DataFrame] = []
    undecided, block = units, first_block
    while rows:
        head, head_rows = undecided, rows
        if rows > block:
            last, head_rows = block_end(undecided, block)
            head = undecided.filter(F.col("id") <= F.lit(last))
        beaten = tile_join(head, head, cells, radius, has_lower(threshold), ids, head_rows, tile)
        fresh = cut_lineage(head.join(beaten, "id", "left_anti"), "kept")
        fresh_rows = fresh.count()
        if not fresh_rows:
            raise RuntimeError("a round decided no row: ids must be unique and not null")
        kept.append(fresh)
        if fresh_rows == rows:
            break
        removed = tile_join(fresh, undecided, cells, radius, removing(threshold), homes, (fresh_rows, rows), tile)
        if removing is not has_lower:
            removed = cut_lineage(removed, "removed")
        gone.append(removed)
        decided = removed.select("id").unionByName(fresh.select("id"))
        undecided = cut_lineage(undecided.join(decided, "id", "left_anti"), "undecided")
        rows = undecided.count()
        if block < max_block or 2 * fresh_rows >= head_rows:
            block *= 2
    nothing = units.sparkSession.createDataFrame([], homes)
    return reduce(DataFrame.unionByName, kept, units.limit(0)), reduce(DataFrame.unionByName, gone, nothing)


def block_end(undecided: DataFrame, block: int, buckets: int = BUCKETS) -> tuple[int, int]:
    """The last id of a block of the lowest rows, and the exact size of the block.

    The block has at most ``block`` rows and at least half as many. Ids are counted in equal
    ranges; while the block would end inside a range, that range is counted again, finer. All
    numbers are integers, and at most ``buckets`` counts reach the driver at a time.
    """
    low, high = undecided.agg(F.min("id"), F.max("id")).first()
    size, last = 0, low - 1
    while True:
        width = -(-(high - low + 1) // buckets)
        place = ((F.col("id").cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)"))
        counts = (
            undecided.filter(F.col("id").between(low, high))
            .groupBy(F.floor(place).cast("bigint").alias("range")).agg(F.count(F.lit(1)).alias("n")).collect()
        )
        for part, n in sorted((r["range"], r["n"]) for r in counts):
            if size + n > block:
                break
            size, last = size + n, min(high, low + (part + 1) * width - 1)
        else:
            return last, size
        if 2 * size >= block or width == 1:
            return last, size
        low, high = low + part * width, min(high, low + (part + 1) * width - 1)


@dataclass
class SemanticDedup:
    """The outcome of ``semantic_dedup``; every member is a lazy table."""

    source: DataFrame
    target: str
    order: str
    category: str | None
    threshold: float
    model: str | None
    rows: DataFrame  # row, blank, digest of the input
    units: DataFrame  # digest, id, copies, vec of the distinct non-blank keys
    fresh: DataFrame  # id, vec of the representatives found in this input
    fresh_ids: DataFrame  # id of these
    known: DataFrame | None  # row_index, key, category, vec of earlier representatives
    cells: PivotCells | SignBands
    unit_rows: int
    tile: int

    def _first_blank(self) -> DataFrame:
        """At most one row: the first blank of this input, unless an earlier one is known."""
        blank = self.rows.filter("blank").agg(F.min("row").alias("id")).filter("id IS NOT NULL")
        if self.known is not None:
            seen = self.known.filter("key = ''").select(F.lit(1).alias("seen")).limit(1)
            blank = blank.withColumn("seen", F.lit(1)).join(seen, "seen", "left_anti").select("id")
        return blank

    def kept_ids(self) -> DataFrame:
        return self.fresh_ids.unionByName(self._first_blank())

    def kept(self) -> DataFrame:
        """The input rows that stay, all columns untouched."""
        return self.source.join(
            self.kept_ids(), column(self.order) == F.col("id"), "left_semi"
        )

    def representatives(self) -> DataFrame:
        """``row_index, key, category, vec`` of all representatives, earlier ones included.

        Pass it as ``known`` with the next batch of rows.
        """
        new = self.new_representatives()
        return new if self.known is None else self.known.unionByName(new)

    def new_representatives(self) -> DataFrame:
        """The representatives found in this input, first blank included."""
        return (
            self.kept_ids().join(self.fresh.select("id", "vec"), "id", "left")
            .join(self._facts(), "id")
            .select(F.col("id").alias("row_index"), "key", "category", "vec")
        )

    def _facts(self) -> DataFrame:
        """Key and category of every input row."""
        label = column(self.category) if self.category else F.lit(None).cast("string")
        return self.source.select(
            column(self.order).cast("bigint").alias("id"),
            dedup_key(target_value(self.source, self.target)).alias("key"),
            label.alias("category"),
        )

    def _links(self) -> DataFrame:
        """``id, match, similarity`` of every dropped row, with the best representative before it."""
        base = self.fresh
        probe = self.units.join(self.fresh.select("id"), "id", "left_anti").select("id", "digest", "vec")
        base_rows = self.unit_rows
        if self.known is not None:
            earlier = self.known.filter("key <> ''").select(F.col("row_index").alias("id"), "vec")
            base = base.unionByName(earlier)
            base_rows = base.count()
            # Keys that are known already match the row that has them, whatever the vectors say.
            same = self._same_keys()
            probe = probe.join(same.select("digest"), "digest", "left_anti")
        # A distinct key can be dropped at several row numbers. The representatives that raise
        # the best similarity, in row order, answer for all of them at once.
        steps = tile_join(
            base, probe.select("id", "vec"), self.cells, math.acos(self.threshold), improving(self.threshold),
            "id bigint, match bigint, similarity double", (base_rows, self.unit_rows), self.tile,
        )
        before = Window.partitionBy("id").orderBy("match").rowsBetween(Window.unboundedPreceding, -1)
        after = Window.partitionBy("id").orderBy("match")
        steps = (
            steps.withColumn("best", F.max("similarity").over(before))
            .filter(F.col("best").isNull() | (F.col("similarity") > F.col("best")))
            .withColumn("until", F.lead("match").over(after))
            .drop("best")
        )
        # The copies of a representative match the representative itself.
        own = self.fresh.select(
            "id",
            F.col("id").alias("match"),
            F.lit(1.0).alias("similarity"),
            F.lit(None).cast("bigint").alias("until"),
        )
        if self.known is not None:
            own = own.unionByName(
                same.select("id", "match", F.lit(1.0).alias("similarity"), F.lit(None).cast("bigint").alias("until"))
            )
        unit_steps = self.units.select("digest", "id").join(steps.unionByName(own), "id").drop("id")
        rows = self.rows.filter("NOT blank").select("row", "digest")
        sizes = self.units.select("digest", F.col("copies").alias("n"))
        return (
            hot_join(rows, unit_steps, "digest", "row", sizes)
            .filter(
                (F.col("match") < F.col("row"))
                & (F.col("until").isNull() | (F.col("until") >= F.col("row")))
            )
            .select(F.col("row").alias("id"), "match", "similarity")
            .unionByName(self._blank_links())
        )

    def _same_keys(self) -> DataFrame:
        """``digest, id, match``: distinct keys of this input that an earlier representative has."""
        seen = self.known.filter("key <> ''").groupBy(key_digest(F.col("key")).alias("digest")).agg(F.min("row_index").alias("match"))
        return self.units.select("digest", "id").join(seen, "digest")

    def _blank_links(self) -> DataFrame:
        blanks = self.rows.filter("blank").select(F.col("row").alias("id"))
        first = self._first_blank().select(F.col("id").alias("match"))
        if self.known is not None:
            first = first.unionByName(
                self.known.filter("key = ''").select(F.col("row_index").alias("match"))
            )
        # One row at most on the right-hand side.
        return (
            blanks.join(F.broadcast(first), F.col("match") < F.col("id"))
            .select("id", "match", F.lit(1.0).alias("similarity"))
        )

    def matches(self) -> DataFrame:
        """The audit table: each dropped row with the representative it repeats.

        ``row_index, duplicate_of_row_index, text, matched_text`` (normalised texts),
        ``<category>, matched_<category>, same_<category>`` when there is a category column,
        and ``similarity``. Missing categories are never the same.
        """
        facts = self._facts()
        holders = self.representatives().select(
            F.col("row_index").alias("match"),
            F.col("key").alias("matched_text"),
            F.col("category").alias("matched_category"),
        )
        table = (
            self._links().join(facts, "id").withColumnRenamed("key", "text").join(holders, "match")
        )
        columns = [
            F.col("id").alias("row_index"),
            F.col("match").alias("duplicate_of_row_index"),
            "text",
            "matched_text",
        ]
        if self.category:
            same = F.coalesce(F.col("category") == F.col("matched_category"), F.lit(False))
            columns += [
                F.col("category").alias(self.category),
                F.col("matched_category").alias(f"matched_{self.category}"),
                same.alias(f"same_{self.category}"),
            ]
        return table.select(*columns, "similarity")

    def stats(self) -> DataFrame:
        """One row of counts; earlier representatives count as unique values, as one run would."""
        after = self.kept_ids().agg(F.count(F.lit(1)).alias("total_after"))
        before = self.source.agg(F.count(F.lit(1)).alias("total_before"))
        earlier = F.lit(0).cast("bigint")
        table = before.withColumn("one", F.lit(1)).join(after.withColumn("one", F.lit(1)), "one").drop("one")
        if self.known is not None:
            known = self.known.agg(F.count(F.lit(1)).alias("known_rows")).withColumn("one", F.lit(1))
            table = table.withColumn("one", F.lit(1)).join(known, "one").drop("one")
            earlier = F.col("known_rows")
        return table.select(
            "total_before",
            "total_after",
            (F.col("total_before") - F.col("total_after")).alias("duplicate_rows"),
            (F.col("total_after") + earlier).alias("unique_values"),
            F.lit(resolve_target_column(self.source, self.target)).alias("target_column"),
            F.lit("semantic").alias("dedupe_mode"),
            F.lit(float(self.threshold)).alias("semantic_threshold"),
            F.lit(self.model).cast("string").alias("embedding_model"),
        )


def semantic_dedup(
    df: DataFrame,
    target: str = "text",
    vector: str = "embedding",
    threshold: float = 0.9,
    order: str = "row_index",
    category: str = "category",
    index: str = "flat",
    known: DataFrame | None = None,
    model: str | None = None,
    encoder=None,
    tile: int = TILE_ROWS,
    first_block: int = FIRST_BLOCK,
    max_block: int = MAX_BLOCK,
    cells: PivotCells | SignBands | None = None,
) -> SemanticDedup:
    """Drop rows whose meaning repeats an earlier row's. ``order`` is a unique bigint column.

    ``index`` is ``flat`` (exact) or ``hnsw`` (approximate: may keep a row that the exact
    search drops). With an ``encoder`` the distinct non-blank keys are encoded here, else the
    vectors are taken from the ``vector`` column. Equal keys are duplicates at any threshold;
    blank texts need no vector, the first one is kept. ``known`` holds earlier representatives
    (``SemanticDedup.representatives``), whose row numbers must be lower.
    """
    check_threshold(threshold)
    if index not in ("flat", "hnsw"):
        raise ValueError(f"unknown index kind: {index}")
    name = resolve_target_column(df, target)
    key = dedup_key(target_value(df, name))
    keyed = df.select(column(order).cast("bigint").alias("row"), key.alias("key"))
    rows = keyed.select("row", "key", key_digest(F.col("key")).alias("digest"), (F.col("key") == "").alias("blank"))
    packable = encoder == "char-ngrams" and known is None and index == "flat" and cells is None
    if packable:
        # One pass over the texts; what is left of them is short.
        with small_batches(df.sparkSession):
            rows = cut_lineage(trigram_counts(rows, "key", "vec").drop("key"), "trigram-counts")
    firsts = (
        rows.filter("NOT blank").groupBy("digest")
        .agg(F.min("row").alias("id"), F.count(F.lit(1)).alias("copies"))
    )
    if packable:
        units = firsts.join(rows.select(F.col("row").alias("id"), "vec"), "id")
    elif encoder is None:
        source = df.select(column(order).cast("bigint").alias("id"), column(vector).alias("vec"))
        units = firsts.join(source, "id")
    else:
        # A fixed number of partitions: the texts are small, the work on them is not, so they
        # must not be merged into a few tasks by size. The merge join keeps that partitioning.
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        source = df.select(column(order).cast("bigint").alias("id"), key.alias("key")).repartition(tasks, "id")
        units = encode(source.join(firsts.hint("merge"), "id"), "key", encoder, name="vec").drop("key")
    units = cut_lineage(units.select("digest", "id", "copies", "vec"), "units")
    unit_rows = units.count()
    if packable:
        weights = trigram_weights(units, "vec")
        blocks = pack(units.select("id", "vec"), weights, unit_rows, "unit-blocks", ordered=True)
        ids = cut_lineage(packed_representatives(blocks, threshold, first_block, max_block), "kept")
        vectors = weights.unfolded(units, "vec")
        fresh = weights.unfolded(units.select("id", "vec").join(ids, "id", "left_semi"), "vec")
        return SemanticDedup(
            df, name, order, category if category in df.columns else None, threshold, model,
            rows, vectors, fresh, ids, known, PivotCells(np.empty((0, 0))), unit_rows, tile,
        )
    earlier, earlier_rows = None, 0
    if known is not None:
        earlier = known.filter("key <> ''").select(F.col("row_index").alias("id"), "vec")
        earlier_rows = earlier.count()
    if cells is None and index == "hnsw":
        larger = earlier if earlier_rows > unit_rows else units
        cells = cells_for_recall(larger, max(unit_rows, earlier_rows), threshold, tile=tile)
    elif cells is None and earlier_rows > unit_rows:
        cells = PivotCells.choose(earlier, earlier_rows, tile)
    elif cells is None:
        cells = PivotCells.choose(units, unit_rows, tile)

    open_units = units.select("id", "vec")
    open_rows = unit_rows
    if known is not None:
        beaten = tile_join(
            earlier, open_units, cells, math.acos(threshold), has_lower(threshold), "id bigint", (earlier_rows, unit_rows), tile
        )
        same_key = (
            units.select("id", "digest")
            .join(known.filter("key <> ''").select(key_digest(F.col("key")).alias("digest")), "digest", "left_semi")
            .select("id")
        )
        open_units = cut_lineage(
            open_units.join(beaten.unionByName(same_key), "id", "left_anti"), "open"
        )
        open_rows = open_units.count()
    fresh = greedy_representatives(open_units, threshold, cells, open_rows, tile, first_block, max_block)
    return SemanticDedup(
        df, name, order, category if category in df.columns else None, threshold, model,
        rows, units, fresh, fresh.select("id"), known, cells, unit_rows, tile,
    )
