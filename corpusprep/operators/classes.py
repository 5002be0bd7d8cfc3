"""Similar rows as classes: many near copies take a record each, not one for every pair.

A class is a representative and the rows within half the angle of the threshold, so that any
two of its rows are similar. Two classes are similar as a whole where the angle of their
representatives and their radii prove it; only rows of classes where that stays open are
compared, and their pairs listed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.vectors import inner_product
from corpusprep.operators.neighbors import (
    TILE_ROWS,
    PivotCells,
    Reducer,
    _angles,
    check_threshold,
    exact_values,
    repeated_vectors,
    similar_cells,
    single,
    tile_join,
    vector_table,
)
from corpusprep.operators.rows import cut_lineage
from corpusprep.operators.semantic import greedy_homes
from corpusprep.operators.skew import hot_join

#: Angles are known up to this.
MARGIN = 1e-7


@dataclass(frozen=True)
class _ClassPairs:
    """Cells for ``tile_join``: one for each pair of classes whose rows must be compared."""

    pairs: DataFrame  # left_class, right_class, cell
    sizes: DataFrame  # class_id, n
    single = False

    def place(self, base: DataFrame, probe: DataFrame, radius: float | str) -> tuple[DataFrame, DataFrame]:
        return self._side(base, "left_class"), self._side(probe, "right_class")

    def _side(self, rows: DataFrame, side: str) -> DataFrame:
        cells = self.pairs.select(F.col(side).alias("class_id"), "cell")
        return hot_join(rows, cells, "class_id", "id", self.sizes)


def _between_classes(threshold: float) -> Reducer:
    """Pairs of representatives whose classes are similar as a whole (1), or may be in part (0)."""
    full = math.acos(threshold)

    @single(lower=True)
    def reduce(base, probe, cosines, exact=None):
        # Angles are taken only where the widest classes could meet.
        widest = min(math.pi, full + base["radius"].max() + probe["radius"].max() + 2 * MARGIN)
        row, col = similar_cells(cosines, math.cos(widest) - 1e-12, exact)
        lower = base["id"][col] < probe["id"][row]
        row, col = row[lower], col[lower]
        cosines = exact_values(cosines, row, col, exact)
        radii = base["radius"][col] + probe["radius"][row]
        angles = _angles(cosines)
        alone = radii == 0
        whole = np.where(alone, cosines >= threshold, angles + radii <= full - MARGIN)
        met = whole | (~alone & (angles <= full + radii + MARGIN))
        return [base["id"][col[met]], probe["id"][row[met]], whole[met].astype(np.int64)]

    return reduce


def _crossing(threshold: float) -> Reducer:
    """All similar pairs of a base and a probe row, the lower id first."""

    @single()
    def reduce(base, probe, cosines, exact=None):
        row, col = similar_cells(cosines, threshold, exact)
        values = exact_values(cosines, row, col, exact)
        similar = values >= threshold
        one, two = base["id"][col[similar]], probe["id"][row[similar]]
        return [np.minimum(one, two), np.maximum(one, two), values[similar]]

    return reduce


@dataclass
class SimilarClasses:
    """The similar pairs of a table in a compressed form. Two rows are similar if

    * they are ``members`` of the same class, or
    * their classes are a row of ``class_pairs``, or
    * the first rows with their vectors are a row of ``row_pairs``.

    Each pair is in one of the three only.
    """

    members: DataFrame  # id, first (the first row with the same vector), class_id
    class_pairs: DataFrame  # left_class, right_class
    row_pairs: DataFrame  # left_id, right_id, similarity
    copies: DataFrame  # first, class_id, n

    def link_counts(self) -> DataFrame:
        """``id, n_links``: how many other rows each member is similar to, without listing them."""
        classes = self.copies.groupBy("class_id").agg(F.sum("n").alias("rows"))
        right = classes.select(F.col("class_id").alias("other"), F.col("rows").alias("beside"))
        ends = self.class_pairs.select(F.col("left_class").alias("class_id"), F.col("right_class").alias("other"))
        both = ends.unionByName(ends.select(F.col("other").alias("class_id"), F.col("class_id").alias("other")))
        beside = both.join(right, "other").groupBy("class_id").agg(F.sum("beside").alias("beside"))
        ends = self.row_pairs.select(F.col("left_id").alias("first"), F.col("right_id").alias("other"))
        both = ends.unionByName(ends.select(F.col("other").alias("first"), F.col("first").alias("other")))
        copies = self.copies.select(F.col("first").alias("other"), F.col("n").alias("single"))
        singles = both.join(copies, "other").groupBy("first").agg(F.sum("single").alias("single"))
        counted = (
            self.copies.join(classes, "class_id").join(beside, "class_id", "left").join(singles, "first", "left")
            .select("first", (F.col("rows") - 1 + F.coalesce("beside", F.lit(0)) + F.coalesce("single", F.lit(0))).alias("n_links"))
        )
        sizes = self.copies.select("first", "n")
        return hot_join(self.members.select("id", "first"), counted, "first", "id", sizes).select("id", "n_links")


def similar_classes(df: DataFrame, vector: str, threshold: float, order: str = "row_index", tile: int = TILE_ROWS) -> SimilarClasses:
    """All similar pairs as classes, pairs of classes and pairs of rows.

    m rows within half the angle of one of them take m records. The result is complete, like that
    of ``similar_pairs``. Rows whose vector is null, zero or not finite are in no class. Rows of
    neighbouring classes that are similar in part are listed in pairs.
    """
    check_threshold(threshold)
    table = vector_table(df, vector, order)
    length = inner_product(F.col("vec"), F.col("vec"))
    table = table.filter((length > 0) & (length < float("inf")))
    marked, firsts = repeated_vectors(table)
    units = cut_lineage(table.join(firsts.select(F.col("first").alias("id")), "id", "left_semi"), "class-units")
    rows = firsts.count()
    cells = PivotCells.choose(units, rows, tile)
    full = math.acos(threshold)
    half = max(0.0, full / 2 - MARGIN)
    # A row belongs to a head that removed it, so heads need not meet the other rows again.
    heads, homes = greedy_homes(units, math.cos(half), cells, rows, tile)
    heads = cut_lineage(heads, "class-heads")
    head_rows = heads.count()
    best = F.max(F.struct("cosine", (-F.col("class_id")).alias("home"))).alias("best")
    homed = homes.groupBy("id").agg(best).select(
        "id", (-F.col("best.home")).alias("class_id"), F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), "best.cosine"))).alias("angle")
    )
    homed = cut_lineage(homed.unionByName(heads.select("id", F.col("id").alias("class_id"), F.lit(0.0).alias("angle"))), "class-homes")
    balls = cut_lineage(
        homed.groupBy("class_id").agg(
            F.count(F.lit(1)).alias("n"),
            # A class of several vectors is never a point, even where its angles round to zero.
            F.when(F.count(F.lit(1)) > 1, F.max("angle") + MARGIN / 10).otherwise(0.0).alias("radius"),
        ),
        "class-balls",
    )
    widest = balls.agg(F.max("radius")).first()[0] or 0.0
    placed = heads.join(balls.select(F.col("class_id").alias("id"), "radius"), "id")
    looking = placed.withColumn("reach", F.col("radius") + F.lit(full + widest))
    met = cut_lineage(
        tile_join(placed, looking, cells, "reach", _between_classes(threshold), "left_class bigint, right_class bigint, whole bigint", head_rows, tile),
        "class-pairs",
    )
    unsettled = cut_lineage(met.filter("whole = 0").select("left_class", "right_class", F.monotonically_increasing_id().alias("cell")), "class-open")
    settled = units.join(homed.select("id", "class_id"), "id")
    row_pairs = tile_join(
        settled, settled, _ClassPairs(unsettled, balls.select("class_id", "n")), 0.0, _crossing(threshold),
        "left_id bigint, right_id bigint, similarity double", rows, tile,
    )
    known = cut_lineage(firsts.join(homed.select(F.col("id").alias("first"), "class_id"), "first"), "class-copies")
    sizes = firsts.select("digest", F.col("copies").alias("n"))
    members = hot_join(marked, known.select("digest", "first", "class_id"), "digest", "id", sizes).select("id", "first", "class_id")
    return SimilarClasses(
        members, met.filter("whole = 1").select("left_class", "right_class"), cut_lineage(row_pairs, "class-rows"),
        known.select("first", "class_id", F.col("copies").alias("n")),
    )
