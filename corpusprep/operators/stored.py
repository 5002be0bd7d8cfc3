"""Tables that grow batch by batch and are joined without moving what they hold.

``BucketTable`` keeps rows in files by bucket of a key: a join on the key shuffles the new side
into the same buckets and reads the stored side where it lies. ``RepresentativeIndex`` keeps the
representatives of earlier batches that way, by bands of random-projection signs, so that a new
batch meets only the cells it touches.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions.text import key_digest
from corpusprep.operators.neighbors import TILE_ROWS, SignBands, multiplier, tile_join
from corpusprep.operators.rows import cut_lineage

BUCKETS = 32
#: Distinct keys of a batch up to which buckets and files without them are not read.
LISTED = 2000
#: Bands from which an index must pay to be one of bands, and representatives of a shard of the others.
MANY_BANDS, SHARD_ROWS = 64, 1024
#: Batches after which older ones are merged.
MERGE_EVERY = 16


class BucketTable:
    """Rows of batches in a folder: a sub-folder per batch, a file per bucket of ``key``.

    A batch that is written again replaces itself. ``columns`` is a DDL list; the column
    ``batch`` is added. Every ``MERGE_EVERY`` batches older ones are merged into one sub-folder
    with a negative number; a merge that is cut short leaves rows twice until the next one, so
    readers must not count them.
    """

    def __init__(self, folder: str, columns: str, key: str, buckets: int = BUCKETS):
        self.folder, self.columns, self.key, self.buckets = folder.rstrip("/"), columns, key, buckets
        self.name = "bucket_table_" + hashlib.md5(self.folder.encode()).hexdigest()

    def table(self, spark: SparkSession) -> DataFrame:
        """All rows with their ``batch``. The session learns where the table lies."""
        if not spark.catalog.tableExists(self.name):
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
            place = self.folder.replace("'", "\\'")
            spark.sql(
                f"CREATE TABLE {self.name} ({self.columns}, batch BIGINT) USING parquet PARTITIONED BY (batch) "
                f"CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {self.buckets} BUCKETS LOCATION '{place}'"
            )
            spark.catalog.recoverPartitions(self.name)
        spark.catalog.refreshTable(self.name)
        return spark.table(self.name)

    def write(self, rows: DataFrame, batch: int) -> None:
        """Store the rows of a batch, in place of what it has stored before."""
        spark = rows.sparkSession
        names = [c for c in self.table(spark).columns if c != "batch"]
        dealt = rows.select(*names).repartition(self.buckets, self.key).sortWithinPartitions(self.key)
        spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION (batch = {batch}) SELECT * FROM {{rows}}", rows=dealt)

    def batches(self, spark: SparkSession) -> list[int]:
        """Numbers of the stored batches: one per sub-folder."""
        return sorted(r[0] for r in self.table(spark).select("batch").distinct().collect())

    def before(self, spark: SparkSession, batch: int) -> DataFrame:
        """The rows of earlier batches. Later ones are refused: the stream began anew."""
        held = self.batches(spark)
        if held and held[-1] > batch:
            raise ValueError(f"{self.folder} holds batch {held[-1]}, later than batch {batch}: use a new folder")
        return self.table(spark).filter(F.col("batch") < batch).drop("batch")

    def merge(self, spark: SparkSession, batch: int, every: int = MERGE_EVERY) -> None:
        """Merge what lies before the batch ahead of ``batch`` once there are ``every`` sub-folders.

        The last two batches stay as they are, because Spark may replay them.
        """
        old = [b for b in self.batches(spark) if b < batch - 1]
        if len(old) < every:
            return
        rows = self.table(spark).filter(F.col("batch").isin(old)).drop("batch").distinct()
        self.write(cut_lineage(rows, "merged"), -(batch + 1))
        for number in old:
            spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (batch = {number})")
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/batch={number}")
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        spark.catalog.refreshTable(self.name)

    def touched(self, stored: DataFrame, keys: DataFrame) -> DataFrame:
        """Stored rows that may have one of ``keys`` (a column named like the key).

        Up to ``LISTED`` distinct keys become a condition that prunes buckets and row groups;
        with more of them everything is read.
        """
        listed = [r[0] for r in keys.select(self.key).distinct().limit(LISTED + 1).collect()]
        return stored if len(listed) > LISTED else stored.filter(F.col(self.key).isin(listed)) if listed else stored.limit(0)


class _Given:
    """Cells that both tables of a tiled join have already."""

    single = False

    def place(self, base: DataFrame, probe: DataFrame, radius) -> tuple[DataFrame, DataFrame]:
        return base, probe


@dataclass(frozen=True)
class _Shards:
    """Cells for an index whose bands would not pay: a representative lies in one, a row meets all."""

    count: int

    def stored(self, table: DataFrame) -> DataFrame:
        return table.withColumn("cell", F.pmod(F.xxhash64("id"), F.lit(self.count)).cast("bigint"))

    def touched(self, table: DataFrame) -> DataFrame:
        return table.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(self.count - 1)).cast("array<bigint>")))


def _meets(threshold: float):
    """Ids of base rows with a similar probe row."""

    def reduce(base, probe, cosines):
        return [base["id"][(cosines >= threshold).any(axis=0)]]

    return reduce


class RepresentativeIndex:
    """Representatives of earlier batches, found by key or by similarity.

    Vectors lie in ``cells.bands`` cells each; two at the threshold share one with probability
    ``recall``. ``rows`` is how many representatives are expected: it sets the bits of a cell.
    With far more of them cells grow; those beyond ``tile`` rows are cut into tiles. Where storing
    every vector once a band is dearer than comparing all, vectors lie once, in a shard by their id,
    a batch meets all shards, and no similar representative is missed.
    """

    def __init__(self, folder: str, threshold: float, recall: float = 0.95, rows: int = 1 << 20, buckets: int = BUCKETS,
                 category: str = "string", tile: int = TILE_ROWS):
        self.threshold, self.tile = threshold, tile
        self.cells: SignBands | _Shards = SignBands.for_recall(threshold, recall, rows)
        if self.cells.bands > MANY_BANDS and not self.cells.pays(rows):
            self.cells = _Shards(max(1, min(buckets, rows // SHARD_ROWS)))
        self.bands = BucketTable(f"{folder}/bands", "cell BIGINT, id BIGINT, vec ARRAY<DOUBLE>", "cell", buckets)
        self.sizes = BucketTable(f"{folder}/sizes", "cell BIGINT, n BIGINT", "cell", buckets)
        self.keys = BucketTable(f"{folder}/keys", "digest BINARY, row_index BIGINT", "digest", buckets)
        self.facts = BucketTable(f"{folder}/facts", f"row_index BIGINT, key STRING, category {category}, vec ARRAY<DOUBLE>", "row_index", buckets)
        self.parts = (self.bands, self.sizes, self.keys, self.facts)

    def add(self, representatives: DataFrame, batch: int) -> None:
        """Store ``row_index, key, category, vec``; the vector of a blank text is null."""
        rows = representatives.withColumn("vec", F.col("vec").cast("array<double>"))
        self.facts.write(rows, batch)
        self.keys.write(rows.select(key_digest(F.col("key")).alias("digest"), "row_index"), batch)
        placed = cut_lineage(self.cells.stored(rows.filter("vec IS NOT NULL").select(F.col("row_index").alias("id"), "vec")), "bands")
        self.bands.write(placed, batch)
        self.sizes.write(placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")), batch)
        for part in self.parts:
            # A size stands once per batch and cell; merged ones would have to be added up.
            if part is not self.sizes:
                part.merge(representatives.sparkSession, batch)

    def similar_ids(self, probe: DataFrame, batch: int) -> DataFrame:
        """``id`` of the stored representatives similar to a row of ``probe`` (``id, vec``).

        The stored side is neither shuffled nor copied, but for cells of more than ``tile`` rows.
        """
        spark = probe.sparkSession
        vectors = probe.select("id", F.col("vec").cast("array<double>").alias("vec"))
        # In shards the vectors are written once; their copies are made as they are read.
        banded = isinstance(self.cells, SignBands)
        placed = cut_lineage(self.cells.touched(vectors), "touched-cells") if banded else self.cells.touched(cut_lineage(vectors, "touching"))
        stored = self.bands.touched(self.bands.before(spark, batch), placed)
        counts = self.sizes.touched(self.sizes.before(spark, batch), placed).groupBy("cell").agg(F.sum("n").alias("n"))
        probes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        # At most (all rows / tile) cells; written, so that its size is known to the joins.
        large = cut_lineage(counts.unionByName(probes).filter(F.col("n") > self.tile).select("cell").distinct(), "large-cells")
        schema = "id bigint"
        run = multiplier(_meets(self.threshold), schema)
        if large.isEmpty():
            return stored.groupBy("cell").cogroup(placed.groupBy("cell")).applyInArrow(run, schema).distinct()
        few = [t.join(large, "cell", "left_anti") for t in (stored, placed)]
        found = few[0].groupBy("cell").cogroup(few[1].groupBy("cell")).applyInArrow(run, schema)
        many = [t.join(large, "cell", "left_semi").select("id", "vec", "cell") for t in (stored, placed)]
        more = tile_join(many[0], many[1], _Given(), 0.0, _meets(self.threshold), schema, 0, self.tile)
        return found.unionByName(more).distinct()

    def relevant(self, units: DataFrame, batch: int) -> DataFrame:
        """``row_index, key, category, vec`` of the representatives that a batch can repeat.

        ``units`` has ``id, digest, vec``, with a null vector for blank texts. Passed on as the
        known representatives, these give what all of them would, at the recall of the bands.
        """
        spark = units.sparkSession
        by_key = self.keys.before(spark, batch).join(units.select("digest").distinct(), "digest").select("row_index")
        by_vector = self.similar_ids(units.filter("vec IS NOT NULL").select("id", "vec"), batch).select(F.col("id").alias("row_index"))
        found = cut_lineage(by_key.unionByName(by_vector).distinct(), "relevant-ids")
        facts = self.facts.touched(self.facts.before(spark, batch), found)
        return facts.join(found, "row_index", "left_semi").dropDuplicates(["row_index"])

    def all(self, spark: SparkSession) -> DataFrame:
        """Every stored representative, once."""
        return self.facts.table(spark).drop("batch").dropDuplicates(["row_index"])
