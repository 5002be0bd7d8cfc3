"""The same operators on Structured Streaming tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusprep.functions.text import dedup_key, key_digest
from corpusprep.operators.cleaning import clean, cleaning_stats
from corpusprep.operators.dedup import exact_dedup, known_digests
from corpusprep.operators.rows import column, cut_lineage, target_value
from corpusprep.operators.semantic import semantic_dedup
from corpusprep.operators.stored import BUCKETS, BucketTable, RepresentativeIndex

clean_stream = clean  # stateless: the batch operator as it is
cleaning_stats_stream = cleaning_stats  # a running aggregate: complete output mode


def dedup_stream(
    stream: DataFrame, target: str = "text", event_time: str | None = None, delay: str | None = None
) -> DataFrame:
    """Keep one row of every key that arrives, in a stateful query.

    Which copy of one micro-batch stays is open; ``DedupStream`` keeps the first in row order.

    The state is one 32-byte digest per key. Without an event time it grows with the keys;
    with ``event_time`` and ``delay`` keys are forgotten once the watermark has passed them.
    """
    keyed = stream.withColumn("__digest", key_digest(dedup_key(target_value(stream, target))))
    if event_time is None:
        return keyed.dropDuplicates(["__digest"]).drop("__digest")
    if delay is None:
        raise ValueError("an event time needs a delay")
    return keyed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["__digest"]).drop("__digest")


class BatchFolders:
    """Results of micro-batches below a folder: one sub-folder per table and batch number.

    A batch that Spark replays after a failure overwrites its own sub-folders, so it counts
    once. A stream that starts anew (batch 0 again, as after a lost checkpoint) is refused if
    the folder holds later batches.
    """

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        raise NotImplementedError

    def start(self, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def _write(self, name: str, table: DataFrame, batch_id: int) -> None:
        table.write.mode("overwrite").parquet(f"{self.folder}/{name}/batch={batch_id}")

    def _read(self, spark: SparkSession, name: str) -> DataFrame | None:
        """All batches of a table with their number, or nothing before the first one."""
        try:
            return spark.read.parquet(f"{self.folder}/{name}")
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def _before(self, spark: SparkSession, name: str, batch_id: int) -> DataFrame | None:
        """The rows of the batches before this one."""
        table = self._read(spark, name)
        if table is None:
            return None
        last = table.agg(F.max("batch")).first()[0]
        if last is not None and last > batch_id:
            raise ValueError(f"{self.folder} holds batch {last}, later than batch {batch_id}: use a new folder")
        return table.filter(F.col("batch") < batch_id).drop("batch")

    def _result(self, spark: SparkSession, name: str) -> DataFrame:
        table = self._read(spark, name)
        if table is None:
            raise ValueError(f"no batch has been written to {self.folder}")
        return table.drop("batch")


class DedupStream(BatchFolders):
    """Exact deduplication of a stream that keeps the first row of every key.

    Rows of a micro-batch are decided in the order of ``order``, those of earlier batches come
    before them. The keys seen are a table of 32-byte digests in buckets: a batch's digests are
    shuffled to them, the stored ones stay where they are, and older batches are merged.
    """

    def __init__(self, folder: str, target: str = "text", order: str = "row_index", buckets: int = BUCKETS):
        super().__init__(folder)
        self.target = target
        self.order = order
        self.keys = BucketTable(f"{self.folder}/keys", "digest BINARY", "digest", buckets)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = self.keys.before(spark, batch_id)
        kept = exact_dedup(batch, self.target, self.order, known)
        self._write("kept", kept, batch_id)
        written = spark.read.schema(batch.schema).parquet(f"{self.folder}/kept/batch={batch_id}")
        self.keys.write(known_digests(written, self.target), batch_id)
        self.keys.merge(spark, batch_id)

    def kept(self, spark: SparkSession) -> DataFrame:
        return self._result(spark, "kept")


class SemanticDedupStream(BatchFolders):
    """Semantic deduplication of a stream, one micro-batch after the other.

    Each batch is compared with the representatives of all batches before it. Kept rows,
    matches and representatives are written. Row numbers must grow from batch to batch.
    """

    def __init__(self, folder: str, target: str = "text", order: str = "row_index", category: str = "category", **options):
        super().__init__(folder)
        self.target = target
        self.order = order
        self.category = category
        self.options = options

    def process(self, batch: DataFrame, batch_id: int) -> None:
        known = self._before(batch.sparkSession, "representatives", batch_id)
        outcome = semantic_dedup(
            batch, self.target, order=self.order, category=self.category, known=known, **self.options
        )
        self._write("kept", outcome.kept(), batch_id)
        self._write("matches", outcome.matches(), batch_id)
        self._write("representatives", outcome.new_representatives(), batch_id)

    def kept(self, spark: SparkSession) -> DataFrame:
        return self._result(spark, "kept")

    def matches(self, spark: SparkSession) -> DataFrame:
        return self._result(spark, "matches")

    def representatives(self, spark: SparkSession) -> DataFrame:
        return self._result(spark, "representatives")


class IndexedSemanticStream(SemanticDedupStream):
    """``SemanticDedupStream`` with an index of the representatives (``RepresentativeIndex``).

    A batch reads the cells of the index that its vectors fall into, and is compared with the
    representatives found there; work follows the batch, not what came before. A representative
    similar to a row is found with probability ``recall``; where one is missed the row is kept.
    """

    def __init__(self, folder: str, threshold: float = 0.9, recall: float = 0.95, rows: int = 1 << 20, buckets: int = BUCKETS,
                 vector: str = "embedding", target: str = "text", order: str = "row_index", category: str = "category",
                 category_type: str = "string", **options):
        super().__init__(folder, target, order, category, threshold=threshold, vector=vector, **options)
        self.vector = vector
        self.index = RepresentativeIndex(f"{self.folder}/index", threshold, recall, rows, buckets, category_type)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        key = dedup_key(target_value(batch, self.target))
        firsts = batch.select(column(self.order).cast("bigint").alias("id"), key.alias("key"), column(self.vector).alias("vec"))
        units = firsts.groupBy(key_digest(F.col("key")).alias("digest")).agg(
            F.min("id").alias("id"), F.min_by(F.when(F.col("key") != "", F.col("vec")), "id").alias("vec")
        )
        known = cut_lineage(self.index.relevant(cut_lineage(units, "batch-units"), batch_id), "known")
        outcome = semantic_dedup(batch, self.target, order=self.order, category=self.category, known=known, **self.options)
        self._write("kept", outcome.kept(), batch_id)
        self._write("matches", outcome.matches(), batch_id)
        self.index.add(cut_lineage(outcome.new_representatives(), "new-representatives"), batch_id)

    def representatives(self, spark: SparkSession) -> DataFrame:
        return self.index.all(spark)
