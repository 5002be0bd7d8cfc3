"""Target column, row positions, and cutting a long lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names tried, in this order, when the default target is asked for.
DEFAULT_TARGET_COLUMNS = ("text", "用户问题", "客户问题", "用户输入")


def resolve_target_column(df: DataFrame, target: str = "text") -> str:
    """The column that holds the text; the default name also stands for its usual aliases."""
    if target in df.columns:
        return target
    if target == "text":
        for name in DEFAULT_TARGET_COLUMNS:
            if name in df.columns:
                return name
    raise ValueError(f"未找到目标列：{target}")


def column(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def target_value(df: DataFrame, target: str = "text") -> Column:
    """The target cell, with NaN of float columns as missing."""
    name = resolve_target_column(df, target)
    value = column(name)
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        value = F.when(~F.isnan(value), value)
    return value


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``).

    Only a local session without the setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="corpusprep-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_SCOPES: list[list[str]] = []


@contextmanager
def intermediate_tables(spark: SparkSession):
    """Delete what ``cut_lineage`` wrote inside the block when it ends.

    Results of the block must be written or collected before its end.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        configuration = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _SCOPES.pop():
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(configuration).delete(place, True)


def cut_lineage(df: DataFrame, name: str = "table", **options: str) -> DataFrame:
    """Write a table to the shared folder and continue from the written copy, a file per task.

    The result no longer depends on the plan that made it: it survives lost executors and
    gives the same rows, in the same place, to every action that follows.
    """
    path = f"{shared_folder(df.sparkSession)}/corpusprep/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.options(compression="zstd", maxRecordsPerFile=0, **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch where rows are large or many copies of a batch are held.
BATCH_BYTES = 1 << 22
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession):
    """Python gets batches of a few megabytes for what runs inside the block (not of what is only planned)."""
    before = spark.conf.get(_BATCHES, None)
    spark.conf.set(_BATCHES, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCHES)
        else:
            spark.conf.set(_BATCHES, before)


_HELD: dict[str, object] = {}


def once_per_worker(name: str | None, factory: Callable[[], object]):
    """What ``factory`` makes, kept by the Python worker under ``name``; without one, made anew."""
    if name is None:
        return factory()
    if name not in _HELD:
        _HELD[name] = factory()
    return _HELD[name]


def with_row_index(df: DataFrame, *order: str | Column, name: str = "row_index") -> DataFrame:
    """Add the 0-based position of each row in the given order.

    Rows are range-partitioned and sorted once and written with their partition; their place
    in its file is their position. Only the row counts of the partitions are then turned into
    running offsets, so no task ever sees more than one partition.
    """
    if not order:
        raise ValueError("with_row_index needs at least one ordering column")
    placed = cut_lineage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()),
        "row-index",
    )
    # One row per shuffle partition: bounded by spark.sql.shuffle.partitions.
    counts = sorted(placed.groupBy("__part").count().collect())
    starts, total = [], 0
    for part, count in counts:
        starts.append((part, total))
        total += count
    offsets = df.sparkSession.createDataFrame(starts, "__part int, __start bigint")
    return (
        placed.withColumn("__pos", placed.metadataColumn("_metadata")["row_index"])
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__start") + F.col("__pos"))
        .drop("__part", "__pos", "__start")
    )


def with_file_order(df: DataFrame) -> DataFrame:
    """Add ``file_path, file_start, file_row``: the order in which rows stand in their files.

    For a table just read from files; sort or index by the three columns in that order.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("file_start"),
        F.monotonically_increasing_id().alias("file_row"),
    )
