"""Reading and writing tables and run records."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpusprep.operators.rows import column
from corpusprep.sources.records import csv_records, placed_lines, records_of

FORMATS = {".csv": "csv", ".parquet": "parquet"}
# Words that stand for a missing cell.
MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


def _format(path: str) -> str:
    kind = FORMATS.get(PurePosixPath(path).suffix.lower())
    if kind is None:
        raise ValueError(f"unsupported file type, expected one of {', '.join(FORMATS)}: {path}")
    return kind


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names of CSV files, from the header line only."""
    return spark.read.csv(path, header=True, inferSchema=False, enforceSchema=False).columns


def read_csv(
    spark: SparkSession, path: str, keep_blank_lines: bool = True, na_values: tuple[str, ...] = MISSING_WORDS
) -> DataFrame:
    """CSV files with a header; every column is text, so a number keeps its spelling.

    Quoted cells keep their line breaks, and empty lines are rows of missing values unless
    ``keep_blank_lines`` is off. Cells that are empty or one of ``na_values`` are missing; pass
    ``()`` to keep such words. A header must stand in the first lines of each file.
    """
    if _format(path) != "csv":
        raise ValueError(f"not a CSV file: {path}")
    names = csv_columns(spark, path)
    if not names:
        return spark.createDataFrame([], T.StructType([]))
    fields = ", ".join(f"`{name.replace('`', '``')}` STRING" for name in names)
    return _parsed(csv_records(spark, path), fields, keep_blank_lines, na_values)


def _parsed(records: DataFrame, fields: str, keep_blank_lines: bool, na_values: tuple[str, ...]) -> DataFrame:
    """Records as rows. ``fields`` is a DDL list."""
    if not keep_blank_lines:
        records = records.filter("value <> ''")
    # The parser reads one record: a line break inside a cell is a character like any other.
    parsed = F.from_csv("value", F.lit(fields), {"escape": '"', "maxCharsPerColumn": "-1", "multiLine": "true"})
    return _without(records.select(parsed.alias("r")).select("r.*"), na_values)


def _without(table: DataFrame, na_values: tuple[str, ...]) -> DataFrame:
    """Text cells that are empty or one of the words become missing."""
    if not na_values:
        return table
    return table.select(
        *(
            F.when(~column(f.name).isin(*na_values), column(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else column(f.name)
            for f in table.schema
        )
    )


def count_rows(table: DataFrame) -> int:
    """Number of records; 0 for an empty table."""
    return table.count()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV (all text) or Parquet (typed) table, by the ending of its path."""
    return read_csv(spark, path) if _format(path) == "csv" else spark.read.parquet(path)


def stream_table(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    kind: str = "csv",
    files_per_batch: int = 1,
    na_values: tuple[str, ...] = MISSING_WORDS,
) -> DataFrame:
    """A folder of files as a stream, a bounded number of files per micro-batch.

    CSV files may have line breaks in quoted cells, so each is read by one task. Missing words
    are as in ``read_csv``; empty lines are left out, as Spark's CSV reader skips them.
    ``CsvStream`` keeps them and reads files in splits, for sinks that take whole batches.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if kind == "csv":
        reader = reader.option("header", True).option("escape", '"').option("multiLine", True)
        return _without(reader.format(kind).load(folder), na_values)
    return reader.format(kind).load(folder)


class CsvStream:
    """CSV files of a folder in micro-batches of whole files, read as ``read_csv`` reads them.

    Empty lines are rows of missing values, quoted cells keep their line breaks, and a file of
    any size is read in splits by many tasks: each batch gets its own survey of where records
    begin. ``schema`` is a DDL list of the columns in their order; every file has a header.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType | str, files_per_batch: int = 1,
                 keep_blank_lines: bool = True, na_values: tuple[str, ...] = MISSING_WORDS):
        lines = spark.readStream.option("lineSep", "\n").option("maxFilesPerTrigger", files_per_batch)
        self.lines = placed_lines(lines.text(folder))
        self.fields = schema if isinstance(schema, str) else ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
        self.keep_blank_lines, self.na_values = keep_blank_lines, na_values

    def start(self, process: Callable[[DataFrame, int], None], checkpoint: str, **trigger) -> StreamingQuery:
        """Call ``process`` with the rows and the number of each batch, such as the sinks' own."""

        def each(lines: DataFrame, batch_id: int) -> None:
            process(_parsed(records_of(lines), self.fields, self.keep_blank_lines, self.na_values), batch_id)

        writer = self.lines.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()


def write_table(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A table as a folder of CSV files with header, or of Parquet files."""
    writer = table.write.mode(mode)
    if _format(path) == "csv":
        writer.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    else:
        writer.parquet(path)


def append_table(table: DataFrame, path: str) -> None:
    """Add rows to a written table; each file has its own header."""
    write_table(table, path, mode="append")


def write_matches(matches: DataFrame, path: str, append: bool = False) -> bool:
    """Write the audit table of a semantic deduplication; nothing at all if it has no rows."""
    if matches.isEmpty():
        return False
    write_table(matches, path, mode="append" if append else "overwrite")
    return True


def run_metadata(
    spark: SparkSession,
    action: str,
    input_path: str,
    output_path: str,
    parameters: dict[str, object],
    cleaning_stats: DataFrame | None = None,
    deduplication_stats: DataFrame | None = None,
    clustering_stats: DataFrame | None = None,
    evaluation_stats: DataFrame | None = None,
    side_files: dict[str, str] | None = None,
) -> DataFrame:
    """One row that describes a run: time, action, paths, parameters, the counts there are."""
    record = spark.range(1).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("generated_at"),
        F.lit(action).alias("action"),
        F.lit(input_path).alias("input_file"),
        F.lit(output_path).alias("output_file"),
        F.struct(*(F.lit(value).alias(name) for name, value in parameters.items() if value is not None)).alias("parameters"),
    )
    parts = {
        "cleaning_stats": cleaning_stats,
        "deduplication_stats": deduplication_stats,
        "clustering_stats": clustering_stats,
        "evaluation_stats": evaluation_stats,
    }
    for name, stats in parts.items():
        if stats is not None:  # one row each
            record = record.join(F.broadcast(stats.select(F.struct("*").alias(name))))
    for name, path in (side_files or {}).items():
        record = record.withColumn(name, F.lit(path))
    return record


def write_run_metadata(record: DataFrame, path: str) -> None:
    """The run record as a single JSON document in the folder ``path``."""
    record.coalesce(1).write.mode("overwrite").json(path)
