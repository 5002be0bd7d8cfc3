"""The stages of the corpus pipeline, each one operator applied to all rows it is given.

All but the last return the columns of ``documents``. Columns are those of the input; a table
without rows gives one without rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm import bpe, langid, mixing, queries, secrets, simhash
from corpusprep.llm.common import free_name, scratch


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; ``lang`` becomes the language of the text.

    Rejected are texts without a letter or null (``und``). The model learns from the labelled
    documents, as op 2 does.
    """
    samples = langid.fit(docs.filter(~queries.held_out()))
    found = langid.identify(docs, samples)
    kept = found.filter(F.col("lang_pred") != langid.UNDETERMINED)
    return kept.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Rows are told apart by a number of their own, so rows that share an id, or have none, are
    documents like all others; of equal ids the first number stays, a null id comes last.
    """
    row = free_name(docs, "row")
    path = scratch(spark, "numbered-documents")
    docs.withColumn(row, F.monotonically_increasing_id()).write.parquet(path)
    numbered = spark.read.parquet(path)
    near = simhash.near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text"), words=3, radius=2)
    ids = numbered.select(F.col(row).alias("number"), F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(row).alias("number")).alias("place"))
    least = ids.join(near.select(F.col("doc_id").alias("number"), "component_id"), "number").groupBy("component_id").agg(F.min("place").alias("place"))
    firsts = least.select(F.col("place.number").alias(row))
    return numbered.join(firsts, row, "left_semi").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced; ``n_chars`` follows the text."""
    before = free_name(docs, "size_before")
    clean = secrets.redact(docs.withColumn(before, F.length("text")))
    changed = F.length("text") != F.col(before)
    size = F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", size).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: some not at all, some up to three times."""
    return mixing.repeated(docs, F.array("source"))


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row."""
    coded = bpe.encode(docs, queries.tokenizer_path())
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")
