"""Queries over the driver's tables, one per operator, with their SQL counterparts."""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpusprep.functions import text as X  # noqa: E402
from corpusprep.functions import vectors as V  # noqa: E402
from corpusprep.operators import classes, cleaning, cluster_tables, clustering, dedup, density, neighbors, scoring  # noqa: E402
from corpusprep.operators.encoding import encode  # noqa: E402
from corpusprep.operators.projection import project_3d  # noqa: E402
from corpusprep.operators.rows import cut_lineage, shared_folder, with_row_index  # noqa: E402
from corpusprep.operators.semantic import semantic_dedup  # noqa: E402
from corpusprep.plans.clean_dedup import clean_then_dedup  # noqa: E402
from corpusprep.plans.cluster_texts import cluster_texts  # noqa: E402
from corpusprep.sources import tables as io  # noqa: E402
from corpusprep.streaming import streams  # noqa: E402

# The training-data operators and their pipeline may be absent; everything else works without.
try:
    from corpusprep.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith("corpusprep.llm"):
        raise
    llm_queries = None
try:
    import corpus_pipeline
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith(("corpusprep.llm", "corpus_pipeline")):
        raise
    corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]

# Pairs of vectors in the given table are far apart; at this similarity some are "duplicates".
SIMILAR = 0.4
# Angles of near copies made of them are far smaller than the half of this one's.
SIMILAR_COPIES = 0.9
# Rows of a tile where the given vectors are to fill several cells.
SMALL_TILE = 32


# --- inputs --------------------------------------------------------------------------------


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """The documents, read in splits; only files with fewer splits than cores are dealt out evenly."""
    table = _table(spark, sf, "documents")
    cores = spark.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table


def _words(spark: SparkSession, sf: str) -> DataFrame:
    """Every word of every document; full stops leave blanks, stars become emoji."""
    words = F.split(F.translate("text", ".*", " 😂"), " ")
    return _documents(spark, sf).select("doc_id", F.posexplode(words).alias("pos", "text"))


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors, each with a text of its own."""
    return _table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row_index"), F.col("vec_id").cast("string").alias("text"), "embedding", "label"
    )


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    """All documents, with a vector and a given cluster; fewer vectors than documents repeat."""
    vectors = _table(spark, sf, "embeddings").select("vec_id", "embedding", F.col("label").alias("cluster_id"))
    count = vectors.count()
    chosen = _table(spark, sf, "documents").withColumn("vec_id", F.col("doc_id") % max(count, 1))
    return chosen.join(vectors, "vec_id").select(F.col("doc_id").alias("row_index"), "text", "lang", "embedding", "cluster_id")


def _members(spark: SparkSession, sf: str) -> DataFrame:
    return cut_lineage(cluster_tables.member_table(_labelled(spark, sf)), "members")


def _facts(rows: DataFrame) -> DataFrame:
    return cut_lineage(cluster_tables.cluster_facts(rows), "facts")


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/corpusprep/{name}-{uuid.uuid4().hex}"


# --- cleaning ------------------------------------------------------------------------------


def clean_words(spark, sf):
    return cleaning.clean(_words(spark, sf)).select("doc_id", "pos", "text")


def removed_words(spark, sf):
    return cleaning.removed_rows(_words(spark, sf)).select("doc_id", "pos", "text", "removal_reason")


def removal_reasons_by_document(spark, sf):
    reasons = cleaning.with_removal_reason(_words(spark, sf))
    return reasons.groupBy("doc_id", F.coalesce("removal_reason", F.lit("kept")).alias("reason")).agg(
        F.count(F.lit(1)).alias("words")
    )


def cleaning_stats_words(spark, sf):
    return cleaning.cleaning_stats(_words(spark, sf))


def clean_documents(spark, sf):
    return cleaning.clean(_documents(spark, sf))


def cleaning_stats_tables(spark, sf):
    parts = [("documents", "text"), ("conversations", "text"), ("benchmark", "text"), ("pages", "html")]
    rows = [
        cleaning.cleaning_stats(_table(spark, sf, name), target).withColumn("name", F.lit(name))
        for name, target in parts
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


def merged_cleaning_stats(spark, sf):
    """Counts of the words per language, added up."""
    words = _words(spark, sf).join(_table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    parts = words.groupBy("lang").agg(*cleaning.counters(X.removal_reason(F.col("text")))).drop("lang")
    return cleaning.merge_stats(parts)


# --- exact deduplication -------------------------------------------------------------------


def dedup_keys(spark, sf):
    return _documents(spark, sf).select("doc_id", X.dedup_key(F.col("text")).alias("dedup_key"))


def exact_dedup_documents(spark, sf):
    return dedup.exact_dedup(_documents(spark, sf), order="doc_id")


def exact_dedup_conversations(spark, sf):
    rows = _table(spark, sf, "conversations").withColumn("row_index", F.col("conv_id") * 100000 + F.col("turn"))
    return dedup.exact_dedup(rows).drop("row_index")


def exact_dedup_stats(spark, sf):
    return dedup.exact_dedup_stats(_documents(spark, sf))


def first_words(spark, sf):
    """Numbering all words, then keeping the first of each: a few keys hold most rows."""
    return dedup.exact_dedup(with_row_index(_words(spark, sf), "doc_id", "pos"), numbered=True).select("row_index", "doc_id", "pos", "text")


def known_keys_dedup(spark, sf):
    documents = _documents(spark, sf)
    known = dedup.known_digests(documents.filter(F.col("source").eqNullSafe("src0")))
    return dedup.exact_dedup(documents.filter(~F.col("source").eqNullSafe("src0")), order="doc_id", known_keys=known)


def known_keys_stats(spark, sf):
    documents = _documents(spark, sf)
    known = dedup.known_digests(documents.filter(F.col("source").eqNullSafe("src0")))
    return dedup.exact_dedup_stats(documents.filter(~F.col("source").eqNullSafe("src0")), known_keys=known)


def row_index(spark, sf):
    events = _table(spark, sf, "events").select("event_id", "ts", "user_id")
    return with_row_index(events, F.desc("ts"), F.col("event_id"))


def _cleaned_words(spark, sf):
    words = _words(spark, sf).withColumn("place", F.col("doc_id") * 10000000 + F.col("pos"))
    return clean_then_dedup(words, order="place")


def clean_then_dedup_words(spark, sf):
    return _cleaned_words(spark, sf).kept.select("row_index", "doc_id", "pos", "text")


def clean_then_dedup_stats(spark, sf):
    result = _cleaned_words(spark, sf)
    return result.cleaning_stats.select(F.struct("*").alias("c")).join(
        F.broadcast(result.dedup_stats.select(F.struct("*").alias("d")))
    ).select(
        "c.total_before", "c.total_removed", F.col("d.total_before").alias("cleaned"),
        "d.duplicate_rows", "d.unique_values", "d.total_after",
    )


def target_alias(spark, sf):
    """Documents whose texts stand in a column by one of the usual other names."""
    questions = _table(spark, sf, "documents").withColumnRenamed("text", "用户问题")
    kept = clean_then_dedup(questions, order="doc_id").kept
    return kept.select("row_index", "doc_id", F.col("用户问题").alias("question"))


def empty_input(spark, sf):
    """Rows to remove from clean documents: none. Their counts, and what is read back after writing them."""
    nothing = cleaning.removed_rows(cleaning.clean(_table(spark, sf, "documents"))).drop("removal_reason")
    path = _folder(spark, "nothing") + ".csv"
    io.write_table(nothing, path)
    result = clean_then_dedup(nothing, order="doc_id")
    return result.cleaning_stats.select(F.struct("*").alias("c")).join(
        F.broadcast(result.dedup_stats.select(F.struct("*").alias("d")))
    ).select("c.*", "d.duplicate_rows", "d.unique_values", F.lit(io.count_rows(io.read_csv(spark, path))).cast("bigint").alias("read_back"))


# --- files ---------------------------------------------------------------------------------


def csv_round_trip(spark, sf):
    """All documents; most of their texts hold line breaks."""
    path = _folder(spark, "documents") + ".csv"
    io.write_table(_table(spark, sf, "documents"), path)
    return io.read_csv(spark, path)


def csv_stream(spark, sf):
    path = _folder(spark, "documents") + ".csv"
    table = _table(spark, sf, "documents")
    io.write_table(table.repartition(8), path)
    return _drain_csv(io.CsvStream(spark, path, table.schema, files_per_batch=4))


def csv_stream_blank_lines(spark, sf):
    """Languages of the documents as CSV files of one column: a missing one is an empty line."""
    path = _folder(spark, "languages")

    def with_header(batches):
        yield pa.RecordBatch.from_pydict({"value": ["lang"]})
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["value"])

    lines = _table(spark, sf, "documents").select(F.coalesce("lang", F.lit("")).alias("value")).repartition(6)
    lines.mapInArrow(with_header, "value string").write.text(path)
    rows = _drain_csv(io.CsvStream(spark, path, "lang string", files_per_batch=2))
    return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("documents"))


def appended_table(spark, sf):
    path = _folder(spark, "conversations") + ".parquet"
    talk = _table(spark, sf, "conversations")
    io.write_table(talk.filter("role = 'user'"), path)
    io.append_table(talk.filter("role <> 'user'"), path)
    return io.read_table(spark, path)


def row_counts(spark, sf):
    names = ["documents", "embeddings", "labels", "conversations"]
    counts = [_table(spark, sf, n).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("name", F.lit(n)) for n in names]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


def csv_row_counts(spark, sf):
    """Records of written CSV files; line breaks in cells begin none."""
    counts = []
    for name in ("documents", "conversations", "pages"):
        path = _folder(spark, name) + ".csv"
        io.write_table(_table(spark, sf, name), path)
        counts.append((name, io.count_rows(io.read_csv(spark, path))))
    return spark.createDataFrame(counts, "name string, n_rows bigint")


def written_matches(spark, sf):
    """The audit table in two loads; a load without matches leaves what is there."""
    found = cut_lineage(semantic_dedup(_vectors(spark, sf), threshold=SIMILAR, category="label").matches(), "matches")
    path = _folder(spark, "matches") + ".csv"
    same = F.coalesce(F.col("same_label"), F.lit(False))
    io.write_matches(found.filter(same), path)
    io.write_matches(found.filter("row_index < duplicate_of_row_index"), path)
    io.write_matches(found.filter(~same), path, append=True)
    numbers = [F.col(c).cast("bigint").alias(c) for c in ("row_index", "duplicate_of_row_index", "label", "matched_label")]
    return io.read_csv(spark, path).select(*numbers, "text", "matched_text", F.round(F.col("similarity").cast("double"), 6).alias("similarity"))


def run_metadata(spark, sf):
    words = _words(spark, sf)
    record = io.run_metadata(
        spark, "clean-deduplicate", "documents.parquet", "kept.parquet", {"target_column": "text", "threshold": None},
        cleaning_stats=cleaning.cleaning_stats(words), deduplication_stats=dedup.exact_dedup_stats(words),
    )
    path = _folder(spark, "run")
    io.write_run_metadata(record, path)
    return spark.read.json(path).select(
        "action", "input_file", F.col("parameters.target_column").alias("target_column"),
        F.col("cleaning_stats.total_after").alias("cleaned"), F.col("deduplication_stats.unique_values").alias("unique_values"),
    )


# --- vectors -------------------------------------------------------------------------------


def normalized_vectors(spark, sf):
    doubled = F.transform("embedding", lambda x: x.cast("double") * 2)
    unit = V.l2_normalize(doubled)
    return _table(spark, sf, "embeddings").select(
        "vec_id", F.round(V.inner_product(unit, unit), 6).alias("squared_norm"), F.round(unit[0], 6).alias("first_value")
    )


def inner_products(spark, sf):
    left = _table(spark, sf, "embeddings").select("vec_id", "embedding")
    right = left.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return left.join(right, "vec_id").select(
        "vec_id", F.round(V.inner_product(F.col("embedding"), F.col("next")), 6).alias("similarity")
    )


def similar_pairs(spark, sf):
    pairs = neighbors.similar_pairs(_vectors(spark, sf), "embedding", SIMILAR)
    return pairs.withColumn("similarity", F.round("similarity", 6))


def similar_pairs_approx(spark, sf):
    pairs = neighbors.similar_pairs_approx(_vectors(spark, sf), "embedding", SIMILAR, recall=0.9999)
    return pairs.withColumn("similarity", F.round("similarity", 6))


def top_k_neighbors(spark, sf):
    rows = _vectors(spark, sf)
    found = neighbors.top_k_neighbors(rows, rows, 5)
    return found.withColumn("similarity", F.round("similarity", 6))


def similar_pairs_cells(spark, sf):
    """Tiles so small that the vectors fall into several cells."""
    pairs = neighbors.similar_pairs(_vectors(spark, sf), "embedding", SIMILAR, tile=SMALL_TILE)
    return pairs.withColumn("similarity", F.round("similarity", 6))


def top_k_cells(spark, sf):
    rows = _vectors(spark, sf)
    return neighbors.top_k_neighbors(rows, rows, 5, tile=SMALL_TILE).withColumn("similarity", F.round("similarity", 6))


def similar_classes(spark, sf):
    """Every vector with three near copies, each with another component enlarged: links of each row."""
    rows = _table(spark, sf, "embeddings").withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(3))))
    enlarged = F.transform("embedding", lambda x, i: F.when(i + 1 == F.col("variant"), 1.5 * x.cast("double")).otherwise(x.cast("double")))
    copies = rows.select((4 * F.col("vec_id") + F.col("variant")).alias("row_index"), enlarged.alias("embedding"))
    return classes.similar_classes(copies, "embedding", SIMILAR_COPIES).link_counts().withColumnRenamed("id", "row_index")


def encoded_documents(spark, sf):
    """Size and length of the vectors, and how many documents share each one."""
    encoded = cut_lineage(encode(_documents(spark, sf).select("doc_id", "text"), "text").drop("text"), "encoded")
    same = F.count(F.lit(1)).over(Window.partitionBy(F.xxhash64("embedding"), F.xxhash64(F.reverse("embedding"))))
    return encoded.select(
        "doc_id", F.size("embedding").alias("dimensions"),
        F.round(V.inner_product(F.col("embedding"), F.col("embedding")), 4).alias("squared_norm"), same.alias("copies"),
    )


# --- semantic deduplication ----------------------------------------------------------------


def semantic_dedup_vectors(spark, sf):
    return semantic_dedup(_vectors(spark, sf), threshold=SIMILAR).kept().select("row_index", "label")


def semantic_dedup_cells(spark, sf):
    """Several cells and many blocks."""
    found = semantic_dedup(_vectors(spark, sf), threshold=SIMILAR, tile=SMALL_TILE, first_block=4 * SMALL_TILE)
    return found.kept().select("row_index", "label")


def semantic_dedup_approx(spark, sf):
    return semantic_dedup(_vectors(spark, sf), threshold=SIMILAR, index="hnsw").kept().select("row_index", "label")


def semantic_matches(spark, sf):
    found = semantic_dedup(_vectors(spark, sf), threshold=SIMILAR, category="label").matches()
    return found.withColumn("similarity", F.round("similarity", 6))


def semantic_stats(spark, sf):
    return semantic_dedup(_vectors(spark, sf), threshold=SIMILAR).stats().drop("embedding_model")


def _with_blanks(rows: DataFrame) -> DataFrame:
    """All rows under even numbers, and beside each French one a row with a missing text."""
    real = rows.withColumn("row_index", 2 * F.col("row_index"))
    blank = real.filter("lang = 'fr'").withColumn("row_index", F.col("row_index") + 1).withColumn("text", F.lit(None).cast("string"))
    return real.unionByName(blank)


def _texts(spark, sf):
    """Every vector with the text of its document; those without a document have none."""
    documents = _table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text", "lang")
    rows = _table(spark, sf, "embeddings").join(documents, "vec_id", "left")
    return _with_blanks(rows.select(F.col("vec_id").alias("row_index"), "text", "lang", "embedding"))


def semantic_dedup_texts(spark, sf):
    return semantic_dedup(_texts(spark, sf), threshold=SIMILAR).kept().select("row_index", "lang")


def semantic_matches_texts(spark, sf):
    found = semantic_dedup(_texts(spark, sf), threshold=SIMILAR, category="lang").matches()
    return found.select("row_index", "duplicate_of_row_index", "lang", "matched_lang", "same_lang", F.round("similarity", 6).alias("similarity"))


def clean_then_semantic_dedup(spark, sf):
    """Rows without a usable text go first; the others are numbered anew and compared by their vectors."""
    result = clean_then_dedup(_texts(spark, sf), mode="semantic", threshold=SIMILAR)
    return result.kept.select("row_index", "lang")


def semantic_dedup_two_parts(spark, sf):
    """Two loads, the second one against the representatives of the first."""
    rows = with_row_index(_vectors(spark, sf).withColumnRenamed("row_index", "vec_id"), "label", "vec_id")
    early = F.coalesce(F.col("label"), F.lit(0)) < 5
    first = semantic_dedup(rows.filter(early), threshold=SIMILAR)
    second = semantic_dedup(rows.filter(~early), threshold=SIMILAR, known=first.representatives())
    return first.kept().unionByName(second.kept()).select("row_index", "vec_id")


def semantic_dedup_documents(spark, sf):
    """All documents by wording: hashed character trigrams, similarity 0.9."""
    documents = _documents(spark, sf).select(F.col("doc_id").alias("row_index"), "text")
    return semantic_dedup(documents, encoder="char-ngrams").kept().select("row_index")


# --- clusters ------------------------------------------------------------------------------


def cluster_sizes(spark, sf):
    return cluster_tables.cluster_sizes(_members(spark, sf))


def cluster_representatives(spark, sf):
    return cluster_tables.cluster_representatives(_members(spark, sf))


def cluster_keywords(spark, sf):
    return cluster_tables.cluster_keywords(_members(spark, sf))


def token_counts(spark, sf):
    tokens = _documents(spark, sf).select(F.explode(X.keyword_tokens(F.col("text"))).alias("token"))
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("uses"))


def cluster_rule_labels(spark, sf):
    return _facts(_members(spark, sf)).select("cluster_id", "cluster_label")


def cluster_label_context(spark, sf):
    rows = _members(spark, sf)
    context = cluster_tables.cluster_label_context(rows, _facts(rows))
    return context.select(
        "cluster_id", "cluster_size", F.size("top_keyword_list").alias("keywords"),
        F.array_join("sample_texts", "\n--\n").alias("samples"), "prompt",
    )


def cluster_summary(spark, sf):
    rows = _members(spark, sf)
    return cluster_tables.cluster_summary(rows, _facts(rows))


def clustering_stats(spark, sf):
    return cluster_tables.clustering_stats(_members(spark, sf))


def cluster_analysis(spark, sf):
    rows = _members(spark, sf)
    summary = cluster_tables.cluster_summary(rows, _facts(rows))
    return cluster_tables.cluster_analysis(summary, cluster_tables.clustering_stats(rows)).drop("example_texts")


def clustered_rows(spark, sf):
    """The whole path with a given assignment; blank texts are noise."""
    rows = _with_blanks(_labelled(spark, sf)).withColumnRenamed("cluster_id", "given")
    given = rows.select("row_index", F.col("given").alias("cluster_id"))
    found = cluster_texts(rows, vector="embedding", assignment=given).clustered()
    return found.select("row_index", "cluster_id", "is_noise", "cluster_size", "cluster_label")


def normalized_labels(spark, sf):
    return _documents(spark, sf).select("doc_id", X.normalize_label(F.col("text")).alias("label"))


def kmeans_clusters(spark, sf):
    return clustering.kmeans(_vectors(spark, sf), k=8)


def _grouped_vectors(spark, sf):
    """Every vector, small, beside a large axis for its label: groups that nobody can mix up."""
    axes = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.when(i == F.pmod(F.coalesce("label", F.lit(15)), F.lit(16)), 100.0).otherwise(0.0))
    unit = V.l2_normalize(F.col("embedding").cast("array<double>"))
    return _vectors(spark, sf).withColumn("embedding", F.concat(axes, unit))


def kmeans_groups(spark, sf):
    rows = _grouped_vectors(spark, sf)
    return clustering.kmeans(rows, k=rows.agg(F.countDistinct(F.pmod(F.coalesce("label", F.lit(15)), F.lit(16)))).first()[0])


def hdbscan_groups(spark, sf):
    return density.hdbscan(_grouped_vectors(spark, sf), min_cluster_size=5)


def hdbscan_clusters(spark, sf):
    """Documents by wording, density clusters."""
    return cluster_texts(_documents(spark, sf), order="doc_id").rows.select("row_index", "cluster_id")


def core_distances(spark, sf):
    found = density.core_distances(_vectors(spark, sf), k=5)
    return found.withColumn("core_distance", F.round("core_distance", 6))


def projection(spark, sf):
    return project_3d(_members(spark, sf)).drop("text")


def projection_radii(spark, sf):
    """Three dimensions are turned about their mean: distances to it stay, axes are uncorrelated, the widest first."""
    rows = _vectors(spark, sf).select("row_index", "text", F.col("label").alias("cluster_id"), F.slice("embedding", 1, 3).alias("embedding"))
    placed = cut_lineage(project_3d(rows).select("row_index", *[F.col(c).cast("double").alias(c) for c in "xyz"]), "placed")
    flat = [F.abs(F.corr(a, b)) < 1e-4 for a, b in ("xy", "xz", "yz")]
    facts = placed.agg(
        (flat[0] & flat[1] & flat[2]).alias("uncorrelated"),
        ((F.var_pop("x") >= F.var_pop("y")) & (F.var_pop("y") >= F.var_pop("z"))).alias("falling"),
    )
    radius = F.round(F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z")), 3)
    return placed.select("row_index", radius.alias("radius")).join(F.broadcast(facts))


# --- scoring -------------------------------------------------------------------------------


def prompts(spark, sf):
    return _table(spark, sf, "conversations").select(
        "conv_id", "turn", X.render_prompt(F.col("text"), "Answer briefly.").alias("prompt")
    )


def _scored(spark, sf):
    """A stand-in model that whispers; the expected answer is the text if its quality is 1."""
    rows = _documents(spark, sf).join(_table(spark, sf, "labels"), "doc_id", "left").select(
        "doc_id", "text", F.when(F.col("quality") == 1, F.col("text")).otherwise(F.col("lang")).alias("expected")
    )

    def whisper():
        return lambda texts: [f"  {text.lower()} " for text in texts]

    return scoring.score_rows(rows, whisper, expected="expected", result="answer", seconds="seconds", match="matches")


def scored_rows(spark, sf):
    return _scored(spark, sf).select("doc_id", "answer", "matches")


def evaluation_stats(spark, sf):
    return scoring.evaluation_stats(_scored(spark, sf), "seconds", "matches").drop("average_call_time_seconds")


# --- streams -------------------------------------------------------------------------------


def _drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    spark = stream.sparkSession
    out, checkpoint = _folder(spark, "out"), _folder(spark, "stream")
    if mode == "append":
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    else:
        def replace(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(out)

        query = stream.writeStream.outputMode(mode).foreachBatch(replace).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


def _drain_csv(stream: io.CsvStream) -> DataFrame:
    spark = stream.lines.sparkSession
    out = _folder(spark, "out")
    stream.start(lambda rows, batch: rows.write.mode("overwrite").parquet(f"{out}/part={batch}"), _folder(spark, "stream")).awaitTermination()
    return spark.read.parquet(out).drop("part")


def _stream(table: DataFrame, *order: str) -> DataFrame:
    """A table as a stream of 32 files, eight per micro-batch."""
    spark = table.sparkSession
    source = _folder(spark, "source")
    table.repartitionByRange(32, *order).write.parquet(source)
    return io.stream_table(spark, source, table.schema, "parquet", files_per_batch=8)


def _in_order(table: DataFrame, order: str, batches: int = 4) -> DataFrame:
    """All rows as a stream whose micro-batches follow each other in the order of a column."""
    spark = table.sparkSession
    source = _folder(spark, "source")
    placed = with_row_index(table, order, name="__place")
    size = -(-placed.count() // batches)
    # Rows are dealt by their place, so that every part but the last has just so many files.
    files = max(1, min(spark.sparkContext.defaultParallelism, size))
    for part in range(batches):  # files are taken by their time of writing
        rows = placed.filter(F.floor(F.col("__place") / max(size, 1)) == part)
        rows.repartitionById(files, (F.col("__place") % files).cast("int")).drop("__place").write.mode("append").parquet(source)
    return io.stream_table(spark, source, table.schema, "parquet", files_per_batch=files)


def clean_stream(spark, sf):
    return _drain(streams.clean_stream(_stream(_words(spark, sf), "doc_id", "pos")))


def cleaning_stats_stream(spark, sf):
    return _drain(streams.cleaning_stats_stream(_stream(_words(spark, sf), "doc_id", "pos")), "complete")


def dedup_stream(spark, sf):
    """The first row of every key, with the documents arriving in the order of their ids."""
    table = _table(spark, sf, "documents")
    sink = streams.DedupStream(_folder(spark, "dedup"), order="doc_id")
    sink.start(_in_order(table, "doc_id"), _folder(spark, "checkpoint")).awaitTermination()
    return sink.kept(spark)


def dedup_stream_state(spark, sf):
    """Keys kept in streaming state; which copy of a micro-batch stays is open, so the keys are compared."""
    kept = _drain(streams.dedup_stream(_stream(_table(spark, sf, "documents"), "doc_id")))
    return kept.select(X.dedup_key(F.col("text")).alias("dedup_key"))


def dedup_stream_watermark(spark, sf):
    rows = _table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.concat_ws(" ", "event_type", "user_id").alias("text"))
    kept = _drain(streams.dedup_stream(_stream(rows, "ts"), event_time="ts", delay="3650 days"))
    return kept.select("text")


def semantic_dedup_stream(spark, sf):
    sink = streams.SemanticDedupStream(_folder(spark, "semantic"), threshold=SIMILAR)
    sink.start(_in_order(_vectors(spark, sf), "row_index"), _folder(spark, "checkpoint")).awaitTermination()
    return sink.kept(spark).select(F.col("row_index").alias("vec_id"), "label")


def semantic_dedup_indexed_stream(spark, sf):
    """The same with an index of the representatives; at this recall none is missed."""
    table = _vectors(spark, sf)
    sink = streams.IndexedSemanticStream(_folder(spark, "indexed"), SIMILAR, recall=1 - 1e-9, rows=max(1, table.count()))
    sink.start(_in_order(table, "row_index"), _folder(spark, "checkpoint")).awaitTermination()
    return sink.kept(spark).select(F.col("row_index").alias("vec_id"), "label")


# --- contract ------------------------------------------------------------------------------

_QUERIES: list[Query] = [
    clean_words, removed_words, removal_reasons_by_document, cleaning_stats_words, clean_documents,
    cleaning_stats_tables, merged_cleaning_stats, dedup_keys, exact_dedup_documents, exact_dedup_conversations,
    exact_dedup_stats, first_words, known_keys_dedup, known_keys_stats, row_index, clean_then_dedup_words,
    clean_then_dedup_stats, csv_round_trip, csv_stream, csv_stream_blank_lines, appended_table, row_counts, run_metadata, normalized_vectors,
    inner_products, similar_pairs, similar_pairs_approx, top_k_neighbors, encoded_documents,
    semantic_dedup_vectors, semantic_dedup_approx, semantic_matches, semantic_stats, semantic_dedup_texts,
    semantic_matches_texts, semantic_dedup_two_parts, semantic_dedup_documents, cluster_sizes,
    cluster_representatives, cluster_keywords, token_counts, cluster_rule_labels, cluster_label_context,
    cluster_summary, clustering_stats, cluster_analysis, clustered_rows, normalized_labels, kmeans_clusters,
    hdbscan_clusters, core_distances, projection, prompts, scored_rows, evaluation_stats, clean_stream,
    cleaning_stats_stream, dedup_stream, dedup_stream_state, dedup_stream_watermark, semantic_dedup_stream,
    semantic_dedup_indexed_stream, target_alias, empty_input, csv_row_counts, written_matches, similar_pairs_cells,
    top_k_cells, semantic_dedup_cells, clean_then_semantic_dedup, kmeans_groups, hdbscan_groups, projection_radii,
    similar_classes,
]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the first document of every normalised text."""
    return exact_dedup_documents(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """Every registered query by name."""
    found = {query.__name__: query for query in _QUERIES}
    if llm_queries:
        found |= llm_queries.queries()
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return found


# The rules again, in SQL. RE2 classes; white space in the tables is ASCII.
# The letters and code point blocks of the removal rules.
_BROKEN = "\\x{FFFD}ÃÂÐÑØÞßæøåçðþŒœ€™¢£¥¦§¨©ª«¬®¯°±²³´µ¶·¸¹º»¼½¾¿"
_EMOJI = "\\x{1F300}-\\x{1FAFF}\\x{2600}-\\x{27BF}\\x{1F1E6}-\\x{1F1FF}\\x{200D}\\x{FE0F}"


def _strip(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '^\\s+|\\s+$', '', 'g')"


def _key(x: str) -> str:
    return f"replace(lower(regexp_replace({_strip(x)}, '\\s+', ' ', 'g')), 'ß', 'ss')"


def _reason(x: str) -> str:
    t = _strip(x)
    return (
        f"CASE WHEN {t} = '' THEN 'blank' "
        f"WHEN regexp_matches({t}, '^[\\s{_EMOJI}]+$') THEN 'emoji' "
        f"WHEN NOT regexp_matches({t}, '[A-Za-z0-9\\x{{4E00}}-\\x{{9FFF}}]') AND regexp_matches({t}, '[{_BROKEN}\\p{{C}}]') "
        f"AND regexp_matches({t}, '^[\\s{_BROKEN}\\p{{C}}\\p{{P}}\\p{{S}}]+$') THEN 'garbled' "
        f"WHEN regexp_matches({t}, '^[\\s\\p{{P}}\\p{{S}}]+$') THEN 'symbol' END"
    )


_WORDS = (
    "words AS (SELECT doc_id, CAST(unnest(range(len(w))) AS INTEGER) AS pos, unnest(w) AS text FROM "
    "(SELECT doc_id, string_split(translate(text, '.*', ' 😂'), ' ') AS w FROM documents))"
)
_REASONS = f"{_WORDS}, reasons AS (SELECT *, {_reason('text')} AS reason FROM words)"
_COUNTS = (
    "count(*) AS total_before, count(*) FILTER (reason IS NULL) AS total_after, "
    + ", ".join(f"count(*) FILTER (reason = '{r}') AS removed_{r}_rows" for r in ("blank", "symbol", "emoji", "garbled"))
    + ", count(*) FILTER (reason IS NOT NULL) AS total_removed"
)
_KEYED = f"keyed AS (SELECT *, {_key('text')} AS k FROM documents)"


def _dot(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: CAST(p[1] AS DOUBLE) * CAST(p[2] AS DOUBLE)))"


def _cos(a: str, b: str) -> str:
    return f"{_dot(a, b)} / sqrt({_dot(a, a)} * {_dot(b, b)})"


def _walk(rows: str) -> str:
    """Representatives by walking ``rows`` (id, e) one after the other."""
    return (
        f"RECURSIVE numbered AS MATERIALIZED (SELECT id, e, row_number() OVER (ORDER BY id) AS n FROM ({rows})), "
        "walk AS (SELECT CAST(0 AS BIGINT) AS n, CAST([] AS STRUCT(id BIGINT, e FLOAT[])[]) AS reps "
        "UNION ALL SELECT r.n, CASE WHEN coalesce(list_max(list_transform(w.reps, "
        f"lambda q: {_cos('q.e', 'r.e')})), -2) >= {SIMILAR} "
        "THEN w.reps ELSE list_append(w.reps, {'id': r.id, 'e': r.e}) END "
        "FROM walk w JOIN numbered r ON r.n = w.n + 1), "
        "reps AS (SELECT q.id AS id, q.e AS e FROM (SELECT unnest(reps) AS q FROM walk WHERE n = (SELECT max(n) FROM walk)))"
    )


_VECTOR_ROWS = "SELECT vec_id AS id, embedding AS e FROM embeddings"
_PAIRED = "documents d JOIN embeddings e ON e.vec_id = d.doc_id % (SELECT count(*) FROM embeddings)"
_LABELLED = (
    "labelled AS (SELECT d.doc_id AS row_index, d.text AS raw, d.lang AS lang, e.embedding AS embedding, e.label AS cluster_id, "
    f"{_strip('d.text')} AS text FROM {_PAIRED})"
)
_JOB = (
    f"(SELECT *, {_key('text')} AS k FROM (SELECT 2 * e.vec_id AS id, d.text AS text, d.lang AS lang, e.embedding AS e FROM embeddings e "
    "LEFT JOIN documents d ON e.vec_id = d.doc_id UNION ALL SELECT 2 * e.vec_id + 1, NULL, d.lang, e.embedding FROM embeddings e "
    "JOIN documents d ON e.vec_id = d.doc_id WHERE d.lang = 'fr'))"
)
_TEXT_UNITS = f"SELECT id, e FROM (SELECT id, e, row_number() OVER (PARTITION BY k ORDER BY id) AS c FROM {_JOB} WHERE k <> '') WHERE c = 1"
_FIRST_BLANK = f"(SELECT min(id) FROM {_JOB} WHERE k = '')"


_CLEANED = (
    "SELECT *, row_number() OVER (ORDER BY id) - 1 AS n, row_number() OVER (PARTITION BY k ORDER BY id) AS c "
    f"FROM {_JOB} WHERE ({_reason('text')}) IS NULL"
)
# Labels as clusters, numbered by their first vector.
_FIRSTS = "SELECT vec_id AS row_index, min(vec_id) OVER (PARTITION BY coalesce(label, 15)) AS first FROM embeddings"
_GROUP = "dense_rank() OVER (ORDER BY first) - 1"


def _tokens(x: str) -> str:
    return f"list_filter(regexp_extract_all({_key(x)}, '[A-Za-z0-9_]+'), lambda t: length(t) >= 2)"


def _facts_sql(rows: str) -> str:
    """Cluster facts of ``rows`` (row_index, text, embedding, cluster_id)."""
    return (
        f"sizes AS (SELECT cluster_id, count(*) AS cluster_size FROM {rows} GROUP BY 1), "
        f"flat AS (SELECT row_index, cluster_id, generate_subscripts(embedding, 1) AS i, unnest(embedding) AS x FROM {rows}), "
        "center AS (SELECT cluster_id, i, avg(CAST(x AS DOUBLE)) AS m FROM flat GROUP BY 1, 2), "
        "norm AS (SELECT cluster_id, sqrt(sum(m * m)) AS len FROM center GROUP BY 1), "
        "score AS (SELECT f.cluster_id, f.row_index, sum(f.x * c.m) / any_value(n.len) AS s FROM flat f "
        "JOIN center c ON f.cluster_id = c.cluster_id AND f.i = c.i JOIN norm n ON n.cluster_id = f.cluster_id GROUP BY 1, 2), "
        "rep AS (SELECT s.cluster_id, r.text AS representative_text FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY cluster_id ORDER BY s DESC, row_index) AS c FROM score) s JOIN {rows} r USING (row_index) WHERE c = 1), "
        f"toks AS (SELECT DISTINCT cluster_id, row_index, unnest({_tokens('text')}) AS token FROM {rows}), "
        "freq AS (SELECT cluster_id, token, count(*) AS n FROM toks GROUP BY 1, 2), "
        "ranked AS (SELECT f.cluster_id, token, row_number() OVER (PARTITION BY f.cluster_id ORDER BY n DESC, length(token) DESC, token) AS c "
        "FROM freq f JOIN sizes s USING (cluster_id) WHERE n >= least(2, cluster_size)), "
        "keywords AS (SELECT s.cluster_id, coalesce(string_agg(token, ', ' ORDER BY c), '') AS top_keywords FROM sizes s "
        "LEFT JOIN (SELECT * FROM ranked WHERE c <= 5) k USING (cluster_id) GROUP BY 1), "
        "facts AS (SELECT cluster_id, cluster_size, representative_text, top_keywords, "
        "CASE WHEN split_part(top_keywords, ', ', 1) <> '' AND NOT contains(representative_text, split_part(top_keywords, ', ', 1)) "
        "THEN split_part(top_keywords, ', ', 1) || ' | ' || representative_text "
        "WHEN representative_text <> '' THEN representative_text ELSE split_part(top_keywords, ', ', 1) END AS cluster_label "
        "FROM sizes JOIN rep USING (cluster_id) JOIN keywords USING (cluster_id))"
    )


_EXAMPLES = (
    "examples AS (SELECT cluster_id, string_agg(text, ' | ' ORDER BY c) AS example_texts FROM (SELECT cluster_id, text, "
    "row_number() OVER (PARTITION BY cluster_id ORDER BY row_index) AS c FROM labelled) WHERE c <= 3 GROUP BY 1)"
)


def oracle_sql() -> dict[str, str]:
    """The same results in DuckDB SQL, for every query that SQL can express."""
    first_key = "row_number() OVER (PARTITION BY k ORDER BY doc_id) = 1"
    matches = (
        "SELECT r.id AS row_index, q.id AS match, s FROM (SELECT r.id AS rid, q.id AS qid, "
        f"{_cos('r.e', 'q.e')} AS s, row_number() OVER (PARTITION BY r.id ORDER BY {_cos('r.e', 'q.e')} DESC, q.id) AS c "
        "FROM {rows} r JOIN reps q ON q.id < r.id WHERE r.id NOT IN (SELECT id FROM reps)) x "
        "JOIN {rows} r ON r.id = rid JOIN reps q ON q.id = qid WHERE c = 1"
    )
    dup_words = (
        f"WITH {_REASONS}, cleaned AS (SELECT doc_id, pos, text, row_number() OVER (ORDER BY doc_id, pos) - 1 AS row_index "
        f"FROM reasons WHERE reason IS NULL), keyed AS (SELECT *, {_key('text')} AS k FROM cleaned)"
    )
    return (llm_queries.oracle_sql() if llm_queries else {}) | {
        "clean_words": f"WITH {_REASONS} SELECT doc_id, pos, text FROM reasons WHERE reason IS NULL",
        "removed_words": f"WITH {_REASONS} SELECT doc_id, pos, text, reason AS removal_reason FROM reasons WHERE reason IS NOT NULL",
        "removal_reasons_by_document": f"WITH {_REASONS} SELECT doc_id, coalesce(reason, 'kept') AS reason, count(*) AS words FROM reasons GROUP BY 1, 2",
        "cleaning_stats_words": f"WITH {_REASONS} SELECT {_COUNTS} FROM reasons",
        "clean_documents": f"SELECT * FROM documents WHERE ({_reason('text')}) IS NULL",
        "cleaning_stats_tables": " UNION ALL ".join(
            f"SELECT '{n}' AS name, {_COUNTS} FROM (SELECT {_reason(c)} AS reason FROM {n})"
            for n, c in (("documents", "text"), ("conversations", "text"), ("benchmark", "text"), ("pages", "html"))
        ),
        "merged_cleaning_stats": f"WITH {_REASONS} SELECT {_COUNTS} FROM reasons",
        "dedup_keys": f"SELECT doc_id, {_key('text')} AS dedup_key FROM documents",
        "exact_dedup_documents": f"WITH {_KEYED} SELECT doc_id, text, lang, source, n_chars FROM keyed QUALIFY {first_key}",
        "exact_dedup_conversations": (
            f"SELECT conv_id, turn, role, text FROM conversations QUALIFY row_number() OVER (PARTITION BY {_key('text')} ORDER BY conv_id, turn) = 1"
        ),
        "exact_dedup_stats": (
            f"WITH {_KEYED} SELECT count(*) AS total_before, count(DISTINCT k) AS total_after, count(*) - count(DISTINCT k) AS duplicate_rows, "
            "count(DISTINCT k) AS unique_values, 'text' AS target_column, 'exact' AS dedupe_mode FROM keyed"
        ),
        "first_words": (
            f"WITH {_WORDS}, numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id, pos) - 1 AS row_index, {_key('text')} AS k FROM words) "
            "SELECT row_index, doc_id, pos, text FROM numbered QUALIFY row_number() OVER (PARTITION BY k ORDER BY row_index) = 1"
        ),
        "known_keys_dedup": (
            f"WITH {_KEYED} SELECT doc_id, text, lang, source, n_chars FROM keyed WHERE source IS DISTINCT FROM 'src0' AND k NOT IN "
            f"(SELECT k FROM keyed WHERE source = 'src0') QUALIFY {first_key}"
        ),
        "known_keys_stats": (
            f"WITH {_KEYED}, old AS (SELECT DISTINCT k FROM keyed WHERE source = 'src0'), new AS (SELECT k FROM keyed WHERE source IS DISTINCT FROM 'src0'), "
            "kept AS (SELECT count(DISTINCT k) AS n FROM new WHERE k NOT IN (SELECT k FROM old)) "
            "SELECT (SELECT count(*) FROM new) AS total_before, n AS total_after, (SELECT count(*) FROM new) - n AS duplicate_rows, "
            "n + (SELECT count(*) FROM old) AS unique_values, 'text' AS target_column, 'exact' AS dedupe_mode FROM kept"
        ),
        "row_index": "SELECT event_id, ts, user_id, row_number() OVER (ORDER BY ts DESC, event_id) - 1 AS row_index FROM events",
        "clean_then_dedup_words": f"{dup_words} SELECT row_index, doc_id, pos, text FROM keyed QUALIFY row_number() OVER (PARTITION BY k ORDER BY row_index) = 1",
        "clean_then_dedup_stats": (
            f"{dup_words} SELECT (SELECT count(*) FROM words) AS total_before, (SELECT count(*) FROM words) - count(*) AS total_removed, "
            "count(*) AS cleaned, count(*) - count(DISTINCT k) AS duplicate_rows, count(DISTINCT k) AS unique_values, count(DISTINCT k) AS total_after FROM keyed"
        ),
        "csv_round_trip": "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM documents",
        "csv_stream": "SELECT * FROM documents",
        "csv_stream_blank_lines": "SELECT lang, count(*) AS documents FROM documents GROUP BY 1",
        "appended_table": "SELECT * FROM conversations",
        "row_counts": " UNION ALL ".join(
            f"SELECT '{n}' AS name, count(*) AS n_rows FROM {n}" for n in ("documents", "embeddings", "labels", "conversations")
        ),
        "run_metadata": (
            f"WITH {_REASONS} SELECT 'clean-deduplicate' AS action, 'documents.parquet' AS input_file, 'text' AS target_column, "
            f"count(*) FILTER (reason IS NULL) AS cleaned, count(DISTINCT {_key('text')}) AS unique_values FROM reasons"
        ),
        "target_alias": (
            f"WITH cleaned AS (SELECT doc_id, text, {_key('text')} AS k, row_number() OVER (ORDER BY doc_id) - 1 AS row_index FROM documents "
            f"WHERE ({_reason('text')}) IS NULL) SELECT row_index, doc_id, text AS question FROM cleaned "
            "QUALIFY row_number() OVER (PARTITION BY k ORDER BY row_index) = 1"
        ),
        "empty_input": (
            f"WITH reasons AS (SELECT {_reason('text')} AS reason FROM (SELECT text FROM documents WHERE ({_reason('text')}) IS NULL) c WHERE ({_reason('text')}) IS NOT NULL) "
            f"SELECT {_COUNTS}, CAST(0 AS BIGINT) AS duplicate_rows, CAST(0 AS BIGINT) AS unique_values, count(*) AS read_back FROM reasons"
        ),
        "csv_row_counts": " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n_rows FROM {n}" for n in ("documents", "conversations", "pages")),
        "written_matches": (
            f"WITH {_walk(_VECTOR_ROWS)}, m AS ({matches.format(rows='numbered')}) SELECT row_index, match AS duplicate_of_row_index, "
            "CAST(row_index AS VARCHAR) AS text, CAST(match AS VARCHAR) AS matched_text, CAST(a.label AS BIGINT) AS label, CAST(b.label AS BIGINT) AS matched_label, "
            "round(s, 6) AS similarity FROM m JOIN embeddings a ON a.vec_id = row_index JOIN embeddings b ON b.vec_id = match"
        ),
        "clean_then_semantic_dedup": (
            f"WITH {_walk(f'SELECT n AS id, e FROM ({_CLEANED}) WHERE c = 1')} SELECT n AS row_index, lang FROM ({_CLEANED}) WHERE n IN (SELECT id FROM reps)"
        ),
        "kmeans_groups": f"SELECT row_index, CAST({_GROUP} AS INTEGER) AS cluster_id FROM ({_FIRSTS})",
        "hdbscan_groups": f"SELECT row_index, CAST({_GROUP} AS BIGINT) AS cluster_id FROM ({_FIRSTS})",
        "projection_radii": (
            "WITH v AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings), "
            "m AS (SELECT avg(x) AS mx, avg(y) AS my, avg(z) AS mz FROM v) "
            "SELECT vec_id AS row_index, round(sqrt((x - mx) ** 2 + (y - my) ** 2 + (z - mz) ** 2), 3) AS radius, true AS uncorrelated, true AS falling FROM v, m"
        ),
        "normalized_vectors": (
            f"WITH d AS (SELECT vec_id, embedding, sqrt({_dot('embedding', 'embedding')}) AS len FROM embeddings) "
            f"SELECT vec_id, round({_dot('embedding', 'embedding')} / (len * len), 6) AS squared_norm, "
            "round(CAST(embedding[1] AS DOUBLE) / len, 6) AS first_value FROM d"
        ),
        "inner_products": (
            f"SELECT a.vec_id, round({_dot('a.embedding', 'b.embedding')}, 6) AS similarity FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"
        ),
        **dict.fromkeys(("similar_pairs", "similar_pairs_approx", "similar_pairs_cells"), (
            f"SELECT a.vec_id AS left_id, b.vec_id AS right_id, round({_cos('a.embedding', 'b.embedding')}, 6) AS similarity "
            f"FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE {_cos('a.embedding', 'b.embedding')} >= {SIMILAR}"
        )),
        "similar_classes": (
            "WITH v AS (SELECT 4 * vec_id + k AS id, list_transform(list_zip(embedding, range(1, len(embedding) + 1)), "
            "lambda p: CAST(p[1] AS DOUBLE) * CASE WHEN p[2] = k THEN 1.5 ELSE 1 END) AS e FROM embeddings, range(4) t(k)), "
            "u AS MATERIALIZED (SELECT id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS u FROM v) "
            "SELECT a.id AS row_index, CAST(count(*) - 1 AS BIGINT) AS n_links FROM u a JOIN u b "
            f"ON list_dot_product(a.u, b.u) >= {SIMILAR_COPIES} GROUP BY 1"
        ),
        **dict.fromkeys(("top_k_neighbors", "top_k_cells"), (
            f"WITH s AS (SELECT a.vec_id AS query_id, b.vec_id AS match_id, {_cos('a.embedding', 'b.embedding')} AS sim FROM embeddings a, embeddings b), "
            "r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, match_id) AS INTEGER) AS rank FROM s) "
            "SELECT query_id, match_id, round(sim, 6) AS similarity, rank FROM r WHERE rank <= 5"
        )),
        "encoded_documents": "SELECT doc_id, 1024 AS dimensions, CAST(1.0 AS DOUBLE) AS squared_norm, count(*) OVER (PARTITION BY text) AS copies FROM documents",
        **dict.fromkeys(("semantic_dedup_vectors", "semantic_dedup_approx", "semantic_dedup_cells"), (
            f"WITH {_walk(_VECTOR_ROWS)} SELECT vec_id AS row_index, label FROM embeddings WHERE vec_id IN (SELECT id FROM reps)"
        )),
        "semantic_matches": (
            f"WITH {_walk(_VECTOR_ROWS)}, m AS ({matches.format(rows='numbered')}) SELECT row_index, match AS duplicate_of_row_index, "
            "CAST(row_index AS VARCHAR) AS text, CAST(match AS VARCHAR) AS matched_text, a.label AS label, b.label AS matched_label, "
            "a.label = b.label AS same_label, round(s, 6) AS similarity FROM m JOIN embeddings a ON a.vec_id = row_index JOIN embeddings b ON b.vec_id = match"
        ),
        "semantic_stats": (
            f"WITH {_walk(_VECTOR_ROWS)} SELECT (SELECT count(*) FROM embeddings) AS total_before, count(*) AS total_after, "
            "(SELECT count(*) FROM embeddings) - count(*) AS duplicate_rows, count(*) AS unique_values, 'text' AS target_column, "
            f"'semantic' AS dedupe_mode, CAST({SIMILAR} AS DOUBLE) AS semantic_threshold FROM reps"
        ),
        "semantic_dedup_texts": (
            f"WITH {_walk(_TEXT_UNITS)} SELECT id AS row_index, lang FROM {_JOB} WHERE id IN (SELECT id FROM reps) OR id = {_FIRST_BLANK}"
        ),
        "semantic_matches_texts": (
            f"WITH {_walk(_TEXT_UNITS)}, job AS {_JOB}, rows AS (SELECT id, first_value(e) OVER (PARTITION BY k ORDER BY id) AS e FROM job WHERE k <> ''), "
            f"m AS ({matches.format(rows='rows')}), "
            f"blank AS (SELECT id AS row_index, {_FIRST_BLANK} AS match, CAST(1.0 AS DOUBLE) AS s FROM job WHERE k = '') "
            "SELECT row_index, match AS duplicate_of_row_index, a.lang AS lang, b.lang AS matched_lang, coalesce(a.lang = b.lang, false) AS same_lang, "
            "round(s, 6) AS similarity FROM (SELECT * FROM m UNION ALL SELECT * FROM blank WHERE row_index > match) x "
            "JOIN job a ON a.id = row_index JOIN job b ON b.id = match"
        ),
        "semantic_dedup_two_parts": (
            f"WITH {_walk('SELECT row_number() OVER (ORDER BY label, vec_id) - 1 AS id, embedding AS e FROM embeddings')}, "
            "o AS (SELECT vec_id, row_number() OVER (ORDER BY label, vec_id) - 1 AS row_index FROM embeddings) "
            "SELECT row_index, vec_id FROM o WHERE row_index IN (SELECT id FROM reps)"
        ),
        "cluster_sizes": f"WITH {_LABELLED} SELECT cluster_id, count(*) AS cluster_size FROM labelled GROUP BY 1",
        "cluster_representatives": f"WITH {_LABELLED}, {_facts_sql('labelled')} SELECT cluster_id, representative_text FROM facts",
        "cluster_keywords": f"WITH {_LABELLED}, {_facts_sql('labelled')} SELECT cluster_id, top_keywords FROM facts",
        "token_counts": f"SELECT token, count(*) AS uses FROM (SELECT unnest({_tokens('text')}) AS token FROM documents) GROUP BY 1",
        "cluster_rule_labels": f"WITH {_LABELLED}, {_facts_sql('labelled')} SELECT cluster_id, cluster_label FROM facts",
        "cluster_label_context": (
            f"WITH {_LABELLED}, {_facts_sql('labelled')}, others AS (SELECT l.cluster_id, l.text, min(row_index) AS f FROM labelled l JOIN facts USING (cluster_id) "
            "WHERE l.text <> representative_text GROUP BY 1, 2), "
            "few AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY f) AS c FROM others), "
            "every AS (SELECT cluster_id, representative_text AS text, 0 AS c FROM facts UNION ALL SELECT cluster_id, text, c FROM few WHERE c < 8), "
            "samples AS (SELECT cluster_id, string_agg(text, '\n--\n' ORDER BY c) AS samples, string_agg('- ' || text, '\n' ORDER BY c) AS listed FROM every GROUP BY 1) "
            "SELECT cluster_id, cluster_size, CAST(len(string_split(top_keywords, ', ')) AS INTEGER) AS keywords, samples, "
            "'簇编号：' || cluster_id || '\n簇大小：' || cluster_size || '\n代表问题：' || representative_text || '\n高频关键词：' || replace(top_keywords, ', ', '、') "
            "|| '\n示例问题：\n' || listed AS prompt FROM facts JOIN samples USING (cluster_id)"
        ),
        "cluster_summary": (
            f"WITH {_LABELLED}, {_facts_sql('labelled')}, {_EXAMPLES} SELECT cluster_id, cluster_size, cluster_label, top_keywords, representative_text, example_texts "
            "FROM facts JOIN examples USING (cluster_id) ORDER BY cluster_size DESC, cluster_id"
        ),
        "clustering_stats": (
            f"WITH {_LABELLED}, g AS (SELECT cluster_id, count(*) AS n FROM labelled GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS total_before, "
            "CAST(sum(n) AS BIGINT) AS total_clustered, count(*) AS cluster_count, CAST(0 AS BIGINT) AS noise_rows, max(n) AS largest_cluster_size, "
            "min(n) AS smallest_cluster_size, avg(n) AS average_cluster_size FROM g"
        ),
        "cluster_analysis": (
            f"WITH {_LABELLED}, {_facts_sql('labelled')} SELECT row_number() OVER (ORDER BY cluster_size DESC, cluster_id) AS cluster_rank, cluster_id, cluster_size, "
            "round_even(cluster_size / (SELECT sum(cluster_size) FROM sizes), 4) AS cluster_ratio, cluster_label, top_keywords, representative_text FROM facts"
        ),
        "clustered_rows": (
            f"WITH {_LABELLED}, placed AS (SELECT * REPLACE (2 * row_index AS row_index) FROM labelled WHERE text <> ''), {_facts_sql('placed')} "
            "SELECT row_index, CAST(l.cluster_id AS BIGINT) AS cluster_id, false AS is_noise, cluster_size, cluster_label FROM placed l JOIN facts USING (cluster_id) "
            "UNION ALL SELECT 2 * row_index, CAST(-1 AS BIGINT), true, CAST(1 AS BIGINT), '' FROM labelled WHERE text = '' "
            "UNION ALL SELECT 2 * row_index + 1, CAST(-1 AS BIGINT), true, CAST(1 AS BIGINT), '' FROM labelled WHERE lang = 'fr'"
        ),
        "normalized_labels": (
            "SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace("
            f"{_strip('text')}, '(?s)\\n.*$', ''), '^[\\s\"''“”‘’]+|[\\s\"''“”‘’]+$', '', 'g'), '^[0-9]+[.)、:\\-]\\s*', ''), '^(标签|主题)[:：]\\s*', ''), "
            "' .,!?:;，。！？；：') AS label FROM documents"
        ),
        "core_distances": (
            f"WITH s AS (SELECT a.vec_id AS q, b.vec_id AS m, CASE WHEN a.vec_id = b.vec_id THEN 0 ELSE sqrt(greatest(2 - 2 * {_cos('a.embedding', 'b.embedding')}, 0)) END AS d FROM embeddings a, embeddings b) "
            "SELECT q AS row_index, round(d, 6) AS core_distance FROM s QUALIFY row_number() OVER (PARTITION BY q ORDER BY d, m) = 5"
        ),
        "prompts": (
            f"SELECT conv_id, turn, '系统指令：Answer briefly.\n\n用户输入：' || {_strip('text')} || '\n\n助手：' AS prompt FROM conversations"
        ),
        "scored_rows": (
            f"SELECT doc_id, '  ' || lower({_strip('text')}) || ' ' AS answer, (CASE WHEN quality = 1 THEN {_key('text')} ELSE {_key('lang')} END) = {_key('text')} AS matches "
            "FROM documents LEFT JOIN labels USING (doc_id)"
        ),
        "evaluation_stats": (
            f"SELECT count(*) AS total_rows, count(*) FILTER (quality = 1 OR {_key('lang')} = {_key('text')}) AS matched_expected_count, true AS has_expected_result "
            "FROM documents LEFT JOIN labels USING (doc_id)"
        ),
        "clean_stream": f"WITH {_REASONS} SELECT doc_id, pos, text FROM reasons WHERE reason IS NULL",
        "cleaning_stats_stream": f"WITH {_REASONS} SELECT {_COUNTS} FROM reasons",
        "dedup_stream": f"WITH {_KEYED} SELECT doc_id, text, lang, source, n_chars FROM keyed QUALIFY {first_key}",
        "dedup_stream_state": f"SELECT DISTINCT {_key('text')} AS dedup_key FROM documents",
        "dedup_stream_watermark": "SELECT DISTINCT event_type || ' ' || user_id AS text FROM events",
        **dict.fromkeys(
            ("semantic_dedup_stream", "semantic_dedup_indexed_stream"),
            f"WITH {_walk(_VECTOR_ROWS)} SELECT vec_id, label FROM reps JOIN embeddings ON vec_id = id",
        ),
    }
