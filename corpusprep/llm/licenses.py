"""License scans by diagonal voting.

Every run of ``k`` words of a text is hashed and joined to the same runs of license templates.
A match at word p of the text and word q of a template votes for the diagonal p - q: where the
template would start. Votes are added up by diagonal; neighbouring diagonals, which a few
inserted or missing words part, are merged; and a span counts if the runs it matched, whose
words are compared as they stand, cover enough of the template. Everything is a plan of
DataFrame operations; the templates' runs, some hundreds of rows, are the broadcast side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import id_and_text

# The words of a text, and the base phrases with their labels.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Opening or characteristic sentences of licenses, by label.
TEMPLATES = {
    "apache-2.0": (
        "licensed under the apache license version 2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
        "on an as is basis without warranties or conditions of any kind either express or implied",
    ),
    "mit": (
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    ),
    "gpl-3.0": (
        "general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later version",
    ),
    "gpl-2.0": ("general public license version 2",),
    "lgpl": ("gnu lesser general public license",),
    "agpl": ("gnu affero general public license",),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
        "licensed under the bsd license",
    ),
    "cc-by-nc": ("licensed under cc by nc 4.0", "creative commons attribution noncommercial 4.0 international license"),
    "cc-by-sa": ("licensed under cc by sa 4.0", "creative commons attribution sharealike 4.0 international license"),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2.0",),
    "public-domain": ("dedicated to the public domain", "cc0 1.0 universal public domain dedication"),
}

#: Words of a run.
RUN = 3
#: Diagonals no further apart than this are one span, in templates longer than a phrase.
SLACK = 3
#: Share of a template's runs that a span has to match.
COVER = 0.7


def template_runs(spark: SparkSession, templates: dict[str, tuple[str, ...]], base: dict[str, str], run: int = RUN) -> DataFrame:
    """``template, label, base, offset, runs, k, words, hash``: each run of each template.

    A template of fewer words than ``run`` is one run of its own length.
    """
    rows = []
    named = [(label, phrase, True) for phrase, label in base.items()]
    named += [(label, text, False) for label, texts in templates.items() for text in texts]
    for number, (label, text, is_base) in enumerate(named):
        words = text.lower().replace(".", " ").replace("-", " ").split()
        k = min(run, len(words))
        rows += [(number, label, is_base, at, len(words) - k + 1, k, words[at : at + k]) for at in range(len(words) - k + 1)]
    schema = "template int, label string, base boolean, offset int, runs int, k int, words array<string>"
    return spark.createDataFrame(rows, schema).withColumn("hash", F.xxhash64("k", *[F.get("words", F.lit(j)) for j in range(run)]))


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, SEPARATORS), lambda w: w != "")


def _run_hashes(words: Column, k: int, run: int) -> Column:
    """Hashes of all runs of ``k`` words, in order."""
    heads = F.slice(words, 1, F.greatest(F.size(words) - (k - 1), F.lit(0)))
    empty = F.lit(None).cast("string")
    return F.transform(
        heads,
        lambda w, at: F.xxhash64(F.lit(k), w, *[F.get(words, at + j) for j in range(1, k)], *[empty] * (run - k)),
    )


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, base: dict[str, str] = BASE,
         id_col: str = "doc_id", text_col: str = "text", run: int = RUN, slack: int = SLACK, cover: float = COVER) -> DataFrame:
    """``doc_id, n_words, spans`` of every row, found in its whole text.

    A span is ``template, label, base, first, last, score``: the words it reaches from and to
    (numbered from 0) and the share of the template's runs it matches. Base phrases are found
    at all their places. Null and empty texts have no words and no spans; repeated rows are
    scanned row by row; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    grams = template_runs(spark, templates, base, run)
    lengths = sorted({min(run, len(t.replace(".", " ").replace("-", " ").split())) for t in [*base, *[t for ts in templates.values() for t in ts]]})
    # A row of its own stands for each document, so that those without a match are kept and
    # documents are read once: a template that matches before the first word. A hash that
    # happens to equal its own is told apart by the number of words compared.
    document = spark.createDataFrame([(-1, None, False, 0, 0, 0, [])], "template int, label string, base boolean, offset int, runs int, k int, words array<string>")
    grams = grams.unionByName(document.withColumn("hash", F.xxhash64(F.lit(-1)))).withColumnRenamed("words", "gram")
    # Rows of one document stay in one task up to the first shuffle; the number of the row
    # tells repeated rows apart.
    rows = id_and_text(docs, id_col, text_col).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("words")
    )
    hashed = rows.select(
        "row", "doc_id", "words",
        F.concat(F.array(F.xxhash64(F.lit(-1))), *[_run_hashes(F.col("words"), k, run) for k in lengths]).alias("hashes"),
    )
    # The hashes of each length follow each other: what an index is an index of.
    at = hashed.select("row", "doc_id", "words", F.posexplode_outer("hashes").alias("index", "hash"))
    joined = at.join(F.broadcast(grams), "hash")
    start: Column = F.lit(1)
    place = F.when(F.col("k") == 0, F.lit(0))
    for k in lengths:
        place = place.when(F.col("k") == k, F.col("index") - start)
        start = start + F.greatest(F.size("words") - (k - 1), F.lit(0))
    hits = joined.select("*", place.alias("place")).filter(F.slice("words", F.col("place") + 1, F.col("k")) == F.col("gram"))
    hits = hits.select("row", "doc_id", F.size("words").alias("n_words"), "template", "label", "base", "runs", "k", "offset", "place")
    votes = hits.groupBy("row", "doc_id", "n_words", "template", "label", "base", "runs", "k", (F.col("place") - F.col("offset")).alias("diagonal")).agg(
        F.min("place").alias("first"), F.max(F.col("place") + F.col("k") - 1).alias("last"), F.collect_set("offset").alias("offsets")
    )
    # Neighbouring diagonals of one template: a new span begins where the gap is too wide.
    by = Window.partitionBy("row", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(by)
    new = F.coalesce((gap > F.when(F.col("runs") > 1, slack).otherwise(0)), F.lit(True)).cast("int")
    numbered = votes.withColumn("new", new).withColumn("span", F.sum("new").over(by))
    spans = numbered.groupBy("row", "doc_id", "n_words", "template", "label", "base", "runs", "span").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.size(F.array_distinct(F.flatten(F.collect_list("offsets")))).alias("matched")
    )
    score = F.when(F.col("runs") > 0, F.col("matched") / F.col("runs"))
    verified = spans.withColumn("score", score).filter((F.col("template") < 0) | (F.col("score") >= cover))
    span = F.when(F.col("template") >= 0, F.struct("first", "last", "template", "label", "base", "score"))
    return verified.groupBy("row", "doc_id", "n_words").agg(F.array_sort(F.collect_list(span)).alias("spans")).drop("row")
