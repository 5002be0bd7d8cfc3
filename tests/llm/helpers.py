"""Rows that every operator has to take, and comparisons by plain Python."""

from __future__ import annotations

import random

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "the of and license general public cc by rights reserved all ñandú über été token = : word. x1 ( )".split()


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    rng = random.Random(4)
    long = " ".join(rng.choice(WORDS) for _ in range(30_000))
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n ", None, None, 4), (4, long, "en", "b", len(long)),
        (5, "x" * 50_000, "en", "b", 50_000), (6, "All rights reserved. CC-BY\nGeneral  Public-License", "en", "a", 1),
        (6, "All rights reserved. CC-BY\nGeneral  Public-License", "en", "a", 1), (7, "  two\twords ", None, "a", 3),
        (8, "Ｆｕｌｌ ½ 東京 \U0001F600 don't we'll  <|endoftext|> end", "fr", "c", 9), (9, "\x1c\x85  　", "fr", None, 2),
        (10, "!!! ??? 123", "en", "c", 3), (None, "no id", "en", "b", 5), (12, "two words", "en", None, 9),
        (11, "a b c", "de", "a", 5), (13, "A B C", "de", "a", 5),
    ]
    return rows


def clashing(df):
    """The same rows with further columns named like what operators add."""
    from pyspark.sql import functions as F

    names = ["ids", "spans", "lang_pred", "score", "bits", "row", "words", "hash", "size", "taken", "times", "fp", "component_id", "place", "members", "__text", "start", "part", "node", "label"]
    return df.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])


def empty(spark, schema=DOC_SCHEMA):
    return spark.createDataFrame([], schema)


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))
