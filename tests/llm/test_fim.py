import hashlib
import random
import re

import numpy as np
from helpers import by_id, clashing, empty
from pyspark.sql import functions as F

from corpusprep.llm import fim

TOKENS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def by_hand(doc_id, text):
    text = text or ""
    ends = [0] + [m.end() for m in TOKENS.finditer(text)]
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(ends) - 1
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[: ends[a]], text[ends[a] : ends[b]], text[ends[b] :]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts():
    rng = random.Random(5)
    pool = ["a", "bc", " ", "\n", "\t\x0b", "é東", "\U0001F600", "x" * 300, "<", "P>", "S>", "\x85", "<M"]
    rows = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    return rows + ["", None, "   ", "<P> marked", "a<S>", "<M>", "w " * 20_000, "y" * 70_000 + " z"]


def test_outputs_and_their_way_back(spark, odd):
    mixed = spark.createDataFrame(list(enumerate(texts())), "doc_id bigint, text string")
    for docs in (mixed, clashing(odd)):
        rows = docs.select("doc_id", "text").collect()
        made = fim.transform(docs).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
        assert by_id(r[:6] for r in made) == by_id(by_hand(r.doc_id, r.text) for r in rows)
        assert by_id((r.doc_id, r.back) for r in made) == by_id((r.doc_id, r.text or "") for r in rows)
    assert {r.form for r in fim.transform(mixed).collect()} == {"plain", "psm", "spm"}


def test_index_finds_every_boundary(spark):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id bigint, text string")
    for error in (0, 3, fim.ERROR):
        found = {r.doc_id: r for r in fim.rank_index(docs, error=error).collect()}
        for doc_id, text in enumerate(texts()):
            r = found[doc_id]
            ends = [0] + [m.end() for m in TOKENS.finditer(text or "")]
            residuals = np.frombuffer(r.residuals, np.int8)
            at = np.searchsorted(r.ranks, np.arange(len(ends)), "right") - 1
            line = np.array(r.offsets)[at] + np.rint(np.array(r.slopes)[at] * (np.arange(len(ends)) - np.array(r.ranks)[at]))
            assert r.n == len(ends) - 1 and (line + residuals).tolist() == ends and abs(residuals).max(initial=0) <= error + 1


def test_few_segments_for_even_text():
    data = np.frombuffer(b"word " * 5000, np.uint8)
    assert len(fim.fit(*fim.boundaries(data, np.array([0, len(data)]))).ranks) == 1


def test_empty_table(spark):
    assert fim.transform(empty(spark)).count() == 0 and fim.rank_index(empty(spark)).count() == 0
