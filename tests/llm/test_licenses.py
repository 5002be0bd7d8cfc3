import re

import pandas as pd
from helpers import by_id, clashing, empty

from corpusprep.llm import licenses, queries


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def places(text):
    found = words(text)
    for phrase, label in licenses.BASE.items():
        want = phrase.split()
        yield from ((k, label) for k in range(len(found) - len(want) + 1) if found[k : k + len(want)] == want)


def test_base_places_equal_a_plain_search(spark, odd, sample):
    for docs in (odd, sample):
        got = by_id(
            (r.doc_id, r.n_words, sorted((s["first"], s["label"]) for s in r.spans if s["base"])) for r in licenses.scan(docs).collect()
        )
        want = by_id((r.doc_id, len(words(r.text)), sorted(places(r.text))) for r in docs.collect())
        assert got == want


def test_templates_with_inserted_and_missing_words(spark):
    text = licenses.TEMPLATES["mit"][2].split()
    cases = {1: text, 2: ["here"] * 9 + text[:8] + ["really"] + text[8:20] + text[21:], 3: text[:9], 4: text[:12] + ["x"] * 40 + text[12:14]}
    docs = spark.createDataFrame([(k, " ".join(v).upper()) for k, v in cases.items()], "doc_id bigint, text string")
    found = {r.doc_id: [s for s in r.spans if s["label"] == "mit"] for r in licenses.scan(docs).collect()}
    assert len(found[1]) == 1 and (found[1][0]["first"], found[1][0]["last"], found[1][0]["score"]) == (0, len(text) - 1, 1.0)
    assert len(found[2]) == 1 and found[2][0]["first"] == 9 and found[2][0]["score"] > 0.8
    assert not found[3] and not found[4]


def test_neighbouring_places_of_a_phrase_stay_apart(spark):
    docs = spark.createDataFrame([(1, "cc by cc by")], "doc_id bigint, text string")
    assert [s["first"] for s in licenses.scan(docs).first().spans] == [0, 2]


def test_clashing_names_and_empty_tables(spark, odd):
    assert licenses.scan(clashing(odd)).count() == odd.count()
    assert licenses.scan(empty(spark)).count() == 0


def test_query(spark):
    got = queries.op1_licenses(spark, "/root/testdata/sf0.001").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").toPandas()
    want = {i: sorted(places(t)) for i, t in zip(docs.doc_id, docs.text)}
    assert len(got) == len(docs)
    for r in got.itertuples():
        found = want[r.doc_id]
        assert r.n_base == len(found) and r.base_labels == ",".join(sorted({x for _, x in found}))
        assert (None if pd.isna(r.first_word) else r.first_word) == (found[0][0] if found else None)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
