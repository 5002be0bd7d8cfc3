from collections import Counter

from helpers import DOC_SCHEMA, by_id, empty
from test_simhash import fingerprint, roots
from test_tokens import library

import __spark_entry__ as entry
import corpus_pipeline
from corpusprep.llm import secrets, stages

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark, sample):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "simhash_dedup", "secret_scan", "mixing", "bpe"]
    found = stages.language_id(spark, sample, SF)
    assert found.schema.simpleString() == sample.schema.simpleString() and found.count() == sample.count()
    rows = sorted(found.collect(), key=lambda r: r.doc_id)
    label = roots([fingerprint(r.text) for r in rows], 2)
    single = stages.drop_near_copies(spark, found, SF)
    assert sorted(r.doc_id for r in single.collect()) == sorted({min(rows[j].doc_id for j in range(len(rows)) if label[j] == k) for k in label})
    clean = stages.redact_secrets(spark, single, SF)
    before = {r.doc_id: r for r in single.collect()}
    for r in clean.collect():
        assert (r.text == before[r.doc_id].text) == (not secrets.secret_spans(before[r.doc_id].text)) and r.n_chars == len(r.text)
    mixed = stages.mix_sources(spark, clean, SF)
    assert mixed.columns == sample.columns and max(Counter(r.doc_id for r in mixed.collect()).values()) <= 3
    coded = stages.encode_bpe(spark, mixed, SF).collect()
    texts = [(r.doc_id, r.text) for r in mixed.collect()]
    assert by_id((r.doc_id, r.ids) for r in coded) == by_id((i, ids) for (i, _), ids in zip(texts, library([t for _, t in texts])[0]))
    again = corpus_pipeline.run(spark, SF).collect()
    assert by_id(again) == by_id(coded)


def test_odd_rows(spark, odd, tmp_path):
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r.doc_id for r in rows}
    assert not ids & {1, 2, 3, 10} and len(ids & {11, 13}) <= 1 and all(r.n_tokens == len(r.ids) for r in rows)
    empty(spark, DOC_SCHEMA).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_rows_that_share_an_id_are_told_apart(spark):
    base = [" ".join(f"w{(k * 7 + j * j * k) % 97}" for j in range(40)) for k in range(4)]
    rows = [(1, base[0]), (1, base[1]), (2, base[1]), (None, base[2]), (None, base[2]), (3, base[2]), (None, base[3]), (4, None), (5, None)]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOC_SCHEMA)
    kept = by_id((r.doc_id, r.text) for r in stages.drop_near_copies(spark, docs, SF).collect())
    assert kept == by_id([(1, base[0]), (1, base[1]), (3, base[2]), (None, base[3]), (4, None)])


def test_registration():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op")} and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
