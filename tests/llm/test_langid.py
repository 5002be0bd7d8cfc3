import random

from helpers import by_id, clashing, empty

from corpusprep.llm import langid, queries


def phrases(text, sample):
    """Greedy longest matches by plain search, in blocks."""
    symbols, base = langid.fold(text).tolist(), langid.fold(sample).tolist()
    inside = {tuple(base[i:j]) for i in range(len(base)) for j in range(i + 1, len(base) + 1)}
    count = 0
    for low in range(0, len(symbols), langid.BLOCK):
        block, at = symbols[low : low + langid.BLOCK], 0
        while at < len(block):
            size = 0
            while at + size < len(block) and tuple(block[at : at + size + 1]) in inside:
                size += 1
            at += max(1, size)
            count += 1
    return count, len(symbols)


def test_phrases_equal_a_plain_search():
    import numpy as np

    rng = random.Random(3)
    samples = (("a", "abracadabra abba cab"), ("b", "xyzzy yxzy bazz"))
    parser = langid.Parser(samples)
    texts = ["".join(rng.choice("abcxyz !") for _ in range(rng.randint(1, 60))) for _ in range(60)] + ["ab" * 900, "", "?!"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    costs, letters = parser.costs(data, np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    for k, text in enumerate(texts):
        assert letters[k] == sum(c.isalpha() for c in text)
        for j, (_, sample) in enumerate(samples):
            count, size = phrases(text, sample)
            bits = np.log2(len(langid.fold(sample)))
            assert abs(costs[k, j] - count * bits / max(size, 1)) < 1e-9


def test_letters_are_never_put_together():
    """Thousands of letters, and languages that differ in rare ones only."""
    import numpy as np

    rng = random.Random(5)
    pools = [[chr(0x4E00 + k) for k in range(low, 4000, 2)] for low in (0, 1)]
    samples = tuple((lang, "".join(rng.choice(pool) for _ in range(8000))) for lang, pool in zip("ab", pools))
    parser = langid.Parser(samples)
    assert parser.alphabet > 3900
    texts = [samples[k % 2][1][100 * k : 100 * k + 40] for k in range(60)]
    raw = [t.encode() for t in texts]
    costs, _ = parser.costs(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw]))
    assert costs.argmin(axis=1).tolist() == [k % 2 for k in range(60)]


def test_held_out_accuracy(spark):
    found = queries.op2_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id"
    ).filter("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in found) >= 0.98 * len(found) > 100


def test_odd_rows(spark, odd):
    samples = langid.fit(odd)
    assert [lang for lang, _ in samples] == ["de", "en", "fr"] and samples == langid.fit(odd)
    rows = {(r.doc_id, r.text): r for r in langid.identify(odd, samples).collect()}
    for key in ((1, None), (2, ""), (3, " \t\n "), (10, "!!! ??? 123")):
        assert (rows[key].lang_pred, rows[key].score, rows[key].bits) == ("und", 0.0, None)
    assert rows[(12, "two words")].lang_pred in ("de", "en", "fr")
    wide = langid.identify(clashing(odd), samples)
    assert by_id(wide.select("doc_id", "lang_pred").collect()) == by_id((r.doc_id, r.lang_pred) for r in langid.identify(odd, samples).collect())
    assert "__text" in wide.columns and wide.columns.count("score") == 1


def test_empty_tables_and_no_labels(spark, odd):
    assert langid.fit(empty(spark)) == () and langid.identify(empty(spark), ()).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, ()).collect()} == {"und"}
