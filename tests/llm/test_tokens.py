import hashlib
import random
import zlib

import numpy as np
from helpers import by_id, clashing, empty
from tokenizers import Tokenizer

from corpusprep.llm import bpe, pretokens, queries, tokenfiles


def library(texts):
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    coded = [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    return coded, [tokenizer.decode(ids, skip_special_tokens=False) for ids in coded]


def test_encoding_equals_the_library(spark, odd, sample):
    rng = random.Random(1)
    letters = "  \n\t'strevmld abc1!é　東 \x1c\x85\U0001F600"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["<|endoftext|>a <|endoftext|> <|endoftext|>", "aaaaaaaaaaaaaaaa", "'s't're've'm'll'd ''s 's", "a" * 5000]
    mixed = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for docs in (mixed, odd, sample):
        rows = docs.collect()
        ids, texts = library([r.text for r in rows])
        got = by_id((r.doc_id, r.ids, r.decoded) for r in bpe.encode(docs, queries.tokenizer_path(), decoded=True).collect())
        assert got == by_id((r.doc_id, i, t) for r, i, t in zip(rows, ids, texts))


def test_decoding_of_broken_characters(spark):
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    lists = [[k] for k in range(300)] + [None, [], [50256, 10, 235, 201]]
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(lists)], "doc_id bigint, ids array<int>")
    got = {r.doc_id: r.text for r in bpe.decode(rows, queries.tokenizer_path()).collect()}
    assert got == {k: None if v is None else tokenizer.decode(v, skip_special_tokens=False) for k, v in enumerate(lists)}


def test_worker_cache_may_start_anew():
    index = bpe.PairIndex(queries.tokenizer_path())
    words = pretokens.WordCodes(index.encode_words, remembered=3)
    for text in ("one two three four five", "six one seven", "eight nine ten one"):
        data = np.frombuffer(text.encode(), np.uint8)
        ids, counts = words.texts(data, np.array([0, len(data)]), ())
        assert ids.tolist() == library([text])[0][0] and counts.tolist() == [len(ids)]


def test_words_with_one_hash_keep_their_ids():
    """A polynomial hash modulo 2^64 gives one key to words built for that; their ids differ."""
    text = "acfaedaaafaahaaa\ngaaiaajdcadeaecb"
    data = np.frombuffer(text.encode(), np.uint8)
    keys = pretokens.word_hashes(data, np.array([0, 17]), np.array([16, 33]))
    assert keys[0] == keys[1]
    # Thue-Morse words and their opposites collide for any multiplier; so do words made of them.
    a, b = "a", "b"
    while len(a) < 2048:
        a, b = a + b, b + a
    rng = random.Random(11)
    texts = [text, a, b, a + " " + b, text + " gaaiaajdcadeaecb acfaedaaafaahaaa"]
    pair = text.split("\n")
    texts += [" ".join("".join(rng.choice(pair) for _ in range(rng.randint(1, 3))) for _ in range(20)) for _ in range(500)]
    want, _ = library(texts)
    index = bpe.PairIndex(queries.tokenizer_path())
    for words in (pretokens.WordCodes(index.encode_words), tokenfiles._encoder(queries.tokenizer_path())[0]):
        for low in range(0, len(texts), 100):
            part = [t.encode() for t in texts[low : low + 100]]
            flat, counts = words.texts(np.frombuffer(b"".join(part), np.uint8), np.cumsum([0] + [len(t) for t in part]), ())
            assert [p.tolist() for p in np.split(flat, np.cumsum(counts)[:-1])] == want[low : low + 100]
        assert words.collided


def test_every_hash_may_collide(monkeypatch):
    """With one hash for all words the bytes alone decide."""
    monkeypatch.setattr(pretokens, "word_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    rng = random.Random(12)
    texts = [" ".join("".join(rng.choice("abé") for _ in range(rng.randint(1, 90))) for _ in range(30)) for _ in range(60)]
    want, _ = library(texts)
    words = pretokens.WordCodes(bpe.PairIndex(queries.tokenizer_path()).encode_words)
    raw = [t.encode() for t in texts]
    flat, counts = words.texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(t) for t in raw]), ())
    assert [p.tolist() for p in np.split(flat, np.cumsum(counts)[:-1])] == want


def test_files_hold_any_ids():
    rng = np.random.default_rng(2)
    for size in (0, 1, 7, 511, 512, 513, 5000):
        ids = rng.choice([0, 5, 255, 256, 65535, 65536, 2**32 - 1], size).astype(np.uint32)
        starts = np.sort(rng.integers(0, size + 1, 4))
        starts[0] = 0
        file = tokenfiles.TokenFile(tokenfiles.pack(ids, starts, [3, None, -5, 9]))
        assert file.names == [3, None, -5, 9] and file.range(0, size).tolist() == ids.tolist()
        assert [file.token(k) for k in range(size)] == ids.tolist()
        for low, high in ((0, size // 2), (size // 3, size), (size // 2, size // 2)):
            assert file.range(low, high).tolist() == ids[low:high].tolist()


def test_token_files_equal_the_library(spark, odd, sample, tmp_path):
    for k, docs in enumerate((clashing(odd), sample)):
        rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
        ids, _ = library([r.text for r in rows])
        folder = str(tmp_path / str(k))
        manifest = tokenfiles.write_token_files(docs, queries.tokenizer_path(), folder, file_tokens=500)
        assert manifest.count() > 1
        read = sorted(tokenfiles.read_token_files(manifest).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in read] == [r.doc_id for r in rows]
        assert [np.frombuffer(r.ids, "<u4").tolist() for r in read] == [i + [2] for i in ids]
        assert [r.start for r in read] == np.cumsum([0] + [len(i) + 1 for i in ids])[:-1].tolist()


def test_empty_tables(spark):
    assert bpe.encode(empty(spark), queries.tokenizer_path(), decoded=True).count() == 0
    assert tokenfiles.token_files(empty(spark), queries.tokenizer_path()).count() == 0


def test_queries(spark):
    sf = "/root/testdata/sf0.001"
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda r: r.doc_id)
    ids, texts = library([r.text for r in docs])
    got = by_id(queries.op10_bpe(spark, sf).collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == by_id((r.doc_id, len(i), sha(",".join(map(str, i))), sha(t)) for r, i, t in zip(docs, ids, texts))
    got = sorted(queries.op3_token_files(spark, sf).collect(), key=lambda r: r.doc_id)
    assert [r.ids_crc32 for r in got] == [zlib.crc32(np.array(i + [2], "<u4").tobytes()) for i in ids]
