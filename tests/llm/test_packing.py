import bisect
import random
import zlib

import numpy as np
import pytest
from helpers import clashing, empty
from tokenizers import Tokenizer

from corpusprep.llm import packing, queries, wordtokens

PATH = queries.tokenizer_path(queries.WORD_TOKENIZER)


def library(texts):
    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def best_fit(lengths, capacity):
    """Sequences of best fit by falling length, one piece after the other."""
    gaps, count = [], 0
    for length in sorted(lengths, reverse=True):
        k = bisect.bisect_left(gaps, length)
        if k == len(gaps):
            count += 1
            gap = capacity
        else:
            gap = gaps.pop(k)
        if gap > length:
            bisect.insort(gaps, gap - length)
    return count


def test_ids_equal_the_library():
    rng = random.Random(1)
    letters = "  \n\t'strevmldTSREVM abc1!é　東½²Ⅷ \x1c\x1f\x85\xa0​\U0001F600ΣİßÅéＡ<|"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(5000)]
    texts += ["<|endoftext|>a <|startoftext|> <|ENDOFTEXT|>", "'s't're've'm'll'd ''s 's a's'S", "áͅ", "x" * 5000, "", " "]
    flat, counts = wordtokens.WordTokens(PATH).ids(texts)
    assert [p.tolist() for p in np.split(flat, np.cumsum(counts)[:-1])] == library(texts)


def test_brackets_meet_as_on_a_stack():
    rng = random.Random(2)
    for _ in range(300):
        opens = np.array([rng.random() < 0.5 for _ in range(rng.randint(1, 40))])
        stack, want = [], set()
        for k, is_open in enumerate(opens):
            if is_open:
                stack.append(k)
            elif stack:
                want.add((stack.pop(), k))
        assert set(zip(*(x.tolist() for x in packing.match_brackets(opens)))) == want
        # The same in parts: those left over meet by their ranks.
        got, counts, free, waiting = set(), [], {}, {}
        cuts = sorted(rng.sample(range(len(opens) + 1), min(3, len(opens))))
        for part, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(opens)])):
            left, right = (x + a for x in packing.match_brackets(opens[a:b]))
            got |= set(zip(left.tolist(), right.tolist()))
            alone = [k for k in range(a, b) if k not in left and k not in right]
            waiting[part], free[part] = [k for k in alone if opens[k]], [k for k in alone if not opens[k]]
            counts.append((part, len(waiting[part]), len(free[part])))
        for first, p, low_piece, g, low_gap, number in packing.meeting_ranks(counts):
            got |= {(waiting[p][low_piece + number - 1 - k], free[g][low_gap + k]) for k in range(number)}
        assert got == want


def check(rows, capacity):
    """Pieces lie gapless from 0, none twice, no sequence too long. Returns their number."""
    sequences = {}
    for key, length, sequence, offset in rows:
        sequences.setdefault(sequence, []).append((offset, length))
    for pieces in sequences.values():
        ends = np.cumsum([0] + [length for _, length in sorted(pieces)])
        assert [o for o, _ in sorted(pieces)] == ends[:-1].tolist() and ends[-1] <= capacity
    return len(sequences)


@pytest.mark.parametrize("sweep", [200_000, 300])
@pytest.mark.parametrize("kind", ["tiny", "same", "uneven", "small capacity"])
def test_as_few_sequences_as_sequential_best_fit(spark, monkeypatch, sweep, kind):
    monkeypatch.setattr(packing, "SWEEP_ROWS", sweep)
    rng = np.random.default_rng(3)
    capacity = 10 if kind == "small capacity" else 2048
    lengths = {
        "tiny": lambda: rng.integers(1, 40, 1500),
        "same": lambda: np.full(900, 700),
        "uneven": lambda: np.clip(rng.lognormal(5.5, 1.3, 1500), 1, 2048).astype(int),
        "small capacity": lambda: rng.integers(1, 11, 900),
    }[kind]().tolist()
    rows = spark.createDataFrame(list(enumerate(lengths)), "key bigint, length bigint")
    got = [(r.key, lengths[r.key], r.sequence_id, r.offset) for r in packing.pack(rows, capacity).collect()]
    assert sorted(r[0] for r in got) == list(range(len(lengths)))
    assert check(got, capacity) <= best_fit(lengths, capacity) * 1.01 + 1


def test_pieces_and_query(spark, odd):
    docs = clashing(odd)
    cut = packing.write_pieces(docs, PATH, capacity=50)
    rows = packing.packed(cut, 50).collect()
    want = []
    for r in odd.collect():
        ids = [*library([r.text])[0], 0]
        want += [(r.doc_id, k // 50, k, ids[k : k + 50]) for k in range(0, len(ids), 50)]
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[3])
    got = [(r.doc_id, r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in rows]
    assert sorted(got, key=order) == sorted(want, key=order)
    check([(k, r.length, r.sequence_id, r.offset) for k, r in enumerate(rows)], 50)
    sf = "/root/testdata/sf0.001"
    read = spark.read.parquet(f"{sf}/documents.parquet").collect()
    docs = {r.doc_id: [*i, 0] for r, i in zip(read, library([r.text for r in read]))}
    rows = queries.op11_packing(spark, sf).collect()
    assert len(rows) == sum(-(-len(i) // 2048) for i in docs.values())
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(docs[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()) and r.start == r.piece * 2048
    lengths = [r.length for r in rows]
    assert check([(k, r.length, r.sequence_id, r.offset) for k, r in enumerate(rows)], 2048) <= best_fit(lengths, 2048) * 1.01 + 1


def test_empty_table(spark):
    assert packing.packed(packing.write_pieces(empty(spark), PATH)).count() == 0
