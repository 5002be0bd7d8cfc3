import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from helpers import by_id, clashing, empty

from corpusprep.llm import queries, simhash
from corpusprep.operators.components import components


def fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, radius):
    values = np.array(values, np.uint64)
    label = np.arange(len(values))
    for k in range(len(values)):
        near = np.flatnonzero(np.bitwise_count(values ^ values[k]) <= radius)
        for old in np.unique(label[near]):
            label[label == old] = label[near].min()
    return label


def test_fingerprints(spark, odd):
    got = by_id((r.doc_id, r.fp & (1 << 64) - 1) for r in simhash.fingerprints(clashing(odd)).collect())
    assert got == by_id((r.doc_id, fingerprint(r.text)) for r in odd.collect())


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_near_lanes(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**64, 200, dtype=np.uint64)
    base[100:] = base[rng.integers(0, 3, 100)] ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64))
    stacked = simhash.planes(base)
    asked = np.repeat(base, len(stacked))
    word = np.tile(np.arange(len(stacked)), len(base))
    rows, lanes = simhash.near_lanes(stacked, word, asked, np.zeros(len(word), np.uint64), radius)
    found = {(r // len(stacked), word[r] * 64 + lane) for r, hit in zip(rows.tolist(), lanes.tolist()) for lane in range(64) if hit >> lane & 1}
    want = {(i, int(j)) for i in range(len(base)) for j in np.flatnonzero(np.bitwise_count(base ^ base[i]) <= radius)}
    assert {(i, j) for i, j in found if j < len(base)} == want


@pytest.mark.parametrize("tile", [16, 100, 1024])
def test_components_of_dense_groups(spark, tile):
    rng = np.random.default_rng(1)
    values = []
    for base in rng.integers(0, 2**63, 20):
        for _ in range(40):
            values.append(int(base) ^ 1 << int(rng.integers(64)) ^ (1 << int(rng.integers(64)) if rng.random() < 0.5 else 0))
    values += [values[0] ^ 1 << int(a) ^ 1 << int(b) for a, b in rng.integers(0, 64, (400, 2))]
    unique = np.sort(np.unique(np.array(values, np.uint64)).view(np.int64))
    found = {r.id: r.label for r in components(simhash.near_edges(spark.createDataFrame(pd.DataFrame({"fp": unique})), 2, tile)).collect()}
    want = unique[roots(unique.view(np.uint64), 2)]
    assert [found.get(int(v), int(v)) for v in unique] == want.tolist()


def test_odd_rows_and_query(spark, odd):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    prints = [fingerprint(r.text) for r in docs]
    label = roots(prints, 2)
    least = {k: min(docs[j].doc_id for j in np.flatnonzero(label == k)) for k in set(label)}
    got = by_id(queries.op6_simhash(spark, sf).collect())
    assert got == by_id((r.doc_id, f"{p:016x}", least[k]) for r, p, k in zip(docs, prints, label))
    near = {(r.doc_id, r.fp): r.component_id for r in simhash.near_duplicates(odd).collect()}
    assert near[(1, 0)] == near[(2, 0)] == near[(3, 0)] == 1
    assert len({v for (i, _), v in near.items() if i in (11, 13)}) == 1


def test_empty_tables(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
