"""SimHash near-duplicates with bit-sliced comparison.

A document's fingerprint has a bit set where more than half of its shingles' XXH64 hashes have
it. Distinct fingerprints are dealt to keys: 64 bits in ``radius + 2`` blocks, one key for each
pair of blocks, so that two fingerprints within the radius share a key. Within a key they are
compared bit-sliced: 64 of them stand vertically, one word per bit; the differences to a
fingerprint are added up bit by bit in carry-save counters for all 64 at once, and words whose
lanes have all passed the radius are abandoned. What a task finds it reduces to stars, one edge
per fingerprint, and components join the stars.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import id_and_text, local_roots, pieces, text_bytes, tidy
from corpusprep.operators.components import components
from corpusprep.operators.rows import cut_lineage

SEED = 42
#: Fingerprints of one key that are compared in one group; larger keys are cut into tiles.
TILE = 1024
#: Bytes of text hashed at a time.
PIECE = 2 << 20
#: Rows of a partition compared at a time.
ROWS = 1 << 16
#: Pairs of a fingerprint and a word of 64 others compared at a time.
WORDS = 1 << 18
#: Planes between two looks for words that can be abandoned.
STRIDE = 8


# --- fingerprints --------------------------------------------------------------------------


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (the 64 bits as bigint) of every whole text.

    A-Z are lower-cased; words are what stands between ASCII white space; ``words`` of them
    make a shingle, joined by blanks, repeats included. Fewer words are one shingle, no words
    (or a null text) fingerprint 0. Repeated rows are hashed row by row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            raw = memoryview(data)
            found = [
                _majorities([bytes(raw[a:b]) for a, b in zip(offsets[low:high].tolist(), offsets[low + 1 : high + 1].tolist())], words)
                for low, high in pieces(offsets, PIECE)
            ]
            values = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values.view(np.int64))], names=["doc_id", "fp"])

    return id_and_text(docs, id_col, text_col).mapInArrow(tidy(run), "doc_id bigint, fp bigint")


def _majorities(texts: list[bytes], words: int) -> np.ndarray:
    """Fingerprints of a few texts."""
    texts = [b" ".join(t.lower().split()) for t in texts]
    raw = b"\x20".join(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    blanks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 0x20)
    # Words are cut at blanks; an empty text between two blanks makes an empty word.
    starts, ends = np.concatenate([[0], blanks + 1]), np.append(blanks, len(raw))
    owner = np.searchsorted(begins, starts, "right") - 1
    real = ends > starts
    starts, ends, owner = starts[real], ends[real], owner[real]
    result = np.zeros(len(texts), np.uint64)
    if not len(starts):
        return result
    counts = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(counts) - counts
    place = np.arange(len(starts)) - first[owner]
    opens = (place <= counts[owner] - words) | (place == 0)
    starts, owner = starts[opens], owner[opens]
    last = np.minimum(np.flatnonzero(opens) + words - 1, (first + counts - 1)[owner])
    shingles = map(raw.__getitem__, map(slice, starts.tolist(), ends[last].tolist()))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(starts))
    totals = np.bincount(owner, minlength=len(texts))
    some = np.flatnonzero(totals)
    bounds = np.cumsum(totals[some]) - totals[some]
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    votes = np.add.reduceat(bits, bounds, axis=0, dtype=np.int32)
    major = np.packbits(votes * 2 > totals[some][:, None], axis=1, bitorder="little")
    result[some] = major.view("<u8").ravel()
    return result


# --- comparison ----------------------------------------------------------------------------


def planes(fps: np.ndarray) -> np.ndarray:
    """Fingerprints in words of 64 lanes: ``planes[w, b]`` has bit b of lane l at bit l."""
    padded = np.zeros(-(-len(fps) // 64) * 64, np.uint64)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")
    return np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little").reshape(-1, 64, 8).copy().view("<u8")[:, :, 0]


def near_lanes(words: np.ndarray, word: np.ndarray, fps: np.ndarray, barred: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Lanes within the radius of each fingerprint.

    Row r compares ``fps[r]`` with the 64 lanes of ``words[word[r]]``, except the lanes set in
    ``barred[r]``. Returns the rows that have such lanes, and the lanes as bits.
    """
    width = max(1, radius.bit_length())
    rows = np.arange(len(word))
    beyond = barred.copy()
    counters = [np.zeros(len(word), np.uint64) for _ in range(width)]

    def past() -> np.ndarray:
        """Lanes whose count is over the radius: compared from the highest counter down."""
        greater, equal = np.zeros(len(rows), np.uint64), np.full(len(rows), ~np.uint64(0))
        for k in reversed(range(width)):
            if radius >> k & 1:
                equal &= counters[k]
            else:
                greater |= equal & counters[k]
                equal &= ~counters[k]
        return beyond | greater

    # The bits of each block in turn, so that every key's other blocks come early.
    order = [b for k in range(16) for b in range(k, 64, 16)]
    for step, b in enumerate(order):
        same = np.uint64(0) - (fps >> np.uint64(b) & np.uint64(1))
        carry = words[word, b] ^ same
        for k in range(width):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        beyond |= carry
        if step % STRIDE == STRIDE - 1:
            alive = past() != ~np.uint64(0)
            if not alive.all():
                rows, word, fps, beyond = rows[alive], word[alive], fps[alive], beyond[alive]
                counters = [c[alive] for c in counters]
            if not len(rows):
                break
    return rows, ~past()


def _pairs(rows: np.ndarray, lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bits = np.unpackbits(lanes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, lane = np.nonzero(bits)
    return rows[row], lane


def group_roots(fps: np.ndarray, group: np.ndarray, tile: np.ndarray, crossed: np.ndarray, radius: int) -> np.ndarray:
    """The first row each row is connected to by near pairs inside its group.

    ``group`` numbers runs of rows. Where ``crossed``, only rows with different ``tile`` are
    compared.
    """
    sizes = np.bincount(group)
    begins = np.cumsum(sizes) - sizes
    left, right = [], []
    # Small groups share words of 64 lanes; none is cut by the end of a word.
    small = np.flatnonzero((sizes > 1) & (sizes <= 64))
    used, slots = 0, np.zeros(len(small), np.int64)
    for k, size in enumerate(sizes[small].tolist()):
        if used % 64 + size > 64:
            used += 64 - used % 64
        slots[k] = used
        used += size
    if len(small):
        counts = sizes[small]
        inner = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        member = np.repeat(begins[small], counts) + inner
        slot = np.repeat(slots, counts) + inner
        lanes = np.zeros(-(-used // 64) * 64, np.uint64)
        lanes[slot] = fps[member]
        at = np.full(len(lanes), -1)
        at[slot] = member
        # The lanes after a row's own up to the end of its group take part.
        one, end = (slot % 64 + 1).astype(np.uint64), np.repeat(slots + counts, counts) - slot // 64 * 64
        upto = np.where(end >= 64, ~np.uint64(0), (np.uint64(1) << (end % 64).astype(np.uint64)) - np.uint64(1))
        after = np.where(one >= 64, np.uint64(0), ~np.uint64(0) << (one % np.uint64(64)))
        stacked = planes(lanes)
        for low in range(0, len(member), WORDS):
            part = slice(low, low + WORDS)
            rows, hit = near_lanes(stacked, slot[part] // 64, fps[member[part]], ~(upto[part] & after[part]), radius)
            row, lane = _pairs(rows, hit)
            left.append(member[part][row])
            right.append(at[slot[part][row] // 64 * 64 + lane])
    for k in np.flatnonzero(sizes > 64):
        rows_ = np.arange(begins[k], begins[k] + sizes[k])
        if crossed[rows_[0]]:
            mine = tile[rows_] == tile[rows_].min()
            sides = (rows_[mine], rows_[~mine])
        else:
            sides = (rows_, rows_)
        stacked = planes(fps[sides[1]])
        bar = np.zeros(len(stacked), np.uint64)
        if len(sides[1]) % 64:
            bar[-1] = ~np.uint64(0) << np.uint64(len(sides[1]) % 64)
        step = max(1, WORDS // max(1, len(stacked)))
        for low in range(0, len(sides[0]) if len(stacked) else 0, step):
            asked = sides[0][low : low + step]
            word = np.tile(np.arange(len(stacked)), len(asked))
            rows, hit = near_lanes(stacked, word, np.repeat(fps[asked], len(stacked)), bar[word], radius)
            row, lane = _pairs(rows, hit)
            left.append(asked[row // len(stacked)])
            right.append(sides[1][word[row] * 64 + lane])
    if not left:
        return np.arange(len(fps))
    return local_roots(np.concatenate(left), np.concatenate(right), len(fps))


def near_edges(fps: DataFrame, radius: int = 2, tile: int = TILE) -> DataFrame:
    """``a, b``: edges that connect all distinct fingerprints (column ``fp``) within the radius."""
    blocks = radius + 2
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    masks = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(cuts, cuts[1:])]
    choices = [a | b for a, b in combinations(masks, 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in choices]
    keyed = fps.select(
        "fp",
        F.explode(F.array(*[F.struct(F.lit(k).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for k, m in enumerate(signed)])).alias("key"),
    ).select("fp", "key.choice", "key.bits")
    # Keys with more than a tile of fingerprints: at most rows / tile of them.
    large = keyed.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tile)
    large = large.select("choice", "bits", F.ceil(F.col("n") / (tile // 2)).cast("int").alias("tiles"))
    tiled = keyed.join(large, ["choice", "bits"], "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    mine = F.pmod(F.xxhash64("fp", F.lit(6)), F.col("tiles")).cast("int")
    met = tiled.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    placed = met.select(
        "choice", "bits", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "fp"
    )
    group = ["choice", "bits", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= ROWS:
                table = pa.Table.from_batches(held).combine_chunks()
                ready, rest = _split_last(table, group)
                held = rest.to_batches()
                if ready.num_rows:
                    yield from _group_edges(ready, group, radius)
        if held:
            yield from _group_edges(pa.Table.from_batches(held).combine_chunks(), group, radius)

    return placed.repartition(*group).sortWithinPartitions(*group).mapInArrow(tidy(run), "a bigint, b bigint")


def _changes(table: pa.Table, names: list[str]) -> np.ndarray:
    changed = np.zeros(table.num_rows, bool)
    for name in names:
        values = table.column(name).to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    return changed


def _split_last(table: pa.Table, names: list[str]) -> tuple[pa.Table, pa.Table]:
    """The rows before the last group, which may go on in the next batch, and that group."""
    last = int(np.max(np.flatnonzero(_changes(table, names)), initial=0))
    return table.slice(0, last), table.slice(last)


def _group_edges(table: pa.Table, names: list[str], radius: int) -> Iterator[pa.RecordBatch]:
    group = np.cumsum(_changes(table, names))
    fps = table.column("fp").to_numpy().view(np.uint64)
    low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
    roots = group_roots(fps, group, table.column("mine").to_numpy(), low != high, radius)
    moved = roots != np.arange(len(fps))
    yield pa.RecordBatch.from_arrays(
        [pa.array(fps[roots[moved]].view(np.int64)), pa.array(fps[moved].view(np.int64))], names=["a", "b"]
    )


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text",
                    tile: int = TILE) -> DataFrame:
    """``doc_id, fp, component_id`` of every row: the smallest id its fingerprint's links reach.

    Equal fingerprints are one node, so copies are never paired with each other. Null ids take
    part but are never the smallest unless a component has no other. An empty table gives an
    empty one.
    """
    marked = cut_lineage(fingerprints(docs, words, id_col, text_col), "fingerprints")
    distinct = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    # Written first, so that no task runs two Python steps, and two workers, at once.
    edges = cut_lineage(near_edges(distinct.select("fp"), radius, tile), "fingerprint-edges")
    labels = components(edges)
    rooted = distinct.join(labels.select(F.col("id").alias("fp"), "label"), "fp", "left").withColumn("root", F.coalesce("label", "fp"))
    rooted = cut_lineage(rooted.select("fp", "root", "least"), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")
