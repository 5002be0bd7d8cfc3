"""BPE encoding and decoding by a pair occurrence index.

The distinct pre-tokens of a batch are laid out as one sequence of symbols. An index maps each
pair that has a rank to all its positions. Ranks are applied in ascending order: all positions
of the lowest active rank are merged at once, and the neighbours' new pairs are added to the
lists of their ranks, which are always higher (the loader checks that no merge comes before
the merges that make its parts). The ids of a text are those of its pre-tokens.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusprep.llm.common import id_and_text, list_column, pieces, text_bytes, tidy
from corpusprep.llm.pretokens import WordCodes, special_tokens

#: Bytes of text whose new pre-tokens are merged together.
PIECE = 3 << 20


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the others take code points from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


class PairIndex:
    """The merges of a tokenizer file, and their application to many words at once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        letters = byte_letters()
        self.bytes_to_ids = np.array([vocabulary[c] for c in letters], np.int32)
        left = np.array([vocabulary[a] for a, _ in merges], np.int64)
        right = np.array([vocabulary[b] for _, b in merges], np.int64)
        made = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        self.bits = np.int64(max(vocabulary.values()).bit_length())
        made_at = np.full(max(vocabulary.values()) + 1, -1, np.int64)
        made_at[made] = np.arange(len(made))
        ranks = np.arange(len(made))
        if len(np.unique(made)) < len(made) or (made_at[left] >= ranks).any() or (made_at[right] >= ranks).any():
            raise ValueError("a merge comes before the merges that make its parts")
        keys = left << self.bits | right
        order = np.argsort(keys)
        self.keys, self.key_ranks = keys[order], order
        self.left, self.right, self.made = left, right, made
        back = {c: b for b, c in enumerate(letters)}
        self.token_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.token_bytes[number] = bytes(back[c] for c in token)
        self.specials = special_tokens(path)
        for token, number in self.specials.items():
            self.token_bytes.extend([b""] * (number + 1 - len(self.token_bytes)))
            self.token_bytes[number] = token
        lengths = np.array([len(t) for t in self.token_bytes], np.int64)
        self.token_lengths, self.token_starts = lengths, np.cumsum(lengths) - lengths
        self.token_flat = np.frombuffer(b"".join(self.token_bytes), np.uint8)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 for pairs that are never merged."""
        keys = left.astype(np.int64) << self.bits | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.key_ranks[at], -1)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of the words, one after the other."""
        plain = [b"" if w in self.specials else w for w in words]
        sizes = np.array([len(w) for w in plain], np.int64)
        symbols = self.bytes_to_ids[np.frombuffer(b"".join(plain), np.uint8)]
        stops = np.cumsum(sizes)
        after = np.arange(1, len(symbols) + 1)
        before = np.arange(-1, len(symbols) - 1)
        after[stops[sizes > 0] - 1] = -1
        before[(stops - sizes)[sizes > 0]] = -1
        self._merge_all(symbols, after, before)
        kept = symbols >= 0
        counts = np.concatenate([[0], np.cumsum(kept)])
        lengths = counts[stops] - counts[stops - sizes]
        flat = symbols[kept]
        special = [k for k, w in enumerate(words) if w in self.specials]
        if special:
            begins = np.cumsum(lengths) - lengths
            flat = np.insert(flat, begins[special], [self.specials[words[k]] for k in special])
            lengths[special] = 1
        return lengths, flat

    def _merge_all(self, symbols: np.ndarray, after: np.ndarray, before: np.ndarray) -> None:
        active: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def enlist(starts: np.ndarray) -> None:
            found = self.ranks(symbols[starts], symbols[after[starts]])
            hits = found >= 0
            if not hits.any():
                return
            starts, found = starts[hits], found[hits]
            order = np.argsort(found, kind="stable")
            starts, found = starts[order], found[order]
            cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
            for rank, part in zip(found[np.concatenate([[0], cuts])].tolist(), np.split(starts, cuts)):
                if rank in active:
                    active[rank].append(part)
                else:
                    active[rank] = [part]
                    heapq.heappush(queue, rank)

        enlist(np.flatnonzero(after >= 0))
        while queue:
            rank = heapq.heappop(queue)
            parts = active.pop(rank)
            left, right = self.left[rank], self.right[rank]
            at = parts[0] if len(parts) == 1 else np.concatenate(parts)
            # The end of a word has no next symbol: index -1 is masked by the second test.
            following = after[at]
            at = at[(symbols[at] == left) & (following >= 0) & (symbols[following] == right)]
            if not len(at):
                continue
            if left == right:
                at = _every_other(np.unique(at), after)
            gone = after[at]
            beyond = after[gone]
            symbols[at] = self.made[rank]
            symbols[gone] = -1
            after[at] = beyond
            inner = beyond >= 0
            before[beyond[inner]] = at[inner]
            previous = before[at]
            enlist(np.unique(np.concatenate([previous[previous >= 0], at[inner]])))

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of the ids; bytes that are not UTF-8 become U+FFFD."""
        lengths = self.token_lengths[ids]
        begins = np.cumsum(lengths) - lengths
        raw = self.token_flat[np.repeat(self.token_starts[ids] - begins, lengths) + np.arange(int(lengths.sum()))].tobytes()
        try:
            raw.decode("utf-8")
            return raw
        except UnicodeDecodeError:
            return raw.decode("utf-8", "replace").encode("utf-8")


def _every_other(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of equal symbols in a row, the pairs that a scan from the left merges."""
    chained = np.zeros(len(at), bool)
    chained[1:] = after[at[:-1]] == at[1:]
    place = np.arange(len(at))
    begin = np.maximum.accumulate(np.where(chained, 0, place))
    return at[(place - begin) % 2 == 0]


@lru_cache(maxsize=1)
def _worker(path: str) -> tuple[PairIndex, WordCodes]:
    index = PairIndex(path)
    return index, WordCodes(index.encode_words)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``doc_id, ids`` (array<int>) of every whole text, and with ``decoded`` the text that the
    ids decode to.

    ``path`` is a byte-level BPE tokenizer file. Null and empty texts have no ids; repeated rows
    are encoded row by row; other columns are not read. No rows are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, words = _worker(path)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for low, high in pieces(offsets, PIECE):
                part = offsets[low : high + 1] - offsets[low]
                ids, counts = words.texts(data[offsets[low] : offsets[high]], part, tuple(index.specials))
                bounds = np.concatenate([[0], np.cumsum(counts)])
                # Results leave in slices, so that one list column stays well below 2 GB.
                for a, b in pieces(bounds, 1_000_000):
                    flat = ids[bounds[a] : bounds[b]]
                    columns = [batch.column("doc_id").slice(low + a, b - a), list_column(flat, counts[a:b], pa.int32())]
                    if decoded:
                        texts = [index.decode(ids[s:e]) for s, e in zip(bounds[a:b].tolist(), bounds[a + 1 : b + 1].tolist())]
                        columns.append(pa.array(texts, pa.binary()).cast(pa.string()))
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][: len(columns)])

    schema = "doc_id bigint, ids array<int>" + ", decoded string" * decoded
    return id_and_text(docs, id_col, text_col).mapInArrow(tidy(run, lambda: _worker(path)[1].clear()), schema)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` of rows of ids. Null lists give null texts, empty ones empty texts."""
    from corpusprep.operators.rows import column

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, _ = _worker(path)
        for batch in batches:
            lists = batch.column("ids")
            texts = [None if v is None else index.decode(np.array(v, np.int64)).decode() for v in lists.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows = encoded.select(column(id_col).cast("bigint").alias("doc_id"), column(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id bigint, text string")
