"""Texts to unit vectors."""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.operators.rows import column, cut_lineage, once_per_worker, small_batches

# Called once per worker and name; returns the function that turns texts into vectors.
EncoderFactory = Callable[[], Callable[[list[str]], np.ndarray]]


def encode(
    df: DataFrame,
    text: str,
    encoder: EncoderFactory | str = "char-ngrams",
    batch_size: int = 64,
    name: str = "embedding",
    dimensions: int = 1024,
    model: str | None = None,
) -> DataFrame:
    """Add a unit vector for every text.

    ``encoder`` is a factory for a batch function, run as an Arrow-batched function; with a
    ``model`` name it is called once per Python worker and kept under that name, else once per
    task. ``"char-ngrams"`` are character trigrams hashed to ``dimensions`` buckets, weighted
    by their inverse document frequency over all rows: a stand-in that finds texts of similar
    wording.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    if encoder == "char-ngrams":
        return _char_ngrams(df, text, name, dimensions)
    factory = encoder
    held = f"encoder {model}" if model else None

    @F.pandas_udf("array<float>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = once_per_worker(held, factory)
        for series in batches:
            texts = series.tolist()
            rows: list[np.ndarray] = []
            for start in range(0, len(texts), batch_size):
                matrix = np.asarray(run(texts[start : start + batch_size]), dtype=np.float64)
                norms = np.linalg.norm(matrix, axis=1, keepdims=True)
                unit = np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)
                rows.extend(unit.astype(np.float32))
            yield pd.Series(rows)

    return df.withColumn(name, vectors(column(text)))


def _char_ngrams(df: DataFrame, text: str, name: str, dimensions: int) -> DataFrame:
    # Trigrams are counted once: the counts are read again, short, for the weights and the vectors.
    with small_batches(df.sparkSession):
        counted = cut_lineage(trigram_counts(df, text, "__counts", dimensions), "trigram-counts")
    if counted.isEmpty():
        return df.withColumn(name, F.lit(None).cast("array<float>"))
    weights = trigram_weights(counted, "__counts", dimensions)
    vectors = weights.unfolded(counted.select(*(column(c) for c in df.columns), F.col("__counts").alias("__vector")), "__vector")
    return vectors.withColumn(name, F.col("__vector")).drop("__vector")


# --- character trigrams --------------------------------------------------------------------

#: Characters that get a place in the table of trigrams; trigrams of others are hashed each time.
_ALPHABET = 255
#: Characters and texts that are counted at a time.
_CHARS, _TEXTS = 1 << 18, 512
#: Rows that are weighted at a time.
_STRIP = 128


def trigram_counts(df: DataFrame, text: str, name: str, dimensions: int = 1024) -> DataFrame:
    """Add the trigrams of each text, counted by bucket: integers of 1, 2 or 4 bytes, as few as hold them.

    Buckets are those of ``HashingTF`` over ``NGram``, of the text between two spaces.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _Buckets(dimensions)
        for batch in batches:
            counts = pa.array(buckets.counts(batch.column(text).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, counts], names=[*batch.schema.names, name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(counted, f"{fields}, `{name}` binary")


class _Buckets:
    """Buckets of trigrams, remembered for the commonest characters."""

    def __init__(self, dimensions: int) -> None:
        self.dimensions = dimensions
        self.places = np.full(sys.maxunicode + 1, -1, dtype=np.int64)
        self.seen = 0
        # Bucket plus one; pages of zeros that no trigram touches take no memory.
        self.table = np.zeros((_ALPHABET + 1) ** 3, dtype=np.uint32)

    def counts(self, texts: list[str]) -> list[bytes]:
        found: list[bytes] = []
        part, size = [], 0
        for text in texts:
            if text is None:
                raise ValueError("a text is missing")
            part.append(f" {text} ")
            size += len(part[-1])
            if size >= _CHARS or len(part) == _TEXTS:
                found += self._counted(part)
                part, size = [], 0
        return found + self._counted(part)

    def _counted(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum([len(text) for text in texts])
        row = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
        # No trigram begins at the last two characters of a text.
        inside = np.ones(len(codes), dtype=bool)
        inside[ends - 1] = False
        inside[ends - 2] = False
        (at,) = np.nonzero(inside)
        cells = row[at] * self.dimensions + self._of(codes, at)
        matrix = np.bincount(cells, minlength=len(texts) * self.dimensions).reshape(len(texts), -1)
        most = matrix.max(axis=1)
        kinds = [np.uint8 if m < 1 << 8 else np.uint16 if m < 1 << 16 else np.uint32 for m in most]
        return [counts.astype(kind).tobytes() for counts, kind in zip(matrix, kinds)]

    def _of(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        place = self.places[codes]
        if (place < 0).any():
            for code in np.unique(codes[place < 0]):
                self.places[code] = min(self.seen, _ALPHABET)
                self.seen += 1
            place = self.places[codes]
        wide = _ALPHABET + 1
        key = (place[at] * wide + place[at + 1]) * wide + place[at + 2]
        bucket = self.table[key].astype(np.int64) - 1
        (new,) = np.nonzero(bucket < 0)
        if len(new):
            one = codes[at[new]].astype(np.int64) << 42 | codes[at[new] + 1].astype(np.int64) << 21 | codes[at[new] + 2]
            trigrams, back = np.unique(one, return_inverse=True)
            hashed = trigram_buckets(trigrams >> 42, trigrams >> 21 & 0x1FFFFF, trigrams & 0x1FFFFF, self.dimensions)
            bucket[new] = hashed[back]
            common = np.maximum(np.maximum(place[at[new]], place[at[new] + 1]), place[at[new] + 2]) < _ALPHABET
            self.table[key[new[common]]] = bucket[new[common]] + 1
        return bucket


def _utf8(codes: np.ndarray, size: int) -> list[np.ndarray]:
    """The bytes of characters that take ``size`` bytes each."""
    if size == 1:
        return [codes]
    lead = {2: 0xC0, 3: 0xE0, 4: 0xF0}[size]
    return [lead | codes >> 6 * (size - 1), *(0x80 | codes >> 6 * k & 0x3F for k in range(size - 2, -1, -1))]


def trigram_buckets(one: np.ndarray, two: np.ndarray, three: np.ndarray, dimensions: int) -> np.ndarray:
    """The bucket of each trigram: Murmur 3 of its characters with spaces between them, as ``HashingTF`` has it."""
    sizes = [1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000) for c in (one, two, three)]
    shape = (sizes[0] * 5 + sizes[1]) * 5 + sizes[2]
    found = np.empty(len(one), dtype=np.int64)
    for kind in np.unique(shape):
        (own,) = np.nonzero(shape == kind)
        space = [np.full(len(own), 0x20)]
        parts = [_utf8(c[own], int(size)) for c, size in zip((one, two, three), (kind // 25, kind // 5 % 5, kind % 5))]
        found[own] = _murmur3(parts[0] + space + parts[1] + space + parts[2]) % dimensions
    return found


def _murmur3(columns: list[np.ndarray], seed: int = 42) -> np.ndarray:
    """Signed 32-bit Murmur 3 of rows of bytes."""
    data = [c.astype(np.uint32) for c in columns]
    rotated = lambda x, r: x << np.uint32(r) | x >> np.uint32(32 - r)
    mixed = lambda k: rotated(k * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
    word = lambda part: sum((c << np.uint32(8 * k) for k, c in enumerate(part)), np.zeros(len(data[0]), dtype=np.uint32))
    h = np.full(len(data[0]), seed, dtype=np.uint32)
    whole = len(data) // 4 * 4
    for k in range(0, whole, 4):
        h = rotated(h ^ mixed(word(data[k : k + 4])), 13) * np.uint32(5) + np.uint32(0xE6546B64)
    if whole < len(data):
        h = h ^ mixed(word(data[whole:]))
    h = h ^ np.uint32(len(data))
    h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
    h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    return (h ^ h >> np.uint32(16)).astype(np.int32).astype(np.int64)


def count_matrix(counts: pa.Array, dimensions: int) -> np.ndarray:
    """Rows of counts as a matrix of the narrowest type that holds all of them."""
    rows = [np.frombuffer(value, dtype=f"<u{len(value) // dimensions}") for value in counts.to_pylist()]
    return np.stack(rows).astype(max((row.dtype for row in rows), key=lambda kind: kind.itemsize)) if rows else np.empty((0, dimensions), dtype=np.uint8)


def trigram_weights(counted: DataFrame, counts: str, dimensions: int = 1024) -> "TrigramWeights":
    """Inverse document frequencies over all rows; one vector of document counts a task reaches the driver."""

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(dimensions, dtype=np.int64), 0
        for batch in batches:
            for start in range(0, batch.num_rows, _TEXTS):
                matrix = count_matrix(batch.column(0).slice(start, _TEXTS), dimensions)
                total += np.count_nonzero(matrix, axis=0)
                rows += len(matrix)
        yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([total])], names=["n", "used"])

    parts = counted.select(column(counts)).mapInArrow(used, "n bigint, used array<bigint>").collect()
    total, rows = np.sum([part.used for part in parts], axis=0), sum(part.n for part in parts)
    return TrigramWeights(np.array([math.log((rows + 1.0) / (n + 1.0)) for n in total]))


@dataclass(frozen=True)
class TrigramWeights:
    """Turns counts into vectors: weighted, of unit length, in single precision."""

    weights: np.ndarray

    def raw(self, counts: pa.Array) -> np.ndarray:
        return count_matrix(counts, len(self.weights))

    def embedding(self, raw: np.ndarray, norms: np.ndarray | None = None) -> np.ndarray:
        """Vectors of unit length, up to a rounding of single precision."""
        norms = self.norms(raw) if norms is None else norms
        found = np.empty(raw.shape, dtype=np.float32)
        for start in range(0, len(raw), _STRIP):
            part = slice(start, start + _STRIP)
            weighted, length = raw[part] * self.weights, norms[part][:, None]
            found[part] = np.divide(weighted, length, out=weighted, where=length > 0)
        return found

    def norms(self, raw: np.ndarray) -> np.ndarray:
        found = np.empty(len(raw))
        for start in range(0, len(raw), _STRIP):
            weighted = raw[start : start + _STRIP] * self.weights
            # Squares are added one after the other, as Spark's Normalizer does.
            found[start : start + _STRIP] = np.sqrt(np.add.reduce(np.ascontiguousarray((weighted * weighted).T), axis=0))
        return found

    def unit(self, counts: pa.Array) -> np.ndarray:
        """Unit vectors in double precision, as ``unit_matrix`` makes them of the embeddings."""
        matrix = self.embedding(self.raw(counts)).astype(np.float64)
        norms = np.linalg.norm(matrix, axis=1, keepdims=True)
        return np.divide(matrix, norms, out=matrix, where=norms > 0)

    def _lists(self, raw: np.ndarray) -> pa.ListArray:
        offsets = np.arange(len(raw) + 1, dtype=np.int32) * len(self.weights)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(self.embedding(raw).ravel()))

    def of_counts(self, counts: Column) -> Column:
        """Vectors of a column of counts."""

        @F.arrow_udf("array<float>")
        def vectors(column: pa.Array) -> pa.Array:
            return self._lists(self.raw(column))

        return vectors(counts)

    def of_texts(self, text: Column) -> Column:
        """Vectors of a column of texts."""

        @F.arrow_udf("array<float>")
        def vectors(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            buckets = _Buckets(len(self.weights))
            for texts in columns:
                yield self._lists(self.raw(pa.array(buckets.counts(texts.to_pylist()), pa.binary())))

        return vectors(text)

    def unfolded(self, df: DataFrame, name: str) -> DataFrame:
        """The table with vectors for the counts in column ``name``."""

        def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, _TEXTS):
                    part = batch.slice(start, _TEXTS)
                    yield part.set_column(part.schema.get_field_index(name), name, self._lists(self.raw(part.column(name))))

        fields = ", ".join(f"`{f.name}` {'array<float>' if f.name == name else f.dataType.simpleString()}" for f in df.schema)
        return df.mapInArrow(vectors, fields)

    def digests(self, table: DataFrame) -> DataFrame:
        """``id, digest`` of a table (id, vec): 128 bits of each vector."""

        def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, _TEXTS):
                    part = batch.slice(start, _TEXTS)
                    found = [hashlib.blake2b(row.tobytes(), digest_size=16).digest() for row in self.embedding(self.raw(part.column("vec")))]
                    yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found, pa.binary())], names=["id", "digest"])

        return table.select("id", "vec").mapInArrow(marked, "id bigint, digest binary")
