"""Token ids in binary files of directly addressable codes.

Each id is cut into chunks of ``WIDTHS`` bits, lowest first. Level 0 holds the lowest chunk of
every id; a bitmap tells which ids go on in the next level, and a rank directory counts the set
bits before each block of ``RANK_BLOCK`` bits. The place of an id in the next level is the
number of set bits before it, so any token is read with one look at each level, without
decoding what stands before it.

A file (little-endian): magic, number of tokens, documents and levels; the documents' ids, null
flags and starts; then for each level its size, chunks, bitmap and directory. A table of files,
the manifest, lists them in the order of the documents.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import binary_column, id_and_text, pieces, scratch, text_bytes, tidy
from corpusprep.llm.pretokens import WordCodes, special_tokens

MAGIC = b"DACTOK01"
#: Chunk types of the levels; together 32 bits.
LEVELS = (np.dtype("<u1"), np.dtype("<u1"), np.dtype("<u2"))
RANK_BLOCK = 512
#: A task begins a new file when one holds this many tokens, whatever the size of its partition.
FILE_TOKENS = 2_000_000
#: Bytes of text encoded at a time.
PIECE = 4 << 20
_BITS = np.array([bin(b).count("1") for b in range(256)], np.uint8)


def pack(ids: np.ndarray, starts: np.ndarray, names: list[int | None]) -> bytes:
    """The bytes of a file: all ids, where each document starts, and the documents' ids."""
    parts = [
        MAGIC,
        np.array([len(ids), len(names), len(LEVELS)], "<u8").tobytes(),
        np.array([0 if n is None else n for n in names], "<i8").tobytes(),
        np.array([n is None for n in names], "<u1").tobytes(),
        np.asarray(starts, "<u8").tobytes(),
    ]
    rest = np.asarray(ids, np.uint32)
    for k, kind in enumerate(LEVELS):
        width = kind.itemsize * 8
        more = rest >> np.uint32(width) if width < 32 else np.zeros_like(rest)
        goes_on = more > 0
        bitmap = np.packbits(goes_on, bitorder="little")
        blocks = np.zeros(-(-len(bitmap) * 8 // RANK_BLOCK) * RANK_BLOCK // 8, np.uint8)
        blocks[: len(bitmap)] = bitmap
        ones = _BITS[blocks].reshape(-1, RANK_BLOCK // 8).sum(axis=1, dtype=np.int64)
        directory = np.concatenate([[0], np.cumsum(ones)]).astype("<u8")
        parts += [
            np.array([len(rest), len(blocks), len(directory)], "<u8").tobytes(),
            (rest & np.uint32((1 << width) - 1)).astype(kind).tobytes(),
            blocks.tobytes(),
            directory.tobytes(),
        ]
        rest = more[goes_on]
    return b"".join(parts)


class TokenFile:
    """Random access to a file's tokens. ``data`` is anything with the buffer interface."""

    def __init__(self, data):
        view = memoryview(data)
        if bytes(view[:8]) != MAGIC:
            raise ValueError("not a token file")
        place = 8

        def take(kind: str | np.dtype, count: int) -> np.ndarray:
            nonlocal place
            values = np.frombuffer(view, kind, count, place)
            place += values.nbytes
            return values

        self.tokens, documents, levels = (int(x) for x in take("<u8", 3))
        ids, missing = take("<i8", documents), take("<u1", documents)
        self.names = [None if m else int(i) for i, m in zip(ids, missing)]
        self.starts = np.append(take("<u8", documents).astype(np.int64), self.tokens)
        self.levels = []
        for k in range(levels):
            size, bitmap, directory = (int(x) for x in take("<u8", 3))
            self.levels.append((take(LEVELS[k], size), take("<u1", bitmap), take("<u8", directory)))

    def _rank(self, level: int, place: int) -> int:
        """Set continuation bits before a place of a level."""
        _, bitmap, directory = self.levels[level]
        block, inside = divmod(place, RANK_BLOCK)
        first = block * RANK_BLOCK // 8
        whole, rest = divmod(inside, 8)
        count = int(directory[block]) + int(_BITS[bitmap[first : first + whole]].sum())
        return count + (int(_BITS[bitmap[first + whole] & ((1 << rest) - 1)]) if rest else 0)

    def token(self, place: int) -> int:
        """The token at one place."""
        value = shift = 0
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            value |= int(chunks[place]) << shift
            if not bitmap[place >> 3] >> (place & 7) & 1:
                break
            shift += chunks.dtype.itemsize * 8
            place = self._rank(level, place)
        return value

    def range(self, low: int, high: int) -> np.ndarray:
        """The tokens from ``low`` to before ``high``."""
        values = np.zeros(high - low, np.uint32)
        where, shift = None, 0
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            if high <= low:
                break
            part = chunks[low:high].astype(np.uint32) << np.uint32(shift)
            if where is None:
                values |= part
            else:
                values[where] |= part
            bits = np.unpackbits(bitmap[low >> 3 : (high + 7) >> 3], bitorder="little")[low & 7 :][: high - low].astype(bool)
            where = np.flatnonzero(bits) if where is None else where[bits]
            shift += chunks.dtype.itemsize * 8
            low, high = self._rank(level, low), self._rank(level, low) + len(where)
        return values


@lru_cache(maxsize=1)
def _encoder(path: str) -> tuple[WordCodes, tuple[bytes, ...]]:
    """Encodes each distinct pre-token with the tokenizers library, once."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lists = [e.ids for e in tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]
        lengths = np.array([len(x) for x in lists], np.int64)
        return lengths, np.fromiter((i for x in lists for i in x), np.int32, int(lengths.sum()))

    return WordCodes(encode), tuple(special_tokens(path))


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else os.path.abspath(folder))


def _save(folder: str, name: str, data: bytes) -> str:
    """Write a file under a name of this attempt, then give it its own name.

    A task that runs again writes the same bytes to the same name.
    """
    store, root = _filesystem(folder)
    store.create_dir(root, recursive=True)
    draft, final = f"{root}/.{name}-{uuid.uuid4().hex}", f"{root}/{name}"
    with store.open_output_stream(draft) as out:
        out.write(data)
    store.move(draft, final)
    return f"{folder}/{name}"


def write_token_files(
    docs: DataFrame,
    path: str,
    folder: str,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Encode every whole text, append ``end_id`` and write the ids in ascending order of ids.

    Returns the manifest: ``file, part, number, documents, tokens``, read back from a table
    beside the files. Null texts are empty; null ids come first; rows with equal ids follow
    each other by a hash of the text, so that one id may hold any share of the rows. An empty
    table gives an empty manifest. ``folder`` must be visible to all executors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, specials = _encoder(path)
        task = TaskContext.get().partitionId()
        names: list[int | None] = []
        lists: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        number = size = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, size
            ids, lengths = np.concatenate(lists), np.concatenate(counts)
            name = _save(folder, f"part-{task:06d}-{number:04d}.dac", pack(ids, np.cumsum(lengths) - lengths, names))
            row = [[name], [task], [number], [len(names)], [len(ids)]]
            names.clear(), lists.clear(), counts.clear()
            number, size = number + 1, 0
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
                names=["file", "part", "number", "documents", "tokens"],
            )

        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for low, high in pieces(offsets, min(PIECE, 4 * file_tokens)):
                part = offsets[low : high + 1] - offsets[low]
                ids, lengths = words.texts(data[offsets[low] : offsets[high]], part, specials)
                lists.append(np.insert(ids, np.cumsum(lengths), end_id))
                counts.append(lengths + 1)
                names += batch.column("doc_id").slice(low, high - low).to_pylist()
                size += len(ids) + len(lengths)
                if size >= file_tokens:
                    yield flush()
        if names:
            yield flush()

    rows = id_and_text(docs, id_col, text_col)
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    manifest = ordered.mapInArrow(tidy(run), "file string, part int, number int, documents bigint, tokens bigint")
    manifest.write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.parquet(f"{folder}/manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files, in their order.

    ``start`` counts the ids of all documents before it; ``ids`` holds them as little-endian
    unsigned 32-bit integers. The running total is over the manifest, one row per file.
    """
    # Totals by part first, so that the window over all parts sees one row of each.
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("tokens").alias("part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("part_start"))
    placed = manifest.withColumn("inner_start", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(parts, "part")
    files = placed.select("file", (F.col("part_start") + F.col("inner_start")).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                store, path = _filesystem(name)
                with store.open_input_file(path) as source:
                    file = TokenFile(source.read_buffer())
                # Documents of about a million tokens are read at a time.
                for low, high in pieces(file.starts, 1_000_000):
                    first, last = int(file.starts[low]), int(file.starts[high])
                    lengths = np.diff(file.starts[low : high + 1])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(file.names[low:high], pa.int64()),
                            pa.array(start + file.starts[low:high], pa.int64()),
                            pa.array(lengths, pa.int64()),
                            binary_column(file.range(first, last).astype("<u4").view(np.uint8), lengths * 4),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    # One task for every few files: as many partitions as shuffles have, dealt out by name.
    shuffles = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    return files.repartition(shuffles, "file").mapInArrow(run, schema)


def token_files(docs: DataFrame, path: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Write the token files of all documents, then read them back."""
    return read_token_files(write_token_files(docs, path, folder or scratch(docs.sparkSession, "token-files"), end_id))
