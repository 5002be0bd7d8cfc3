"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.operators.rows import column, shared_folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the folder that all executors share."""
    return f"{shared_folder(spark)}/corpusprep/{name}-{uuid.uuid4().hex}"


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, under names of its own; null text is empty."""
    return docs.select(
        column(id_col).cast("bigint").alias("doc_id"), F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text")
    )


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(run: Run, *forget: Callable[[], object]) -> Run:
    """``run``, with the worker's memory given back when a partition is done.

    Workers go on to other stages; what the allocators keep, and the caches that ``forget``
    clears, would stand beside what those need.
    """

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            for clear in forget:
                clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # only glibc has it
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return tidied


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(array: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and where each text starts (one more entry)."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.type not in (pa.string(), pa.binary()):
        array = array.cast(pa.string())
    if len(array) == 0 or array.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    offsets = np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(array.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``most`` bytes; a longer text is a range of its own."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, min(last, rows)
        first = min(last, rows)


def key_runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows in batches sorted by ``keys``, as one table for each run of equal keys.

    Only the run at hand is held.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for key in keys:
            values = batch.column(key)
            if batch.num_rows > 1:
                new[1:] |= pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)
        cuts = [*np.flatnonzero(new).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            part = batch.slice(start, stop - start)
            key = tuple(part.column(k)[0].as_py() for k in keys)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
            last = key
    if held:
        yield pa.Table.from_batches(held)


def local_roots(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    """The smallest index each of ``size`` nodes is connected to by the links left-right."""
    label = np.arange(size)
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, before[left], low)
        np.minimum.at(label, before[right], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(label, before):
            break
    return label


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.sqrt(np.einsum("ij,ij->i", matrix, matrix))[:, None]


def matrix_of(array: pa.Array | pa.ChunkedArray, dtype=np.float64) -> np.ndarray:
    """A column of equally long lists without nulls, as rows of a matrix."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    values = array.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return values.reshape(len(array), -1) if len(array) else np.zeros((0, 0), dtype)


def list_column(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Lists of the given lengths out of one flat array."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def binary_column(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Byte strings of the given lengths out of one flat array of bytes."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])
