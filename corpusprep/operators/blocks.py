"""All pairs of wide vectors without a shuffle.

Vectors are packed, thousands to a row, and written once. Each task holds one or a few blocks and
reads the others one by one (a Cartesian product of blocks, whose vectors reach Python once for
each task), so vectors are compared in time, not in disk: what leaves a task is reduced.

Products are taken in single precision. Where that leaves a comparison open, the vectors are
multiplied again in double precision.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.operators.encoding import TrigramWeights
from corpusprep.operators.neighbors import _ARROW, Exact, Reducer, _fields, _ranked, exact_cosines, exact_values, reached, similar_cells
from corpusprep.operators.rows import cut_lineage, small_batches

#: Rows of a block at most, unit vectors of a block in single precision (bytes), and cosines at a time.
BLOCK_ROWS, BLOCK_BYTES, STRIP_VALUES = 1 << 13, 12 << 20, 1 << 20
#: Part of the rows of a block that may be decided before the others are gathered anew.
_THINNED = 0.8

_META = "block bigint, lo bigint, hi bigint, n int, ids binary, vec binary, norms binary, kind string"
_NUMBERS = {"bigint": np.int64, "double": np.float64}


@dataclass(frozen=True)
class Blocks:
    """A table (id, vec, numbers) packed; ``weights`` turn its counts into vectors."""

    table: DataFrame  # block, lo, hi (smallest and largest id), n, ids, vec, norms, kind, a binary column for each of the numbers
    count: int
    weights: TrigramWeights
    numbers: dict[str, type] = field(default_factory=dict)


def pack(table: DataFrame, weights: TrigramWeights, rows: int, name: str = "blocks", ordered: bool = False) -> Blocks:
    """Blocks of the rows in the order of the table, or of their ids. ``rows`` is about their number."""
    dimensions = len(weights.weights)
    size = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (4 * dimensions), -(-rows // (2 * table.sparkSession.sparkContext.defaultParallelism))))
    parts = max(1, rows // size)
    if ordered:
        table = table.repartitionByRange(parts, "id").sortWithinPartitions("id")
    else:
        table = table.coalesce(parts)
    numbers = {f.name: _NUMBERS[f.dataType.simpleString()] for f in table.schema if f.name not in ("id", "vec")}

    def record(held: list[pa.RecordBatch], block: int) -> pa.RecordBatch:
        whole = pa.Table.from_batches(held)
        ids = whole.column("id").to_numpy().astype(np.int64)
        raw = weights.raw(whole.column("vec"))
        columns = {"block": block, "lo": int(ids.min()), "hi": int(ids.max()), "n": len(ids), "ids": ids.tobytes(), "vec": raw.tobytes(), "norms": weights.norms(raw).tobytes(), "kind": raw.dtype.str}
        columns |= {k: whole.column(k).to_numpy().astype(kind).tobytes() for k, kind in numbers.items()}
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.string(), *(pa.binary() for _ in numbers)]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(columns.values(), types)], names=list(columns))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, size + size // 4 - n)
                held.append(part)
                n += part.num_rows
                batch = batch.slice(part.num_rows)
                if n == size + size // 4:
                    # A small rest joins the block before it.
                    whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    yield record([whole.slice(0, size)], block)
                    held, n, block = [whole.slice(size)], n - size, block + 1
        if n:
            yield record(held, block)

    extra = "".join(f", `{k}` binary" for k in numbers)
    # Few rows to a row group: each of them is large.
    options = {"parquet.block.size": str(1 << 23), "parquet.page.size.row.check.min": "1", "parquet.enable.dictionary": "false"}
    with small_batches(table.sparkSession):
        written = cut_lineage(table.mapInArrow(packed, _META + extra), name, **options)
    return Blocks(written, written.count(), weights, numbers)


class _Side:
    """The rows of a block in memory."""

    def __init__(self, row: dict, weights: TrigramWeights, kinds: dict[str, type], chosen: np.ndarray | None) -> None:
        self.block, self.lo, self.hi, self.size = row["block"], row["lo"], row["hi"], row["n"]
        raw = np.frombuffer(row["vec"], dtype=row["kind"]).reshape(row["n"], -1)
        numbers = {"id": np.frombuffer(row["ids"], dtype=np.int64)}
        numbers |= {k: np.frombuffer(row[k], dtype=kind) for k, kind in kinds.items()}
        self.at = np.arange(row["n"]) if chosen is None else np.flatnonzero(chosen)
        self.numbers = {k: v[self.at] for k, v in numbers.items()}
        self.unit = weights.embedding(raw[self.at], np.frombuffer(row["norms"], dtype=np.float64)[self.at])

    def drop(self, gone: np.ndarray) -> None:
        keep = ~gone
        self.at, self.unit = self.at[keep], self.unit[keep]
        self.numbers = {k: v[keep] for k, v in self.numbers.items()}


def _exact(probe: _Side, base: _Side, start: int = 0) -> Exact:
    return exact_cosines(lambda rows: _doubles(probe.unit[rows + start]), lambda rows: _doubles(base.unit[rows]), probe.unit.shape[1])


def _doubles(unit: np.ndarray) -> np.ndarray:
    matrix = unit.astype(np.float64)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=matrix, where=norms > 0)


def block_join(
    base: Blocks,
    probe: Blocks,
    work: Callable[[], "Pairwise"],
    schema: str,
    lower: bool = False,
    base_rows: dict[int, np.ndarray] | None = None,
    probe_rows: dict[int, np.ndarray] | None = None,
) -> DataFrame:
    """Bring every probe block together with every base block; each task makes a ``work`` of its own.

    With ``lower`` only base blocks that begin below the end of a probe block are compared.
    ``base_rows`` and ``probe_rows`` say which rows of a block take part (one bit each, packed);
    blocks without such rows are not read. Run it in ``small_batches``: rows are large.
    """
    session = base.table.sparkSession
    probes = probe.count if probe_rows is None else max(1, len(probe_rows))
    tasks = 2 * session.sparkContext.defaultParallelism
    # A task reads all base blocks one by one, unless there are too few tasks.
    parts = max(1, min(base.count, tasks // max(1, min(probes, probe.count))))

    def side(blocks: Blocks, chosen: dict | None, mark: str, parts: int) -> DataFrame:
        table = blocks.table
        if chosen is not None:
            table = table.filter(F.col("block").isin(*chosen) if len(chosen) <= 1000 else F.col("block").between(min(chosen), max(chosen)))
        named = table.select(*(F.col(c).alias(f"{mark}_{c}") for c in table.columns)).coalesce(parts)
        return named.withColumn(f"{mark}_first", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0)

    left, right = side(base, base_rows, "b", parts), side(probe, probe_rows, "p", max(1, min(probes, probe.count)))
    # The vectors of a block go along with the first pair of each task that it is in.
    needed = (F.col("b_lo") <= F.col("p_hi")) | F.col("b_first") | F.col("p_first") if lower else F.lit(True)
    pairs = left.hint("shuffle_replicate_nl").join(right, needed)

    def sent(mark: str, blocks: Blocks, first: str) -> list:
        heavy = {"ids", "vec", "norms", "kind", *blocks.numbers}
        names = ["block", "lo", "hi", "n", "ids", "vec", "norms", "kind", *blocks.numbers]
        return [F.when(F.col(first), F.col(f"{mark}_{c}")).alias(f"{mark}_{c}") if c in heavy else F.col(f"{mark}_{c}") for c in names]

    pairs = pairs.select(*sent("b", base, "p_first"), *sent("p", probe, "b_first"))

    def chosen(rows: dict | None, row: dict) -> np.ndarray | None:
        if rows is None:
            return None
        bits = rows.get(row["block"])
        return np.zeros(row["n"], dtype=bool) if bits is None else np.unpackbits(bits, count=row["n"]).astype(bool)

    # What goes to the tasks holds no table.
    sources = (("p", probe.weights, probe.numbers, probe_rows), ("b", base.weights, base.numbers, base_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: dict[int, _Side] = {}
        current: _Side | None = None
        doing = work()
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in ("b_block", "p_block", "b_lo", "p_hi")}
                for mark, weights, kinds, rows in sources:
                    if not batch.column(f"{mark}_vec")[k].is_valid:
                        continue
                    own = {c[2:]: batch.column(c)[k].as_py() for c in batch.schema.names if c.startswith(f"{mark}_")}
                    if mark == "b":
                        current = None  # two of them are never held
                    read = _Side(own, weights, kinds, chosen(rows, own))
                    if mark == "p":
                        sides[read.block] = read
                    else:
                        current = read
                if current is None or current.block != row["b_block"]:
                    raise RuntimeError("a block came without its vectors")
                if not lower or row["b_lo"] <= row["p_hi"]:
                    found = doing.pair(current, sides[row["p_block"]])
                    if found is not None:
                        yield found
        for own in sides.values():
            found = doing.end(own)
            if found is not None:
                yield found

    return pairs.mapInArrow(run, schema)


def _batch(columns: list[np.ndarray], schema: str) -> pa.RecordBatch | None:
    if not len(columns[0]):
        return None
    fields = _fields(schema)
    return pa.RecordBatch.from_arrays([pa.array(v, type=_ARROW[kind]) for v, (_, kind) in zip(columns, fields)], names=[name for name, _ in fields])


class Pairwise:
    """What a task does with its pairs of blocks; this one hands them to a reducer."""

    def __init__(self, reducer: Reducer, schema: str) -> None:
        self.reducer, self.schema = reducer, schema

    def pair(self, base: _Side, probe: _Side) -> pa.RecordBatch | None:
        if not len(base.at) or not len(probe.at):
            return None
        found = []
        rows = max(1, STRIP_VALUES // len(base.at))
        for start in range(0, len(probe.at), rows):
            strip = {k: v[start : start + rows] for k, v in probe.numbers.items()}
            cosines = probe.unit[start : start + rows] @ base.unit.T
            found.append(self.reducer(base.numbers, strip, cosines, _exact(probe, base, start)))
        return _batch([np.concatenate(parts) for parts in zip(*found)], self.schema)

    def end(self, probe: _Side) -> pa.RecordBatch | None:
        return None


class FoundLower(Pairwise):
    """``block, found``: the rows of a probe block (bits) that have a similar base row of lower id."""

    SCHEMA = "block bigint, found binary"

    def __init__(self, threshold: float) -> None:
        self.threshold = threshold
        self.found: dict[int, np.ndarray] = {}

    def pair(self, base: _Side, probe: _Side) -> pa.RecordBatch | None:
        found = self.found.setdefault(probe.block, np.zeros(probe.size, dtype=bool))
        if not len(base.at) or not len(probe.at):
            return None
        overlap = base.hi >= probe.lo
        rows = max(1, STRIP_VALUES // len(base.at))
        for start in range(0, len(probe.at), rows):
            cosines = probe.unit[start : start + rows] @ base.unit.T
            exact = _exact(probe, base, start)
            row, col = similar_cells(cosines, self.threshold, exact)
            if overlap:
                earlier = base.numbers["id"][col] < probe.numbers["id"][row + start]
                row, col = row[earlier], col[earlier]
            found[probe.at[start + reached(cosines, row, col, self.threshold, exact)]] = True
        gone = found[probe.at]
        if gone.sum() > (1 - _THINNED) * len(gone):
            probe.drop(gone)
        return None

    def end(self, probe: _Side) -> pa.RecordBatch | None:
        bits = np.packbits(self.found[probe.block]).tobytes() if probe.block in self.found else np.packbits(np.zeros(probe.size, dtype=bool)).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([probe.block]), pa.array([bits], pa.binary())], names=["block", "found"])


class Nearest(Pairwise):
    """``query_id, match_id, similarity``: the k most similar base rows of each probe row (ties to the lower id)."""

    SCHEMA = "query_id bigint, match_id bigint, similarity double"

    def __init__(self, k: int) -> None:
        self.k = k
        self.best: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # similarities and ids, one row each

    def pair(self, base: _Side, probe: _Side) -> pa.RecordBatch | None:
        if not len(base.at) or not len(probe.at):
            return None
        k = self.k
        if probe.block not in self.best:
            self.best[probe.block] = np.full((len(probe.at), k), -np.inf), np.full((len(probe.at), k), np.iinfo(np.int64).max)
        similar, ids = self.best[probe.block]
        rows = max(1, STRIP_VALUES // len(base.at))
        for start in range(0, len(probe.at), rows):
            cosines = probe.unit[start : start + rows] @ base.unit.T
            exact = _exact(probe, base, start)
            part = slice(start, start + len(cosines))
            limit = min(k, cosines.shape[1])
            cut = similar[part, -1] - 2 * exact.margin
            # Before a row has k matches, the k best of a few base rows bound what can be among them.
            if not np.isfinite(cut).all():
                cut = np.maximum(cut, np.partition(cosines, cosines.shape[1] - limit, axis=1)[:, -limit] - 4 * exact.margin)
            # Rounded down, as the limit must not grow.
            row, col = np.divmod(np.flatnonzero(cosines >= np.nextafter(cut.astype(np.float32), np.float32(-np.inf))[:, None]), cosines.shape[1])
            if not len(row):
                continue
            value, match = exact_values(cosines, row, col, exact), base.numbers["id"][col]
            rows_, back = np.unique(row, return_inverse=True)
            at = rows_ + start
            row = np.concatenate([back, np.repeat(np.arange(len(at)), k)])
            value, match = np.concatenate([value, similar[at].ravel()]), np.concatenate([match, ids[at].ravel()])
            order = np.lexsort((match, -value, row))
            order = order[(np.arange(len(order)) - np.searchsorted(row[order], row[order])) < k]
            similar[at], ids[at] = value[order].reshape(-1, k), match[order].reshape(-1, k)
        return None

    def end(self, probe: _Side) -> pa.RecordBatch | None:
        if probe.block not in self.best:
            return None
        similar, ids = self.best[probe.block]
        row, place = np.nonzero(similar > -np.inf)
        return _batch([probe.numbers["id"][row], ids[row, place], similar[row, place]], self.SCHEMA)


def packed_top_k(blocks: Blocks, k: int) -> DataFrame:
    """``query_id, match_id, similarity, rank``: the k best rows for every row, itself among them."""
    with small_batches(blocks.table.sparkSession):
        return cut_lineage(_ranked(block_join(blocks, blocks, lambda: Nearest(k), Nearest.SCHEMA), k), "near")


def packed_representatives(blocks: Blocks, threshold: float, first_block: int, max_block: int) -> DataFrame:
    """``id`` of the rows that a sequential pass over the rows would keep.

    The rounds of ``greedy_representatives``; blocks are those of ``pack`` in the order of their ids.
    One bit of each row is held on the driver, vectors stay where they were written. Once few rows
    of the blocks are undecided, these are packed anew.
    """
    kept: list[DataFrame] = []
    most = first_block
    while blocks.count:
        facts = sorted(tuple(row) for row in blocks.table.select("lo", "hi", "block", "n").collect())
        rows = sum(n for *_, n in facts)
        open_ = {block: np.ones(n, dtype=bool) for _, _, block, n in facts}
        chosen = {block: np.zeros(n, dtype=bool) for _, _, block, n in facts}
        left = rows
        while 2 * left >= rows:
            head: dict[int, np.ndarray] = {}
            size = 0
            for _, _, block, _ in facts:
                n = int(open_[block].sum())
                if n and head and size + n > most:
                    break
                if n:
                    head[block] = open_[block].copy()
                    size += n
            beaten = _found(blocks, threshold, head, head)
            fresh = {block: own & ~beaten[block] for block, own in head.items()}
            for block, own in fresh.items():
                chosen[block] |= own
                open_[block] &= ~own
            fresh_rows = sum(int(own.sum()) for own in fresh.values())
            if not fresh_rows:
                raise RuntimeError("a round decided no row: ids must be unique and not null")
            rest = {block: own for block, own in open_.items() if own.any()}
            for block, own in _found(blocks, threshold, fresh, rest).items():
                open_[block] &= ~own
            left = sum(int(own.sum()) for own in open_.values())
            if most < max_block or 2 * fresh_rows >= size:
                most *= 2
        kept.append(chosen_ids(blocks, _bits(chosen)))
        if not left:
            break
        blocks = pack(_chosen_rows(blocks, _bits(open_)), blocks.weights, left, "open-blocks", ordered=True)
    nothing = blocks.table.sparkSession.createDataFrame([], "id bigint")
    return reduce(DataFrame.unionByName, kept, nothing)


def _bits(rows: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    return {block: np.packbits(own) for block, own in rows.items() if own.any()}


def _found(blocks: Blocks, threshold: float, base: dict[int, np.ndarray], probe: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Rows of ``probe`` that have a similar row of lower id in ``base``."""
    hits = {block: np.zeros(len(own), dtype=bool) for block, own in probe.items()}
    base_bits, probe_bits = _bits(base), _bits(probe)
    if base_bits and probe_bits:
        table = block_join(blocks, blocks, lambda: FoundLower(threshold), FoundLower.SCHEMA, True, base_bits, probe_bits)
        with small_batches(blocks.table.sparkSession):
            parts = table.collect()  # one row per block and task
        for block, part in parts:
            if block in hits:
                hits[block] |= np.unpackbits(np.frombuffer(part, dtype=np.uint8), count=len(hits[block])).astype(bool)
    return hits


def _chosen_rows(blocks: Blocks, rows: dict[int, np.ndarray]) -> DataFrame:
    """``id, vec`` (counts) of the rows of which the bit is set."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, n, ids, vec, kind in zip(*(batch.column(name).to_pylist() for name in ("block", "n", "ids", "vec", "kind"))):
                if block in rows:
                    at = np.flatnonzero(np.unpackbits(rows[block], count=n))
                    counts = np.frombuffer(vec, dtype=kind).reshape(n, -1)[at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.frombuffer(ids, dtype=np.int64)[at]), pa.array([own.tobytes() for own in counts], pa.binary())], names=["id", "vec"]
                    )

    return blocks.table.select("block", "n", "ids", "vec", "kind").mapInArrow(listed, "id bigint, vec binary")


def chosen_ids(blocks: Blocks, rows: dict[int, np.ndarray]) -> DataFrame:
    """``id`` of the rows of which the bit is set."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, n, ids in zip(*(batch.column(name).to_pylist() for name in ("block", "n", "ids"))):
                if block not in rows:
                    continue
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(ids, dtype=np.int64)[np.unpackbits(rows[block], count=n).astype(bool)])], names=["id"])

    return blocks.table.select("block", "n", "ids").mapInArrow(listed, "id bigint")
