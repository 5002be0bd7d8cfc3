"""Similarity joins on unit vectors.

All joins here share one shape. Rows get a *cell*; rows that can be similar meet in a cell;
a cell with many rows is cut into tiles of a bounded size; each pair of tiles is one group
of an Arrow co-group, multiplied as matrices; what leaves a group is already reduced (one
record per row, k records per row, or only the pairs over the threshold).

``PivotCells`` is exact: a vector belongs to its nearest pivot, and looks into another cell
only when the triangle inequality on angles allows a partner there. Cells that lie together
share a group, so that a vector is copied once per group, not per cell. ``SignBands`` is
approximate: vectors meet when one band of random-projection signs is equal.

Tables have the columns ``id bigint, vec array<float|double>``; ids are unique. Vectors are
brought to unit length in double precision on use; a zero vector is similar to nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.operators.rows import column, cut_lineage
from corpusprep.operators.skew import hot_join

TILE_ROWS = 1 << 13
_STRIP_ROWS = 512
#: Base rows at a time where only lower ids count.
_STRIP_COLUMNS = 1 << 10
#: Cosines in memory at a time.
_STRIP_VALUES = 1 << 22
_SLACK = 1e-6
#: Rows that are turned into a matrix at a time where vectors get their cells.
_PLACED_ROWS = 1 << 11
#: Bytes of one side of a group of cells, in double precision.
GROUP_BYTES = 1 << 27
#: Pairs of groups that a join is cut into while they stay below these bytes.
_GROUPS = 36
#: Comparisons that take as long as moving a vector to one more group.
_MOVED = 2048


def unit_matrix(column) -> np.ndarray:
    """An Arrow list column as a matrix of unit rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    if rows == 0:
        return np.empty((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    matrix = flat.reshape(rows, -1)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


class _Rows:
    """An Arrow list column: its values, and unit rows in single precision."""

    def __init__(self, column) -> None:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        rows = len(column)
        self.raw = column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)
        self.norms = np.empty(rows)
        self.unit = np.zeros(self.raw.shape, dtype=np.float32)
        for start in range(0, rows, _PLACED_ROWS):
            part = slice(start, start + _PLACED_ROWS)
            self.norms[part] = np.linalg.norm(self.raw[part].astype(np.float64, copy=False), axis=1)
            self.unit[part] = self.doubles(np.arange(rows)[part])

    def doubles(self, rows: np.ndarray) -> np.ndarray:
        """Unit rows in double precision."""
        matrix, norms = self.raw[rows].astype(np.float64), self.norms[rows][:, None]
        return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


@dataclass(frozen=True)
class Exact:
    """Cosines (row, column) in double precision, and how far others may be from these."""

    cosines: Callable[[np.ndarray, np.ndarray], np.ndarray]
    margin: float


def margin(dimensions: int) -> float:
    """By how much a cosine of unit vectors in single precision may be wrong."""
    return (dimensions + 16) * 2.0**-24


def exact_cosines(probe: Callable[[np.ndarray], np.ndarray], base: Callable[[np.ndarray], np.ndarray], dimensions: int) -> Exact:
    """From functions that give unit rows in double precision."""

    def cosines(row: np.ndarray, col: np.ndarray) -> np.ndarray:
        found, step = np.empty(len(row)), max(1, (1 << 20) // max(dimensions, 1))
        for start in range(0, len(row), step):
            part = slice(start, start + step)
            rows, back = np.unique(row[part], return_inverse=True)
            found[part] = np.einsum("ij,ij->i", probe(rows)[back], base(col[part]))
        return found

    return Exact(cosines, margin(dimensions))


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = _PLACED_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _listed(batch: pa.RecordBatch, row: np.ndarray, cell: np.ndarray) -> pa.RecordBatch:
    """A batch with the list of the cells of each row; ``row`` is sorted. Spark makes the copies."""
    offsets = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(cell.astype(np.int64)))
    return pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "cell"])


def _mixed(batch: pa.RecordBatch) -> np.ndarray:
    """A hash of the row numbers."""
    x = batch.column("id").fill_null(0).to_numpy().astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# --- cells ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class PivotCells:
    """Cells around pivot vectors. ``pivots`` has at most ``max_pivots`` rows."""

    pivots: np.ndarray

    @classmethod
    def choose(cls, table: DataFrame, rows: int, tile: int = TILE_ROWS, max_pivots: int = 1024) -> "PivotCells":
        """Pivots by the smallest hash of the id: the same for every run over the same rows."""
        wanted = min(max_pivots, rows // (2 * tile))
        if wanted < 2:
            return cls(np.empty((0, 0)))
        picked = table.orderBy(F.xxhash64("id")).limit(wanted).select("vec").toArrow()
        return cls(unit_matrix(picked.column("vec")))

    @property
    def single(self) -> bool:
        return len(self.pivots) < 2

    def place(self, base: DataFrame, probe: DataFrame, radius: float | str) -> tuple[DataFrame, DataFrame]:
        """Both tables with a ``cell``. ``radius`` is an angle, or the probe column holding one."""
        if self.single:
            cell = F.lit(0).cast("bigint")
            return base.withColumn("cell", cell), probe.withColumn("cell", cell)
        def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches):
                home, own = self._home(batch)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(home), pa.array(own)], names=[*batch.schema.names, "cell", "angle"]
                )

        homed = base.mapInArrow(nearest, _schema(base, "cell bigint, angle double"))
        extents = self._extents(base)

        def reachable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches):
                yield _listed(batch, *np.nonzero(self._inside(batch, radius, extents)))

        spread = probe.mapInArrow(reachable, _schema(probe, "cell array<bigint>"))
        return homed.drop("angle"), spread.withColumn("cell", F.explode("cell"))

    def deal(self, base: DataFrame, probe: DataFrame, radius: float | str, probe_rows: int, tile: int) -> tuple[DataFrame, DataFrame]:
        """Both tables with a ``cell``: the pair of groups in which rows meet, each row once per pair.

        Cells that lie together fill a group up to a number of rows that follows the tables; a
        cell with more is cut into several. Vectors are copied by the number of groups, which
        stays the same until a group has ``GROUP_BYTES`` (or ``tile`` rows, if these are more).
        """
        extents = self._extents(base)
        counts = extents[2]
        base_rows = int(counts.sum())
        limit = max(tile, GROUP_BYTES // (8 * self.pivots.shape[1]))
        size = -(-base_rows // _parts(base_rows, probe_rows, tile, limit))
        # Packs of neighbouring cells, the groups that each is cut into, and the first of them.
        chain = [cell for cell in self._chain() if counts[cell]]
        packs: list[list[int]] = []
        held = 0
        for cell in chain:
            if not packs or held + counts[cell] > size:
                packs.append([])
                held = 0
            packs[-1].append(cell)
            held += counts[cell]
        if not packs:
            cell = F.lit(0).cast("bigint")
            return base.withColumn("cell", cell).limit(0), probe.withColumn("cell", cell).limit(0)
        starts = np.cumsum([0, *(len(pack) for pack in packs[:-1])])
        pack_of = np.zeros(len(self.pivots), dtype=np.int64)
        pack_of[chain] = np.repeat(np.arange(len(packs)), [len(pack) for pack in packs])
        cuts = np.array([max(1, -(-int(counts[pack].sum()) // size)) for pack in packs])
        first = np.cumsum([0, *cuts[:-1]])

        def reached(batch: pa.RecordBatch) -> np.ndarray:
            return np.logical_or.reduceat(self._inside(batch, radius, extents)[:, chain], starts, axis=1)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = np.zeros(len(packs), dtype=np.int64)
            for batch in _slices(batches):
                rows += reached(batch).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(packs))), pa.array(rows)], names=["pack", "n"])

        # One row per pack.
        probes = np.zeros(len(packs), dtype=np.int64)
        for pack, n in probe.mapInArrow(count, "pack bigint, n bigint").groupBy("pack").agg(F.sum("n")).collect():
            probes[pack] = n
        share = -(-probe_rows // _parts(probe_rows, base_rows, tile, limit))
        strips = -(-probes // max(share, 1))

        def base_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches):
                pack = pack_of[self._home(batch)[0]]
                group = first[pack] + (_mixed(batch) % cuts[pack].astype(np.uint64)).astype(np.int64)
                row = np.repeat(np.arange(len(pack)), strips[pack])
                strip = np.arange(len(row)) - np.repeat(np.cumsum(strips[pack]) - strips[pack], strips[pack])
                yield _listed(batch, row, (group[row] << 24) + strip)

        def probe_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _slices(batches):
                row, pack = np.nonzero(reached(batch))
                salt = _mixed(batch) >> np.uint64(32)
                strip = (salt[row] % strips[pack].astype(np.uint64)).astype(np.int64)
                at = np.repeat(np.arange(len(row)), cuts[pack])
                cut = np.arange(len(at)) - np.repeat(np.cumsum(cuts[pack]) - cuts[pack], cuts[pack])
                yield _listed(batch, row[at], ((first[pack[at]] + cut) << 24) + strip[at])

        return tuple(
            table.mapInArrow(groups, _schema(table, "cell array<bigint>")).withColumn("cell", F.explode("cell"))
            for table, groups in ((base, base_groups), (probe, probe_groups))
        )

    def _home(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """The nearest pivot of each row, the first of equal ones, and the angle to it."""
        angles = _angles(unit_matrix(batch.column("vec")) @ self.pivots.T)
        home = (angles <= angles.min(axis=1, keepdims=True) + _SLACK / 10).argmax(axis=1).astype(np.int64)
        return home, angles[np.arange(len(home)), home]

    def _extents(self, base: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Smallest and largest angle of each cell's rows to its pivot, and their number."""

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low, high = np.full(len(self.pivots), np.inf), np.full(len(self.pivots), -np.inf)
            n = np.zeros(len(self.pivots), dtype=np.int64)
            for batch in _slices(batches):
                home, own = self._home(batch)
                np.fmin.at(low, home, own)
                np.fmax.at(high, home, own)
                np.add.at(n, home, 1)
            (cell,) = np.nonzero(n)
            columns = {"cell": cell, "low": low[cell], "high": high[cell], "n": n[cell]}
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))

        found = base.mapInArrow(measure, "cell bigint, low double, high double, n bigint")
        nearest, farthest = np.full(len(self.pivots), np.inf), np.full(len(self.pivots), -np.inf)
        counts = np.zeros(len(self.pivots), dtype=np.int64)
        # One row per pivot.
        for cell, low, high, n in found.groupBy("cell").agg(F.min("low"), F.max("high"), F.sum("n")).collect():
            nearest[cell], farthest[cell], counts[cell] = low, high, n
        return nearest, farthest, counts

    def _inside(self, batch: pa.RecordBatch, radius: float | str, extents: tuple) -> np.ndarray:
        """Which cells can hold a partner of each row."""
        nearest, farthest, _ = extents
        angles = _angles(unit_matrix(batch.column("vec")) @ self.pivots.T)
        if isinstance(radius, str):
            reach = batch.column(radius).to_numpy(zero_copy_only=False)[:, None] + _SLACK
        else:
            reach = radius + _SLACK
        return (
            (angles <= farthest + reach)
            & (angles >= nearest - reach)
            & (angles - angles.min(axis=1, keepdims=True) <= 2 * reach)
        )

    def _chain(self) -> list[int]:
        """All cells, each followed by the nearest one that is left."""
        cosines = self.pivots @ self.pivots.T
        chain = [0]
        left = np.ones(len(cosines), dtype=bool)
        left[0] = False
        while left.any():
            chain.append(int(np.where(left, cosines[chain[-1]], -np.inf).argmax()))
            left[chain[-1]] = False
        return chain


def _parts(own: int, other: int, tile: int, limit: int) -> int:
    """Into how many parts a table is cut: few where the other one is larger."""
    wanted = round(math.sqrt(_GROUPS * own / max(other, 1)))
    return max(1, -(-own // limit), min(wanted, _GROUPS, -(-own // tile)))


@dataclass(frozen=True)
class SignBands:
    """Locality-sensitive cells: ``bands`` groups of ``bits`` random-projection signs."""

    bands: int = 16
    bits: int = 8
    seed: int = 42
    single = False

    def __post_init__(self) -> None:
        if self.bands < 1 or not 1 <= self.bits <= 48:
            raise ValueError("a band has 1 to 48 bits")

    @classmethod
    def for_recall(cls, threshold: float, recall: float = 0.95, rows: int = 0, cell_rows: int = 256, seed: int = 42) -> "SignBands":
        """Bands that meet a recall for pairs at the threshold.

        Bits grow with the logarithm of the rows, so that a cell of unrelated vectors has about
        ``cell_rows``; two vectors at the threshold share a sign with probability
        ``1 - angle / pi``, which gives the number of bands that reach ``recall``.
        """
        bits = min(48, max(1, round(math.log2(max(2.0, rows / cell_rows)))))
        same = (1 - math.acos(threshold) / math.pi) ** bits
        return cls(max(1, math.ceil(math.log(1 - recall) / math.log1p(-same))) if same < 1 else 1, bits, seed)

    def place(self, base: DataFrame, probe: DataFrame, radius: float | str) -> tuple[DataFrame, DataFrame]:
        return self._banded(base), self._banded(probe)

    def stored(self, table: DataFrame) -> DataFrame:
        return self._banded(table)

    def touched(self, table: DataFrame) -> DataFrame:
        return self._banded(table)

    def _banded(self, table: DataFrame) -> DataFrame:
        bands, bits, seed = self.bands, self.bits, self.seed

        def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            planes = None
            for batch in _slices(batches, max(1, min(_PLACED_ROWS, _STRIP_VALUES // (bands * bits)))):
                matrix = unit_matrix(batch.column("vec"))
                if planes is None or len(planes) != matrix.shape[1]:
                    planes = np.random.default_rng(seed).standard_normal((matrix.shape[1], bands * bits))
                positive = (matrix @ planes > 0).reshape(-1, bands, bits)
                codes = positive @ (1 << np.arange(bits, dtype=np.int64))
                cells = codes + (np.arange(bands, dtype=np.int64) << np.int64(bits))
                yield _listed(batch, np.repeat(np.arange(batch.num_rows), bands), cells.ravel())

        return table.mapInArrow(signs, _schema(table, "cell array<bigint>")).withColumn("cell", F.explode("cell"))

    def pays(self, rows: int, tile: int = TILE_ROWS) -> bool:
        """Whether the bands take less than comparing all rows, tile by tile.

        At a low threshold or a recall near 1 it takes so many bands that copying every vector
        once for each is dearer than all comparisons.
        """
        return self.bands * (rows / 2.0**self.bits + _MOVED) < rows * (1 + _MOVED / tile)


def cells_for_recall(
    table: DataFrame, rows: int, threshold: float, recall: float = 0.95, seed: int = 42, tile: int = TILE_ROWS
) -> PivotCells | SignBands:
    """Bands of signs for a recall where they pay, else the exact cells, which miss nothing."""
    bands = SignBands.for_recall(threshold, recall, rows, seed=seed)
    return bands if bands.pays(rows) else PivotCells.choose(table, rows, tile)


def _schema(table: DataFrame, extra: str) -> str:
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    return f"{own}, {extra}"


# --- the tiled join ------------------------------------------------------------------------

# A reducer gets (base table, probe strip, cosines [strip x base]) and returns output columns. A
# ``single`` one takes cosines in single precision and, as fourth argument, a way to exact ones.
Reducer = Callable[..., list[np.ndarray]]


def single(lower: bool = False) -> Callable[[Reducer], Reducer]:
    """Marks a reducer that takes single precision; with ``lower`` it looks at base rows of lower id only."""

    def mark(reducer: Reducer) -> Reducer:
        reducer.single, reducer.lower = True, lower
        return reducer

    return mark


def tile_join(
    base: DataFrame,
    probe: DataFrame,
    cells: PivotCells | SignBands,
    radius: float | str,
    reducer: Reducer,
    schema: str,
    rows: int | tuple[int, int],
    tile: int = TILE_ROWS,
) -> DataFrame:
    """Bring every probe row together with the base rows of its cells, tile by tile.

    ``rows`` are upper bounds on the sizes of the two tables, or one for both; each table is
    cut by its own size, so a few probe rows copy no base row. They save a counting pass when
    there is a single cell. Extra numeric columns of both tables reach the reducer.
    """
    base_rows, probe_rows = rows if isinstance(rows, tuple) else (rows, rows)
    if isinstance(cells, PivotCells) and not cells.single:
        base, probe = cells.deal(base, probe, radius, probe_rows, tile)
        return (
            base.groupBy("cell").cogroup(probe.groupBy("cell"))
            .applyInArrow(multiplier(reducer, schema), schema).select(*(name for name, _ in _fields(schema)))
        )
    base, probe = cells.place(base, probe, radius)
    if cells.single:
        tiles = {
            "base_tiles": F.lit(max(1, math.ceil(base_rows / tile))),
            "probe_tiles": F.lit(max(1, math.ceil(probe_rows / tile))),
        }
        base, probe = base.withColumns(tiles), probe.withColumns(tiles)
    else:
        sizes = (
            base.groupBy("cell").agg(F.count(F.lit(1)).alias("b"), F.lit(0).cast("bigint").alias("p"))
            .unionByName(probe.groupBy("cell").agg(F.lit(0).cast("bigint").alias("b"), F.count(F.lit(1)).alias("p")))
            .groupBy("cell").agg(F.sum("b").alias("b"), F.sum("p").alias("p"))
        )
        # Only cells over one tile need splitting: at most (all rows / tile) of them.
        large = sizes.filter((F.col("b") > tile) | (F.col("p") > tile)).select(
            "cell",
            F.ceil(F.col("b") / tile).cast("int").alias("base_tiles"),
            F.ceil(F.col("p") / tile).cast("int").alias("probe_tiles"),
        )
        one = {name: F.greatest(F.coalesce(name, F.lit(1)), F.lit(1)) for name in ("base_tiles", "probe_tiles")}
        base = base.join(large, "cell", "left").withColumns(one)
        probe = probe.join(large, "cell", "left").withColumns(one)

    def spread(table: DataFrame, own: str, other: str) -> DataFrame:
        # New aliases, so that a table can be joined with itself.
        return (
            table.select(*(F.col(name).alias(name) for name in table.columns))
            .withColumn(f"{own}_tile", F.pmod(F.xxhash64("id"), F.col(f"{own}_tiles")).cast("int"))
            .withColumn(f"{other}_tile", F.explode(F.sequence(F.lit(0), F.col(f"{other}_tiles") - 1)))
            .drop("base_tiles", "probe_tiles")
        )

    names = [name for name, _ in _fields(schema)]
    keys = ["cell", "base_tile", "probe_tile"]
    return (
        spread(base, "base", "probe").groupBy(*keys)
        .cogroup(spread(probe, "probe", "base").groupBy(*keys))
        .applyInArrow(multiplier(reducer, schema), schema)
        .select(*names)
    )


def multiplier(reducer: Reducer, schema: str) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A co-group's function: the two tables as matrices, strip by strip, through the reducer."""

    def multiply(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = []
        if left.num_rows and right.num_rows:
            left, right = left.sort_by("id"), right.sort_by("id")
            base_rows, probe_rows = _numbers(left), _numbers(right)
            base, vectors = _Rows(left.column("vec")), right.column("vec")
            rows = _STRIP_ROWS if getattr(reducer, "lower", False) else max(1, min(_STRIP_ROWS, _STRIP_VALUES // left.num_rows))
            for start in range(0, right.num_rows, rows):
                strip = {name: values[start : start + rows] for name, values in probe_rows.items()}
                probe = _Rows(vectors.slice(start, rows))
                if not getattr(reducer, "single", False):
                    every = probe.doubles(np.arange(len(strip["id"]))) @ base.doubles(np.arange(left.num_rows)).T
                    found.append(reducer(base_rows, strip, every))
                    continue
                dimensions = base.raw.shape[1]
                if not getattr(reducer, "lower", False):
                    exact = exact_cosines(probe.doubles, base.doubles, dimensions)
                    found.append(reducer(base_rows, strip, probe.unit @ base.unit.T, exact))
                    continue
                # Only lower ids count: base rows from the last id of the strip on are left out, the
                # others come in parts whose cosines stay in the processor's cache.
                end, step = np.searchsorted(base_rows["id"], strip["id"][-1]), max(_STRIP_COLUMNS, dimensions)
                for first in range(0, end, step):
                    last = min(first + step, end)
                    part = {name: values[first:last] for name, values in base_rows.items()}
                    exact = exact_cosines(probe.doubles, lambda rows, first=first: base.doubles(rows + first), dimensions)
                    found.append(reducer(part, strip, probe.unit @ base.unit[first:last].T, exact))
        if not found:
            return pa.table({name: pa.array([], type=_ARROW[kind]) for name, kind in _fields(schema)})
        columns = [np.concatenate(parts) for parts in zip(*found)]
        return pa.table(
            {
                name: pa.array(values, type=_ARROW[kind])
                for (name, kind), values in zip(_fields(schema), columns, strict=True)
            }
        )

    return multiply


_ARROW = {"bigint": pa.int64(), "double": pa.float64()}


def _fields(schema: str) -> list[tuple[str, str]]:
    return [tuple(part.split()) for part in schema.split(",")]


def _numbers(table: pa.Table) -> dict[str, np.ndarray]:
    skip = {"vec", "cell", "base_tile", "probe_tile"}
    return {
        name: table.column(name).to_numpy() for name in table.column_names if name not in skip
    }


# --- reducers ------------------------------------------------------------------------------


def similar_cells(cosines: np.ndarray, threshold: float, exact: Exact | None) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns that may reach the threshold: all that do, by exact cosines."""
    least = threshold if exact is None else np.float32(threshold - 2 * exact.margin)
    return np.divmod(np.flatnonzero(cosines >= least), cosines.shape[1])


def exact_values(cosines: np.ndarray, row: np.ndarray, col: np.ndarray, exact: Exact | None) -> np.ndarray:
    return cosines[row, col] if exact is None else exact.cosines(row, col)


def reached(cosines: np.ndarray, row: np.ndarray, col: np.ndarray, threshold: float, exact: Exact | None) -> np.ndarray:
    """The rows with a cosine over the threshold; only those that are open are multiplied again."""
    values = cosines[row, col]
    if exact is None:
        return np.unique(row[values >= threshold])
    hit = np.zeros(len(cosines), dtype=bool)
    hit[row[values >= threshold + 2 * exact.margin]] = True
    row, col = row[~hit[row]], col[~hit[row]]
    hit[row[exact.cosines(row, col) >= threshold]] = True
    return np.flatnonzero(hit)


def _lower(base: dict, probe: dict, cosines: np.ndarray, threshold: float, exact: Exact | None) -> tuple[np.ndarray, np.ndarray]:
    row, col = similar_cells(cosines, threshold, exact)
    lower = base["id"][col] < probe["id"][row]
    return row[lower], col[lower]


def has_lower(threshold: float) -> Reducer:
    """Ids of probe rows with a similar base row of lower id."""

    @single(lower=True)
    @single()
    def reduce(base, probe, cosines, exact=None):
        return [probe["id"][reached(cosines, *_lower(base, probe, cosines, threshold, exact), threshold, exact)]]

    return reduce


def best_lower(threshold: float) -> Reducer:
    """Probe rows with a similar base row of lower id, and the most similar one (ties to the lower id)."""

    @single(lower=True)
    def reduce(base, probe, cosines, exact=None):
        row, col = _lower(base, probe, cosines, threshold, exact)
        values = exact_values(cosines, row, col, exact)
        order = np.lexsort((col, -values, row))
        order = order[values[order] >= threshold]
        order = order[np.diff(row[order], prepend=-1) > 0]
        return [probe["id"][row[order]], base["id"][col[order]], values[order]]

    return reduce


def lower_pairs(threshold: float) -> Reducer:
    """All similar pairs with the lower id on the base side."""

    @single(lower=True)
    def reduce(base, probe, cosines, exact=None):
        row, col = _lower(base, probe, cosines, threshold, exact)
        values = exact_values(cosines, row, col, exact)
        similar = values >= threshold
        return [base["id"][col[similar]], probe["id"][row[similar]], values[similar]]

    return reduce


def improving(threshold: float) -> Reducer:
    """Per probe row, the similar base rows that beat every base row before them."""

    @single()
    def reduce(base, probe, cosines, exact=None):
        # Only rows and columns that hold a similar pair are walked.
        row, col = similar_cells(cosines, threshold, exact)
        (rows, at), (cols, beside) = np.unique(row, return_inverse=True), np.unique(col, return_inverse=True)
        scores = np.full((len(rows), len(cols)), -np.inf)
        scores[at, beside] = exact_values(cosines, row, col, exact)
        scores[scores < threshold] = -np.inf
        best = np.maximum.accumulate(scores, axis=1)
        before = np.hstack([np.full((len(best), 1), -np.inf), best[:, :-1]])
        row, col = np.nonzero(scores > before)
        return [probe["id"][rows[row]], base["id"][cols[col]], scores[row, col]]

    return reduce


def nearest(k: int) -> Reducer:
    """Per probe row, the k most similar base rows (ties to the lower id)."""

    def reduce(base, probe, cosines, exact=None):
        limit = min(k, cosines.shape[1])
        cut = np.partition(cosines, cosines.shape[1] - limit, axis=1)[:, -limit]
        if exact is not None:
            cut = (cut - 4 * exact.margin).astype(np.float32)
        row, col = np.nonzero(cosines >= cut[:, None])
        values = exact_values(cosines, row, col, exact)
        order = np.lexsort((base["id"][col], -values, row))
        row, col, values = row[order], col[order], values[order]
        starts = np.searchsorted(row, np.arange(len(cosines)))
        top = np.arange(len(row)) - starts[row] < limit
        row, col, values = row[top], col[top], values[top]
        return [probe["id"][row], base["id"][col], values]

    return reduce


# --- operators -----------------------------------------------------------------------------


def vector_table(df: DataFrame, vector: str, order: str) -> DataFrame:
    """The two columns the joins work on."""
    return df.select(column(order).cast("bigint").alias("id"), column(vector).alias("vec"))


def repeated_vectors(table: DataFrame, digests: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``id, digest`` of every row, and ``digest, first, copies`` of every distinct vector.

    The digest is 128 bits: two hashes, of the vector and of its reverse. The vectors
    themselves are not shuffled. ``digests`` (id, digest) are those of vectors in another form.
    """
    digest = F.array(F.xxhash64("vec"), F.xxhash64(F.reverse("vec")))
    marked = table.select("id", digest.alias("digest")) if digests is None else digests
    firsts = marked.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    return marked, cut_lineage(firsts, "firsts")


def check_threshold(threshold: float) -> None:
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")


def _pairs(df: DataFrame, vector: str, order: str, threshold: float, choose: Callable, tile: int, once: bool = False) -> DataFrame:
    """Pairs over the threshold between distinct vectors, plus one pair per repeated vector.

    With ``once`` a pair of ids is reported once, however often rows or cells bring it.
    """
    check_threshold(threshold)
    table = vector_table(df, vector, order)
    marked, firsts = repeated_vectors(table)
    distinct = table.join(firsts.select(F.col("first").alias("id")), "id", "left_semi")
    rows = firsts.count()
    cells = choose(distinct, rows)
    found = tile_join(
        distinct, distinct, cells, math.acos(threshold), lower_pairs(threshold),
        "left_id bigint, right_id bigint, similarity double", rows, tile,
    )
    if once:
        found = found.groupBy("left_id", "right_id").agg(F.max("similarity").alias("similarity"))
    repeated = firsts.filter("copies > 1")
    copies = (
        hot_join(marked, repeated, "digest", "id", repeated.select("digest", F.col("copies").alias("n")))
        .filter(F.col("id") > F.col("first"))
        .select(F.col("first").alias("left_id"), F.col("id").alias("right_id"), F.lit(1.0).alias("similarity"))
    )
    return found.unionByName(copies)


def similar_pairs(
    df: DataFrame, vector: str, threshold: float, order: str = "row_index", tile: int = TILE_ROWS
) -> DataFrame:
    """All pairs ``left_id < right_id`` of distinct vectors with similarity >= threshold.

    A vector that occurs several times takes part once, as its first row; each later copy is
    reported as one pair with that first row. The result is complete, yet copies cost one
    record each instead of one record per pair of copies.
    """
    return _pairs(df, vector, order, threshold, lambda table, rows: PivotCells.choose(table, rows, tile), tile)


def similar_pairs_approx(
    df: DataFrame,
    vector: str,
    threshold: float,
    order: str = "row_index",
    recall: float = 0.95,
    seed: int = 42,
    tile: int = TILE_ROWS,
) -> DataFrame:
    """Like ``similar_pairs``, comparing only vectors that share a band of signs.

    Finds a pair at the threshold with probability ``recall``, closer ones more surely, and
    never reports a wrong one: every candidate is checked exactly. Where the bands that this
    takes are dearer than comparing all vectors, all are compared.
    """
    return _pairs(
        df, vector, order, threshold, lambda table, rows: cells_for_recall(table, rows, threshold, recall, seed, tile), tile, True
    )


def top_k(query: DataFrame, corpus: DataFrame, k: int, tile: int = TILE_ROWS, cells: PivotCells | None = None) -> DataFrame:
    """``query_id, match_id, similarity, rank``: the k best corpus rows for every query row.

    With several cells, a first pass against the query's own cell gives a bound on its k-th
    angle; the second pass visits only the cells the bound allows.
    """
    if k < 1:
        raise ValueError("k must be positive")
    schema = "query_id bigint, match_id bigint, similarity double"
    corpus_rows, query_rows = corpus.count(), query.count()
    rows = (corpus_rows, query_rows)
    cells = cells or PivotCells.choose(corpus, corpus_rows, tile)
    radius: float | str = math.pi
    if not cells.single:
        near = tile_join(corpus, query, cells, 0.0, nearest(k), schema, rows, tile)
        bound = (
            _ranked(near, k).filter(F.col("rank") == k)
            .select(F.col("query_id").alias("id"), F.acos(F.greatest(F.least("similarity", F.lit(1.0)), F.lit(-1.0))).alias("reach"))
        )
        # Written, as the second pass reads it twice: to deal the rows and to move them.
        query = cut_lineage(query.join(bound, "id", "left").withColumn("reach", F.coalesce("reach", F.lit(math.pi))), "bounded")
        radius = "reach"
    found = tile_join(corpus, query, cells, radius, nearest(k), schema, rows, tile)
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "match_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k_neighbors(
    query: DataFrame,
    corpus: DataFrame,
    k: int,
    vector: str = "embedding",
    query_id: str = "row_index",
    corpus_id: str = "row_index",
    tile: int = TILE_ROWS,
) -> DataFrame:
    """The k corpus rows with the largest inner product for every query row.

    Columns ``query_id, match_id, similarity, rank``; equal similarities rank by lower id.
    """
    return top_k(vector_table(query, vector, query_id), vector_table(corpus, vector, corpus_id), k, tile)
