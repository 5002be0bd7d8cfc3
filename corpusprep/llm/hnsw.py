"""Approximate nearest neighbours: a navigable small-world graph per shard.

Distinct vectors are dealt to shards of about ``SHARD_ROWS``. Each shard becomes one index: the
nodes' layers (a node is in layer l with probability ``WIDTH ** -l``) and, for each layer, a flat
array of neighbours. Layers are filled from the top, nodes in batches: a beam search in the part
that stands gives each node's candidates, of which those closer to the node than to a chosen
one are linked, and the links' other ends are trimmed the same way. A query is answered by
every shard; the shards' answers are merged by exact distances.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import matrix_of
from corpusprep.operators.rows import column, cut_lineage

#: Vectors of a shard: about 5 MB with 64 components and the links, some 20 s to build.
SHARD_ROWS = 8192
#: Links of a node in the upper layers; the lowest has twice as many.
WIDTH = 16
#: Candidates kept while building and while searching.
BUILD_BEAM, SEARCH_BEAM = 64, 160
#: Candidates kept in the upper layers, and those from which the next layer is entered.
UPPER_BEAM, ENTRIES = 24, 8
#: Nodes added at a time, nodes expanded at a time, queries walked at a time.
BATCH, EXPAND, QUERY_BLOCK = 256, 4, 256
#: Powers of two of the largest component that go to shards of their own.
BAND = 256


def finite_vectors(df: DataFrame, id_col: str, vec_col: str, *more: str) -> DataFrame:
    """``id, vec`` (array<double>) and columns ``more`` of the rows whose vector takes part.

    Vectors that are null, empty or zero, or hold null, NaN or infinite components take no part.
    """
    vec = column(vec_col).cast("array<double>")
    rows = df.select(column(id_col).cast("bigint").alias("id"), vec.alias("vec"), *[column(c) for c in more])
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("vec").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("vec", lambda x: x != 0))


def valid_vectors(df: DataFrame, id_col: str, vec_col: str, *more: str) -> DataFrame:
    """``finite_vectors`` of the commonest length (the longer on a tie): others have no distance to them."""
    good = finite_vectors(df, id_col, vec_col, *more)
    # One row per length.
    length = good.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return good.filter(F.size("vec") == (length["n"] if length else 0))


# --- one index -----------------------------------------------------------------------------


def _levels(keys: np.ndarray) -> np.ndarray:
    """The highest layer of each node, drawn from a hash of its key."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    unit = ((z >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
    return np.floor(-np.log(unit) / np.log(WIDTH)).astype(np.int64)


def _squares(difference: np.ndarray) -> np.ndarray:
    """Squared lengths, in double precision; what overflows is as far as can be."""
    with np.errstate(over="ignore"):
        return np.minimum(np.einsum("...d,...d->...", difference, difference), np.finfo(np.float64).max)


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to one vector; they neither overflow nor underflow on the way."""
    with np.errstate(over="ignore"):
        difference = np.abs(vectors - query)
        largest = difference.max(axis=-1, keepdims=True)
        safe = np.where((largest > 0) & np.isfinite(largest), largest, 1.0)
        plain = np.sqrt((difference**2).sum(axis=-1))
        scaled = safe[..., 0] * np.sqrt(((difference / safe) ** 2).sum(axis=-1))
    usual = (largest[..., 0] < 1e150) & ((largest[..., 0] > 1e-150) | (largest[..., 0] == 0))
    return np.where(usual, plain, scaled)


class Index:
    """Vectors, layers and flat neighbour arrays (-1 where a node has fewer)."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray], entry: int):
        self.vectors, self.links, self.entry = vectors, links, entry

    @classmethod
    def build(cls, vectors: np.ndarray, keys: np.ndarray) -> Index:
        levels = _levels(keys)
        order = np.lexsort((keys, -levels))
        top = int(levels[order[0]])
        index = cls(vectors, [np.zeros((0, 0), np.int32)] * (top + 1), int(order[0]))
        for layer in range(top, -1, -1):
            index._fill(layer, order[levels[order] >= layer], WIDTH if layer else 2 * WIDTH)
        return index

    def _fill(self, layer: int, nodes: np.ndarray, width: int) -> None:
        links = np.full((len(self.vectors), width), -1, np.int32)
        self.links[layer] = links
        done = 0
        while done < len(nodes):
            size = min(BATCH, len(nodes) - done, max(32, done))
            batch = nodes[done : done + size]
            own = self._pairs(batch)
            np.fill_diagonal(own, np.inf)
            ids, near = np.broadcast_to(batch, (size, size)), own
            if done:
                found, far = self._beam(self.vectors[batch], self._descend(self.vectors[batch], layer), layer, BUILD_BEAM)
                ids, near = np.concatenate([found, ids], axis=1), np.concatenate([far, near], axis=1)
            chosen = self._choose(ids, near, min(WIDTH, width))
            links[batch, : chosen.shape[1]] = chosen
            self._link_back(links, batch, chosen)
            done += size

    def _pairs(self, nodes: np.ndarray) -> np.ndarray:
        return np.stack([_squares(self.vectors[nodes] - self.vectors[node]) for node in nodes])

    def _choose(self, ids: np.ndarray, near: np.ndarray, width: int) -> np.ndarray:
        """Of each row's candidates up to ``width``, none closer to a chosen one than to the row."""
        most = min(ids.shape[1], max(BUILD_BEAM, 2 * width))
        order = np.argpartition(near, most - 1, axis=1)[:, :most]
        order = np.take_along_axis(order, np.argsort(np.take_along_axis(near, order, 1), axis=1, kind="stable"), 1)
        ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
        real = np.isfinite(near) & (ids >= 0)
        safe = np.where(real, ids, 0)
        # From each row's nearest candidate as origin, so that nothing is lost far from 0.
        v = self.vectors[safe] - self.vectors[safe[:, :1]]
        squares = _squares(v)
        between = np.maximum(squares[:, :, None] + squares[:, None, :] - 2 * v @ v.transpose(0, 2, 1), 0)
        chosen = np.full((len(ids), width), -1, np.int64)
        count = np.zeros(len(ids), np.int64)
        kept = np.zeros(ids.shape, bool)
        rows = np.arange(len(ids))
        for k in range(ids.shape[1]):
            nearest = np.where(kept, between[:, k, :], np.inf).min(axis=1)
            take = real[:, k] & (nearest > near[:, k]) & (count < width)
            kept[:, k] = take
            chosen[rows[take], count[take]] = ids[take, k]
            count += take
        # Places that are left go to the nearest of the others.
        for k in range(ids.shape[1]):
            take = real[:, k] & ~kept[:, k] & (count < width)
            chosen[rows[take], count[take]] = ids[take, k]
            count += take
        return chosen

    def _link_back(self, links: np.ndarray, batch: np.ndarray, chosen: np.ndarray) -> None:
        to, source = chosen.ravel(), np.repeat(batch, chosen.shape[1])
        to, source = to[to >= 0], source[to >= 0]
        order = np.argsort(to, kind="stable")
        to, source = to[order], source[order]
        targets, begin, count = np.unique(to, return_index=True, return_counts=True)
        most = int(count.max(initial=0))
        if not most:
            return
        new = np.full((len(targets), most), -1, np.int64)
        new[np.repeat(np.arange(len(targets)), count), np.arange(len(to)) - np.repeat(begin, count)] = source
        old = links[targets].astype(np.int64)
        new[(new[:, :, None] == old[:, None, :]).any(axis=2)] = -1
        both = np.concatenate([old, new], axis=1)
        room = (both >= 0).sum(axis=1) <= links.shape[1]
        packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, : links.shape[1]]
        links[targets[room]] = packed[room]
        full = np.flatnonzero(~room)
        for low in range(0, len(full), BATCH):
            part = full[low : low + BATCH]
            ids = both[part]
            safe = np.maximum(ids, 0)
            centre = targets[part]
            near = _squares(self.vectors[safe] - self.vectors[centre][:, None])
            links[centre] = self._choose(ids, np.where(ids >= 0, near, np.inf), links.shape[1])

    def _descend(self, queries: np.ndarray, layer: int) -> np.ndarray:
        """The nodes of the layer above that a walk from the top reaches, nearest first."""
        at = np.full((len(queries), 1), self.entry)
        for above in range(len(self.links) - 1, layer, -1):
            found, _ = self._beam(queries, at, above, UPPER_BEAM)
            at = found[:, :ENTRIES]
        return at

    def _beam(self, queries: np.ndarray, entries: np.ndarray, layer: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest nodes of a layer found for each query, nearest first (-1, inf where fewer)."""
        links, count = self.links[layer], len(queries)
        ids = np.full((count, width), -1, np.int64)
        near = np.full((count, width), np.inf)
        opened = np.zeros((count, width), bool)
        seen = np.zeros((count, len(self.vectors)), bool)
        rows = np.arange(count)
        begun = min(width, entries.shape[1])
        ids[:, :begun] = entries[:, :begun]
        real = ids[:, :begun] >= 0
        near[:, :begun] = np.where(real, _squares(self.vectors[np.maximum(ids[:, :begun], 0)] - queries[:, None]), np.inf)
        r, c = np.nonzero(real)
        seen[r, ids[r, c]] = True
        active = rows
        while len(active):
            closed = np.where(opened[active], np.inf, near[active])
            pick = np.argsort(closed, axis=1, kind="stable")[:, : min(EXPAND, width)]
            some = np.isfinite(np.take_along_axis(closed, pick, 1))
            going = some[:, 0]
            active, pick, some = active[going], pick[going], some[going]
            if not len(active):
                break
            opened[active[:, None], pick] |= some
            nodes = np.where(some, ids[active[:, None], pick], -1)
            reached = np.where((nodes >= 0)[:, :, None], links[np.maximum(nodes, 0)], -1).reshape(len(active), -1).astype(np.int64)
            fresh = (reached >= 0) & ~seen[active[:, None], np.maximum(reached, 0)]
            # The same node reached twice at once counts once.
            order = np.argsort(reached, axis=1, kind="stable")
            ranked = np.take_along_axis(reached, order, 1)
            twice = np.zeros(reached.shape, bool)
            np.put_along_axis(twice, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], 1)
            fresh &= ~twice
            r, c = np.nonzero(fresh)
            far = np.full(fresh.shape, np.inf)
            far[r, c] = _squares(self.vectors[reached[r, c]] - queries[active[r]])
            seen[active[r], reached[r, c]] = True
            all_ids = np.concatenate([ids[active], np.where(fresh, reached, -1)], axis=1)
            all_near = np.concatenate([near[active], far], axis=1)
            all_open = np.concatenate([opened[active], np.zeros(far.shape, bool)], axis=1)
            best = np.argsort(all_near, axis=1, kind="stable")[:, :width]
            ids[active] = np.take_along_axis(all_ids, best, 1)
            near[active] = np.take_along_axis(all_near, best, 1)
            opened[active] = np.take_along_axis(all_open, best, 1)
        return ids, near

    def search(self, queries: np.ndarray, k: int, beam: int = SEARCH_BEAM) -> np.ndarray:
        """The ``k`` nearest nodes found, nearest first; -1 where there are fewer."""
        return self._beam(queries, self._descend(queries, 0), 0, max(beam, k))[0][:, :k]

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, vectors=self.vectors, entry=self.entry, **{f"links{k}": a for k, a in enumerate(self.links)})
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Index:
        held = np.load(io.BytesIO(raw))
        return cls(held["vectors"], [held[f"links{k}"] for k in range(len(held.files) - 2)], int(held["entry"]))


# --- tables --------------------------------------------------------------------------------


def build_shards(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``shard, band, ids, vectors, index``: an index of each shard of the distinct vectors in ``id, vec``.

    ``ids`` holds, for each node, the smallest ``k + 1`` ids of the rows with its vector: enough
    for any answer of ``k``, however many copies there are. Every row is indexed. Vectors whose
    largest components are more than 2^128 apart go to different shards, walked in a scale of
    their own, so that squares neither overflow nor vanish.
    """
    by = Window.partitionBy("vec").orderBy("id")
    firsts = vectors.withColumn("copy", F.row_number().over(by)).filter(F.col("copy") <= k + 1)
    largest = F.array_max(F.transform("vec", lambda x: F.abs(x)))
    distinct = firsts.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    distinct = cut_lineage(distinct.withColumn("band", F.round(F.log2(largest) / BAND).cast("int")), "distinct-vectors")
    # One row per band, of which doubles have nine.
    first, starts = 0, []
    for band, count in sorted(distinct.groupBy("band").count().collect()):
        starts.append((band, first, max(1, -(-count // shard_rows))))
        first += starts[-1][2]
    bands = distinct.sparkSession.createDataFrame(starts, "band int, first int, parts int")
    place = F.col("first") + F.pmod(F.xxhash64("vec"), F.col("parts")).cast("int")
    placed = distinct.join(F.broadcast(bands), "band").withColumn("shard", place)

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("ids", key=lambda s: s.map(lambda x: x[0]), kind="stable")
        band = int(group["band"].iloc[0])
        matrix = np.ldexp(np.stack(group["vec"].to_numpy()).astype(np.float64), -BAND * band)
        index = Index.build(matrix, np.array([x[0] for x in group["ids"]], np.int64))
        row = {"shard": int(group["shard"].iloc[0]), "band": band, "ids": list(group["ids"]), "index": index.dump()}
        return pd.DataFrame([row])

    # As many tasks as shards, each dealt its own.
    dealt = placed.repartitionById(max(1, first), F.col("shard"))
    built = dealt.groupBy("shard").applyInPandas(build, "shard int, band int, ids array<array<bigint>>, index binary")
    return cut_lineage(built, "shards")


def search(shards: DataFrame, queries: DataFrame, k: int = 10, beam: int = SEARCH_BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for each of ``id, vec``.

    Euclidean distances in double precision on the vectors as given; ties go to the smaller
    id; a row is no answer to itself. Queries are sent to the shards, where one block of them
    is walked at a time; an index is sent once to each of the few tasks that share its shard,
    whose number follows the cores, not the queries. Without shards or queries there are no rows.
    """
    spark = shards.sparkSession
    count = shards.count()
    tasks = max(1, -(-spark.sparkContext.defaultParallelism // max(1, count)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(max(1, n) - 1)))
    asked = queries.select(
        every(count).alias("shard"), F.pmod(F.xxhash64("id", F.lit(7)), F.lit(tasks)).cast("int").alias("share"),
        F.lit(None).cast("int").alias("band"), F.lit(None).cast("array<array<bigint>>").alias("ids"), F.lit(None).cast("binary").alias("index"), "id", "vec",
    )
    indexes = shards.select(
        "shard", every(tasks).alias("share"), "band", "ids", "index", F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("array<double>").alias("vec")
    )
    both = asked.unionByName(indexes.select(*asked.columns))
    dealt = both.repartitionById(max(1, count) * tasks, F.col("shard") * tasks + F.col("share"))

    def answers(index: Index, members: list, band: int, names: list[int], matrix: np.ndarray) -> pa.RecordBatch:
        width, at = index.vectors.shape[1], []
        if matrix.shape[1] == width:
            found = index.search(np.ldexp(matrix, -BAND * band), k + 1, beam)
            for name, query, nodes in zip(names, matrix, found):
                nodes = nodes[nodes >= 0]
                near = distances(np.ldexp(index.vectors[nodes], BAND * band), query)
                mine = sorted((float(d), i) for node, d in zip(nodes.tolist(), near) for i in members[node] if i != name)
                at += [(name, i, d) for d, i in mine[:k]]
        columns = list(zip(*at)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = members = band = None
        for batch in batches:  # the index of the task's shard stands first
            if index is None:
                index, members, band = Index.load(batch.column("index")[0].as_py()), batch.column("ids")[0].as_py(), batch.column("band")[0].as_py()
                batch = batch.slice(1)
            for low in range(0, batch.num_rows, QUERY_BLOCK):
                part = batch.slice(low, QUERY_BLOCK)
                yield answers(index, members, band, part.column("id").to_pylist(), matrix_of(part.column("vec")))

    ordered = dealt.sortWithinPartitions(F.col("id").isNotNull(), "id")
    found = ordered.mapInArrow(run, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(df: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", shard_rows: int = SHARD_ROWS,
            beam: int = SEARCH_BEAM) -> DataFrame:
    """Index every valid vector and search for those for which ``is_query(id)`` holds.

    Rows without an id take no part. Repeated rows with one id and vector are one candidate;
    an id with several vectors is asked once for each.
    """
    vectors = cut_lineage(valid_vectors(df, id_col, vec_col).filter("id is not null").distinct(), "vectors")
    shards = build_shards(vectors, k, shard_rows)
    return search(shards, vectors.filter(is_query(F.col("id"))), k, beam)
