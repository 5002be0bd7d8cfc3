"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.operators.rows import cut_lineage

#: Edges a task contracts at a time (16 bytes each).
LOCAL_EDGES = 1 << 18


def components(edges: DataFrame, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """``id, label`` for every end of ``edges`` (a, b): the smallest id it is connected to.

    Each task first replaces its edges by stars of the components they form among themselves.
    Then large-star and small-star steps (Kiveris et al., 2014) alternate until only stars are
    left: every step is a grouped minimum and an equi-join whose other side has one row per
    node, so adaptive execution can split a hub with any number of neighbours. Edges with a
    null end and loops are left out; no edges give no rows.
    """

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
            size += batch.num_rows
            if size >= local_edges:
                yield _stars(held)
                held, size = [], 0
        if size:
            yield _stars(held)

    pairs = edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).filter("a <> b")
    links = cut_lineage(pairs.mapInArrow(contract, "hi bigint, lo bigint").distinct(), "links")
    while not _only_stars(links):
        links = cut_lineage(_small_star(_large_star(links)), "stars")
    roots = links.select(F.col("lo").alias("id"), F.col("lo").alias("label")).distinct()
    return links.select(F.col("hi").alias("id"), F.col("lo").alias("label")).unionByName(roots)


def _only_stars(links: DataFrame) -> bool:
    """No node has two smaller neighbours, and no smaller neighbour has one itself."""
    ends = links.groupBy("hi").agg(F.count(F.lit(1)).alias("n"))
    if ends.filter("n > 1").limit(1).count():
        return False
    middle = links.select(F.col("lo").alias("hi")).distinct()
    return links.join(middle, "hi", "left_semi").limit(1).count() == 0


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("least", "u"))
    return (
        both.filter("v > u").join(least, "u")
        .select(F.col("v").alias("hi"), F.col("least").alias("lo")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    least = links.groupBy("hi").agg(F.min("lo").alias("least"))
    moved = links.join(least, "hi").filter("lo <> least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("least").alias("lo"))).distinct()


def _stars(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    ends = np.concatenate([a for a, _ in held] + [b for _, b in held])
    ids, index = np.unique(ends, return_inverse=True)
    half = len(ends) // 2
    # Hooking each end to the smaller label, then shortening all paths, until stable.
    label = np.arange(len(ids))
    left, right = index[:half], index[half:]
    while True:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, before[left], low)
        np.minimum.at(label, before[right], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(label, before):
            break
    moved = label != np.arange(len(ids))
    return pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[label[moved]])], names=["hi", "lo"])
