"""Fixed-number clustering and its row-level columns."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.operators.rows import column, cut_lineage

NOISE = -1


def kmeans(
    df: DataFrame, vector: str = "embedding", k: int = 8, seed: int = 42, order: str = "row_index"
) -> DataFrame:
    """``row_index, cluster_id`` for every row that has a vector.

    Cluster numbers follow the smallest row number of each cluster.
    """
    points = df.filter(column(vector).isNotNull()).select(
        column(order).cast("bigint").alias("row_index"), array_to_vector(column(vector)).alias("features")
    )
    # KMeans reads its input once per iteration: from a written table, which survives lost executors.
    points = cut_lineage(points, "points")
    rows = points.count()
    if rows < k:
        raise ValueError(f"KMeans 的聚类数 {k} 大于可用文本数 {rows}")
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="found").fit(points)
    found = cut_lineage(model.transform(points).select("row_index", "found"), "kmeans")
    # k rows.
    firsts = found.groupBy("found").agg(F.min("row_index").alias("first")).collect()
    numbers = {row.found: i for i, row in enumerate(sorted(firsts, key=lambda row: row.first))}
    renumber = df.sparkSession.createDataFrame(list(numbers.items()), "found int, cluster_id int")
    return found.join(F.broadcast(renumber), "found").select("row_index", "cluster_id")
