"""Cluster tables, KMeans, projection, whole clustering, scoring."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.operators import cluster_tables as T
from corpusprep.operators import scoring
from corpusprep.operators.clustering import kmeans
from corpusprep.operators.encoding import encode
from corpusprep.operators.projection import project_3d
from corpusprep.plans.cluster_texts import cluster_texts
from test_semantic import clustered, table


@pytest.fixture(scope="module")
def fixture(spark):
    return spark.createDataFrame(
        [
            (0, "退款怎么申请", "售后", [1.0, 0.0], 0),
            (1, "怎么申请退款", "售后", [0.99, 0.01], 0),
            (2, "我要开发票", "财务", [0.0, 1.0], 1),
            (3, "", "其他", None, -1),
        ],
        "row_index bigint, text string, category string, embedding array<float>, given int",
    )


def run(df, **options):
    assignment = df.select("row_index", F.col("given").alias("cluster_id"))
    return cluster_texts(df, vector="embedding", assignment=assignment, **options)


def test_fixture_rows(fixture):
    result = run(fixture)
    rows = [tuple(r) for r in result.clustered().drop("category", "embedding", "given").orderBy("row_index").collect()]
    first = ("退款怎么申请", "申请, 退款", "退款怎么申请")
    assert rows == [
        (0, "退款怎么申请", 0, False, 2, *first),
        (1, "怎么申请退款", 0, False, 2, *first),
        (2, "我要开发票", 1, False, 1, "我要开发票", "发票, 开发", "我要开发票"),
        (3, "", -1, True, 1, "", "", ""),
    ]
    stats = result.stats().first()
    assert (stats.total_before, stats.total_clustered, stats.noise_rows, stats.cluster_count) == (4, 3, 1, 2)
    assert (stats.largest_cluster_size, stats.smallest_cluster_size, stats.average_cluster_size) == (2, 1, 1.5)
    placed = {r.row_index: (r.x, r.y, r.z) for r in result.projection().collect()}
    assert placed[0] == (1.0, 0.0, 0.0) and placed[2] == (0.0, 1.0, 0.0) and placed[3] == (None, None, None)
    summary = result.summary().collect()
    assert [(r.cluster_id, r.cluster_size, r.example_texts) for r in summary] == [
        (0, 2, "退款怎么申请 | 怎么申请退款"), (1, 1, "我要开发票"),
    ]
    analysis = result.analysis().orderBy("cluster_rank").collect()
    assert [(r.cluster_rank, r.cluster_id, r.cluster_ratio) for r in analysis] == [(1, 0, 0.6667), (2, 1, 0.3333)]


def test_given_labels_and_context(spark, fixture):
    labels = spark.createDataFrame([(0, " 售后退款流程"), (1, " ")], "cluster_id bigint, label string")
    result = run(fixture, labels=labels, sample_size=1)
    assert {r.cluster_id: r.cluster_label for r in result.facts.collect()} == {0: "售后退款流程", 1: "我要开发票"}
    context = {r.cluster_id: r for r in result.label_context().collect()}
    assert context[0].sample_texts == ["退款怎么申请"] and context[0].top_keyword_list == ["申请", "退款"]
    full = {r.cluster_id: r for r in run(fixture).label_context().collect()}
    assert full[0].prompt == (
        "簇编号：0\n簇大小：2\n代表问题：退款怎么申请\n高频关键词：申请、退款\n示例问题：\n- 退款怎么申请\n- 怎么申请退款"
    )
    with pytest.raises(ValueError):
        run(fixture, sample_size=0).label_context()


def test_rule_label(spark):
    df = spark.createDataFrame(
        [("黄金, 基金", "什么是股票基金？"), ("基金", "什么是股票基金？"), ("a", ""), ("", "x"), ("", "")], "k string, r string"
    )
    got = [r[0] for r in df.select(T.rule_label(F.col("k"), F.col("r"))).collect()]
    assert got == ["黄金 | 什么是股票基金？", "什么是股票基金？", "a | ", "x", ""]


def test_analysis_ratios(spark):
    summary = spark.createDataFrame(
        [(1, 1, "b", "", "", ""), (0, 3, "a", "", "", "")],
        "cluster_id int, cluster_size bigint, cluster_label string, top_keywords string, representative_text string, example_texts string",
    )
    stats = spark.createDataFrame([(5, 4)], "total_before bigint, total_clustered bigint")
    rows = T.cluster_analysis(summary, stats).orderBy("cluster_rank").collect()
    assert [(r.cluster_rank, r.cluster_id, r.cluster_ratio) for r in rows] == [(1, 0, 0.75), (2, 1, 0.25)]


def test_kmeans(spark):
    matrix = clustered(34, 4, 20, 6, 0.05)
    df = table(spark, matrix)
    labels = [r.cluster_id for r in sorted(kmeans(df, k=4).collect())]
    assert labels[0] == 0 and set(labels) == {0, 1, 2, 3}
    same = matrix @ matrix.T > 0.8
    assert all((labels[i] == labels[j]) == same[i, j] for i in range(80) for j in range(80))
    two = df.limit(2)
    with pytest.raises(ValueError, match="聚类数 3 大于可用文本数 2"):
        kmeans(two, k=3)


def test_projection_is_pca(spark):
    matrix = clustered(33, 5, 12, 7, 0.3)
    df = table(spark, matrix).selectExpr("row_index", "'t' AS text", "0 AS cluster_id", "embedding")
    rows = sorted(project_3d(df).collect())
    centered = matrix - matrix.mean(axis=0)
    _, _, axes = np.linalg.svd(centered)
    want = centered @ axes[:3].T
    got = np.array([[r.x, r.y, r.z] for r in rows])
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-5)
    single = project_3d(df.limit(1)).first()
    assert (single.x, single.y, single.z) == (0.0, 0.0, 0.0)
    pair = project_3d(df.filter("row_index < 2")).collect()
    assert all(r.z == 0.0 for r in pair) and pair[0].x == pytest.approx(-pair[1].x, abs=1e-6)


@pytest.mark.parametrize("mode", ["kmeans", "hdbscan"])
def test_whole_clustering(spark, mode):
    texts = [f"{word} {i}" for word in ("refund order", "invoice tax", "ship parcel") for i in range(8)] + ["", " "]
    df = spark.createDataFrame(list(enumerate(texts)), "row_index bigint, text string")
    result = cluster_texts(df, mode=mode, num_clusters=3)
    rows = result.clustered().orderBy("row_index").collect()
    assert [r.cluster_id for r in rows] == [0] * 8 + [1] * 8 + [2] * 8 + [-1, -1]
    assert rows[0].cluster_top_keywords == "refund, order"
    assert result.stats().first().cluster_mode == mode
    with pytest.raises(ValueError):
        cluster_texts(df, mode="dbscan")


def test_all_blank(spark):
    df = spark.createDataFrame([(0, ""), (1, None)], "row_index bigint, text string")
    result = cluster_texts(df)
    assert [r.cluster_id for r in result.clustered().collect()] == [-1, -1]
    stats = result.stats().first()
    assert (stats.total_clustered, stats.cluster_count, stats.average_cluster_size) == (0, 0, 0.0)
    assert result.summary().count() == 0 and result.analysis().count() == 0


def test_encoder_factory_runs_in_batches(spark):
    df = spark.createDataFrame([(f"t{i}",) for i in range(10)], "text string").coalesce(1)

    def factory():
        def run(texts):
            assert len(texts) <= 3
            return np.array([[3.0, 4.0]] * len(texts))

        return run

    rows = encode(df, "text", factory, batch_size=3).collect()
    assert all(np.allclose(r.embedding, [0.6, 0.8]) for r in rows)
    with pytest.raises(ValueError):
        encode(df, "text", factory, batch_size=0)


ANSWERS = {"退款怎么申请": "请在订单页提交退款申请", "发票怎么开": "请走人工工单"}


def test_scoring(spark):
    answers = dict(ANSWERS)

    def answer():
        return lambda prompts: [answers.get(p, p) for p in prompts]

    df = spark.createDataFrame(
        [("退款怎么申请", " 请在订单页提交退款申请"), ("发票怎么开", "请联系财务开票")], "`用户输入` string, `预期结果` string"
    )
    scored = scoring.score_rows(df, answer, batch_size=1)
    assert scored.columns == ["用户输入", "预期结果", "模型结果", "模型调用时间", "匹配预期"]
    rows = scored.collect()
    assert [(r["模型结果"], r["匹配预期"]) for r in rows] == [("请在订单页提交退款申请", True), ("请走人工工单", False)]
    assert all(r["模型调用时间"] >= 0 for r in rows)
    stats = scoring.evaluation_stats(scored).first()
    assert (stats.total_rows, stats.matched_expected_count, stats.has_expected_result) == (2, 1, True)
    plain = scoring.score_rows(df.select("用户输入"), answer, system_prompt="短答")
    assert "匹配预期" not in plain.columns
    assert plain.first()["模型结果"].startswith("系统指令：短答")
    none = scoring.evaluation_stats(scoring.score_rows(df.limit(0), answer)).first()
    assert (none.total_rows, none.average_call_time_seconds) == (0, 0.0)


def test_wrong_number_of_answers_is_an_error(spark):
    df = spark.createDataFrame([("a",)], "text string")
    with pytest.raises(Exception, match="one answer per prompt"):
        scoring.score_rows(df, lambda: lambda prompts: []).collect()
