"""Running a model over rows and checking its answers."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.functions.text import match_expected, render_prompt
from corpusprep.operators.rows import column, cut_lineage, once_per_worker, target_value

RESULT_COLUMN = "模型结果"
TIME_COLUMN = "模型调用时间"
EXPECTED_COLUMN = "预期结果"
MATCH_COLUMN = "匹配预期"

# Called once per worker and name; returns the function that answers a batch of prompts.
PredictorFactory = Callable[[], Callable[[list[str]], list[str]]]


def score_rows(
    df: DataFrame,
    predictor: PredictorFactory,
    target: str = "text",
    batch_size: int = 8,
    system_prompt: str = "",
    result: str = RESULT_COLUMN,
    seconds: str = TIME_COLUMN,
    expected: str = EXPECTED_COLUMN,
    match: str = MATCH_COLUMN,
    model: str | None = None,
) -> DataFrame:
    """Append the model's answer and its call time per row (batch seconds / rows).

    Rows flow through in bounded Arrow batches. With a ``model`` name the predictor is made
    once per Python worker and kept under that name, else once per task. Answers are written
    once: what follows reads them and does not call the model again. With an ``expected``
    column, ``match`` says whether the answer equals it after text normalisation.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    prompted = df.withColumn("__prompt", render_prompt(target_value(df, target), system_prompt))
    schema = T.StructType(
        [*df.schema.fields, T.StructField(result, T.StringType()), T.StructField(seconds, T.DoubleType())]
    )

    held = f"predictor {model}" if model else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = once_per_worker(held, predictor)
        for batch in batches:
            prompts = batch.column("__prompt").to_pylist()
            answers: list[str] = []
            times: list[float] = []
            for start in range(0, len(prompts), batch_size):
                asked = prompts[start : start + batch_size]
                started = time.perf_counter()
                given = list(predict(asked))
                elapsed = round(time.perf_counter() - started, 4)
                if len(given) != len(asked):
                    raise ValueError("the predictor must return one answer per prompt")
                answers += given
                times += [round(elapsed / len(asked), 4)] * len(asked)
            kept = [name for name in batch.schema.names if name != "__prompt"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in kept), pa.array(answers, pa.string()), pa.array(times, pa.float64())],
                names=[*kept, result, seconds],
            )

    scored = cut_lineage(prompted.mapInArrow(run, schema), "answers")
    if expected in df.columns:
        scored = scored.withColumn(match, match_expected(column(expected), column(result)))
    return scored


def evaluation_stats(scored: DataFrame, seconds: str = TIME_COLUMN, match: str = MATCH_COLUMN) -> DataFrame:
    """One row: rows, matched answers, mean call time (4 decimals, 0 without rows)."""
    matched = F.count_if(column(match)) if match in scored.columns else F.lit(0).cast("bigint")
    return scored.agg(
        F.count(F.lit(1)).alias("total_rows"),
        matched.alias("matched_expected_count"),
        F.coalesce(F.bround(F.avg(column(seconds)), 4), F.lit(0.0)).alias("average_call_time_seconds"),
    ).withColumn("has_expected_result", F.lit(match in scored.columns))
