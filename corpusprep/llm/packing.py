"""Best-fit packing of token pieces into sequences, in bulk-synchronous rounds.

The first round opens as many sequences as the tokens need at least. In a round all waiting
pieces and all gaps of open sequences are sorted together by size; a piece wants the smallest
gap that is not smaller than itself, its successor in that order. Conflicts are resolved by
rank: gaps are closing and pieces opening brackets, and a gap takes the largest piece before it
that no smaller gap takes. Each sorted partition is swept by itself; the brackets that stay open
in it meet those of other partitions by their ranks, which takes two numbers of each partition.
A gap that holds several of the longest waiting pieces takes part with several slots. Then gaps
are updated and the round is repeated. When few pieces find a gap, the rest opens as many new
sequences as its tokens need at least.

Every round is written to the shared folder, so that a lost executor costs one round at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import binary_column, id_and_text, pieces, scratch, text_bytes, tidy
from corpusprep.llm.wordtokens import word_tokens

#: Tokens of a sequence.
CAPACITY = 2048
#: Rows of a sorted partition in a round.
SWEEP_ROWS = 200_000
#: Bytes of text that are encoded at a time.
PIECE = 4 << 20
#: New sequences are opened when a round places less than this share of the waiting pieces.
LEAST_SHARE = 1 / 32


def write_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode every whole text, append ``end_id`` and cut documents longer than ``capacity``.

    Returns a written table ``key, doc_id, piece, start, length, ids``: ``key`` is unique,
    ``start`` the number of the document's ids before the piece, ``ids`` little-endian unsigned
    32-bit integers. Null and empty texts have the end id alone; repeated rows and null ids are
    documents of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(path)
        for batch in batches:
            _, offsets = text_bytes(batch.column("text"))
            for low, high in pieces(offsets, PIECE):
                flat, counts = tokens.ids(batch.column("text").slice(low, high - low).to_pylist())
                flat = np.insert(flat, np.cumsum(counts), end_id).astype("<u4")
                counts = counts + 1
                cuts = -(-counts // capacity)
                of = np.repeat(np.arange(high - low), cuts)
                number = np.arange(len(of)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                lengths = np.minimum(counts[of] - number * capacity, capacity)
                bounds = np.concatenate([[0], np.cumsum(lengths)])
                ids = batch.column("doc_id").slice(low, high - low).take(pa.array(of))
                # Results leave in slices, so that one column of bytes stays well below 2 GB.
                for a, b in pieces(bounds, 4_000_000):
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.slice(a, b - a),
                            pa.array(number[a:b], pa.int32()),
                            pa.array(number[a:b] * capacity, pa.int64()),
                            pa.array(lengths[a:b], pa.int64()),
                            binary_column(flat[bounds[a] : bounds[b]].view(np.uint8), lengths[a:b] * 4),
                        ],
                        names=["doc_id", "piece", "start", "length", "ids"],
                    )

    rows = id_and_text(docs, id_col, text_col)
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids binary"
    cut = rows.mapInArrow(tidy(run), schema)
    return _written(cut.select(F.monotonically_increasing_id().alias("key"), "*"), "pieces")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, f"packing-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def match_brackets(opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of matching opening and closing brackets in a row of them."""
    height = np.cumsum(np.where(opens, 1, -1))
    level = np.where(opens, height, height + 1)
    order = np.argsort(level, kind="stable")
    # At one level brackets open and close in turn; a first one may close, a last one stay open.
    pair = np.flatnonzero((level[order][:-1] == level[order][1:]) & opens[order][:-1] & ~opens[order][1:])
    return order[pair], order[pair + 1]


_SWEPT = "part int, key bigint, length bigint, bin bigint, rank bigint"


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs within a sorted partition, and the brackets left over, with their ranks.

    A piece without a gap has a null bin, a gap without a piece a null key.
    """
    part = TaskContext.get().partitionId()
    columns = [[], [], []]
    for batch in batches:
        for held, name in zip(columns, ("kind", "value", "id")):
            held.append(batch.column(name).to_numpy())
    if not columns[0]:
        return
    kind, value, number = (np.concatenate(c) for c in columns)
    opens = kind == 0
    left, right = match_brackets(opens)
    alone = np.ones(len(kind), bool)
    alone[left] = alone[right] = False
    waiting, free = np.flatnonzero(alone & opens), np.flatnonzero(alone & ~opens)
    none = lambda count: pa.nulls(count, pa.int64())
    for keys, lengths, bins, ranks in (
        (pa.array(number[left]), pa.array(value[left]), pa.array(number[right]), none(len(left))),
        (pa.array(number[waiting]), pa.array(value[waiting]), none(len(waiting)), pa.array(np.arange(len(waiting)))),
        (none(len(free)), none(len(free)), pa.array(number[free]), pa.array(np.arange(len(free)))),
    ):
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), part, np.int32)), keys, lengths, bins, ranks], names=["part", "key", "length", "bin", "rank"])


def meeting_ranks(counts: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Which brackets left over in one partition meet which of another one.

    ``counts``: partition, pieces and gaps left, in the partitions' order. Returns ``first
    match, partition of the pieces, their lowest rank, partition of the gaps, their lowest rank,
    number``: the pieces from the highest rank down meet the gaps from the lowest rank up.
    """
    stack: list[list[int]] = []
    ranges, matches = [], 0
    for part, waiting, free in counts:
        used = 0
        while used < free and stack:
            owner, left = stack[-1]
            taken = min(left, free - used)
            ranges.append((matches, owner, left - taken, part, used, taken))
            matches, used = matches + taken, used + taken
            if taken == left:
                stack.pop()
            else:
                stack[-1][1] -= taken
        if waiting:
            stack.append([part, waiting])
    return ranges


_PLACED = "key bigint, length bigint, bin bigint"


def _round(waiting: DataFrame, gaps: DataFrame, rows: int, longest: int) -> tuple[DataFrame, str]:
    """One round: ``key, length, bin`` of the waiting pieces, with a null bin where no gap was found,
    and the path where they are written.

    ``rows``: about how many pieces and gaps there are; ``longest``: the longest waiting piece.
    """
    spark = waiting.sparkSession
    slots = F.greatest(F.lit(1), F.floor(F.col("gap") / longest)).cast("int")
    free = gaps.select(
        F.lit(1).alias("kind"),
        F.floor(F.col("gap") / slots).alias("value"),
        F.col("bin").alias("id"),
        F.explode(F.array_repeat(F.lit(0), slots)).alias("slot"),
    ).drop("slot")
    items = waiting.select(F.lit(0).alias("kind"), F.col("length").alias("value"), F.col("key").alias("id")).unionByName(free)
    parts = max(1, math.ceil(rows / SWEEP_ROWS))
    # Ids break ties, so that one length may be that of any share of the rows.
    order = ["value", "kind", "id"]
    dealt = items.repartitionByRange(parts, *order) if parts > 1 else items.repartition(1)
    path = scratch(spark, "packing-swept")
    dealt.sortWithinPartitions(*order).mapInArrow(tidy(_sweep), _SWEPT).write.parquet(path)
    swept = spark.read.schema(_SWEPT).parquet(path)
    pairs, left = swept.filter("rank is null").select("key", "length", "bin"), swept.filter("rank is not null")
    # One row per partition; with one partition nothing is left that could meet.
    counts = left.groupBy("part").agg(F.count("key"), F.count("bin")).collect() if parts > 1 else []
    meeting = meeting_ranks(sorted(map(tuple, counts)))
    if not meeting:
        return swept.filter("key is not null").select("key", "length", "bin"), path
    schema = "match bigint, pieces int, low_piece bigint, gaps int, low_gap bigint, number bigint"
    ranges = F.broadcast(spark.createDataFrame(meeting, schema))
    inside = lambda low: (F.col("rank") >= F.col(low)) & (F.col("rank") < F.col(low) + F.col("number"))
    alone = left.filter("key is not null").join(ranges, (F.col("part") == F.col("pieces")) & inside("low_piece"), "left")
    alone = alone.select("key", "length", (F.col("match") + F.col("number") - 1 - F.col("rank") + F.col("low_piece")).alias("match"))
    open_gaps = left.filter("key is null").join(ranges, (F.col("part") == F.col("gaps")) & inside("low_gap"))
    open_gaps = open_gaps.select("bin", (F.col("match") + F.col("rank") - F.col("low_gap")).alias("match"))
    path = scratch(spark, "packing-round")
    pairs.unionByName(alone.join(open_gaps, "match", "left").select("key", "length", "bin")).write.parquet(path)
    return spark.read.schema(_PLACED).parquet(path), path


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``key, sequence_id, offset`` for ``key, length`` (unique keys, lengths from 1 to ``capacity``).

    Sequences hold at most ``capacity`` tokens; their pieces lie one after the other from offset
    0, the longest first. Rounds are repeated until all pieces are placed. An empty table gives
    an empty one.
    """
    spark = rows.sparkSession
    waiting = rows.select("key", F.col("length").cast("bigint").alias("length"))
    gaps = spark.createDataFrame([], "bin bigint, gap bigint")
    rounds: list[str] = []
    bins = before = 0
    while True:
        # Of pieces and gaps at once: one pass for each round.
        both = waiting.select("length", F.lit(None).cast("bigint").alias("gap")).unionByName(gaps.select(F.lit(None).cast("bigint").alias("length"), "gap"))
        count, tokens, shortest, longest, held, widest = both.agg(
            F.count("length"), F.sum("length"), F.min("length"), F.max("length"), F.count("gap"), F.coalesce(F.max("gap"), F.lit(0))
        ).first()
        if not count:
            break
        if widest < shortest or before - count < LEAST_SHARE * before or not bins:
            new = max(math.ceil(tokens / capacity), math.ceil(count / (capacity // shortest)))
            fresh = spark.range(bins, bins + new).select(F.col("id").alias("bin"), F.lit(capacity).cast("bigint").alias("gap"))
            gaps, bins, held = gaps.unionByName(fresh), bins + new, held + new
        before = count
        done, path = _round(waiting, gaps.filter(F.col("gap") >= shortest), count + held, longest)
        rounds.append(path)
        waiting = done.filter("bin is null").select("key", "length")
        filled = done.filter("bin is not null").select("bin", (-F.col("length")).alias("gap"))
        rest = gaps.unionByName(filled).groupBy("bin").agg(F.sum("gap").alias("gap"))
        gaps = _written(rest.filter(F.col("gap") >= shortest), "gaps")
    if not rounds:
        return spark.createDataFrame([], "key bigint, sequence_id bigint, offset bigint")
    placed = spark.read.schema(_PLACED).parquet(*rounds).filter("key is not null and bin is not null")
    earlier = Window.partitionBy("bin").orderBy(F.desc("length"), "key").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("key", F.col("bin").alias("sequence_id"), F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"))


def packed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The written pieces of ``write_pieces`` with their ``sequence_id`` and ``offset``."""
    return cut.join(pack(cut.select("key", "length"), capacity), "key").drop("key")
