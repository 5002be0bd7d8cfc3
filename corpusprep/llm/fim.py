"""Fill-in-the-middle texts, cut with a piecewise-linear learned index of token boundaries.

A text's tokens are a run of other characters with the white space in front of it, or white
space at the end. The offsets at which tokens end ascend, so rank -> offset is nearly a line:
segments are fitted to all of them, each with an error of at most ``ERROR`` characters, and the
difference between the offset and its prediction is stored in a byte. A cut at a rank is
predicted by the segment that covers it and made exact by the stored difference.

Segments are fitted by the shrinking cone: the slopes that keep all points so far within the
error narrow, point by point, until none is left; there the next segment begins. Whole windows
of points are tested at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.llm.common import list_column, pieces, text_bytes, tidy
from corpusprep.operators.rows import column

#: Greatest distance of a prediction from the offset, in characters. Below 127, for one byte.
ERROR = 100
#: Points that are tested at a time at first; the window doubles while the segment goes on.
WINDOW = 512
#: Bytes of text that are indexed at a time.
PIECE = 4 << 20
MARKS = ("<P>", "<S>", "<M>")
SEED = 42
#: Share of documents that are transformed, and of those that are written suffix first.
FIM_SHARE, SPM_SHARE = 50, 80


class RankIndex(NamedTuple):
    """Segments of many texts, one after the other, and the differences of all ranks.

    Ranks are those of all texts in a row: text ``k`` has the boundaries ``first[k]`` (offset 0)
    to ``first[k + 1] - 1`` (its length). Offsets are characters from the text's start.
    """

    first: np.ndarray
    ranks: np.ndarray
    offsets: np.ndarray
    slopes: np.ndarray
    residuals: np.ndarray

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.ranks, ranks, "right") - 1
        return self.offsets[at] + np.rint(self.slopes[at] * (ranks - self.ranks[at])).astype(np.int64)

    def locate(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets of boundaries."""
        return self.predict(ranks) + self.residuals[ranks]


def boundaries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character offsets of all boundaries of the texts in UTF-8 ``data``, and where each text's begin.

    The first boundary of a text is 0, the others are the ends of its tokens.
    """
    texts = len(offsets) - 1
    blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    ends = np.zeros(len(data) + 1, bool)
    if len(data):
        ends[1:-1] = ~blank[:-1] & blank[1:]  # white space begins after a word
        ends[offsets[1:][np.diff(offsets) > 0]] = True
    stops = np.flatnonzero(ends)
    owner = np.searchsorted(offsets, stops, "left") - 1
    characters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    starts = characters[offsets[:-1]]
    counts = np.bincount(owner, minlength=texts) if len(stops) else np.zeros(texts, np.int64)
    first = np.concatenate([[0], np.cumsum(counts + 1)])
    points = np.zeros(int(first[-1]), np.int64)
    is_stop = np.ones(len(points), bool)
    is_stop[first[:-1]] = False
    points[is_stop] = characters[stops] - starts[owner]
    return points, first


def fit(points: np.ndarray, first: np.ndarray, error: int = ERROR) -> RankIndex:
    """Segments within ``error`` of all points; a text begins a segment of its own."""
    ranks: list[int] = []
    slopes: list[float] = []
    steps = np.arange(1, len(points) + 1, dtype=np.float64)
    for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
        begin = low
        while begin < high:
            # Slopes of lines through the segment's first point that pass all points within the error.
            least, most, at, width = -np.inf, np.inf, begin + 1, WINDOW
            while at < high:
                stop = min(at + width, high)
                step = steps[at - begin - 1 : stop - begin - 1]
                rise = points[at:stop] - points[begin]
                lower = np.maximum.accumulate((rise - error) / step)
                upper = np.minimum.accumulate((rise + error) / step)
                np.maximum(lower, least, out=lower)
                np.minimum(upper, most, out=upper)
                if lower[-1] <= upper[-1]:
                    least, most, at, width = lower[-1], upper[-1], stop, width * 2
                    continue
                fits = int(np.argmax(lower > upper))
                if fits:
                    least, most = lower[fits - 1], upper[fits - 1]
                at += fits
                break
            ranks.append(begin)
            slopes.append((least + most) / 2 if at > begin + 1 else 0.0)
            begin = at
    at = np.array(ranks, np.int64)
    index = RankIndex(first, at, points[at], np.array(slopes), np.zeros(0, np.int8))
    residuals = points - index.predict(np.arange(len(points)))
    # Rounding may add half a character to the error.
    return index._replace(residuals=residuals.astype(np.int8))


def _texts(batch: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = text_bytes(batch.fill_null(""))
    for low, high in pieces(offsets, PIECE):
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]


def rank_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", error: int = ERROR) -> DataFrame:
    """The index of every whole text: ``doc_id, n, ranks, offsets, slopes, residuals``.

    ``n`` is the number of tokens; ``residuals`` has a signed byte for each of the ``n + 1``
    boundaries. The boundary of rank r is ``offsets[s] + rint(slopes[s] * (r - ranks[s])) +
    residuals[r]`` with the last segment s whose rank is not above r. Null texts are empty: one
    boundary, 0. Nothing is shuffled; repeated rows are indexed row by row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in _texts(batch.column("text")):
                index = fit(*boundaries(data, offsets), error)
                bounds = np.searchsorted(index.ranks, index.first)
                sizes, counts = np.diff(bounds), np.diff(index.first)
                inner = index.ranks - np.repeat(index.first[:-1], sizes)
                stored = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                residuals = pa.Array.from_buffers(pa.binary(), high - low, [None, pa.py_buffer(stored.tobytes()), pa.py_buffer(index.residuals.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        pa.array(counts - 1, pa.int64()),
                        list_column(inner, sizes, pa.int64()),
                        list_column(index.offsets, sizes, pa.int64()),
                        list_column(index.slopes, sizes, pa.float64()),
                        residuals,
                    ],
                    names=["doc_id", "n", "ranks", "offsets", "slopes", "residuals"],
                )

    rows = docs.select(column(id_col).cast("bigint").alias("doc_id"), column(text_col).cast("string").alias("text"))
    schema = "doc_id bigint, n bigint, ranks array<bigint>, offsets array<bigint>, slopes array<double>, residuals binary"
    return rows.mapInArrow(tidy(run), schema)


_CUTS = T.StructType([T.StructField(name, T.LongType()) for name in ("n", "first", "second")])


@F.arrow_udf(_CUTS)
def _cuts(text: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
    """Number of tokens, and the offsets of the cuts at the ranks that the hashes name."""
    hashes = [h.to_numpy(zero_copy_only=False) for h in (one, two)]
    found = []
    for low, high, data, offsets in _texts(text):
        index = fit(*boundaries(data, offsets))
        n = np.diff(index.first) - 1
        ranks = np.sort(np.stack([h[low:high] % (n + 1) for h in hashes]), axis=0)
        found.append((n, *(index.locate(index.first[:-1] + r) for r in ranks)))
    columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["n", "first", "second"])


def _hashes(doc_id: Column, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    fim_share: int = FIM_SHARE,
    spm_share: int = SPM_SHARE,
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every whole text.

    Four hashes of the seed and the id decide: where the two cuts are, whether the text is
    transformed (``fim_share`` in 100) and whether its suffix comes first (``spm_share`` in
    100). Empty and null texts and those that hold a mark are plain: the text as it is, with
    null ``prefix_chars`` and ``middle_chars``. A null id is hashed as no digits at all. Equal
    rows give equal rows; an empty table gives an empty one. Only texts and two hashes go to
    Python, three numbers come back; nothing is shuffled.
    """
    doc_id = column(id_col).cast("bigint")
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    h = _hashes(doc_id, seed)
    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"), *[x.alias(f"h{k}") for k, x in enumerate(h, 1)])
    rows = rows.withColumn("cuts", _cuts("text", "h1", "h2"))
    marked = F.col("text").contains(MARKS[0]) | F.col("text").contains(MARKS[1]) | F.col("text").contains(MARKS[2])
    plain = (F.col("text") == "") | marked | (F.pmod("h3", F.lit(100)) >= fim_share)
    form = F.when(plain, "plain").when(F.pmod("h4", F.lit(100)) < spm_share, "spm").otherwise("psm")
    rows = rows.select("doc_id", "text", F.col("cuts.n").alias("n"), form.alias("form"), F.col("cuts.first").alias("first"), F.col("cuts.second").alias("second"))
    part = lambda start, size: F.substring(F.col("text"), start, size)
    first, second = F.col("first").cast("int"), F.col("second").cast("int")
    prefix, middle = part(F.lit(1), first), part(first + 1, second - first)
    suffix = part(second + 1, F.lit(2**31 - 1))
    p, s, m = (F.lit(x) for x in MARKS)
    output = (
        F.when(F.col("form") == "plain", F.col("text"))
        .when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle))
        .otherwise(F.concat(p, prefix, s, suffix, m, middle))
    )
    moved = F.col("form") != "plain"
    return rows.select(
        "doc_id",
        "n",
        "form",
        F.when(moved, F.col("first")).alias("prefix_chars"),
        F.when(moved, F.col("second") - F.col("first")).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from, by its marks alone."""
    parts = F.split(output, "|".join(MARKS), -1)
    at = lambda k: F.get(parts, F.lit(k))
    return (
        F.when(form == "psm", F.concat(at(1), at(3), at(2)))
        .when(form == "spm", F.concat(at(2), at(3), at(1)))
        .otherwise(output)
    )
