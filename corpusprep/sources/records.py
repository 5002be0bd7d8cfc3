"""CSV records out of lines: quoted cells keep their line breaks, blank lines stay rows.

Spark's line reader splits files anywhere. Whether a split begins inside a quoted cell depends
on the splits before it, so two passes are made: the first finds for each split what it does to
a reader that enters it outside and inside a quoted cell; the second, with the entry state of
each split known, puts lines together. A record that crosses splits leaves a fragment in each
of them; only fragments are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'


def ends_inside(line: str, inside: bool, delimiter: str = ",") -> bool:
    """Whether a reader is inside a quoted cell after a line.

    A quote opens a cell only as its first character; inside, two quotes are one character.
    """
    if QUOTE not in line:
        return inside
    at = 0
    while True:
        if not inside:
            # The next cell that begins with a quote.
            if line.startswith(QUOTE, at) and (at == 0 or line[at - 1] == delimiter):
                at += 1
            else:
                found = line.find(delimiter + QUOTE, max(at - 1, 0))
                if found < 0:
                    return False
                at = found + 2
            inside = True
        close = line.find(QUOTE, at)
        if close < 0:
            return True
        if line.startswith(QUOTE, close + 1):
            at = close + 2
            continue
        inside = False
        at = line.find(delimiter, close + 1) + 1
        if not at:
            return False


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list[str]]]:
    """Lines with the split they stand in: ``(file, start)``. A split may come in several parts."""
    for batch in batches:
        files, starts = batch.column("file").to_numpy(), batch.column("start").to_numpy()
        change = [0, *((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])).nonzero()[0] + 1, batch.num_rows]
        for low, high in zip(change, change[1:]):
            if high > low:
                yield (int(files[low]), int(starts[low])), batch.column("value").slice(low, high - low).to_pylist()


def placed_lines(lines: DataFrame) -> DataFrame:
    """``value, file, start``: lines of text files, read in batch or as a stream, with their split."""
    return lines.select("value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def csv_records(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """``value``: the records of CSV files without their headers, line breaks in cells as ``\\n``."""
    return records_of(placed_lines(spark.read.option("lineSep", "\n").text(path)), delimiter)


def records_of(lines: DataFrame, delimiter: str = ",") -> DataFrame:
    """The records of whole files given as ``placed_lines``: a folder's, or a micro-batch's.

    The driver holds one entry per split of the files.
    """

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple[int, int], list[bool]] = {}
        for split, values in _splits(batches):
            pair = states.setdefault(split, [False, True])
            for line in values:
                if QUOTE in line:
                    pair[0], pair[1] = ends_inside(line, pair[0], delimiter), ends_inside(line, pair[1], delimiter)
        rows = [(f, s, a, b) for (f, s), (a, b) in states.items()]
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "start", "outside", "inside"])

    found = sorted(tuple(r) for r in lines.mapInArrow(survey, "file bigint, start bigint, outside boolean, inside boolean").collect())
    # Splits that are entered inside a cell.
    entered: set[tuple[int, int]] = set()
    file, inside = None, False
    for name, start, outside_end, inside_end in found:
        if name != file:
            file, inside = name, False
        if inside:
            entered.add((name, start))
        inside = inside_end if inside else outside_end

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, int | None, int | None, int, bool]] = []
        held: list[str] = []
        split, within, head, first = None, False, False, False

        def close(open_: bool) -> None:
            """The end of a split: what is held is a fragment."""
            if held:
                out.append(("\n".join(held), *split, 0 if head else 1, open_))
                held.clear()

        for now, values in _splits(batches):
            if now != split:
                close(within)
                split, within = now, now in entered
                head, first = within, now[1] == 0
            for line in values:
                held.append(line)
                within = ends_inside(line, within, delimiter)
                if within:
                    continue
                if head:
                    close(False)
                    head = False
                elif first:
                    held.clear()
                else:
                    out.append(("\n".join(held).removesuffix("\r"), None, None, 1, False))
                    held.clear()
                first = False
            if len(out) > 4096:
                yield _rows(out)
                out = []
        close(within)
        if out:
            yield _rows(out)

    placed = lines.mapInArrow(assemble, "value string, file bigint, start bigint, part int, open boolean")
    if not entered:
        # No record crosses a split: nothing is shuffled. An open last record of a file is whole.
        return placed.select(F.regexp_replace("value", "\r$", "").alias("value"))
    # A fragment that is open goes on in the next fragment of its file.
    pieces = placed.filter("file is not null")
    by = Window.partitionBy("file").orderBy("start", "part")
    begins = F.coalesce(~F.lag("open").over(by), F.lit(True)).cast("int")
    numbered = pieces.withColumn("begins", begins).withColumn("record", F.sum("begins").over(by))
    joined = numbered.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("start", "part", "value"))).alias("parts"))
    whole = joined.select(F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"))
    return placed.filter("file is null").select("value").unionByName(whole.select(F.regexp_replace("value", "\r$", "").alias("value")))


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["value", "file", "start", "part", "open"])
