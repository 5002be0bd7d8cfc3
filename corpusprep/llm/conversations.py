"""Repair of damaged conversations by a checkpointed dynamic program.

A conversation is sound when the first letters of its roles read ``(s?(ua)+)?`` and no row is
blank or says what an earlier row says. Rows are kept (cost 0), get another role (2) or are
deleted (3); rows of user or assistant with an empty text may be inserted (2); a row that stops
without ``. ! ?`` and is not deleted adds 1. The cheapest repair is wanted, of several the one
whose letters D, I, K, R come first in ASCII order.

Backwards, the program needs one vector for each row: the cost from there to the end in each of
the four states of the pattern. Only the vectors at every square root of the rows are stored;
the walk forward computes the vectors of one block again and takes the first letter that keeps
the least cost. Vectors differ by few small numbers, so up to a constant there are only some
dozens of them: ``Tables`` lists them once, and a step is a look into a table.

A conversation of more than ``long_rows`` rows is never held by one task. Its rows are numbered
in order, blocks of about the square root of all such rows become min-plus matrices, those of a
conversation are multiplied from its end (a square root of rows in a group), and each block is
walked by itself from the state in which the one before it ends.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import scratch, tidy
from corpusprep.operators.rows import column, with_row_index

#: Conversations with more rows than this are cut into blocks.
LONG = 2000
#: Least rows of a block.
LEAST_BLOCK = 64
BLANKS = " \t\n\x0b\x0c\r"
#: States of the pattern: nothing yet, after s, after u, after a. The first and last may end it.
START, SYSTEM, USER, REPLY = range(4)
_INSERTED = (USER, USER, REPLY, USER)
_ENDS = (START, REPLY)
_FAR = 1 << 40
#: Row codes: 0 has to go; else 1 + 2 * role (other, s, u, a) + whether it is truncated.
CODES = 9

DIGESTS = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)
TURNS = "conv_id bigint, place bigint, edit string, turn bigint, role string, text string"


def _kept(state: int, role: int) -> int | None:
    """The state after a kept row, if its role may stand there."""
    if role == 1:
        return SYSTEM if state == START else None
    if role == 2:
        return USER if state != USER else None
    return REPLY if role == 3 and state == USER else None


class Tables:
    """All cost vectors that can occur, and the steps between them."""

    def __init__(self):
        final = self._closed([0 if s in _ENDS else _FAR for s in range(4)])
        units = [tuple(0 if s == t else _FAR for s in range(4)) for t in range(4)]
        self.ids: dict[tuple, int] = {}
        self.vectors: list[tuple] = []
        self.final = self.number(final)[0]
        self.units = [self.number(u)[0] for u in units]
        #: For a vector after a row and the row's code: the vector before it, and what it adds.
        self.back: list[int] = []
        self.adds: list[int] = []
        #: For the same and the state before the row: letters up to the row's own, and the state after it.
        self.letters: list[str] = []
        self.goes: list[int] = []
        at = 0
        while at < len(self.vectors):
            for code in range(CODES):
                after = self.vectors[at]
                row = [self._row(after, code, s) for s in range(4)]
                before = self._closed([min(c for c, _, _ in options) for options in row])
                number, least = self.number(before)
                self.back.append(number)
                self.adds.append(least)
                for state in range(4):
                    letters, where = "", state
                    while True:
                        inserted = _INSERTED[where]
                        options = [*row[where], (2 + before[inserted], "I", inserted)]
                        tight = min((x, t) for c, x, t in options if c == before[where]) if before[where] < _FAR else ("D", where)
                        letters += tight[0]
                        where = tight[1]
                        if tight[0] != "I":
                            break
                    self.letters.append(letters)
                    self.goes.append(where)
            at += 1

    @staticmethod
    def _closed(raw: list[int]) -> tuple:
        """The vector when rows may be inserted first: twice at most, a third one is at a known state."""
        once = [min(raw[s], 2 + raw[_INSERTED[s]]) for s in range(4)]
        return tuple(min(_FAR, raw[s], 2 + once[_INSERTED[s]]) for s in range(4))

    @staticmethod
    def _row(after: tuple, code: int, state: int) -> list[tuple[int, str, int]]:
        """Cost, letter and next state of what may happen to a row itself."""
        options = [(min(_FAR, 3 + after[state]), "D", state)]
        if code:
            role, truncated = divmod(code - 1, 2)
            kept = _kept(state, role)
            if kept is not None:
                options.append((min(_FAR, truncated + after[kept]), "K", kept))
            options.append((min(_FAR, 2 + truncated + after[_INSERTED[state]]), "R", _INSERTED[state]))
        return options

    def number(self, vector: tuple) -> tuple[int, int]:
        """The number of a vector, and the constant it stands above the listed one."""
        least = min(vector)
        plain = tuple(v - least if v < _FAR else _FAR for v in vector)
        if plain not in self.ids:
            self.ids[plain] = len(self.vectors)
            self.vectors.append(plain)
        return self.ids[plain], least

    def backward(self, codes: bytes, end: int) -> tuple[list[int], int, int]:
        """Vectors at checkpoints (after every square root of the rows), the first vector, its constant."""
        stride = max(1, math.isqrt(len(codes)))
        back, adds, vector, total = self.back, self.adds, end, 0
        stored = [0] * (-(-len(codes) // stride))
        for block in range(len(stored) - 1, -1, -1):
            stored[block] = vector
            for code in reversed(codes[block * stride : (block + 1) * stride]):
                step = vector * CODES + code
                total += adds[step]
                vector = back[step]
        return stored, vector, total

    def walk(self, codes: bytes, stored: list[int], state: int, last: bool) -> tuple[str, int]:
        """Letters of the cheapest edits from ``state``, the least in ASCII order, and the last state."""
        stride = max(1, math.isqrt(len(codes)))
        out: list[str] = []
        for block, vector in enumerate(stored):
            part = codes[block * stride : (block + 1) * stride]
            steps = []
            for code in reversed(part):
                step = vector * CODES + code
                steps.append(step * 4)
                vector = self.back[step]
            for step in reversed(steps):
                out.append(self.letters[step + state])
                state = self.goes[step + state]
        while last and state not in _ENDS:
            out.append("I")
            state = _INSERTED[state]
        return "".join(out), state

    def matrix(self, codes: bytes) -> list[int]:
        """Least cost from each state before the rows to each state after them, row by row."""
        columns = []
        for unit in self.units:
            _, vector, total = self.backward(codes, unit)
            columns.append([min(_FAR, total + v) for v in self.vectors[vector]])
        return [columns[t][s] for s in range(4) for t in range(4)]


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def turns_after(letters: str, state: int, rows: Iterator[tuple]) -> Iterator[tuple]:
    """``letter, turn, role, text`` of each repaired row; ``rows`` are ``turn, role, text``."""
    for letter in letters:
        if letter == "I":
            state = _INSERTED[state]
            yield letter, None, "user" if state == USER else "assistant", ""
            continue
        turn, role, text = next(rows)
        if letter == "D":
            continue
        if letter == "R":
            state = _INSERTED[state]
            role = "user" if state == USER else "assistant"
        else:
            state = _kept(state, _role(role))
        yield letter, turn, role, text


def _role(role: str) -> int:
    return {"s": 1, "u": 2, "a": 3}.get(role[:1], 0)


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` after the damage that crc32 of ``conv_id:turn`` modulo 20 names.

    0 drops a row, 1 empties its text, 2 takes its ``. ! ?`` away, 3 repeats it, 4 sets its role
    to user. Null values count as one space, in the hashed string too; a null turn stays null.
    """
    ids, turns = column(conv).cast("bigint"), column(turn).cast("bigint")
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(blank(ids), F.lit(":"), blank(turns)).cast("binary")), F.lit(20))
    plain = rows.select(ids.alias("conv_id"), turns.alias("turn"), blank(column(role)).alias("role"), blank(column(text)).alias("text"), kind.alias("kind"))
    times = F.when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1))
    return plain.filter("kind <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("copy"),
    ).drop("copy")


def _state_of_text() -> Column:
    """2 for texts without a visible character, 1 for truncated ones, 0 for others."""
    trimmed = F.rtrim("text", F.lit(BLANKS))
    return F.when(trimmed == "", 2).when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1).cast("int")


def _sorted_out(rows: DataFrame, long_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows of short and of long conversations. Ids of long ones: at most rows / long_rows of them.

    Nothing is broadcast by force; adaptive execution does it when the ids are few, and splits
    the hot ids of the other side when they are not.
    """
    long = rows.groupBy("conv_id").count().filter(F.col("count") > long_rows).select(F.col("conv_id").alias("long_id"))
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    return rows.join(long, same, "left_anti"), rows.join(long, same, "left_semi")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[tuple]]]:
    """Rows of one conversation at a time, out of rows sorted by it."""
    held: list[tuple] = []
    current: object = _conversations
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "state")]
        for conv, *row in zip(*columns):
            if conv != current:
                if held:
                    yield current, held
                current, held = conv, []
            held.append(row)
    if held:
        yield current, held


def _repair_short(rows: DataFrame, turns: bool) -> DataFrame:
    def repaired(conv, held: list[tuple]):
        seen: set[tuple] = set()
        codes, faults, illegal, previous = bytearray(), [0, 0, 0], 0, None
        numbers = set()
        for turn, role, text, state in held:
            initial = _role(role)
            again = (role, text) in seen
            seen.add((role, text))
            if state == 2:
                faults[0] += 1
            elif again:
                faults[1] += 1
            elif state:
                faults[2] += 1
            codes.append(0 if state == 2 or again else 1 + 2 * initial + state)
            if previous is not None:
                illegal += (previous, initial) not in ((1, 2), (2, 3), (3, 2))
            previous = initial
            if turn is not None:
                numbers.add(turn)
        stored, first, total = tables().backward(bytes(codes), tables().final)
        letters, _ = tables().walk(bytes(codes), stored, START, True)
        after = turns_after(letters, START, iter([row[:3] for row in held]))
        if turns:
            return [(conv, k, *row) for k, row in enumerate(after)]
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        text = "\n".join(f"{role}:{text}" for _, _, role, text in after)
        digest = hashlib.sha256(text.encode()).hexdigest()
        return [(conv, gaps, *faults, illegal, total + tables().vectors[first][START], letters, digest)]

    schema = TURNS if turns else DIGESTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for conv, held in _conversations(batches):
            out += repaired(conv, held)
            if len(out) >= 5000:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    ordered = rows.select("*", _state_of_text().alias("state")).repartition("conv_id")
    return ordered.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(tidy(run), schema)


_TYPES = {"bigint": pa.int64(), "string": pa.string(), "int": pa.int32(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [_TYPES[part.split()[1]] for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)], names=names)


_SEGMENT = (
    "block bigint, conv_id bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "first_role int, last_role int, codes binary, matrix array<bigint>"
)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block and conversation, out of narrow rows in order."""

    def row(key: tuple, roles: list[int], faults: list[int], codes: bytearray) -> tuple:
        illegal = sum(pair not in ((1, 2), (2, 3), (3, 2)) for pair in zip(roles, roles[1:]))
        counts = [faults.count(k) for k in (1, 2, 3)]
        return (*key, *counts, illegal, roles[0], roles[-1], bytes(codes), tables().matrix(bytes(codes)))

    key, roles, faults, codes = None, [], [], bytearray()
    for batch in batches:
        done = []
        columns = [batch.column(c).to_pylist() for c in ("block", "conv_id", "role", "fault")]
        for block, conv, role, fault in zip(*columns):
            if (block, conv) != key:
                if codes:
                    done.append(row(key, roles, faults, codes))
                key, roles, faults, codes = (block, conv), [], [], bytearray()
            roles.append(role)
            faults.append(fault)
            codes.append(0 if fault in (1, 2) else 1 + 2 * role + (fault == 3))
        if done:
            yield _batch(done, _SEGMENT)
    if codes:
        yield _batch([row(key, roles, faults, codes)], _SEGMENT)


def _chained(segments: pd.DataFrame) -> pd.DataFrame:
    """For the blocks of one conversation: the vector after each, and the conversation's counts."""
    segments = segments.sort_values("block")
    vector, ends = list(tables().vectors[tables().final]), []
    for matrix in reversed(segments["matrix"].tolist()):
        ends.append(tables().number(tuple(vector))[0])
        vector = [min(_FAR, min(int(matrix[4 * s + t]) + vector[t] for t in range(4))) for s in range(4)]
    roles = list(zip(segments["last_role"][:-1], segments["first_role"][1:]))
    between = sum((int(a), int(b)) not in ((1, 2), (2, 3), (3, 2)) for a, b in roles)
    out = segments[["conv_id", "block"]].copy()
    out["after"] = ends[::-1]
    for name in ("blank", "duplicate", "truncated"):
        out[name] = segments[name].sum()
    out["illegal"] = segments["illegal"].sum() + between
    out["cost"] = vector[START]
    return out


def _entered(maps: pd.DataFrame) -> pd.DataFrame:
    """The state in which each block of one conversation begins."""
    maps = maps.sort_values("block")
    state, begins = START, []
    for ends in maps["ends"]:
        begins.append(state)
        state = int(ends[state])
    out = maps[["conv_id", "block"]].copy()
    out["begin"], out["last"] = begins, [False] * (len(begins) - 1) + [True]
    return out


def _joined(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Two tables by keys that may be null: a null conversation is one as any other."""
    other = right.withColumnsRenamed({k: f"other_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"other_{k}")) for k in keys]
    return left.join(other, same, how).drop(*[f"other_{k}" for k in keys])


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _repair_long(rows: DataFrame, turns: bool) -> DataFrame:
    placed = with_row_index(rows, "conv_id", "turn", "role", "text", F.monotonically_increasing_id())
    placed = _written(placed, "long-conversations")
    size = max(LEAST_BLOCK, math.isqrt(placed.count()))
    block = F.floor(F.col("row_index") / F.lit(size)).alias("block")
    initial = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for x in ("s", 1, "u", 2, "a", 3)]), F.left("role", F.lit(1))), F.lit(0))
    # What a conversation says for the first time: digests only, and partial sums of them.
    said = placed.select("conv_id", "row_index", F.sha2(F.concat("role", F.lit("\0"), "text").cast("binary"), 256).alias("said"))
    firsts = said.groupBy("conv_id", "said").agg(F.min("row_index").alias("row_index")).select("row_index", F.lit(1).alias("first"))
    narrow = placed.select("conv_id", "row_index", block, initial.alias("role"), _state_of_text().alias("state"))
    fault = F.when(F.col("state") == 2, 1).when(F.col("first").isNull(), 2).when(F.col("state") == 1, 3).otherwise(0)
    coded = narrow.join(firsts, "row_index", "left").select("block", "conv_id", "row_index", "role", fault.alias("fault"))
    segments = _written(
        coded.repartition("block").sortWithinPartitions("row_index").drop("row_index").mapInArrow(tidy(_segments), _SEGMENT),
        "conversation-blocks",
    )
    facts = "conv_id bigint, block bigint, after int, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
    chained = _written(segments.drop("codes").groupBy("conv_id").applyInPandas(_chained, facts), "conversation-vectors")
    known = _joined(segments.select("conv_id", "block", "codes"), chained.select("conv_id", "block", "after"), "conv_id", "block")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for conv, number, codes, after in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "block", "codes", "after")]):
                stored, _, _ = tables().backward(codes, after)
                found.append((conv, number, [tables().walk(codes, stored, s, False)[1] for s in range(4)]))
            yield _batch(found, "conv_id bigint, block bigint, ends array<bigint>")

    maps = known.mapInArrow(ends, "conv_id bigint, block bigint, ends array<bigint>")
    entered = maps.groupBy("conv_id").applyInPandas(_entered, "conv_id bigint, block bigint, begin int, last boolean")

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for conv, number, codes, after, begin, last in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "block", "codes", "after", "begin", "last")]):
                stored, _, _ = tables().backward(codes, after)
                found.append((conv, number, begin, tables().walk(codes, stored, begin, last)[0]))
            yield _batch(found, "conv_id bigint, block bigint, begin int, letters string")

    scripts = _written(
        _joined(known, entered, "conv_id", "block").mapInArrow(tidy(walked), "conv_id bigint, block bigint, begin int, letters string"), "conversation-edits"
    )
    # Each block's script in front of its rows.
    texts = placed.select("conv_id", block, "row_index", "turn", "role", "text", F.lit(None).cast("int").alias("begin"))
    heads = scripts.select("conv_id", "block", F.lit(-1).cast("bigint").alias("row_index"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.col("letters").alias("text"), "begin")
    together = texts.unionByName(heads).repartition("block").sortWithinPartitions("block", "conv_id", "row_index")
    schema = TURNS if turns else "conv_id bigint, block bigint, lines string"

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(head: tuple, held: list[tuple]) -> list[tuple]:
            conv, number, begin, letters = head
            after = turns_after(letters, begin, iter(held))
            if turns:  # places are those of a block for now: its number, then the row's
                return [(conv, (number << 32) + k, *row) for k, row in enumerate(after)]
            return [(conv, number, "".join(f"{role}:{text}\n" for _, _, role, text in after))]

        head, held = None, []
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "block", "begin", "turn", "role", "text")]
            for conv, number, begin, turn, role, text in zip(*columns):
                if begin is not None:
                    if head:
                        out += done(head, held)
                    head, held = (conv, number, begin, text), []
                else:
                    held.append((turn, role, text))
            if out:
                yield _batch(out, schema)
        if head and (out := done(head, held)):
            yield _batch(out, schema)

    repaired = together.mapInArrow(tidy(lines), schema)
    if turns:
        return with_row_index(repaired, "conv_id", "place").drop("place").withColumnRenamed("row_index", "place").select(
            "conv_id", "place", "edit", "turn", "role", "text"
        )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """SHA-256 goes through a conversation in order: one block is held at a time."""
        current, digest, held, letters = digests, None, b"", []
        for batch in batches:
            out = []
            for conv, part, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "letters", "lines")]):
                if conv != current:
                    if digest:
                        digest.update(held[:-1])
                        out.append((current, "".join(letters), digest.hexdigest()))
                    current, digest, held, letters = conv, hashlib.sha256(), b"", []
                letters.append(part)
                if text:
                    digest.update(held)
                    held = text.encode()
            if out:
                yield _batch(out, "conv_id bigint, audit string, repaired_sha256 string")
        if digest:
            digest.update(held[:-1])
            yield _batch([(current, "".join(letters), digest.hexdigest())], "conv_id bigint, audit string, repaired_sha256 string")

    in_order = _joined(repaired, scripts.select("conv_id", "block", "letters"), "conv_id", "block")
    in_order = in_order.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    hashed = in_order.mapInArrow(tidy(digests), "conv_id bigint, audit string, repaired_sha256 string")
    number = placed.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    )
    counts = chained.select("conv_id", "blank", "duplicate", "truncated", "illegal", "cost").distinct()
    return _joined(_joined(hashed, number, "conv_id"), counts, "conv_id").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repair(rows: DataFrame, long_rows: int = LONG) -> DataFrame:
    """One row for each conversation of ``rows`` (``conv_id, turn, role, text``, no nulls but in
    ids and turns): its gaps, faults, illegal neighbours, the cost and letters of the cheapest
    edits, and the SHA-256 of the repaired ``role:text`` lines.

    Rows count in the order of their turns, null turns first; of equal turns, by role and text.
    The first fault of a row counts: blank, duplicate (same role and text before), truncated.
    A null id is one conversation. An empty table gives an empty one.
    """
    short, long = _sorted_out(rows.select("conv_id", "turn", "role", "text"), long_rows)
    return _repair_short(short, False).unionByName(_repair_long(long, False))


def repaired_turns(rows: DataFrame, long_rows: int = LONG) -> DataFrame:
    """The repaired conversations: ``conv_id, place, edit, turn, role, text``, in order of place.

    ``edit`` is K, R or I; inserted rows have no turn and an empty text. Places of a conversation
    ascend; those of short ones count from 0.
    """
    short, long = _sorted_out(rows.select("conv_id", "turn", "role", "text"), long_rows)
    return _repair_short(short, True).unionByName(_repair_long(long, True))


def with_untouched(repaired: DataFrame, original: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Every conversation of ``original``; those without rows in ``repaired`` get zeros, no edits
    and the digest of the empty string."""
    all_ids = original.select(column(conv).cast("bigint").alias("id")).distinct()
    whole = all_ids.join(repaired, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return whole.select(
        F.col("id").alias("conv_id"),
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
