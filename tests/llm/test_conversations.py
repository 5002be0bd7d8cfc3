import collections
import hashlib
import random
import re
import zlib

import pytest
from helpers import empty
from pyspark.sql import functions as F

from corpusprep.llm import conversations, queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
FOLLOWS = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def by_hand(original):
    """Forward over the rows: the cheapest, then ASCII-least way to each last letter."""
    groups = {r[0]: [] for r in original}
    for conv, turn, role, text in original:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        groups[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    found = {}
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {r[0] for r in rows if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        seen, faults = set(), collections.Counter()
        ways = {"": (0, "", ())}

        def put(ways, state, way):
            if state not in ways or way[:2] < ways[state][:2]:
                ways[state] = way

        def insert(ways):
            for _ in range(3):
                for state, (cost, letters, lines) in list(ways.items()):
                    put(ways, FOLLOWS[state], (cost + 2, letters + "I", (*lines, NAMES[FOLLOWS[state]] + ":")))

        for _, role, text in rows:
            visible = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            insert(ways)
            after = {}
            for state, (cost, letters, lines) in ways.items():
                put(after, state, (cost + 3, letters + "D", lines))
                if fault not in ("blank", "duplicate"):
                    add = fault == "truncated"
                    if role[:1] and state + role[:1] in ("s", "u", "su", "ua", "au"):
                        put(after, role[:1], (cost + add, letters + "K", (*lines, f"{role}:{text}")))
                    follows = FOLLOWS[state]
                    put(after, follows, (cost + add + 2, letters + "R", (*lines, f"{NAMES[follows]}:{text}")))
            ways = after
        insert(ways)
        cost, letters, lines = min((ways[s] for s in ("", "a") if s in ways), key=lambda way: way[:2])
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        found[conv] = (conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, letters, digest)
    return found


def rows():
    rng = random.Random(6)
    made = []
    for conv in (None, 1, 2, 3, 4, 5, 6, 7, 8):
        for _ in range(500 if conv in (None, 1) else rng.randint(1, 12)):
            text = rng.choice(["a.", "b!", "c", "d? ", " ", "", None, "x.\n", "é"])
            if rng.random() < 0.7 and text is not None:
                text += str(rng.randint(0, 300)) + rng.choice([".", "", "!"])
            made.append((conv, None if rng.random() < 0.05 else rng.randint(0, 300), rng.choice(["user", "assistant", "system", "tool", None, ""]), text))
    dropped = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    return [*made, *made[-3:], (9, dropped, "user", "gone."), (10, 1, "user", "long " * 40_000 + ".")]


def test_tables_against_every_way():
    tables = conversations.tables()
    rng = random.Random(7)
    for _ in range(3000):
        codes = bytes(rng.randrange(conversations.CODES) for _ in range(rng.randint(0, 30)))
        stored, first, total = tables.backward(codes, tables.final)
        letters, state = tables.walk(codes, stored, conversations.START, True)
        assert state in (conversations.START, conversations.REPLY) and len(letters.replace("I", "")) == len(codes)
        cost = sum({"D": 3, "I": 2, "K": 0, "R": 2}[x] for x in letters)
        own = letters.replace("I", "")
        cost += sum(x != "D" and c > 0 and (c - 1) % 2 for x, c in zip(own, codes))
        assert cost == total + tables.vectors[first][conversations.START]
        assert all(x == "D" for x, c in zip(own, codes) if c == 0)
        # Cut in two blocks, the same letters.
        if codes:
            cut = rng.randint(0, len(codes))
            stored, after, _ = tables.backward(codes[cut:], tables.final)
            left, state = tables.walk(codes[:cut], tables.backward(codes[:cut], after)[0], conversations.START, False)
            assert left + tables.walk(codes[cut:], stored, state, True)[0] == letters


@pytest.mark.parametrize("long_rows", [2000, 50, 0])
def test_repair_by_hand(spark, long_rows):
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    docs = docs.select("*", *[F.lit(k).alias(n) for k, n in enumerate(["state", "block", "kind", "copy", "cost", "letters", "begin"])])
    damaged = conversations.damaged(docs)
    want = by_hand(rows())
    got = {r.conv_id: tuple(r) for r in conversations.with_untouched(conversations.repair(damaged, long_rows), docs).collect()}
    assert got == want
    lines = collections.defaultdict(list)
    for r in conversations.repaired_turns(damaged, long_rows).orderBy("conv_id", "place").collect():
        lines[r.conv_id].append(f"{r.role}:{r.text}")
        assert (r.edit == "I") <= (r.turn is None and r.text == "")
    assert all(hashlib.sha256("\n".join(lines[c]).encode()).hexdigest() == want[c][-1] for c in want)


def test_query_and_empty_table(spark):
    sf = "/root/testdata/sf0.001"
    original = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r.conv_id: tuple(r) for r in queries.op13_conversations(spark, sf).collect()} == by_hand(original)
    nothing = empty(spark, SCHEMA)
    assert conversations.with_untouched(conversations.repair(conversations.damaged(nothing)), nothing).count() == 0
    assert conversations.repaired_turns(conversations.damaged(nothing)).count() == 0
