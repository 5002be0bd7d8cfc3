"""Secrets in texts: fixed patterns, and values that would take many guesses.

Values in a credential context (a name such as ``password``, then ``:`` or ``=``) are cut into
words, dates, repeats, keyboard walks and brute-force spans so that the product of the guesses
for the parts is smallest (dynamic programming over the ends of the parts). A value whose cost
is high is a secret, even where no fixed pattern fits.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.llm.common import id_and_text, tidy
from corpusprep.operators.rows import column

# The patterns of the base kinds, and the least characters of a find.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "guess")

#: Names and separators of the wider credential context, and what a value may hold.
CONTEXT = re.compile(
    r"(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|auth|bearer|(?:api|access|private|secret)[_-]?key)"
    r"[\"']?\x20{0,3}(?:[:=]|=>|:=)\x20{0,3}[\"']?([^\s\"'<>,;]{6,})",
    re.I | re.A,
)
_NAMES = ("pass", "pwd", "secret", "token", "credential", "auth", "bearer", "key")
_ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Log10 of the guesses from which a value counts as a secret.
LEAST_COST = 10.0
#: Log10 of the guesses for each character of a brute-force span, and for each further part.
CHARACTER_COST, PART_COST = 1.0, 0.3

# Common passwords and words, most frequent first.
WORDS = (
    "password 123456 qwerty letmein welcome admin login master dragon monkey secret love money test user root guest "
    "pass hello world abc iloveyou sunshine princess football baseball shadow superman batman trustno1 starwars "
    "changeme default example sample dummy demo token apikey key none null true false foo bar baz here your my the "
    "and for with this that from value string placeholder insert todo xxx access system server database summer "
    "winter spring autumn monday friday january october google facebook microsoft computer internet "
    # Longer words of prose and of documentation: shorter ones stay below the limit by their length.
    "information application authentication authorization configuration documentation environment development "
    "administrator administration organization registration verification identifier encryption decryption certificate "
    "credential credentials permission permissions connection connections production repository deployment integration "
    "expiration generation validation activation transaction transactions subscription description definition "
    "instruction instructions introduction conclusion discussion collection communication competition composition "
    "confirmation consideration construction contribution conversation cooperation corporation declaration demonstration "
    "destination distribution examination expectation explanation exploration foundation government imagination "
    "implementation institution interpretation investigation legislation observation opportunity participation "
    "performance possibility preparation presentation professional publication recognition recommendation relationship "
    "replacement representation reputation requirement requirements reservation resolution responsibility satisfaction "
    "significance specification substitution temperature themselves throughout tournament tradition traditional "
    "translation transportation understanding university unfortunately technology technologies statistics standardized "
    "something everything background basketball businesses categories characters collective combination commercial "
    "committee companies comparison complicated components comprehensive concentration conditions conference confidence "
    "confidential connecting consequence considerable considered consistent constantly constitution continuous "
    "contemporary controlled convenient conventional correctly correspondence creativity critically currently dangerous "
    "democratic department dependent description determined developer developers difference different difficulty "
    "directory dictionary discovered distinguished documented economics educational effectively efficiency electronic "
    "elementary employment enterprise enterprises entertainment equipment especially essential established eventually "
    "everybody excellent experience experienced experiment experimental expression expressions frequently friendship "
    "generally generated historical immediately importance impossible incredible independence independent individual "
    "individuals industrial influence initially instrument instruments insurance intelligence interested interesting "
    "international invalidated investment knowledge laboratory leadership literature localhost maintenance management "
    "manufacturer mathematics measurement mechanism membership minimum mysterious necessarily necessary neighborhood "
    "neighbourhood newspaper objective occasionally operating operations ordinarily originally otherwise particular "
    "particularly passphrase percentage permanent personality perspective philosophy photograph physically political "
    "population positively potentially practically president previously principal privileges procedure processing "
    "programmer programming protection psychology punishment reasonable recommended references reflection regulation "
    "religious remarkable repeatedly republican researchers resistance respectively restaurant restricted revolution "
    "scientific scientist secretary securities settlement signature simplicity situation specialist specifically "
    "specified strategies strength structure structures successful successfully sufficient supporting surprising "
    "television territory thousands tokenizer tokenization unauthorized underlying undefined unspecified unavailable "
    "unexpected unnecessary unencrypted vegetables vulnerability vulnerabilities volunteers vocabulary"
).split()
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")

_RANK = {w: k + 1 for k, w in reversed(list(enumerate(WORDS)))}
_LONGEST = max(map(len, WORDS))
_NEXT = {a + b for row in ROWS for a, b in zip(row, row[1:])} | {b + a for row in ROWS for a, b in zip(row, row[1:])}
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.](?:0[1-9]|1[0-2])[-/.](?:19|20)\d\d")
_LEET = str.maketrans("@4301$5!", "aaeoissi")


def guess_cost(value: str) -> float:
    """Log10 of the guesses for the cheapest way to cut a value into parts."""
    low = value.lower()
    plain = low.translate(_LEET)
    size = len(value)
    best = [0.0] + [math.inf] * size
    # How far the repeat and the keyboard walk that end at each place reach back.
    repeat = walk = 0
    for end in range(1, size + 1):
        repeat = repeat + 1 if end > 1 and low[end - 1] == low[end - 2] else 1
        walk = walk + 1 if end > 1 and low[end - 2 : end] in _NEXT else 1
        least = best[end - 1] + CHARACTER_COST
        if repeat >= 3:
            least = min(least, best[end - repeat] + PART_COST + math.log10(12 * repeat))
        if walk >= 3:
            least = min(least, best[end - walk] + PART_COST + math.log10(40 * walk))
        for start in range(max(0, end - _LONGEST), end - 2):
            rank = _RANK.get(low[start:end]) or 3 * _RANK.get(plain[start:end], 0)
            if rank:
                cased = 2 if value[start:end] != low[start:end] else 1
                least = min(least, best[start] + PART_COST + math.log10(rank * cased))
        for length in (10, 8, 7, 6, 4):
            if length <= end and _DATE.fullmatch(value, end - length, end):
                least = min(least, best[end - length] + PART_COST + (2.1 if length < 6 else 4.6))
        best[end] = least
    return best[size]


def _covered(start: int, end: int, spans: list[tuple[int, int]]) -> bool:
    """Whether sorted spans hold all places from ``start`` to ``end``."""
    for a, b in spans:
        if a <= start < b:
            start = b
    return start >= end


def secret_spans(text: str) -> list[tuple[int, int, int, float]]:
    """``start, kind, end, cost`` of the secrets in a text, in that order.

    Kinds are places in ``KINDS``. Base kinds are the leftmost matches of their patterns that
    do not overlap within the kind, less those that are too short. ``guess`` are values in a
    wider credential context that base finds do not cover whole, with a cost of at least ``LEAST_COST``.
    """
    found: list[tuple[int, int, int, float]] = []
    low = text.lower()
    named = any(name in low for name in _NAMES)
    if named and any(name in low for name in _ASSIGN_NAMES):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_LEAST:
                found.append((m.start(), 0, m.end(), guess_cost(m[2])))
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= ACCESS_LEAST:
            found.append((m.start(), 1, m.end(), guess_cost(m[0])))
    for m in HEX.finditer(text):
        found.append((m.start(), 2, m.end(), guess_cost(m[0])))
    if named:
        taken = sorted((start, end) for start, _, end, _ in found)
        for m in CONTEXT.finditer(text):
            start, end = m.span(1)
            if _covered(start, end, taken):
                continue
            cost = guess_cost(m[1])
            if cost >= LEAST_COST:
                found.append((start, 3, end, cost))
    return sorted(found)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` of every whole text: an array of ``kind, start, end, cost``.

    Places are code points from 0, ends exclusive, in the order of start, then kind. Null and
    empty texts have no spans; repeated rows are searched row by row. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [secret_spans(text.as_py()) for text in batch.column("text")]
            flat = [s for spans in lists for s in spans]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in lists])]).astype(np.int32)
            spans = pa.StructArray.from_arrays(
                [
                    pa.array([KINDS[s[1]] for s in flat], pa.string()),
                    pa.array([s[0] for s in flat], pa.int32()),
                    pa.array([s[2] for s in flat], pa.int32()),
                    pa.array([s[3] for s in flat], pa.float64()),
                ],
                names=["kind", "start", "end", "cost"],
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), spans)], names=["doc_id", "spans"]
            )

    schema = "doc_id bigint, spans array<struct<kind: string, start: int, end: int, cost: double>>"
    return id_and_text(docs, id_col, text_col).mapInArrow(tidy(run), schema)


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """Every row with the secrets in its text replaced by a mark; overlapping ones by one mark.

    Null texts stay null, other columns stay as they are.
    """

    def clean(text: str | None) -> str | None:
        parts, done, marked = [], 0, -1
        for start, _, end, _ in secret_spans(text) if text else ():
            if start >= marked:
                parts += [text[done:start], mark]
            marked = done = max(marked, end)
        return "".join(parts) + text[done:] if parts else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = pa.array([clean(t.as_py()) for t in batch.column(at)], pa.string())
            columns = [texts if k == at else c for k, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    rows = docs.withColumn(text_col, column(text_col).cast("string"))
    return rows.mapInArrow(tidy(run), T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema]))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def joined(spans: Column, base_only: bool) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    chosen = F.filter(spans, lambda s: s["kind"] != KINDS[-1]) if base_only else spans
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
