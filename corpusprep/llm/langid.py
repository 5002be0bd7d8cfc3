"""Language identification by cross-parsing entropy.

Labelled text of each language becomes a suffix automaton, which holds all its substrings. A
text is cut greedily into phrases, each the longest match in the automaton from where the last
one ended. In its own language a text needs few and long phrases. The count is normalised by
the size of the labelled text, ``phrases * log2(size) / characters``: the bits to point to the
phrases. The language with the smallest cost wins; ties go to the smaller label.

Characters are folded to lower case; every run of characters that are not letters is one blank.
A text is parsed in blocks of ``BLOCK`` characters, whole texts always, so that array
operations walk many blocks at once through the transition tables. A block's end ends a phrase,
so a count is at most one phrase a block above that of the text in one piece.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.llm.common import free_name, pieces, text_bytes, tidy
from corpusprep.operators.rows import column

#: Labelled text of one language: at most about this many characters, a sample of blocks
#: from all its labelled texts.
SAMPLE_CHARS = 40_000
#: Characters of a sampled block.
SAMPLE_BLOCK = 200
#: Characters of a block that is parsed on its own.
BLOCK = 1024
#: Bytes of text parsed at a time.
PIECE = 4 << 20
#: Draws for a row's place in a table.
TRIES = 1000
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """Lower-case code point of each letter, 0 for everything else."""
    import regex

    table = np.zeros(0x110000, np.int32)
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    for match in regex.finditer(r"\p{L}", "".join(map(chr, points))):
        letter = match.group()
        lower = letter.lower()
        table[ord(letter)] = ord(lower) if len(lower) == 1 else ord(letter)
    return table


def fold(text: str) -> np.ndarray:
    """Folded code points of a text; runs of other characters are one 0."""
    points = _folded()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    return points[(points != 0) | np.append(True, points[:-1] != 0)] if len(points) else points


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings of a sequence."""
    moves: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for symbol in symbols:
        current = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and symbol not in moves[state]:
            moves[state][symbol] = current
            state = link[state]
        if state >= 0:
            target = moves[state][symbol]
            if length[state] + 1 == length[target]:
                link[current] = target
            else:
                copy = len(moves)
                moves.append(dict(moves[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                while state >= 0 and moves[state].get(symbol) == target:
                    moves[state][symbol] = copy
                    state = link[state]
                link[target] = link[current] = copy
        last = current
    return moves


def compact(moves: list[dict[int, int]], alphabet: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transitions in two flat arrays: rows of few entries laid over one another.

    A state is the place where its row begins; no two begin at one place. Its transition by
    symbol ``x`` stands at ``state + x`` if ``owner`` there names the state, and leads to
    ``target``; else it has none. The third array gives each automaton state's place.
    """
    # Large rows first, each where a seeded draw finds room: three of four entries stay free.
    room = 4 * sum(map(len, moves)) + 1
    taken, begun = bytearray(room + alphabet), bytearray(room)
    place = np.zeros(len(moves), np.int64)
    draw = random.Random(1).random
    for state in sorted(range(len(moves)), key=lambda s: (-len(moves[s]), s)):
        symbols, tries = list(moves[state]), 0
        begin = int(draw() * room)
        while begun[begin] or any(taken[begin + x] for x in symbols):
            tries += 1
            if tries == TRIES:  # a place of its own behind all others
                begin = len(taken)
                taken.extend(bytes(alphabet))
                begun.extend(bytes(len(taken) - len(begun)))
                break
            begin = int(draw() * room)
        begun[begin] = 1
        place[state] = begin
        for x in symbols:
            taken[begin + x] = 1
    last = len(taken)
    owner, target = np.full(last, -1, np.int32), np.zeros(last, np.int32)
    for state, out in enumerate(moves):
        for x, to in out.items():
            owner[place[state] + x], target[place[state] + x] = place[state], place[to]
    return owner, target, place


class Parser:
    """The automata of all languages as flat tables that count phrases while they walk.

    Every letter of the samples is a symbol of its own; a letter that no sample has is a phrase
    of its own in every language. The tables take some 100 bytes for each sampled character.
    """

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        texts = [(lang, fold(text)) for lang, text in samples]
        self.langs = [lang for lang, _ in texts]
        self.letters = np.unique(np.concatenate([np.zeros(1, np.int32), *[t for _, t in texts]]))
        # Symbol 0 is the blank, the last one stands for letters unknown to all.
        self.alphabet = len(self.letters) + 1
        self.owners, self.targets, self.roots, self.absent, self.bits = [], [], [], [], []
        for _, text in texts:
            moves = suffix_automaton(np.searchsorted(self.letters, text).tolist())
            owner, target, place = compact(moves, self.alphabet)
            starts = np.full(self.alphabet, place[0], np.int32)
            absent = np.ones(self.alphabet, np.int32)
            for x, to in moves[0].items():
                starts[x], absent[x] = place[to], 0
            self.owners.append(owner)
            self.targets.append(target)
            self.roots.append((int(place[0]), starts))
            self.absent.append(absent)
            self.bits.append(np.log2(max(len(text), 2)))

    def symbols(self, folded: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.letters, folded), len(self.letters) - 1)
        return np.where(self.letters[at] == folded, at, self.alphabet - 1).astype(np.int32)

    def costs(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cost of each text (row) in each language, and its number of letters."""
        documents = len(offsets) - 1
        costs, letters = np.zeros((documents, len(self.langs))), np.zeros(documents, np.int64)
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        folded = _folded()[points]
        owner = np.repeat(np.arange(documents), np.diff(starts))
        letters += np.bincount(owner[folded != 0], minlength=documents)
        same = np.zeros(len(folded), bool)
        same[1:] = (folded[1:] == 0) & (folded[:-1] == 0) & (owner[1:] == owner[:-1])
        symbols, owner = self.symbols(folded[~same]), owner[~same]
        sizes = np.bincount(owner, minlength=documents)
        begins = np.cumsum(sizes) - sizes
        # Blocks, longest first, so that those still under way stand in front.
        blocks = -(-sizes // BLOCK)
        of = np.repeat(np.arange(documents), blocks)
        place = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        first = begins[of] + place * BLOCK
        length = np.minimum(sizes[of] - place * BLOCK, BLOCK)
        order = np.argsort(-length, kind="stable")
        of, first, length = of[order], first[order], length[order]
        if not len(of):
            return costs, letters
        going = np.searchsorted(-length, -np.arange(length[0]), "left")
        count = np.zeros((len(self.langs), len(of)), np.int32)
        state = [np.full(len(of), root, np.int32) for root, _ in self.roots]
        for step in range(int(length[0])):
            active = int(going[step])
            symbol = symbols[first[:active] + step]
            for k, (owner, target) in enumerate(zip(self.owners, self.targets)):
                root, starts = self.roots[k]
                now = state[k][:active]
                entry = now + symbol
                goes_on = owner[entry] == now
                # Where no match goes on, an open phrase ends and the symbol begins the next one;
                # a symbol that the language lacks is a phrase of its own, after which none is open.
                ended = (now != root).astype(np.int32) + self.absent[k][symbol]
                count[k, :active] += np.where(goes_on, 0, ended)
                state[k][:active] = np.where(goes_on, target[entry], starts[symbol])
        for k, bits in enumerate(self.bits):
            # The phrase that the end of a block cuts off counts as well.
            costs[:, k] = np.bincount(of, count[k] + (state[k] != self.roots[k][0]), minlength=documents) * bits
        return costs / np.maximum(sizes, 1)[:, None], letters


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        sample_chars: int = SAMPLE_CHARS) -> tuple[tuple[str, str], ...]:
    """Labelled text per language: blocks of ``SAMPLE_BLOCK`` characters drawn from all texts.

    About ``sample_chars`` characters of each language, fewer where it has fewer; the draw
    depends on ids and places only. Rows without a label or text are left out; an empty table
    gives an empty sample. What reaches the driver is bounded by the number of languages times
    ``sample_chars``.
    """
    rows = labelled.select(
        column(text_col).cast("string").alias("text"),
        column(lang_col).cast("string").alias("lang"),
        column(id_col).cast("bigint").alias("id"),
    ).filter("text <> '' and lang is not null")
    blocks = F.ceil(F.length("text") / SAMPLE_BLOCK).cast("int")
    wanted = max(1, sample_chars // SAMPLE_BLOCK)
    # One row per language.
    totals = rows.groupBy("lang").agg(F.sum(blocks).alias("blocks")).collect()
    if not totals:
        return ()
    share = F.create_map(*[F.lit(v) for r in totals for v in (r["lang"], min(1.0, 1.2 * wanted / r["blocks"]))])
    drawn = rows.withColumn("rate", share[F.col("lang")]).withColumn(
        "places",
        F.filter(
            F.sequence(F.lit(0), blocks - 1),
            lambda k: F.pmod(F.xxhash64(F.lit(20), F.col("id"), k), F.lit(1 << 30)) < F.col("rate") * (1 << 30),
        ),
    )
    parts = drawn.filter(F.size("places") > 0).select(
        "lang",
        "id",
        F.explode(
            F.transform(
                "places",
                lambda k: F.struct(k.alias("at"), F.substring("text", k * SAMPLE_BLOCK + 1, F.lit(SAMPLE_BLOCK)).alias("piece")),
            )
        ).alias("part"),
    )
    texts: dict[str, list[str]] = {}
    for r in sorted(parts.collect(), key=lambda r: (r["lang"], r["id"] is not None, r["id"] or 0, r["part"])):
        texts.setdefault(r["lang"], []).append(r["part"]["piece"])
    return tuple((lang, " ".join(found)[:sample_chars]) for lang, found in sorted(texts.items()))


def identify(docs: DataFrame, samples: tuple[tuple[str, str], ...], text_col: str = "text", drop_text: bool = False) -> DataFrame:
    """Every row with ``lang_pred, score, bits``, found from its whole text.

    ``bits`` is the cost per character in the language found, ``score`` how much smaller it is
    than the next one's (``1 - best / second``; 1 with a single language). Texts that are null
    or have no letter are ``und`` with score 0 and null bits; so are all texts if there are no
    samples. Columns that have one of these names are replaced. Nothing is shuffled. The tables
    are made once, by the driver, from the samples of bounded size, and sent to the workers,
    which keep nothing of them.
    """
    parser = Parser(samples) if samples else None
    added = ["lang_pred", "score", "bits"]
    names = [c for c in docs.columns if c.lower() not in added]
    sent = [c for c in names if not (drop_text and c == text_col)]
    whole = free_name(docs, "whole_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(whole))
            for low, high in pieces(offsets, PIECE):
                rows = high - low
                langs: list[str] = [UNDETERMINED] * rows
                score, bits = np.zeros(rows), np.full(rows, np.nan)
                if parser:
                    costs, letters = parser.costs(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                    best, found = costs.argmin(axis=1), letters > 0
                    least = costs[np.arange(rows), best]
                    langs = [parser.langs[b] if f else UNDETERMINED for b, f in zip(best.tolist(), found.tolist())]
                    second = np.partition(costs, 1, axis=1)[:, 1] if costs.shape[1] > 1 else np.full(rows, np.inf)
                    score = np.where(found, 1 - least / np.maximum(second, 1e-12), 0.0)
                    bits = np.where(found, least, np.nan)
                columns = [batch.column(c).slice(low, rows) for c in sent]
                columns += [pa.array(langs, pa.string()), pa.array(score), pa.array(bits, mask=np.isnan(bits))]
                yield pa.RecordBatch.from_arrays(columns, names=sent + added)

    text = F.coalesce(column(text_col).cast("string"), F.lit("")).alias(whole)
    schema = T.StructType(
        [docs.schema[c] for c in sent]
        + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits", T.DoubleType())]
    )
    return docs.select(*[column(c) for c in sent], text).mapInArrow(tidy(run), schema)
