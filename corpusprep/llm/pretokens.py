"""Pre-tokens of a byte-level tokenizer, found and looked up with array operations.

The pre-tokenizer cuts a text at changes between letters, numbers, white space and other
characters, lets one blank join what follows it, keeps the last of several white-space
characters apart, and keeps the English endings ``'s 't 're 've 'm 'll 'd`` together. That is
the pattern of ``public_tokenizers.PATTERN``. What a pre-token is encoded to does not depend on
what stands around it, so each distinct one is encoded once.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash

OTHER, LETTER, NUMBER, SPACE = range(4)

#: Bytes that are hashed at a time; longer words are hashed one by one.
BLOCK = 1 << 20
LONG_WORD = 64
#: Distinct words a worker remembers between batches. Only a cache: beyond it, it starts anew.
REMEMBERED = 1_000_000

_MULTIPLIER = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of every code point."""
    import regex

    table = np.zeros(0x110000, np.uint8)
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    everything = "".join(map(chr, points))
    where = np.array(points)
    for kind, name in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for match in regex.finditer(name, everything):
            table[where[match.start() : match.end()]] = kind
    return table


def byte_classes(data: np.ndarray) -> np.ndarray:
    """The class of the character each byte of UTF-8 belongs to."""
    table = _classes()
    kinds = np.take(table[:256], data)
    high = np.flatnonzero(data >= 0xC0)
    if len(high):
        kinds[data >= 0x80] = OTHER
        padded = np.concatenate([data, np.zeros(4, np.uint8)])
        lead = data[high].astype(np.int64)
        one, two, three = (padded[high + k].astype(np.int64) & 0x3F for k in (1, 2, 3))
        point = np.where(
            lead < 0xE0,
            (lead & 0x1F) << 6 | one,
            np.where(lead < 0xF0, (lead & 0x0F) << 12 | one << 6 | two, (lead & 0x07) << 18 | one << 12 | two << 6 | three),
        )
        kind = table[np.minimum(point, 0x10FFFF)]
        kinds[high] = kind
        for k, least in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
            more = (lead >= least) & (high + k < len(data))
            kinds[high[more] + k] = kind[more]
    return kinds


def word_starts(data: np.ndarray, offsets: np.ndarray, specials: tuple[bytes, ...] = ()) -> np.ndarray:
    """Where the pre-tokens of the texts in ``data`` start.

    ``specials`` are strings that count as one token wherever they stand.
    """
    size = len(data)
    if not size:
        return np.zeros(0, np.int64)
    first = np.zeros(size + 1, bool)
    first[offsets] = True
    inside = []
    for special in specials:
        raw = data.tobytes() if len(data) else b""
        at = raw.find(special)
        while at >= 0:
            owner = np.searchsorted(offsets, at, "right") - 1
            if at + len(special) <= offsets[owner + 1]:
                first[[at, at + len(special)]] = True
                inside.append((at, at + len(special)))
                at = raw.find(special, at + len(special))
            else:
                at = raw.find(special, at + 1)
    kinds = byte_classes(data)
    start = first[:-1].copy()
    start[1:] |= kinds[1:] != kinds[:-1]
    runs = np.flatnonzero(start)
    ends = np.append(runs[1:], size)
    kind = kinds[runs]
    followed = ~first[ends]
    # A run of white space before something else gives up its last character.
    blank = (kind == SPACE) & followed
    last = ends[blank] - 1
    for _ in range(3):
        last = np.where((data[last] & 0xC0) == 0x80, last - 1, last)
    start[last] = True
    joins = data[last] == 0x20
    start[ends[blank][joins]] = False
    # English endings: an apostrophe that stands alone and is not joined to a blank.
    quote = np.flatnonzero((kind == OTHER) & followed & (ends - runs == 1) & (data[runs] == 0x27) & start[runs])
    if len(quote):
        at, stop = runs[quote], ends[np.minimum(quote + 1, len(ends) - 1)]
        padded = np.concatenate([data, np.zeros(2, np.uint8)])
        one, two = padded[at + 1], padded[at + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = (stop >= at + 3) & (
            ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        )
        for found, length in ((short, 1), (long, 2)):
            start[at[found] + 1] = False
            rest = at[found] + 1 + length
            start[rest[rest < size]] = True
    for low, high in inside:
        start[low + 1 : high] = False
    return np.flatnonzero(start)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.full(BLOCK + LONG_WORD, _MULTIPLIER, np.uint64)
        down = np.full(BLOCK + LONG_WORD, pow(_MULTIPLIER, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial for short words, XXH64 for long ones."""
    hashes = np.zeros(len(starts), np.uint64)
    lengths = ends - starts
    up, down = _powers()
    with np.errstate(over="ignore"):
        low = 0
        while low < len(starts):
            high = max(low + 1, int(np.searchsorted(starts, starts[low] + BLOCK - LONG_WORD, "left")))
            base = starts[low]
            if high > low + 1 or lengths[low] <= LONG_WORD:
                stop = min(int(ends[high - 1]), int(base) + BLOCK)
                sums = np.zeros(stop - base + 1, np.uint64)
                np.cumsum((data[base:stop].astype(np.uint64) + np.uint64(1)) * up[: stop - base], out=sums[1:])
                a, b = starts[low:high] - base, np.minimum(ends[low:high], stop) - base
                hashes[low:high] = (sums[b] - sums[a]) * down[a]
            low = high
        hashes ^= lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in np.flatnonzero(lengths > LONG_WORD):
        hashes[k] = xxhash.xxh64_intdigest(data[starts[k] : ends[k]].tobytes(), 7)
    return hashes


def _windows(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place of ``data`` on, as one number; the last 8 bytes are padding."""
    return np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), 0, (1,))


class WordCodes:
    """Token ids of distinct words. ``encode(words)`` gives lengths and ids of new ones.

    Words are found by their hash, and each is compared with the stored word byte by byte: words
    that share a hash get slots of their own.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], remembered: int = REMEMBERED):
        self.encode, self.remembered = encode, remembered
        self.clear()

    def clear(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.starts, self.lengths, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        # The words themselves, and slots of those whose hash another word has.
        self.raw, self.raw_starts, self.raw_lengths = np.zeros(8, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.collided: dict[bytes, int] = {}

    def _add(self, words: list[bytes]) -> np.ndarray:
        """Encode new words; their slots."""
        lengths, flat = self.encode(words)
        slots = len(self.lengths) + np.arange(len(words))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths.astype(np.int64)])
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        sizes = np.array([len(w) for w in words], np.int64)
        self.raw_starts = np.concatenate([self.raw_starts, len(self.raw) - 8 + np.cumsum(sizes) - sizes])
        self.raw_lengths = np.concatenate([self.raw_lengths, sizes])
        self.raw = np.concatenate([self.raw[:-8], np.frombuffer(b"".join(words), np.uint8), np.zeros(8, np.uint8)])
        return slots

    def _equal(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Whether each word is the one in its slot, byte by byte."""
        equal = lengths == self.raw_lengths[slots]
        mine, stored, at = _windows(np.concatenate([data, np.zeros(8, np.uint8)])), _windows(self.raw), self.raw_starts[slots]
        rows, done = np.flatnonzero(equal & (lengths <= LONG_WORD)), 0
        while len(rows):
            left = lengths[rows] - done
            apart = mine[starts[rows] + done] ^ stored[at[rows] + done]
            unused = (8 * (8 - np.minimum(left, 8))).astype(np.uint64)
            equal[rows] = apart << unused == 0
            rows, done = rows[(left > 8) & equal[rows]], done + 8
        for k in np.flatnonzero(equal & (lengths > LONG_WORD)).tolist():
            word = data[starts[k] : starts[k] + lengths[k]]
            equal[k] = np.array_equal(word, self.raw[at[k] : at[k] + lengths[k]])
        return equal

    def look_up(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The slot of each word; words not seen before are encoded."""
        if len(self.lengths) > self.remembered:
            self.clear()
        codes, keys = pd.factorize(word_hashes(data, starts, ends))
        first = np.zeros(len(keys), np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        slots = np.zeros(len(keys), np.int64)
        slots[known] = self.slots[at[known]]
        new = np.flatnonzero(~known)
        raw = memoryview(data)
        if len(new):
            slots[new] = self._add([bytes(raw[a:b]) for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())])
            order = np.argsort(keys[new])
            spot = np.searchsorted(self.keys, keys[new][order])
            self.keys = np.insert(self.keys, spot, keys[new][order])
            self.slots = np.insert(self.slots, spot, slots[new][order])
        found = slots[codes]
        other = np.flatnonzero(~self._equal(data, starts, ends - starts, found))
        if len(other):
            words = [bytes(raw[a:b]) for a, b in zip(starts[other].tolist(), ends[other].tolist())]
            unseen = list(dict.fromkeys(w for w in words if w not in self.collided))
            if unseen:
                self.collided.update(zip(unseen, self._add(unseen).tolist()))
            found[other] = [self.collided[w] for w in words]
        return found

    def ids(self, slots: np.ndarray) -> np.ndarray:
        """The ids of the words in these slots, one after the other."""
        lengths = self.lengths[slots]
        before = np.cumsum(lengths) - lengths
        return self.flat[np.repeat(self.starts[slots] - before, lengths) + np.arange(int(lengths.sum()))]

    def texts(self, data: np.ndarray, offsets: np.ndarray, specials: tuple[bytes, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of each."""
        starts = word_starts(data, offsets, specials)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        slots = self.look_up(data, starts, np.append(starts[1:], len(data)))
        sums = np.concatenate([[0], np.cumsum(self.lengths[slots])])
        bounds = np.searchsorted(starts, offsets)
        return self.ids(slots), np.diff(sums[bounds])


def special_tokens(path: str) -> dict[bytes, int]:
    """Special strings of a tokenizer file; they are matched as they stand."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        raise ValueError("only special tokens that are matched as they stand are handled")
    return {t["content"].encode(): t["id"] for t in added}
