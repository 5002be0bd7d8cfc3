"""Token ids of a word-level BPE tokenizer: lower-cased words without white space.

The tokenizer normalises a text (NFC, lower case), cuts it into runs of letters, single digits,
runs of other characters and the English endings, and drops white space. What a word is encoded
to depends on the word alone, so each distinct one is encoded once, by the tokenizers library.
Texts that the library normalises in a way of its own are normalised by it.
"""

from __future__ import annotations

import os
import unicodedata
from functools import lru_cache

import numpy as np

from corpusprep.llm.pretokens import LETTER, NUMBER, OTHER, SPACE, WordCodes, byte_classes, special_tokens


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of the normalised texts in ``data`` start and end."""
    size = len(data)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kinds = byte_classes(data)
    first = np.zeros(size + 1, bool)
    first[offsets] = True
    start = first[:-1].copy()
    start[1:] |= kinds[1:] != kinds[:-1]
    start |= (kinds == NUMBER) & ((data & 0xC0) != 0x80)
    # English endings: an apostrophe alone before letters; those after the ending are a new word.
    runs = np.flatnonzero(start)
    ends = np.append(runs[1:], size)
    kind = kinds[runs]
    quote = np.flatnonzero((kind[:-1] == OTHER) & (kind[1:] == LETTER) & (data[runs[:-1]] == 0x27) & (ends[:-1] - runs[:-1] == 1) & ~first[ends[:-1]])
    if len(quote):
        at, stop = runs[quote], ends[quote + 1]
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
    runs = np.flatnonzero(start)
    ends = np.append(runs[1:], size)
    words = kinds[runs] != SPACE
    return runs[words], ends[words]


class WordTokens:
    """Ids of whole texts. ``ids(texts)`` gives all ids, one text after the other, and their numbers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.normalizers import Lowercase

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [s.decode() for s in special_tokens(path)]
        self.words = WordCodes(self._encode)
        # Characters that the library lowers in another way than Python does, alone or in context.
        lower = Lowercase()
        points = [chr(p) for p in range(0x80, 0x110000) if not 0xD800 <= p < 0xE000]
        theirs = lower.normalize_str("\n".join(points)).split("\n")
        odd = [c for c, low in zip(points, theirs) if c.lower() != low]
        import regex

        self.odd = regex.compile("[" + "".join(map(regex.escape, [*odd, "Σ"])) + "]")

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lists = [e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]
        lengths = np.array([len(x) for x in lists], np.int64)
        return lengths, np.fromiter((i for x in lists for i in x), np.int32, int(lengths.sum()))

    def normalised(self, text: str) -> str:
        if text.isascii() or (unicodedata.is_normalized("NFC", text) and not self.odd.search(text)):
            return text.lower()
        return self.tokenizer.normalizer.normalize_str(text)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        special = [any(s in t for s in self.specials) for t in texts]
        raw = [b"" if s else self.normalised(t).encode() for t, s in zip(texts, special)]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)])
        data = np.frombuffer(b"".join(raw), np.uint8)
        starts, ends = word_bounds(data, offsets)
        if len(starts):
            slots = self.words.look_up(data, starts, ends)
            sums = np.concatenate([[0], np.cumsum(self.words.lengths[slots])])
            counts, flat = np.diff(sums[np.searchsorted(starts, offsets)]), self.words.ids(slots)
        else:
            counts, flat = np.zeros(len(texts), np.int64), np.zeros(0, np.int32)
        if any(special):  # texts with a special token in them: as the library cuts them
            parts = np.split(flat, np.cumsum(counts)[:-1])
            for k in np.flatnonzero(special).tolist():
                parts[k] = np.array(self.tokenizer.encode(texts[k], add_special_tokens=False).ids, np.int32)
                counts[k] = len(parts[k])
            flat = np.concatenate(parts)
        return flat, counts


@lru_cache(maxsize=1)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)
