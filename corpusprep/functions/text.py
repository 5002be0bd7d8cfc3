"""Text functions as native column expressions.

Every function takes and returns a ``Column``; nothing here leaves the JVM, so the
predicates stay visible to Catalyst and inside whole-stage code generation.
"""

from __future__ import annotations

import sys
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points that Unicode (and Python's ``str.isspace``) treat as space.
WHITESPACE = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)])
) + "\u2028\u2029\u202f\u205f\u3000"
# The same set, written for use inside a Java regex class.
WS = (
    r"\x09-\x0D\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

# Emoji blocks, joiner and variation selector.
_EMOJI = r"\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}\x{1F1E6}-\x{1F1FF}\x{200D}\x{FE0F}"
# Letters that a wrong decoding typically leaves behind.
_MOJIBAKE = "ÃÂÐÑØÞßæøåçðþŒœ€™¢£¥¦§¨©ª«¬®¯°±²³´µ¶·¸¹º»¼½¾¿"
_READABLE = r"[A-Za-z0-9\x{4E00}-\x{9FFF}]"

# Words and characters that are never keywords.
STOP_WORDS = (
    "的", "了", "呢", "吗", "啊", "呀", "和", "或", "及", "与", "是", "在", "把", "将", "就", "都", "也", "还", "要",
    "我", "你", "他", "她", "它", "我们", "你们", "他们",
)
STOP_CHARS = ("的", "了", "呢", "吗", "啊", "呀", "么", "是", "在", "把", "将", "就", "都", "也", "还", "要")


def raw_text(value: Column) -> Column:
    """Any cell as text; a missing value is the empty string."""
    return F.coalesce(value.cast("string"), F.lit(""))


def cell_text(value: Column) -> Column:
    """Any cell as text without leading and trailing white space."""
    return F.btrim(raw_text(value), F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    return text == ""


def is_emoji_only(text: Column) -> Column:
    return text.rlike(f"^[{WS}{_EMOJI}]+$")


def is_garbled_only(text: Column) -> Column:
    """No readable letter, at least one broken character, nothing but broken ones and symbols."""
    broken = rf"[\x{{FFFD}}{_MOJIBAKE}[\p{{C}}&&[^{WS}]]]"
    garble = rf"^[{WS}{_MOJIBAKE}\p{{C}}\p{{P}}\p{{S}}]+$"
    return ~text.rlike(_READABLE) & text.rlike(broken) & text.rlike(garble)


def is_symbol_only(text: Column) -> Column:
    return text.rlike(rf"^[{WS}\p{{P}}\p{{S}}]+$")


def removal_reason(value: Column) -> Column:
    """Why a row should go: blank, emoji, garbled or symbol (first that applies), else null.

    A readable letter rules out all of them, and most texts show one at once.
    """
    text = cell_text(value)
    return (
        F.when(raw_text(value).rlike(_READABLE), F.lit(None).cast("string"))
        .when(is_blank(text), "blank")
        .when(is_emoji_only(text), "emoji")
        .when(is_garbled_only(text), "garbled")
        .when(is_symbol_only(text), "symbol")
    )


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[dict[str, str], dict[str, str]]:
    """Lower-case characters whose Unicode case folding differs: one-to-one, and expanding."""
    single: dict[str, str] = {}
    several: dict[str, str] = {}
    for point in range(0x80, sys.maxunicode + 1):
        char = chr(point)
        folded = char.casefold()
        if folded == char or char.lower() != char:
            continue
        (single if len(folded) == 1 else several)[char] = folded
    return single, several


def _span_class(chars) -> str:
    """A short regex class that covers all of ``chars`` (gaps up to 64 code points are filled)."""
    spans: list[list[int]] = []
    for point in sorted(map(ord, chars)):
        if spans and point - spans[-1][1] <= 64:
            spans[-1][1] = point
        else:
            spans.append([point, point])
    return "[" + "".join(rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for lo, hi in spans) + "]"


def casefold(text: Column) -> Column:
    """Full Unicode case folding.

    ``lower`` does nearly all of it, and sharp s is a plain replacement. The few hundred other
    characters that fold differently are handled behind a guard that ordinary text fails.
    """
    single, several = _fold_tables()
    rare = {char: folded for char, folded in several.items() if char != "ß"}
    lowered = F.lower(text)
    mapped = F.translate(lowered, "".join(single), "".join(single.values()))
    # Ligatures and the like are spelled out character by character.
    spelled = F.expr(f"map_from_arrays(split('{' '.join(rare)}', ' '), split('{' '.join(rare.values())}', ' '))")
    chars = F.transform(F.split(mapped, ""), lambda char: F.coalesce(spelled[char], char))
    unusual = F.when(mapped.rlike("[" + "".join(rare) + "]"), F.array_join(chars, "")).otherwise(mapped)
    guard = rf"[^\x00-\x7F](?<={_span_class([*single, *rare])})"
    folded = F.when(lowered.rlike(guard), unusual).otherwise(lowered)
    return F.replace(folded, F.lit("ß"), F.lit("ss"))


def collapse_spaces(text: Column) -> Column:
    """Every run of white space as one space; a single space is not even touched."""
    space = r"[\s\x1C-\x1F]"
    return F.regexp_replace(text, rf"(?U)(?![!-~]){space}(?:(?<! )|{space}){space}*", " ")


def dedup_key(value: Column) -> Column:
    """The form under which two texts count as equal: stripped, single-spaced, case-folded.

    ASCII without white space and control characters needs no more than small letters.
    """
    text = raw_text(value)
    return F.when(~text.rlike("[^!-~]"), F.lower(text)).otherwise(casefold(collapse_spaces(cell_text(value))))


def key_digest(key: Column) -> Column:
    """32-byte SHA-256 of a key: what is shuffled and compared instead of whole texts."""
    return F.unhex(F.sha2(key, 256))


def short_digest(key: Column) -> Column:
    """A key itself if it has less than 32 bytes, else its digest, which has 32.

    Not for tables that are kept: these hold ``key_digest``.
    """
    return F.when(F.octet_length(key) < 32, key.cast("binary")).otherwise(key_digest(key))


def keyword_tokens(value: Column) -> Column:
    """Keyword candidates of a text, with repeats.

    Latin runs of two or more characters; Chinese runs of one or two characters as they are,
    longer ones as two-character pieces without stop words and stop characters.
    """
    runs = F.filter(
        F.regexp_extract_all(
            casefold(cell_text(value)), F.lit(r"[A-Za-z0-9_]+|[\x{4E00}-\x{9FFF}]+"), F.lit(0)
        ),
        lambda run: ~run.isin(*STOP_WORDS),
    )

    def pieces(run: Column) -> Column:
        size = F.char_length(run)
        chars = F.split(run, "")
        cut = F.zip_with(
            F.slice(chars, 1, size - 1), F.slice(chars, 2, size), lambda one, next_one: F.concat(one, next_one)
        )
        usable = F.filter(
            cut, lambda piece: ~piece.isin(*STOP_WORDS) & ~piece.rlike(f"[{''.join(STOP_CHARS)}]")
        )
        none = F.array().cast("array<string>")
        return (
            F.when(run.rlike(r"^[\x{4E00}-\x{9FFF}]") & (size > 2), usable)
            .when(run.rlike(r"^[\x{4E00}-\x{9FFF}]") | (size >= 2), F.array(run))
            .otherwise(none)
        )

    return F.flatten(F.transform(runs, pieces))


def normalize_label(value: Column) -> Column:
    """Tidy a generated label: first line, no quotes, numbering, "label:" prefix or end marks."""
    # The quotes, prefix words and end marks that are cut off.
    line = r"\r\n\x0B\x0C\x1C-\x1E\x85\x{2028}\x{2029}"
    quotes = f"[{WS}\"'“”‘’]+"
    text = F.regexp_replace(cell_text(value), f"(?s)[{line}].*$", "")
    text = F.regexp_replace(text, f"^{quotes}|{quotes}$", "")
    text = F.regexp_replace(text, rf"^[0-9]+[.)、:\-][{WS}]*", "")
    text = F.regexp_replace(text, f"^(?:标签|主题)[:：][{WS}]*", "")
    return F.btrim(text, F.lit(" .,!?:;，。！？；："))


def render_prompt(value: Column, system_prompt: str = "") -> Column:
    """The model input for a cell, with the system prompt around it if there is one."""
    text = cell_text(value)
    if not system_prompt:
        return text
    return F.concat(
        F.lit(f"系统指令：{system_prompt}\n\n用户输入："), text, F.lit("\n\n助手：")
    )


def match_expected(expected: Column, result: Column) -> Column:
    """Whether an answer equals the expected one after text normalisation."""
    return dedup_key(expected) == dedup_key(result)
