"""Text functions against plain-Python statements of the rules."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusprep.functions import text as X
from corpusprep.operators.cleaning import (
    clean,
    clean_observed,
    cleaning_stats,
    merge_stats,
    removed_rows,
    with_removal_reason,
)
from corpusprep.operators.rows import resolve_target_column

# The letters and code point blocks of the removal rules.
MOJIBAKE = set("ÃÂÐÑØÞßæøåçðþŒœ€™¢£¥¦§¨©ª«¬®¯°±²³´µ¶·¸¹º»¼½¾¿")
POOL = "aZ5正常!?.。#£€ßÃÂ�😂🤣☀🇨🇳‍️\x00\x1c\x1f\x85\t 　\xa0$+·"


def expected_reason(text):
    stripped = (text or "").strip()
    marks = [c for c in stripped if not c.isspace()]
    if not marks:
        return "blank"
    kind = unicodedata.category
    blocks = ((0x1F300, 0x1FAFF), (0x2600, 0x27BF), (0x1F1E6, 0x1F1FF))
    if all(c in "‍️" or any(a <= ord(c) <= b for a, b in blocks) for c in marks):
        return "emoji"
    hit = any(c == "�" or c in MOJIBAKE or kind(c)[0] == "C" for c in marks)
    readable = re.search("[A-Za-z0-9一-鿿]", stripped)
    if hit and not readable and all(c in MOJIBAKE or kind(c)[0] in "CPS" for c in marks):
        return "garbled"
    if all(kind(c)[0] in "PS" for c in marks):
        return "symbol"
    return None


def test_reasons_of_random_strings(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 5))) for _ in range(8000)]
    texts += [None, "!!!", "😂🤣", "���", "正常内容", "abc123", "£", "€", "‍", "a‍", "é", "é!"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = with_removal_reason(df).collect()
    wrong = [(r.text, r.removal_reason) for r in got if r.removal_reason != expected_reason(r.text)]
    assert wrong == []


def test_cleaning_counts(spark):
    rows = ["ordinary words", "???", "", "  \t", "🙈 ☔", "��", "42", "…—", "你好吗"]
    df = spark.createDataFrame(list(enumerate(rows)), "row_index bigint, text string")
    assert [r.row_index for r in clean(df).orderBy("row_index").collect()] == [0, 6, 8]
    stats = cleaning_stats(df).first().asDict()
    assert stats == {
        "total_before": 9,
        "total_after": 3,
        "removed_blank_rows": 2,
        "removed_symbol_rows": 2,
        "removed_emoji_rows": 1,
        "removed_garbled_rows": 1,
        "total_removed": 6,
    }
    assert {r.row_index: r.removal_reason for r in removed_rows(df).collect()} == {
        1: "symbol", 2: "blank", 3: "blank", 4: "emoji", 5: "garbled", 7: "symbol",
    }
    cleaned, seen = clean_observed(df)
    assert cleaned.columns == ["row_index", "text"]
    cleaned.collect()
    assert seen.get["total_removed"] == 6 and seen.get["removed_emoji_rows"] == 1
    both = merge_stats(cleaning_stats(df).union(cleaning_stats(df))).first()
    assert both.total_before == 18 and both.removed_symbol_rows == 4


def test_empty_input_gives_zero_counts(spark):
    df = spark.createDataFrame([], "text string")
    assert clean(df).count() == 0
    assert list(cleaning_stats(df).first()) == [0] * 7


def test_target_column(spark):
    # The alias of the default column and the error sentence.
    df = spark.createDataFrame([("...", "apples"), ("pears", "…")], "text string, body string")
    assert [r.body for r in clean(df, "body").collect()] == ["apples"]
    df = spark.createDataFrame([(7, "。。"), (8, "plums")], "n bigint, `用户输入` string")
    assert resolve_target_column(df) == "用户输入" and [r.n for r in clean(df).collect()] == [8]
    with pytest.raises(ValueError, match="未找到目标列：body"):
        clean(spark.createDataFrame([("a",)], "text string"), "body")


def test_numbers_and_nan(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "text double")
    assert cleaning_stats(df).first().removed_blank_rows == 2


def test_keys(spark):
    points = [p for p in range(1, 0x110000) if not 0xD800 <= p <= 0xDFFF and unicodedata.category(chr(p))[0] in "LMSZN"]
    texts = ["x" + chr(p) + "y" for p in points if p < 0x1E900 and unicodedata.category(chr(p)) != "Cn"]
    texts += [None, "", " \tHello \n World ", "\x1c a\x1c\x1cb　c \x85", "ΑΣ Σας", "STRASSE straße", "ﬃ İ ŉ"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(8)
    got = df.select("text", X.dedup_key(F.col("text")).alias("key")).collect()
    # Cased letters newer than the JVM's Unicode version do not fold there.
    newer = {p for p in range(0x110000) if unicodedata.category(chr(p))[0] == "L" and not (p < 0xA7C0 or 0xA7F2 <= p < 0x10570 or p >= 0x105C0)}
    newer |= {0x2C2F}
    wrong = [
        (r.text, r.key)
        for r in got
        if r.key != re.sub(r"\s+", " ", (r.text or "").strip()).casefold()
        and not any(ord(c) in newer for c in r.text)
    ]
    assert wrong == []


def test_keyword_tokens(spark):
    cases = {
        "退款怎么申请": ["退款", "款怎", "申请"],
        "我要开发票": ["开发", "发票"],
        "我们 订单 A ab AB_1 的 x": ["订单", "ab", "ab_1"],
        "": [],
    }
    df = spark.createDataFrame([(t,) for t in cases], "text string")
    got = {r.text: r.tokens for r in df.select("text", X.keyword_tokens(F.col("text")).alias("tokens")).collect()}
    assert got == cases


def test_normalize_label(spark):
    cases = {
        ' "退款流程" \n第二行': "退款流程",
        "1. 退款": "退款",
        "标签：发票。": "发票",
        "2、主题: 开票!": "开票",
        "“你好”": "你好",
        " ": "",
        None: "",
    }
    df = spark.createDataFrame([(t,) for t in cases], "text string")
    got = {r.text: r.label for r in df.select("text", X.normalize_label(F.col("text")).alias("label")).collect()}
    assert got == cases


def test_prompt(spark):
    df = spark.createDataFrame([(" 你好 ",), (None,)], "text string")
    plain = [r[0] for r in df.select(X.render_prompt(F.col("text"))).collect()]
    full = [r[0] for r in df.select(X.render_prompt(F.col("text"), "短答")).collect()]
    assert plain == ["你好", ""]
    assert full[0] == "系统指令：短答\n\n用户输入：你好\n\n助手："
