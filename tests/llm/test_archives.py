import hashlib
import io
import random
import zipfile

import pytest
from helpers import by_id, empty
from pyspark.sql import functions as F

from corpusprep.llm import archives, queries

SCHEMA = "page_id bigint, url string, html string"
LONG = "é" * 600
ROWS = [
    (1, "http://a/ b\n", LONG), (20, "http://x.org/a%20b?q=%2F", "u"), (21, "é%20 %", "u"), (22, "", "u"), (23, " ", "u"), (24, "a:b%", "u"), (5, None, LONG), (5, "http://b", LONG), (None, "c", LONG), (7, "d", None), (8, "e", ""), (11, "h", "short"),
    (12, "h", "short"), (13, "i", "x" * 999), (14, "i", "x" * 999), (15, "j", "y" * 1000), (16, "j", "y" * 1000), (17, "k", "z\r\n\r\n" * 50_000), (18, "k", "z\r\n\r\n" * 50_000),
]


def want(rows):
    for page_id, url, html in rows:
        raw = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "").encode() == raw and r[0] is not None]
        holder = max(same, default=None) if len(raw) >= 1000 else None
        again = holder is not None and holder != page_id
        yield page_id, "revisit" if again else "response", holder if again else None, hashlib.sha1(raw).hexdigest(), len(raw)


def test_round_trip_of_odd_rows(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    manifest = archives.write_packages(pages, str(tmp_path / "a"), package_bytes=500)
    assert manifest.count() > 3 and sum(r.records for r in manifest.collect()) == len(ROWS)
    read = archives.read_packages(manifest, payloads=True).collect()
    assert by_id((r.page_id, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes) for r in read) == by_id(want(ROWS))
    texts = {i: (h or "").encode() for i, _, h in ROWS}
    assert all(bytes(r.payload) == texts[r.page_id] for r in read if r.record_type == "response")
    assert all(r.payload is None for r in read if r.record_type == "revisit")
    assert {r.url for r in read} == {u for _, u, _ in ROWS}


@pytest.mark.parametrize("comment", [b"", b"a comment with PK\x05 in it"])
def test_members_of_any_zip(comment):
    out = io.BytesIO()
    rng = random.Random(1)
    parts = {f"m{k}": rng.randbytes(50 * k) for k in range(8)}
    with zipfile.ZipFile(out, "w") as file:
        file.comment = comment
        for k, (name, data) in enumerate(parts.items()):
            if k == 3:
                file.writestr(name, data, zipfile.ZIP_DEFLATED)
            else:
                with file.open(zipfile.ZipInfo(name), "w", force_zip64=k % 2 == 0) as member:
                    member.write(data)
    raw = out.getvalue()
    found = archives.stored_members(lambda start, length: raw[start : start + length], len(raw))
    assert {name: raw[a : a + n] for name, (a, n) in found.items()} == {n: d for k, (n, d) in enumerate(parts.items()) if k != 3}


def test_zip64_end_record(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as file:
        for k in range(5):
            file.writestr(f"n{k}", b"data" * k)
    raw = out.getvalue()
    assert b"PK\x06\x07" in raw
    found = archives.stored_members(lambda start, length: raw[start : start + length], len(raw))
    assert [raw[a : a + n] for a, n in found.values()] == [b"data" * k for k in range(5)]


def test_packages_are_zip64_that_others_read():
    raw = archives.package([b"one", b"three"], ["a", "b"])
    assert raw[-42:-38] == b"PK\x06\x07" and raw[-98:-94] == b"PK\x06\x06" and raw.count(b"\xff" * 8) >= 4
    with zipfile.ZipFile(io.BytesIO(raw)) as file:
        assert file.testzip() is None
        assert {n: file.read(n) for n in file.namelist()} == {archives.DATA: b"onethree", archives.INDEX: b"a 0 3\nb 3 5\n"}
    found = archives.stored_members(lambda start, length: raw[start : start + length], len(raw))
    assert {n: raw[a : a + k] for n, (a, k) in found.items()} == {archives.DATA: b"onethree", archives.INDEX: b"a 0 3\nb 3 5\n"}


def test_clashing_names(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    names = ["payload", "digest", "holder", "key", "rows", "file", "records", "url_", "record_type", "refers_to"]
    clash = pages.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])
    got = archives.archived(clash).collect()
    assert by_id((r.page_id, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes) for r in got) == by_id(want(ROWS))


def test_damage_is_noticed():
    raw = archives.record(1, "u", "response", hashlib.sha1(b"body").hexdigest(), 4, b"body", None)
    assert archives.parse_record(raw)["payload"] == b"body"
    for broken in (raw.replace(b"body", b"bodx"), raw[:-6], b"nothing"):
        with pytest.raises(ValueError):
            archives.parse_record(broken)
    with pytest.raises(ValueError):
        archives.stored_members(lambda start, length: b"", 0)


def test_empty_tables_and_query(spark):
    assert archives.archived(empty(spark, SCHEMA)).count() == 0
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    got = queries.op8_archives(spark, "/root/testdata/sf0.001").collect()
    assert by_id((r.page_id, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes) for r in got) == by_id(want([(r.page_id, r.url, r.html) for r in pages]))
