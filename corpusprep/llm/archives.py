"""WARC records in ZIP packages, read in place.

A package is a ZIP file whose members are stored, not compressed: ``archive/data.warc.gz``,
where each WARC record is a gzip member of its own, and ``indexes/index.cdx``, one line per
record with its place. Packages are written with ZIP64 fields. The reader finds the central
directory through the end record, or the ZIP64 end record where numbers are not in it, locates the stored members, reads the index and
then each record by its range; nothing is extracted.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import scratch
from corpusprep.llm.tokenfiles import _filesystem
from corpusprep.operators.rows import column

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: Payloads from this size on are kept once; records with the same payload revisit that one.
REVISIT_BYTES = 1000
#: A task begins a new package when one holds this many bytes.
PACKAGE_BYTES = 32 << 20

_END, _END64, _LOCATOR, _ENTRY, _LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
#: Stands in a header for a number that is in the ZIP64 field.
_IN_EXTRA = 0xFFFFFFFF
#: Characters that stay as they are in an escaped url.
_PLAIN = "".join(chr(c) for c in range(0x21, 0x7F) if chr(c) != "%")
#: Says that the url holds characters which a header cannot, and is escaped; others stay as given.
_ESCAPED = "X-Target-URI-Escaped: yes"


# --- records -------------------------------------------------------------------------------


def record(page_id: int | None, url: str | None, kind: str, digest: str, size: int, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record. A revisit has the headers of the response it stands for, no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>"]
    if url is not None:
        fits = all("!" <= c <= "~" for c in url)
        lines.append(f"WARC-Target-URI: {url if fits else quote(url, safe=_PLAIN)}")
        if not fits:
            lines.append(_ESCAPED)
    lines += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        lines += [
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The fields of a record; raises ``ValueError`` if it is damaged."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    if len(block) < int(fields["content-length"]):
        raise ValueError("a WARC record ends early")
    http, _, payload = block.partition(b"\r\n\r\n")
    kept = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in http.decode("latin-1").split("\r\n")[1:])}
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError("a payload differs from its digest")

    def page(name: str) -> int | None:
        number = fields.get(name, "<urn:page:null>").removeprefix("<urn:page:").removesuffix(">")
        return None if number == "null" else int(number)

    uri = fields.get("warc-target-uri")
    return {
        "page_id": page("warc-record-id"),
        "url": unquote(uri) if uri is not None and "x-target-uri-escaped" in fields else uri,
        "record_type": kind,
        "refers_to": page("warc-refers-to"),
        "payload_digest": digest,
        "payload_bytes": len(payload) if kind == "response" else int(kept["content-length"]),
        "payload": payload if kind == "response" else None,
    }


# --- packages ------------------------------------------------------------------------------


def package(records: list[bytes], names: list[str]) -> bytes:
    """A ZIP package of gzipped records; all sizes, places and counts are written in ZIP64 form."""
    lines, place = [], 0
    for name, raw in zip(names, records):
        lines.append(f"{name} {place} {len(raw)}\n".encode())
        place += len(raw)
    out, directory = io.BytesIO(), b""
    for member, parts in ((DATA, records), (INDEX, lines)):
        name, start, size, crc = member.encode(), out.tell(), sum(map(len, parts)), 0
        for part in parts:
            crc = zlib.crc32(part, crc)
        # Version 4.5, no flags, stored, the first day a ZIP date can hold.
        facts = struct.pack("<HHHHHI", 45, 0, 0, 0, 33, crc)
        out.write(_LOCAL + facts + struct.pack("<IIHH", _IN_EXTRA, _IN_EXTRA, len(name), 20) + name)
        out.write(struct.pack("<HHQQ", 1, 16, size, size))
        out.writelines(parts)
        directory += _ENTRY + struct.pack("<H", 45) + facts
        directory += struct.pack("<IIHHHHHII", _IN_EXTRA, _IN_EXTRA, len(name), 28, 0, 0, 0, 0, _IN_EXTRA) + name
        directory += struct.pack("<HHQQQ", 1, 24, size, size, start)
    start = out.tell()
    out.write(directory)
    end = out.tell()
    out.write(_END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 2, 2, len(directory), start))
    out.write(_LOCATOR + struct.pack("<IQI", 0, end, 1))
    out.write(_END + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, _IN_EXTRA, _IN_EXTRA, 0))
    return out.getvalue()


Read = Callable[[int, int], bytes]


def _zip64(extra: bytes, wanted: list[int]) -> list[int]:
    """Numbers of an entry, those that do not fit taken from its ZIP64 field in their order."""
    found, place = list(wanted), 0
    while place + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, place)
        if kind == 1:
            at = place + 4
            for k, value in enumerate(found):
                if value == _IN_EXTRA:
                    found[k] = struct.unpack_from("<Q", extra, at)[0]
                    at += 8
        place += 4 + size
    return found


def stored_members(read: Read, size: int) -> dict[str, tuple[int, int]]:
    """Start and length of the data of each stored member of a ZIP file.

    ``read(start, length)`` gives a range of the file. Compressed members are left out.
    """
    start = max(0, size - (22 + 0xFFFF))
    tail = read(start, size - start)
    at = tail.rfind(_END)
    if at < 0:
        raise ValueError("not a ZIP file")
    count, length, offset = struct.unpack_from("<HII", tail, at + 10)
    if tail[max(0, at - 20) : at][:4] == _LOCATOR and (count == 0xFFFF or _IN_EXTRA in (length, offset)):
        where = struct.unpack_from("<Q", tail, at - 20 + 8)[0]
        record64 = read(where, 56)
        if record64[:4] != _END64:
            raise ValueError("the ZIP64 end record is missing")
        count, length, offset = struct.unpack_from("<QQQ", record64, 32)
    directory = read(offset, length)
    members, place = {}, 0
    for _ in range(count):
        if directory[place : place + 4] != _ENTRY:
            raise ValueError("the central directory is damaged")
        method, = struct.unpack_from("<H", directory, place + 10)
        packed, full, name, extra, comment = struct.unpack_from("<IIHHH", directory, place + 20)
        header, = struct.unpack_from("<I", directory, place + 42)
        after = place + 46 + name
        full, packed, header = _zip64(directory[after : after + extra], [full, packed, header])
        if method == 0:
            local = read(header, 30)
            if local[:4] != _LOCAL:
                raise ValueError("a local header is missing")
            names, extras = struct.unpack_from("<HH", local, 26)
            members[directory[place + 46 : after].decode()] = (header + 30 + names + extras, packed)
        place = after + extra + comment
    return members


def package_records(read: Read, size: int) -> Iterator[dict]:
    """All records of a package, found by its index and read one by one."""
    members = stored_members(read, size)
    data, _ = members[DATA]
    for line in read(*members[INDEX]).decode().splitlines():
        _, start, length = line.rsplit(" ", 2)
        yield parse_record(zlib.decompress(read(data + int(start), int(length)), 31))


# --- tables --------------------------------------------------------------------------------


def write_packages(pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """A WARC record per row of ``pages`` (page_id, url, html), in packages below ``folder``.

    Of rows with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the largest
    page_id is the response, the others revisit it; of rows that share that page_id each is a
    response. Null html is an empty payload; null ids and urls stay null. Returns the manifest
    ``file, records``; an empty table gives an empty one. ``folder`` must be visible to all
    executors. Files of attempts that did not end are in no manifest.
    """
    rows = pages.select(
        column("page_id").cast("bigint").alias("page_id"),
        column("url").cast("string").alias("url"),
        F.coalesce(column("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    # Payloads that more than one row has: the other side of the join has a row for each.
    shared = rows.filter(F.length("payload") >= REVISIT_BYTES).groupBy("digest").agg(
        F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("rows")
    )
    # Payloads too small to be shared, empty ones above all, are spread instead of meeting at one digest.
    alone = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))
    key = F.when(F.length("payload") >= REVISIT_BYTES, F.col("digest")).otherwise(alone)
    holders = shared.filter("rows > 1").select(F.col("digest").alias("key"), "holder")
    decided = rows.withColumn("key", key).join(holders, "key", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records: list[bytes] = []
        names: list[str] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal size
            name = f"part-{uuid.uuid4().hex}.wacz"
            store, root = _filesystem(folder)
            store.create_dir(root, recursive=True)
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(package(records, names))
            row = pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([len(records)], pa.int64())], names=["file", "records"])
            records.clear(), names.clear()
            size = 0
            return row

        for batch in batches:
            for page_id, url, digest, payload, holder in zip(*(batch.column(c) for c in ("page_id", "url", "digest", "payload", "holder"))):
                number, body, holder = page_id.as_py(), payload.as_py(), holder.as_py()
                kind = "response" if holder is None or holder == number else "revisit"
                raw = record(number, url.as_py(), kind, digest.as_py(), len(body), body, holder)
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                records.append(packer.compress(raw) + packer.flush())
                names.append(f"{number} {kind} {digest.as_py()}")
                size += len(records[-1])
                if size >= package_bytes:
                    yield flush()
        if records:
            yield flush()

    decided.select("page_id", "url", "digest", "payload", "holder").mapInArrow(run, "file string, records bigint").write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.parquet(f"{folder}/manifest")


def read_packages(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """``page_id, url, record_type, refers_to, payload_digest, payload_bytes`` of every record.

    Size and digest are those of the full payload, for revisits as their headers have them;
    a response whose payload differs from its digest fails the read. With ``payloads`` the
    payload of responses comes along.
    """
    kinds = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload_digest": pa.string(), "payload_bytes": pa.int64()}
    if payloads:
        kinds["payload"] = pa.binary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                store, path = _filesystem(name)
                with store.open_input_file(path) as source:

                    def read(start: int, length: int) -> bytes:
                        source.seek(start)
                        return source.read(length)

                    held: list[dict] = []
                    size = 0
                    for found in package_records(read, source.size()):
                        size += found["payload_bytes"]
                        held.append(found)
                        if not payloads:
                            found["payload"] = None
                        if len(held) >= 1000 or size > 16 << 20:
                            yield _batch(held, kinds)
                            held, size = [], 0
                    if held:
                        yield _batch(held, kinds)

    shuffles = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint"
    return manifest.select("file").repartition(shuffles, "file").mapInArrow(run, schema + ", payload binary" * payloads)


def _batch(rows: list[dict], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[name] for r in rows], kind) for name, kind in kinds.items()], names=list(kinds))


def archived(pages: DataFrame, folder: str | None = None, payloads: bool = False) -> DataFrame:
    """Write the packages of all pages, then read them back."""
    return read_packages(write_packages(pages, folder or scratch(pages.sparkSession, "packages")), payloads)
