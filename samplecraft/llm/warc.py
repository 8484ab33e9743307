"""Legacy archive converter: ARC archives in, WARC archives with equivalent records out.

An ARC archive starts with a version block, whose header line names the archive; version 1 and version 2 blocks list
different fields for the header lines of records:

    1: URL IP-address Archive-date Content-type Archive-length
    2: URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length

A record is its header line and as many bytes as the last field declares; a line end separates records. Each becomes a
WARC/1.1 record: the type from the content, an identifier made from key, address, date and content (so that
conversion run twice gives the same), the date in ISO form, and SHA-256 digests of block and payload.

Of records with equal payloads of ``REVISIT_BYTES`` or more the one with the smallest key is a ``response``, others
become ``revisit`` records that refer to it and keep only the HTTP header. Digests are grouped with sums combined
before the shuffle and joined back; a very common payload is a skewed join, which adaptive execution splits.

Archives are binary rows of about ``ARCHIVE_BYTES``, written as a table in the shared folder by Spark's writers.

Edge cases: a null or empty page is a response of 0 bytes; null addresses are written as ``-``; white space and control
characters in addresses are percent-encoded; records of equal key and payload are all responses if that key is the
smallest; null keys are the largest, and a revisit of a record without key refers to null; an empty table gives no
archives; extra columns play no part.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplecraft.llm.common import materialise, slices

REVISIT_BYTES = 100
ARCHIVE_BYTES = 4 << 20
ARCHIVED = "20240101000000"
KEY_FIELD = "X-Record-Key"

#: Field names of the two versions of the archive format.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = "key long, url string, date string, mime string, record_id string, digest string, length long, head binary, payload binary"


def _address(url: str | None) -> str:
    return re.sub(r"[\s\x00-\x1f\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url, flags=re.ASCII) if url else "-"


def arc_version_block(name: str, version: int) -> bytes:
    body = f"{version} 0 samplecraft\n{FIELDS[version]}\n".encode()
    middle = "text/plain" if version == 1 else f"text/plain 200 - - 0 {name}"
    return f"filedesc://{name} 0.0.0.0 {ARCHIVED} {middle} {len(body)}\n".encode() + body + b"\n"


def arc_record(version: int, url: str, block: bytes, offset: int, name: str) -> bytes:
    middle = "text/html" if version == 1 else f"text/html 200 - - {offset} {name}"
    return f"{url} 0.0.0.0 {ARCHIVED} {middle} {len(block)}\n".encode() + block + b"\n"


def http_block(key: int | None, payload: bytes) -> bytes:
    field = "" if key is None else f"{KEY_FIELD}: {key}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{field}Content-Length: {len(payload)}\r\n\r\n".encode() + payload


def to_arc(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages as ARC archives (column ``data``), of version 1 and 2 in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, count = [], 0, 0
        for batch in slices(batches, "html"):
            for k, address, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                version, name = 1 + count % 2, f"pages-{count:05d}.arc"
                if not parts:
                    parts = [arc_version_block(name, version)]
                    size = len(parts[0])
                parts.append(arc_record(version, _address(address), http_block(k, (page or "").encode()), size, name))
                size += len(parts[-1])
                if size >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], names=["data"])
                    parts, count = [], count + 1
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], names=["data"])

    narrow = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    return narrow.mapInArrow(run, "data binary")


def parse_arc(data: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """(header fields, content) of each record after the version block."""
    view, at, names = memoryview(data), 0, None
    while at < len(data):
        if data[at] == 10:  # the line end between records
            at += 1
            continue
        end = data.index(b"\n", at)
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        length = int(line.rsplit(" ", 1)[1])
        content = view[end + 1 : end + 1 + length]
        if len(content) < length:
            raise ValueError(f"record at {at} declares {length} bytes, {len(content)} are left")
        at = end + 1 + length
        if names is None:
            if not line.startswith("filedesc://"):
                raise ValueError("an archive begins with a version block")
            lines = bytes(content).decode().split("\n")
            version = int(lines[0].split(" ", 1)[0])
            names = (lines[1] if lines[1:] and lines[1] else FIELDS[version]).split(" ")
        else:
            yield dict(zip(names, line.rsplit(" ", len(names) - 1), strict=True)), content


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """(header with its empty line, payload); a block that is no HTTP message is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    head, mark, payload = block.partition(b"\r\n\r\n")
    return head + mark, payload


def http_field(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode().strip() if found else None


def records(archives: DataFrame) -> DataFrame:
    """The records of ARC archives (column ``data``), as ``RECORDS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORDS.split(", ")]
        types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for fields, content in parse_arc(data.as_py()):
                    head, payload = split_http(bytes(content))
                    key, digest = http_field(head, KEY_FIELD), hashlib.sha256(payload).hexdigest()
                    date = fields["Archive-date"]
                    identity = uuid.uuid5(uuid.NAMESPACE_URL, f"{key} {fields['URL']} {date} {digest}")
                    rows.append((int(key) if key else None, fields["URL"], date, fields["Content-type"], f"<urn:uuid:{identity}>", digest, len(payload), head, payload))
                for k in range(0, len(rows), 512):
                    columns = zip(*rows[k : k + 512], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return archives.mapInArrow(run, RECORDS)


def with_targets(found: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``found`` with the record that each refers to (``to_key, to_id, to_url, to_date``; null: it is a response)."""
    first = F.min(F.struct(F.col("key").isNull().alias("none"), F.col("key"), F.col("record_id"), F.col("url"), F.col("date")))
    chosen = found.where(F.col("length") >= least).groupBy("digest").agg(F.count("*").alias("copies"), first.alias("r")).where("copies > 1")
    chosen = chosen.select(F.col("digest").alias("d"), F.col("r.key").alias("to_key"), F.col("r.record_id").alias("to_id"), F.col("r.url").alias("to_url"), F.col("r.date").alias("to_date"))
    joined = found.join(chosen, F.col("digest") == F.col("d"), "left").drop("d")
    own = F.col("to_id").isNull() | F.col("key").eqNullSafe(F.col("to_key"))
    return joined.withColumns({c: F.when(~own, F.col(c)) for c in ("to_key", "to_url", "to_date")} | {"to_id": F.when(~own, F.col("to_id"))})


def _iso(date: str) -> str:
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def _converted(r: dict) -> bytes:
    payload_digest = f"sha256:{r['digest']}"
    fields = [("WARC-Record-ID", r["record_id"]), ("WARC-Target-URI", r["url"]), ("WARC-Date", _iso(r["date"])), ("WARC-Payload-Digest", payload_digest)]
    http = bool(r["head"])
    if r["to_id"] is not None:
        refers = [("WARC-Type", "revisit"), ("WARC-Profile", PROFILE), ("WARC-Refers-To", r["to_id"]), ("WARC-Refers-To-Target-URI", r["to_url"]), ("WARC-Refers-To-Date", _iso(r["to_date"]))]
        if r["to_key"] is not None:
            refers.append((f"WARC-Refers-To-{KEY_FIELD}", str(r["to_key"])))
        fields, block = fields + refers, r["head"]
    else:
        fields, block = [*fields, ("WARC-Type", "response" if http else "resource")], r["head"] + r["payload"]
    fields += [("Content-Type", "application/http; msgtype=response" if http else r["mime"]), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}")]
    return warc_record(fields, block)


def to_warc(found: DataFrame) -> DataFrame:
    """WARC archives (column ``data``) of records with their targets; each begins with a warcinfo record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in slices(batches, "payload"):
            for r in batch.to_pylist():
                if not parts:
                    block = b"software: samplecraft\r\nformat: WARC File Format 1.1\r\n"
                    identity = uuid.uuid5(uuid.NAMESPACE_URL, r["record_id"])
                    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{identity}>"), ("WARC-Date", _iso(r["date"])), ("Content-Type", "application/warc-fields")]
                    parts = [warc_record(fields, block)]
                    size = len(parts[0])
                parts.append(_converted(r))
                size += len(parts[-1])
                if size >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], names=["data"])
                    parts = []
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], names=["data"])

    return found.mapInArrow(run, "data binary")


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record."""
    at = 0
    while at < len(data):
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at {at}")
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")[1:]
        fields = dict(x.split(": ", 1) for x in lines)
        length = int(fields["Content-Length"])
        block = data[end + 4 : end + 4 + length]
        if data[end + 4 + length : end + 8 + length] != b"\r\n\r\n":
            raise ValueError(f"record at {at} does not end where it declares")
        at = end + 8 + length
        yield fields, block


def read_warc(archives: DataFrame, key: str = "page_id") -> DataFrame:
    """A row a response, resource or revisit record; digests are compared with the contents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [key, "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "target_uri"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for fields, block in parse_warc(data.as_py()):
                    kind = fields["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    if fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
                        raise ValueError(f"block digest of {fields['WARC-Record-ID']}")
                    head, payload = split_http(block)
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    if kind != "revisit" and digest != hashlib.sha256(payload).hexdigest():
                        raise ValueError(f"payload digest of {fields['WARC-Record-ID']}")
                    own, to = http_field(head, KEY_FIELD), fields.get(f"WARC-Refers-To-{KEY_FIELD}")
                    length = int(http_field(head, "Content-Length") or 0) if kind == "revisit" else len(payload)
                    rows.append((int(own) if own else None, length, digest, kind, int(to) if to else None, fields["WARC-Record-ID"], fields["WARC-Target-URI"]))
                columns = list(zip(*rows, strict=True)) or [[]] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return archives.mapInArrow(run, f"`{key}` long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, target_uri string")


def convert(archives: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """ARC archives to WARC archives, written in the shared folder."""
    return materialise(to_warc(with_targets(records(archives), least)))
