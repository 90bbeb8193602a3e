"""Web archives: a legacy ARC writer, an ARC to WARC converter, and a WARC writer and reader.

Archives are written by Spark's text writer (its bytes are written as they are, and its line separator is what
ends the last record of a file), so they commit like any other Spark output, to any store that Spark can write.  A file
is one value of that writer, filled with records up to ``FILE_BYTES`` before compression, and is read back whole by
``binaryFile``.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import join_counted
from .store import broadcast_if_small, deleted, new_path, removed, written

FILE_BYTES = 16 << 20
#: Payloads of fewer bytes are never revisits.
MIN_REVISIT_BYTES = 0
#: Capture time of pages that carry none.
CAPTURED = "20240101000000"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122, URLs

# The fields of a URL record line in the two versions of the ARC format.
ARC_FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "result", "checksum", "location", "offset", "filename", "length"),
}


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- ARC ---------------------------------------------------------------------------------------------------------


def arc_heading(version: int, name: str) -> bytes:
    """The version block that opens an ARC file, without the line end behind it."""
    body = f"{version} 0 jobsieve\n{' '.join(_titles(version))}\n".encode()
    fields = {"url": f"filedesc://{name}", "ip": "0.0.0.0", "date": CAPTURED, "type": "text/plain", "length": str(len(body)), "result": "200", "checksum": "-", "location": "-", "offset": "0", "filename": name}
    return _line(version, fields) + body


def _titles(version: int) -> list[str]:
    # The names of the fields in the heading.
    names = {"url": "URL", "ip": "IP-address", "date": "Archive-date", "type": "Content-type", "result": "Result-code", "checksum": "Checksum", "location": "Location", "offset": "Offset", "filename": "Filename", "length": "Archive-length"}
    return [names[f] for f in ARC_FIELDS[version]]


def _line(version: int, fields: dict[str, str]) -> bytes:
    return (" ".join(fields[f] for f in ARC_FIELDS[version]) + "\n").encode()


def _uri(url: str | None) -> str:
    """A URL without white space or control characters, which would break a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "about:blank"


def arc_record(version: int, key: str, url: str | None, payload: bytes, date: str = CAPTURED) -> bytes:
    """One ARC record (without the newline behind it): the URL record line and the stored HTTP response."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Record-Key: " + key.encode() + b"\r\n\r\n" + payload
    fields = {"url": _uri(url), "ip": "0.0.0.0", "date": date, "type": "text/html", "result": "200", "checksum": "-", "location": "-", "offset": "0", "filename": "-", "length": str(len(block))}
    return _line(version, fields) + block


def arc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of every record of an ARC file, by the declared lengths.

    The version in the file's heading says how the lines that follow are to be read; a file without one is taken
    for version 1 if its lines have five fields, else 2.  URLs of old crawlers may hold blanks, so fields are
    counted from the right.  A length that isn't a number or exceeds the file raises ValueError.
    """
    at, version = 0, 0
    while at < len(data):
        if data[at : at + 1] in b"\r\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError("an ARC record line without an end")
        words = data[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        opening = words[0].startswith("filedesc://")
        kind = version or (1 if len(words) == 5 else 2)
        if opening:
            kind = 2 if len(words) >= len(ARC_FIELDS[2]) else 1
        names = ARC_FIELDS[kind]
        if len(words) < len(names) or not words[-1].isdigit():
            raise ValueError(f"not an ARC version {kind} record line: {words[:12]}")
        tail = len(names) - 1
        fields = dict(zip(names, [" ".join(words[:-tail]), *words[-tail:]]))
        start, size = end + 1, int(words[-1])
        if start + size > len(data):
            raise ValueError("an ARC record is shorter than it says")
        block = data[start : start + size]
        if opening:
            version = int(m[1]) if (m := re.match(rb"(\d)", block)) and int(m[1]) in ARC_FIELDS else kind
        yield fields, block
        at = start + size


# --- WARC --------------------------------------------------------------------------------------------------------


def iso_time(date: str) -> str:
    """A WARC-Date of an ARC date of 8 to 14 digits; 1970 if it is none."""
    digits = (re.sub(r"\D", "", date) + "0101000000"[max(0, len(date) - 4) :])[:14] if len(date) < 14 else date
    try:
        return datetime.strptime(digits[:14], "%Y%m%d%H%M%S").replace(tzinfo=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return "1970-01-01T00:00:00Z"


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, '|'.join(parts))}>"


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """The head of an HTTP response with its blank line, and the payload; all is payload if it has no head."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = block.find(b"\r\n\r\n")
    if end >= 0:
        return block[: end + 4], block[end + 4 :]
    end = block.find(b"\n\n")
    return (block[: end + 2], block[end + 2 :]) if end >= 0 else (block, b"")


def warc_record(kind: str, ident: str, url: str, date: str, digest: str, head: bytes, payload: bytes, extra: dict[str, str]) -> bytes:
    """One WARC/1.1 record, without the two line ends behind it; a revisit keeps the head alone."""
    block = head + (b"" if kind == "revisit" else payload)
    media = "application/http; msgtype=response" if head else "application/octet-stream"
    lines = {"WARC-Type": kind, "WARC-Record-ID": ident, "WARC-Date": date, "WARC-Target-URI": url, "WARC-Payload-Digest": f"sha1:{digest}", "WARC-Block-Digest": f"sha1:{sha1_base32(block)}", **extra, "Content-Type": media, "Content-Length": str(len(block))}
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines.items()) + "\r\n").encode() + block


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of every record of a WARC file, by Content-Length; ValueError if it's broken."""
    at = 0
    while at < len(data):
        if data[at : at + 1] in b"\r\n":
            at += 1
            continue
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError("not a WARC record")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in data[at:end].decode("utf-8", "replace").split("\r\n")[1:])}
        size = int(headers["content-length"])
        if end + 4 + size > len(data):
            raise ValueError("a WARC record is shorter than it says")
        yield headers, data[end + 4 : end + 4 + size]
        at = end + 4 + size


# --- Spark -------------------------------------------------------------------------------------------------------


def write_files(files: DataFrame, path: str, separator: str) -> None:
    """Writes each value of the one binary column ``file`` as a gzip-compressed archive file, separator behind it."""
    writer = files.select(F.col("file").cast("string").alias("value")).write.option("lineSep", separator).option("maxRecordsPerFile", 1)
    writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def _filled(records: Iterator[bytes], separator: bytes, file_bytes: int, opening: bytes = b"") -> Iterator[pa.RecordBatch]:
    """A batch for each file: records up to file_bytes, or one that is longer, behind the opening."""
    held, size = [], 0

    def file() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([separator.join(([opening] if opening else []) + held)], pa.binary())], ["file"])

    for record in records:
        if held and size + len(record) > file_bytes:
            yield file()
            held, size = [], 0
        held.append(record)
        size += len(record) + len(separator)
    if held:
        yield file()


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content), a row per file and few files in a partition."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files


def _unpacked(content: bytes) -> bytes:
    """The bytes of a file of one or many gzip members, or of a plain one."""
    if not content.startswith(b"\x1f\x8b"):
        return content
    out, rest = [], content
    while rest:
        member = zlib.decompressobj(31)
        out.append(member.decompress(rest) + member.flush())
        rest = member.unused_data.lstrip(b"\0")
    return b"".join(out)


def _in_parts(rows: Iterator[tuple], schema: pa.Schema, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + sum(len(x) for x in row if isinstance(x, bytes))
        if size > most or len(held) >= 5000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def pages_to_arc(pages: DataFrame, path: str, version: int = 1, file_bytes: int = FILE_BYTES) -> None:
    """Writes (page_id, url, html) rows as ARC files of the given version; a null html is an empty payload."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))

    def encode(batches):
        def records():
            for batch in batches:
                for key, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                    yield arc_record(version, "" if key is None else str(key), url, html.encode())

        yield from _filled(records(), b"\n", file_bytes, arc_heading(version, "pages.arc"))

    write_files(own.mapInArrow(encode, "file binary"), path, "\n")


def _captures(content: bytes) -> Iterator[tuple[int | None, str, str, bytes, bytes]]:
    """(key, url, date, head, payload) of the records of an ARC file, but for its heading."""
    for fields, block in arc_records(_unpacked(content)):
        if not fields["url"].startswith("filedesc://"):
            head, payload = split_http(block)
            key = m[1] if (m := re.search(rb"(?im)^X-Record-Key: *(-?\d+)\r?$", head)) else None
            yield int(key) if key else None, fields["url"], iso_time(fields["date"]), head, payload


def index_arc(spark: SparkSession, path: str) -> DataFrame:
    """(path, nth, key, url, date, payload_bytes, payload_digest): the records of ARC files, nth in their file, without
    their payloads."""
    schema = pa.schema([("path", pa.string()), ("nth", pa.int64()), ("key", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])

    def decode(batches):
        def rows():
            for batch in batches:
                for name, content in zip(*batch.columns):
                    for nth, (key, url, date, _, payload) in enumerate(_captures(content.as_py())):
                        yield name.as_py(), nth, key, url, date, len(payload), sha1_base32(payload)

        yield from _in_parts(rows(), schema)

    return read_files(spark, path).mapInArrow(decode, "path string, nth long, key long, url string, date string, payload_bytes long, payload_digest string")


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Converts ARC files to WARC files.

    Identifiers are UUIDs (version 5) of URL, time and key, so a second run gives the same ones.  Of the records of
    one payload (equal digest and length) of at least ``min_revisit_bytes``, that with the smallest key stays a
    response, the others become revisits of it.  Which they are is found on an index without payloads, where the few
    digests that very many records share are joined by broadcast; each file then gets the list of its revisits, so
    payloads are never dealt by digest.
    """
    index = written(index_arc(spark, arc_path), "arc-index")
    first = index.where(F.col("payload_bytes") >= min_revisit_bytes).groupBy("payload_digest", "payload_bytes").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "url", "date")).alias("first"), F.count("*").alias("n"))
    again = written(first.where("n > 1").select("payload_digest", "payload_bytes", "n", F.col("first.key").alias("first_key"), F.col("first.url").alias("first_url"), F.col("first.date").alias("first_date")), "arc-firsts")
    met = join_counted(index, again, ["payload_digest", "payload_bytes"], "n", index.count(), "inner").where(~F.col("first_key").eqNullSafe(F.col("key")))
    # a list has no more entries than its file has records
    lists = written(met.groupBy("path").agg(F.collect_list(F.struct("nth", "first_key", "first_url", "first_date")).alias("revisits"), F.count("*").alias("n")), "arc-revisits")
    size = lists.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def encode(batches):
        def records():
            for batch in batches:
                for content, revisits in zip(*batch.columns):
                    of = {r["nth"]: r for r in revisits.as_py() or ()}
                    for nth, (key, url, date, head, payload) in enumerate(_captures(content.as_py())):
                        extra = {} if key is None else {"X-Record-Key": str(key)}
                        kind, x = "response", of.get(nth)
                        if x:
                            kind = "revisit"
                            extra |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": record_id(x["first_url"], x["first_date"], str(x["first_key"])), "WARC-Refers-To-Target-URI": x["first_url"], "WARC-Refers-To-Date": x["first_date"], "X-Refers-To-Key": str(x["first_key"]), "X-Payload-Length": str(len(payload))}
                        yield warc_record(kind, record_id(url, date, str(key)), url, date, sha1_base32(payload), head, payload, extra)

        yield from _filled(records(), b"\r\n\r\n", file_bytes)

    files = read_files(spark, arc_path).join(broadcast_if_small(lists.select("path", "revisits"), size, 300), "path", "left").select("content", "revisits")
    write_files(files.mapInArrow(encode, "file binary"), warc_path, "\r\n\r\n")
    removed(spark, index, again, lists)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of WARC files: (record_id, record_type, key, url, date, payload_bytes, payload_digest, refers_to,
    refers_to_id, payload).  Digests of stored payloads are computed anew; one that differs from its header raises."""
    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("key", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("refers_to_id", pa.string()), ("payload", pa.binary())])

    def number(x: str | None) -> int | None:
        return int(x) if x and x != "None" else None

    def decode(batches):
        def rows():
            for batch in batches:
                for column in batch.column(1):
                    for h, block in warc_records(_unpacked(column.as_py())):
                        digest = h.get("warc-payload-digest", "").removeprefix("sha1:")
                        revisit = h["warc-type"] == "revisit"
                        payload = None if revisit else split_http(block)[1] if h.get("content-type", "").startswith("application/http") else block
                        if payload is not None and sha1_base32(payload) != digest:
                            raise ValueError(f"the payload of {h['warc-record-id']} isn't what its digest says")
                        yield (h["warc-record-id"], h["warc-type"], number(h.get("x-record-key")), h.get("warc-target-uri"), h.get("warc-date"), int(h["x-payload-length"]) if revisit else len(payload), digest, number(h.get("x-refers-to-key")), h.get("warc-refers-to"), payload)

        yield from _in_parts(rows(), schema)

    return read_files(spark, path).mapInArrow(decode, "record_id string, record_type string, key long, url string, date string, payload_bytes long, payload_digest string, refers_to long, refers_to_id string, payload binary")


def archive_pages(pages: DataFrame, arc_version: int = 1, min_revisit_bytes: int = MIN_REVISIT_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """pages as legacy ARC files, those converted to WARC files, and these read back (see ``read_warc``).

    A null html is an empty payload.  A null page_id stays null; such a page revisits any other of its payload that
    has an id, and is a response if none has.  Rows that repeat an id are records of their own, and those that repeat
    the id of a response are responses.  A null URL becomes about:blank, other columns are ignored, and an empty table
    gives no rows.
    """
    spark = pages.sparkSession
    arc, warc = new_path(spark, "arc"), new_path(spark, "warc")
    pages_to_arc(pages, arc, arc_version, file_bytes)
    convert(spark, arc, warc, min_revisit_bytes, file_bytes)
    deleted(spark, arc)
    return read_warc(spark, warc)
