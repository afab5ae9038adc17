"""Converts legacy ARC archives to WARC, and reads and writes both.

An ARC file begins with a version block, whose own lines name the version and the fields of
the header line that precedes each document; a document is as long as its header declares.
Each becomes a WARC record with a synthesised identifier, timestamp, type and digests. Records
whose payload another record holds already are written as revisits of it.

Archives are written by Spark's text writer, a record at a time, as gzip files, and read as
binary files, so they can lie in any store that Spark reaches. A file is as large as what one
task writes, and is parsed as a stream, record by record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revmill.llm.common import if_small, ship
from revmill.session import cut_lineage, scratch

# The header fields of the two ARC versions, as archives state them.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
# Fixed value: the profile of revisits with an identical payload.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_HEADER = "X-Row-Id"
# Bytes of records that a Python task hands over at a time.
BATCH_BYTES = 8 * 1024 * 1024
# Records between version blocks when archives are made.
ARC_RECORDS = 1_000


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _batches(rows: Iterator[dict], schema: pa.Schema, size_of) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + size_of(row)
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _http(status: str, headers: list[tuple[str, str]]) -> bytes:
    return "\r\n".join([f"HTTP/1.1 {status}", *(f"{k}: {v}" for k, v in headers), "", ""]).encode()


def _header(lines: list[bytes], name: str) -> str | None:
    start = name.lower().encode() + b":"
    return next((x[len(start) :].strip().decode("utf-8", "replace") for x in lines if x.lower().startswith(start)), None)


def _row_id(head: bytes) -> str | None:
    value = _header(head.split(b"\r\n"), ID_HEADER)
    return None if value is None else unquote(value)


# ---------------------------------------------------------------- ARC


def arc_version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 revmill\n{ARC_FIELDS[version]}\n".encode()
    return arc_record(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", body)


def arc_record(version: int, url: str, ip: str, date: str, mime: str, body: bytes) -> bytes:
    """The header line of a version and the document, without the line feed behind it."""
    url = re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}" if ord(m[0]) < 256 else "%20", url) or "about:blank"
    middle = f" 200 {base32_sha1(body)} - 0 -" if version == 2 else ""
    return f"{url} {ip} {date} {mime}{middle} {len(body)}\n".encode() + body


def write_arc(pages: DataFrame, path: str, date: str = "20000101000000", ip: str = "0.0.0.0") -> None:
    """Writes pages (page_id, url, html) as ARC files, versions 1 and 2 by turns. The id goes
    into a response header; a null id has none, a null html is empty, a null url is blank."""
    ship(pages.sparkSession)

    def rows(batches):
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, urls, bodies = (batch.column(i) for i in range(3))
            for i in range(batch.num_rows):
                version = 1 + number // ARC_RECORDS % 2
                if number % ARC_RECORDS == 0:
                    name = f"{part:06d}-{number // ARC_RECORDS:06d}.arc"
                    yield {"record": arc_version_block(version, name, date)}
                body = bodies[i].as_py() or b""
                headers = [("Content-Type", "text/html; charset=UTF-8"), ("Content-Length", str(len(body)))]
                if ids[i].as_py() is not None:
                    headers.append((ID_HEADER, quote(ids[i].as_py())))
                page = _http("200 OK", headers) + body
                yield {"record": arc_record(version, urls[i].as_py() or "", ip, date, "text/html", page)}
                number += 1

    schema = pa.schema([("record", pa.binary())])
    source = pages.select(F.col("page_id").cast("string"), F.col("url"), F.col("html").cast("binary"))
    made = source.mapInArrow(lambda b: _batches(rows(b), schema, lambda r: len(r["record"])), "record binary")
    _write_records(made, path)


def _write_records(records: DataFrame, path: str) -> None:
    """Each record's bytes and a line feed. The text writer passes bytes on as they are."""
    lines = records.select(F.col("record").cast("string").alias("value"))
    lines.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def _read_exactly(stream: io.BufferedIOBase, n: int) -> bytes:
    data = stream.read(n)
    if len(data) != n:
        raise ValueError("the archive ends inside a record")
    return data


def parse_arc(stream: io.BufferedIOBase) -> Iterator[dict]:
    """The documents of an ARC stream: version, fields by name, body, and its place. Header
    lines are split from the right by the fields that the version block names, as a URL may
    hold blanks."""
    fields: list[str] = []
    version, name, place = 0, "", 0
    while line := stream.readline():
        if not line.strip():
            continue
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text.startswith("filedesc://"):
            body = _read_exactly(stream, int(text.rsplit(" ", 1)[1]))
            lines = body.decode("utf-8", "replace").splitlines()
            version, name, fields = int(lines[0].split()[0]), text.split(" ")[0][len("filedesc://") :], lines[1].split()
            if version not in ARC_FIELDS or not fields:
                raise ValueError(f"unknown ARC version block: {lines[:2]}")
            place = 0
            about = {"URL": text.split(" ")[0], "Archive-date": text.split(" ")[2], "Content-type": "text/plain"}
            yield about | {"version": version, "archive": name, "place": 0, "body": body, "about": True}
            continue
        if not fields:
            raise ValueError("a document comes before the version block")
        values = text.rsplit(" ", len(fields) - 1)
        if len(values) != len(fields):
            raise ValueError(f"an ARC header line of version {version} has {len(values)} fields")
        place += 1
        record = dict(zip(fields, values))
        body = _read_exactly(stream, int(record["Archive-length"]))
        yield record | {"version": version, "archive": name, "place": place, "body": body, "about": False}


# ---------------------------------------------------------------- ARC to WARC


def converted(document: dict) -> dict:
    """The WARC headers that a document of an ARC file stands for, its HTTP head and payload.

    Identifiers follow the archive's name and the document's place, so that a repeated task
    makes the same ones. The version block becomes a warcinfo record, an HTTP exchange a
    response, any other document a resource.
    """
    body, url = document["body"], document["URL"]
    date = document["Archive-date"].ljust(14, "0")
    stamp = f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"
    own = uuid.uuid5(uuid.NAMESPACE_URL, f"{document['archive']}#{document['place']}")
    row = {
        "record_id": f"<urn:uuid:{own}>",
        "uri": url,
        "date": stamp,
        "ip": document.get("IP-address"),
        "mime": document.get("Content-type"),
        "row_id": None,
        "head": b"",
        "payload": body,
    }
    if document["about"]:
        row["type"] = "warcinfo"
    elif body.startswith(b"HTTP/"):
        row["type"], row["mime"] = "response", "application/http; msgtype=response"
        end = body.find(b"\r\n\r\n")
        end = len(body) if end < 0 else end + 4
        row["head"], row["payload"] = body[:end], body[end:]
        row["row_id"] = _row_id(row["head"])
    else:
        row["type"] = "resource"
    row["payload_digest"] = base32_sha1(row["payload"])
    row["payload_bytes"] = len(row["payload"])
    return row


_CONVERTED = (
    "type string, record_id string, uri string, date string, ip string, mime string, row_id string, "
    "payload_digest string, payload_bytes long, head binary, payload binary"
)
_CONVERTED_ARROW = pa.schema(
    [(n, pa.string()) for n in ("type", "record_id", "uri", "date", "ip", "mime", "row_id", "payload_digest")]
    + [("payload_bytes", pa.int64()), ("head", pa.binary()), ("payload", pa.binary())]
)


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[io.BufferedIOBase]:
    for batch in batches:
        for i in range(batch.num_rows):
            content = batch.column("content")[i].as_buffer()
            raw = io.BytesIO(content.to_pybytes())
            head = raw.read(2)
            raw.seek(0)
            yield gzip.GzipFile(fileobj=raw) if head == b"\x1f\x8b" else raw


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def convert_arc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The WARC records that the ARC files of a folder stand for."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for stream in _streams(batches):
                for document in parse_arc(stream):
                    row = converted(document)
                    yield row if with_payload else row | {"head": b"", "payload": b""}

        return _batches(rows(), _CONVERTED_ARROW, lambda r: len(r["payload"]) + len(r["head"]))

    return _files(spark, path).mapInArrow(run, _CONVERTED)


# ---------------------------------------------------------------- WARC


def warc_record(row: dict) -> bytes:
    """A record without the last line feed, which the writer adds. A revisit has the HTTP
    head alone."""
    revisit = row.get("refers_to_id") is not None
    block = row["head"] if revisit else row["head"] + row["payload"]
    headers = [
        ("WARC-Type", "revisit" if revisit else row["type"]),
        ("WARC-Record-ID", row["record_id"]),
        ("WARC-Date", row["date"]),
        ("WARC-Target-URI" if row["type"] != "warcinfo" else "WARC-Filename", row["uri"].removeprefix("filedesc://")),
        ("WARC-IP-Address", None if row["type"] == "warcinfo" else row["ip"]),
        ("WARC-Payload-Digest", None if row["type"] == "warcinfo" else f"sha1:{row['payload_digest']}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("WARC-Refers-To", row.get("refers_to_id")),
        ("WARC-Refers-To-Target-URI", row.get("refers_to_uri")),
        ("WARC-Refers-To-Date", row.get("refers_to_date")),
        ("Content-Type", row["mime"]),
        ("Content-Length", str(len(block))),
    ]
    head = "\r\n".join(["WARC/1.1", *(f"{k}: {v}" for k, v in headers if v is not None), "", ""])
    return head.encode() + block + b"\r\n\r"


def revisits(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """record_id, refers_to_id, refers_to_uri, refers_to_date of the records whose payload, of
    least_bytes or more, the record with the largest row id holds too (numbers by size, other
    ids as text, none last)."""
    order = F.struct(F.col("row_id").try_cast("decimal(38,0)").alias("n"), F.col("row_id").alias("t"), F.col("record_id").alias("i"))
    alike = records.filter((F.col("type") != "warcinfo") & (F.col("payload_bytes") >= least_bytes))
    alike = alike.select("payload_digest", "payload_bytes", "record_id", "uri", "date", order.alias("o"))
    firsts = alike.groupBy("payload_digest", "payload_bytes").agg(
        F.count("*").alias("n"), F.max("o").alias("m"), F.max_by(F.struct("record_id", "uri", "date"), "o").alias("r")
    )
    firsts = cut_lineage(firsts.filter("n > 1"))
    firsts = if_small(firsts, firsts.count(), 300)
    joined = alike.join(firsts, ["payload_digest", "payload_bytes"]).filter(F.col("record_id") != F.col("r.record_id"))
    return joined.select(
        "record_id", F.col("r.record_id").alias("refers_to_id"), F.col("r.uri").alias("refers_to_uri"), F.col("r.date").alias("refers_to_date")
    )


def write_warc(records: DataFrame, again: DataFrame, path: str) -> None:
    """Writes converted records, those in `again` (see revisits) as revisits."""
    ship(records.sparkSession)
    again = cut_lineage(again)
    again = if_small(again, again.count(), 300)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ({"record": warc_record(r)} for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist())
        return _batches(rows, pa.schema([("record", pa.binary())]), lambda r: len(r["record"]))

    _write_records(records.join(again, "record_id", "left").mapInArrow(run, "record binary"), path)


def parse_warc(stream: io.BufferedIOBase) -> Iterator[tuple[list[bytes], bytes]]:
    """Header lines and block of each record of a WARC stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        lines = []
        while (line := stream.readline()).strip():
            lines.append(line.rstrip(b"\r\n"))
        yield lines, _read_exactly(stream, int(_header(lines, "Content-Length") or 0))


_READ = "type string, record_id string, uri string, date string, row_id string, payload_digest string, payload_bytes long, refers_to_id string"


def read_warc(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Records of the WARC files of a folder. Digest and size are those of the whole payload:
    of what was read, or for a revisit what its headers say. A payload that differs from its
    digest raises."""
    ship(spark)
    names = [p.split()[0] for p in _READ.split(", ")]
    schema = pa.schema([(n, pa.int64() if n == "payload_bytes" else pa.string()) for n in names] + ([("payload", pa.binary())] if with_payload else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for stream in _streams(batches):
                for lines, block in parse_warc(stream):
                    kind = _header(lines, "WARC-Type")
                    http = kind in ("response", "revisit") and block.startswith(b"HTTP/")
                    end = block.find(b"\r\n\r\n") + 4 if http else 0
                    head, payload = block[:end], block[end:]
                    digest = (_header(lines, "WARC-Payload-Digest") or "").removeprefix("sha1:") or None
                    size = int(_header(head.split(b"\r\n"), "Content-Length") or 0) if kind == "revisit" else len(payload)
                    if kind != "revisit" and digest and digest != base32_sha1(payload):
                        raise ValueError(f"the payload of {_header(lines, 'WARC-Record-ID')} differs from its digest")
                    row = {
                        "type": kind,
                        "record_id": _header(lines, "WARC-Record-ID"),
                        "uri": _header(lines, "WARC-Target-URI"),
                        "date": _header(lines, "WARC-Date"),
                        "row_id": _row_id(head) if http else None,
                        "payload_digest": digest,
                        "payload_bytes": size,
                        "refers_to_id": _header(lines, "WARC-Refers-To"),
                    }
                    yield row | ({"payload": payload} if with_payload else {})

        return _batches(rows(), schema, lambda r: len(r.get("payload") or b""))

    return _files(spark, path).mapInArrow(run, _READ + (", payload binary" if with_payload else ""))


def archive_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every row of pages,
    as read back from the WARC archives that its ARC archives are converted to.

    Of pages with equal html (null: empty) the one with the largest page_id is the response,
    one of them if that id repeats; pages without an id come last. Other columns are left out.
    """
    spark = pages.sparkSession
    old, new = scratch(spark, "arc"), scratch(spark, "warc")
    write_arc(pages, old)
    plain = cut_lineage(convert_arc(spark, old, with_payload=False).drop("head", "payload"))
    write_warc(convert_arc(spark, old), revisits(plain, least_bytes), new)
    read = cut_lineage(read_warc(spark, new).filter("type <> 'warcinfo'"))
    id_type = pages.schema["page_id"].dataType
    targets = read.filter("type = 'response'").select(F.col("record_id").alias("__to"), F.col("row_id").alias("__row"))
    joined = read.join(targets, F.col("refers_to_id") == F.col("__to"), "left")
    return joined.select(
        F.col("row_id").cast(id_type).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("__row").cast(id_type).alias("refers_to"),
    )
