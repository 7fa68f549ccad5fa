"""Legacy ARC archives and their conversion to WARC."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatline.llm.common import attach, prepared, ship, slices
from beatline.runtime import scratch_path, store

#: Fixed values of the two formats: header fields of ARC record lines by version,
#: what ends a record in either kind of file, and the profile of a revisit.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL",
        "IP-address",
        "Archive-date",
        "Content-type",
        "Result-code",
        "Checksum",
        "Location",
        "Offset",
        "Filename",
        "Archive-length",
    ),
}
ARC_END, WARC_END = b"\n", b"\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: HTTP header that carries a page's identifier through ARC, and its WARC counterparts.
KEY_HEADER, WARC_KEY, WARC_REFERS_KEY = "X-Page-Id", "WARC-Source-Key", "WARC-Refers-To-Source-Key"

_VERSION_DATE = "20240101000000"


def digest32(data: bytes) -> str:
    """SHA-1 in upper-case base32, as WARC digests are written."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _field(value: str | None) -> str:
    """A value inside a space-separated header line."""
    return re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", value or "") or "-"


def arc_record(version: int, url: str, ip: str, date: str, mime: str, block: bytes, offset: int, name: str) -> bytes:
    own = {
        "URL": _field(url),
        "IP-address": ip,
        "Archive-date": date,
        "Content-type": mime,
        "Result-code": "200",
        "Checksum": hashlib.md5(block).hexdigest(),
        "Location": "-",
        "Offset": str(offset),
        "Filename": name,
        "Archive-length": str(len(block)),
    }
    return " ".join(own[f] for f in ARC_FIELDS[version]).encode() + b"\n" + block


def version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 beatline\n{' '.join(ARC_FIELDS[version])}\n".encode()
    url = f"filedesc://{name}"
    return arc_record(1 if version == 1 else 2, url, "0.0.0.0", _VERSION_DATE, "text/plain", body, 0, name)


def http_block(key: int | None, body: bytes) -> bytes:
    lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    if key is not None:
        lines.append(f"{KEY_HEADER}: {key}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body


def write_arc(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    body_col: str = "html",
    date: str = _VERSION_DATE,
    versions: tuple[int, ...] = (1, 2),
) -> None:
    """Write pages as gzipped ARC files, one per task, whose versions take turns.

    Spark's text writer commits the files; its record end is ARC's newline. Null
    bodies are empty, null addresses ``-``, and a null id leaves its header out.
    """
    own = prepared(pages, id=id_col, url=url_col, text=body_col)
    own = own.select(F.col("id").cast("long").alias("id"), F.col("url").cast("string").alias("url"), F.col("text").cast("binary").alias("text"))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        version, name, offset = versions[number % len(versions)], f"pages-{number:05d}.arc", 0
        for part in slices(batches):
            out = [] if offset else [version_block(version, name)]
            offset += sum(len(r) + len(ARC_END) for r in out)
            for key, url, body in zip(*[part.column(c) for c in ("id", "url", "text")], strict=True):
                block = http_block(key.as_py(), body.as_buffer().to_pybytes())
                out.append(arc_record(version, url.as_py(), "0.0.0.0", date, "text/html", block, offset, name))
                offset += len(out[-1]) + len(ARC_END)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    _write(own.mapInArrow(records, "value binary"), path, ARC_END)


def _write(records: DataFrame, path: str, end: bytes) -> None:
    text = records.select(F.col("value").cast("string").alias("value"))
    text.write.option("lineSep", end.decode()).option("compression", "gzip").text(path)


@dataclass(frozen=True)
class ArcRecord:
    """One record of an ARC file; header fields by their names in the version block."""

    file: str
    offset: int
    version: int
    header: dict[str, str]
    block: bytes


def parse_arc(stream: io.BufferedIOBase) -> Iterator[ArcRecord]:
    """The records of one uncompressed ARC stream, the version block first.

    The version block names the file and the version, which says how many
    fields each header line has; blocks are cut by their declared length alone,
    so their content may look like headers. A line with another number of
    fields, a short block or a missing record end raises ValueError.
    """
    version, name = 0, ""
    while line := stream.readline():
        start = stream.tell() - len(line)
        fields = line.decode("utf-8", "surrogateescape").rstrip("\n").split(" ")
        if not version:
            # The version block's own line has the fields of its version.
            kinds = [v for v, names in ARC_FIELDS.items() if len(names) == len(fields)]
            if not kinds or not fields[0].startswith("filedesc://"):
                raise ValueError(f"not an ARC file: {line[:80]!r}")
            names, name = ARC_FIELDS[kinds[0]], fields[0].removeprefix("filedesc://")
        if len(fields) != len(names):
            raise ValueError(f"{name}, offset {start}: {len(fields)} header fields, not {len(names)}")
        header = dict(zip(names, fields, strict=True))
        length = int(header["Archive-length"])
        block = stream.read(length)
        if len(block) != length or stream.read(1) != ARC_END:
            raise ValueError(f"{name}, offset {start}: the record does not end after {length} bytes")
        if not version:
            said = block.decode().split("\n")
            version = int(said[0].split(" ")[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"{name}: unknown version {said[0]!r}")
            names = tuple(said[1].split(" "))
        yield ArcRecord(name, start, version, header, block)


def split_http(block: bytes) -> tuple[bytes, dict[str, str], bytes] | None:
    """Header bytes with their end, header fields in lower case, and body; None if it is no response."""
    if not block.startswith(b"HTTP/"):
        return None
    head, end, body = block.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("latin-1").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields.setdefault(name.strip().lower(), value.strip())
    return head + end, fields, body


def warc_date(arc_date: str) -> str:
    """Fourteen digits to ISO 8601; shorter old dates are filled with their first moment."""
    full = arc_date + "00000101000000"[len(arc_date) :]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def record_id(file: str, offset: int, url: str, date: str) -> str:
    """The same identifier for the same ARC record on every run."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file} {offset} {date} {url}')}>"


def read_arc(spark: SparkSession, path: str, bodies: bool = True) -> DataFrame:
    """Records of ARC files as WARC would name them; without ``bodies`` only what deduplication needs.

    Columns: record_id, uri, date, kind (response, resource or warcinfo), mime,
    key, head and body (a response's HTTP header and payload; else body alone),
    payload_bytes, payload (SHA-256 of the body).
    """

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_buffer().to_pybytes()
                stream = gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
                rows, held = [], 0
                for r in parse_arc(stream):
                    rows.append(_as_row(r, bodies))
                    held += len(r.block)
                    if held > 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                yield _batch(rows)

    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(parsed, _RECORD)


_RECORD = "record_id string, uri string, date string, kind string, mime string, key long, head binary, body binary, payload_bytes long, payload binary"
_RECORD_TYPES = [pa.string()] * 5 + [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]


def _as_row(r: ArcRecord, bodies: bool) -> tuple:
    url, date = r.header["URL"], warc_date(r.header["Archive-date"])
    http = split_http(r.block) if r.offset else None
    kind = "warcinfo" if not r.offset else "response" if http else "resource"
    head, fields, body = http or (b"", {}, r.block)
    key = fields.get(KEY_HEADER.lower())
    return (
        record_id(r.file, r.offset, url, date),
        url,
        date,
        kind,
        r.header["Content-type"],
        int(key) if key else None,
        head if bodies else None,
        body if bodies else None,
        len(body),
        hashlib.sha256(body).digest(),
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.strip().split(" ")[0] for c in _RECORD.split(",")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _RECORD_TYPES, strict=True)], names)


def warc_record(fields: dict[str, str | None], block: bytes) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in fields.items() if v is not None], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogateescape") + b"\r\n\r\n" + block


def convert_arc(spark: SparkSession, arc_path: str, warc_path: str, *, min_revisit_bytes: int = 0) -> None:
    """Convert ARC files to gzipped WARC files.

    Identifiers come from a record's place in its archive, dates and types from
    its header line, block and payload digests from its bytes. Of responses with
    equal payloads of at least ``min_revisit_bytes`` the one with the smallest
    key is written out and the others as revisits that refer to it; a null key
    comes last, then the record's identifier decides. Version blocks become the
    warcinfo record of each new file.
    """
    order = F.struct(F.col("key").isNull().alias("none"), "key", "record_id", "uri", "date")
    narrow = store(
        read_arc(spark, arc_path, bodies=False)
        .where((F.col("kind") == "response") & (F.col("payload_bytes") >= min_revisit_bytes))
        .groupBy("payload")
        .agg(F.count("*").alias("n"), F.min(order).alias("first"))
        .where("n > 1"),
        "warc-first",
    )
    repeated = narrow.agg(F.sum("n")).first()[0] or 0
    rows = read_arc(spark, arc_path).where("kind <> 'warcinfo'")
    # Only payloads that repeat have a partner; hot ones are spread over tasks.
    rows = attach(rows, narrow, "payload", ["record_id"], repeated)
    is_first = F.col("first").isNull() | (F.col("kind") != "response") | (F.col("first.record_id") == F.col("record_id"))
    rows = rows.withColumn("first", F.when(~is_first, F.col("first"))).drop("n", "payload", "payload_bytes")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = False
        for part in slices(batches, "body"):
            out = [] if begun else [_warcinfo()]
            begun = True
            columns = [part.column(c).to_pylist() for c in ("record_id", "uri", "date", "kind", "mime", "key", "head", "body", "first")]
            for name, uri, date, kind, mime, key, head, body, first in zip(*columns, strict=True):
                fields = {"WARC-Type": "revisit" if first else kind, "WARC-Record-ID": name, "WARC-Target-URI": uri, "WARC-Date": date}
                fields[WARC_KEY] = None if key is None else str(key)
                if kind == "response":
                    fields |= {"Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": f"sha1:{digest32(body)}"}
                else:
                    fields["Content-Type"] = mime
                block = head if first else head + body
                if first:
                    fields |= {
                        "WARC-Profile": REVISIT,
                        "WARC-Refers-To": first["record_id"],
                        "WARC-Refers-To-Target-URI": first["uri"],
                        "WARC-Refers-To-Date": first["date"],
                        WARC_REFERS_KEY: None if first["key"] is None else str(first["key"]),
                    }
                fields["WARC-Block-Digest"] = f"sha1:{digest32(block)}"
                out.append(warc_record(fields, block))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    _write(rows.mapInArrow(written, "value binary"), warc_path, WARC_END)


def _warcinfo() -> bytes:
    number = TaskContext.get().partitionId()
    body = b"software: beatline\r\nformat: WARC File Format 1.1\r\n"
    fields = {
        "WARC-Type": "warcinfo",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'warcinfo {number}')}>",
        "WARC-Date": warc_date(_VERSION_DATE),
        "Content-Type": "application/warc-fields",
    }
    return warc_record(fields, body)


def parse_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields in lower case and block of each record; blocks are cut by their declared length."""
    while line := stream.readline():
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"not a WARC record: {line[:80]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            fields[name.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) != length or stream.read(4) != WARC_END:
            raise ValueError(f"{fields.get('warc-record-id')}: the record does not end after {length} bytes")
        yield fields, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files but warcinfo, digests verified.

    Columns: key, record_type, record_id, uri, date, payload_bytes and
    payload_digest of the full payload, refers_to (key of the record that holds
    a revisit's payload) and payload (null for revisits).
    """

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for fields, block in parse_warc(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer()))):
                    if fields["warc-type"] != "warcinfo":
                        rows.append(_read_row(fields, block))
                        held += len(block)
                        if held > 8 << 20:
                            yield _read_batch(rows)
                            rows, held = [], 0
                yield _read_batch(rows)

    ship(spark)
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parsed, _READ)


_READ = "key long, record_type string, record_id string, uri string, date string, payload_bytes long, payload_digest string, refers_to long, payload binary"
_READ_TYPES = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.int64(), pa.binary()]


def _read_row(fields: dict[str, str], block: bytes) -> tuple:
    if fields["warc-block-digest"] != f"sha1:{digest32(block)}":
        raise ValueError(f"{fields['warc-record-id']}: block digest differs")
    kind = fields["warc-type"]
    _, http, body = split_http(block) or (b"", {}, block)
    digest = digest32(body)
    size = len(body)
    if kind == "revisit":
        body, size, digest = None, int(http["content-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
    elif fields.get("warc-payload-digest", f"sha1:{digest}") != f"sha1:{digest}":
        raise ValueError(f"{fields['warc-record-id']}: payload digest differs")
    key, refers = fields.get(WARC_KEY.lower()), fields.get(WARC_REFERS_KEY.lower())
    return (
        int(key) if key else None,
        kind,
        fields["warc-record-id"],
        fields["warc-target-uri"],
        fields["warc-date"],
        size,
        digest,
        int(refers) if refers else None,
        body,
    )


def _read_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.strip().split(" ")[0] for c in _READ.split(",")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _READ_TYPES, strict=True)], names)


def through_archives(pages: DataFrame, *, min_revisit_bytes: int = 0, **columns) -> DataFrame:
    """Write pages as ARC, convert the archives to WARC and read those: the rows of ``read_warc``.

    Null bodies are empty payloads; a null id is no key, and no revisit can name
    it. Repeated ids are records of their own, told apart by their place. An
    empty table gives an empty result; other columns are not looked at.
    """
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, **columns)
    convert_arc(spark, arc, warc, min_revisit_bytes=min_revisit_bytes)
    return read_warc(spark, warc)
