"""ARC archives and their conversion."""

import base64
import gzip
import hashlib
import io
from collections import Counter
from pathlib import Path

import pytest

from beatline.llm import warc
from beatline.runtime import scratch_path

PAGES = "page_id long, url string, html string, key binary, kind string, first int, n long"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, b"k", "clash", 1, 1) for i, u, h in rows], PAGES).repartition(3)


ROWS = [
    (1, "http://a.example/ x\ty", "<html>one</html>"),
    (2, None, "<html>one</html>"),
    (3, "https://a.example/", None),
    (4, "https://a.example/", ""),
    (5, "http://é.example/", "WARC/1.1\r\nContent-Length: 9999\r\n\r\n\n1 2 3\n" * 3),
    (6, "http://b.example/", "x" * 300_000 + "é\u0000\r\n\r\n"),
    (None, "http://b.example/", "<html>one</html>"),
    (7, "http://b.example/", "only here"),
    (7, "http://b.example/", "only here"),
    *[(100 + i, f"http://c.example/{i}", "hot page") for i in range(30)],
]


def digest(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


@pytest.mark.parametrize("least", [0, 10])
def test_through_archives(spark, least):
    got = warc.through_archives(pages(spark, ROWS), min_revisit_bytes=least).collect()
    first = {}
    for i, _, h in ROWS:
        if i is not None and len((h or "").encode()) >= least:
            first[h or ""] = min(i, first.get(h or "", i))
    want, left = Counter(), Counter(first.values())
    for i, _, h in ROWS:
        lead = first.get(h or "")
        opens = lead is None or i == lead and left[i] > 0
        left[i] -= opens and lead is not None
        want[i, len((h or "").encode()), digest(h), "response" if opens else "revisit", None if opens else lead] += 1
    assert Counter((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    by_type = {r.record_type for r in got if r.payload is None}
    assert by_type <= {"revisit"}


def test_files_are_archives(spark):
    arc, out = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    warc.write_arc(pages(spark, ROWS), arc)
    versions = Counter()
    for f in Path(arc).glob("part-*"):
        records = list(warc.parse_arc(gzip.open(f)))
        assert records[0].header["URL"].startswith("filedesc://")
        versions[records[0].version] += 1
        for r in records:
            assert len(r.header) == len(warc.ARC_FIELDS[r.version])
    assert set(versions) == {1, 2}
    warc.convert_arc(spark, arc, out)
    ids = Counter()
    for f in Path(out).glob("part-*"):
        for n, (fields, block) in enumerate(warc.parse_warc(gzip.open(f))):
            assert (fields["warc-type"] == "warcinfo") == (n == 0)
            assert fields["warc-block-digest" if n else "warc-type"] in (f"sha1:{warc.digest32(block)}", "warcinfo")
            assert fields["warc-date"] == "2024-01-01T00:00:00Z"
            ids[fields["warc-record-id"]] += n > 0
    assert sum(ids.values()) == len(ROWS) and set(ids.values()) <= {0, 1}
    again = scratch_path(spark, "warc")
    warc.convert_arc(spark, arc, again)
    assert Counter(map(tuple, warc.read_warc(spark, out).collect())) == Counter(map(tuple, warc.read_warc(spark, again).collect()))


def archive(version, *records):
    head = warc.version_block(version, "old.arc") + b"\n"
    return head + b"".join(r + b"\n" for r in records)


def test_versions_have_their_own_header_lines():
    one = archive(1, b"http://x/ 1.2.3.4 19970314 text/html 5\nhe\nlo", b"dns:x 1.2.3.4 19970314101112 text/dns 0\n")
    got = list(warc.parse_arc(io.BytesIO(one)))
    assert [r.block for r in got[1:]] == [b"he\nlo", b""]
    assert got[1].header["IP-address"] == "1.2.3.4" and "Result-code" not in got[1].header
    two = archive(2, b"http://x/ 1.2.3.4 19970314101112 text/html 404 abc - 99 old.arc 3\nxyz")
    assert list(warc.parse_arc(io.BytesIO(two)))[1].header["Result-code"] == "404"
    assert warc.warc_date("19970314") == "1997-03-14T00:00:00Z"
    assert warc.warc_date("19970314101112") == "1997-03-14T10:11:12Z"


@pytest.mark.parametrize(
    "data,message",
    [
        (b"http://x/ 1.2.3.4 19970314 text/html 5\nhello\n", "not an ARC file"),
        (archive(1, b"http://x/ 1.2.3.4 text/html 5\nhello"), "header fields"),
        (archive(1, b"http://x/ 1.2.3.4 19970314 text/html 9\nhello"), "does not end after 9 bytes"),
        (archive(2, b"http://x/ 1.2.3.4 19970314 text/html 5\nhello"), "header fields"),
    ],
)
def test_broken_archives_fail(data, message):
    with pytest.raises(ValueError, match=message):
        list(warc.parse_arc(io.BytesIO(data)))


def test_other_records(spark):
    path = scratch_path(spark, "arc")
    data = archive(1, b"dns:x 1.2.3.4 19970314101112 text/dns 3\nabc", b"http://x/ 1.2.3.4 19970314101112 text/html 3\nabc")
    spark.createDataFrame([(data.decode(),)], "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(path)
    # What follows the last record here is the writer's line end.
    rows = spark.read.format("binaryFile").load(path).select("content").first()
    assert bytes(rows.content).startswith(data)
    whole = scratch_path(spark, "arc")
    spark.createDataFrame([(data[:-1].decode(),)], "value string").coalesce(1).write.text(whole)
    got = {r.uri: (r.kind, r.mime) for r in warc.read_arc(spark, whole).collect()}
    assert got["dns:x"] == ("resource", "text/dns") and got["http://x/"] == ("resource", "text/html")


def test_empty_table(spark):
    assert warc.through_archives(pages(spark, [])).count() == 0
