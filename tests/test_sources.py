import datetime as dt
import gzip
import json
import os
import tempfile
from unittest import mock

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from beatline.schemas import MESSAGES, RECORD_HEADER
from beatline.sinks.signal_table import time_chunk
from beatline.sources import line_ranges, messages, metadata, signal_files


def wire(spark, *lines):
    return spark.createDataFrame([(None if m is None else bytearray(m.encode()),) for m in lines], MESSAGES)


def test_messages_are_worked_out_once(spark):
    """However often the parsed columns are used, a message is split once and its time matched once."""
    parsed = messages.parse_sample(wire(spark, "a,10:00:00.000,1.5"))
    timed = messages.event_time(parsed, "2024-01-01").where("value > 0 and ts > '2020-01-01'")
    plan = timed.select("ts", "value", F.col("value") * 2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and plan.count("RLIKE") == 1 and plan.count("try_cast(trim(") == 1
    judged = messages.judge_messages(wire(spark, "a,10:00:00.000,1.5"), "2024-01-01", keep=())
    plan = judged.where("reason is null")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and plan.count("RLIKE") == 1


def test_signal_file(spark, tmp_path):
    (tmp_path / "100_signals.txt").write_text("".join(f"{i / 8:.32f}\n" for i in range(20)))
    (tmp_path / "10+1 b_signals.txt").write_text("1.5\nbad\n\n2.5")
    rows = signal_files.scan_signal_files(spark, str(tmp_path), keep_text=True).orderBy("record", "idx").collect()
    assert [(r.idx, r.value) for r in rows if r.record == "100"] == [(i, i / 8) for i in range(20)]
    assert [(r.idx, r.value, r.text) for r in rows if r.record == "10+1 b"] == [
        (0, 1.5, "1.5"), (1, None, "bad"), (2, None, ""), (3, 2.5, "2.5")
    ]


def test_undecodable_line_is_not_counted(spark, tmp_path):
    (tmp_path / "7_signals.txt").write_bytes(b"1.0\n\xff\xfe\n2.0\n")
    rows = signal_files.scan_signal_files(spark, str(tmp_path)).orderBy("idx").collect()
    assert [(r.idx, r.value) for r in rows] == [(0, 1.0), (1, 2.0)]


def test_one_file_read_in_many_splits(spark, tmp_path):
    (tmp_path / "1_signals.txt").write_text("".join(f"{i}.0\n" for i in range(30_000)))
    (tmp_path / "2_signals.txt").write_text("5.0\n6.0\n")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = signal_files.scan_signal_files(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
        assert df.count() == 30_002
        assert df.where("record = '1' and value != idx").count() == 0
        assert df.where("record = '1'").select("idx").distinct().count() == 30_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_lines_are_not_shuffled(spark, tmp_path):
    (tmp_path / "1_signals.txt").write_text("1.0\n2.0\n")
    plan = signal_files.scan_signal_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Sort" not in plan and "Join" not in plan
    # What is shuffled is the list of ranges; lines only come into being above it.
    assert plan.index("MapInArrow") < plan.index("Exchange")
    shuffled = plan[plan.index("Exchange"):]
    assert "text#" not in shuffled and "begin#" in shuffled


@pytest.fixture
def narrow_splits(spark):
    """Settings under which Spark cuts files another way than by default."""
    was = {k: spark.conf.get(k) for k in ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")}

    def cut():
        spark.conf.set("spark.sql.files.minPartitionNum", "40")
        spark.conf.set("spark.sql.files.openCostInBytes", "100")

    yield cut
    spark.conf.unset("spark.sql.files.minPartitionNum")
    for k, v in was.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("packed", [False, True])
def test_splits_that_change_after_the_frame_is_built(spark, tmp_path, narrow_splits, packed):
    """Also where only Spark's reader can open a file: here one is packed."""
    (tmp_path / "1_signals.txt").write_text("".join(f"{i}.0\n" for i in range(30_000)))
    if packed:
        with gzip.open(tmp_path / "record.gz", "wt") as file:
            file.write("7.0\n8.0\n")
    df = signal_files.scan_signal_files(spark, str(tmp_path)).where("record = '1'")
    narrow_splits()
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
    assert df.count() == 30_000 and df.where("value != idx").count() == 0
    assert df.select("idx").distinct().count() == 30_000


def test_changed_file_is_refused(spark, tmp_path):
    file = tmp_path / "1_signals.txt"
    file.write_text("1.0\n2.0\n")
    longer = signal_files.scan_signal_files(spark, str(tmp_path))
    file.write_text("1.0\n2.0\n3.0\n")
    with pytest.raises(Exception, match="has changed since"):
        longer.collect()
    same_length = signal_files.scan_signal_files(spark, str(tmp_path))
    file.write_text("1.0\n2.0\n4.0\n")
    os.utime(file, (1, 1))
    with pytest.raises(Exception, match="has changed since"):
        same_length.collect()


@given(st.binary(max_size=60).map(lambda b: b.replace(b"\x00", b"\n").replace(b"\x01", b"\r\n")), st.integers(1, 9), st.integers(1, 7))
def test_any_bytes_in_any_ranges(content, size, block):
    """Ranges of any size, read in blocks of any size, hold each line once, in order."""
    with tempfile.NamedTemporaryFile() as file, mock.patch.object(line_ranges, "BLOCK", block):
        file.write(content)
        file.flush()
        found = [
            text.as_py()
            for begin in range(0, max(1, len(content)), size)
            for texts in line_ranges.range_lines(file.name, begin, min(begin + size, len(content)), len(content), None)
            for text in texts
        ]
    want = []
    for line in content.removeprefix(b"\xef\xbb\xbf").splitlines():
        try:
            want.append(line.decode())
        except UnicodeDecodeError:
            pass
    # bytes.splitlines also splits at nothing but line feeds and carriage returns.
    assert found == want


def test_ranges_smaller_than_lines_and_files_in_parts(spark, tmp_path):
    folder = tmp_path / "record=9"
    folder.mkdir()
    (folder / "part-00000-x.txt").write_bytes(b"0\r\n1\r2\n\n4")
    (folder / "part-00001-x.txt").write_bytes(b"")
    (folder / "part-00002-x.txt").write_bytes(b"5\n" + b"6" * 50 + b"\n7\n")
    files = signal_files.list_files(spark, str(tmp_path))
    for size in (1, 3, 1000):
        rows = signal_files.read_ranges(signal_files.plan_ranges(files, size)).orderBy("idx").collect()
        assert [(r.record, r.idx, r.text) for r in rows] == [
            ("9", i, t) for i, t in enumerate(["0", "1", "2", "", "4", "5", "6" * 50, "7"])
        ]


def test_written_signals_read_back_in_order(spark, tmp_path):
    df = spark.range(5000).select(
        F.when(F.col("id") % 5 == 0, "b").otherwise("a").alias("record"), (F.col("id") * 7 % 5003).alias("idx")
    ).withColumn("value", F.col("idx") / 4)
    signal_files.write_signal_files(df, str(tmp_path / "s"))
    back = signal_files.scan_signal_files(spark, str(tmp_path / "s"))
    for record in "ab":
        want = sorted(r.idx / 4 for r in df.where(F.col("record") == record).collect())
        got = [r.value for r in back.where(F.col("record") == record).orderBy("idx").collect()]
        assert got == want


def test_manifest_file(spark, tmp_path):
    (tmp_path / "RECORDS.txt").write_text("100\n101\n102\n")
    records = signal_files.scan_manifest(spark, str(tmp_path / "RECORDS.txt"))
    have = spark.createDataFrame([("100",), ("102",), ("102",)], "record string")
    names = lambda df: sorted(r.record for r in df.collect())
    assert names(metadata.record_manifest(records, have)) == ["100", "102"]
    assert names(metadata.record_manifest(records, have, order="line", skip_first=True)) == ["102"]


def test_replay(spark):
    df = spark.createDataFrame([(i,) for i in (0, 1, 2, 360)], "idx bigint")
    rows = messages.replay_timestamps(df, "2024-03-01 10:00:00").orderBy("idx").collect()
    assert [r.time for r in rows] == ["10:00:00.000", "10:00:00.003", "10:00:00.006", "10:00:01.000"]
    assert rows[3].ts == dt.datetime(2024, 3, 1, 10, 0, 1)


def test_replay_matches_rounded_offsets(spark):
    rows = messages.replay_timestamps(spark.range(2000).withColumnRenamed("id", "idx"), "2024-01-01 23:59:58").collect()
    for r in rows:
        want = dt.datetime(2024, 1, 1, 23, 59, 58) + dt.timedelta(seconds=round(r.idx / 360, 3))
        assert r.ts == want and r.time == want.strftime("%H:%M:%S.%f")[:-3]


def test_clock_times_a_zone_skips(spark):
    was = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        one = spark.range(1).withColumnRenamed("id", "idx")
        row = messages.replay_timestamps(one, "2024-03-10 02:30:00.5").first()
        assert row.time == "02:30:00.500"
        back = messages.event_time(spark.createDataFrame([(row.time,)], "time string"), "2024-03-10")
        chunked = time_chunk(back.select(F.col("ts").alias("time"))).first()
        assert chunked.time == dt.datetime(2024, 3, 10, 2, 30, 0, 500000)
        assert chunked.chunk == dt.datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", was)


def test_encode_skips_incomplete(spark):
    df = spark.createDataFrame([("a", "01:02:03.004", 0.5), ("a", None, 1.0)], "signame string, time string, value double")
    assert [bytes(r.value) for r in messages.encode_message(df).collect()] == [b"a,01:02:03.004,0.5"]


def test_parse(spark):
    good = wire(spark, "100,01:02:03.004,0.5,extra", "100,x, -1e3 ")
    assert [tuple(r) for r in messages.parse_sample(good).collect()] == [("100", "01:02:03.004", 0.5), ("100", "x", -1000.0)]
    mixed = wire(spark, "100,01:02:03.004", "a,b,c", "a,b,NaN", None, "a,b,2")
    with pytest.raises(Exception, match="bad sample message"):
        messages.parse_sample(mixed).collect()
    for df in (messages.parse_sample(mixed), messages.parse_sample(mixed).select("signame")):
        with pytest.raises(Exception, match="bad sample message"):
            df.count()
    kept, refused = messages.parse_sample_quarantine(mixed)
    assert [tuple(r) for r in kept.collect()] == [("a", "b", 2.0)]
    assert refused.count() == 4


def test_event_time(spark):
    texts = ["01:02:03.004", "23:59:59.999", "24:00:00.000", "1:2:3.4", "noon"]
    df = spark.createDataFrame([(t,) for t in texts], "time string")
    day = dt.datetime(2024, 5, 6)
    strict = [r.ts for r in messages.event_time(df, "2024-05-06", on_error="null").collect()]
    assert strict == [
        day + dt.timedelta(hours=1, minutes=2, seconds=3, milliseconds=4),
        day + dt.timedelta(hours=23, minutes=59, seconds=59, milliseconds=999),
        None, None, None,
    ]
    lenient = [r.ts for r in messages.event_time(df, "2024-05-06", lenient=True, on_error="null").collect()]
    with pytest.raises(Exception, match="bad time of day"):
        messages.event_time(df, "2024-05-06").collect()
    with pytest.raises(Exception, match="bad time of day"):
        messages.event_time(df, "2024-05-06").count()
    with pytest.raises(Exception, match="bad time of day"):
        messages.event_time(df, "2024-05-06", lenient=True).count()
    assert lenient[2] == day + dt.timedelta(days=1) and lenient[3] == strict[0] and lenient[4] is None


def test_event_time_over_midnight(spark):
    rows = [("23:59:59.999", dt.date(2024, 5, 6)), ("00:00:00.001", dt.date(2024, 5, 7))]
    df = spark.createDataFrame(rows, "time string, day date")
    stamped = messages.event_time(df, F.col("day")).orderBy("ts")
    assert [(r.time, r.ts.day) for r in stamped.collect()] == [("23:59:59.999", 6), ("00:00:00.001", 7)]
    today = messages.event_time(df, F.current_date()).first()
    assert (today.ts.hour, today.ts.microsecond) == (23, 999_000)


def comments(spark, text):
    df = spark.createDataFrame([(text,)], "c string")
    return df.select(metadata.parse_header_comments(F.col("c"))).first()[0]


@pytest.mark.parametrize(
    "text,want",
    [
        ("<age>: 65 <sex>: M", {"age": "65", "sex": "M"}),
        ("no header", {}),
        ("", {}),
        ("<", {}),
        ("<age", {}),
        ("<age>:", {"age": ""}),
        ("<a>: 1 <b>: 2 <a>: 3 4", {"a": "34", "b": "2"}),
        ("<a>: x*y <b>: z", {"a": "x", "y ": "b"}),
        ("<a> 5 <b>: 6", {"a> 5 ": "b"}),
    ],
)
def test_header_comments(spark, text, want):
    assert comments(spark, text) == want


def test_metadata(spark):
    rows = [
        ("100", 360.0, 2, 650000, ["mV", "mV"], ["MLII", "V5"], ['<age>: 65 <sex>: M <fs>: "250"', "second"]),
        ("101", 360.0, 1, 10, ["mV"], ["V5"], []),
    ]
    out = {r.record: json.loads(r.metadata) for r in metadata.record_metadata(spark.createDataFrame(rows, RECORD_HEADER)).collect()}
    assert out["100"] == {
        "age": "65", "fs": '"250"', "n_sig": 2, "sex": "M", "sig_len": 650000,
        "sig_name": ["MLII", "V5"], "units": ["mV", "mV"],
    }
    assert list(out["100"]) == sorted(out["100"])
    assert out["101"] == {"fs": 360.0, "n_sig": 1, "sig_len": 10, "sig_name": ["V5"], "units": ["mV"]}


def test_channel(spark):
    df = spark.createDataFrame([("a", "MLII", 1.0), ("b", "V5", 2.0)], "record string, channel string, value double")
    assert [r.record for r in metadata.select_channel(df).collect()] == ["a"]


class _Reader:
    """Stands in for a stream reader whose connector is not here."""

    def __init__(self):
        self.readStream, self.given = self, {}

    def format(self, name):
        return self

    def option(self, name, value):
        self.given[name] = value
        return self

    def options(self, **given):
        self.given |= given
        return self

    def load(self):
        return self.given


@pytest.mark.parametrize("asked, want", [(None, messages.BATCH_MESSAGES), ({"maxOffsetsPerTrigger": "7"}, "7")])
def test_micro_batches_of_a_topic_are_bounded(asked, want):
    assert messages.source_stream(_Reader(), options=asked)["maxOffsetsPerTrigger"] == want
