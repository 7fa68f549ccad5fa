import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from util import random_signals, samples

from beatline.operators.windows import count_window_arrays
from beatline.plans.detection import detect_anomalies, drop_repeats
from beatline.schemas import SAMPLES
from beatline.sinks.signal_table import read_signal_samples, sink_signal_samples
from beatline.sources.messages import encode_message, event_time, parse_sample, replay_timestamps, source_stream
from beatline.sources.signal_files import scan_signal_files
from beatline.streaming.detection import (
    detect_messages,
    detect_stream,
    late_path,
    read_late,
    read_refused_messages,
    windows_stream,
)
from beatline.streaming.order import Reorder
from beatline.streaming.reported import ReportedBeats
from beatline.streaming.windows import CarryWindows

SIGNALS = random_signals(12, 90, seed=41) | {"long": [float((i * 37) % 11) / 8 for i in range(400)]}
KW = dict(size=16, slide=8)


def slices(df, cuts):
    """Consecutive parts of every signal, so arrival order is time order."""
    edges = [0, *cuts, 10**9]
    return [df.where((F.col("tie") >= a) & (F.col("tie") < b)) for a, b in zip(edges, edges[1:])]


def firings(df):
    return sorted((str(r.signame), r.k, r.ecg, [str(t) for t in r.times]) for r in df.collect())


def test_stateful_windows_equal_batch_across_restarts(spark, tmp_path):
    df = samples(spark, SIGNALS)
    src, out, check = (str(tmp_path / p) for p in ("src", "out", "check"))
    for part in slices(df, [7, 30, 31, 100]):
        part.write.mode("append").parquet(src)
        windows_stream(source_stream(spark, "parquet", src, SAMPLES), out, check, **KW).awaitTermination()
    assert firings(spark.read.parquet(out)) == firings(count_window_arrays(df, **KW))


@pytest.mark.parametrize("size,slide", [(16, 8), (3, 7), (9, 2)])
def test_carried_windows_equal_batch(spark, tmp_path, size, slide):
    df = samples(spark, SIGNALS)
    carry = CarryWindows(spark, str(tmp_path / "tails"), size, slide, task_rows=120)
    found = []
    for batch, part in enumerate(slices(df, [5, 33, 100])):
        now = firings(carry.next(part, batch))
        if batch == 1:  # a replayed batch gives the same firings
            assert firings(carry.next(part, batch)) == now
        found += now
    assert sorted(found) == firings(count_window_arrays(df, size, slide))


@pytest.mark.parametrize("front", ["state", "carry"])
def test_stream_fills_the_table_like_batch(spark, tmp_path, front):
    df = samples(spark, SIGNALS)
    kw = dict(width=2, rr_floor=6 / 360, **KW)
    src, table, check = (str(tmp_path / p) for p in ("src", "table", "check"))
    for part in slices(df, [50, 200]):
        part.write.mode("append").parquet(src)
        detect_stream(source_stream(spark, "parquet", src, SAMPLES), table, check, front=front, **kw).awaitTermination()
    cols = ["signame", "time", "ecg", "abnormal"]
    want = sorted(map(repr, detect_anomalies(df, **kw).select(cols).collect()))
    assert want
    assert sorted(map(repr, read_signal_samples(spark, table).select(cols).collect())) == want
    # A second stream on the table only adds, under ids of its own.
    stream = source_stream(spark, "parquet", src, SAMPLES)
    detect_stream(stream, table, str(tmp_path / "again"), front=front, **kw).awaitTermination()
    stored = read_signal_samples(spark, table)
    assert sorted(map(repr, stored.select(cols).collect())) == sorted(want * 2)
    assert stored.select("id").distinct().count() == 2 * len(want)
    with pytest.raises(ValueError):
        detect_stream(df, table, check, front="other")


def test_any_sink(spark, tmp_path):
    df = samples(spark, SIGNALS)
    kw = dict(width=2, rr_floor=6 / 360, **KW)
    src = str(tmp_path / "src")
    df.write.parquet(src)
    taken = []
    detect_stream(
        source_stream(spark, "parquet", src, SAMPLES),
        lambda rows, name, batch: taken.append((name, batch, rows.count())),
        str(tmp_path / "check"),
        **kw,
    ).awaitTermination()
    assert sum(n for *_, n in taken) == detect_anomalies(df, **kw).count()
    assert len({name for name, *_ in taken}) == 1


def test_quiet_keys_and_old_folders(spark, tmp_path):
    """Many keys without news, one busy key, tails gathered several times."""
    signals = {f"quiet{i}": [1.0] * 5 for i in range(50)} | {"busy": [float(i % 9) for i in range(200)]}
    nameless = samples(spark, {"x": [2.0] * 60}).withColumn("signame", F.lit(None).cast("string"))
    df = samples(spark, signals).unionByName(nameless)
    carry = CarryWindows(spark, str(tmp_path / "tails"), 16, 8, compact=2)
    found = []
    for batch, part in enumerate(slices(df, [5, 25, 60, 61, 90, 120, 160])):
        found += firings(carry.next(part, batch))
    assert sorted(found) == firings(count_window_arrays(df, 16, 8))
    left = {p.name for p in (tmp_path / "tails").iterdir()}
    assert "batch=0" not in left and "batch=7" in left and "all=6" in left
    # Only keys with news are written.
    assert spark.read.parquet(str(tmp_path / "tails" / "batch=7")).select("signame").distinct().count() == 1


def test_messages_to_samples_on_a_stream(spark, tmp_path):
    df = samples(spark, {"a": range(20)}).withColumn("time", F.date_format("ts", "HH:mm:ss.SSS"))
    src = str(tmp_path / "topic")
    encode_message(df).write.parquet(src)
    stream = source_stream(spark, "parquet", src, encode_message(df).schema)
    parsed = event_time(parse_sample(stream), "2024-01-01")
    query = parsed.writeStream.format("memory").queryName("parsed").trigger(availableNow=True).start()
    query.awaitTermination()
    got = sorted((r.signame, r.ts, r.value) for r in spark.table("parsed").collect())
    assert got == sorted((r.signame, r.ts, r.value) for r in df.collect())


def test_recordings_to_table(spark, tmp_path):
    """Files, replay, messages, stream, detection, table: the whole way."""
    signals = {"100": SIGNALS["long"], "101": SIGNALS["long"][150:290]}
    for name, xs in signals.items():
        (tmp_path / f"{name}_signals.txt").write_text("".join(f"{x:.32f}\n" for x in xs))
    kw = dict(width=2, rr_floor=6 / 360, **KW)
    files = scan_signal_files(spark, str(tmp_path / "*_signals.txt")).withColumnRenamed("record", "signame")
    stamped = replay_timestamps(files, "2024-01-01 12:00:00")
    topic, table, check = (str(tmp_path / p) for p in ("topic", "table", "check"))
    sent = encode_message(stamped).withColumn("offset", F.monotonically_increasing_id())
    sent.write.parquet(topic)

    received = parse_sample(source_stream(spark, "parquet", topic, sent.schema), keep=("offset",))
    stream = event_time(received, "2024-01-01").withColumnRenamed("offset", "tie")
    detect_stream(stream, table, check, **kw).awaitTermination()

    cols = ["signame", "time", "ecg"]
    want = detect_anomalies(stamped, order=("ts",), idx="idx", **kw).select(cols).collect()
    assert want
    assert sorted(map(repr, read_signal_samples(spark, table).select(cols).collect())) == sorted(map(repr, want))


def key_of(row):
    return tuple(map(str, row))


@pytest.mark.parametrize("front", ["state", "carry"])
def test_dedup_over_micro_batches(spark, tmp_path, front):
    """Beats seen again by firings of a later micro-batch, of a restarted stream, are not reported again."""
    df = samples(spark, SIGNALS)
    kw = dict(width=2, rr_floor=6 / 360, dedup=True, size=24, slide=5)
    src, table, check = (str(tmp_path / p) for p in ("src", "table", "check"))
    for part in slices(df, [37, 52, 61, 200]):
        part.write.mode("append").parquet(src)
        detect_stream(source_stream(spark, "parquet", src, SAMPLES), table, check, front=front, **kw).awaitTermination()
    cols = ["signame", "time", "ecg"]
    want = detect_anomalies(df, **kw).select(cols)
    got = read_signal_samples(spark, table).select(cols)
    assert sorted(map(key_of, got.collect())) == sorted(map(key_of, want.collect()))
    assert want.count() < detect_anomalies(df, **kw | {"dedup": False}).count()


def test_reported_beats_are_gathered(spark, tmp_path):
    """Gathering forgets only beats that no later firing can hold; a replayed batch reports the same."""
    df = samples(spark, {"a": [float((i * 5) % 7) / 4 for i in range(400)], "quiet": [1.0, 0.0] * 6})
    kw = dict(size=16, slide=4)
    found = detect_anomalies(df, width=2, rr_floor=6 / 360, **kw).withColumn("part", F.floor(F.col("k") / 9)).cache()
    reported = ReportedBeats(spark, str(tmp_path / "beats"), compact=2, **kw)
    got = []
    for batch in range(12):
        part = found.where(F.col("part") == batch).drop("part")
        now = [(r.signame, r.k, r.seg) for r in reported.next(part, batch).collect()]
        if batch == 7:
            assert sorted(now) == sorted((r.signame, r.k, r.seg) for r in reported.next(part, batch).collect())
        got += now
    want = [(r.signame, r.k, r.seg) for r in drop_repeats(found).collect()]
    assert sorted(got) == sorted(want) and len(want) < found.count()
    kept = spark.read.parquet(str(tmp_path / "beats" / "all=10"))
    assert 0 < kept.count() < len(want) / 2
    assert "batch=0" not in {p.name for p in (tmp_path / "beats").iterdir()}


def shuffled(df, seed, delay):
    """Four micro-batches in which every sample is at most ``delay`` samples behind the newest one."""
    arrival = F.col("tie") + F.pmod(F.xxhash64("signame", "tie", F.lit(seed)), F.lit(delay))
    parted = df.withColumn("arrival", arrival)
    edges = [0, 40, 41, 130, 10**9]
    return [parted.where((F.col("arrival") >= a) & (F.col("arrival") < b)).drop("arrival") for a, b in zip(edges, edges[1:])]


def test_samples_out_of_order(spark, tmp_path):
    """Samples shuffled within the delay give the batch's result; what is further behind is stored and counted."""
    df = samples(spark, SIGNALS)
    kw = dict(width=2, rr_floor=6 / 360, **KW)
    src, table, check = (str(tmp_path / p) for p in ("src", "table", "check"))
    parts = shuffled(df, 1, 20)
    # A few samples of the first part come with the last one.
    behind = parts[0].where("tie < 9 and signame in ('long', 's1')")
    sent = [parts[0].exceptAll(behind), *parts[1:3], parts[3].unionByName(behind)]
    for part in sent:
        part.write.mode("append").parquet(src)
        stream = source_stream(spark, "parquet", src, SAMPLES)
        detect_stream(stream, table, check, delay="20 milliseconds", **kw).awaitTermination()
    late = read_late(spark, late_path(check))
    assert sorted((r.signame, r.tie) for r in late.collect()) == sorted((r.signame, r.tie) for r in behind.collect())
    end = df.agg(F.max("ts") - F.expr("interval 20 milliseconds")).first()[0]
    taken = df.exceptAll(behind).where(F.col("ts") <= F.lit(str(end)).cast("timestamp_ntz"))
    cols = ["signame", "time", "ecg"]
    want = sorted(map(key_of, detect_anomalies(taken, **kw).select(cols).collect()))
    assert want and sorted(map(key_of, read_signal_samples(spark, table).select(cols).collect())) == want
    with pytest.raises(ValueError):
        detect_stream(df, table, check, front="state", delay="1 second")


def test_reorder_releases_once_and_in_order(spark, tmp_path):
    df = samples(spark, SIGNALS)
    order = Reorder(spark, str(tmp_path / "order"), "25 milliseconds")
    released, last = [], None
    for batch, part in enumerate([*shuffled(df, 2, 25), df.limit(0)]):
        ready, late = order.next(part, batch)
        now = sorted((r.ts, r.signame, r.tie) for r in ready.collect())
        if batch == 2:
            assert sorted((r.ts, r.signame, r.tie) for r in order.next(part, batch)[0].collect()) == now
        assert late.count() == 0
        assert not now or last is None or now[0][0] > last
        last = now[-1][0] if now else last
        released += now
    held = spark.read.parquet(str(tmp_path / "order" / "held" / "batch=4"))
    everything = sorted((r.ts, r.signame, r.tie) for r in df.collect())
    assert sorted(released + [(r.ts, r.signame, r.tie) for r in held.collect()]) == everything
    assert sorted(p.name for p in (tmp_path / "order" / "held").iterdir()) == ["batch=3", "batch=4"]


def test_refused_messages_do_not_stop_the_job(spark, tmp_path):
    df = samples(spark, SIGNALS).withColumn("time", F.date_format("ts", "HH:mm:ss.SSS"))
    kw = dict(width=2, rr_floor=6 / 360, **KW)
    sent = encode_message(df.orderBy("tie")).withColumn("offset", F.monotonically_increasing_id())
    bad = ["", "no fields", "a,b", "a,10:00:00.000,x", "a,10:00:00.000,NaN", "a,25:00:00.000,1.0", "a,10:00,1.0"]
    why = ["no value"] * 5 + ["bad time of day"] * 2
    wrong = spark.createDataFrame([(bytearray(m.encode()), -i) for i, m in enumerate(bad, 1)], "value binary, offset long")
    wrong = wrong.unionByName(spark.createDataFrame([(None, -99)], "value binary, offset long"))
    topic, table, refused, check = (str(tmp_path / p) for p in ("topic", "table", "refused", "check"))
    calls = []
    for part in (wrong.where("offset % 2 = 0").unionByName(sent.where("offset % 7 < 3")), wrong.where("offset % 2 != 0"), sent.where("offset % 7 >= 3")):
        part.write.mode("append").parquet(topic)
        stream = source_stream(spark, "parquet", topic, sent.schema)

        def sink(rows, name, batch):
            # The batch fails once after its refused messages were stored, and is replayed.
            calls.append(batch)
            if calls.count(batch) == 1 and batch == 1:
                raise RuntimeError("lost")
            sink_signal_samples(rows, table, name, batch)

        try:
            detect_messages(stream, sink, refused, check, "2024-01-01", **kw).awaitTermination()
        except StreamingQueryException:
            detect_messages(stream, sink, refused, check, "2024-01-01", **kw).awaitTermination()
    assert calls.count(1) == 2
    got = [(r.offset, bytes(r.message) if r.message is not None else None, r.reason) for r in read_refused_messages(spark, refused).collect()]
    want = [(-i, m.encode(), w) for i, (m, w) in enumerate(zip(bad, why, strict=True), 1)] + [(-99, None, "no value")]
    assert sorted(got) == sorted(want)
    assert read_signal_samples(spark, table).count() > 0
