import datetime as dt

import pytest
from pyspark.sql import functions as F

from beatline.functions.arrays import parse_array_text
from beatline.plans import serving
from beatline.schemas import SIGNAL_SAMPLES
from beatline.sinks import signal_table
from beatline.sinks.reports import newest_rows, recent_rows, update_reports

DAY = dt.datetime(2024, 1, 1, 23, 59, 0)


def rows(*items):
    return [(i, name, DAY + dt.timedelta(seconds=s), [float(i), 1.0], flag) for i, name, s, flag in items]


@pytest.fixture(scope="module")
def table(spark):
    data = [(i, ["101", "102"][i % 2], i // 2, "TRUE" if i % 5 else "FALSE") for i in range(200)]
    return spark.createDataFrame(rows(*data), SIGNAL_SAMPLES)


def test_array_text(spark):
    df = spark.createDataFrame([("[1.5, -2, 3e1]",), ("x[4]y",), ("none",)], "t string")
    assert [r[0] for r in df.select(parse_array_text(F.col("t"))).collect()] == [[1.5, -2.0, 30.0], [4.0], None]


@pytest.mark.parametrize("task_rows", [10**6, 9])
def test_ids(spark, task_rows):
    df = spark.range(60).select(
        (F.col("id") % 4).cast("string").alias("signame"), F.col("id").alias("k"), F.lit(1).alias("seg")
    )
    out = signal_table.assign_id(df, task_rows=task_rows).collect()
    assert [r.id for r in sorted(out, key=lambda r: (r.signame, r.k))] == list(range(1, 61))
    timed = df.withColumn("time", F.lit(DAY))
    hashed = [signal_table.stable_id(d).select("id").collect() for d in (timed, timed.orderBy(F.rand(1)))]
    assert sorted(hashed[0]) == sorted(hashed[1]) and len(set(hashed[0])) == 60
    other = signal_table.stable_id(timed, writer="other").select("id").collect()
    assert not set(other) & set(hashed[0])


def test_chunk_and_unique(spark):
    df = spark.createDataFrame(rows((3, "a", 5, "TRUE"), (1, "a", 5, "TRUE"), (2, "b", 65, "TRUE")), SIGNAL_SAMPLES)
    chunks = {r.id: r.chunk for r in signal_table.time_chunk(df).collect()}
    assert chunks[1] == DAY and chunks[2] == DAY + dt.timedelta(minutes=1)
    kept = signal_table.unique_signal_time(df)
    assert kept.columns == df.columns and sorted(r.id for r in kept.collect()) == [1, 2]


def test_chunks_keep_null_times(spark):
    times = [None, dt.datetime(1969, 12, 31, 23, 59, 59, 5), dt.datetime(2024, 3, 10, 2, 30, 59, 999_999)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id long, time timestamp_ntz")
    for interval, want in (
        ("1 minute", [None, dt.datetime(1969, 12, 31, 23, 59), dt.datetime(2024, 3, 10, 2, 30)]),
        ("6 hours", [None, dt.datetime(1969, 12, 31, 18), dt.datetime(2024, 3, 10)]),
        ("45 seconds", [None, dt.datetime(1969, 12, 31, 23, 59, 15), dt.datetime(2024, 3, 10, 2, 30, 45)]),
    ):
        got = signal_table.time_chunk(df, interval).orderBy("id").collect()
        assert [r.chunk for r in got] == want, interval


def test_writers_only_add(spark, tmp_path):
    path = str(tmp_path / "table")
    beats = spark.createDataFrame(rows((1, "a", 0, "TRUE"), (2, "a", 120, "TRUE")), SIGNAL_SAMPLES)
    found = beats.withColumns({"k": F.col("id"), "seg": F.lit(1)}).drop("id")
    names = [signal_table.sink_signal_samples(found, path) for _ in range(2)]
    assert names[0] != names[1]
    back = signal_table.read_signal_samples(spark, path)
    assert back.count() == 4 and back.select("id").distinct().count() == 4
    signal_table.sink_signal_samples(found, path, names[0])
    assert signal_table.read_signal_samples(spark, path).count() == 4
    compact = str(tmp_path / "compact")
    signal_table.compact_signal_samples(spark, path, compact)
    read = lambda p: sorted(map(repr, signal_table.read_signal_samples(spark, p).collect()))
    assert read(compact) == read(path)


def test_sink_is_idempotent_and_filters(spark, tmp_path):
    path = str(tmp_path / "table")
    good = spark.createDataFrame(rows((1, "a", 0, "TRUE"), (2, "a", 120, "TRUE"), (3, "n" * 51, 0, "TRUE")), SIGNAL_SAMPLES)
    signal_table.sink_signal_samples(good, path, "w", 0)
    signal_table.sink_signal_samples(good, path, "w", 0)
    signal_table.sink_signal_samples(good.where("id = 2").withColumn("id", F.lit(9).cast("long")), path, "w", 1)
    back = signal_table.read_signal_samples(spark, path)
    assert sorted(r.id for r in back.collect()) == [1, 2, 9]
    assert sorted({str(r.date) for r in back.collect()}) == ["2024-01-01", "2024-01-02"]
    refused = signal_table.split_storable(good)[1]
    assert [r.id for r in refused.collect()] == [3]
    kept = signal_table.read_refused(spark, path).collect()
    assert [(r.id, r.writer, r.batch, r.reason) for r in kept] == [(3, "w", 0, "signame is longer than 50")]
    with pytest.raises(ValueError, match="constraints"):
        signal_table.sink_jdbc(good, "jdbc:none", {})


def test_recent_prunes_by_date(spark, tmp_path):
    path = str(tmp_path / "table")
    signal_table.sink_signal_samples(spark.createDataFrame(rows((1, "a", 0, "TRUE"), (2, "a", 120, "TRUE")), SIGNAL_SAMPLES), path)
    stored = signal_table.read_signal_samples(spark, path)
    recent = serving.recent_events(stored, 30)
    assert [r.id for r in recent.collect()] == [2]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert any("date" in scan.split("PushedFilters")[0] for scan in plan.split("PartitionFilters: ")[1:])


def test_lookup_prunes_by_date_and_signal(spark, tmp_path):
    path = str(tmp_path / "table")
    beats = spark.createDataFrame(rows((1, "a", 0, "TRUE"), (2, "a", 120, "TRUE"), (3, "b", 120, "TRUE")), SIGNAL_SAMPLES)
    signal_table.sink_signal_samples(beats, path)
    stored = signal_table.read_signal_samples(spark, path)
    found = serving.ecg_signal(stored, 2, "a", "2024-01-02")
    assert [r.ecg for r in found.collect()] == [[2.0, 1.0]]
    assert serving.ecg_signal(stored, 2, "b", "2024-01-02").count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "date" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "IsNotNull(signame)" in plan.split("PushedFilters")[1]


def test_latest(table):
    got = [(r.id, r.abnormal) for r in serving.latest_events(table, "101").collect()]
    want = [(i, "TRUE") for i in range(198, -1, -2) if i % 5][:50]
    assert got == want


def test_recent_takes_the_oldest(table):
    got = [r.id for r in serving.recent_events(table).collect()]
    first = next(i for i in range(200) if i // 2 > 99 - 60)
    assert got == list(range(first, first + 50))
    assert [r.id for r in serving.recent_events(table, 1).collect()] == [198, 199]


def test_view_chooses(table):
    ids = lambda df: [r.id for r in df.collect()]
    assert ids(serving.events_view(table)) == ids(serving.recent_events(table))
    assert ids(serving.events_view(table, "10")) == ids(serving.recent_events(table))
    assert ids(serving.events_view(table, "101")) == ids(serving.latest_events(table, "101"))
    assert serving.events_view(table, "101").columns == ["id", "signame", "time", "abnormal"]


def test_signal_and_trace(table):
    assert [r.ecg for r in serving.ecg_signal(table, 7).collect()] == [[7.0, 1.0]]
    assert [tuple(r) for r in serving.signal_trace(table, 7).collect()] == [(0, 7.0), (1, 1.0)]
    assert serving.ecg_signal(table, 5).count() == 0  # stored, but not abnormal
    assert serving.signal_trace(table, 10_000).count() == 0
    assert sorted(r.signame for r in serving.signal_names(table).collect()) == ["101", "102"]


def test_top_k_plans_do_not_sort_everything(table):
    for df in (serving.latest_events(table, "101"), serving.recent_events(table)):
        assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_unique_rows_over_appends(spark, tmp_path):
    """Repeats within a batch and of stored rows are refused with their reason, whoever wrote them; replays change nothing."""
    table = str(tmp_path / "t")
    day = [dt.datetime(2024, 1, d, 12) for d in (1, 2, 3)]
    schema = "id long, signame string, time timestamp_ntz, ecg array<double>, abnormal string, k long"

    def rows(*given):
        return spark.createDataFrame([(i, s, t, [float(i)], "TRUE", k) for i, s, t, k in given], schema)

    first = rows((1, "a", day[0], 2), (2, "a", day[0], 1), (3, "a", day[1], 1), (4, "b", day[0], 1), (5, None, day[0], 0))
    second = rows((6, "a", day[1], 1), (7, "a", day[2], 1), (8, "b", day[0], 5), (9, None, day[0], 0))
    for given, writer in ((first, "one"), (second, "two"), (second, "two"), (first, "one")):
        signal_table.sink_signal_samples(given, table, writer, unique=("k",))
        if writer == "two":
            assert sorted(r.id for r in signal_table.read_signal_samples(spark, table).collect()) == [2, 3, 4, 7]
    assert sorted(r.id for r in signal_table.read_signal_samples(spark, table).collect()) == [2, 3, 4, 7]
    refused = {r.id: r.reason for r in signal_table.read_refused(spark, table).collect()}
    assert refused == {
        1: signal_table.TAKEN, 5: "signame is null", 6: signal_table.KNOWN, 8: signal_table.KNOWN, 9: "signame is null"
    }


def test_lookup_reads_the_dates_of_the_batch(spark, tmp_path):
    table = str(tmp_path / "t")
    days = spark.range(400).select(
        "id", F.lit("a").alias("signame"), (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"))).alias("time"),
        F.array(F.lit(1.0)).alias("ecg"), F.lit("TRUE").alias("abnormal"),
    )
    signal_table.sink_signal_samples(days, table, "old")
    asked = days.where("id in (3, 200)").select(F.to_date("time").alias("date"))
    keys = signal_table.stored_keys(spark, table, asked, "new", 0)
    assert keys.count() == 2
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "date" in plan.split("PartitionFilters")[1] and "ReadSchema: struct<signame:string,time:timestamp_ntz>" in plan
    read = len(keys.select(F.input_file_name()).distinct().collect())
    assert read == 2 and len(list((tmp_path / "t").rglob("*.parquet"))) >= 400


def test_ids_count_on_over_appends(spark, tmp_path):
    ledger = str(tmp_path / "ids")

    def ids(keys, writer, batch, **kw):
        rows = spark.createDataFrame([(k, 0, 0) for k in keys], "signame string, k long, seg long").repartition(3)
        return {r.signame: r.id for r in signal_table.assign_next_ids(rows, ledger, writer, batch, **kw).collect()}

    assert ids("cab", "one", 0) == {"a": 1, "b": 2, "c": 3}
    assert ids("ed", "two", 0, task_rows=1) == {"d": 4, "e": 5}
    assert ids("", "one", 1) == {}
    assert ids("fg", "one", 2) == {"f": 6, "g": 7}
    assert ids("gf", "one", 2) == {"f": 6, "g": 7}  # a replay
    assert ids("de", "two", 0) == {"d": 4, "e": 5}
    assert ids("h", "one", 3) == {"h": 8}
    with pytest.raises(ValueError):
        ids("hi", "one", 3)
    assert sorted(p.name for p in (tmp_path / "ids" / "writer=one").iterdir()) == ["batch=2", "batch=3"]


def test_an_id_alone_reads_few_files(spark, tmp_path):
    """Hashed ids lie anywhere; still the data of a few files of many are read."""
    table, per_file = str(tmp_path / "t"), 60
    rows = spark.range(200 * per_file).select(
        F.lit("a").alias("signame"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("id") % 200).cast("int"), F.lit(0), F.lit(0), F.col("id").cast("decimal(18,6)") / 1000)).alias("time"),
        F.array(F.col("id").cast("double")).alias("ecg"), F.lit("TRUE").alias("abnormal"), F.col("id").alias("k"), F.lit(1).alias("seg"),
    )
    signal_table.sink_signal_samples(rows, table, "w")
    stored = signal_table.read_signal_samples(spark, table)
    wanted = stored.where("ecg[0] = 777").first().id
    found = serving.ecg_signal(stored, wanted)
    assert [r.ecg for r in found.collect()] == [[777.0]]
    plan = found._jdf.queryExecution().executedPlan()
    read = plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()
    assert 1 <= read < 5 * per_file


def test_reports_are_kept_up(spark, tmp_path):
    """After each batch of either writer the summaries answer as the table does, and read no more as it grows."""
    table, kept = str(tmp_path / "t"), str(tmp_path / "r")
    sizes = []
    for batch in range(4):
        for writer in ("one", "two"):
            place = F.col("id") + 1000 * batch
            given = spark.range(90).select(
                (place * 2 + int(writer == "two")).alias("id"), F.when(F.col("id") % 5 == 0, "b").otherwise("a").alias("signame"),
                (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (place / 2 - F.pmod(F.col("id") * 7, F.lit(40))).cast("decimal(18,6)"))).alias("time"),
                F.array(F.lit(1.0)).alias("ecg"), F.when(F.col("id") % 3 == 0, "FALSE").otherwise("TRUE").alias("abnormal"),
            )
            for _ in range(2 if batch == 2 else 1):  # a replay
                signal_table.sink_signal_samples(given, table, writer, batch)
                update_reports(spark, table, kept, writer, batch, rows=10)
        stored = signal_table.read_signal_samples(spark, table)
        for name in "ab":
            got = serving.latest_events(newest_rows(spark, kept), name, 10).collect()
            assert got == serving.latest_events(stored, name, 10).collect() and len(got) == 10
        got = serving.recent_events(recent_rows(spark, kept)).collect()
        assert got == serving.recent_events(stored).collect() and got
        sizes.append(newest_rows(spark, kept).count() + recent_rows(spark, kept).count())
    assert sizes[-1] <= sizes[0] + 5 and stored.count() == 720
    assert sorted(p.name for p in (tmp_path / "r" / "writer=one").iterdir()) == ["batch=2", "batch=3"]
