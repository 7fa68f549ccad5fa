"""One Spark query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatline.functions import arrays
from beatline.functions.times import clock_text
from beatline.operators import peaks, shape, windows
from beatline.operators.indexing import dense_index
from beatline.plans import detection, serving
from beatline.runtime import scratch_path
from beatline.sinks import signal_table
from beatline.sinks.reports import newest_rows, recent_rows
from beatline.sources import messages, metadata, signal_files
from beatline.streaming.detection import read_late, read_refused_messages
from registry import streams
from registry.tables import (
    LONG,
    SHORT,
    SHORT_BEATS,
    event_table,
    events,
    samples,
    stamp,
    steady,
    vector_rows,
    vectors,
)

Query = Callable[[SparkSession, str], DataFrame]
START = "2024-01-01 10:00:00"


def _firings(spark, sf):
    return windows.count_window_arrays(samples(spark, sf), **LONG)


def _segments(spark, sf):
    return detection.beat_segments(_firings(spark, sf), **LONG)


def _scored(spark, sf):
    return detection.beat_timestamp(detection.rr_interval(detection.avg_teager(_segments(spark, sf))))


def _anomalies(spark, sf, **kw):
    return detection.detect_anomalies(samples(spark, sf), **LONG, **kw)


def _wide_anomalies(spark, sf, **kw):
    return detection.detect_anomalies(samples(spark, sf, "user_id"), **SHORT, **SHORT_BEATS, **kw)


def _anomaly_report(df):
    return df.select("signame", "k", "seg", "start", "len", steady("avg_te").alias("avg_te"),
                     steady("rr").alias("rr"), stamp("time").alias("time"), "abnormal")


def _indexed(spark, sf, key="user_id"):
    """(signame, pos, ts, value) with dense positions."""
    return dense_index(samples(spark, sf, key), ["signame"], ["ts", "tie"], "pos").drop("tie")


def _table(spark, sf):
    """The stored table, filled by detection."""
    return signal_table.assign_id(_wide_anomalies(spark, sf)).select("id", "signame", "time", "ecg", "abnormal")


# --- sources -----------------------------------------------------------------


def scan_signal_files(spark, sf):
    path = scratch_path(spark, "signals")
    signal_files.write_signal_files(
        _indexed(spark, sf, "event_type").withColumnRenamed("signame", "record"), path, idx="pos"
    )
    return signal_files.scan_signal_files(spark, path)


def replay_timestamps(spark, sf):
    stamped = messages.replay_timestamps(_indexed(spark, sf, "event_type"), START, idx="pos")
    return stamped.select("signame", "pos", stamp("ts").alias("ts"), "time")


def _timed(spark, sf):
    return samples(spark, sf).withColumn("time", clock_text(F.col("ts")))


def encode_message(spark, sf):
    return messages.encode_message(_timed(spark, sf)).select(F.col("value").cast("string").alias("message"))


def parse_sample(spark, sf):
    return messages.parse_sample(messages.encode_message(_timed(spark, sf)))


def parse_sample_quarantine(spark, sf):
    # Every error event loses its value on the way, so its message is refused.
    sent = _timed(spark, sf).select(
        F.concat_ws(",", "signame", "time", F.when(F.col("signame") != "error", F.col("value").cast("string")))
        .cast("binary").alias("value")
    )
    good, bad = messages.parse_sample_quarantine(sent)
    return good.groupBy("signame").agg(F.count("*").alias("n")).unionByName(
        bad.groupBy(F.lit("refused").alias("signame")).agg(F.count("*").alias("n"))
    )


def event_time(spark, sf):
    parsed = messages.parse_sample(messages.encode_message(_timed(spark, sf)))
    return messages.event_time(parsed, "2024-01-01").select("signame", "time", stamp("ts").alias("ts"), "value")


def source_stream(spark, sf):
    out, check = scratch_path(spark, "received"), scratch_path(spark, "check")

    def run(stream):
        return (
            stream.writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", check).trigger(availableNow=True).start()
        )

    streams.in_slices(samples(spark, sf), run)
    return spark.read.parquet(out).select("signame", stamp("ts").alias("ts"), "tie", "value")


def _headers(spark, sf):
    """A recording header per user, with a repeated key in its comment."""
    user = F.col("user_id").cast("string")
    comment = F.concat(
        F.lit("<age>: "), user, F.lit(" <sex>: M <sinus rhythm>: n o "),
        F.lit("<age>: "), (F.col("user_id") + 1).cast("string"),
    )
    return (
        events(spark, sf)
        .groupBy("user_id")
        .agg(
            F.count_distinct("event_type").cast("int").alias("n_sig"),
            F.count("*").alias("sig_len"),
            F.sort_array(F.collect_set("event_type")).alias("sig_name"),
        )
        .select(
            user.alias("record"), F.lit(360.0).alias("fs"), "n_sig", "sig_len",
            F.array(F.lit("mV")).alias("units"), "sig_name", F.array(comment).alias("comments"),
        )
    )


def parse_header_comments(spark, sf):
    parsed = metadata.parse_header_comments(F.col("comments")[0])
    return _headers(spark, sf).select("record", F.explode(parsed).alias("field", "text"))


def record_metadata(spark, sf):
    return metadata.record_metadata(_headers(spark, sf))


def _channels(spark, sf):
    return events(spark, sf).select(
        F.col("user_id").cast("string").alias("record"), F.col("event_type").alias("channel"),
        F.col("event_id").alias("idx"), "value",
    )


def select_channel(spark, sf):
    return metadata.select_channel(_channels(spark, sf), "error")


def record_manifest(spark, sf, skip_first=False):
    everything = _channels(spark, sf)
    return metadata.record_manifest(
        everything.select("record").distinct(), metadata.select_channel(everything, "error"), skip_first=skip_first
    )


# --- windows -----------------------------------------------------------------


def rebalance(spark, sf):
    return windows.rebalance(samples(spark, sf)).select("signame", stamp("ts").alias("ts"), "tie", "value")


def key_by(spark, sf):
    return windows.key_by(samples(spark, sf)).select("signame", stamp("ts").alias("ts"), "tie", "value")


def watermark(spark, sf):
    return windows.watermark(samples(spark, sf)).select("signame", stamp("ts").alias("ts"), "tie", "value")


def count_window(spark, sf):
    return windows.count_window(samples(spark, sf), **LONG).select(
        "signame", "k", "pos", stamp("ts").alias("ts"), "value"
    )


def watermark_delay(spark, sf):
    late = windows.watermark(samples(spark, sf), delay="10 minutes")
    return late.select("signame", stamp("ts").alias("ts"), "tie", "value")


def count_window_ranged(spark, sf):
    """Signals too long for one task: range partitioned positions and lanes."""
    return windows.count_window(samples(spark, sf), **LONG, task_rows=500).select(
        "signame", "k", "pos", stamp("ts").alias("ts"), "value"
    )


def count_window_short(spark, sf):
    """A slide longer than the window: some samples belong to no firing."""
    return windows.count_window(samples(spark, sf, "user_id"), size=5, slide=7).select(
        "signame", "k", "pos", stamp("ts").alias("ts"), "value"
    )


def _collected(df):
    cents = F.transform("ecg", lambda x: F.round(x * 100).cast("bigint").cast("string"))
    return df.select(
        "signame", "k", F.size("ecg").cast("bigint").alias("n"),
        stamp(F.element_at("times", 1)).alias("first_ts"), stamp(F.element_at("times", -1)).alias("last_ts"),
        F.array_join(cents, ",").alias("cents"),
    )


def window_collect(spark, sf):
    return _collected(windows.window_collect(windows.count_window(samples(spark, sf), **LONG)))


def count_window_stream(spark, sf):
    return _collected(streams.windows_of(samples(spark, sf), **LONG))


# --- detection ---------------------------------------------------------------


def r_peaks(spark, sf):
    return detection.r_peaks(_firings(spark, sf))


def min_peaks_gate(spark, sf):
    return detection.min_peaks_gate(_firings(spark, sf)).select(
        "signame", "k", F.size("peaks").cast("bigint").alias("n_peaks")
    )


def beat_segments(spark, sf):
    return _segments(spark, sf).select(
        "signame", "k", "seg", "start", "len", "abs_start", "abs_end",
        F.element_at("ecg", 1).alias("opening"), F.element_at("ecg", -1).alias("closing"),
    )


def teager_energy(spark, sf):
    return (
        detection.teager_energy(_segments(spark, sf))
        .select("signame", "k", "seg", F.posexplode("psi").alias("j", "psi"))
        .select("signame", "k", "seg", F.col("j").cast("bigint").alias("j"), steady("psi").alias("psi"))
    )


def avg_teager(spark, sf):
    return detection.avg_teager(_segments(spark, sf)).select("signame", "k", "seg", steady("avg_te").alias("avg_te"))


def rr_interval(spark, sf):
    return detection.rr_interval(_segments(spark, sf)).select("signame", "k", "seg", "len", steady("rr").alias("rr"))


def beat_timestamp(spark, sf):
    return detection.beat_timestamp(_segments(spark, sf)).select("signame", "k", "seg", stamp("time").alias("time"))


def beat_timestamp_peak(spark, sf):
    return detection.beat_timestamp(_segments(spark, sf), "peak").select(
        "signame", "k", "seg", stamp("time").alias("time")
    )


def classify_beat(spark, sf):
    return detection.classify_beat(_scored(spark, sf)).select("signame", "k", "seg", "abnormal")


def detect_anomalies(spark, sf):
    return _anomaly_report(_anomalies(spark, sf))


def detect_anomalies_wide(spark, sf):
    return _anomaly_report(_wide_anomalies(spark, sf))


def detect_anomalies_ranged(spark, sf):
    return _anomaly_report(_anomalies(spark, sf, task_rows=500))


def detect_anomalies_dedup(spark, sf):
    return _anomaly_report(_anomalies(spark, sf, dedup=True))


def anomaly_rows(spark, sf):
    return detection.anomaly_rows(_anomalies(spark, sf)).select(
        "signame", stamp("time").alias("time"), F.posexplode("ecg").alias("x", "y"), "abnormal"
    ).withColumn("x", F.col("x").cast("bigint"))


def _stored(df):
    return df.select(
        "signame", stamp("time").alias("time"), F.size("ecg").cast("bigint").alias("n"),
        F.element_at("ecg", 1).alias("opening"), F.element_at("ecg", -1).alias("closing"), "abnormal",
    )


def detect_stream(spark, sf):
    return _stored(streams.anomalies_of(samples(spark, sf), "state", **LONG))


def detect_stream_carry(spark, sf):
    return _stored(streams.anomalies_of(samples(spark, sf), "carry", **LONG))


def detect_stream_dedup(spark, sf):
    """Three runs of a stream; a beat that firings of two of them hold is reported once."""
    rows = samples(spark, sf)
    return _stored(streams.anomalies_of(rows, "carry", parts=streams.by_time(rows, 3), dedup=True, **LONG))


def _late_stream(spark, sf):
    """Three runs with samples out of order, a day of delay, and some samples far behind."""
    rows, late = samples(spark, sf), scratch_path(spark, "late")
    parts = streams.out_of_order(rows, 86_400_000_000)
    return streams.anomalies_of(rows, "carry", parts=parts, late=late, delay="1 day", **LONG), late


def detect_stream_ordered(spark, sf):
    return _stored(_late_stream(spark, sf)[0])


def late_samples(spark, sf):
    late = read_late(spark, _late_stream(spark, sf)[1])
    return late.select("signame", stamp("ts").alias("ts"), "tie", "value")


def _topic(spark, sf):
    """Messages with their offset and day; of every 50, one has no number, one no time of day and one too few fields."""
    place = F.col("tie") % 50
    time = F.when(place == 1, "25:61").otherwise(clock_text(F.col("ts")))
    number = F.when(place == 0, "-").otherwise(F.col("value").cast("string"))
    text = F.when(place == 2, F.col("signame")).otherwise(F.concat_ws(",", "signame", time, number))
    return samples(spark, sf).select(
        text.cast("binary").alias("value"), F.col("tie").alias("offset"), F.to_date("ts").alias("day"), "ts"
    )


def detect_messages(spark, sf):
    table = scratch_path(spark, "table")
    streams.messages_of(_topic(spark, sf), table, scratch_path(spark, "refused"), **LONG)
    return _stored(signal_table.read_signal_samples(spark, table))


def refused_messages(spark, sf):
    refused = scratch_path(spark, "refused")
    streams.messages_of(_topic(spark, sf), scratch_path(spark, "table"), refused, **LONG)
    return read_refused_messages(spark, refused).select("offset", F.col("message").cast("string").alias("message"), "reason")


# --- sinks -------------------------------------------------------------------


def sink_signal_samples(spark, sf):
    path = scratch_path(spark, "table")
    signal_table.sink_signal_samples(_anomalies(spark, sf), path)
    return _stored(signal_table.read_signal_samples(spark, path))


def sink_append_twice(spark, sf):
    """Two batch writers, one of which repeats its batch, and two streams on one table."""
    path = scratch_path(spark, "table")
    found = _anomalies(spark, sf)
    signal_table.sink_signal_samples(found, path)
    for _ in range(2):
        signal_table.sink_signal_samples(found, path, writer="second", batch=0)
    for _ in range(2):
        streams.anomalies_of(samples(spark, sf), "carry", table=path, **LONG)
    return _stored(signal_table.read_signal_samples(spark, path)).withColumn(
        "ids", F.lit(signal_table.read_signal_samples(spark, path).select("id").distinct().count())
    )


def sink_unique_append(spark, sf):
    """Two writers whose beats are stamped in two ways, on a table where (signame, time) is unique; one repeats its batch."""
    path = scratch_path(spark, "table")
    for mode, times in (("reference", 1), ("peak", 2)):
        found = _anomalies(spark, sf, time_mode=mode)
        for _ in range(times):
            signal_table.sink_signal_samples(found, path, writer=mode, unique=("k", "seg"))
    return _stored(signal_table.read_signal_samples(spark, path))


def parse_array_text(spark, sf):
    text = F.concat(F.lit("["), F.col("value").cast("string"), F.lit(", "), F.col("user_id").cast("string"), F.lit("]"))
    return events(spark, sf).select("event_id", F.posexplode(arrays.parse_array_text(text)).alias("x", "y")).withColumn(
        "x", F.col("x").cast("bigint")
    )


def assign_id(spark, sf):
    return signal_table.assign_id(_wide_anomalies(spark, sf)).select("id", "signame", "k", "seg")


def assign_id_appends(spark, sf):
    """Three appends, one of them replayed: ids count on."""
    found, ledger = _wide_anomalies(spark, sf), scratch_path(spark, "ledger")
    parts = [found.where(F.col("k") % 3 == i) for i in range(3)]
    numbered = [signal_table.assign_next_ids(parts[i], ledger, "one", i) for i in (0, 1, 1, 2)]
    return numbered[0].unionByName(numbered[2]).unionByName(numbered[3]).select("id", "signame", "k", "seg")


def ecg_signal_stored(spark, sf):
    """A waveform by its id alone from the stored table: the newest abnormal beat's."""
    path = scratch_path(spark, "table")
    found = signal_table.assign_next_ids(_anomalies(spark, sf), scratch_path(spark, "ledger"), "one")
    signal_table.sink_signal_samples(found, path, "one")
    table = signal_table.read_signal_samples(spark, path)
    last = table.agg(F.max("id")).first()[0] or 0
    return serving.ecg_signal(table, last).select(F.posexplode("ecg").alias("x", "y")).withColumn("x", F.col("x").cast("bigint"))


def time_chunk(spark, sf):
    return signal_table.time_chunk(_table(spark, sf)).select("id", stamp("chunk").alias("chunk"))


def unique_signal_time(spark, sf):
    return signal_table.unique_signal_time(_table(spark, sf)).select("id", "signame", stamp("time").alias("time"))


# --- signal functions --------------------------------------------------------


def find_peaks(spark, sf):
    return peaks.find_peaks(_indexed(spark, sf), 5, 0.75, ["signame"]).select("signame", "pos", "value")


def find_peaks_long(spark, sf):
    """Long signals cut into chunks smaller than the signal."""
    return peaks.find_peaks(_indexed(spark, sf, "event_type"), 50, 0.75, ["signame"], chunk=512).select(
        "signame", "pos", "value"
    )


def find_peaks_relative(spark, sf):
    return peaks.find_peaks(_indexed(spark, sf), 3, 0.7512345, ["signame"], relative=True).select(
        "signame", "pos", "value"
    )


def find_peaks_decay(spark, sf):
    return peaks.find_peaks(vector_rows(spark, sf), 2, 0.01, ["vec_id"], decay=0.95).select(
        "vec_id", "pos", steady("value").alias("value")
    )


def over_threshold(spark, sf):
    return peaks.over_threshold(_indexed(spark, sf), 3, 0.7512345, ["signame"], relative=True).select(
        "signame", "pos", "value"
    )


def exp_decay_hold(spark, sf):
    return peaks.exp_decay_hold(vector_rows(spark, sf), 0.95, ["vec_id"]).select(
        "vec_id", "pos", steady("av").alias("av")
    )


def exp_decay_hold_chunked(spark, sf):
    """The same recurrence with each vector split over several chunk levels."""
    return peaks.exp_decay_hold(vector_rows(spark, sf), 0.95, ["vec_id"], fold=4).select(
        "vec_id", "pos", steady("av").alias("av")
    )


def top_n_peaks(spark, sf):
    return peaks.top_n_peaks(_indexed(spark, sf), 3, 2, ["signame"]).select("signame", "rank", "pos", "value")


def normalise(spark, sf):
    return shape.normalise(vector_rows(spark, sf), ["vec_id"]).select("vec_id", "pos", steady("value").alias("value"))


def rolling_slope(spark, sf):
    return shape.rolling_slope(_indexed(spark, sf), 7, ["signame"], hop=1 / 360).select(
        "signame", "pos", steady("slope", 4).alias("slope")
    )


def array_min(spark, sf):
    return vectors(spark, sf).select("vec_id", arrays.arr_min(F.col("xs")).alias("array_min"))


def array_max(spark, sf):
    return vectors(spark, sf).select("vec_id", arrays.arr_max(F.col("xs")).alias("array_max"))


def arg_min(spark, sf):
    return vectors(spark, sf).select("vec_id", arrays.arg_min(F.col("xs")).alias("arg_min"))


def arg_max(spark, sf):
    return vectors(spark, sf).select("vec_id", arrays.arg_max(F.col("xs")).alias("arg_max"))


def extremes(spark, sf):
    return shape.extremes(_indexed(spark, sf, "event_type"), ["signame"])


# --- serving -----------------------------------------------------------------


def _event(df):
    return df.withColumn("time", stamp("time"))


def ecg_signal(spark, sf):
    return serving.ecg_signal(_table(spark, sf), 10).select(F.explode("ecg").alias("y"))


def latest_events(spark, sf):
    return _event(serving.latest_events(event_table(spark, sf), "007"))


def latest_events_stored(spark, sf):
    """All of one signal's abnormal beats in the table that detection filled, without a report's limit."""
    path = scratch_path(spark, "table")
    signal_table.sink_signal_samples(_anomalies(spark, sf), path)
    table = signal_table.read_signal_samples(spark, path)
    found = table.where((F.col("signame") == "error") & (F.col("abnormal") == "TRUE"))
    return _event(found).select("signame", "time", "abnormal")


def _reports(spark, sf):
    """Summaries that a stream kept up over three runs."""
    rows, reports = samples(spark, sf), scratch_path(spark, "reports")
    streams.anomalies_of(rows, "carry", parts=streams.by_time(rows, 3), reports=reports, report_seconds=86_400, **LONG)
    return reports


def latest_events_kept(spark, sf):
    table = newest_rows(spark, _reports(spark, sf))
    return _event(serving.latest_events(table, "error")).select("signame", "time", "abnormal")


def recent_events_kept(spark, sf):
    table = recent_rows(spark, _reports(spark, sf))
    return _event(serving.recent_events(table, 86_400)).select("signame", "time", "abnormal")


def recent_events(spark, sf):
    return _event(serving.recent_events(event_table(spark, sf), 86_400))


def events_view_all(spark, sf):
    return _event(serving.events_view(event_table(spark, sf), None))


def events_view_name(spark, sf):
    return _event(serving.events_view(event_table(spark, sf), "003"))


def signal_trace(spark, sf):
    return serving.signal_trace(_table(spark, sf), 10).withColumn("x", F.col("x").cast("bigint"))


def signal_names(spark, sf):
    return serving.signal_names(event_table(spark, sf))


def record_manifest_skip_first(spark, sf):
    return record_manifest(spark, sf, skip_first=True)


def all_queries() -> dict[str, Query]:
    """Every public function of this module, by name."""
    return {
        name: item
        for name, item in globals().items()
        if callable(item) and getattr(item, "__module__", None) == __name__ and not name.startswith("_") and name != "all_queries"
    }
