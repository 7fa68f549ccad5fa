"""The live job: samples or messages in, abnormal beats appended to the table."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from beatline.operators.windows import SIZE, SLIDE
from beatline.plans.detection import detect_in_windows
from beatline.plans.serving import RECENT_SECONDS
from beatline.schemas import REFUSED_MESSAGES, SAMPLES
from beatline.sinks.reports import update_reports
from beatline.sinks.side_tables import read_aside, sink_aside
from beatline.sinks.signal_table import sink_signal_samples, stable_id
from beatline.sources.messages import judge_messages
from beatline.streaming.order import Reorder
from beatline.streaming.reported import ReportedBeats
from beatline.streaming.windows import CarryWindows, stateful_windows


Sink = Callable[[DataFrame, str, int], object]

#: Takes a micro-batch, the stream's name and the batch's number; returns the samples to go on with.
Divert = Callable[[DataFrame, str, int], DataFrame]


def detect_stream(
    samples: DataFrame,
    table: str | Sink,
    checkpoint: str,
    size: int = SIZE,
    slide: int = SLIDE,
    front: str = "carry",
    trigger: dict | None = None,
    dedup: bool = False,
    delay: str | None = None,
    late: str | None = None,
    divert: Divert | None = None,
    reports: str | None = None,
    report_seconds: int = RECENT_SECONDS,
    **kw,
) -> StreamingQuery:
    """Start detection on a streaming frame of (signame, ts, tie, value).

    ``front='carry'`` keeps window tails in a table under the checkpoint and
    spreads a signal over many tasks, ``'state'`` keeps them in the state store,
    one task per signal. ``table`` is the stored table's path, or a function
    that takes the beats with their ids, the stream's name and the micro-batch.

    ``dedup`` reports a beat once, by the first firing that holds it, also when
    firings of several micro-batches do. ``delay``, such as "10 minutes", takes
    samples in the order of event time (see ``Reorder``); later ones are stored
    at ``late``, by default under the checkpoint, for ``read_late``. Without it
    samples count in the order of their arrival. ``delay`` and ``divert`` need
    ``front='carry'``. ``reports`` is a folder of summaries that each batch
    brings up to date, for ``newest_rows`` and ``recent_rows``; it needs a
    table's path.

    The stream's name is made with its checkpoint and is part of folders and
    ids. A batch replayed after a failure replaces its rows instead of repeating
    them, and a stream with a new checkpoint only adds to the table.
    """
    if front not in ("state", "carry"):
        raise ValueError("front is 'state' or 'carry'")
    if front == "state" and (delay or divert):
        raise ValueError("samples are only ordered or diverted with front='carry'")
    if reports and callable(table):
        raise ValueError("reports are made from a stored table")
    spark = samples.sparkSession

    def append(rows: DataFrame, writer: str, batch: int) -> None:
        sink_signal_samples(rows, table, writer, batch)
        if reports:
            update_reports(spark, table, reports, writer, batch, seconds=report_seconds)

    sink = table if callable(table) else append
    reported = ReportedBeats(spark, f"{checkpoint}/beats", size, slide) if dedup else None

    def name() -> str:
        said = spark.read.text(f"{checkpoint}/query/metadata").first()[0]
        return json.loads(said)["id"]

    def store(windows: DataFrame, batch: int) -> None:
        writer = name()
        found = detect_in_windows(windows, size, slide, **kw)
        if reported is None:
            sink(stable_id(found, writer=writer), writer, batch)
            return
        found = found.persist()
        try:
            sink(stable_id(reported.next(found, batch), writer=writer), writer, batch)
        finally:
            found.unpersist()

    if front == "state":
        frame = stateful_windows(samples, size, slide)
        handle = store
    else:
        frame = samples
        carry = CarryWindows(spark, f"{checkpoint}/tails", size, slide)
        order = Reorder(spark, f"{checkpoint}/order", delay) if delay else None

        def handle(rows: DataFrame, batch: int) -> None:
            rows = rows.persist()
            try:
                taken = divert(rows, name(), batch) if divert else rows
                if order:
                    taken, behind = order.next(taken, batch)
                    sink_aside(behind, late or late_path(checkpoint), name(), batch)
                store(carry.next(taken, batch), batch)
            finally:
                rows.unpersist()

    return (
        frame.writeStream.option("checkpointLocation", f"{checkpoint}/query")
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(handle)
        .start()
    )


def late_path(checkpoint: str) -> str:
    return f"{checkpoint}/late"


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """Samples that came after the delay, with the stream's name as ``writer`` and the micro-batch."""
    return read_aside(spark, path, SAMPLES)


def detect_messages(
    messages: DataFrame,
    table: str | Sink,
    refused: str,
    checkpoint: str,
    date: str | Column | None = None,
    offset: str = "offset",
    keep: tuple[str, ...] = (),
    lenient: bool = False,
    **kw,
) -> StreamingQuery:
    """Start detection on a streaming frame of raw messages; a bad one stops nothing.

    A micro-batch is read and parsed once. Its samples go through
    ``detect_stream``, whose further arguments are taken; its other messages are
    stored at ``refused`` with offset and reason, once per batch, for
    ``read_refused_messages``. ``date`` is the day of the times, by default the
    current one; columns it is made of are named in ``keep``. Samples of equal
    time are in the order of ``offset``.
    """
    day = F.current_date() if date is None else date
    judged = judge_messages(messages, day, keep=(offset, *keep), lenient=lenient).withColumnRenamed(offset, "tie")

    def apart(rows: DataFrame, writer: str, batch: int) -> DataFrame:
        bad = rows.where("reason is not null")
        sink_aside(bad.select("message", F.col("tie").cast("long").alias("offset"), "reason"), refused, writer, batch)
        return rows.where("reason is null")

    return detect_stream(judged, table, checkpoint, divert=apart, **kw)


def read_refused_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages that are no samples: message, offset, reason, and the writer and batch that met them."""
    return read_aside(spark, path, REFUSED_MESSAGES)


def windows_stream(
    samples: DataFrame, path: str, checkpoint: str, size: int = SIZE, slide: int = SLIDE, trigger: dict | None = None
) -> StreamingQuery:
    """Start writing the firings themselves to Parquet, exactly once."""
    return (
        stateful_windows(samples, size, slide)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
