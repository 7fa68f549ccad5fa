"""Samples as topic messages: stamping, encoding, subscribing, parsing.

One message is the text "<signame>,<HH:mm:ss.SSS>,<value>".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatline.functions.times import clock_text

FS = 360.0
TOPIC = "ecg-topic2"

#: Messages a micro-batch takes from a topic unless the options say otherwise.
BATCH_MESSAGES = 5_000_000


def replay_timestamps(indexed: DataFrame, start: str, fs: float = FS, idx: str = "idx") -> DataFrame:
    """Add event time ``ts`` and its time-of-day text ``time`` from the sample index.

    Sample i is stamped ``start + round(i / fs, 3)`` seconds; the text keeps
    milliseconds.
    """
    seconds = F.round(F.col(idx) / fs, 3).cast(T.DecimalType(18, 6))
    zero = F.lit(0)
    ts = F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)
    return indexed.withColumn("ts", ts).withColumn("time", clock_text(F.col("ts")))


def encode_message(samples: DataFrame, key: str = "signame", time: str = "time", value: str = "value") -> DataFrame:
    """Samples to message bytes. A sample with a missing field is skipped, not fatal."""
    fields = [F.col(c).cast("string") for c in (key, time, value)]
    return samples.select(F.concat(fields[0], F.lit(","), fields[1], F.lit(","), fields[2]).cast("binary").alias("value")).where(
        F.col("value").isNotNull()
    )


def publish(messages: DataFrame, options: dict[str, str], topic: str = TOPIC) -> None:
    """Send messages to a topic. Needs the Kafka connector on the class path."""
    messages.write.format("kafka").options(**options).option("topic", topic).save()


def source_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    path: str | None = None,
    schema: T.StructType | None = None,
    options: dict[str, str] | None = None,
    topic: str = TOPIC,
) -> DataFrame:
    """A streaming frame of messages or samples, read from the earliest record.

    ``fmt='kafka'`` needs the Kafka connector on the class path. Any file format
    with a ``schema`` reads a growing directory instead; downstream is the same.

    A micro-batch takes at most BATCH_MESSAGES of a topic, so a backlog is worked
    off in pieces that keep each partition's order; ``maxOffsetsPerTrigger`` in
    ``options`` overrides it. A directory has no such bound by default, since
    files that arrive together have no order: give ``maxBytesPerTrigger`` where
    files are written in order of time.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("subscribe", topic).option("startingOffsets", "earliest")
        reader = reader.option("maxOffsetsPerTrigger", BATCH_MESSAGES)
    if schema is not None:
        reader = reader.schema(schema)
    reader = reader.options(**(options or {}))
    return reader.load(path) if path else reader.load()


def _once(*columns: Column) -> Column:
    """Columns that are worked out once.

    The one-row generator fixes them; the optimizer would copy plain expressions
    into every later use and every filter above them.
    """
    return F.inline(F.array(F.struct(*columns)))


def _sample(messages: DataFrame, value: str, keep: tuple[str, ...]) -> DataFrame:
    """(signame, time, value, message, *keep); a value that is no number is null, and so is NaN, which would order above every peak."""
    text = F.col(value).cast("string")
    cut = messages.select(*keep, F.col(value).alias("message"), _once(F.split(text, ",").alias("__parts")))
    part = [F.get("__parts", F.lit(i)) for i in range(3)]
    number = F.nanvl(F.trim(part[2]).try_cast("double"), F.lit(None).cast("double"))
    return cut.select(
        _once(part[0].alias("signame"), part[1].alias("time"), number.alias("value")), "message", *keep
    )


def parse_sample(messages: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Message bytes to (signame, time, value); fields after the third are ignored.

    Fails the job on a message with fewer fields or without a number, whichever
    columns are asked for. ``keep`` names further columns to carry along, such
    as a topic's ``offset``.
    """
    parsed = _sample(messages, value, keep)
    good = _or_fail(F.col("value").isNotNull(), "bad sample message: ", F.col("message").cast("string"))
    return parsed.where(good).select("signame", "time", "value", *keep)


def _or_fail(good: Column, complaint: str, text: Column) -> Column:
    """A filter that lets good rows through and fails on others; pruning columns does not remove it."""
    failure = F.raise_error(F.concat(F.lit(complaint), F.coalesce(text, F.lit("null"))))
    return F.when(good, F.lit(True)).otherwise(failure.cast("boolean"))


def parse_sample_quarantine(
    messages: DataFrame, value: str = "value", keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """As ``parse_sample``, but returns (good samples, messages that did not parse)."""
    parsed = _sample(messages, value, keep)
    good = parsed.where(F.col("value").isNotNull()).select("signame", "time", "value", *keep)
    bad = parsed.where(F.col("value").isNull()).select("message", *keep)
    return good, bad


def judge_messages(
    messages: DataFrame, date: str | Column, value: str = "value", keep: tuple[str, ...] = ("offset",), lenient: bool = False
) -> DataFrame:
    """Every message as (signame, time, value, ts, message, *keep, reason), read once.

    ``reason`` is null for a sample, else what is wrong with the message: "no
    value" (fewer than three fields, no number, NaN or no message at all) or "bad
    time of day". ``date`` and ``lenient`` are those of ``event_time``.
    """
    timed = event_time(_sample(messages, value, keep), date, lenient, on_error="null")
    reason = F.when(F.col("value").isNull(), "no value").when(F.col("ts").isNull(), "bad time of day")
    return timed.select("signame", "time", "value", "ts", "message", *keep, reason.alias("reason"))


def event_time(
    samples: DataFrame, date: str | Column, lenient: bool = False, on_error: str = "fail", time: str = "time"
) -> DataFrame:
    """Add ``ts`` from the time-of-day text on the given date.

    ``date`` is a constant, or a column: the current date of a live job, or the
    date of each message. Strict: two-digit fields within their ranges and three
    digits of milliseconds. ``lenient`` lets any field overflow into the next
    and takes the digits after the point as a count of milliseconds. Text of
    another form fails the job, whichever columns are asked for, or leaves
    ``ts`` null with ``on_error="null"``.
    """
    if on_error not in ("fail", "null"):
        raise ValueError("on_error is 'fail' or 'null'")
    text = F.col(time)
    if lenient:
        good = text.rlike(r"^\d+:\d+:\d+\.\d+")
        fields = F.split(text, r"[:.]|(?<=\d)(?=[^\d:.])")
        part = [F.get(fields, F.lit(i)).try_cast("bigint") for i in range(4)]
    else:
        good = text.rlike(r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d\.\d{3}$")
        part = [F.substr(text, F.lit(a), F.lit(n)).try_cast("bigint") for a, n in ((1, 2), (4, 2), (7, 2), (10, 3))]
    millis = ((part[0] * 60 + part[1]) * 60 + part[2]) * 1000 + part[3]
    seconds = (millis / 1000).cast(T.DecimalType(18, 6))
    zero = F.lit(0)
    day = F.lit(date) if isinstance(date, str) else date
    ts = day.cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)
    # A number too long to be one leaves ``ts`` null as well.
    others = [c for c in samples.columns if c != "ts"]
    stamped = samples.select(*others, _once(F.when(good, ts).alias("ts")))
    if on_error == "fail":
        stamped = stamped.where(_or_fail(F.col("ts").isNotNull(), "bad time of day: ", text))
    return stamped
