"""Streaming queries over the driver's tables.

Samples are written to a folder in slices and the stream is run to completion
after each, so every run restarts from the checkpoint of the one before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatline.runtime import scratch_path
from beatline.sinks.signal_table import read_signal_samples
from beatline.sources.messages import source_stream
from beatline.streaming.detection import detect_messages, detect_stream, windows_stream


def _bounds(samples: DataFrame, parts: int) -> list[Column]:
    """Whole milliseconds that cut the samples' span into equal parts, in microseconds."""
    first, last = samples.agg(F.min(_micros()), F.max(_micros())).first()
    if first is None:
        return []
    return [F.lit((first + (last - first) * k // parts) // 1000 * 1000) for k in range(1, parts)]


def _micros(ts: str = "ts") -> Column:
    return F.unix_micros(F.to_timestamp(ts))


def by_time(samples: DataFrame, parts: int = 2) -> list[DataFrame]:
    """Consecutive parts of the samples' span."""
    cuts = _bounds(samples, parts)
    if not cuts:
        return [samples]
    edges = [None, *cuts, None]
    return [
        samples.where((F.lit(True) if a is None else _micros() >= a) & (F.lit(True) if b is None else _micros() < b))
        for a, b in zip(edges, edges[1:])
    ]


def out_of_order(samples: DataFrame, delay_micros: int) -> list[DataFrame]:
    """Three parts by time; of the first, some of the last ``delay_micros`` come with the second, a few others with the third."""
    cuts = _bounds(samples, 3)
    if not cuts:
        return [samples]
    one, two = cuts
    near = _micros() >= one - delay_micros
    part = F.when(_micros() >= two, 3).when(_micros() >= one, 2).when(near & (F.col("tie") % 3 == 0), 2).when(
        ~near & (F.col("tie") % 97 == 0), 3
    ).otherwise(1)
    return [samples.where(part == k) for k in (1, 2, 3)]


def in_slices(samples: DataFrame, run: Callable[[DataFrame], object], parts: list[DataFrame] | None = None) -> None:
    """Feed ``parts``, by default two by time, to ``run`` as a growing folder, one run of the stream for each."""
    spark = samples.sparkSession
    folder = scratch_path(spark, "arrivals")
    for part in parts or by_time(samples):
        part.write.mode("append").parquet(folder)
        run(source_stream(spark, "parquet", folder, part.schema)).awaitTermination()


def windows_of(samples: DataFrame, size: int, slide: int) -> DataFrame:
    spark = samples.sparkSession
    out, check = scratch_path(spark, "firings"), scratch_path(spark, "check")
    in_slices(samples, lambda stream: windows_stream(stream, out, check, size, slide))
    return spark.read.parquet(out)


def anomalies_of(
    samples: DataFrame, front: str, table: str | None = None, parts: list[DataFrame] | None = None, late: str | None = None, **kw
) -> DataFrame:
    spark = samples.sparkSession
    table, check = table or scratch_path(spark, "table"), scratch_path(spark, "check")
    in_slices(samples, lambda stream: detect_stream(stream, table, check, front=front, late=late, **kw), parts)
    return read_signal_samples(spark, table)


def messages_of(sent: DataFrame, table: str, refused: str, **kw) -> None:
    """Detection on a topic of messages (value, offset, day), in two runs of the stream."""
    check = scratch_path(sent.sparkSession, "check")

    def run(stream: DataFrame) -> object:
        return detect_messages(stream, table, refused, check, F.col("day"), keep=("day",), **kw)

    in_slices(sent, run, by_time(sent))
