"""Samples of a stream in event-time order, within a delay; later ones are set aside.

Spark's event-time timers would drop late samples unseen and hold a signal's
buffer in one task. Here the buffer is a table, so that a signal of any size is
many tasks, and late samples can be stored and counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatline.runtime import remove
from beatline.schemas import SAMPLES


class Reorder:
    """Releases samples once the watermark has passed them.

    The watermark is the newest event time seen less ``delay``, over all signals.
    A micro-batch releases the samples, new or held, that its watermark has
    passed; each batch begins after all that was released before, so samples that
    are at most ``delay`` behind leave in (ts, tie) order over all batches. A
    sample not after the watermark of the batch before, or without a time, is
    late. What was not released when a stream stops is held for its next run.

    A batch reads what the one before it left and replaces its own folders, so
    replays do not change the result; batches count 0, 1, 2, ….
    """

    def __init__(self, spark: SparkSession, path: str, delay: str):
        self.spark, self.path, self.delay = spark, path.rstrip("/"), delay

    def _marks(self, batch: int) -> tuple[str | None, str | None]:
        """(newest event time, watermark) after ``batch``, as text."""
        if batch < 0:
            return None, None
        row = self.spark.read.schema("newest string, passed string").parquet(f"{self.path}/marks/batch={batch}").first()
        return row.newest, row.passed

    def next(self, samples: DataFrame, batch: int) -> tuple[DataFrame, DataFrame]:
        """(samples to handle now, late samples) of micro-batch ``batch``; both keep the columns of SAMPLES."""
        rows = samples.select(*SAMPLES.fieldNames())
        newest, passed = self._marks(batch - 1)
        known = F.greatest(F.max("ts"), F.lit(newest).cast("timestamp_ntz"))
        marks = rows.agg(known.alias("newest")).select(
            F.col("newest").cast("string").alias("newest"),
            (F.col("newest") - F.expr(f"interval {self.delay}")).cast("string").alias("passed"),
        )
        marks.write.mode("overwrite").parquet(f"{self.path}/marks/batch={batch}")
        _, passing = self._marks(batch)

        before, now = (F.lit(x).cast("timestamp_ntz") for x in (passed, passing))
        late = F.col("ts").isNull() | F.coalesce(F.col("ts") <= before, F.lit(False))
        waiting = rows.where(~late)
        if batch:
            waiting = waiting.unionByName(self.spark.read.schema(SAMPLES).parquet(f"{self.path}/held/batch={batch - 1}"))
        ready = F.coalesce(F.col("ts") <= now, F.lit(False))
        waiting.where(~ready).write.mode("overwrite").parquet(f"{self.path}/held/batch={batch}")
        if batch > 1:
            remove(self.spark, f"{self.path}/held/batch={batch - 2}")
        return waiting.where(ready), rows.where(late)
