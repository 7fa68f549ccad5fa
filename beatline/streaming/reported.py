"""Beats a stream has reported, so that a later micro-batch does not report them again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatline.operators.windows import SIZE, SLIDE
from beatline.plans.detection import drop_repeats
from beatline.streaming.folders import COMPACT, BatchFolders


class ReportedBeats:
    """Keeps each beat's first report over all micro-batches, as ``dedup`` does over a table.

    Firings of a signal count on, so a beat is known by its signal and the
    positions of its two peaks. Later firings begin later: only beats that a
    next firing can still hold are kept when folders are gathered.
    """

    def __init__(
        self, spark: SparkSession, path: str, size: int = SIZE, slide: int = SLIDE, key: str = "signame", compact: int = COMPACT
    ):
        self.size, self.slide, self.key = size, slide, key
        schema = T.StructType([
            T.StructField(key, T.StringType()),
            T.StructField("abs_start", T.LongType()),
            T.StructField("abs_end", T.LongType()),
            T.StructField("k", T.LongType()),
        ])
        self.folders = BatchFolders(spark, path, schema, compact)

    def _needed(self, beats: DataFrame) -> DataFrame:
        newest = beats.groupBy(self.key).agg(F.max("k").alias("__k")).withColumnRenamed(self.key, "__key")
        joined = beats.join(newest, F.col(self.key).eqNullSafe(F.col("__key")))
        return joined.where(F.col("abs_start") >= F.col("__k") * self.slide - self.size).drop("__k", "__key")

    def next(self, found: DataFrame, batch: int) -> DataFrame:
        """Of the beats that micro-batch ``batch`` found, those not reported before."""
        known = self.folders.before(batch, self._needed).select(
            *[F.col(c).alias(f"__{c}") for c in (self.key, "abs_start", "abs_end")]
        )
        first = drop_repeats(found, self.key)
        self.folders.write(first, batch)
        same = F.lit(True)
        for c in (self.key, "abs_start", "abs_end"):
            same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
        return first.join(known, same, "left_anti")
