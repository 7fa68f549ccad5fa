"""Summaries of the stored table that a writer keeps up batch by batch, for reports that are polled.

A summary has each signal's newest abnormal beats and all rows of the last
seconds, so ``latest_events`` and ``recent_events`` read it in place of the
table and its size does not grow with the table's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatline.plans.serving import EVENT, RECENT_SECONDS, REPORT_ROWS
from beatline.runtime import exists, remove
from beatline.schemas import SIGNAL_SAMPLES
from beatline.sinks.signal_table import read_batch

_SCHEMA = T.StructType([
    *[SIGNAL_SAMPLES[c] for c in EVENT],
    T.StructField("writer", T.StringType()),
    T.StructField("batch", T.LongType()),
    T.StructField("kind", T.StringType()),
])


def update_reports(
    spark: SparkSession, table: str, reports: str, writer: str, batch: int, rows: int = REPORT_ROWS, seconds: int = RECENT_SECONDS
) -> None:
    """Merge a stored batch into its writer's summary.

    Reads the batch's own folder and the summary of the batch before, nothing
    else, and writes ``writer=<writer>/batch=<batch>``; a replay does the same
    again. Summaries but the last two are removed. Batches count 0, 1, 2, ….
    """
    own = f"{reports.rstrip('/')}/writer={writer}"
    new = read_batch(spark, table, writer, batch).select(*EVENT)
    newest = recent = new
    if batch and exists(spark, f"{own}/batch={batch - 1}"):
        old = spark.read.schema(_SCHEMA).option("basePath", reports).parquet(f"{own}/batch={batch - 1}")
        newest, recent = (new.unionByName(old.where(F.col("kind") == k).select(*EVENT)) for k in ("newest", "recent"))
    place = Window.partitionBy("signame").orderBy(F.desc("time"), F.desc("id"))
    newest = newest.where("abnormal = 'TRUE'").withColumn("__n", F.row_number().over(place)).where(F.col("__n") <= rows).drop("__n")
    since = recent.agg((F.max("time") - F.expr(f"interval {seconds} seconds")).alias("since")).scalar()
    both = newest.withColumn("kind", F.lit("newest")).unionByName(recent.where(F.col("time") > since).withColumn("kind", F.lit("recent")))
    both.repartition("kind").sortWithinPartitions("kind", "signame", "time").write.mode("overwrite").partitionBy("kind").parquet(
        f"{own}/batch={batch}"
    )
    if batch > 1:
        remove(spark, f"{own}/batch={batch - 2}")


def _kept(spark: SparkSession, reports: str, kind: str) -> DataFrame:
    """The rows of every writer's newest summary; summaries of several writers are simply read together."""
    held = spark.read.schema(_SCHEMA).parquet(reports).where(F.col("kind") == kind)
    last = held.groupBy(F.col("writer").alias("__w")).agg(F.max("batch").alias("__b"))
    return held.join(last, (F.col("writer") == F.col("__w")) & (F.col("batch") == F.col("__b"))).select(*EVENT)


def newest_rows(spark: SparkSession, reports: str) -> DataFrame:
    """A table for ``latest_events``, of at most as many rows a signal and writer as summaries keep."""
    return _kept(spark, reports, "newest")


def recent_rows(spark: SparkSession, reports: str) -> DataFrame:
    """A table for ``recent_events``, of the last seconds that summaries keep."""
    return _kept(spark, reports, "recent")
