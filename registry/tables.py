"""The driver's tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatline.functions.times import stamp_text

# Narrow keys: five long signals, the method's own settings.
LONG = dict(size=576, slide=288)
# Wide keys: many short signals, settings scaled to their length.
SHORT = dict(size=32, slide=16)
SHORT_BEATS = dict(width=5, rr_floor=10 / 360)


def events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet")


def samples(spark: SparkSession, sf: str, key: str = "event_type") -> DataFrame:
    return events(spark, sf).select(
        F.col(key).cast("string").alias("signame"), "ts", F.col("event_id").alias("tie"), "value"
    )


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as arrays of doubles."""
    return spark.read.parquet(f"{sf}/embeddings.parquet").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("xs")
    )


def vector_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as (vec_id, pos, value)."""
    return vectors(spark, sf).select("vec_id", F.posexplode("xs").alias("pos", "value")).withColumn(
        "pos", F.col("pos").cast("long")
    )


def event_table(spark: SparkSession, sf: str) -> DataFrame:
    """Events in the shape of the stored table."""
    return events(spark, sf).select(
        F.col("event_id").alias("id"),
        F.format_string("%03d", "user_id").alias("signame"),
        F.col("ts").alias("time"),
        F.array("value").alias("ecg"),
        F.when(F.col("event_type") == "error", "TRUE").otherwise("FALSE").alias("abnormal"),
    )


def steady(x: str, digits: int = 6):
    """Round for comparison. The odd offset keeps decimal ties off the boundary."""
    scale = 10.0**digits
    return F.floor(F.col(x) * scale + 0.31830988) / scale


def stamp(ts):
    return stamp_text(F.col(ts) if isinstance(ts, str) else ts)
