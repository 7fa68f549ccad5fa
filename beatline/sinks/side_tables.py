"""Rows a live job sets aside: refused messages, late samples.

A micro-batch owns the folder ``writer=<writer>/batch=<batch>`` and replaces it
when it is written again, so a replay adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def sink_aside(rows: DataFrame, path: str, writer: str, batch: int) -> None:
    """Store a micro-batch's rows; a batch without rows leaves an empty folder."""
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/writer={writer}/batch={batch}")


def read_aside(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows set aside at ``path``, with their writer and batch."""
    whole = T.StructType([*schema.fields, T.StructField("writer", T.StringType()), T.StructField("batch", T.LongType())])
    return spark.read.schema(whole).parquet(path)
