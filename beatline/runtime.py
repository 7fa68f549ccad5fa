"""Session facts the operators need: shared scratch space and group sizes."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows one task may sort on its own; larger groups take the split path.
TASK_ROWS = 2_000_000

# Most partitions one shuffle is asked for; its block count is their square.
MOST_PARTITIONS = 32_768

# Partitions that tasks of any size may ask for, and rows that a task has at
# least where there are more: each partition costs the driver a task's result
# and, if dealt by ranges, 300 sampled keys.
SMALL_PARTITIONS, LEAST_ROWS = 2_048, 20_000

# Rows of helper table (a few longs each) that may be broadcast.
BROADCAST_ROWS = 200_000


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, from ``spark.checkpoint.dir``.

    Only a local session may run without that setting; it then gets a fresh
    temporary folder, which a cluster's executors could not share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    root = context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="beatline-"))
        root = context.getCheckpointDir()
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the scratch root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back, so later plans see one fixed result."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own, on whatever file system holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def ship(spark: SparkSession) -> None:
    """Give the package to Python workers, which need not have it installed; once per session.

    The archive lies in the shared scratch folder, where any executor finds it.
    """
    context = spark.sparkContext
    if getattr(context, "_beatline_shipped", False):
        return
    root, buffer = Path(__file__).parent, io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, Path("beatline") / file.relative_to(root))
    path = f"{scratch_path(spark, 'beatline')}.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(target)
    stream.write(bytearray(buffer.getvalue()))
    stream.close()
    context.addPyFile(path)
    context._beatline_shipped = True


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, on whatever file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(target)


@dataclass(frozen=True)
class GroupLoad:
    """Row counts that decide how a grouped operator is laid out."""

    rows: int
    groups: int
    largest: int

    def fits_task(self, limit: int) -> bool:
        return self.largest <= limit

    def balanced(self, parallelism: int) -> bool:
        """No group outweighs twice an even share of the work."""
        return self.largest * parallelism <= 2 * self.rows


def group_load(df: DataFrame, keys: list[str]) -> GroupLoad:
    """Count rows per key: one narrow scan, partially aggregated before its shuffle."""
    row = (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(F.sum("n"), F.count("*"), F.max("n"))
        .first()
    )
    return GroupLoad(int(row[0] or 0), int(row[1]), int(row[2] or 0))


def partitions_for(spark: SparkSession, rows: int, task_rows: int = TASK_ROWS) -> int:
    """Shuffle width for ``rows``: the session's setting, or more where that is too narrow.

    Tasks of fewer than LEAST_ROWS rows are given up before there are more than
    SMALL_PARTITIONS of them.
    """
    wanted = -(-rows // task_rows)
    if wanted > SMALL_PARTITIONS:
        wanted = max(SMALL_PARTITIONS, -(-rows // max(task_rows, LEAST_ROWS)))
    wanted = min(wanted, MOST_PARTITIONS)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)


def spread_by(df: DataFrame, columns: list[str], rows: int | None = None, task_rows: int = TASK_ROWS) -> DataFrame:
    """Hash partition by ``columns``, wider than the session's setting for many ``rows``.

    Without a need for more partitions the width is left to adaptive execution.
    """
    spark = df.sparkSession
    wide = partitions_for(spark, rows or 0, task_rows)
    if wide > int(spark.conf.get("spark.sql.shuffle.partitions")):
        return df.repartition(wide, *columns)
    return df.repartition(*columns)
