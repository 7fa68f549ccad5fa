"""Dense 0-based positions per key, without sorting one key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatline.runtime import (
    BROADCAST_ROWS,
    TASK_ROWS,
    GroupLoad,
    group_load,
    partitions_for,
    store,
)

# monotonically_increasing_id keeps the row number in its low 33 bits.
_ROW_BITS = 33


def dense_index(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    idx: str = "idx",
    task_rows: int = TASK_ROWS,
    load: GroupLoad | None = None,
) -> DataFrame:
    """Number the rows of each key 0, 1, 2, … in ``order``.

    ``keys`` may be empty for one numbering of the whole table. ``order`` must
    be total within a key for the result to be reproducible.

    While every key fits ``task_rows`` this is a window function. Beyond that
    the table is range partitioned on (keys, order), so that a dominant key is
    spread over many tasks, and each partition's numbering is shifted by the
    number of the key's rows before it.
    """
    load = load or group_load(df, keys)
    if load.fits_task(task_rows):
        return _by_window(df, keys, order, idx)
    return _by_range(df, keys, order, idx, task_rows, load)


def _by_window(df, keys, order, idx) -> DataFrame:
    rows = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(idx, F.row_number().over(rows).cast("long") - 1)


def _by_range(df, keys, order, idx, task_rows, load) -> DataFrame:
    parts = partitions_for(df.sparkSession, load.rows, task_rows)
    # The partition and row number are only meaningful once fixed, so the sorted
    # table is written before anything is derived from them.
    ranged = store(
        df.repartitionByRange(parts, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("__row", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftright("__row", _ROW_BITS)),
        "ranged",
    )
    per_part = ranged.groupBy(*keys, "__part").agg(
        F.count("*").alias("__n"), F.min("__row").alias("__first")
    )
    # At most one row per range partition and key: tiny even for a dominant key.
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shift = per_part.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        F.col("__part").alias("__p"),
        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
    )
    # Each boundary splits at most one key, which bounds the helper's rows.
    if load.groups + parts <= BROADCAST_ROWS:
        shift = F.broadcast(shift)
    on: Column = F.col("__part") == F.col("__p")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    return ranged.join(shift, on).select(*df.columns, (F.col("__row") + F.col("__shift")).alias(idx))
