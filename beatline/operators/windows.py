"""Keying and sliding count windows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatline.operators.indexing import dense_index
from beatline.runtime import TASK_ROWS, group_load, spread_by

SIZE = 576
SLIDE = 288

# A lane holds about this many windows' worth of samples and is the unit of the
# shuffle. Only the samples just before a lane travel twice, 1/LANE of them.
LANE = 16


def rebalance(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread rows evenly, ignoring keys. Row content is unchanged."""
    return df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism)


def key_by(df: DataFrame, key: str = "signame") -> DataFrame:
    """Bring each key's rows into one partition.

    The window operators do not call this: they partition by (key, lane), which
    keeps a dominant key parallel.
    """
    return df.repartition(key)


def watermark(df: DataFrame, column: str = "ts", delay: str | None = None) -> DataFrame:
    """Event-time progress marker.

    Count windows fire on arrival counts, so by default no watermark is emitted
    and the frame passes through. ``delay`` opts in to a bounded-lateness one.
    """
    return df if delay is None else df.withWatermark(column, delay)


def count_window_arrays(
    samples: DataFrame,
    size: int = SIZE,
    slide: int = SLIDE,
    key: str = "signame",
    order: tuple[str, ...] = ("ts", "tie"),
    time: str = "ts",
    value: str = "value",
    idx: str | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Firings of a per-key sliding count window: (key, k, times, ecg).

    Firing k = 1, 2, … happens when a key has k·slide samples and holds its last
    ``size`` of them, so early firings are short and a tail shorter than
    ``slide`` never fires. ``times`` and ``ecg`` are parallel arrays in order.

    ``idx`` names an existing dense 0-based position column, which saves the
    ordering step.

    Samples are packed into blocks of ``slide``, the newest part of exactly one
    firing; a firing is its block joined to the blocks before it. Blocks of a
    key are dealt to lanes, so a dominant key is spread over many tasks and a
    sample crosses the shuffle once whatever ``size / slide`` is.
    """
    if size < 1 or slide < 1:
        raise ValueError("size and slide must be positive")
    cols = [F.col(key), F.col(time).alias("__t"), F.col(value).alias("__x")]
    spread, rows = False, None
    if idx is not None:
        indexed = samples.select(*cols, F.col(idx).cast("long").alias("__i"))
    else:
        load = group_load(samples, [key])
        rows = load.rows
        indexed = dense_index(samples, [key], list(order), "__i", task_rows, load).select(*cols, "__i")
        # Keys already spread evenly over the tasks need no second shuffle.
        parallelism = samples.sparkSession.sparkContext.defaultParallelism
        spread = load.fits_task(task_rows) and load.balanced(parallelism)

    span = math.ceil(size / slide)  # blocks in a full firing
    lane_blocks = LANE * max(1, span - 1)
    block = F.floor(F.col("__i") / slide)
    laned = indexed.withColumn(
        "__lane",
        F.explode(F.sequence(F.floor(block / lane_blocks), F.floor((block + span - 1) / lane_blocks))),
    )
    if not spread:
        laned = spread_by(laned, [key, "__lane"], rows, task_rows)
    blocks = (
        laned.withColumn("__b", block)
        .groupBy(key, "__lane", "__b")
        .agg(F.sort_array(F.collect_list(F.struct("__i", "__t", "__x"))).alias("__s"))
        # Only a key's last block can be short, and it does not fire.
        .where(F.size("__s") == slide)
    )
    held = Window.partitionBy(key, "__lane").orderBy("__b").rowsBetween(1 - span, 0)
    joined = blocks.select(
        key,
        "__lane",
        "__b",
        *[F.flatten(F.collect_list(F.col(f"__s.{c}")).over(held)).alias(c) for c in ("__t", "__x")],
    ).where(F.floor(F.col("__b") / lane_blocks) == F.col("__lane"))
    newest = F.struct(
        *[
            F.slice(c, F.greatest(F.lit(1), F.size(c) - size + 1), size).alias(name)
            for c, name in (("__t", "times"), ("__x", "ecg"))
        ]
    )
    # The one-row generator fixes both arrays: as plain projections the optimizer
    # would copy their expressions into every later use, lambdas included.
    return joined.select(key, (F.col("__b") + 1).alias("k"), F.inline(F.array(newest)))


def count_window(samples: DataFrame, *args, key: str = "signame", **kw) -> DataFrame:
    """One row per (firing, sample): (key, k, pos, ts, value), ``pos`` from 0.

    Takes the arguments of ``count_window_arrays``.
    """
    return window_rows(count_window_arrays(samples, *args, key=key, **kw), key)


def window_rows(windows: DataFrame, key: str = "signame") -> DataFrame:
    """Unpack firings into one row per sample."""
    zipped = F.arrays_zip(F.col("times").alias("ts"), F.col("ecg").alias("value"))
    return windows.select(key, "k", F.posexplode(zipped).alias("pos", "s")).select(
        key, "k", F.col("pos").cast("long").alias("pos"), "s.ts", "s.value"
    )


def window_collect(rows: DataFrame, key: str = "signame") -> DataFrame:
    """Pack (key, k, pos, ts, value) rows into firings; a group is one firing."""
    packed = rows.groupBy(key, "k").agg(
        F.sort_array(F.collect_list(F.struct("pos", "ts", "value"))).alias("s")
    )
    return packed.select(key, "k", F.col("s.ts").alias("times"), F.col("s.value").alias("ecg"))
