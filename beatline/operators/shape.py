"""Whole-group and rolling statistics over (group, pos, value) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatline.operators.halo import CHUNK, join_per_group, only_own, with_halo

# Shifted spans that one widening step adds up.
SPREAD = 4


def normalise(
    df: DataFrame, group: list[str], pos: str = "pos", value: str = "value", chunk: int = CHUNK
) -> DataFrame:
    """Replace the value by its z-score within the group (population deviation).

    A constant group becomes 0. The group's mean and deviation are aggregated,
    then joined per (group, chunk): a dominant group is joined in many tasks.
    """
    stats = df.groupBy(*group).agg(
        F.avg(value).alias("__mean"), F.stddev_pop(value).alias("__sd"), F.max(pos).alias("__last")
    )
    scale = F.when(F.col("__sd") == 0, F.lit(1.0)).otherwise(F.col("__sd"))
    return (
        join_per_group(df, stats, group, pos, "__last", chunk=chunk)
        .withColumn(value, (F.col(value) - F.col("__mean")) / scale)
        .select(*df.columns)
    )


def rolling_slope(
    df: DataFrame,
    n: int,
    group: list[str],
    hop: float = 1.0,
    pos: str = "pos",
    value: str = "value",
    chunk: int = CHUNK,
) -> DataFrame:
    """Add ``slope``: the regression slope of the ``n`` rows centred on each row.

    Rows too close to an end repeat the first or last full window's slope. A
    group shorter than ``n`` has null slopes, and ``n = 1`` gives NaN.
    """
    if n < 1:
        raise ValueError("n must be positive")
    if n == 1:
        return df.withColumn("slope", F.lit(float("nan")))
    behind, ahead = n // 2, n - n // 2 - 1
    rows = Window.partitionBy(*group, "__chunk").orderBy(pos)
    # A repeated slope lies up to n rows away and itself sees up to n rows.
    margined = _forward_moments(with_halo(df, pos, 2 * n, 2 * n, chunk), rows, value, n)
    middle = (n - 1) / 2
    spread = n * (n * n - 1) / 12 * hop  # summed squared distances to the middle, in rows, times one hop
    ahead_slope = F.when(F.col("__n") == n, (F.col("__xy") - middle * F.col("__y")) / spread)
    margined = margined.withColumn("__ahead", ahead_slope).drop("__n", "__y", "__xy")
    full = F.lag("__ahead", behind).over(rows)
    return only_own(
        margined.withColumn("__full", full)
        .withColumn(
            "slope",
            F.coalesce(
                "__full",
                F.first("__full", ignorenulls=True).over(rows.rowsBetween(0, behind)),
                F.last("__full", ignorenulls=True).over(rows.rowsBetween(-ahead, 0)),
            ),
        )
        .drop("__full", "__ahead")
    )


def _forward_moments(df: DataFrame, rows, value: str, width: int) -> DataFrame:
    """Add ``__n``, ``__y`` and ``__xy`` of the ``width`` rows from the current one.

    They are the number of values, their sum, and the sum of value times distance
    in rows. ``width`` is spelled out in spans of 1, 4, 16, …, each the sum of
    shifted smaller ones, so the cost is log(width) and nothing is subtracted.
    """
    x = F.col(value)
    df = df.withColumns(
        {
            **{"__sn": F.when(x.isNull(), 0).otherwise(1), "__sy": F.coalesce(x, F.lit(0.0)), "__sxy": F.lit(0.0)},
            **{"__n": F.lit(0), "__y": F.lit(0.0), "__xy": F.lit(0.0)},
        }
    )
    at = lambda c, o: F.coalesce(F.lead(c, o).over(rows), F.lit(0)) if o else F.col(c)
    span, done, left = 1, 0, width
    while left:
        digit, left = left % SPREAD, left // SPREAD
        n, y, xy = F.col("__n"), F.col("__y"), F.col("__xy")
        for _ in range(digit):
            n, y, xy = n + at("__sn", done), y + at("__sy", done), xy + at("__sxy", done) + done * at("__sy", done)
            done += span
        wider = {"__n": n, "__y": y, "__xy": xy}
        if left:
            steps = [i * span for i in range(SPREAD)]
            wider |= {
                "__sn": sum((at("__sn", o) for o in steps[1:]), F.col("__sn")),
                "__sy": sum((at("__sy", o) for o in steps[1:]), F.col("__sy")),
                "__sxy": sum((at("__sxy", o) + o * at("__sy", o) for o in steps[1:]), F.col("__sxy")),
            }
        df = df.withColumns(wider)
        span *= SPREAD
    return df.drop("__sn", "__sy", "__sxy")


def extremes(df: DataFrame, group: list[str], pos: str = "pos", value: str = "value") -> DataFrame:
    """Smallest and largest value of each group and their first positions.

    Columns ``array_min``, ``arg_min``, ``array_max``, ``arg_max``; all four are
    partially aggregated before the shuffle.
    """
    low = F.min(F.struct(F.col(value).alias("x"), F.col(pos).alias("p")))
    high = F.max(F.struct(F.col(value).alias("x"), (-F.col(pos)).alias("p")))
    return (
        df.groupBy(*group)
        .agg(low.alias("__low"), high.alias("__high"))
        .select(
            *group,
            F.col("__low.x").alias("array_min"),
            F.col("__low.p").alias("arg_min"),
            F.col("__high.x").alias("array_max"),
            (-F.col("__high.p")).alias("arg_max"),
        )
    )
