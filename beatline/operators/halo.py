"""Bounded row frames over long groups: cut into chunks that carry their margin."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 65_536


def with_halo(df: DataFrame, pos: str, before: int, after: int, chunk: int = CHUNK) -> DataFrame:
    """Copy each row into every chunk whose rows can see it.

    A row frame reaching ``before`` rows back and ``after`` rows ahead gives the
    same result inside (group, ``__chunk``) as inside the whole group, for the
    rows flagged ``__own``. ``pos`` must count 0, 1, 2, … within the group. Only
    rows near a chunk edge are copied.
    """
    own = F.floor(F.col(pos) / chunk)
    low = F.greatest(F.lit(0), F.floor((F.col(pos) - after) / chunk))
    high = F.floor((F.col(pos) + before) / chunk)
    return df.withColumn("__chunk", F.explode(F.sequence(low, high))).withColumn(
        "__own", F.col("__chunk") == own
    )


def only_own(df: DataFrame) -> DataFrame:
    """Drop the margin copies and the helper columns."""
    return df.where("__own").drop("__own", "__chunk")


def join_per_group(
    df: DataFrame, stats: DataFrame, group: list[str], pos: str, last: str, how: str = "inner", chunk: int = CHUNK
) -> DataFrame:
    """Join one row of ``stats`` per group to the group's rows, chunk by chunk.

    ``last`` names the column of ``stats`` with the group's largest ``pos``. The
    row is repeated once per chunk, so a dominant group is joined in many tasks.
    """
    rows = df.withColumn("__chunk", F.floor(F.col(pos) / chunk))
    spread = stats.withColumn(
        "__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col(last) / chunk)))
    ).drop(last)
    for g in [*group, "__chunk"]:
        spread = spread.withColumnRenamed(g, f"__j{g}")
    on = F.lit(True)
    for g in [*group, "__chunk"]:
        on = on & F.col(g).eqNullSafe(F.col(f"__j{g}"))
    return rows.join(spread, on, how).drop("__chunk", "__j__chunk", *[f"__j{g}" for g in group])
