"""Peak picking over (group, pos, value) rows.

``group`` is a list of key columns and ``pos`` counts 0, 1, 2, … within a group.
Long groups are cut into chunks with margins, so no group is tied to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatline.operators.halo import CHUNK, only_own, with_halo
from beatline.runtime import store

# A relative threshold averages from 3 widths before to 1 width after.
PRE = 3
POST = 1

# Rows of one chunk of the decay recurrence.
FOLD = 64

# Offsets one widening step may combine; a step widens the span by one more.
_STEPS = 3


def _rows(group: list[str], pos: str):
    return Window.partitionBy(*group, "__chunk").orderBy(pos)


def _forward_max(df: DataFrame, rows, value: str, width: int) -> DataFrame:
    """Add ``__m``, the maximum of the ``width`` rows from the current one.

    The span is widened by combining shifted copies of itself, which costs
    log(width) offsets per row where a moving frame costs ``width`` updates.
    """
    df = df.withColumn("__m", F.col(value))
    span = 1
    while span < width:
        offsets = []
        reach = span
        while reach < width and len(offsets) < _STEPS:
            offset = min(reach, width - span)
            offsets.append(offset)
            reach = offset + span
        df = df.withColumn("__m", F.greatest("__m", *[F.lead("__m", o).over(rows) for o in offsets]))
        span = reach
    return df


def _forward_sum(df: DataFrame, rows, value: str, width: int) -> DataFrame:
    """Add ``__sum``, the total of the ``width`` rows from the current one.

    ``width`` is spelled out in spans of 1, 4, 16, …, each the sum of shifted
    smaller ones, so nothing is subtracted and the cost is log(width).
    """
    base = _STEPS + 1
    shifted = lambda c, o: F.coalesce(F.lead(c, o).over(rows), F.lit(0.0)) if o else F.col(c)
    df = df.withColumn("__s", F.col(value)).withColumn("__sum", F.lit(0.0))
    span, done, left = 1, 0, width
    while left:
        digit, left = left % base, left // base
        total = F.col("__sum")
        for _ in range(digit):
            total = total + shifted("__s", done)
            done += span
        wider = F.col("__s")
        if left:
            for i in range(1, base):
                wider = wider + shifted("__s", i * span)
        df = df.withColumns({"__sum": total, "__s": wider})
        span *= base
    return df.drop("__s")


def _is_max(margined: DataFrame, rows, value: str, width: int) -> DataFrame:
    """Add ``is_max`` to rows that carry margins of at least ``width``."""
    if width == 0:
        return margined.withColumn("is_max", F.lit(True))
    x = F.col(value)
    after = F.lead("__m", 1).over(rows)
    # The first rows of a chunk have fewer than `width` rows behind them.
    before = F.coalesce(
        F.lag("__m", width).over(rows), F.max(value).over(rows.rowsBetween(Window.unboundedPreceding, -1))
    )
    is_max = (before.isNull() | (before < x)) & (after.isNull() | (after <= x))
    return _forward_max(margined, rows, value, width).withColumn("is_max", is_max).drop("__m")


def _near_mean(margined: DataFrame, rows, group: list[str], pos: str, value: str, width: int) -> DataFrame:
    """Add ``__mean`` of the rows from PRE·width before to POST·width - 1 after."""
    behind, ahead = PRE * width, POST * width
    # The first rows have fewer behind them; they take a running total instead.
    total = F.when(F.col(pos) >= behind, F.lag("__sum", behind).over(rows)).otherwise(
        F.sum(value).over(rows.rowsBetween(Window.unboundedPreceding, ahead - 1))
    )
    last = F.max(pos).over(Window.partitionBy(*group, "__chunk"))
    count = F.least(F.col(pos) + ahead, last + 1) - F.greatest(F.col(pos) - behind, F.lit(0))
    return (
        _forward_sum(margined, rows, value, behind + ahead).withColumn("__mean", total / count).drop("__sum")
    )


def local_maxima(
    df: DataFrame, width: int, group: list[str], pos: str = "pos", value: str = "value", chunk: int = CHUNK
) -> DataFrame:
    """Add ``is_max``: the row is the first maximum of its ±``width`` neighbourhood."""
    if width == 0:
        return df.withColumn("is_max", F.lit(True))
    return only_own(_is_max(with_halo(df, pos, width, width, chunk), _rows(group, pos), value, width))


def over_threshold(
    df: DataFrame,
    width: int,
    threshold: float,
    group: list[str],
    pos: str = "pos",
    value: str = "value",
    relative: bool = False,
    hold: str | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """Keep rows whose value passes the threshold test.

    Absolute: above ``threshold``. Relative: above ``threshold`` plus the mean of
    the rows from 3·width before to width - 1 after. ``hold`` names a column the
    value must also reach.
    """
    x = F.col(value)
    reached: Column = F.lit(True) if hold is None else x >= F.col(hold)
    if not relative:
        return df.where(reached & (x > threshold))
    if width == 0:
        return df.where(F.lit(False))  # an empty mean passes nothing
    margined = with_halo(df, pos, PRE * width, POST * width, chunk)
    tested = only_own(_near_mean(margined, _rows(group, pos), group, pos, value, width))
    return tested.where(reached & (x > F.col("__mean") + threshold)).drop("__mean")


def find_peaks(
    df: DataFrame,
    width: int,
    threshold: float,
    group: list[str],
    pos: str = "pos",
    value: str = "value",
    decay: float = 0.0,
    relative: bool = False,
    chunk: int = CHUNK,
) -> DataFrame:
    """Local maxima that pass the threshold, and the decaying hold if ``decay`` > 0."""
    columns = df.columns
    x = F.col(value)
    reached: Column = F.lit(True)
    if decay > 0:
        df = exp_decay_hold(df, decay, group, pos, value)
        reached = x >= F.col("av")
    if not relative:
        found = local_maxima(df, width, group, pos, value, chunk).where(F.col("is_max") & reached & (x > threshold))
    elif width == 0:
        found = df.where(F.lit(False))  # an empty mean passes nothing
    else:
        # Both tests share one set of margins, and so one shuffle.
        rows = _rows(group, pos)
        margined = with_halo(df, pos, PRE * width, POST * width, chunk)
        tested = only_own(_near_mean(_is_max(margined, rows, value, width), rows, group, pos, value, width))
        found = tested.where(F.col("is_max") & reached & (x > F.col("__mean") + threshold))
    return found.select(*columns)


def top_n_peaks(
    df: DataFrame,
    n: int,
    width: int,
    group: list[str],
    pos: str = "pos",
    value: str = "value",
    chunk: int = CHUNK,
) -> DataFrame:
    """The ``n`` highest local maxima per group, ties to the earlier; ``rank`` from 1.

    Spark trims each task to its own best ``n`` before the shuffle by group.
    """
    best = Window.partitionBy(*group).orderBy(F.desc(value), F.asc(pos))
    return (
        local_maxima(df, width, group, pos, value, chunk)
        .where("is_max")
        .drop("is_max")
        .withColumn("rank", F.row_number().over(best).cast("long"))
        .where(F.col("rank") <= n)
    )


# --- decay with hold ---------------------------------------------------------
#
# One sample x turns the running level a into max(x, d·a + (1-d)·x). Such steps
# compose to a -> max(m, p·a + q), so the effect of any run of samples is three
# numbers. Runs are joined by doubling: after k rounds a row has the effect of
# the 2^k rows up to it, of its own chunk. Chunks' effects are rows in turn.

# No effect at all. The finite floor keeps 0 · m defined.
_NONE = {"__m": -1.7976931348623157e308, "__p": 1.0, "__q": 0.0}


def exp_decay_hold(
    df: DataFrame, decay: float, group: list[str], pos: str = "pos", value: str = "value", fold: int = FOLD
) -> DataFrame:
    """Add ``av``, a level that jumps up to the value and otherwise decays towards it.

    av starts from the group's first value; av = max(x, d·av + (1-d)·x). ``pos``
    counts 0, 1, 2, … in a group. Which effects are joined with which depends on
    a row's position and ``fold`` alone, so a group gives the same bits whatever
    other groups there are.

    Groups of up to ``fold`` rows take one shuffle and one sort; longer ones one
    more for every further level of chunks, of a ``fold``-th of the rows each.
    """
    if not 0 <= decay <= 1:
        raise ValueError("decay lies between 0 and 1")
    if fold < 2:
        raise ValueError("a chunk has two rows at least")
    if decay == 0:
        return df.withColumn("av", F.col(value))
    d, e, x = F.lit(float(decay)), F.lit(1 - float(decay)), F.col(value)
    first = F.col(pos) == 0
    # The first sample starts from itself, whatever came before.
    rows = df.withColumns({
        "__i": F.col(pos).cast("long"),
        "__m": x,
        "__p": F.when(first, F.lit(0.0)).otherwise(d),
        "__q": F.when(first, d * x + e * x).otherwise(e * x),
    })
    last = df.agg(F.max(pos)).first()[0] or 0
    levels = 0
    while last >= fold ** (levels + 1):
        levels += 1
    return _levels(rows, group, fold, levels).select(*df.columns, F.col("__a").alias("av"))


def _levels(rows: DataFrame, group: list[str], fold: int, levels: int) -> DataFrame:
    """Add ``__a``, the level after row ``__i``, to rows with effects __m, __p, __q; ``levels`` of chunks lie above."""
    m, p, q = F.col("__m"), F.col("__p"), F.col("__q")
    rows = rows.withColumn("__c", F.floor(F.col("__i") / fold))
    chunk = Window.partitionBy(*group, "__c").orderBy("__i")
    step = 1
    while step < fold:
        rows = rows.withColumns({f"{c}0": F.lag(c, step, none).over(chunk) for c, none in _NONE.items()})
        rows = rows.withColumns({
            "__m": F.greatest(m, p * F.col("__m0") + q),
            "__p": p * F.col("__p0"),
            "__q": p * F.col("__q0") + q,
        }).drop("__m0", "__p0", "__q0")
        step *= 2
    if not levels:
        # All of a group is one chunk, which starts from its first sample.
        return rows.withColumn("__a", F.greatest(m, q))
    rows = store(rows, "effects")
    totals = rows.groupBy(*group, F.col("__c").alias("__k")).agg(F.max_by(F.struct(*_NONE), "__i").alias("__t"))
    totals = totals.select(*group, F.col("__k").alias("__i"), *[F.col(f"__t.{c}").alias(c) for c in _NONE])
    carry = _levels(totals, group, fold, levels - 1).select(
        *[F.col(g).alias(f"__g_{g}") for g in group], (F.col("__i") + 1).alias("__next"), F.col("__a").alias("__carry")
    )
    on = F.col("__c") == F.col("__next")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    # A first chunk meets no row and needs none.
    into = F.coalesce(p * F.col("__carry"), F.lit(0.0)) + q
    return rows.join(carry, on, "left").withColumn("__a", F.greatest(m, into))
