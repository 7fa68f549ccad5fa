"""Column functions over one array value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def arr_min(arr: Column) -> Column:
    return F.array_min(arr)


def arr_max(arr: Column) -> Column:
    return F.array_max(arr)


def arg_min(arr: Column) -> Column:
    """0-based position of the first smallest value."""
    return F.array_position(arr, F.array_min(arr)) - 1


def arg_max(arr: Column) -> Column:
    """0-based position of the first largest value."""
    return F.array_position(arr, F.array_max(arr)) - 1


def peak_positions(arr: Column, width: int, threshold: float) -> Column:
    """0-based positions above ``threshold`` that are the first maximum of ±``width``.

    Any two samples in a block of ``width + 1`` lie within ``width`` of each
    other, so each block offers one candidate, its first maximum. Only the
    candidates are compared with their whole neighbourhood.
    """
    block = width + 1
    starts = F.sequence(F.lit(0), F.size(arr) - 1, F.lit(block))
    tops = F.transform(
        starts, lambda s: F.struct(s.alias("s"), F.array_max(F.slice(arr, s + 1, block)).alias("x"))
    )
    candidates = F.transform(
        F.filter(tops, lambda c: c["x"] > threshold),
        lambda c: F.struct(
            (c["s"] + F.array_position(F.slice(arr, c["s"] + 1, block), c["x"]).cast("int") - 1).alias("p"),
            c["x"].alias("x"),
        ),
    )

    def first_maximum(c: Column) -> Column:
        low = F.greatest(c["p"] - width, F.lit(0))
        near = F.slice(arr, low + 1, c["p"] + width + 1 - low)
        return (F.array_max(near) == c["x"]) & (F.array_position(near, c["x"]) == c["p"] - low + 1)

    kept = F.transform(F.filter(candidates, first_maximum), lambda c: c["p"])
    return F.when(F.size(arr) > 0, kept).otherwise(F.array().cast("array<int>"))


def teager(arr: Column) -> Column:
    """Teager energy of a slice: x[j+1]² − x[j]·x[j+2], the last two slots 0."""
    inner = _teager_inner(arr)
    return F.slice(F.concat(inner, F.array(F.lit(0.0), F.lit(0.0))), F.lit(1), F.size(arr))


def teager_sum(arr: Column) -> Column:
    return F.aggregate(_teager_inner(arr), F.lit(0.0), lambda acc, v: acc + v)


def _teager_inner(arr: Column) -> Column:
    n = F.greatest(F.size(arr) - 2, F.lit(0))
    outer = F.zip_with(F.slice(arr, F.lit(1), n), F.slice(arr, F.lit(3), n), lambda a, c: a * c)
    return F.zip_with(F.slice(arr, F.lit(2), n), outer, lambda b, ac: b * b - ac)


def parse_array_text(text: Column) -> Column:
    """``"[a, b, c]"`` to an array of doubles; null when there are no brackets."""
    inner = F.regexp_extract(text, r"\[([^\]]*)\]", 1)
    parts = F.transform(F.split(inner, ","), lambda part: F.trim(part).try_cast("double"))
    return F.when(text.rlike(r"\[[^\]]*\]"), parts)
