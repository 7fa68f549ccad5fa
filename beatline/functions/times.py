"""Zone-free timestamps as text.

Formatting functions read a timestamp in the session's zone, which shifts clock
times that the zone skips. A cast to text does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stamp_text(ts: Column, digits: int = 6) -> Column:
    """``yyyy-MM-dd HH:mm:ss.f…`` with ``digits`` places of the second, cut off."""
    text = ts.cast("string")
    whole = F.when(F.contains(text, F.lit(".")), text).otherwise(F.concat(text, F.lit(".")))
    return F.substr(F.rpad(whole, 26, "0"), F.lit(1), F.lit(20 + digits))


def clock_text(ts: Column) -> Column:
    """Time of day as ``HH:mm:ss.SSS``."""
    return F.substr(stamp_text(ts, 3), F.lit(12), F.lit(12))
