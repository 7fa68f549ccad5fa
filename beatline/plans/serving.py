"""Monitoring queries over the table of abnormal beats.

``table`` has columns id, signame, time, ecg, abnormal. Where the table also has
its ``date`` partition column, time filters are repeated on it for pruning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows per report, seconds looked back, length of a signal name.
REPORT_ROWS = 50
RECENT_SECONDS = 60
NAME_LENGTH = 3

EVENT = ("id", "signame", "time", "abnormal")


def ecg_signal(table: DataFrame, ecg_id: int, signame: str | None = None, date: str | None = None) -> DataFrame:
    """The waveform of one abnormal beat.

    Hashed ids lie anywhere in the stored table; its files' filters of ids leave
    the data of few files to read, though all footers. The event it was chosen
    from names its signal and date too: the date prunes folders, the signal the
    row groups of their sorted files.
    """
    found = table.where((F.col("id") == ecg_id) & (F.col("abnormal") == "TRUE"))
    if signame is not None:
        found = found.where(F.col("signame") == signame)
    if date is not None:
        found = found.where(F.col("date") == F.lit(date).cast("date"))
    return found.select("ecg")


def latest_events(table: DataFrame, signame: str, rows: int = REPORT_ROWS) -> DataFrame:
    """The newest abnormal beats of one signal, newest first."""
    return (
        table.where((F.col("signame") == signame) & (F.col("abnormal") == "TRUE"))
        .select(*EVENT)
        .orderBy(F.desc("time"), F.desc("id"))
        .limit(rows)
    )


def recent_events(table: DataFrame, seconds: int = RECENT_SECONDS, rows: int = REPORT_ROWS) -> DataFrame:
    """The oldest rows of the table's last ``seconds``, oldest first."""
    zero = F.lit(0)
    window = F.make_dt_interval(zero, zero, zero, F.lit(seconds).cast("decimal(18,6)"))
    since = table.agg((F.max("time") - window).alias("since")).scalar()
    recent = table.where(F.col("time") > since)
    if "date" in table.columns:
        recent = recent.where(F.col("date") >= F.to_date(since))
    return recent.select(*EVENT).orderBy("time", "id").limit(rows)


def events_view(table: DataFrame, signame: str | None = None) -> DataFrame:
    """One signal's latest events, or all recent ones without a full signal name."""
    if signame is None or len(signame) != NAME_LENGTH:
        return recent_events(table)
    return latest_events(table, signame)


def signal_trace(table: DataFrame, ecg_id: int, signame: str | None = None, date: str | None = None) -> DataFrame:
    """(x, y) points of one abnormal beat, x counting samples from 0."""
    return ecg_signal(table, ecg_id, signame, date).select(F.posexplode("ecg").alias("x", "y"))


def signal_names(table: DataFrame) -> DataFrame:
    return table.select("signame").distinct()
