"""Beat detection over count-window firings.

A firing is one row (key, k, times, ecg), as made by ``count_window_arrays`` in
batch or by the streaming front ends. Detection itself looks at one row at a
time: it adds no shuffle, and the same frames serve batch and stream.

    count_window_arrays → with_peaks → beat_segments → classify → anomaly_rows
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatline.functions.arrays import peak_positions, teager, teager_sum
from beatline.operators.windows import SIZE, SLIDE, count_window_arrays
from beatline.runtime import TASK_ROWS

# Fixed values of the method.
FS = 360.0
WIDTH = 50
THRESHOLD = 0.75
TEAGER_FLOOR = 0.018
RR_FLOOR = 0.4


def with_peaks(windows: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``peaks``, the firing's R-peak positions."""
    return windows.withColumn("peaks", peak_positions(F.col("ecg"), width, threshold))


def r_peaks(windows: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, key: str = "signame") -> DataFrame:
    """One row per R peak: (key, k, pos, value)."""
    return (
        with_peaks(windows, width, threshold)
        .select(key, "k", "ecg", F.explode("peaks").alias("pos"))
        .select(key, "k", F.col("pos").cast("long").alias("pos"), F.get("ecg", F.col("pos")).alias("value"))
    )


def min_peaks_gate(
    windows: DataFrame, least: int = 2, width: int = WIDTH, threshold: float = THRESHOLD
) -> DataFrame:
    """Firings with at least ``least`` peaks."""
    return with_peaks(windows, width, threshold).where(F.size("peaks") >= least)


def beat_segments(
    windows: DataFrame,
    size: int = SIZE,
    slide: int = SLIDE,
    width: int = WIDTH,
    threshold: float = THRESHOLD,
    key: str = "signame",
) -> DataFrame:
    """One row per pair of consecutive peaks of a firing.

    ``seg`` counts the pairs from 1. ``ecg`` is the slice including both peaks,
    ``len`` its length, and ``abs_start``/``abs_end`` the peaks' positions in the
    whole signal.
    """
    base = F.greatest(F.lit(0), F.col("k") * slide - size)
    # A firing with fewer than two peaks has no pair and leaves no row.
    n_pairs = F.greatest(F.size("peaks") - 1, F.lit(0))
    pairs = F.arrays_zip(
        F.slice("peaks", F.lit(1), n_pairs).alias("a"), F.slice("peaks", F.lit(2), n_pairs).alias("b")
    )
    length = F.col("pair.b") - F.col("pair.a") + 1
    return (
        with_peaks(windows, width, threshold)
        .select(key, "k", "times", "ecg", F.posexplode(pairs).alias("i", "pair"))
        .select(
            key,
            "k",
            (F.col("i") + 1).cast("long").alias("seg"),
            F.col("pair.a").cast("long").alias("start"),
            length.cast("long").alias("len"),
            "times",
            _once(F.slice("ecg", F.col("pair.a") + 1, length), "ecg"),
            (F.col("pair.a") + base).alias("abs_start"),
            (F.col("pair.b") + base).alias("abs_end"),
        )
    )


def _once(value: Column, name: str) -> Column:
    """``value`` as a column that is worked out once.

    The one-row generator fixes it; the optimizer would copy a plain expression
    into every later use and every filter above it.
    """
    return F.inline(F.array(F.struct(value.alias(name))))


def teager_energy(segments: DataFrame) -> DataFrame:
    """Add ``psi``, the slice's Teager energy sample by sample."""
    return segments.withColumn("psi", teager(F.col("ecg")))


def avg_teager(segments: DataFrame) -> DataFrame:
    """Add ``avg_te``: summed energy over the whole slice length."""
    return segments.select("*", _once(teager_sum(F.col("ecg")) / F.col("len"), "avg_te"))


def rr_interval(segments: DataFrame, fs: float = FS) -> DataFrame:
    """Add ``rr``: the slice's sample count in seconds."""
    return segments.withColumn("rr", F.col("len") / fs)


def beat_timestamp(segments: DataFrame, time_mode: str = "reference") -> DataFrame:
    """Add ``time``.

    ``'reference'`` stamps the i-th beat of a firing with the firing's i-th
    sample, ``'peak'`` with the sample of the beat's opening peak.
    """
    if time_mode not in ("reference", "peak"):
        raise ValueError("time_mode is 'reference' or 'peak'")
    at = F.col("seg") - 1 if time_mode == "reference" else F.col("start")
    return segments.withColumn("time", F.get("times", at.cast("int")))


def classify_beat(segments: DataFrame, te_floor: float = TEAGER_FLOOR, rr_floor: float = RR_FLOOR) -> DataFrame:
    """Keep abnormal beats: a short interval or low mean energy, both strict."""
    return segments.where((F.col("rr") < rr_floor) | (F.col("avg_te") < te_floor)).withColumn(
        "abnormal", F.lit("TRUE")
    )


def drop_repeats(anomalies: DataFrame, key: str = "signame") -> DataFrame:
    """Keep the earliest firing's copy of a beat that overlapping firings both saw."""
    copies = Window.partitionBy(key, "abs_start", "abs_end").orderBy("k")
    return anomalies.withColumn("__copy", F.row_number().over(copies)).where("__copy = 1").drop("__copy")


def detect_in_windows(
    windows: DataFrame,
    size: int = SIZE,
    slide: int = SLIDE,
    width: int = WIDTH,
    threshold: float = THRESHOLD,
    fs: float = FS,
    te_floor: float = TEAGER_FLOOR,
    rr_floor: float = RR_FLOOR,
    time_mode: str = "reference",
    dedup: bool = False,
    key: str = "signame",
) -> DataFrame:
    """Abnormal beats of given firings. ``dedup`` is for batch frames only."""
    segments = rr_interval(avg_teager(beat_segments(windows, size, slide, width, threshold, key)), fs)
    found = classify_beat(beat_timestamp(segments, time_mode), te_floor, rr_floor).drop("times")
    return drop_repeats(found, key) if dedup else found


def detect_anomalies(
    samples: DataFrame,
    size: int = SIZE,
    slide: int = SLIDE,
    key: str = "signame",
    order: tuple[str, ...] = ("ts", "tie"),
    idx: str | None = None,
    task_rows: int = TASK_ROWS,
    **kw,
) -> DataFrame:
    """Samples in, abnormal beats out."""
    windows = count_window_arrays(samples, size, slide, key, order, idx=idx, task_rows=task_rows)
    return detect_in_windows(windows, size, slide, key=key, **kw)


def anomaly_rows(anomalies: DataFrame, key: str = "signame") -> DataFrame:
    """The four columns that are stored for an abnormal beat."""
    return anomalies.select(F.col(key).alias("signame"), "time", "ecg", "abnormal")
