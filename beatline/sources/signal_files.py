"""Recordings as text: one sample per line, one recording per file or folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beatline.runtime import BROADCAST_ROWS, MOST_PARTITIONS, ship, store
from beatline.sources.line_ranges import count_ranges as _count_ranges
from beatline.sources.line_ranges import opens
from beatline.sources.line_ranges import read_ranges as _read_ranges

# Bytes of a file that one task reads.
RANGE_BYTES = 64 << 20

# Endings of packed files, which cannot be read from the middle.
_PACKED = ("gz", "bz2", "zst", "lz4", "snappy", "deflate", "xz")

# Fixed name forms: the file "<record>_signals.txt", or "part-*" files in the
# folder "record=<record>".
SUFFIX = "_signals.txt"
PART = "part-"


def _record_name(path: Column) -> Column:
    """The record a file belongs to, by cheap string cuts."""
    last = F.substring_index(path, "/", -1)
    parent = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    name = F.substring_index(F.when(F.startswith(last, F.lit(PART)), parent).otherwise(last), "=", -1)
    return F.when(
        F.endswith(name, F.lit(SUFFIX)), F.substr(name, F.lit(1), F.length(name) - len(SUFFIX))
    ).otherwise(name)


def _decoded(url: Column) -> Column:
    """A path of file metadata, which is percent-encoded."""
    decoded = F.url_decode(F.replace(url, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(url, F.lit("%")), decoded).otherwise(url)


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as (record, idx, text), ``idx`` counting a record's lines from 0.

    Lines end with a line feed, a carriage return or both. Lines that are not
    UTF-8 are skipped and not counted. A record's files count on in the order of
    their names. Lines are never shuffled.
    """
    files = list_files(spark, path)
    ending = F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1))
    found = files.agg(
        F.bool_or(ending.isin(*_PACKED)).alias("packed"),
        F.collect_set(F.regexp_extract("path", "^([A-Za-z][A-Za-z0-9+.-]*):", 1)).alias("schemes"),
    ).first()
    if not found.packed and all(map(opens, found.schemes)):
        return read_ranges(plan_ranges(files))
    return _stored_lines(spark, path)


def _before(*order: str) -> Window:
    """What comes before in a record; part numbers of five digits sort by name, longer ones by length first."""
    return Window.partitionBy("record").orderBy(F.length(order[0]), *order).rowsBetween(Window.unboundedPreceding, -1)


def _stored_lines(spark: SparkSession, path: str) -> DataFrame:
    """Numbered lines of files that only Spark's reader can open or unpack.

    How Spark cuts files into splits may change from one reading to the next, so
    the lines are written once with their split and their place in it. They are
    counted per split; the counts before a split shift its lines. Only the small
    table of splits is shuffled.
    """
    lines = store(
        spark.read.text(path)
        .where(F.is_valid_utf8("value"))
        .select(
            F.col("_metadata.file_path").alias("__file"),
            F.col("_metadata.file_block_start").alias("__at"),
            F.col("value").alias("text"),
            # Increases line by line within a split.
            F.monotonically_increasing_id().alias("__seq"),
        ),
        "lines",
    )
    splits = lines.groupBy("__file", "__at").agg(F.count("*").alias("__n"), F.min("__seq").alias("__first"))
    shifts = splits.withColumn("record", _record_name(_decoded(F.col("__file")))).select(
        F.col("__file").alias("__f"),
        F.col("__at").alias("__a"),
        "record",
        (F.coalesce(F.sum("__n").over(_before("__file", "__at")), F.lit(0)) - F.col("__first")).alias("__shift"),
    )
    shifts = store(shifts, "splits")
    if shifts.count() <= BROADCAST_ROWS:
        shifts = F.broadcast(shifts)
    numbered = lines.join(shifts, (F.col("__file") == F.col("__f")) & (F.col("__at") == F.col("__a")))
    return numbered.select("record", (F.col("__seq") + F.col("__shift")).alias("idx"), "text")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the files under ``path``; their content is not read."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


def plan_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A stored list of byte ranges: record, path, length, changed, begin, end, n and base.

    A range holds the lines that begin in it, ``n`` of them, and its first line
    is line ``base`` of the record. The list is a row per range, so what is
    planned is read, however Spark would cut the files on another day. Length
    and time of change are kept for ``read_ranges``, which refuses a file that is
    not the one that was counted.
    """
    ship(files.sparkSession)
    cut = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes)))
    ranges = files.select("path", "length", cut.alias("begin")).withColumn("end", F.least("length", F.col("begin") + range_bytes))
    counted = _spread(ranges).mapInArrow(_count_ranges, "path string, length long, changed long, begin long, end long, n long")
    planned = store(counted.withColumn("record", _record_name(F.col("path"))), "counted")
    base = F.coalesce(F.sum("n").over(_before("path", "begin")), F.lit(0))
    return store(planned.withColumn("base", base), "ranges")


def read_ranges(ranges: DataFrame) -> DataFrame:
    """The lines of a planned list as (record, idx, text), a task or a part of one per range."""
    ship(ranges.sparkSession)
    return _spread(ranges).mapInArrow(_read_ranges, "record string, idx long, text string")


def _spread(ranges: DataFrame) -> DataFrame:
    """A few ranges per task; only the list is shuffled."""
    return ranges.repartition(max(1, min(ranges.count(), MOST_PARTITIONS)))


def scan_signal_files(spark: SparkSession, path: str, keep_text: bool = False) -> DataFrame:
    """Signal files to (record, idx, value); a line that is no number has a null value.

    ``keep_text`` adds the line itself as ``text``.
    """
    return _numbered_lines(spark, path).select(
        "record",
        "idx",
        F.trim("text").try_cast("double").alias("value"),
        *(["text"] if keep_text else []),
    )


def scan_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A list of record names, one per line, as (record, line)."""
    return _numbered_lines(spark, path).select(F.trim("text").alias("record"), F.col("idx").alias("line"))


def write_signal_files(samples: DataFrame, path: str, record: str = "record", idx: str = "idx", value: str = "value") -> None:
    """Samples to text under ``path/record=<record>/``, in order.

    A long recording becomes several files whose names sort in sample order.
    """
    (
        samples.repartitionByRange(record, idx)
        .sortWithinPartitions(record, idx)
        .select(F.col(record).alias("record"), F.col(value).cast("string").alias("value"))
        .write.partitionBy("record")
        .text(path)
    )
