"""Recording headers, channels and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANNEL = "MLII"

# Fixed pattern: what ends a piece of a header comment. A bare * does so too.
MARKS = r"<|>:|\*"

# Fixed list: the header fields that are kept.
FIELDS = ("fs", "n_sig", "sig_len", "units", "sig_name")


def _header_entries(comment: Column) -> Column:
    """[(key, value), …] of "<key>: value …" in order, duplicates included."""
    parts = F.split(comment, MARKS, -1)
    # Text before the first mark is no key; then keys and values alternate.
    last = F.size(parts) - 2
    pairs = F.transform(
        F.sequence(F.lit(1), F.greatest(last, F.lit(1)), F.lit(2)),
        lambda i: F.struct(F.get(parts, i).alias("key"), F.replace(F.get(parts, i + 1), F.lit(" "), F.lit("")).alias("value")),
    )
    none = F.array().cast("array<struct<key:string,value:string>>")
    return F.when((F.instr(comment, "<") > 0) & (last >= 1), pairs).otherwise(none)


def _last_wins(entries: Column) -> Column:
    """Drop entries whose key appears again further on."""

    def is_last(e: Column, i: Column) -> Column:
        later = F.slice(entries, i + 2, F.size(entries))
        return ~F.exists(later, lambda o: o["key"] == e["key"])

    return F.filter(entries, is_last)


def parse_header_comments(comment: Column) -> Column:
    """Header comment "<age>: 65 <sex>: M" to a map; empty without a ``<``.

    Spaces are removed from values and a repeated key keeps its last value.
    """
    return F.map_from_entries(_last_wins(_header_entries(comment)))


def _json_text(text: Column) -> Column:
    quoted = F.to_json(F.array(text))
    return F.substr(quoted, F.lit(2), F.length(quoted) - 2)


def record_metadata(headers: DataFrame) -> DataFrame:
    """(record, metadata): the kept fields and the header comment as sorted JSON.

    A header entry named like a kept field replaces it. Only the first comment
    counts; whitespace is compact.
    """
    fragments = {
        "fs": F.col("fs").cast("string"),
        "n_sig": F.col("n_sig").cast("string"),
        "sig_len": F.col("sig_len").cast("string"),
        "units": F.to_json("units"),
        "sig_name": F.to_json("sig_name"),
    }
    fixed = F.array(
        *[F.struct(F.lit(f).alias("key"), F.coalesce(fragments[f], F.lit("null")).alias("value")) for f in FIELDS]
    )
    extra = F.transform(
        _header_entries(F.get("comments", F.lit(0))),
        lambda e: F.struct(e["key"].alias("key"), _json_text(e["value"]).alias("value")),
    )
    merged = headers.select("record", F.explode(F.array(F.concat(fixed, extra))).alias("entries"))
    members = F.transform(
        F.array_sort(_last_wins(F.col("entries"))),
        lambda e: F.concat(_json_text(e["key"]), F.lit(":"), e["value"]),
    )
    return merged.select("record", F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}")).alias("metadata"))


def select_channel(samples: DataFrame, channel: str = CHANNEL, column: str = "channel") -> DataFrame:
    """Samples of one channel; recordings without it have no rows left."""
    return samples.where(F.col(column) == channel)


def record_manifest(
    records: DataFrame, samples: DataFrame, order: str = "record", skip_first: bool = False
) -> DataFrame:
    """Records that still have samples. ``skip_first`` leaves out the first listed one."""
    kept = records
    if skip_first:
        # A one-row scalar: the smallest position, not a sort of the list.
        kept = records.where(F.col(order) != records.agg(F.min(order)).scalar())
    present = samples.select("record").distinct()
    return kept.join(present, "record", "left_semi").select("record")
