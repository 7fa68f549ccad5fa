"""Mixing sources to target weights with hash-threshold histograms, DataFrame only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatline.llm.common import WORD, prepared
from beatline.operators.indexing import dense_index
from beatline.runtime import BROADCAST_ROWS, scratch_path, store

#: Hash bits one histogram resolves, and how many histograms cover all 60 bits.
LEVEL_BITS, LEVELS = 15, 4


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def hash60(id_col: Column, seed: int) -> Column:
    """A document's place in its source, 0 … 2^60 - 1: the leading bits of an MD5."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Per-source tables are broadcast while their counted rows stay below the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def source_targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Add ``target`` to (source, source_size): share of all sizes, dealt by weight, capped.

    Weights repeat over sources in code point order, null last. A target stops
    at ``most`` times its source's size; the excess is dealt again by weight
    until no target is above. Each turn is one aggregate over the sources.
    """
    ranked = dense_index(sources.withColumn("none", F.col("source").isNull()), [], ["none", "source"], "rank")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = store(
        ranked.withColumn("weight", F.element_at(turn, (F.col("rank") % len(weights) + 1).cast("int"))).drop(
            "none", "rank"
        ),
        "mix-sources",
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size") * F.lit(float(most))
    free, load, capped = share * total, 0.0, -1
    level = F.lit(0.0)
    while True:
        above = level > cap if capped >= 0 else F.lit(False)
        row = ranked.agg(
            F.sum(F.when(above, 1).otherwise(0)),
            F.sum(F.when(above, cap)),
            F.sum(F.when(~above, F.col("weight"))),
        ).first()
        if (row[0] or 0) == capped:
            break
        capped, free, load = row[0] or 0, share * total - (row[1] or 0.0), row[2] or 0.0
        level = F.lit(free) * F.col("weight") / F.lit(load) if load else F.lit(0.0)
    return ranked.withColumn("target", F.when(level > cap, cap).otherwise(level))


def thresholds(sized: DataFrame, targets: DataFrame, n_sources: int) -> DataFrame:
    """Per source: copies every document gets, and the hash up to which one more is taken.

    ``sized`` (source, size, h) is read once for a histogram of its leading hash
    bits. Only rows of the bucket in which the rest of the budget ends are kept
    for the next bits, so later levels read next to nothing. The last level
    knows whole hashes and takes the boundary document if that comes nearer.
    """
    has = F.col("source_size") > 0
    whole = F.when(has, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    base = targets.withColumn("copies", whole).withColumn(
        "rest", F.col("target") - F.col("copies") * F.col("source_size")
    )
    state = base.where("rest > 0").select(
        F.col("source").alias("s"), F.lit(0).cast("long").alias("upto"), F.col("rest").alias("left")
    )
    rows = sized.where("size > 0")
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        part = F.shiftright("h", shift)
        hist = (
            rows.groupBy("source", part.alias("part"))
            .agg(F.sum("size").alias("size"))
            .join(_small(state, n_sources), F.col("source").eqNullSafe(F.col("s")))
        )
        upward = Window.partitionBy("source").orderBy("part")
        hist = hist.withColumn("cum", F.sum("size").over(upward)).withColumn("before", F.col("cum") - F.col("size"))
        # The bucket in which the budget ends; exactly one, as 0 < left < the whole.
        edge = hist.where((F.col("before") < F.col("left")) & (F.col("cum") >= F.col("left")))
        if level == LEVELS - 1:
            near = F.col("cum") - F.col("left") < F.col("left") - F.col("before")
            edge = edge.select(
                F.col("source").alias("s"), F.when(near, F.col("part")).otherwise(F.col("part") - 1).alias("upto")
            )
        else:
            edge = edge.select(
                F.col("source").alias("s"),
                F.col("part").alias("upto"),
                (F.col("left") - F.col("before")).alias("left"),
            )
        state = store(edge, "mix-edge")
        if level < LEVELS - 1:
            at_edge = rows.join(
                _small(state.select("s", "upto"), n_sources),
                F.col("source").eqNullSafe(F.col("s")) & (part == F.col("upto")),
            )
            rows = store(at_edge.select("source", "size", "h"), "mix-rows")
    return base.join(_small(state, n_sources), F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("source").alias("s"), "source_size", "target", "copies", F.coalesce("upto", F.lit(-1)).alias("upto")
    )


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 1,
    carry: bool = False,
) -> DataFrame:
    """Decide how many times the mix takes each document.

    Sizes are words. A source gets whole copies of all its documents plus those
    whose hash lies under a threshold, so a larger budget with the same seed
    takes a superset, nothing is sorted, and reruns agree. Returns id, source,
    size, source_size, target, times and taken = times * size; with ``carry``
    also the input row as ``row`` (then texts are read once more).

    A null text has size 0; a null source is a source of its own, ranked last;
    a null id hashes as the empty string; rows that repeat an id share its hash
    and are taken together. Documents of size 0 follow the threshold as well.
    An empty table gives an empty result. Only the named columns are used.
    """
    spark = docs.sparkSession
    own = prepared(docs, carry=carry, id=id_col, text=text_col, source=source_col)
    own = own.withColumns({"size": word_count(F.col("text")), "h": hash60(F.col("id"), seed)}).drop("text")
    path = scratch_path(spark, "mix-sized")
    own.drop("row").write.parquet(path)
    sized = spark.read.parquet(path)
    sources = store(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-totals")
    n_sources = sources.count()
    cut = store(thresholds(sized, source_targets(sources, weights, share, most), n_sources), "mix-cut")
    extra = F.when(F.col("h") <= F.col("upto"), 1).otherwise(0)
    return (
        (own if carry else sized)
        .join(_small(cut, n_sources), F.col("source").eqNullSafe(F.col("s")))
        .withColumn("times", F.col("copies") + extra)
        .withColumn("taken", F.col("size") * F.col("times"))
        .select("id", "source", "size", "source_size", "target", "times", "taken", *(["row"] if carry else []))
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each input row as many times as it is taken, columns unchanged."""
    taken = mix(docs, carry=True, **options).where("times > 0")
    return taken.select(F.explode(F.array_repeat("row", F.col("times").cast("int"))).alias("row")).select("row.*")
