"""Exact deduplication by sorting contents, DataFrame only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatline.llm.common import prepared
from beatline.runtime import BROADCAST_ROWS, partitions_for, store

#: Leading characters by which texts are ranged; splitters stay short for any text.
PREFIX_CHARS = 32

#: Documents one sorting task is meant to hold.
TASK_DOCS = 50_000


def _runs(df: DataFrame, group: list[str]) -> DataFrame:
    """Number the runs of equal texts in each sorted group by comparing whole neighbours."""
    order = Window.partitionBy(*group).orderBy("text", "id")
    opens = F.coalesce(F.lag("text").over(order) != F.col("text"), F.lit(True))
    return df.withColumn("opens", opens).withColumn("run", F.sum(F.col("opens").cast("long")).over(order))


def exact_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    hot_rows: int = 2_000,
    carry: bool = False,
) -> DataFrame:
    """Find rows with equal texts; one row of each group is kept.

    Texts are range partitioned by sampled splitters over (first characters,
    hash, salt) and sorted by their bytes, so equal ones are adjacent; whole
    texts of neighbours are compared, so a hash collision changes nothing.
    Texts on more than ``hot_rows`` rows (more where those would be over
    BROADCAST_ROWS texts) are counted beforehand and salted by id; the heads of
    their sorted runs, one per salt, are compared in a second, small round.

    Returns one row per input row: id, keep_id, group_size, kept, text_sha256;
    with ``carry`` also ``row``, the input row where it is kept, else null.
    ``keep`` is ``smallest`` or ``largest`` id. Null text equals empty text. A
    null id loses to any other; of rows that repeat the winning id one is kept.
    An empty table gives an empty result; other columns are not looked at.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    spark = docs.sparkSession
    rows = docs.count()
    limit = max(hot_rows, -(-rows // BROADCAST_ROWS))
    own = prepared(docs, carry, id=id_col, text=text_col)
    own = own.withColumns({"prefix": F.substring("text", 1, PREFIX_CHARS), "hash": F.xxhash64("text")})
    hot = store(
        own.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") > limit).withColumnRenamed("hash", "hot_hash"),
        "dedup-hot",
    )  # at most rows / limit <= BROADCAST_ROWS rows
    salts = F.ceil(F.col("n") / F.lit(limit)).cast("long")
    own = own.join(F.broadcast(hot), F.col("hash") == F.col("hot_hash"), "left").withColumn(
        "salt", F.coalesce(F.pmod(F.xxhash64("id"), salts), F.lit(-1).cast("long"))
    )
    group = ["prefix", "hash", "salt"]
    held = [*group, "row"] if carry else [*group, "id", "text"]
    width = partitions_for(spark, rows, TASK_DOCS)
    if width > int(spark.conf.get("spark.sql.shuffle.partitions")):
        ranged = own.select(*held).repartitionByRange(width, *group)
    else:
        ranged = own.select(*held).repartitionByRange(*group)
    if carry:
        ranged = ranged.withColumns(
            {"id": F.col(f"row.`{id_col}`"), "text": F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit(""))}
        )
    best = F.col("id").asc_nulls_last() if keep == "smallest" else F.col("id").desc_nulls_last()
    run = [*group, "run"]
    ranked = _runs(ranged.sortWithinPartitions(*group, "text", "id"), group).select(
        *run,
        "id",
        F.sha2(F.col("text"), 256).alias("text_sha256"),
        F.when(F.col("opens") & (F.col("salt") >= 0), F.col("text")).alias("head"),
        F.row_number().over(Window.partitionBy(*run).orderBy(best)).alias("place"),
        *(["row"] if carry else []),
    )
    if carry:
        ranked = ranked.withColumn("row", F.when(F.col("place") == 1, F.col("row")))
    whole = Window.partitionBy(*run)
    best_id = F.min("id") if keep == "smallest" else F.max("id")
    local = store(
        ranked.withColumns(
            {"best": best_id.over(whole), "size": F.count("*").over(whole), "head": F.max("head").over(whole)}
        ).withColumn("head", F.when(F.col("place") == 1, F.col("head"))),
        "dedup-runs",
    )
    # One head per salt of a hot text: at most rows / limit + the number of hot texts.
    heads = local.where((F.col("salt") >= 0) & (F.col("place") == 1)).select(
        "prefix", "hash", "salt", F.col("run").alias("salt_run"), F.col("head").alias("text"), F.col("best").alias("id"), "size"
    )
    merged = _runs(heads, ["prefix", "hash"])
    across = Window.partitionBy("prefix", "hash", "run")
    merged = store(
        merged.select(
            F.col("prefix").alias("p"),
            F.col("hash").alias("h"),
            F.col("salt").alias("s"),
            F.col("salt_run").alias("r"),
            best_id.over(across).alias("all_best"),
            F.sum("size").over(across).alias("all_size"),
            (F.row_number().over(across.orderBy(best, "salt")) == 1).alias("wins"),
        ),
        "dedup-heads",
    )
    found = local.join(
        F.broadcast(merged),
        (F.col("prefix") == F.col("p"))
        & (F.col("hash") == F.col("h"))
        & (F.col("salt") == F.col("s"))
        & (F.col("run") == F.col("r")),
        "left",
    )
    return found.select(
        "id",
        F.when(F.col("wins").isNull(), F.col("best")).otherwise(F.col("all_best")).alias("keep_id"),
        F.coalesce("all_size", "size").alias("group_size"),
        ((F.col("place") == 1) & F.coalesce("wins", F.lit(True))).alias("kept"),
        "text_sha256",
        *(["row"] if carry else []),
    )


def unique_rows(docs: DataFrame, **options) -> DataFrame:
    """The input without repeated texts, columns unchanged."""
    return exact_dedup(docs, carry=True, **options).where("kept").select("row.*")
