"""The stored table of abnormal beats."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatline.operators.indexing import dense_index
from beatline.runtime import exists, remove, store
from beatline.schemas import SIGNAL_SAMPLES

# Declared lengths of the table's text columns.
NAME_LENGTH = 50
FLAG_LENGTH = 5

# Names of the interval units of ``time_chunk`` and their seconds.
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}

# A lease of ids: the first one and how many, with the writer and batch that hold it.
LEASES = "first long, n long, writer string, batch long"

# Rows with waveforms that one task may sort on its own.
TASK_BEATS = 50_000


def assign_id(
    rows: DataFrame, order: tuple[str, ...] = ("signame", "k", "seg"), task_rows: int = TASK_BEATS
) -> DataFrame:
    """Add ``id`` 1, 2, … in ``order``, which must be total.

    The rows are stored first: numbering them takes more than one pass, and what
    finds them costs far more than reading them back.
    """
    return dense_index(store(rows, "unnumbered"), [], list(order), "id", task_rows).withColumn("id", F.col("id") + 1)


def assign_next_ids(
    rows: DataFrame, ledger: str, writer: str, batch: int = 0,
    order: tuple[str, ...] = ("signame", "k", "seg"), task_rows: int = TASK_BEATS,
) -> DataFrame:
    """Add ``id`` in ``order``, counting on where the appends before left off, from 1.

    A batch leases as many ids as it has rows, in a folder of its own under
    ``ledger``. A replayed batch finds its lease and gets the same ids; it must
    have the same number of rows. A writer's leases but the last two are removed,
    so the ledger has two rows a writer. Appends must follow one another.
    """
    spark, own = rows.sparkSession, f"{ledger.rstrip('/')}/writer={writer}"
    kept = store(rows, "unnumbered")
    n = kept.count()
    leases = spark.createDataFrame([], LEASES)
    if exists(spark, ledger):
        leases = spark.read.schema(LEASES).parquet(ledger)
    mine = leases.where((F.col("writer") == writer) & (F.col("batch") == batch)).first()
    if mine and mine.n != n:
        raise ValueError(f"batch {batch} had {mine.n} rows when its ids were leased, now {n}")
    first = mine.first if mine else leases.agg(F.max(F.col("first") + F.col("n"))).first()[0] or 1
    if not mine:
        spark.createDataFrame([(first, n)], "first long, n long").coalesce(1).write.mode("overwrite").parquet(f"{own}/batch={batch}")
        if exists(spark, f"{own}/batch={batch - 2}"):
            remove(spark, f"{own}/batch={batch - 2}")
    return dense_index(kept, [], list(order), "id", task_rows).withColumn("id", F.col("id") + first)


def stable_id(
    rows: DataFrame, columns: tuple[str, ...] = ("signame", "k", "seg", "time"), writer: str = ""
) -> DataFrame:
    """Add a 64-bit ``id`` hashed from ``writer`` and ``columns``; a replayed row keeps its id.

    Counts of windows start again with a new writer, so its name and the beat's
    time are part of the id.
    """
    return rows.withColumn("id", F.xxhash64(F.lit(writer), *columns))


def time_chunk(rows: DataFrame, interval: str = "1 minute", time: str = "time") -> DataFrame:
    """Add ``chunk``, the start of the row's time range; a null time has a null chunk.

    ``interval`` is a count of seconds, minutes, hours or days. Ranges count
    from 1970-01-01 00:00 on the row's own clock, whatever the session's zone.
    """
    count, unit = interval.split()
    size = int(count) * UNIT_SECONDS[unit.rstrip("s")]
    ts = F.col(time)
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    days = F.datediff(F.to_date(ts), F.to_date(epoch)).cast("long")
    # Whole seconds: a range begins on one, and floors do not need the fraction.
    seconds = ((days * 24 + F.hour(ts)) * 60 + F.minute(ts)) * 60 + F.second(ts)
    begin = F.floor(seconds / size) * size
    day, zero = F.floor(begin / 86400).cast("int"), F.lit(0)
    clock = F.make_dt_interval(day, zero, zero, F.pmod(begin, F.lit(86400)).cast(T.DecimalType(18, 6)))
    return rows.withColumn("chunk", epoch + clock)


def unique_signal_time(rows: DataFrame, order: tuple[str, ...] = ("id",)) -> DataFrame:
    """One row per (signame, time): the first in ``order``.

    Ids that count up are the order of insertion. Hashed ids are not: name the
    columns that tell it, such as ("batch", "k", "seg").
    """
    rest = [c for c in rows.columns if c not in ("signame", "time", *order)]
    return (
        rows.groupBy("signame", "time")
        .agg(F.min(F.struct(*order, *rest)).alias("__first"))
        .select(*[F.col(c) if c in ("signame", "time") else F.col(f"__first.{c}") for c in rows.columns])
    )


def _refusal() -> Column:
    """The constraint of the table that a row breaks, null for a row it accepts."""
    return (
        F.when(F.col("signame").isNull(), "signame is null")
        .when(F.length("signame") > NAME_LENGTH, f"signame is longer than {NAME_LENGTH}")
        .when(F.col("time").isNull(), "time is null")
        .when(F.col("abnormal").isNull(), "abnormal is null")
        .when(F.length("abnormal") > FLAG_LENGTH, f"abnormal is longer than {FLAG_LENGTH}")
    )


def split_storable(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows the table accepts, rows it refuses with their ``reason``)."""
    judged = rows.withColumn("reason", _refusal())
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")


def _few_files(dated: DataFrame) -> DataFrame:
    """Gather each date's rows, so that not every task writes to every date.

    Adaptive execution splits a date that is too large for one task. Stateful
    streams run without it and deal each date to as many tasks as there are cores.
    """
    spark = dated.sparkSession
    if spark.conf.get("spark.sql.adaptive.enabled") == "true":
        return dated.hint("rebalance", "refused", "date")
    tasks = spark.sparkContext.defaultParallelism
    return dated.repartition("refused", "date", F.pmod("id", F.lit(tasks)))


# Each file says which ids it may hold, in as little space as its rows need, so
# a beat asked for by its id alone is looked for in the data of few files.
ID_FILTER = {"parquet.bloom.filter.enabled#id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}

#: Why a row is refused where (signame, time) must be unique.
TAKEN, KNOWN = "signame and time repeat an earlier row of the batch", "signame and time are stored already"

# Dates of a batch that are named one by one in a lookup; more are looked up as one span.
NAMED_DATES = 1_000


def stored_keys(spark: SparkSession, path: str, dates: DataFrame, writer: str, batch: int) -> DataFrame:
    """(signame, time) of the table's rows on ``dates`` (date), but those of the writer's own batch.

    Only the folders of those dates are read, and of their files two columns.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], "signame string, time timestamp_ntz")
    named = [r.date for r in dates.where("date is not null").distinct().limit(NAMED_DATES + 1).collect()]
    if len(named) <= NAMED_DATES:
        asked = F.col("date").isin(named)
    else:
        first, last = dates.agg(F.min("date"), F.max("date")).first()
        asked = F.col("date").between(first, last)
    other = (F.col("writer") != writer) | (F.col("batch") != batch)
    return _read(spark, path).where(~F.col("refused") & asked & other).select("signame", "time")


def _refuse_repeats(rows: DataFrame, path: str, writer: str, batch: int, order: tuple[str, ...]) -> DataFrame:
    """Give rows whose (signame, time) the batch or the table has already a ``reason``; rows refused before count for nothing."""
    same = Window.partitionBy("signame", "time", F.col("reason").isNull()).orderBy(*order)
    ranked = rows.withColumn("__rank", F.row_number().over(same))
    known = stored_keys(rows.sparkSession, path, rows.select("date"), writer, batch).distinct()
    known = known.select(F.col("signame").alias("__s"), F.col("time").alias("__t"))
    met = ranked.join(known, (F.col("signame") == F.col("__s")) & (F.col("time") == F.col("__t")), "left")
    reason = F.coalesce("reason", F.when(F.col("__s").isNotNull(), KNOWN), F.when(F.col("__rank") > 1, TAKEN))
    return met.withColumn("reason", reason).withColumn("refused", F.col("reason").isNotNull()).drop("__rank", "__s", "__t")


def sink_signal_samples(
    rows: DataFrame, path: str, writer: str | None = None, batch: int = 0, unique: tuple[str, ...] | None = None
) -> str:
    """Append rows to the table at ``path`` and return the writer's name.

    A writer's batch owns the folder ``writer=<writer>/batch=<batch>`` and
    replaces it when written again, so a retried micro-batch does not add its
    rows twice. Without a name the call is a writer of its own and only adds.
    Rows without an ``id`` get a hashed one. Rows that break a constraint are
    kept apart with the reason, for ``read_refused``. Each date's rows are
    sorted by signal and time, and files carry a filter of their ids, so readers
    skip what they do not ask for.

    ``unique`` makes (signame, time) a key of the table: a row whose key is
    stored already is refused, and of a batch's rows of one key the first in the
    order of these columns stays. The lookup reads the batch's dates only.
    Appends of several writers that must not repeat each other's keys have to
    follow one another.
    """
    writer = writer or uuid.uuid4().hex
    if "id" not in rows.columns:
        rows = stable_id(rows, writer=writer)
    names = SIGNAL_SAMPLES.fieldNames()
    dated = rows.withColumns({"reason": _refusal(), "refused": _refusal().isNotNull(), "date": F.to_date("time")})
    if unique:
        # Read twice: for its dates, and to be written.
        dated = dated.select(*names, *[c for c in unique if c not in names], "reason", "refused", "date").persist()
    try:
        judged = _refuse_repeats(dated, path, writer, batch, unique) if unique else dated
        (
            _few_files(judged.select(*names, "reason", "refused", "date"))
            .sortWithinPartitions("refused", "date", "signame", "time")
            .write.mode("overwrite")
            .options(**ID_FILTER)
            .partitionBy("refused", "date")
            .parquet(f"{path.rstrip('/')}/writer={writer}/batch={batch}")
        )
    finally:
        if unique:
            dated.unpersist()
    return writer


def _read(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([
        *SIGNAL_SAMPLES.fields,
        T.StructField("reason", T.StringType()),
        T.StructField("writer", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField("refused", T.BooleanType()),
        T.StructField("date", T.DateType()),
    ])
    return spark.read.schema(schema).parquet(path)


def read_signal_samples(spark: SparkSession, path: str) -> DataFrame:
    """The stored table, with its ``date`` partition column for pruning."""
    return _read(spark, path).where("not refused").drop("reason", "writer", "batch", "refused")


def read_batch(spark: SparkSession, path: str, writer: str, batch: int) -> DataFrame:
    """What one batch of a writer stored; only its folder is read."""
    table = _read(spark, path).where((F.col("writer") == writer) & (F.col("batch") == batch) & ~F.col("refused"))
    return table.drop("reason", "writer", "batch", "refused")


def read_refused(spark: SparkSession, path: str) -> DataFrame:
    """Rows that broke a constraint of the table, with writer, batch and reason."""
    return _read(spark, path).where("refused").drop("refused", "date")


def compact_signal_samples(spark: SparkSession, path: str, into: str) -> None:
    """Copy the table's accepted rows to a new one with few, sorted files per date.

    Micro-batches leave a folder each; readers of the copy list one. The old
    table is left as it is.
    """
    sink_signal_samples(read_signal_samples(spark, path), into, writer="compacted")


def sink_jdbc(
    rows: DataFrame, url: str, options: dict[str, str], table: str = "signal_samples", refused: str | None = None
) -> None:
    """Append rows to a database table; the driver jar and credentials come from the caller.

    Rows the table would refuse are appended as Parquet to the folder
    ``refused``; without one they fail the call.
    """
    good, bad = split_storable(rows)
    if refused:
        bad.write.mode("append").parquet(refused)
    elif bad.limit(1).count():
        raise ValueError("rows break the table's constraints; name a folder for refused rows")
    good.select("signame", "time", "ecg", "abnormal").write.format("jdbc").option("url", url).option(
        "dbtable", table
    ).options(**options).mode("append").save()
