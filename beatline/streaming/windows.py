"""Count windows over a stream.

Two front ends emit the same firings, (key, k, times, ecg), which the batch
detection plan then scores row by row.

``stateful_windows`` keeps each key's tail in Spark's state store. One key is
one task there, as in any keyed stream, and holds its share of a micro-batch:
bound the micro-batch with the source's options.

``CarryWindows`` handles a micro-batch with the batch plan and carries the tails
in a table between batches, so a dominant key is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatline.operators.halo import join_per_group
from beatline.operators.indexing import dense_index
from beatline.operators.windows import SIZE, SLIDE, count_window_arrays
from beatline.runtime import TASK_ROWS, group_load
from beatline.streaming.folders import COMPACT, BatchFolders

# Times are kept as microseconds, which are cheaper to store than datetimes.
STATE = "n bigint, times array<bigint>, ecg array<double>"

# Firings handed back to Spark at a time.
FRAME = 256


def stateful_windows(samples: DataFrame, size: int = SIZE, slide: int = SLIDE, key: str = "signame") -> DataFrame:
    """Streaming (key, ts, tie, value) samples to streaming firings.

    A key's state is its sample count and its last ``size`` samples. Within a
    micro-batch a key's samples are taken in (ts, tie) order; across
    micro-batches, in order of arrival.
    """

    per_frame = FRAME

    # Nested, so that executors need not have this package installed.
    def fire(group, batches, state):
        import numpy as np
        import pandas as pd

        if state.exists:
            n, times, ecg = state.get
        else:
            n, times, ecg = 0, [], []
        arrived = pd.concat(list(batches)).sort_values(["ts", "tie"], kind="stable")
        times = np.concatenate([np.array(times, "datetime64[us]"), arrived["ts"].to_numpy("datetime64[us]")])
        ecg = np.concatenate([np.array(ecg, "float64"), arrived["value"].to_numpy("float64")])
        end = n + len(arrived)
        first = end - len(ecg)  # index of the oldest sample held
        due = range(n // slide + 1, end // slide + 1)
        for some in (due[i : i + per_frame] for i in range(0, len(due), per_frame)):
            cuts = [slice(max(0, k * slide - size) - first, k * slide - first) for k in some]
            yield pd.DataFrame(
                {key: group[0], "k": list(some), "times": [list(times[c]) for c in cuts], "ecg": [ecg[c] for c in cuts]}
            )
        state.update((end, times[-size:].astype("int64").tolist(), ecg[-size:].tolist()))

    schema = T.StructType([
        T.StructField(key, T.StringType()),
        T.StructField("k", T.LongType()),
        T.StructField("times", T.ArrayType(T.TimestampNTZType())),
        T.StructField("ecg", T.ArrayType(T.DoubleType())),
    ])
    return (
        samples.select(key, "ts", "tie", "value")
        .groupBy(key)
        .applyInPandasWithState(fire, schema, STATE, "append", "NoTimeout")
    )


class CarryWindows:
    """Firings of one micro-batch, continuing from the batches before it.

    A batch writes the samples of the keys it has news of, each with the tail it
    started from; keys without news cost nothing. A retried batch reads what it
    read before and replaces its own folder, so replays do not change the result.

    Batches count 0, 1, 2, …; within a batch and a key, samples are in (ts, tie)
    order. A null key is a key like any other.
    """

    def __init__(
        self, spark: SparkSession, path: str, size: int = SIZE, slide: int = SLIDE,
        key: str = "signame", task_rows: int = TASK_ROWS, compact: int = COMPACT,
    ):
        self.size, self.slide, self.key, self.task_rows = size, slide, key, task_rows
        schema = T.StructType([
            T.StructField(key, T.StringType()),
            T.StructField("idx", T.LongType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("fresh", T.BooleanType()),
            T.StructField("tail", T.BooleanType()),
            T.StructField("at", T.LongType()),
        ])
        self.folders = BatchFolders(spark, path, schema, compact)

    def _same_key(self, left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        """Join on the key, null included; ``right`` loses its key column."""
        other = right.withColumnRenamed(self.key, "__key")
        return left.join(other, F.col(self.key).eqNullSafe(F.col("__key")), how).drop("__key")

    def _newest(self, rows: DataFrame) -> DataFrame:
        """Each key's tail of the last batch that had news of it."""
        tails = rows.where("tail")
        last = tails.groupBy(self.key).agg(F.max("at").alias("__at"))
        return self._same_key(tails, last, "inner").where("at = __at").drop("__at")

    def next(self, samples: DataFrame, batch: int) -> DataFrame:
        """The firings that ``samples``, micro-batch ``batch``, bring about."""
        key = self.key
        load = group_load(samples, [key])
        counts = samples.groupBy(key).agg((F.count("*") - 1).alias("__last"))
        asked = counts.select(key)
        known = self.folders.before(batch, self._newest).where("tail")
        tails = self._newest(self._same_key(known, asked, "left_semi")).select(key, "idx", "ts", "value")
        arrived = dense_index(
            samples.select(key, "ts", "tie", "value"), [key], ["ts", "tie"], "__i", self.task_rows, load
        )
        before = tails.groupBy(key).agg((F.max("idx") + 1).alias("__before"))
        starts = (
            self._same_key(counts, before, "left")
            .withColumn("__before", F.coalesce("__before", F.lit(0)))
            .withColumn("__end", F.col("__before") + F.col("__last") + 1)
        )
        # A tail is the last `size` samples, from the start of their block.
        in_tail = F.col("idx") >= F.floor((F.col("__end") - self.size) / self.slide) * self.slide
        fresh = join_per_group(arrived, starts, [key], "__i", "__last").withColumn(
            "idx", F.col("__i") + F.col("__before")
        )
        old = self._same_key(tails, starts.select(key, "__end"), "inner")
        parts = [
            rows.select(
                key, "idx", "ts", "value", F.lit(new).alias("fresh"), in_tail.alias("tail"),
                F.lit(batch).cast("long").alias("at"),
            )
            for rows, new in ((old, False), (fresh, True))
        ]
        held = self.folders.write(parts[0].unionByName(parts[1]), batch).withColumn("stamp", F.struct("ts", "fresh"))
        windows = count_window_arrays(held, self.size, self.slide, key, time="stamp", idx="idx")
        # A firing whose last sample is old has happened already.
        return windows.where(F.element_at("times", -1)["fresh"]).withColumn("times", F.col("times.ts"))
