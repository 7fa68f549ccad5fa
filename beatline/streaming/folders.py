"""Tables that the micro-batches of a stream leave for the ones after them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from beatline.runtime import remove

# Batches between two folders that gather what is still needed.
COMPACT = 20


class BatchFolders:
    """One folder per micro-batch, ``<path>/batch=<id>``, which a retry of the batch replaces.

    Every ``compact`` batches the rows that are still needed are gathered in
    ``<path>/all=<id>``, so a batch looks through one such copy and the few
    batches since. Folders before the last two copies are removed. Batches count
    0, 1, 2, ….
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, compact: int = COMPACT):
        self.spark, self.path, self.schema, self.compact = spark, path.rstrip("/"), schema, compact

    def read(self, *folders: str) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def _since(self, batch: int, first: int) -> list[str]:
        return [f"all={first}"] * (first > 0) + [f"batch={i}" for i in range(first, batch)]

    def before(self, batch: int, needed: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The rows of all batches before ``batch`` that are still needed, or more.

        ``needed`` picks them from all rows known, when it is time to gather them.
        """
        first = batch // self.compact * self.compact
        if batch and batch == first:
            known = self.read(*self._since(batch, batch - self.compact))
            needed(known).write.mode("overwrite").parquet(f"{self.path}/all={batch}")
            oldest = batch - 2 * self.compact
            for folder in [f"all={oldest}", *[f"batch={i}" for i in range(max(0, oldest), oldest + self.compact)]]:
                if oldest >= 0:
                    remove(self.spark, f"{self.path}/{folder}")
        return self.read(*self._since(batch, first))

    def write(self, rows: DataFrame, batch: int) -> DataFrame:
        rows.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        return self.read(f"batch={batch}")
