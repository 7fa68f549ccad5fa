"""What the operators of this folder share: input columns, hot keys, word caches."""

from __future__ import annotations

import ctypes
import threading
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.runtime import BROADCAST_ROWS, ship

#: Fixed value: a word is a run of characters that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Fixed value: the characters of Unicode's White_Space, for character classes.
UNICODE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: UTF-8 bytes of text one step of a Python task works on.
SLICE_BYTES = 4 << 20


def prepared(df: DataFrame, carry: bool = False, **columns: str) -> DataFrame:
    """The input columns under the given names, which no other input column can clash with.

    A column named ``text`` becomes a string, null as empty. ``carry`` adds the
    whole input row as the struct column ``row``.
    """
    ship(df.sparkSession)
    own = {new: F.col(f"`{old}`") for new, old in columns.items()}
    if "text" in own:
        own["text"] = F.coalesce(own["text"].cast("string"), F.lit(""))
    if carry:
        own["row"] = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(*[c.alias(new) for new, c in own.items()])


def attach(left: DataFrame, right: DataFrame, key: str, spread: list[str], rows: int) -> DataFrame:
    """Left join of ``right`` (one row per key, ``n`` = its rows in ``left``), no key in one task.

    ``right`` has ``key`` (never null), ``n`` and payload columns and should be a
    stored table. Keys over ``rows / BROADCAST_ROWS`` rows, at least 10,000, are
    hot: there are at most BROADCAST_ROWS of them, so they are broadcast. Other
    keys meet in a shuffle join, in which rows of hot keys are spread by the
    hash of the columns ``spread``. Left rows without a partner get nulls.
    """
    limit = max(10_000, -(-rows // BROADCAST_ROWS))
    payload = [c for c in right.columns if c != key]
    hot = right.where(F.col("n") > limit).select(
        F.col(key).alias("__hk"), F.struct(*payload).alias("__hot")
    )
    cold = right.where(F.col("n") <= limit).select(
        F.col(key).alias("__ck"), F.lit(0).cast("long").alias("__cs"), F.struct(*payload).alias("__cold")
    )
    marked = left.join(F.broadcast(hot), F.col(key) == F.col("__hk"), "left").withColumn(
        "__s", F.when(F.col("__hot").isNotNull(), F.xxhash64(*spread).bitwiseOR(F.lit(1))).otherwise(F.lit(0).cast("long"))
    )
    joined = marked.join(cold, (F.col(key) == F.col("__ck")) & (F.col("__s") == F.col("__cs")), "left")
    found = F.coalesce("__hot", "__cold")
    return joined.select(*left.columns, *[found[c].alias(c) for c in payload])


_HELD: dict[str, dict] = {}

#: Seconds that a worker keeps what it holds while no task comes.
REST_S = 2.0
_WAITS: list[threading.Timer] = []


def worker_cache(owner: str, key: object, make: Callable[[], object]) -> object:
    """What one operator keeps in a Python worker between its tasks.

    Workers outlive a job, so what other operators left in this one is dropped
    first: a chain of operators needs the memory of one.
    """
    while _WAITS:
        _WAITS.pop().cancel()
    if others := [name for name in _HELD if name != owner]:
        for other in others:
            del _HELD[other]
        release()
    mine = _HELD.setdefault(owner, {})
    if key not in mine:
        mine[key] = make()
    return mine[key]


def rest(seconds: float | None = None) -> None:
    """Called at a task's end: what this worker keeps goes soon, unless another task asks for it.

    A chain of operators goes on beside idle workers, in the memory they leave.
    After 0 ``seconds`` (default: REST_S) it goes before the task has ended.
    """

    def drop() -> None:
        _HELD.clear()
        release()

    if seconds == 0:
        drop()
        return
    release()
    _WAITS.append(threading.Timer(REST_S if seconds is None else seconds, drop))
    _WAITS[-1].daemon = True
    _WAITS[-1].start()


def release() -> None:
    """Give memory that this worker no longer uses back to the system, for the tasks beside it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library than glibc
        pass


class WordCache:
    """Values of repeated words, in two generations so that its memory stays bounded.

    ``encode`` maps a list of distinct words to their values, never None. A word
    used since the last turn of generations is kept; the rest is forgotten, and
    words over ``longest`` characters are at once.
    """

    def __init__(
        self,
        encode: Callable[[list], list],
        limit: int = 400_000,
        known: dict | None = None,
        longest: int = 64,
    ):
        self.encode, self.limit, self.known, self.longest = encode, limit, known or {}, longest
        self.young: dict = dict(self.known)
        self.old: dict = {}

    def values(self, words: list) -> list:
        found = list(map(self.young.get, words))
        if None in found:
            fresh, missed = [], [i for i, v in enumerate(found) if v is None]
            for w in {words[i] for i in missed}:
                if (v := self.old.get(w)) is None:
                    fresh.append(w)
                else:
                    self.young[w] = v
            for i in range(0, len(fresh), 10_000):
                part = fresh[i : i + 10_000]
                self.young.update(zip(part, self.encode(part), strict=True))
            for i in missed:
                found[i] = self.young[words[i]]
            for w in fresh:
                if len(w) > self.longest:
                    del self.young[w]
            if len(self.young) > self.limit + len(self.known):
                self.old, self.young = self.young, dict(self.known)
        return found


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each piece has about ``size`` bytes of text, a row at least."""
    for batch in batches:
        texts, begin, held = batch.column(column), 0, 0
        offsets = _ends(texts)
        for i, end in enumerate(offsets):
            if end - held > size or i == len(offsets) - 1:
                yield batch.slice(begin, i + 1 - begin)
                begin, held = i + 1, end


def _ends(texts: pa.Array) -> list[int]:
    import numpy as np
    import pyarrow.compute as pc

    return np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)).tolist()
