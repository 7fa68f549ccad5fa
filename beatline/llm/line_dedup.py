"""Line deduplication with exact reference counts and sharded cuckoo filters, reversible."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from beatline.llm.common import attach, prepared, slices
from beatline.llm.cuckoo import CuckooFilter, Full, halves
from beatline.runtime import BROADCAST_ROWS, scratch_path, store

#: Most bytes of filters, and of keys they pass wrongly, that are sent to every worker.
BROADCAST_BYTES = 64 << 20

#: Frequent keys one shard is meant to hold.
SHARD_KEYS = 100_000


def line_key(line: bytes) -> bytes:
    """ASCII white space off both ends, A-Z lower-cased."""
    return line.strip().lower()


def digest(key: bytes) -> bytes:
    """128-bit name of a key in the tables."""
    return hashlib.blake2b(key, digest_size=16).digest()


def keys_of(text: bytes, min_chars: int) -> list[bytes | None]:
    """A digest for each line; None for lines whose key is too short to be dropped."""
    out = []
    for line in text.split(b"\n"):
        key = line_key(line)
        long = len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)
        out.append(digest(key) if long and key else None)
    return out


def line_refs(docs: DataFrame, id_col: str, text_col: str, min_chars: int, sign: int = 1) -> DataFrame:
    """(key, n): in how many documents each line key occurs, times ``sign``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            seen: Counter = Counter()
            for text in part.column("text"):
                seen.update({k for k in keys_of(text.as_buffer().to_pybytes(), min_chars) if k})
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array([sign * n for n in seen.values()], pa.int64())], ["key", "n"]
            )

    own = prepared(docs, id=id_col, text=text_col).select(F.col("text").cast("binary").alias("text"))
    return own.mapInArrow(counted, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _sharded(keys: DataFrame, shards: int) -> DataFrame:
    return keys.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))


def build_filters(frequent: DataFrame, shards: int) -> DataFrame:
    """(shard, state): one cuckoo filter for each shard of the keys."""

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        keys, room = halves(rows["key"].tolist()), len(rows)
        while True:
            own = CuckooFilter(room)
            try:
                own.add(keys)
                break
            except Full:
                room *= 2
        return pd.DataFrame({"shard": [key[0]], "state": [own.state()]})

    return _sharded(frequent.select("key"), shards).groupBy("shard").applyInPandas(build, "shard int, state binary")


def update_filters(filters: DataFrame, changes: DataFrame, shards: int) -> DataFrame:
    """Apply (key, up) to the filters: add keys that became frequent, remove those that ceased.

    A shard without room comes back with a null state, to be built anew.
    """

    def change(key: tuple, old: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        state = old["state"].iloc[0] if len(old) else None
        try:
            if len(rows):
                own = CuckooFilter(int(rows["up"].sum()), state)
                down, up = rows[~rows["up"]]["key"].tolist(), rows[rows["up"]]["key"].tolist()
                own.remove(halves(down)) if down else None
                own.add(halves(up)) if up else None
                state = own.state()
        except Full:
            state = None
        return pd.DataFrame({"shard": pd.array([key[0]], "int32"), "state": pd.array([state], "object")})

    return (
        filters.groupBy("shard")
        .cogroup(_sharded(changes, shards).groupBy("shard"))
        .applyInPandas(change, "shard int, state binary")
    )


class Filters:
    """All shards' filters inside a worker."""

    def __init__(self, states: dict[int, bytes], shards: int):
        self.own = {k: CuckooFilter(state=v) for k, v in states.items()}
        self.shards = shards

    def contains(self, keys: list[bytes]) -> np.ndarray:
        hits = np.zeros(len(keys), bool)
        if keys:
            both = halves(keys)
            # Spark's xxhash64 of a binary column: signed, seed 42, floored modulus.
            hashes = np.array([xxh64_intdigest(k, 42) for k in keys], np.uint64).astype(np.int64)
            at = hashes % self.shards
            for shard in np.unique(at):
                if own := self.own.get(int(shard)):
                    rows = np.flatnonzero(at == shard)
                    hits[rows] = own.contains(both[rows])
        return hits


def drop_lines(
    docs: DataFrame,
    refs: DataFrame,
    filters: DataFrame,
    shards: int,
    *,
    min_docs: int,
    min_chars: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Documents without their frequent lines: id, n_lines, n_dropped, kept.

    While filters, and the counted keys which they pass although they are not
    frequent, stay within ``broadcast_bytes``, documents are read in place and
    nothing is shuffled. Beyond it, keys meet the exact counts in a join.
    """
    spark = docs.sparkSession
    own = prepared(docs, id=id_col, text=text_col)
    size = filters.agg(F.sum(F.length("state"))).first()[0] or 0
    if size <= broadcast_bytes:
        states = spark.sparkContext.broadcast({r.shard: bytes(r.state) for r in filters.collect()})
        wrong = store(_passed(refs.where(F.col("n") < min_docs), states, shards), "line-wrong")
        if wrong.count() * 64 <= min(broadcast_bytes, 64 * BROADCAST_ROWS):
            listed = spark.sparkContext.broadcast({bytes(r.key) for r in wrong.collect()})
            return _drop_in_place(own, states, listed, shards, min_chars)
    return _drop_by_join(own, refs.where(F.col("n") >= min_docs), min_chars)


def _passed(refs: DataFrame, states, shards: int) -> DataFrame:
    """Keys that the filters pass."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filters(states.value, shards)
        for batch in batches:
            keys = batch.column("key").to_pylist()
            yield batch.filter(pa.array(own.contains(keys), pa.bool_()))

    return refs.select("key").mapInArrow(probe, "key binary")


_OUT = "text string, n_lines long, n_dropped long"


def _cut(text: bytes, keys: list[bytes | None], gone: set[bytes]) -> tuple[str, int, int]:
    lines = text.split(b"\n")
    kept = [x for x, k in zip(lines, keys, strict=True) if k not in gone]
    return b"\n".join(kept).decode(), len(lines), len(lines) - len(kept)


def _with_cut(part: pa.RecordBatch, cut: list[tuple[str, int, int]]) -> pa.RecordBatch:
    kept, lines, dropped = zip(*cut, strict=True) if cut else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [part.column("id"), pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
        ["id", "kept", "n_lines", "n_dropped"],
    )


def _schema(own: DataFrame) -> str:
    return f"id {own.schema['id'].dataType.simpleString()}, kept string, n_lines long, n_dropped long"


def _drop_in_place(own: DataFrame, states, listed, shards: int, min_chars: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, wrong = Filters(states.value, shards), listed.value
        for part in slices(batches):
            texts = [t.as_buffer().to_pybytes() for t in part.column("text")]
            keys = [keys_of(t, min_chars) for t in texts]
            asked = list({k for own in keys for k in own if k})
            hits = filters.contains(asked)
            gone = {k for k, hit in zip(asked, hits, strict=True) if hit and k not in wrong}
            yield _with_cut(part, [_cut(t, k, gone) for t, k in zip(texts, keys, strict=True)])

    return own.select("id", F.col("text").cast("binary").alias("text")).mapInArrow(cut, _schema(own))


def _drop_by_join(own: DataFrame, frequent: DataFrame, min_chars: int) -> DataFrame:
    """Each document's distinct keys meet the frequent ones, hot keys spread; hits return to it."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [sorted({k for k in keys_of(t.as_buffer().to_pybytes(), min_chars) if k}) for t in part.column("text")]
            at = np.repeat(np.arange(len(found)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(at)), part.column("print").take(pa.array(at)), pa.array([k for f in found for k in f], pa.binary())],
                ["id", "print", "key"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [t.as_buffer().to_pybytes() for t in part.column("text")]
            gone = [set(g or ()) for g in part.column("gone").to_pylist()]
            yield _with_cut(part, [_cut(t, keys_of(t, min_chars), g) for t, g in zip(texts, gone, strict=True)])

    kind = own.schema["id"].dataType.simpleString()
    own = own.select("id", F.xxhash64("text").alias("print"), F.col("text").cast("binary").alias("text"))
    # Rows that repeat id and text are cut alike; one of them is asked for.
    pairs = own.mapInArrow(keyed, f"id {kind}, print long, key binary").distinct()
    frequent = store(frequent.select("key", "n"), "line-frequent")
    rows = frequent.agg(F.sum("n")).first()[0] or 0
    hits = attach(pairs, frequent, "key", ["id", "print"], rows).where("n is not null")
    gone = hits.groupBy("id", "print").agg(F.collect_set("key").alias("gone"))
    joined = own.alias("o").join(
        gone.alias("g"), F.col("o.id").eqNullSafe(F.col("g.id")) & (F.col("o.print") == F.col("g.print")), "left"
    )
    return joined.select("o.id", "o.text", "g.gone").mapInArrow(cut, _schema(own))


def line_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Drop lines found in ``min_docs`` documents or more: id, kept, n_lines, n_dropped.

    A null or empty text is one empty line, which is never dropped. Rows count
    as documents, also where ids repeat or are null. A document that loses all
    lines keeps an empty text. An empty table gives an empty result.
    """
    refs = store(line_refs(docs, id_col, text_col, min_chars), "line-refs")
    frequent = refs.where(F.col("n") >= min_docs)
    shards = max(1, -(-frequent.count() // SHARD_KEYS))
    filters = store(build_filters(frequent, shards), "line-filters")
    return drop_lines(
        docs, refs, filters, shards, min_docs=min_docs, min_chars=min_chars, id_col=id_col, text_col=text_col, broadcast_bytes=broadcast_bytes
    )


class LineIndex:
    """Reference counts and filters that follow insertions and deletions of documents.

    Every change writes new tables, so a failed job leaves the former state.
    Deleting documents that were inserted restores the state before them.
    """

    def __init__(self, spark: SparkSession, *, shards: int = 64, min_docs: int = 10, min_chars: int = 1):
        self.spark, self.shards, self.min_docs, self.min_chars = spark, shards, min_docs, min_chars
        self.refs = spark.createDataFrame([], "key binary, n long")
        self.filters = spark.createDataFrame([], "shard int, state binary")

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        self._change(line_refs(docs, id_col, text_col, self.min_chars, 1))

    def delete(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Take back documents that were inserted before, with the texts they had."""
        self._change(line_refs(docs, id_col, text_col, self.min_chars, -1))

    def _change(self, delta: DataFrame) -> None:
        both = self.refs.select("key", "n", F.lit(0).cast("long").alias("d")).unionByName(
            delta.select("key", F.lit(0).cast("long").alias("n"), F.col("n").alias("d"))
        )
        path = scratch_path(self.spark, "line-state")
        both.groupBy("key").agg(F.sum("n").alias("was"), F.sum(F.col("n") + F.col("d")).alias("n")).write.parquet(path)
        state = self.spark.read.parquet(path)
        if state.where("n < 0").limit(1).count():
            raise ValueError("deleted documents were never inserted")
        changes = state.where((F.col("was") >= self.min_docs) != (F.col("n") >= self.min_docs)).select(
            "key", (F.col("n") >= self.min_docs).alias("up")
        )
        refs = state.where("n > 0").select("key", "n")
        filters = store(update_filters(self.filters, changes, self.shards), "line-filters")
        full = filters.where("state is null").select("shard")
        if full.limit(1).count():
            frequent = _sharded(refs.where(F.col("n") >= self.min_docs), self.shards).join(full, "shard", "left_semi")
            built = build_filters(frequent, self.shards)
            filters = store(filters.where("state is not null").unionByName(built), "line-filters")
        self.refs, self.filters = refs, filters

    def apply(self, docs: DataFrame, **options) -> DataFrame:
        """Documents without the lines that are frequent now."""
        return drop_lines(
            docs, self.refs, self.filters, self.shards, min_docs=self.min_docs, min_chars=self.min_chars, **options
        )
