"""Removal of repeated word windows, counted by Rabin-Karp hashes over all documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from beatline.llm.common import WordCache, prepared, slices

#: Odd multipliers of the two hashes, 64 bits and the upper 16 of 64 bits.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

#: Windows one bucket is meant to hold.
BUCKET_WINDOWS = 1_000_000

_LAST = (1 << 63) - 1

# Column, stored type, whether its differences are stored: windows and spans keep
# their documents' order, so what names them changes little from row to row.
_WINDOW = (
    ("a", np.uint64, False),
    ("b", np.uint16, False),
    ("id", np.uint64, True),
    ("tie", np.uint64, True),
    ("start", np.uint32, True),
)
_SPAN = (("id", np.uint64, True), ("tie", np.uint64, True), ("begin", np.uint32, True), ("size", np.uint32, False))


def window_hashes(words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Both hashes of every window of ``n`` word hashes, from prefix sums modulo 2^64."""
    out = []
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint16)
    with np.errstate(over="ignore"):
        for k, base in enumerate(_BASES):
            own = words if k == 0 else (words ^ (words >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
            up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(own) - 1, base, np.uint64)]))
            down = np.cumprod(
                np.concatenate([[np.uint64(1)], np.full(len(own) - n, pow(base, -1, 1 << 64), np.uint64)])
            )
            total = np.concatenate([[np.uint64(0)], np.cumsum(own * up)])
            h = (total[n:] - total[:-n]) * down
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            out.append(h ^ (h >> np.uint64(29)))
    return out[0], (out[1] >> np.uint64(48)).astype(np.uint16)


def _dump(table: dict[str, np.ndarray], fields: tuple) -> bytes:
    """Columns byte plane by byte plane, so that equal bytes compress away."""
    planes = []
    for f, kind, differs in fields:
        own = table[f].astype(kind)
        if differs:
            own = np.diff(own, prepend=own.dtype.type(0))
        planes.append(own.view(np.uint8).reshape(-1, own.itemsize).T.tobytes())
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _load(payload: bytes, n: int, fields: tuple) -> dict[str, np.ndarray]:
    size = sum(np.dtype(kind).itemsize for _, kind, _ in fields)
    raw = np.frombuffer(pa.decompress(payload, n * size, codec="zstd", asbytes=True), np.uint8)
    out, at = {}, 0
    for f, kind, differs in fields:
        w = np.dtype(kind).itemsize
        own = np.ascontiguousarray(raw[at : at + n * w].reshape(w, n).T).view(kind).reshape(n)
        out[f] = np.cumsum(own, dtype=kind) if differs else own
        at += n * w
    return out


def _repeats(t: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of each hash's earliest window, and of all its later ones."""
    order = np.argsort(t["a"], kind="stable")
    a = t["a"][order]
    same = a[1:] == a[:-1]
    shared = np.zeros(len(a), bool)
    shared[1:] |= same
    shared[:-1] |= same
    single, rows = order[~shared], order[shared]
    if not len(rows):
        return single, rows
    rows = rows[np.lexsort([t[f][rows] for f in ("start", "tie", "id", "b", "a")])]
    later = np.zeros(len(rows), bool)
    later[1:] = (t["a"][rows[1:]] == t["a"][rows[:-1]]) & (t["b"][rows[1:]] == t["b"][rows[:-1]])
    # Rows of one document given twice hold the same window: both are its earliest.
    twin = np.zeros(len(rows), bool)
    twin[1:] = later[1:] & np.all([t[f][rows[1:]] == t[f][rows[:-1]] for f in ("id", "tie", "start")], axis=0)
    at = np.where(twin, 0, np.arange(len(rows)))
    lead = np.maximum.accumulate(at)
    later = later[lead]
    return np.concatenate([single, rows[~later & ~twin]]), rows[later]


def _spans(t: dict[str, np.ndarray], rows: np.ndarray, n: int) -> dict[str, np.ndarray]:
    """Windows as maximal spans of words per document: id, tie, begin, size."""
    rows = rows[np.lexsort([t[f][rows] for f in ("start", "tie", "id")])]
    own, tie, start = t["id"][rows], t["tie"][rows], t["start"][rows].astype(np.int64)
    new = np.ones(len(rows), bool)
    new[1:] = (own[1:] != own[:-1]) | (tie[1:] != tie[:-1]) | (start[1:] > start[:-1] + n)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(rows)) - 1 if len(rows) else first
    return {"id": own[first], "tie": tie[first], "begin": start[first], "size": start[last] + n - start[first]}


_WORDS = WordCache(lambda words: [xxh64_intdigest(w, 7) for w in words])


def _ordered(ids: np.ndarray) -> np.ndarray:
    """Signed longs as unsigned ones of the same order."""
    return ids.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)


def _packed(part: pa.RecordBatch) -> tuple[int, bytes]:
    """A block of documents, compressed, under a name made from its content."""
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))
    with pa.ipc.new_stream(sink, part.schema, options=options) as writer:
        writer.write_batch(part)
    payload = sink.getvalue().to_pybytes()
    return xxh64_intdigest(payload) - (1 << 63), payload


def repeated_spans(own: DataFrame, n: int, buckets: int) -> DataFrame:
    """(block, m, spans): packed spans of windows that also start earlier, by block of documents.

    A task hashes all windows of a block, keeps the earliest of equal ones and
    deals those out to buckets by the leading bits of their hash. The others are
    repeats whatever other blocks hold; they travel as spans, so a frequent
    window loads no bucket. A bucket compares its windows and names the later
    ones to the blocks they came from.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            block, _ = _packed(part)
            words, counts = [], []
            for text in part.column("text"):
                found = text.as_buffer().to_pybytes().split()
                words += found
                counts.append(len(found))
            hashes = np.array(_WORDS.values(words), np.uint64)
            del words
            a, b = window_hashes(hashes, n)
            sizes = np.array(counts, np.int64)
            ends = np.cumsum(sizes)
            doc = np.repeat(np.arange(len(sizes)), sizes)[: len(a)]
            pos = np.arange(len(a))
            inside = pos + n <= ends[doc]
            doc, pos = doc[inside], pos[inside]
            t = {
                "a": a[inside],
                "b": b[inside],
                "id": _ordered(part.column("id").to_numpy())[doc],
                "tie": _ordered(part.column("tie").to_numpy())[doc],
                "start": (pos - (ends - sizes)[doc]).astype(np.uint32),
            }
            sent, lost = _repeats(t)
            sent = np.sort(sent)
            to = ((t["a"][sent] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
            order = np.argsort(to, kind="stable")
            cuts = np.searchsorted(to[order], np.arange(buckets + 1))
            spans = _spans(t, lost, n)
            m = len(spans["id"])
            rows = []
            for k in range(buckets):
                chosen = sent[order[cuts[k] : cuts[k + 1]]]
                mine = m if k == block % buckets else 0
                if len(chosen) or mine:
                    windows = _dump({f: v[chosen] for f, v in t.items()}, _WINDOW)
                    rows.append((k, block, len(chosen), windows, mine, _dump(spans, _SPAN) if mine else b""))
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)],
                ["bucket", "block", "n", "windows", "m", "spans"],
            )

    def compared(rows: pa.Table) -> pa.Table:
        blocks, counts, windows, ms, spans = (rows.column(c).to_pylist() for c in ("block", "n", "windows", "m", "spans"))
        out = [(block, m, own_spans) for block, m, own_spans in zip(blocks, ms, spans, strict=True) if m]
        parts = [_load(w, c, _WINDOW) for w, c in zip(windows, counts, strict=True) if c]
        if parts:
            t = {f: np.concatenate([p[f] for p in parts]) for f, *_ in _WINDOW}
            of = np.repeat(np.arange(len(blocks)), counts)
            later = _repeats(t)[1]
            later = later[np.argsort(of[later], kind="stable")]
            cuts = np.searchsorted(of[later], np.arange(len(blocks) + 1))
            for k in np.unique(of[later]):
                mine = _spans(t, later[cuts[k] : cuts[k + 1]], n)
                out.append((blocks[k], len(mine["id"]), _dump(mine, _SPAN)))
        columns = zip(*out, strict=True) if out else [[]] * 3
        kinds = [pa.int64(), pa.int32(), pa.binary()]
        return pa.table(
            {name: pa.array(list(c), kind) for name, c, kind in zip(("block", "m", "spans"), columns, kinds, strict=True)}
        )

    dealt = own.mapInArrow(hashed, "bucket int, block long, n int, windows binary, m int, spans binary")
    return (
        dealt.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(compared, "block long, m int, spans binary")
    )


def _cut(part: pa.RecordBatch, spans: dict[str, np.ndarray]) -> dict[str, list]:
    """A block's documents without the words of their spans."""
    ids, ties = (_ordered(part.column(c).to_numpy()) for c in ("id", "tie"))
    order = np.lexsort([spans["begin"], spans["tie"], spans["id"]])
    spans = {f: v[order] for f, v in spans.items()}
    keys = np.stack([spans["id"], spans["tie"]], axis=1)
    known, first = np.unique(keys, axis=0, return_index=True)
    last = np.append(first[1:], len(keys))[: len(first)]
    at = {(i, t): (b, e) for (i, t), b, e in zip(known.tolist(), first, last, strict=True)}
    out: dict[str, list] = {"id": part.column("own").to_pylist(), "n_words": [], "n_removed": [], "kept": [], "spans": []}
    for i, t, text in zip(ids.tolist(), ties.tolist(), part.column("text"), strict=True):
        words, merged = text.as_buffer().to_pybytes().split(), []
        if found := at.get((i, t)):
            begin, size = spans["begin"][slice(*found)].astype(np.int64), spans["size"][slice(*found)].astype(np.int64)
            depth = np.zeros(len(words) + 1, np.int64)
            np.add.at(depth, begin, 1)
            np.add.at(depth, begin + size, -1)
            gone = np.cumsum(depth)[:-1] > 0
            merged = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]).astype(np.int8))).reshape(-1, 2).tolist()
        kept, end = [], 0
        for b, e in merged:
            kept += words[end:b]
            end = e
        kept += words[end:]
        out["n_words"].append(len(words))
        out["n_removed"].append(len(words) - len(kept))
        out["kept"].append(b" ".join(kept).decode())
        out["spans"].append([{"begin": b, "end": e} for b, e in merged])
    return out


def substring_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 20,
) -> DataFrame:
    """Remove words covered by a window of ``window`` words that also starts earlier.

    Earlier is a smaller id, or the same document at an earlier word; windows are
    judged on the input. Words are runs without ASCII white space. Returns id,
    n_words, n_removed, kept (words left, joined by a space) and spans, the
    maximal removed spans of words [begin, end).

    Windows are compared by 80 bits of hash. Documents are read twice and must
    come in the same order, as from files; another order is noticed and refused.
    Null and empty texts have no words.
    Null ids come last. Rows that repeat an id are ordered by a hash of their
    text, and rows that repeat both are one document, cut alike. An empty table
    gives an empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    own = prepared(docs, id=id_col, text=text_col).select(
        F.col("id").cast("long").alias("own"),
        F.coalesce(F.col("id").cast("long"), F.lit(_LAST)).alias("id"),
        F.col("text").cast("binary").alias("text"),
    )
    seen = own.groupBy("id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size"))
    rows, ids, size = seen.agg(F.sum("n"), F.count("*"), F.sum("size")).first()
    # The tie breaker is constant, and costs nothing, while ids are unique.
    own = own.withColumn("tie", F.lit(0).cast("long") if rows == ids else F.xxhash64("text"))
    wanted = (size or 0) // 6 // BUCKET_WINDOWS  # a word has six bytes or so
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)
    own = own.select("own", "id", "tie", "text")
    spans = repeated_spans(own, window, buckets)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            block, payload = _packed(part)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([payload], pa.binary())], ["block", "docs"])

    span = pa.struct([("begin", pa.int32()), ("end", pa.int32())])
    kinds = {"id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept": pa.string(), "spans": pa.list_(span)}

    def cut(rows: pa.Table) -> pa.Table:
        packed = rows.column("docs").drop_null().to_pylist()
        listed = rows.filter(rows.column("spans").is_valid())
        parts = [_load(p, m, _SPAN) for p, m in zip(listed.column("spans").to_pylist(), listed.column("m").to_pylist(), strict=True)]
        if parts and not packed:
            raise RuntimeError("the documents came in another order the second time; store them before they are cut")
        none = {f: np.zeros(0, kind) for f, kind, _ in _SPAN}
        found = {f: np.concatenate([p[f] for p in parts]) for f, *_ in _SPAN} if parts else none
        done = [_cut(part, found) for docs in packed for part in pa.ipc.open_stream(docs)]
        return pa.table({f: pa.array([x for d in done for x in d[f]], kind) for f, kind in kinds.items()})

    held = own.mapInArrow(blocks, "block long, docs binary").withColumns(
        {"m": F.lit(None).cast("int"), "spans": F.lit(None).cast("binary")}
    )
    both = held.unionByName(spans.withColumn("docs", F.lit(None).cast("binary")))
    return both.groupBy("block").applyInArrow(
        cut, "id long, n_words long, n_removed long, kept string, spans array<struct<begin:int,end:int>>"
    )
