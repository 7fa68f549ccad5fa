"""Near duplicates by SimHash fingerprints and a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from beatline.llm.common import attach, prepared, slices
from beatline.llm.components import stars
from beatline.llm.hamming import GrayIndex, gray_rank, small_groups
from beatline.runtime import BROADCAST_ROWS, spread_by, store

#: Shingles whose bits are added up at once.
CHUNK = 1 << 17

#: Fingerprints below one upper node that one task may hold; larger nodes are divided.
NODE_ROWS = 200_000

#: Groups up to this size are compared side by side.
SMALL = 32


def shingle_hashes(text: bytes, size: int) -> list[bytes]:
    """XXH64 (seed 42) of each run of ``size`` words, lower-cased in ASCII, space-joined."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxh64_digest(joined, 42)]
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    begins = [0, *[e + 1 for e in ends[: len(words) - size]]]
    return [xxh64_digest(joined[b:e], 42) for b, e in zip(begins, ends[size - 1 :], strict=True)]


def fingerprints(texts: list[bytes], size: int) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text; no words: zero."""
    ones = np.zeros((len(texts), 64), np.int64)
    totals = np.zeros(len(texts), np.int64)
    held, owner, n = [], [], 0

    def flush() -> None:
        if not n:
            return
        bits = np.unpackbits(np.frombuffer(b"".join(map(b"".join, held)), np.uint8).reshape(-1, 8), axis=1)
        first = np.cumsum([0] + [len(h) for h in held[:-1]])
        np.add.at(ones, np.array(owner), np.add.reduceat(bits, first, axis=0, dtype=np.int32))

    for k, text in enumerate(texts):
        hashes = shingle_hashes(text, size)
        totals[k] = len(hashes)
        for at in range(0, len(hashes), CHUNK):
            held.append(hashes[at : at + CHUNK])
            owner.append(k)
            n += len(held[-1])
            if n >= CHUNK:
                flush()
                held, owner, n = [], [], 0
    flush()
    majority = (2 * ones > totals[:, None]).astype(np.uint8)
    return np.packbits(majority, axis=1).view(">u8").reshape(-1).astype(np.uint64)


def fingerprint_table(own: DataFrame, size: int) -> DataFrame:
    """(id, tie, print) of (id, text): the fingerprint's bits as a signed long."""
    kind = own.schema["id"].dataType.simpleString()

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [t.as_buffer().to_pybytes() for t in part.column("text")]
            prints = fingerprints(texts, size).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("tie"), pa.array(prints)], ["id", "tie", "print"])

    own = own.select("id", F.xxhash64("text").alias("tie"), F.col("text").cast("binary").alias("text"))
    return own.mapInArrow(printed, f"id {kind}, tie long, print long")


def _masks(free: int, most: int) -> list[int]:
    """Pairs of blocks of the free bits, one of which is clean in every pair of close prints.

    ``most`` differing bits leave at least two of ``most + 2`` blocks untouched.
    """
    bits = [b for b in range(64) if free >> b & 1]
    blocks = [sum(1 << int(b) for b in part) for part in np.array_split(bits, most + 2)]
    return [x | y for x, y in combinations(blocks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pattern_nodes(prints: DataFrame, most: int, node_rows: int) -> DataFrame:
    """(mask, bits, print): every print below the upper nodes of its shared masked bits.

    Two prints that differ in at most ``most`` bits share a node at each depth.
    Nodes over ``node_rows`` prints are divided by more masked bits, for which
    the same holds, so no task meets an unbounded node and no pair is lost.
    """
    spark = prints.sparkSession
    every = (1 << 64) - 1
    level = [m for m in _masks(every, most)]
    rows = prints.select(
        F.explode(F.array(*[F.lit(_signed(m)).cast("long") for m in level])).alias("mask"), "print"
    ).withColumn("bits", F.col("print").bitwiseAND(F.col("mask")))
    done = None
    while True:
        rows = store(rows, "simhash-nodes")
        large = store(
            rows.groupBy("mask", "bits").agg(F.count("*").alias("n")).where(F.col("n") > node_rows).drop("n"),
            "simhash-large",
        )
        found = [r.mask for r in large.select("mask").distinct().collect()]  # at most the masks of one depth
        deeper = {m: _masks(every ^ (m % (1 << 64)), most) for m in found if 64 - (m % (1 << 64)).bit_count() >= 2 * (most + 2)}
        if not deeper:
            return rows if done is None else done.unionByName(rows)
        split = large.where(F.col("mask").isin(list(deeper)))
        if split.count() <= BROADCAST_ROWS:  # there are at most all rows / node_rows of them
            split = F.broadcast(split)
        rest = rows.join(split, ["mask", "bits"], "left_anti")
        done = rest if done is None else done.unionByName(rest)
        table = spark.createDataFrame(
            [(m, [_signed(m % (1 << 64) | d) for d in ds]) for m, ds in deeper.items()], "mask long, deeper array<long>"
        )
        rows = (
            rows.join(split, ["mask", "bits"], "left_semi")
            .join(F.broadcast(table), "mask")
            .select(F.explode("deeper").alias("mask"), "print")
            .withColumn("bits", F.col("print").bitwiseAND(F.col("mask")))
        )


def close_prints(prints: DataFrame, most: int, node_rows: int = NODE_ROWS) -> DataFrame:
    """Edges (u, v) that span all links of at most ``most`` differing bits between distinct prints."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            mask, bits, prints = (batch.column(c).to_numpy() for c in ("mask", "bits", "print"))
            if rest is not None:
                mask, bits, prints = (np.concatenate(x) for x in zip(rest, (mask, bits, prints), strict=True))
            new = np.flatnonzero((mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1]))
            cut = int(new[-1]) + 1 if len(new) else 0
            rest = (mask[cut:], bits[cut:], prints[cut:])
            if cut:
                yield _edges(mask[:cut], bits[:cut], prints[:cut], most)
        if rest is not None and len(rest[0]):
            yield _edges(*rest, most)

    nodes = pattern_nodes(prints, most, node_rows)
    return (
        spread_by(nodes, ["mask", "bits"], nodes.count())
        .sortWithinPartitions("mask", "bits")
        .mapInArrow(linked, "u long, v long")
        .where("u <> v")
        .distinct()
    )


def _edges(mask: np.ndarray, bits: np.ndarray, prints: np.ndarray, most: int) -> pa.RecordBatch:
    """Whole groups of equal (mask, bits), adjacent, as links of each print to one of its component."""
    prints = prints.view(np.uint64)
    start = np.flatnonzero(np.concatenate([[True], (mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])]))
    sizes = np.diff(np.append(start, len(mask)))
    group = np.repeat(np.arange(len(start)), sizes)
    order = np.lexsort([gray_rank(prints), group])
    prints = prints[order]
    us, vs = [], []
    few = np.repeat((sizes <= SMALL) & (sizes > 1), sizes)
    if few.any():
        own = prints[few]
        label = small_groups(own, group[few], most, int(sizes[sizes <= SMALL].max()))
        far = label != np.arange(len(label))
        us.append(own[far])
        vs.append(own[label[far]])
    for k in np.flatnonzero(sizes > SMALL):
        own = prints[start[k] : start[k] + sizes[k]]
        label = GrayIndex(own).linked(most)
        far = label != np.arange(len(label))
        us.append(own[far])
        vs.append(own[label[far]])
    u = np.concatenate(us) if us else np.zeros(0, np.uint64)
    v = np.concatenate(vs) if vs else np.zeros(0, np.uint64)
    return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    most: int = 4,
    node_rows: int = NODE_ROWS,
) -> DataFrame:
    """Group documents whose fingerprints are linked by at most ``most`` differing bits.

    Returns one row per input row: id, print (signed long), fingerprint (16 hex
    digits), component_id (smallest id of the group), tie (hash of the text) and
    first (whether the row is the group's smallest by id, then tie).

    Equal fingerprints meet once, in a pre-aggregated table. Distinct ones go to
    the nodes of their masked bit patterns; inside a node they are sorted by
    Gray rank and searched through a tree of shared patterns. Only a spanning
    set of links leaves a node, and components grow from it by stars.

    Texts without words have fingerprint zero and link like any other; null
    counts as empty. A null id is never smallest unless all of the group are
    null, then component_id is null. Rows that repeat an id stay rows of their
    own. An empty table gives an empty result.
    """
    own = prepared(docs, id=id_col, text=text_col)
    rows = store(fingerprint_table(own, shingle), "simhash-prints")
    best = F.struct(F.col("id").isNull().alias("none"), "id", "tie")
    nodes = store(rows.groupBy("print").agg(F.count("*").alias("n"), F.min(best).alias("best")), "simhash-distinct")
    stars_of = stars(close_prints(nodes.select("print"), most, node_rows))
    rooted = nodes.join(stars_of, nodes["print"] == stars_of["u"], "left").select(
        "print", "n", "best", F.coalesce("v", "print").alias("root")
    )
    rooted = store(rooted, "simhash-rooted")
    groups = store(
        rooted.groupBy("root").agg(F.min("best").alias("group_best"), F.count("*").alias("n")), "simhash-groups"
    )
    per_print = attach(rooted.select("print", "root", F.col("n").alias("rows")), groups, "root", ["print"], nodes.count())
    per_print = store(per_print.select("print", F.col("rows").alias("n"), "group_best"), "simhash-members")
    found = attach(rows, per_print, "print", ["id", "tie"], rows.count())
    return found.select(
        "id",
        "print",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("group_best.id").alias("component_id"),
        "tie",
        (F.col("id").eqNullSafe(F.col("group_best.id")) & (F.col("tie") == F.col("group_best.tie"))).alias("first"),
    )


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The first document of each group, columns unchanged.

    Rows equal to it in id and text stay with it: repeated rows are exact
    duplicates, which are not this operator's to decide.
    """
    groups = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    first = groups.where("first").select(F.col("id").alias("__id"), F.col("tie").alias("__tie")).distinct()
    tie = F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("id"), tie.alias("tie"))
    kept = row.join(first, F.col("id").eqNullSafe(F.col("__id")) & (F.col("tie") == F.col("__tie")), "left_semi")
    return kept.select("row.*")
