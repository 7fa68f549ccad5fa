"""A Merkle tree over a dataset, stored as blocks of nodes in van Emde Boas order.

Rows are leaves of one tree per source, and the roots of those trees are leaves
of a last tree, whose root stands for the whole table. A block is an aligned
subtree of LEVELS levels; a tree of more leaves is a tree of block roots, which
are cut into blocks in turn. Spark spreads the blocks of one layer, so a source
of any size is many tasks, and a path to the root passes one block per layer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import ship
from beatline.operators.indexing import dense_index
from beatline.runtime import spread_by, store

#: Fixed value: nodes under one parent.
FANOUT = 16

#: Hashing levels of a block, and the leaves it has at most.
LEVELS = 3
BLOCK = FANOUT**LEVELS

#: Leaves one task numbers, and leaves whose blocks it builds.
TASK_LEAVES = 50_000

_HEX = 64


@lru_cache(maxsize=None)
def addresses(height: int, fanout: int = FANOUT) -> tuple[np.ndarray, ...]:
    """Places of a complete tree's nodes, one array per depth, in van Emde Boas order.

    The tree is cut at half its height; the upper tree comes first, then the
    lower trees from left to right, each laid out in the same way.
    """
    if height == 1:
        return (np.zeros(1, np.int64),)
    upper = height // 2
    top, low = addresses(upper, fanout), addresses(height - upper, fanout)
    sizes = [sum(len(d) for d in t) for t in (top, low)]
    begins = sizes[0] + np.arange(fanout**upper)[:, None] * sizes[1]
    return (*top, *[(begins + depth[None, :]).ravel() for depth in low])


def levels_of(n: int, first: bool, levels: int = LEVELS, fanout: int = FANOUT) -> int:
    """Hashing levels over a block's ``n`` leaves: as few as leave one node if it is the whole tree, else all."""
    if not first:
        return levels
    need, nodes = 0, n
    while nodes > 1:
        nodes, need = -(-nodes // fanout), need + 1
    return need


def build_block(leaves: bytes, first: bool) -> bytes:
    """The nodes over a block's leaves (32 bytes each), unused places zero, cut after the last used one."""
    n = len(leaves) // 32
    levels = levels_of(n, first)
    places = addresses(levels + 1)
    out = np.zeros((max(int(p[: -(-n // FANOUT ** (levels - d))].max()) for d, p in enumerate(places)) + 1, 32), np.uint8)
    row = leaves
    for depth in range(levels, -1, -1):
        out[places[depth][: len(row) // 32]] = np.frombuffer(row, np.uint8).reshape(-1, 32)
        text, run = row.hex().encode(), FANOUT * _HEX
        row = b"".join([sha256(text[i : i + run]).digest() for i in range(0, len(text), run)])
    return out.tobytes()


def block_paths(nodes: bytes, n: int, first: bool, above: str) -> tuple[list[str], list[str]]:
    """(leaf digests, paths to the last root) of a block's leaves, in order.

    A path has a line per level, from the leaf up: the siblings to the left, a
    bar, the siblings to the right, all as hexadecimal text. ``above`` is the
    path of the block's root.
    """
    stored = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
    levels = levels_of(n, first)
    places = addresses(levels + 1)
    paths = [above]
    row = stored[places[0][:1]].tobytes().hex()
    for depth in range(1, levels + 1):
        count = -(-n // FANOUT ** (levels - depth))
        row = stored[places[depth][:count]].tobytes().hex()
        below = []
        for i in range(count):
            begin = i // FANOUT * FANOUT
            end = min(begin + FANOUT, count)
            left, right = row[begin * _HEX : i * _HEX], row[(i + 1) * _HEX : end * _HEX]
            below.append(f"{left}|{right}\n{paths[i // FANOUT]}")
        paths = below
    return [row[i * _HEX : (i + 1) * _HEX] for i in range(n)], paths


def fold(leaf: str, path: str) -> str:
    """The root that a leaf and the siblings of its path lead to."""
    for line in path.splitlines():
        left, right = line.split("|")
        leaf = sha256(f"{left}{leaf}{right}".encode()).hexdigest()
    return leaf


def digest(*values: Column) -> Column:
    """SHA-256 over fields, each as its UTF-8 byte count, a colon and its text, or "-" for null."""
    parts = [v.cast("string") for v in values]
    told = [F.coalesce(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return F.sha2(F.concat(*told), 256)


@dataclass(frozen=True)
class Forest:
    """Trees by layers of blocks, the leaves' layer first.

    A layer has tree, block, n, nodes, done (the block is the whole rest of its
    tree) and ``rows``, what the leaves carry; ``roots`` has tree and digest.
    """

    layers: list[DataFrame]
    roots: DataFrame


def grow(leaves: DataFrame, label: str) -> Forest:
    """Trees over leaves (tree, pos, digest as 32 bytes, row), ``pos`` counting 0, 1, 2, … within a tree.

    Each layer is one shuffle of what is left, a 4,096th of the layer below.
    """
    carried = leaves.schema["row"].dataType.simpleString()
    schema = f"tree string, block long, n int, nodes binary, done boolean, root binary, rows array<{carried}>"

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, counts, done = [], [], []
            for block, leaves_of in zip(batch.column("block").to_pylist(), batch.column("digests").to_pylist(), strict=True):
                nodes.append(build_block(leaves_of, block == 0))
                counts.append(len(leaves_of) // 32)
                # A tree's first block that is not full is its only one.
                done.append(block == 0 and counts[-1] < BLOCK)
            columns = [
                batch.column("tree"), batch.column("block"), pa.array(counts, pa.int32()), pa.array(nodes, pa.binary()),
                pa.array(done, pa.bool_()), pa.array([x[:32] for x in nodes], pa.binary()), batch.column("rows"),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["tree", "block", "n", "nodes", "done", "root", "rows"])

    layers, left, rows = [], leaves, leaves.count()
    while not layers or left.limit(1).count():
        placed = spread_by(left.withColumn("block", F.floor(F.col("pos") / BLOCK)), ["tree", "block"], rows, TASK_LEAVES)
        packed = placed.groupBy("tree", "block").agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "row"))).alias("s"))
        packed = packed.select(
            "tree", "block", F.array_join(F.transform("s", lambda x: F.hex(x["digest"])), "").alias("hex"), F.col("s.row").alias("rows")
        ).select("tree", "block", F.unhex("hex").alias("digests"), "rows")
        layer = store(packed.mapInArrow(built, schema), f"merkle-{label}")
        layers.append(layer)
        left = layer.where("not done").select(
            "tree", F.col("block").alias("pos"), F.col("root").alias("digest"), F.lit(None).cast(carried).alias("row")
        )
        rows = -(-rows // BLOCK)
    roots = layers[0].where("done").select("tree", "root")
    for layer in layers[1:]:
        roots = roots.unionByName(layer.where("done").select("tree", "root"))
    return Forest(layers, roots.withColumnRenamed("root", "digest"))


def arrive(forest: Forest, tops: DataFrame) -> DataFrame:
    """The leaves' blocks, each with its root's ``path`` and ``subroot``, given (tree, path, subroot) of every tree.

    From the highest layer down, each block hands the blocks below it the path
    of their roots; a block meets one path, by its key.
    """

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, block, n, nodes, above, subroot in _rows(batch, "tree", "block", "n", "nodes", "path", "subroot"):
                _, paths = block_paths(nodes, n, block == 0, above)
                children = pa.array(range(block * BLOCK, block * BLOCK + n), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * n), children, pa.array(paths), pa.array([subroot] * n)],
                    ["tree", "block", "path", "subroot"],
                )

    whole = tops.select("tree", F.lit(0).cast("long").alias("block"), F.lit(True).alias("done"), "path", "subroot")
    found = whole
    for layer in reversed(forest.layers[1:]):
        met = layer.join(found, ["tree", "block", "done"]).select("tree", "block", "n", "nodes", "path", "subroot")
        under = met.mapInArrow(below, "tree string, block long, path string, subroot string")
        found = whole.unionByName(under.withColumn("done", F.lit(False)))
    return forest.layers[0].join(found, ["tree", "block", "done"])


def _rows(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    for i in range(len(batch)):
        yield tuple(batch.column(c)[i].as_py() for c in columns)


def leaf_paths(arrived: DataFrame) -> DataFrame:
    """(row, leaf, path) of every leaf, the path up to the last root."""
    carried = arrived.schema["rows"].dataType.elementType.simpleString()

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (block, n, nodes, above) in enumerate(_rows(batch, "block", "n", "nodes", "path")):
                leaves, paths = block_paths(nodes, n, block == 0, above)
                rows = batch.column("rows").slice(i, 1).flatten()
                yield pa.RecordBatch.from_arrays([rows, pa.array(leaves), pa.array(paths)], ["row", "leaf", "path"])

    return arrived.mapInArrow(listed, f"row {carried}, leaf string, path string")


def leaf_proofs(arrived: DataFrame) -> DataFrame:
    """Leaves with the digest of their siblings and the root that their ``row.claim``, else the leaf, leads to."""
    carried = arrived.schema["rows"].dataType.elementType.simpleString()

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (block, n, nodes, above, subroot) in enumerate(_rows(batch, "block", "n", "nodes", "path", "subroot")):
                leaves, paths = block_paths(nodes, n, block == 0, above)
                rows = batch.column("rows").slice(i, 1).flatten()
                claims = [c or leaf for c, leaf in zip(rows.field("claim").to_pylist(), leaves, strict=True)]
                proofs = [sha256(p.replace("|", "").replace("\n", "").encode()).hexdigest() for p in paths]
                told = [leaves, [subroot] * n, list(map(fold, claims, paths)), proofs]
                yield pa.RecordBatch.from_arrays(
                    [rows, *[pa.array(x, pa.string()) for x in told]], ["row", "leaf", "subroot", "folded_root", "proof_sha256"]
                )

    return arrived.mapInArrow(judged, f"row {carried}, leaf string, subroot string, folded_root string, proof_sha256 string")


def merkle_manifest(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    tampered: Column | None = None,
    changes: dict[str, Column] | None = None,
) -> DataFrame:
    """Build the trees of a table and prove every row against the root.

    Returns id, leaf, subroot, root, proof_sha256, folded_root and verified. A
    leaf is the digest of ``fields``. Rows for which ``tampered`` is true are
    presented with the columns ``changes`` in place of their own: their
    ``folded_root`` starts from the changed leaf and the stored siblings.

    Null fields are digested as such; a null source is a source, the first one.
    Null ids come first, and rows that repeat an id are in the order of their
    leaves, so equal rows are interchangeable. A lone row's leaf is its source's
    subroot, a lone source's subroot the root. An empty table gives an empty
    result. Other columns are not looked at.
    """
    spark = docs.sparkSession
    ship(spark)
    own = {f: F.col(f"`{f}`") for f in fields}
    claim = F.lit(None).cast("string")
    if tampered is not None:
        claim = F.when(tampered, digest(*[(changes or {}).get(f, c) for f, c in own.items()]))
    source = F.col(f"`{source_col}`").cast("string")
    leaves = store(
        docs.select(
            F.coalesce(F.concat(F.lit("s"), source), F.lit("")).alias("tree"),  # in the order of sources, null first
            F.col(f"`{id_col}`").alias("id"),
            digest(*own.values()).alias("leaf"),
            claim.alias("claim"),
        ),
        "merkle-leaves",
    )
    placed = dense_index(leaves, ["tree"], ["id", "leaf"], "pos", TASK_LEAVES)
    sources = grow(
        placed.select("tree", "pos", F.unhex("leaf").alias("digest"), F.struct("id", "claim").alias("row")), "sources"
    )
    subroots = dense_index(sources.roots, [], ["tree"], "pos", TASK_LEAVES)
    # Above the sources stands one tree, whose leaves carry the sources' keys.
    keyed = F.struct(F.col("tree").alias("id"), F.lit(None).cast("string").alias("claim")).alias("row")
    last = grow(subroots.select(F.lit("").alias("tree"), "pos", "digest", keyed), "top")
    found = last.roots.select(F.lower(F.hex("digest"))).first()
    root = F.lit(found[0] if found else None).cast("string")
    top = spark.createDataFrame([("", "", "")], "tree string, path string, subroot string")
    tops = leaf_paths(arrive(last, top)).select(F.col("row.id").alias("tree"), "path", F.col("leaf").alias("subroot"))
    judged = leaf_proofs(arrive(sources, store(tops, "merkle-tops")))
    return judged.select(
        F.col("row.id").alias("id"), "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )
