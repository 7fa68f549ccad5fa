"""SentencePiece encoding and decoding through a relational lattice of pieces."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from beatline.llm.common import prepared, release, ship, slices, worker_cache
from beatline.llm.token_counts import frequent_pieces
from beatline.runtime import BROADCAST_ROWS, store

#: Fixed value: how SentencePiece writes a space.
SPACE = "▁"

#: Characters of a unit the lattice takes; the fold's work grows with the square.
LONGEST = 64

#: Characters of a substring that say which lengths are worth trying.
HEAD = 3

#: Units in the broadcast table, and how many of them a partition names.
TABLE, NAMED = 150_000, 20_000

#: UTF-8 bytes of text in a block of documents, and units on their way back that are packed at once.
SLICE, PACKED = 8 << 20, 200_000

# No piece joins a character other than a space to a space after it, and none
# holds a newline (checked when a model is read): units end there.
_UNIT = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
_SPACED = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_NONE = (1 << 31) - 1


@dataclass(frozen=True)
class Model:
    """What a model file says; ``ranks`` orders its normal pieces by falling score.

    ``pairs`` has the neighbouring characters of pieces as numbers, in order.
    """

    unigram: bool
    prefix: bool
    ids: dict[str, int]
    scores: dict[str, float]
    ranks: dict[str, int]
    bytes_: list[int]
    surface: list[bytes]
    longest: int
    pairs: np.ndarray


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    from sentencepiece import sentencepiece_model_pb2 as pb

    own = pb.ModelProto()
    with open(path, "rb") as file:
        own.ParseFromString(file.read())
    norm, kinds = own.normalizer_spec, pb.ModelProto.SentencePiece
    normal = {p.piece: i for i, p in enumerate(own.pieces) if p.type == kinds.NORMAL}
    byte = {p.piece: i for i, p in enumerate(own.pieces) if p.type == kinds.BYTE}
    if own.trainer_spec.model_type not in (1, 2) or norm.name != "identity" or norm.remove_extra_whitespaces:
        raise ValueError("only unigram and BPE models that leave texts as they are")
    if len(byte) != 256 or any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in normal):
        raise ValueError("only models with byte fallback whose pieces start at spaces")
    scores = {p: own.pieces[i].score for p, i in normal.items()}
    steps = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
    surface = [p.piece.replace(SPACE, " ").encode() if p.type == kinds.NORMAL else b"" for p in own.pieces]
    for k in range(256):
        surface[byte[f"<0x{k:02X}>"]] = bytes([k])
    return Model(
        own.trainer_spec.model_type == 1,
        norm.add_dummy_prefix,
        normal,
        scores,
        {p: steps[s] for p, s in scores.items()},
        [byte[f"<0x{k:02X}>"] for k in range(256)],
        surface,
        max(map(len, normal)),
        np.array(sorted({ord(p[i]) << 21 | ord(p[i + 1]) for p in normal for i in range(len(p) - 1)}), np.int64),
    )


def units(text: str, prefix: bool = True) -> list[str]:
    """The parts of a text that are encoded by themselves."""
    return _UNIT.findall((SPACE if prefix and text else "") + text.replace(" ", SPACE))


def words(text: str, prefix: bool = True) -> list[str]:
    """The parts between a text's spaces; ``word_units`` gives the units of each.

    A part is written without the first space before it, which the prefix gives
    to the first one too.
    """
    if not prefix:
        return units(text, False)
    if not text:
        return []
    if text[0] == " " or "  " in text or SPACE in text:
        return [w[1:] for w in _SPACED.findall(SPACE + text.replace(" ", SPACE))]
    return text.split(" ")


def word_units(word: str, prefix: bool = True) -> list[str]:
    if prefix and SPACE not in word and "\n" not in word:
        return [SPACE + word]
    return _UNIT.findall(SPACE + word) if prefix else [word]


def split_units(found: list[str], own: Model) -> tuple[list[str], list[int]]:
    """Parts of units between which no piece can lie, and how many parts each unit has.

    A unit is cut between two characters that stand in no piece together.
    """
    text = "".join(found)
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    near = (codes[:-1] << 21) | codes[1:]
    pairs = own.pairs
    at = np.searchsorted(pairs, near)
    cut = np.append(pairs[np.minimum(at, len(pairs) - 1)] != near, True)[: len(codes)] if len(pairs) else np.ones(len(codes), bool)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
    cut[ends - 1] = True
    bounds = (np.flatnonzero(cut) + 1).tolist()
    counts = np.diff(np.cumsum(cut)[ends - 1], prepend=0).tolist()
    return [text[a:b] for a, b in zip([0, *bounds], bounds, strict=False)], counts


def lattice(unit_rows: DataFrame, own: Model) -> DataFrame:
    """Add the edges of each distinct ``unit``: keys, pids, ranks, scores, begins and ends.

    Each start is joined to the lengths of the pieces that begin with its first
    three characters, and the substrings of these lengths to the piece table, both
    by equality. A key is start * (longest + 1) + length, and edges are in order of
    rank and start; single characters are edges of unigram models only. Both
    tables come from a vocabulary file, whose row count is checked, and are
    broadcast, so a unit's edges stay adjacent and are gathered where they are.
    """
    spark = unit_rows.sparkSession
    if len(own.ids) > BROADCAST_ROWS:
        raise ValueError("the vocabulary is too large to be broadcast")
    heads: dict[str, set[int]] = {}
    for p in own.ids:
        if len(p) >= HEAD:
            heads.setdefault(p[:HEAD], set()).add(len(p))
    short = list(range(1 if own.unigram else 2, HEAD))
    lengths = spark.createDataFrame([(h, sorted(n)) for h, n in heads.items()] or [("", [0])], "head string, lengths array<int>")
    # The empty piece is that of a unit's first row, which carries the unit itself.
    pieces = spark.createDataFrame(
        [("", -1, _NONE, 0.0), *[(p, i, own.ranks[p], own.scores[p]) for p, i in own.ids.items() if len(p) >= short[0]]],
        "piece string, pid int, rank int, score double",
    )
    width = own.longest + 1
    others = [c for c in unit_rows.columns if c != "unit"]
    numbered = unit_rows.withColumn("uid", F.monotonically_increasing_id())
    starts = numbered.select("*", F.explode(F.sequence(F.lit(0), F.length("unit") - 1)).alias("i"))
    tried = starts.withColumn("head", F.substring(F.col("unit"), F.col("i") + 1, F.lit(HEAD))).join(
        F.broadcast(lengths), "head", "left"
    )
    none, least = F.array().cast("array<int>"), F.array(*map(F.lit, short))
    every = F.concat(F.when(F.col("i") == 0, F.array(F.lit(0))).otherwise(none), least, F.coalesce("lengths", none))
    cut = tried.select(*numbered.columns, "i", F.explode(every).alias("n")).where("i + n <= length(unit)")
    first = F.col("n") == 0
    edges = (
        cut.select(
            "uid",
            *[F.when(first, F.col(c)).alias(c) for c in ("unit", *others)],
            (F.col("i") * width + F.col("n")).alias("key"),
            F.substring(F.col("unit"), F.col("i") + 1, F.col("n")).alias("piece"),
        )
        .join(F.broadcast(pieces), "piece")
        .select("uid", *unit_rows.columns, "key", "pid", "rank", "score")
    )
    fields = unit_rows.schema.fields
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in fields]) + (
        ", keys array<int>, pids array<int>, ranks array<int>, scores array<double>, begins array<int>, ends array<int>"
    )

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
            whole = table.to_batches()[0] if len(table) else batch
            uid = whole.column("uid").to_numpy()
            new = np.flatnonzero(uid[1:] != uid[:-1])
            cut_at = int(new[-1]) + 1 if len(new) else 0
            rest = whole.slice(cut_at)
            if cut_at:
                yield lists(whole.slice(0, cut_at))
        if rest is not None and len(rest):
            yield lists(rest)
        release()

    def lists(rows: pa.RecordBatch) -> pa.RecordBatch:
        uid = rows.column("uid").to_numpy()
        first = np.flatnonzero(np.concatenate([[True], uid[1:] != uid[:-1]]))
        at = pa.array(first)
        unit = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(uid))))
        key = rows.column("key").to_numpy()
        begin, size = key // width, key % width
        own_rows = np.flatnonzero(size)
        rank = np.where(size > 1, rows.column("rank").to_numpy(), _NONE)[own_rows]
        order = pa.array(own_rows[np.lexsort([key[own_rows], rank, unit[own_rows]])])
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(unit[own_rows], minlength=len(first)))]).astype(np.int32))
        values = [*[rows.column(c) for c in ("key", "pid", "rank", "score")], pa.array(begin), pa.array(begin + size)]
        edge = [pa.ListArray.from_arrays(offsets, v.take(order)) for v in values]
        return pa.RecordBatch.from_arrays(
            [*[rows.column(f.name).take(at) for f in fields], *edge],
            [*[f.name for f in fields], "keys", "pids", "ranks", "scores", "begins", "ends"],
        )

    return edges.mapInArrow(gathered, schema)


def _edge(values: str, start, length, width: int):
    """The value of the edge (start, length), null where there is none."""
    return F.get(F.col(values), (F.array_position("keys", (start * width + length).cast("int")) - 1).cast("int"))


def _in_rank_order(width: int):
    """BPE by one fold over the edges: for each character the end of the symbol it begins, -1 inside one.

    An edge that joins two neighbouring symbols when its turn comes is the best
    merge there is. Only a merge that allows an edge whose turn is over needs
    more: then the result is empty.
    """

    def step(ends, k):
        begin, end = F.get("begins", k), F.get("ends", k)
        middle = F.get(ends, begin)
        # Sliced, not transformed: a lambda would work out begin, middle and end for each character.
        merged = F.concat(
            F.slice(ends, 1, begin),
            F.array(end),
            F.slice(ends, begin + 2, middle - begin - 1),
            F.array(F.lit(-1)),
            F.slice(ends, middle + 2, F.size(ends)),
        )
        left = F.array_position(ends, begin).cast("int") - 1
        after = F.array_position("keys", begin * width + F.get(ends, end) - begin)
        before = F.array_position("keys", left * width + end - left)
        late = after.between(1, k) | before.between(1, k)
        return F.when(
            F.get(ends, middle) == end, F.when(late, F.array().cast("array<int>")).otherwise(merged)
        ).otherwise(ends)

    size = F.length("unit")
    start = F.transform(F.sequence(F.lit(0), size), lambda i: F.when(i < size, i + 1).otherwise(-1))
    # Without edges the fold's steps, 0 and -1, find none and change nothing.
    return F.aggregate(F.sequence(F.lit(0), F.size("keys") - 1), start, step)


def _merged(width: int):
    """Boundaries after BPE: a fold that drops the boundary of the best merge until none is left."""

    def step(state, _):
        bounds = state["bounds"]
        ranks = F.transform(
            F.sequence(F.lit(1), F.size(bounds) - 2),
            lambda k: F.struct(
                F.coalesce(
                    _edge("ranks", F.get(bounds, k - 1), F.get(bounds, k + 1) - F.get(bounds, k - 1), width), F.lit(_NONE)
                ).alias("rank"),
                k.alias("at"),
            ),
        )
        best = F.when(F.size(bounds) > 2, F.array_min(ranks))
        # One-row arrays name the best merge, so that it is computed once.
        return F.when(state["done"], state).otherwise(
            F.get(
                F.transform(
                    F.array(best),
                    lambda b: F.when(
                        b.isNull() | (b["rank"] == _NONE),
                        F.struct(bounds.alias("bounds"), F.lit(True).alias("done")),
                    ).otherwise(
                        F.struct(
                            F.filter(bounds, lambda x: x != F.get(bounds, b["at"])).alias("bounds"),
                            F.lit(False).alias("done"),
                        )
                    ),
                ),
                F.lit(0),
            )
        )

    size = F.length("unit")
    start = F.struct(F.sequence(F.lit(0), size).alias("bounds"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), size), start, step, lambda s: s["bounds"])


def _viterbi(width: int, longest: int, unknown: float):
    """Boundaries of the best-scored path: a fold over end positions keeps score and length of the last edge."""

    def step(state, end):
        best = F.array_max(
            F.transform(
                F.sequence(F.least(F.lit(longest), end), F.lit(1), F.lit(-1)),
                lambda n: F.struct(
                    (
                        F.coalesce(_edge("scores", end - n, n, width), F.when(n == 1, F.lit(unknown)), F.lit(float("-inf")))
                        + F.get(state["score"], end - n)
                    ).alias("score"),
                    n.alias("n"),  # of equal scores the longest last piece
                ),
            )
        )
        return F.get(
            F.transform(
                F.array(best),
                lambda b: F.struct(
                    F.concat(state["score"], F.array(b["score"])).alias("score"),
                    F.concat(state["n"], F.array(b["n"])).alias("n"),
                ),
            ),
            F.lit(0),
        )

    size = F.length("unit")
    start = F.struct(F.array(F.lit(0.0)).alias("score"), F.array(F.lit(0)).alias("n"))
    back = F.aggregate(F.sequence(F.lit(1), size), start, step, lambda s: s["n"])
    return F.aggregate(
        F.sequence(F.lit(1), size),
        F.array(size),
        lambda path, _: F.when(F.get(path, F.lit(0)) == 0, path).otherwise(
            F.concat(F.array(F.get(path, F.lit(0)) - F.get(F.col("back"), F.get(path, F.lit(0)))), path)
        ),
    ), back


def encode_units(unit_rows: DataFrame, own: Model) -> DataFrame:
    """Add ``ids`` to distinct units of at most LONGEST characters.

    A character c that is left by itself is -1 - c, but in unigram models only if
    it is no piece; ``with_bytes`` gives the ids of such characters.
    """
    width = own.longest + 1
    edges = lattice(unit_rows, own)
    if own.unigram:
        path, back = _viterbi(width, own.longest, min(own.scores.values()) - 10.0)
        edges = edges.withColumn("back", back).withColumn("bounds", path)
    else:
        # Generators fix both folds, which would be worked out with every use.
        edges = edges.select("*", F.explode(F.array(_in_rank_order(width))).alias("symbols"))
        size = F.length("unit")
        opens = F.filter(F.sequence(F.lit(0), size), lambda i: (i == size) | (F.get("symbols", i) > 0))
        bounds = F.when(F.size("symbols") == 0, _merged(width)).otherwise(opens)
        edges = edges.select("*", F.explode(F.array(bounds)).alias("bounds"))
    ids = F.transform(
        F.sequence(F.lit(1), F.size("bounds") - 1),
        lambda k: F.get(
            F.transform(
                F.array(F.get("bounds", k - 1)),
                lambda b: F.coalesce(
                    _edge("pids", b, F.get("bounds", k) - b, width), -1 - F.ascii(F.substring(F.col("unit"), b + 1, F.lit(1)))
                ),
            ),
            F.lit(0),
        ),
    )
    return edges.select(*unit_rows.columns, ids.alias("ids"))


def with_bytes(ids: list[int], own: Model) -> np.ndarray:
    """Ids as the library gives them: single characters become their piece or byte pieces."""
    if min(ids, default=0) >= 0:
        return np.array(ids, np.int32)
    out: list[int] = []
    for i in ids:
        if i < 0 and (piece := own.ids.get(chr(-1 - i))) is None:
            out += [own.bytes_[b] for b in chr(-1 - i).encode()]
        else:
            out.append(i if i >= 0 else piece)
    return np.array(out, np.int32)


def long_unit(unit: str, own: Model) -> list[int]:
    """A unit beyond the lattice's length, by a heap of merges or a forward pass over its edges."""
    if own.unigram:
        unknown = min(own.scores.values()) - 10.0
        best, back = [0.0], [0]
        for end in range(1, len(unit) + 1):
            found = []
            for n in range(min(own.longest, end), 0, -1):
                score = own.scores.get(unit[end - n : end], unknown if n == 1 else None)
                if score is not None:
                    found.append((best[end - n] + score, n))
            score, n = max(found)
            best.append(score)
            back.append(n)
        bounds, at = [], len(unit)
        while at:
            bounds.append((at - back[at], at))
            at -= back[at]
        parts = [unit[b:e] for b, e in reversed(bounds)]
    else:
        left, right = list(range(-1, len(unit) - 1)), list(range(1, len(unit) + 1))
        text: list[str | None] = list(unit)
        heap = [(own.ranks[a], i, a) for i in range(len(unit) - 1) if (a := unit[i : i + 2]) in own.ranks]
        heapq.heapify(heap)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = right[i]
            if text[i] is None or j >= len(unit) or text[i] + text[j] != joined:
                continue
            text[i], text[j] = joined, None
            right[i] = right[j]
            if right[j] < len(unit):
                left[right[j]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b < len(unit) and (both := text[a] + text[b]) in own.ranks:
                    heapq.heappush(heap, (own.ranks[both], a, both))
        parts = [t for t in text if t is not None]
    return [own.ids.get(p, -1 - ord(p[0])) for p in parts]


def encode(
    docs: DataFrame,
    model_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    table_size: int = TABLE,
) -> DataFrame:
    """Encode documents as the library does: id, ids (array of int), n_tokens, text_sha256.

    Texts are cut into units at spaces. The units that are frequent over all
    documents are encoded once and broadcast, at most ``table_size``. The others
    are cut where no piece can lie and grouped over all documents, encoded once each by the lattice and its
    fold, and sent back to the blocks of documents that hold them, where ids are
    put together. Blocks travel compressed, and no task holds more than a few.
    Units over LONGEST characters are folded inside the block.

    Null and empty texts have no ids. Rows that repeat an id are encoded one by
    one. An empty table gives an empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    own, source = model(model_path), prepared(docs, id=id_col, text=text_col)
    prefix, opening = own.prefix, SPACE if own.prefix else ""

    def cut(text: str) -> list[str]:
        return words(text, prefix)

    def short_units(word: str) -> list[str]:
        return [u for u in word_units(word, prefix) if len(u) <= LONGEST]

    frequent = frequent_pieces(spark, source, cut, table_size, NAMED, short_units)
    rows = spark.createDataFrame([(u,) for u in frequent], "unit string").repartition("unit")
    encoded = encode_units(rows, own).collect()  # at most table_size rows
    table = spark.sparkContext.broadcast({r.unit: with_bytes(r.ids, own).tobytes() for r in encoded})

    def packed(part: pa.RecordBatch) -> tuple[int, pa.Buffer]:
        """A block of documents under a name made from its content."""
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part.schema) as writer:
            writer.write_batch(part)
        payload = sink.getvalue()
        return xxh64_intdigest(payload) - (1 << 63), payload

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, mine = table.value, _own_model(model_path)
        for part in slices(batches, size=SLICE):
            held: set[str] = set()
            for text in part.column("text").to_pylist():
                held.update(words(text, prefix))
            # A unit in the table is all that its word consists of.
            found = {u for w in held if opening + w not in known for u in word_units(w, prefix)}
            parts = set(split_units([u for u in found if u not in known], mine)[0])
            own_units = [p for p in parts if len(p) <= LONGEST and p not in known]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own_units, pa.string()), pa.array([packed(part)[0]] * len(own_units), pa.int64())], ["unit", "block"]
            )
        release()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, size=SLICE):
            block, payload = packed(part)
            payload = zstandard.compress(payload, 6)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([payload], pa.binary())], ["block", "payload"])
        release()

    grouped = source.mapInArrow(rare, "unit string, block long").groupBy("unit").agg(F.collect_set("block").alias("blocks"))
    sent = encode_units(grouped, own).select("blocks", "ids").mapInArrow(_to_blocks, f"block long, {_SENT}")
    held = source.mapInArrow(blocks, "block long, payload binary")
    both = sent.withColumn("payload", F.lit(None).cast("binary")).unionByName(held, allowMissingColumns=True)
    kind = source.schema["id"].dataType.simpleString()
    id_type = _arrow_type(kind)

    def joined(rows: pa.Table) -> pa.Table:
        import hashlib

        mine = _own_model(model_path)
        # The block's own units first, then the table, which all blocks share.
        own_units: dict[str, bytes] = {}
        known = table.value
        payloads = rows.column("payload").drop_null().to_pylist()
        for row in rows.filter(rows.column("codes").is_valid()).select(["n", "codes"]).to_pylist():
            own_units.update(_unpacked(**row, own=mine))

        def ids_of(found: set[str]) -> dict[str, bytes]:
            by_word, late = {}, []
            for w in found:
                if (ids := known.get(u := opening + w)) is None and (ids := own_units.get(u)) is None:
                    late.append(w)
                else:
                    by_word[w] = ids
            cuts = [word_units(w, prefix) for w in late]
            # What the block holds has no place to be split at.
            others = list({u for c in cuts for u in c if u not in known and u not in own_units})
            parts, counts = split_units(others, mine)
            part_ids, at, by_unit = [_part_ids(p, own_units, known, mine) for p in parts], 0, {}
            for u, n in zip(others, counts, strict=True):
                by_unit[u] = part_ids[at] if n == 1 else b"".join(part_ids[at : at + n])
                at += n
            for w, c in zip(late, cuts, strict=True):
                by_word[w] = b"".join([by_unit.get(u) or known.get(u) or own_units[u] for u in c])
            return by_word

        out: dict[str, list] = {"id": [], "ids": [], "n": [], "sha": []}
        for payload in payloads:
            for part in pa.ipc.open_stream(zstandard.decompress(payload)):
                out["id"] += part.column("id").to_pylist()
                texts = part.column("text").to_pylist()
                found: set[str] = set()
                for text in texts:
                    found.update(words(text, prefix))
                by_word = ids_of(found)
                for text in texts:  # cut again: all words of a block would fill the worker
                    out["ids"].append(np.frombuffer(b"".join(map(by_word.__getitem__, words(text, prefix))), np.int32))
                    out["n"].append(len(out["ids"][-1]))
                    out["sha"].append(hashlib.sha256(text.encode()).hexdigest())
        offsets = np.concatenate([[0], np.cumsum(out["n"])]).astype(np.int32)
        flat = np.concatenate(out["ids"]) if out["ids"] else np.zeros(0, np.int32)
        release()
        return pa.table(
            {
                "id": pa.array(out["id"], id_type),
                "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                "n_tokens": pa.array(out["n"], pa.int64()),
                "text_sha256": pa.array(out["sha"], pa.string()),
            }
        )

    schema = f"id {kind}, ids array<int>, n_tokens long, text_sha256 string"
    return both.groupBy("block").applyInArrow(joined, schema)


_SENT = "n int, codes binary"


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units and their ids put together by the blocks that hold them, one row a block.

    ``codes`` has, compressed, a byte for each of ``n`` units, the number of its
    ids (at most LONGEST), then all ids, first their lowest bytes. The ids alone
    say what the units are: their pieces, put together.
    """
    waiting, n, packer = [], 0, zstandard.ZstdCompressor(3)

    def rows() -> pa.RecordBatch:
        table = pa.Table.from_batches(waiting).select(["blocks", "ids"]).combine_chunks()
        lists, ids = table.column("blocks").chunk(0), table.column("ids").chunk(0)
        block = lists.flatten().to_numpy()
        order = np.argsort(block, kind="stable")
        block = block[order]
        of = np.asarray(pc.list_parent_indices(lists))[order]
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        ends = np.append(first[1:], len(block)).tolist()
        out = {"n": [], "codes": []}
        flat, begins = ids.flatten().to_numpy(), ids.offsets.to_numpy().astype(np.int64)
        begins -= begins[0]
        counts = np.diff(begins)
        for begin, end in zip(first.tolist(), ends, strict=True):
            mine = of[begin:end]
            sizes = counts[mine]
            codes = flat[np.repeat(begins[mine] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
            planes = codes.astype("<i4").view(np.uint8).reshape(-1, 4).T
            out["n"].append(len(mine))
            out["codes"].append(packer.compress(sizes.astype(np.uint8).tobytes() + planes.tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array(block[first]), pa.array(out["n"], pa.int32()), pa.array(out["codes"], pa.binary())], ["block", *out]
        )

    for batch in batches:
        if len(batch):
            waiting.append(batch)
            n += len(batch.column("blocks").flatten())
        if n >= PACKED:
            yield rows()
            waiting, n = [], 0
    if n:
        yield rows()
    waiting = []
    release()


def _unpacked(n: int, codes: bytes, own: Model) -> dict[str, bytes]:
    """Units of a block and their ids as bytes."""
    codes = zstandard.decompress(codes)
    sizes = np.frombuffer(codes, np.uint8, n).astype(np.int64)
    flat = np.ascontiguousarray(np.frombuffer(codes, np.uint8, offset=n).reshape(4, -1).T).view("<i4").ravel()
    names = worker_cache("sentencepiece", "names", lambda: _names(own))
    parts = [names[i] if i >= 0 else chr(-1 - i) for i in flat.tolist()]
    ends, text = np.cumsum(sizes), "".join(parts)
    bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])[ends].tolist()
    texts = [text[a:b] for a, b in zip([0, *bounds], bounds, strict=False)]
    by_char = worker_cache("sentencepiece", "characters", lambda: _characters(own))
    ids = flat.copy()
    alone = (flat < 0) & (flat >= -len(by_char))
    ids[alone] = by_char[-1 - flat[alone]]
    raw, at = ids.tobytes(), (ends * 4).tolist()
    found = {u: raw[b:e] for u, b, e in zip(texts, [0, *at], at, strict=False)}
    for i in np.unique(np.searchsorted(ends, np.flatnonzero(ids < 0), side="right")).tolist():
        found[texts[i]] = with_bytes(ids[ends[i] - sizes[i] : ends[i]].tolist(), own).tobytes()
    return found


def _names(own: Model) -> list[str]:
    """Pieces by id."""
    names = [""] * len(own.surface)
    for p, i in own.ids.items():
        names[i] = p
    return names


def _characters(own: Model) -> np.ndarray:
    """Ids of single characters below 65,536, -1 - c for a character c without piece."""
    ids = -1 - np.arange(1 << 16, dtype=np.int32)
    for p, i in own.ids.items():
        if len(p) == 1 and ord(p) < len(ids):
            ids[ord(p)] = i
    return ids


def _own_model(path: str) -> Model:
    """The model, kept by this worker in place of what other operators left."""
    return worker_cache("sentencepiece", path, lambda: model(path))


def _part_ids(part: str, words: dict[str, bytes], known: dict[str, bytes], own: Model) -> bytes:
    """Ids of a part: from the table or the lattice, or merged here if it is too long for it."""
    if (ids := known.get(part)) is None and (ids := words.get(part)) is None:
        ids = words[part] = with_bytes(long_unit(part, own), own).tobytes()
    return ids


def _arrow_type(kind: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    return to_arrow_type(StructType.fromDDL(f"x {kind}")["x"].dataType)


def decode_ids(ids: np.ndarray, own: Model) -> str:
    """The text of one document's ids; ids without surface add nothing, broken bytes become U+FFFD."""
    text = b"".join(map(own.surface.__getitem__, ids.tolist())).decode("utf-8", "replace")
    return text[1:] if own.prefix and text.startswith(" ") else text


def decode(encoded: DataFrame, model_path: str, *, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the decoded text of each row's ids; null ids give a null text. Nothing is shuffled."""

    ship(encoded.sparkSession)

    @F.pandas_udf("string")
    def text_of(rows):
        own = model(model_path)
        return rows.map(lambda ids: None if ids is None else decode_ids(np.asarray(ids), own))

    return encoded.withColumn(into, text_of(F.col(f"`{ids_col}`")))
