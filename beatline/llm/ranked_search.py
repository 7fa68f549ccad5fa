"""Ranked lexical search: sketches of maxima bound every score, and exact scores are asked for in that order."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from beatline.llm.common import prepared, slices
from beatline.runtime import store

#: Coordinates of a sketch.
WIDTH = 512

#: UTF-8 bytes of queries that are looked up in one pass over the documents.
QUERY_BYTES = 8 << 20

#: Documents bounded at once, queries bounded at once, and documents rescored at once.
ROWS, ITEMS, STEP = 8_192, 256, 32

#: Tasks' own best lists of one query that are merged in one task of the first merge.
MERGED = 1_000

# Fixed value: terms are runs of the characters this table does not turn into a
# space; of the letters, only A-Z change case.
_TERM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms(text: str) -> list[bytes]:
    """The terms of a text, as UTF-8."""
    return text.encode().translate(_TERM).split()


@dataclass(frozen=True)
class Lookup:
    """A block of queries: their terms' numbers, sketch coordinates and weights."""

    numbers: dict[bytes, int]
    coordinates: np.ndarray
    #: Per query its term numbers and how often it asks for each.
    asked: list[tuple[np.ndarray, np.ndarray]]


def lookup(texts: list[str], width: int) -> Lookup:
    numbers: dict[bytes, int] = {}
    asked = []
    for text in texts:
        wanted: dict[int, int] = {}
        for t in terms(text):
            k = numbers.setdefault(t, len(numbers))
            wanted[k] = wanted.get(k, 0) + 1
        asked.append((np.array(list(wanted), np.int64), np.array(list(wanted.values()), np.int64)))
    coordinates = np.array([xxh64_intdigest(t) % width for t in numbers], np.int64)
    return Lookup(numbers, coordinates, asked)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What ``tf`` occurrences add to a score, before the term's weight; it rises with ``tf``."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def index(docs: DataFrame, queries: Lookup, width: int = WIDTH) -> DataFrame:
    """Per document: id, n (its terms), sketch, and the queries' terms it holds with their counts.

    ``sketch`` keeps per coordinate the most occurrences of one of the queries'
    terms hashed there; as an impact rises with them, it is the coordinatewise
    maximum of impacts, whatever length norm is set later. Terms that no query
    asks for would only loosen the bounds and are left out. Coordinates are
    stored as pairs of place and count.
    """
    kind = docs.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(queries)

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.numbers.get
        coordinate = shared.value.coordinates
        for part in slices(batches):
            sizes, held, cuts = [], [], [0]
            for text in part.column("text").to_pylist():
                found = terms(text)
                sizes.append(len(found))
                known = [k for k in map(number, found) if k is not None]
                held.append(np.array(known, np.int64))
                cuts.append(len(known))
            flat = np.concatenate(held) if held else np.zeros(0, np.int64)
            doc = np.repeat(np.arange(len(sizes)), cuts[1:])
            span = max(1, len(coordinate))
            keys, counts = np.unique(doc * span + flat, return_counts=True)
            doc, term = keys // span, keys % span
            places = doc * width + coordinate[term] if len(term) else doc
            order = np.argsort(places, kind="stable")
            first = np.flatnonzero(np.diff(places[order], prepend=-1)) if len(order) else np.zeros(0, np.int64)
            most = np.maximum.reduceat(counts[order], first) if len(first) else first
            spots = places[order][first] if len(first) else first
            own = [
                part.column("id"), pa.array(sizes, pa.int64()),
                _lists(spots // width, len(sizes), spots % width, pa.int32()), _lists(spots // width, len(sizes), most, pa.int64()),
                _lists(doc, len(sizes), term, pa.int32()), _lists(doc, len(sizes), counts, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(own, ["id", "n", "places", "most", "terms", "tfs"])

    return docs.mapInArrow(
        folded, f"id {kind}, n long, places array<int>, most array<long>, terms array<int>, tfs array<long>"
    )


def _lists(row: np.ndarray, rows: int, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """``values`` as one list per row, ``row`` rising."""
    offsets = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _ragged(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each value, values, offsets) of a list column."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.int64)
    offsets = offsets - offsets[0]
    return np.repeat(np.arange(len(column)), np.diff(offsets)), values, offsets


class _Best:
    """A task's best documents of one query: (-score, id) ascending, at most ``top``."""

    def __init__(self, top: int):
        self.top, self.found = top, []

    def floor(self) -> int:
        """The score a further document must reach."""
        return -self.found[-1][0] if len(self.found) == self.top else 1

    def add(self, scored: list[tuple[int, int]]) -> None:
        self.found = sorted([*self.found, *scored])[: self.top]


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = 10,
    width: int = WIDTH,
) -> DataFrame:
    """The ``top`` best documents of each item: item_id, rank, doc_id, score.

    Terms are runs of ASCII letters, ASCII digits and all characters beyond
    ASCII, A-Z lower-cased. A document's score sums, over the item's terms with
    repeats, the term's weight floor(1000 ln((2N+2)/(2df+1))) times
    (10^9 tf) div (1000 tf + 8 m), with m = 25 + (75 n N) div L. Documents that
    score 0 are not listed; equal scores are in the order of ids.

    One pass folds each document into a sketch and counts what the scores need;
    a second one reads that index only. There the queries, as one matrix, look
    up all sketches of a batch for upper bounds; a query's documents are then
    scored exactly, the highest bounds first, until the next bound is below the
    task's ``top``-th score. Tasks hand on at most ``top`` rows a query, which
    are merged in two rounds, so no task meets a query's rows of all tasks.

    Queries are taken in blocks of about QUERY_BYTES of text, each one pass.
    Null and empty texts have no terms. Rows that repeat an id are documents or
    items of their own. Ids of documents must be integers; a null id is ranked
    before others of its score. Empty tables give an empty result. Other columns
    are not looked at.
    """
    spark = docs.sparkSession
    own = prepared(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    asked = store(prepared(items, id=item_col, text=item_text_col), "search-items")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // QUERY_BYTES) or 1
    found = None
    for i in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == i) if blocks > 1 else asked
        rows = part.orderBy("id", "text").collect()  # about QUERY_BYTES of text
        answers = _answers(own, [r.text for r in rows], top, width)
        names = spark.createDataFrame([(k, r.id) for k, r in enumerate(rows)], f"item int, item_id {asked.schema['id'].dataType.simpleString()}")
        named = answers.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = named if found is None else found.unionByName(named)
    return found


def _answers(docs: DataFrame, texts: list[str], top: int, width: int) -> DataFrame:
    """(item, rank, doc_id, score), ``item`` counting the texts from 0."""
    spark = docs.sparkSession
    queries = lookup(texts, width)
    held = store(index(docs, queries, width), "search-index")
    counted = held.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    many, every = counted.docs, counted.terms or 0
    # One row per term of the queries.
    df = np.zeros(len(queries.numbers), np.int64)
    for r in held.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[r["t"]] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2 * many + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    # Per query its terms and their weights times repeats, and the same by coordinate.
    asked = [(t, weights[t] * c) for t, c in queries.asked]
    shared = spark.sparkContext.broadcast((asked, queries.coordinates, len(df)))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, coordinates, vocabulary = shared.value
        best = [_Best(top) for _ in wanted]
        for batch in batches:
            for begin in range(0, len(batch), ROWS):
                _search(batch.slice(begin, ROWS), wanted, coordinates, vocabulary, best)
        out = [(i, rank, doc, -score) for i, b in enumerate(best) for rank, (score, doc) in enumerate(b.found)]
        item, rank, doc, score = zip(*out, strict=True) if out else ((), (), (), ())
        columns = [pa.array(item, pa.int32()), pa.array([None if d == _NULL else d for d in doc], pa.int64()), pa.array(score, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    def _search(batch, wanted, coordinates, vocabulary, best) -> None:
        n = batch.column("n").to_numpy()
        m = 25 + (75 * n * many) // max(1, every)
        ids = batch.column("id").fill_null(_NULL).to_numpy()
        row, place, _ = _ragged(batch.column("places"))
        _, most, _ = _ragged(batch.column("most"))
        sketch = np.zeros((len(batch), width))
        sketch[row, place] = impact(most, m[row])
        owner, term, offsets = _ragged(batch.column("terms"))
        _, tf, _ = _ragged(batch.column("tfs"))
        added = impact(tf, m[owner])
        scale = np.zeros(vocabulary, np.int64)
        for first in range(0, len(wanted), ITEMS):
            some = wanted[first : first + ITEMS]
            matrix = np.zeros((width, len(some)))
            for k, (t, w) in enumerate(some):
                np.add.at(matrix[:, k], coordinates[t], w)
            # Whole numbers below 2^53, so these sums are exact.
            bounds = sketch @ matrix
            peaks = bounds.max(axis=0)
            for k, (t, w) in enumerate(some):
                mine = best[first + k]
                if peaks[k] < mine.floor():
                    continue
                scale[t] = w
                bound = bounds[:, k]
                open_ = np.flatnonzero(bound >= mine.floor())
                open_ = open_[np.argsort(-bound[open_], kind="stable")]
                for step in range(0, len(open_), STEP):
                    rows = open_[step : step + STEP]
                    if bound[rows[0]] < mine.floor():
                        break
                    scores = [int(scale[term[a:b]] @ added[a:b]) for a, b in zip(offsets[rows], offsets[rows + 1], strict=True)]
                    mine.add([(-s, int(ids[r])) for s, r in zip(scores, rows, strict=True) if s > 0])
                scale[t] = 0

    local = held.mapInArrow(searched, "item int, doc_id long, score long").withColumn("task", F.floor(F.spark_partition_id() / MERGED))
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    for keys in (["item", "task"], ["item"]):
        local = local.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return local.select("item", "rank", "doc_id", "score")


_NULL = -(1 << 63)
