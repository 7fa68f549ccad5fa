"""Byte-level BPE by replaying the merges over a corpus of words at once."""

from __future__ import annotations

import heapq
from base64 import b64decode
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from beatline.llm.common import prepared, ship, slices

#: Matches a worker remembers in each of two generations, and the longest of them in characters.
MATCHES, LONGEST = 250_000, 64

#: Bytes of text, or of ids, worked on at once.
SLICE = 1 << 20


@dataclass(frozen=True)
class Ranks:
    """A rank file: the ids of byte strings, and the strings by id."""

    ids: dict[bytes, int]
    strings: list[bytes]
    #: Rank of each pair of single bytes, ``NONE`` where they do not merge, and ids of single bytes.
    pairs: np.ndarray
    bytes_: np.ndarray


#: No rank: larger than every rank.
NONE = 1 << 40


@lru_cache(maxsize=2)
def ranks(path: str) -> Ranks:
    ids = {}
    with open(path, "rb") as file:
        for line in file:
            if line.strip():
                token, rank = line.split()
                ids[b64decode(token)] = int(rank)
    strings = [b""] * (max(ids.values()) + 1)
    for token, i in ids.items():
        strings[i] = token
    pairs = np.full(1 << 16, NONE, np.int64)
    for token, i in ids.items():
        if len(token) == 2:
            pairs[token[0] << 8 | token[1]] = i
    return Ranks(ids, strings, pairs, np.array([ids[bytes([b])] for b in range(256)], np.int64))


def replay(words: list[bytes], own: Ranks) -> list[bytes]:
    """The ids of each word, as little-endian 32-bit integers, by one replay of the merges over all of them.

    The words lie end to end as symbols. An index from a pair's rank to the
    positions of that pair is worked off in rank order: the positions of the
    lowest rank are merged from left to right, and only the pairs of a merge
    with its two neighbours are looked up and indexed anew. A rank lower than
    the one at work, should a merge bring one about, goes first, so each word
    meets its merges in the order in which it would meet them alone. A word that
    is itself a token is that token; an empty word has no ids.
    """
    found = [None if (i := own.ids.get(w)) is None else i.to_bytes(4, "little") for w in words]
    todo = [k for k, ids in enumerate(found) if ids is None]
    if todo:
        # A symbol past each word's last keeps pairs inside words.
        ends = np.cumsum(np.array([len(words[k]) + 1 for k in todo], np.int64))
        raw = np.frombuffer(b"\0".join([words[k] for k in todo]) + b"\0", np.uint8).astype(np.int64)
        symbols = own.bytes_[raw]
        symbols[ends - 1] = -1
        first = own.pairs[(raw[:-1] << 8) | raw[1:]]
        first[(symbols[:-1] < 0) | (symbols[1:] < 0)] = NONE
        merged = np.array(_merge(symbols.tolist(), first, own), np.int64)
        left = merged >= 0
        ids = merged[left].astype("<u4").tobytes()
        cuts = (4 * np.cumsum(left)[ends - 1]).tolist()
        for k, begin, end in zip(todo, [0, *cuts], cuts, strict=False):
            found[k] = ids[begin:end]
    return found


def _merge(symbols: list[int], first: np.ndarray, own: Ranks) -> list[int]:
    """``symbols`` after all merges; a symbol merged into the one before it becomes -2, a word's end is -1.

    ``first`` has the rank of each symbol and the next.
    """
    size = len(symbols)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    rank_at = [*first.tolist(), NONE]  # of the pair that a position begins
    spots = np.flatnonzero(first < NONE)
    spots = spots[np.argsort(first[spots], kind="stable")]
    kept = first[spots]
    cuts = np.flatnonzero(np.diff(kept, prepend=-1))
    index = {
        int(kept[a]): spots[a:b].tolist() for a, b in zip(cuts, np.append(cuts[1:], len(kept)), strict=False)
    }
    queue = sorted(index)  # a sorted list is a heap
    strings, rank_of, bucket = own.strings, own.ids.get, index.get
    while queue:
        rank = heapq.heappop(queue)
        places = index.pop(rank)
        places.sort()
        joined = strings[rank]
        for done, at in enumerate(places):
            if rank_at[at] != rank:
                continue  # an overlapping merge was first
            gone = after[at]
            symbols[at], symbols[gone] = rank, -2
            rank_at[gone] = NONE
            right = after[at] = after[gone]
            before[right] = at
            sooner = False
            left = before[at]
            if left >= 0 and (s := symbols[left]) >= 0:
                new = rank_at[left] = rank_of(strings[s] + joined, NONE)
                if new < NONE:
                    if (spots := bucket(new)) is None:
                        index[new] = [left]
                        heapq.heappush(queue, new)
                        sooner = new < rank
                    else:
                        spots.append(left)
            if (s := symbols[right]) >= 0:
                new = rank_at[at] = rank_of(joined + strings[s], NONE)
                if new < NONE:
                    if (spots := bucket(new)) is None:
                        index[new] = [at]
                        heapq.heappush(queue, new)
                        sooner = sooner or new < rank
                    else:
                        spots.append(at)
            else:
                rank_at[at] = NONE
            if sooner:
                index.setdefault(rank, []).extend(places[done + 1 :])
                heapq.heappush(queue, rank)
                break
    return symbols


class _Known:
    """Values of strings met lately, in two generations of at most ``limit``; longer strings are forgotten at once."""

    def __init__(self, work: Callable[[list[str]], list[bytes]], limit: int):
        self.work, self.limit = work, limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def values(self, strings: list[str]) -> list[bytes]:
        young, old = self.young, self.old
        found = list(map(young.get, strings))
        gaps = [i for i, v in enumerate(found) if v is None]
        if gaps:
            fresh = []
            for s in {strings[i] for i in gaps}:
                if (v := old.get(s)) is None:
                    fresh.append(s)
                else:
                    young[s] = v
            young.update(zip(fresh, self.work(fresh), strict=True))
            for i in gaps:
                found[i] = young[strings[i]]
            for s in fresh:
                if len(s) > LONGEST:
                    del young[s]
            if len(young) > self.limit:
                self.old, self.young = young, {}
        return found


_KNOWN: dict[str, _Known] = {}


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode documents: id, ids (little-endian unsigned 32-bit integers as bytes), n_tokens.

    Each match of ``pattern`` is merged by itself, as tiktoken does. Matches that
    a worker has met lately come from its bounded memory, and the new ones of a
    slice of documents form the corpus over which the merges are replayed.
    Nothing is shuffled, and a task that is lost is simply done again.

    Null and empty texts have no ids. Rows that repeat an id are encoded one by
    one. An empty table gives an empty result; other columns are not looked at.
    """
    own = prepared(docs, id=id_col, text=text_col)
    kind = own.schema["id"].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(pattern).findall
        if ranks_path not in _KNOWN:
            _KNOWN[ranks_path] = _Known(lambda new: replay([m.encode() for m in new], ranks(ranks_path)), MATCHES)
        known = _KNOWN[ranks_path].values
        for part in slices(batches, size=SLICE):
            every, cuts = [], [0]
            for text in part.column("text").to_pylist():
                every += find(text)
                cuts.append(len(every))
            values = known(every)
            ids = [b"".join(values[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
            sizes = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(ids, pa.binary()), sizes], ["id", "ids", "n_tokens"])

    return own.mapInArrow(encoded, f"id {kind}, ids binary, n_tokens long")


def decode(encoded: DataFrame, ranks_path: str, *, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the bytes that each row's ids stand for; null ids give null. Nothing is shuffled."""
    ship(encoded.sparkSession)
    schema = T.StructType([*[f for f in encoded.schema if f.name != into], T.StructField(into, T.BinaryType())])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        string = ranks(ranks_path).strings.__getitem__
        for part in slices(batches, ids_col, SLICE):
            texts = [
                None if x is None else b"".join(map(string, np.frombuffer(x, "<u4").tolist()))
                for x in part.column(ids_col).to_pylist()
            ]
            kept = [c for c in part.schema.names if c != into]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(texts, pa.binary())], [*kept, into])

    return encoded.mapInArrow(decoded, schema)
