"""Token counts by map-side lookup of pre-tokens in two tiers."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatline.llm.common import UNICODE_SPACE, WordCache, prepared, slices

#: Pre-tokens in the broadcast table, candidates a partition names for it, and distinct ones it counts at once.
TABLE, NAMED, COUNTED = 50_000, 1_000, 200_000

#: Longer pre-tokens are encoded each time, so tables and caches stay small.
LONGEST = 64

# Pieces that a byte-level pre-tokeniser never joins: a space and the run after
# it, or white space. The library splits each of them further.
_PIECE = re.compile(f" ?[^{UNICODE_SPACE}]+|[{UNICODE_SPACE}]+(?![^{UNICODE_SPACE}])|[{UNICODE_SPACE}]")


def pieces(text: str, special: str | None) -> tuple[list[str], int]:
    """Pre-token pieces of a text and how many special strings stand in it."""
    if special and special in text:
        parts = text.split(special)
        return [p for part in parts for p in _PIECE.findall(part)], len(parts) - 1
    return _PIECE.findall(text), 0


def load_tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


tokenizer = lru_cache(maxsize=4)(load_tokenizer)


def lengths(path: str, strings: list[str]) -> list[int]:
    encoded = tokenizer(path).encode_batch_fast(strings, add_special_tokens=False)
    return [len(e.ids) for e in encoded]


def most_counted(seen: Counter, size: int) -> Counter:
    """The ``size`` largest counts; of equal ones those met first."""
    if len(seen) <= size:
        return seen
    counts = np.fromiter(seen.values(), np.int64, len(seen))
    least = int(np.partition(counts, len(counts) - size)[len(counts) - size])
    kept = Counter({p: n for p, n in seen.items() if n > least})
    kept.update({p: least for p in islice((p for p, n in seen.items() if n == least), size - len(kept))})
    return kept


def frequent_pieces(
    spark: SparkSession,
    own: DataFrame,
    cut: Callable[[str], list[str]],
    size: int,
    names: int,
    into: Callable[[str], list[str]] | None = None,
) -> list[str]:
    """The pieces that partitions name most often, over all documents.

    ``cut`` gives what is counted of a text, ``into`` the pieces of each such
    part, if they are not the same. Each partition names its ``names`` most
    frequent ones; only these names are added up. The choice changes the speed
    of what follows, never its result.
    """

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for part in slices(batches):
            for text in part.column("text").to_pylist():
                seen.update(cut(text))
            if len(seen) > COUNTED:
                seen = most_counted(seen, COUNTED // 2)
        if into:
            parts: Counter = Counter()
            for part, n in seen.items():
                for p in into(part):
                    parts[p] += n
            seen = parts
        best = sorted(most_counted(seen, names).items(), key=itemgetter(1), reverse=True)
        best = [(p, n) for p, n in best if len(p) <= LONGEST]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in best], pa.string()), pa.array([n for _, n in best], pa.int64())], ["piece", "n"]
        )

    found = own.select("text").mapInArrow(named, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return [r.piece for r in found.orderBy(F.desc("n"), "piece").limit(size).collect()]


_CACHES: dict[str, WordCache] = {}


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    special: str | None = "<|endoftext|>",
    limit: int = 512,
    table_size: int = TABLE,
) -> DataFrame:
    """Count tokens of a byte-level BPE: id, n_bytes, n_tokens, over_limit.

    A text is cut into pieces at which pre-tokens always end. A piece's length
    comes from a broadcast table of at most ``table_size`` frequent pieces or
    from the worker's bounded cache, which the library fills; no text and no
    pre-token is shuffled. ``special`` is the one added token whose string the
    library takes out of texts; it counts as one token.

    Null and empty texts have 0 bytes and 0 tokens. Rows are counted one by one,
    whatever their ids. An empty table gives an empty result; other columns are
    not looked at.
    """
    spark = docs.sparkSession
    own = prepared(docs, id=id_col, text=text_col)
    frequent = frequent_pieces(spark, own, lambda text: pieces(text, special)[0], table_size, NAMED)
    table = spark.sparkContext.broadcast(dict(zip(frequent, lengths(tokenizer_path, frequent), strict=True)))
    kind = own.schema["id"].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Kept while the worker lives, for as many tasks as use this table.
        cache = _CACHES.get(tokenizer_path)
        if cache is None or cache.known is not table.value:
            cache = _CACHES[tokenizer_path] = WordCache(
                lambda s: lengths(tokenizer_path, s), known=table.value, longest=LONGEST
            )
        for part in slices(batches):
            every, cuts, specials = [], [0], []
            for text in part.column("text").to_pylist():
                found, n = pieces(text, special)
                every += found
                cuts.append(len(every))
                specials.append(n)
            sizes = cache.values(every)
            counts = [n + sum(sizes[a:b]) for n, a, b in zip(specials, cuts, cuts[1:], strict=False)]
            n_bytes = pc.binary_length(part.column("text")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), n_bytes, pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

    return own.mapInArrow(counted, f"id {kind}, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
