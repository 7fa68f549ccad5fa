"""Token ids written to, and read from, binary files of patched frame-of-reference blocks."""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beatline.llm.common import UNICODE_SPACE, WordCache, prepared, ship, slices
from beatline.llm.pfor import END, File, Writer
from beatline.llm.token_counts import load_tokenizer, tokenizer
from beatline.runtime import partitions_for, scratch_path, store

#: Documents one file is meant to hold.
FILE_DOCS = 20_000

#: Words, and parts of words, a worker's caches hold in each of their two generations.
CACHED, CACHED_PARTS = 600_000, 400_000

#: UTF-8 bytes of text encoded at once.
SLICE = 1 << 20

#: Fixed value: pre-tokens of tokenizers that never join a letter or digit to what ends a word after it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_WORD = re.compile(f"[^{UNICODE_SPACE}]+")
# Characters at which str.split() splits but the tokenizer does not.
_ODD = re.compile("[\x1c-\x1f]")
# What may be cut off a word's end, and the Latin letters and digits, one to one in lower case, it may be cut from.
_ENDING = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_STEM = frozenset(c for c in map(chr, range(256)) if c.isascii() and c.isalnum() or c >= "\xc0" and c.isalpha())
# Latin letters that NFC and lower case leave as they are: one pre-token, however many.
_PLAIN = re.compile("[a-z\xdf-\xf6\xf8-\xff]+")
_CACHES: dict[str, WordCache] = {}


def word_ids(path: str, words: list[str]) -> list[bytes]:
    return _ids(tokenizer(path), words)


def _ids(own, words: list[str]) -> list[bytes]:
    return [array("I", e.ids).tobytes() for e in own.encode_batch_fast(words, add_special_tokens=False)]


def plain_ids(path: str) -> Callable[[list[str]], list[bytes]]:
    """``word_ids`` that spares plain words the normalizers and cuts, which change nothing in them."""
    from tokenizers import normalizers, pre_tokenizers

    plain = load_tokenizer(path)
    plain.normalizer = normalizers.Sequence([])
    plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def encode(words: list[str]) -> list[bytes]:
        is_plain = [_PLAIN.fullmatch(w) is not None for w in words]
        simple = iter(_ids(plain, [w for w, p in zip(words, is_plain, strict=True) if p]))
        others = iter(word_ids(path, [w for w, p in zip(words, is_plain, strict=True) if not p]))
        return [next(simple) if p else next(others) for p in is_plain]

    return encode


def word_parts(words: list[str], specials: list[str]) -> list[tuple[str, str]]:
    """Each word as stem and ending, which are encoded by themselves; ASCII stems in lower case.

    An ending is ASCII punctuation after a Latin letter or digit. Words with a
    special string in them, in whatever case, stay as they are.
    """
    every = "\n".join(words).lower()
    specials = [s for s in specials if s in every]  # seldom any
    parts = []
    for word in words:
        stem = word.rstrip(_ENDING)
        if specials and any(s in word.lower() for s in specials):
            parts.append((word, ""))
        elif len(stem) == len(word) or stem[-1:] not in _STEM:
            parts.append((word.lower() if word.isascii() else word, ""))
        else:
            parts.append((stem.lower() if stem.isascii() else stem, word[len(stem) :]))
    return parts


def _steps(part, name: str) -> list[dict]:
    """The steps of a tokenizer's sequence of normalizers or pre-tokenizers."""
    return json.loads(part.__getstate__()).get(name, []) if part else []


def _cache(path: str) -> WordCache:
    """The worker's cache of a tokenizer's words, over one of parts of words where words have such parts."""
    own, whole = tokenizer(path), WordCache(lambda w: word_ids(path, w), CACHED)
    steps = _steps(own.normalizer, "normalizers")
    cuts = _steps(own.pre_tokenizer, "pretokenizers")
    lower = [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
    if not lower or not cuts or cuts[0].get("pattern") != {"Regex": SPLIT} or own.post_processor:
        return whole
    specials = [t.content.lower() for t in own.get_added_tokens_decoder().values()]
    bytewise = cuts[1:] == [{"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
    small = WordCache(plain_ids(path) if bytewise else lambda w: word_ids(path, w), CACHED_PARTS)

    def by_parts(words: list[str]) -> list[bytes]:
        parts = word_parts(words, specials)
        stems = small.values([a for a, _ in parts])
        ends = iter(small.values([b for _, b in parts if b]))
        return [s + next(ends) if b else s for s, (_, b) in zip(stems, parts, strict=True)]

    return WordCache(by_parts, CACHED)


def encode_texts(path: str, texts: list[str], end: bytes = b"") -> list[bytes]:
    """Each text's ids as little-endian 32-bit integers, word by word through the worker's cache.

    Right for tokenizers that drop white space and never join words across it.
    """
    cache = _CACHES.get(path)
    if cache is None:
        cache = _CACHES[path] = _cache(path)
    words, cuts = [], [0]
    for text in texts:
        words += _WORD.findall(text) if _ODD.search(text) else text.split()
        cuts.append(len(words))
    ids = cache.values(words)
    return [b"".join(ids[a:b]) + end for a, b in zip(cuts, cuts[1:], strict=False)]


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    block: int = 8192,
    percentile: float = 95.0,
) -> None:
    """Encode documents and write their ids, each text ended by ``end_id``, in ascending id order.

    Documents are range partitioned by id; each partition becomes one file that
    Spark's own writer commits, so lost tasks leave no partial file. Null ids
    come first; rows that repeat an id are ordered by a hash of their text. Null
    and empty texts have the end id only. An empty table writes no file.
    """
    spark = docs.sparkSession
    own = prepared(docs, id=id_col, text=text_col)
    own = own.select(F.col("id").cast("long").alias("id"), F.xxhash64("text").alias("tie"), "text")
    rows = docs.count()
    width = partitions_for(spark, rows, FILE_DOCS)
    ranged = own.repartitionByRange(width, "id", "tie").sortWithinPartitions("id", "tie")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = Writer(TaskContext.get().partitionId(), block, percentile)
        end = array("I", [end_id]).tobytes()
        begun = False
        for part in slices(batches, size=SLICE):
            records = [] if begun else [writer.head]
            begun = True
            texts = encode_texts(tokenizer_path, part.column("text").to_pylist(), end)
            for doc_id, ids in zip(part.column("id").to_pylist(), texts, strict=True):
                records += writer.add(doc_id, np.frombuffer(ids, np.uint32))
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["value"])
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array(list(writer.end()), pa.binary())], ["value"])

    files = ranged.select("id", "text").mapInArrow(packed, "value binary")
    # The text writer copies bytes as they are and ends each record with END.
    files.select(F.col("value").cast("string").alias("value")).write.option("lineSep", END.decode()).text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                if not len(content.as_buffer() or b""):
                    continue
                file = File(content.as_buffer().to_pybytes())
                rows = [(i, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for i, at, ids in file.documents()]
                ids, at, sizes, crcs = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file.number] * len(rows), pa.int64()), *[pa.array(c, pa.int64()) for c in (ids, at, sizes, crcs)]],
                    ["file", "id", "at", "n_tokens", "ids_crc32"],
                )

    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    read = store(
        files.mapInArrow(opened, "file long, id long, at long, n_tokens long, ids_crc32 long"), "token-docs"
    )
    # One row per file: a shuffle's width at most, so one window and a broadcast hold them.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    totals = read.groupBy("file").agg(F.sum("n_tokens").alias("total")).select(
        F.col("file").alias("f"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")
    )
    return read.join(F.broadcast(totals), F.col("file") == F.col("f")).select(
        "id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, tokenizer_path: str, path: str | None = None, **options) -> DataFrame:
    """Write the documents' ids to ``path`` (default: a new scratch folder) and read them back."""
    path = path or scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer_path, **options)
    return read_token_files(docs.sparkSession, path)
