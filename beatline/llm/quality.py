"""Quality rules: simple base rules and tokeniser fertility against bands per language or script."""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatline.llm.common import WordCache, prepared, rest, slices, worker_cache
from beatline.llm.substring_dedup import window_hashes
from beatline.llm.token_counts import load_tokenizer

SYMBOLS = "#*$%&|<>"

#: Words in a worker's table, stems in each of its cache's two generations, longest word either keeps, bytes of text judged at once.
CACHED, STEMS, LONGEST, SLICE = 400_000, 120_000, 64, 1 << 20


@dataclass(frozen=True)
class Band:
    """What a document's fertility may be. Entropy is judged against its possible maximum."""

    chars_per_piece: tuple[float, float] = (1.2, 6.0)
    chars_per_byte_token: tuple[float, float] = (1.2, 6.0)
    most_byte_share: float = 0.2
    least_entropy_share: float = 0.65


#: Default bands. A language code wins over a script, a script over ``*``. Scripts
#: for which the vocabularies have few pieces fall back to bytes and short tokens.
#: Lower limits and entropy floors of the four languages lie just below the lowest of
#: all labelled good documents of sf0.1 and check_s (20,544) that pass the base rules.
BANDS = {
    "*": Band((0.2, 8.0), (0.2, 8.0), 0.9, 0.45),
    "LATIN": Band((1.4, 6.0), (1.4, 6.0)),
    "en": Band((1.6, 6.5), (1.68, 6.5), 0.05, 0.7),
    "de": Band((1.56, 6.5), (1.62, 6.0), 0.05, 0.69),
    "fr": Band((1.48, 6.0), (1.55, 5.5), 0.05, 0.68),
    "es": Band((1.65, 6.0), (1.57, 5.5), 0.05, 0.685),
    "CYRILLIC": Band((0.8, 6.0), (0.3, 6.0), 0.2, 0.5),
    "GREEK": Band((0.5, 6.0), (0.3, 6.0), 0.5, 0.5),
}


# What may be cut off a word's end, and the characters it may be cut from: ASCII punctuation after Latin letters and digits.
_ENDING = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_STEM = frozenset(c for c in map(chr, range(256)) if c.isascii() and c.isalnum() or c >= "\xc0" and c.isalpha())


class _Vocabularies:
    """Piece ids and number of byte-level tokens of single words, each as after a space.

    Where no piece holds a word's last letter and the punctuation after it
    together, and the byte-level tokenizer cuts there too, both parts are encoded
    by themselves, so that a stem is encoded once for all its endings.
    """

    def __init__(self, piece_path: str, byte_path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.byte = load_tokenizer(byte_path)
        size = self.pieces.get_piece_size()
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(size)])
        proto = pb.ModelProto()
        proto.ParseFromString(self.pieces.serialized_model_proto())
        cuts = json.loads(self.byte.pre_tokenizer.__getstate__()) if self.byte.pre_tokenizer else {}
        self.cuts = (
            proto.normalizer_spec.name == "identity"
            and cuts.get("type") == "ByteLevel"
            and cuts.get("use_regex") is True
            and not self.byte.normalizer
            and not self.byte.post_processor
        )
        self.joins = {p[i : i + 2] for p in map(self.pieces.id_to_piece, range(size)) for i in range(len(p) - 1)}
        self.specials = [t.content for t in self.byte.get_added_tokens_decoder().values()]
        self.stems = WordCache(self.whole, STEMS)
        self.endings = WordCache(self.after_letter, STEMS)

    def whole(self, words: list[str]) -> list[tuple[bytes, int]]:
        ids = self.pieces.encode(words, num_threads=1)
        tokens = self.byte.encode_batch_fast([" " + w for w in words], add_special_tokens=False)
        return [(array("I", i).tobytes(), len(b)) for i, b in zip(ids, tokens, strict=True)]

    def after_letter(self, endings: list[str]) -> list[tuple[bytes, int]]:
        letter = len(self.pieces.encode("a"))
        ids = self.pieces.encode(["a" + e for e in endings], num_threads=1)
        tokens = self.byte.encode_batch_fast(endings, add_special_tokens=False)
        return [(array("I", i[letter:]).tobytes(), len(b)) for i, b in zip(ids, tokens, strict=True)]

    def parts(self, word: str) -> tuple[str, str]:
        stem = word.rstrip(_ENDING)
        if len(stem) == len(word) or not self.cuts or stem[-1:] not in _STEM:
            return word, ""
        first = word[len(stem)]
        if stem[-1] + first in self.joins or "a" + first in self.joins or any(s in word for s in self.specials):
            return word, ""
        return stem, word[len(stem) :]

    def values(self, words: list[str]) -> list[tuple[bytes, int]]:
        parts = list(map(self.parts, words))
        stems = self.stems.values([a for a, _ in parts])
        ends = iter(self.endings.values([b for _, b in parts if b]))
        return [(v[0] + (e := next(ends))[0], v[1] + e[1]) if b else v for v, (_, b) in zip(stems, parts, strict=True)]


class _WordTable:
    """What a worker knows of words, as arrays: piece ids, byte-level tokens, characters and hash.

    A table over its limit, which one slice of text may bring about, is cut to the
    most used words, half as many as the limit, before the next slice; words over
    LONGEST bytes go.
    """

    def __init__(self, vocabularies: _Vocabularies, limit: int):
        self.own, self.limit = vocabularies, limit
        self.index: dict[bytes, int] = {}
        self.ids, self.begins = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.tokens = self.chars = self.used = np.zeros(0, np.int64)
        self.hashes = np.zeros(0, np.uint64)

    def rows(self, words: list[bytes]) -> np.ndarray:
        """Each word's row in the arrays, good until the next call."""
        if len(self.index) > self.limit:
            self._halve()
        rows = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        missed = np.flatnonzero(rows < 0).tolist()
        if missed:
            self._add(list({words[i] for i in missed}))
            rows[missed] = [self.index[words[i]] for i in missed]
        self.used += np.bincount(rows, minlength=len(self.used))
        return rows

    def pieces(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of pieces of each row, and the ids of all, one after the other."""
        sizes = self.begins[rows + 1] - self.begins[rows]
        shift = self.begins[rows] - (np.cumsum(sizes) - sizes)
        return sizes, self.ids[np.repeat(shift, sizes) + np.arange(sizes.sum())].astype(np.int64)

    def _add(self, fresh: list[bytes]) -> None:
        from xxhash import xxh64_intdigest

        texts = [w.decode() for w in fresh]
        values = [v for i in range(0, len(texts), 10_000) for v in self.own.values(texts[i : i + 10_000])]
        self.index.update(zip(fresh, range(len(self.tokens), len(self.tokens) + len(fresh)), strict=True))
        sizes = np.fromiter((len(v[0]) >> 2 for v in values), np.int64, len(values))
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join([v[0] for v in values]), np.uint32)])
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(sizes)])
        self.tokens = np.concatenate([self.tokens, np.fromiter((v[1] for v in values), np.int64, len(values))])
        self.chars = np.concatenate([self.chars, np.fromiter(map(len, texts), np.int64, len(texts))])
        self.hashes = np.concatenate([self.hashes, np.array([xxh64_intdigest(w, 7) for w in fresh], np.uint64)])
        self.used = np.concatenate([self.used, np.zeros(len(fresh), np.int64)])

    def _halve(self) -> None:
        order = np.argsort(-self.used, kind="stable")[: self.limit // 2]
        kept = np.zeros(len(self.used), bool)
        kept[order] = True
        words = [w for w in self.index if len(w) <= LONGEST and kept[self.index[w]]]  # in order of rows
        rows = np.array([self.index[w] for w in words], np.int64)
        sizes, ids = self.pieces(rows)
        self.index = dict(zip(words, range(len(words)), strict=True))
        self.ids, self.begins = ids.astype(np.uint32), np.concatenate([[0], np.cumsum(sizes)])
        self.tokens, self.chars, self.hashes = self.tokens[rows], self.chars[rows], self.hashes[rows]
        self.used = self.used[rows] >> 1


@lru_cache(maxsize=65_536)
def _script(char: str) -> str | None:
    return unicodedata.name(char, "").split(" ")[0] if char.isalpha() else None


def script_of(text: str) -> str:
    """The script of most letters, ``*`` without letters."""
    counts: dict[str, int] = {}
    for char in set(text):
        if own := _script(char):
            counts[own] = counts.get(own, 0) + text.count(char)
    return max(sorted(counts), key=counts.get) if counts else "*"


def repeated_words(hashes: np.ndarray, sizes: np.ndarray, n: int) -> np.ndarray:
    """Per document, words covered by windows of ``n`` words that it holds twice or more."""
    a, b = window_hashes(hashes, n)
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    own = doc[: len(a)]
    inside = np.arange(len(a)) + n <= ends[own]
    at = np.flatnonzero(inside)
    order = at[np.lexsort([b[at], a[at], own[at]])]
    same = (own[order[1:]] == own[order[:-1]]) & (a[order[1:]] == a[order[:-1]]) & (b[order[1:]] == b[order[:-1]])
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    places = order[again]
    depth = np.bincount(places, minlength=len(hashes) + 1) - np.bincount(places + n, minlength=len(hashes) + 1)
    return np.bincount(doc, np.cumsum(depth)[:-1] > 0, len(sizes)).astype(np.int64)


def entropies(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Entropy in bits of each document's token ids."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    keys, counts = np.unique((doc.astype(np.int64) << 32) | ids, return_counts=True)
    share = counts / sizes[keys >> 32]
    return np.bincount(keys >> 32, -share * np.log2(share), len(sizes))


_NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_RATES = ("chars_per_piece", "chars_per_byte_token", "byte_share", "entropy")


def quality(
    docs: DataFrame,
    piece_path: str,
    byte_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
    bands: dict[str, Band] = BANDS,
    min_words: int = 20,
    most_repeats: float = 0.3,
    repeat_window: int = 8,
    carry: bool = False,
) -> DataFrame:
    """Judge every document by base rules and, if it passes, by its fertility.

    Returns id, the base counts (n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words), base_failed, the measures chars_per_piece and
    chars_per_byte_token (characters of words per token of a SentencePiece and
    of a byte-level vocabulary), byte_share (tokens that are single fallback
    bytes) and entropy (bits), the band that judged them, kept, and with
    ``carry`` the input row as ``row``. Words are encoded one by one through a
    bounded cache of each worker; nothing is shuffled.

    A document is kept if no base rule fails and every measure lies in the band
    of its language, else of the script of most of its letters, else of ``*``.
    Entropy is compared to ``least_entropy_share`` of the most that so many
    tokens can have, at most 9 bits. Null and empty texts have no words and
    fail; their measures are null. A null language leaves the choice to the
    script. Repeated ids are rows of their own. An empty table gives an empty
    result.
    """
    names = {"id": id_col, "text": text_col} | ({"lang": lang_col} if lang_col else {})
    own = prepared(docs, carry, **names)
    if not lang_col:
        own = own.withColumn("lang", F.lit(None).cast("string"))
    within = carry and isinstance(docs.schema[text_col].dataType, T.StringType)
    if within:  # the row holds the text, which would travel twice
        own = own.drop("text")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(piece_path, byte_path)
        is_byte = table.own.is_byte
        for part in slices(_with_text(batches, text_col) if within else batches, size=SLICE):
            texts = part.column("text").to_pylist()
            words = [t.encode().split() for t in texts]
            sizes = np.array([len(w) for w in words], np.int64)
            flat = [w for own_words in words for w in own_words]
            rows = table.rows(flat)
            per_word, ids = table.pieces(rows)
            n = len(sizes)
            doc = np.repeat(np.arange(n), sizes)
            n_pieces, n_byte_tokens, chars = (
                np.bincount(doc, v, n).astype(np.int64) for v in (per_word, table.tokens[rows], table.chars[rows])
            )
            piece_doc = np.repeat(np.arange(n), n_pieces)
            with np.errstate(divide="ignore", invalid="ignore"):
                rates = {
                    "chars_per_piece": chars / n_pieces,
                    "chars_per_byte_token": chars / n_byte_tokens,
                    "byte_share": np.bincount(piece_doc, is_byte[ids], n) / n_pieces,
                    "entropy": entropies(ids, n_pieces),
                }
            counts = {
                "n_words": sizes,
                "word_chars": chars,
                "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64),
                "n_dup_lines": np.array([_dup_lines(t) for t in texts], np.int64),
                "n_repeat_words": repeated_words(table.hashes[rows], sizes, repeat_window),
            }
            langs = part.column("lang").to_pylist()
            chosen = [lang if lang in bands else s if (s := script_of(t)) in bands else "*" for lang, t in zip(langs, texts, strict=True)]
            fine = [_inside(bands[c], {k: v[i] for k, v in rates.items()}, int(n_pieces[i])) for i, c in enumerate(chosen)]
            failed = (sizes < min_words) | (counts["n_repeat_words"] > most_repeats * sizes)
            empty = n_pieces == 0
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    *[pa.array(counts[c]) for c in _NAMES],
                    *[pa.array(rates[c], pa.float64(), mask=empty) for c in _RATES],
                    pa.array(chosen, pa.string()),
                    pa.array(failed),
                    pa.array(~failed & np.array(fine, bool)),
                    *([part.column("row")] if carry else []),
                ],
                ["id", *_NAMES, *_RATES, "band", "base_failed", "kept", *(["row"] if carry else [])],
            )
        del table, is_byte
        # A chain leaves more workers than cores, which take turns: a table would wait in vain, beside those at work.
        rest(0 if carry else None)

    fields = ", ".join([*[f"{c} long" for c in _NAMES], *[f"{c} double" for c in _RATES]])
    schema = T.StructType([own.schema["id"]])
    for field in T.StructType.fromDDL(f"{fields}, band string, base_failed boolean, kept boolean"):
        schema.add(field)
    return own.mapInArrow(judged, schema.add(own.schema["row"]) if carry else schema)


def _with_text(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[pa.RecordBatch]:
    """Add the text of each batch's rows, null as empty."""
    for batch in batches:
        text = batch.column("row").field(text_col)
        yield pa.RecordBatch.from_arrays([*batch.columns, pc.fill_null(text, "") if text.null_count else text], [*batch.schema.names, "text"])


def _table(piece_path: str, byte_path: str) -> _WordTable:
    """This worker's table of words."""
    return worker_cache("quality", (piece_path, byte_path), lambda: _WordTable(_Vocabularies(piece_path, byte_path), CACHED))


def _dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def _inside(band: Band, rates: dict[str, float], n_pieces: int) -> bool:
    if not n_pieces:
        return False
    low, high = band.chars_per_piece
    byte_low, byte_high = band.chars_per_byte_token
    possible = min(9.0, float(np.log2(n_pieces)))
    return bool(
        low <= rates["chars_per_piece"] <= high
        and byte_low <= rates["chars_per_byte_token"] <= byte_high
        and rates["byte_share"] <= band.most_byte_share
        and rates["entropy"] >= band.least_entropy_share * possible
    )


def kept_documents(docs: DataFrame, piece_path: str, byte_path: str, **options) -> DataFrame:
    """The documents no rule rejects, columns unchanged."""
    return quality(docs, piece_path, byte_path, carry=True, **options).where("kept").select("row.*")
