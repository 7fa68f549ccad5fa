"""Token counts, token files and SentencePiece against the libraries."""

import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.cases import empty, frame, null_last, rows
from tokenizers import Tokenizer

from beatline.llm import pfor, token_counts, token_files
from beatline.llm import sentencepiece as own_sp

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = st.text(st.sampled_from(" \t\n\r\x1c\x85\xa0　abzé́ß'st1٣½<|>ΣſİΩ🙂▁,."), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_pieces_give_the_librarys_length(t):
    want = len(Tokenizer.from_file(BYTES).encode(t, add_special_tokens=False).ids) if t else 0
    found, n = token_counts.pieces(t, "<|endoftext|>")
    assert n + sum(token_counts.lengths(BYTES, found)) == want


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_words_give_the_librarys_ids(t):
    want = token_counts.tokenizer(WORDS).encode(t, add_special_tokens=False).ids
    assert list(array("I", token_files.encode_texts(WORDS, [t])[0])) == want


def test_endings_of_words_are_encoded_apart():
    specials = ["<|endoftext|>"]
    words = ["The,", "fürß..", "i\u0307.", "e\u0301,", "x<|EndOfText|>.", "A<|endoftext|>", "don't.", "'s", "..", "a=\u0338", "İ.", "9%%"]
    assert token_files.word_parts(words, specials) == [
        ("the", ","), ("fürß", ".."), ("i\u0307.", ""), ("e\u0301,", ""), ("x<|EndOfText|>.", ""), ("A<|endoftext|>", ""),
        ("don't", "."), ("'s", ""), ("..", ""), ("a=\u0338", ""), ("İ.", ""), ("9", "%%"),
    ]
    own, text = token_counts.tokenizer(WORDS), " ".join(words)
    assert list(array("I", token_files.encode_texts(WORDS, [text])[0])) == own.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("table_size", [50_000, 3])
def test_token_counts(spark, table_size):
    given_rows = rows()
    own = Tokenizer.from_file(BYTES)
    want = Counter()
    for i, t, *_ in given_rows:
        n = len(own.encode(t or "", add_special_tokens=False).ids)
        want[i, len((t or "").encode()), n, n > 512] += 1
    got = token_counts.token_counts(frame(spark, given_rows), BYTES, table_size=table_size).collect()
    assert Counter((r.id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_token_files(spark):
    given_rows = rows()
    own = Tokenizer.from_file(WORDS)
    found = token_files.token_files(frame(spark, given_rows), WORDS, block=64).collect()
    assert len(found) == len(given_rows)
    want = defaultdict(Counter)
    for i, t, *_ in given_rows:
        ids = own.encode(t or "", add_special_tokens=False).ids + [2]
        want[i][len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    got = defaultdict(Counter)
    for r in found:
        got[r.id][r.n_tokens, r.ids_crc32] += 1
    assert got == want
    in_order = [r.id for r in sorted(found, key=lambda r: r.start)]
    assert in_order == sorted(in_order, key=lambda i: (i is not None, i or 0))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 200), max_size=300), st.sampled_from([0.0, 50.0, 95.0, 100.0]))
def test_blocks_round_trip(values, percentile):
    ids = np.array(values, np.uint32)
    assert pfor.unpack(pfor.pack(ids, percentile)).tolist() == values


def test_outliers_are_exceptions():
    ids = np.full(1000, 77, np.uint32)
    ids[::100] = 2**31
    assert len(pfor.pack(ids, 90.0)) < 200


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.none() | st.integers(-5, 5), st.lists(st.integers(0, 70_000), max_size=40)), min_size=1, max_size=30))
def test_files_round_trip(docs):
    writer = pfor.Writer(9, block=16)
    records = [writer.head]
    for i, ids in docs:
        records += writer.add(i, np.array(ids, np.uint32))
    records += writer.end()
    file = pfor.File(b"".join(r + pfor.END for r in records))
    assert [(i, ids.tolist()) for i, _, ids in file.documents()] == docs
    every = [x for _, ids in docs for x in ids]
    assert file.number == 9 and file.ids(0, len(every)).tolist() == every
    assert file.ids(len(every) // 3, len(every) // 2).tolist() == every[len(every) // 3 : len(every) // 2]


def as_unigram(tmp_path):
    """The same pieces and scores, declared a unigram model."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(PIECES, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for p in proto.pieces:
        # Distinct sums, so that no two paths tie in the library's single precision.
        if p.type == 1:
            p.score = -8.0 - 0.37 * ((p.score * 2654435761) % 1009) / 64
    path = tmp_path / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    return str(path)


def encoded(spark, given_rows, path, **options):
    return own_sp.decode(own_sp.encode(frame(spark, given_rows), path, **options), path).collect()


@pytest.mark.parametrize("table_size", [150_000, 5])
def test_sentencepiece_bpe(spark, table_size):
    given_rows = rows()
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = encoded(spark, given_rows, PIECES, table_size=table_size)
    want = Counter((i, tuple(library.encode(t or ""))) for i, t, *_ in given_rows)
    assert Counter((r.id, tuple(r.ids)) for r in got) == want
    texts = Counter((i, (t or "").replace("▁", " ")) for i, t, *_ in given_rows)
    assert Counter((r.id, r.decoded) for r in got) == texts
    assert all(r.n_tokens == len(r.ids) for r in got)


def test_sentencepiece_unigram(spark, tmp_path):
    path = as_unigram(tmp_path)
    given_rows = [r for r in rows() if len(r[1] or "") < 3000]
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = encoded(spark, given_rows, path)
    texts = defaultdict(set)
    for i, t, *_ in given_rows:
        texts[i].add(tuple(library.encode(t or "")))
    assert all(tuple(r.ids) in texts[r.id] for r in got)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abrotinhes▁éx🙂\r"), min_size=1, max_size=80))
def test_long_units_by_merging(t):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    own = own_sp.model(PIECES)
    got = [i for u in own_sp.units(t) for i in own_sp.with_bytes(own_sp.long_unit(u, own), own).tolist()]
    assert got == library.encode(t)
    assert own_sp.decode_ids(np.array(got), own) == t.replace("▁", " ")


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab. \n▁é🙂"), max_size=30), st.booleans())
def test_words_hold_the_units(t, prefix):
    assert [u for w in own_sp.words(t, prefix) for u in own_sp.word_units(w, prefix)] == own_sp.units(t, prefix)


def test_only_edges_leave_the_join(spark):
    """The join's rows are a unit's first row and its pieces of two characters and more."""
    own = own_sp.model(PIECES)
    units = ["▁oninganing", "zqxj", "🙂", "▁of", "a" * 64]
    edges = own_sp.lattice(spark.createDataFrame([(u,) for u in units], "unit string").coalesce(1), own)
    assert "LeftOuter" not in edges._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[0]
    got = {r.unit: sorted(zip(r.begins, r.ends, r.pids, strict=True)) for r in edges.collect()}
    assert got == {
        u: sorted((i, j, own.ids[u[i:j]]) for i in range(len(u)) for j in range(i + 2, len(u) + 1) if u[i:j] in own.ids)
        for u in units
    }


def test_empty_tables(spark):
    docs = empty(spark)
    assert token_counts.token_counts(docs, BYTES).count() == 0
    assert token_files.token_files(docs, WORDS).count() == 0
    assert own_sp.encode(docs, PIECES).count() == 0


def test_ids_sorted_with_nulls_first(spark):
    found = token_files.token_files(frame(spark, [(5, "b", "", ""), (None, "a", "", ""), (-3, "c", "", "")]), WORDS)
    assert [r.id for r in found.orderBy("start").collect()] == [None, -3, 5]
    assert null_last(None) > null_last(5)


def test_plain_words_are_spared_the_normalizers(monkeypatch):
    words = ["plain", "straße", "naïve", "ÿ", "×", "don't", "Ünï", "x1", "e\u0301", "<|endoftext|>", "日本"]
    want = token_files.word_ids(WORDS, words)
    asked = []
    whole = token_files.word_ids
    monkeypatch.setattr(token_files, "word_ids", lambda path, w: asked.extend(w) or whole(path, w))
    assert token_files.plain_ids(WORDS)(words) == want
    assert asked == words[4:]


def test_units_are_split_where_no_piece_can_lie():
    own = own_sp.model(PIECES)
    pairs = {p[i : i + 2] for p in own.ids for i in range(len(p) - 1)}
    found = ["▁the", "▁", "▁ñadoiega", "日本x", "a🙂🙂b", "ß", "\n", "▁▁▁"]
    parts, counts = own_sp.split_units(found, own)
    assert sum(counts) == len(parts)
    for unit, n in zip(found, counts, strict=True):
        mine, parts = parts[:n], parts[n:]
        assert "".join(mine) == unit and all(mine)
        assert all(a[-1] + b[0] not in pairs for a, b in zip(mine, mine[1:], strict=False))
        assert all(p[i : i + 2] in pairs for p in mine for i in range(len(p) - 1))
    assert own_sp.split_units([], own) == ([], [])


def test_units_come_back_as_ids_alone():
    import pyarrow as pa

    own = own_sp.model(PIECES)
    units = ["▁the", "▁ñadoiega", "🙂", "a日", "é", "▁zxqj"]
    ids = [own_sp.long_unit(u, own) for u in units]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([[7], [9, 7], [9], [7], [9], [-3]]), pa.array(units), pa.array(ids, pa.list_(pa.int32()))], ["blocks", "unit", "ids"]
    )
    sent = [r for b in own_sp._to_blocks(iter([batch])) for r in b.to_pylist()]
    assert set(sent[0]) == {"block", "n", "codes"}
    for row in sent:
        mine = [k for k, blocks in enumerate([[7], [9, 7], [9], [7], [9], [-3]]) if row["block"] in blocks]
        want = {units[k]: own_sp.with_bytes(ids[k], own).tobytes() for k in mine}
        assert own_sp._unpacked(row["n"], row["codes"], own) == want
