"""The worker's table of words behind the quality rules: values as encoded whole, across turns."""

import random

import public_tokenizers
from xxhash import xxh64_intdigest

from beatline.llm.quality import LONGEST, _Vocabularies, _WordTable

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")

ODD = ["'s", "it's,", "<|endoftext|>", "a<|endoftext|>", "<s>", "x</s>", "é.", "straße!?", "×,", "á.", "日本,", "!!!", "3.14%", "x" * 500 + ","]


def _words(seed: int, n: int) -> list[bytes]:
    pick = random.Random(seed)
    ends = ["", "", ",", ".", "'", "'s", "&&&", "%%%.", "|>", "_", "…", ")"]
    made = ["".join(pick.choices("abcdeéßñ́Z9-", k=pick.randint(1, 9))) + pick.choice(ends) for _ in range(n)]
    return [w.encode() for w in made + ODD]


def test_values_equal_whole_words_across_turns():
    own = _Vocabularies(PIECES, BYTES)
    table = _WordTable(_Vocabularies(PIECES, BYTES), 300)
    assert table.own.cuts
    for seed in range(6):
        words = _words(seed % 4, 400)
        rows = table.rows(words)
        sizes, ids = table.pieces(rows)
        whole = own.whole([w.decode() for w in words])
        assert ids.astype("<u4").tobytes() == b"".join([v[0] for v in whole])
        assert sizes.tolist() == [len(v[0]) >> 2 for v in whole]
        assert table.tokens[rows].tolist() == [v[1] for v in whole]
        assert table.chars[rows].tolist() == [len(w.decode()) for w in words]
        assert table.hashes[rows].tolist() == [xxh64_intdigest(w, 7) for w in words]


def test_a_full_table_keeps_what_is_used_and_stays_bounded():
    table = _WordTable(_Vocabularies(PIECES, BYTES), 100)
    often = [b"often,", b"again"]
    for k in range(20):
        table.rows(often * 5 + [f"word{k}x{i}".encode() for i in range(60)] + [b"y" * (LONGEST + 1)])
        assert all(w in table.index for w in often)
        assert len(table.index) <= 100 + 63
    table._halve()
    assert len(table.index) <= 50 and b"y" * (LONGEST + 1) not in table.index
    assert len(table.begins) == len(table.tokens) + 1 == len(table.index) + 1


def test_no_words():
    table = _WordTable(_Vocabularies(PIECES, BYTES), 10)
    sizes, ids = table.pieces(table.rows([]))
    assert sizes.tolist() == ids.tolist() == []


def test_idle_workers_drop_what_they_keep(monkeypatch):
    import time

    from beatline.llm import common

    monkeypatch.setattr(common, "REST_S", 0.2)
    first = common.worker_cache("test", "a", lambda: [1])
    common.rest()
    assert common.worker_cache("test", "a", lambda: [2]) is first  # another task came in time
    time.sleep(0.6)
    assert common.worker_cache("test", "a", lambda: [2]) is first  # it is still at work
    common.rest()
    time.sleep(0.6)
    assert common.worker_cache("test", "a", lambda: [2]) == [2]


def test_a_chain_drops_what_a_worker_keeps_before_its_task_ends():
    from beatline.llm import common

    common.worker_cache("test", "a", lambda: [1])
    common.rest(0)
    assert "test" not in common._HELD


def test_a_carried_rows_text_travels_once():
    import pyarrow as pa

    from beatline.llm.quality import _with_text

    rows = pa.array([{"doc_id": 1, "text": "a b"}, {"doc_id": 2, "text": None}, {"doc_id": 3, "text": "c"}])
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), rows], ["id", "row"]).slice(1)
    (got,) = _with_text(iter([batch]), "text")
    assert got.schema.names == ["id", "row", "text"] and got.column("text").to_pylist() == ["", "c"]


def test_the_pipelines_batches_are_bounded(spark):
    import corpus_pipeline

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.newSession()
    corpus_pipeline._bounded(own)
    assert own.conf.get(key) == f"{4 << 20}b"
    own.conf.set(key, "8m")
    corpus_pipeline._bounded(own)
    assert own.conf.get(key) == "8m"
