"""Merge replay against the library, word by word and over whole tables."""

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken
from llm.cases import empty, frame, rows

from beatline.llm import merge_replay

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def library(path=PATH, pattern=public_tokenizers.PATTERN):
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def numbers(found):
    return [np.frombuffer(ids, "<u4").tolist() for ids in found]


def test_words_of_any_bytes():
    rng, own = random.Random(3), library()
    words = [bytes(rng.choices(b"abeth \xc3\xa9x\x00", k=rng.randint(0, 40))) for _ in range(3000)]
    words += [b"a" * 999, b" " * 700, bytes(range(256))]
    assert numbers(merge_replay.replay(words, merge_replay.ranks(PATH))) == [own._encode_single_piece(w) if w else [] for w in words]


def test_ranks_in_any_order(tmp_path):
    """Ranks no training would give: merges that bring about pairs of lower ranks."""
    for seed in range(30):
        rng = random.Random(seed)
        tokens = {bytes([b]) for b in range(256)}
        while len(tokens) < 256 + 60:
            tokens.add(bytes(rng.choices(b"abc", k=rng.randint(2, 6))))
        longer = sorted(t for t in tokens if len(t) > 1)
        rng.shuffle(longer)
        path = tmp_path / f"{seed}.tiktoken"
        listed = [*[bytes([b]) for b in range(256)], *longer]
        path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(listed)))
        own = library(str(path))
        words = [bytes(rng.choices(b"abc", k=rng.randint(1, 30))) for _ in range(300)]
        assert numbers(merge_replay.replay(words, merge_replay.ranks(str(path)))) == [own._encode_single_piece(w) for w in words]


def test_documents(spark):
    given, own = rows(), library()
    both = merge_replay.decode(merge_replay.encode(frame(spark, given), PATH, public_tokenizers.PATTERN), PATH)
    got = Counter((r.id, bytes(r.ids), r.n_tokens, bytes(r.decoded)) for r in both.collect())
    want = Counter()
    for i, t, _, _ in given:
        ids = own.encode_ordinary(t or "")
        want[i, np.array(ids, "<u4").tobytes(), len(ids), (t or "").encode()] += 1
    assert got == want


def test_query(spark):
    from beatline.llm.registry import op11_merge_replay

    sf, own = "/root/testdata/sf0.001", library()
    given = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = op11_merge_replay(spark, sf).collect()
    assert len(found) == len(given)
    for r in found:
        ids = own.encode_ordinary(given[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(given[r.doc_id].encode()).hexdigest()


def test_empty_table(spark):
    assert merge_replay.decode(merge_replay.encode(empty(spark), PATH, public_tokenizers.PATTERN), PATH).count() == 0


def test_memory_of_two_generations():
    """Turned over all the time, and with strings too long to stay."""
    own = merge_replay.ranks(PATH)
    small = merge_replay._Known(lambda new: merge_replay.replay([m.encode() for m in new], own), 3)
    rng = random.Random(4)
    for _ in range(50):
        asked = ["".join(rng.choices("abé ", k=rng.choice([1, 2, 3, 80]))) for _ in range(9)] * 2
        assert small.values(asked) == merge_replay.replay([m.encode() for m in asked], own)
        assert len(small.young) <= 3 + 9 and all(len(s) <= merge_replay.LONGEST for s in small.young)
