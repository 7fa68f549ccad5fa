"""Substring deduplication and near duplicates against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from llm.cases import empty, frame, rows, words

from beatline.llm import hamming
from beatline.llm.components import stars
from beatline.llm.simhash import close_prints, near_duplicates, one_of_each, pattern_nodes
from beatline.llm.substring_dedup import substring_dedup


def brute_cut(given, n):
    """{(id, text): (n_words, n_removed, kept)}; rows equal in both are one document."""
    docs = sorted({(i is None, i or 0, t or "") for i, t, *_ in given})
    # Rows that repeat an id only are ordered by a hash the brute force need not know.
    assert len({d[:2] for d in docs}) >= len(docs) - 2
    first, out = {}, {}
    for k, (_, _, t) in enumerate(docs):
        w = words(t)
        for s in range(len(w) - n + 1):
            first.setdefault(tuple(w[s : s + n]), (k, s))
    for k, (none, i, t) in enumerate(docs):
        w = words(t)
        gone = {s + j for s in range(len(w) - n + 1) if first[tuple(w[s : s + n])] != (k, s) for j in range(n)}
        out[None if none else i, t] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    return out


@pytest.mark.parametrize("n", [20, 3])
def test_substring_dedup(spark, n):
    # Short windows meet the two documents of one id, whose order is a hash's.
    given = rows() if n == 20 else [r for r in rows() if r[0] not in (None, 33)]
    want = brute_cut(given, n)
    got = substring_dedup(frame(spark, given), window=n).collect()
    assert Counter((r.id, r.n_words, r.n_removed, r.kept) for r in got) == Counter(
        (i, *want[i, t or ""]) for i, t, *_ in given
    )
    for r in got:
        assert sum(s.end - s.begin for s in r.spans) == r.n_removed
        assert all(a.end < b.begin for a, b in zip(r.spans, r.spans[1:], strict=False))


def test_unique_ids_need_no_tie(spark):
    given = [(i, "a b c d e f", None, None) for i in range(4)] + [(9, "x a b c d e f x a b c", None, None)]
    got = {r.id: (r.n_removed, r.kept) for r in substring_dedup(frame(spark, given), window=3).collect()}
    assert got[0] == (0, "a b c d e f") and got[3] == (6, "")
    assert got[9] == (10, "x")  # the second "x a b" repeats the first


def brute_print(t, k):
    w = (t or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(prints, most):
    """Component of each position under links of at most ``most`` bits."""
    own = list(range(len(prints)))

    def root(x):
        while own[x] != x:
            x = own[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= most:
                own[root(a)] = root(b)
    return [root(x) for x in range(len(prints))]


@pytest.mark.parametrize("node_rows", [200_000, 4])
def test_near_duplicates(spark, node_rows):
    given = rows()
    rng = random.Random(5)
    base = "the quick brown fox jumps over the lazy dog and runs far away from the hungry wolf " * 30
    for i in range(40):
        w = base.split()
        w[rng.randrange(len(w))] = f"changed{i}"
        given.append((200 + i, " ".join(w), None, None))
    for k, most in ((4, 4), (5, 6)):
        prints = [brute_print(t, k) for _, t, *_ in given]
        groups = brute_groups(prints, most)
        least = defaultdict(list)
        for g, (i, *_) in zip(groups, given, strict=True):
            least[g].append(i)
        best = {g: min([i for i in ids if i is not None], default=None) for g, ids in least.items()}
        want = Counter((i, f"{p:016x}", best[g]) for (i, *_), p, g in zip(given, prints, groups, strict=True))
        got = near_duplicates(frame(spark, given), shingle=k, most=most, node_rows=node_rows).collect()
        assert Counter((r.id, r.fingerprint, r.component_id) for r in got) == want


def test_one_of_each(spark):
    given = [r for r in rows() if r[0] != 33]  # an id with two texts can lead two groups
    docs = frame(spark, given)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    groups = near_duplicates(docs).collect()
    assert {r.doc_id for r in kept.collect()} == {r.component_id for r in groups}
    assert len({(r.doc_id, r.text) for r in kept.collect()}) == len({r.component_id for r in groups})


def cluster(rng, n, near):
    """Prints in dense balls and alone."""
    out = set()
    while len(out) < n:
        center = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 3, near])):
            x = center
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("n,near", [(1, 1), (2, 2), (700, 60), (1500, 900)])
def test_gray_index(n, near):
    prints = np.array(cluster(random.Random(n), n, near), np.uint64)
    prints = prints[np.argsort(hamming.gray_rank(prints))]
    got = hamming.GrayIndex(prints).linked(4)
    want = brute_groups(prints.tolist(), 4)
    assert len(set(zip(got.tolist(), want, strict=True))) == len(set(want)) == len(set(got.tolist()))


def test_gray_rank_is_the_reflected_order():
    ranks = np.arange(256, dtype=np.uint64)
    assert hamming.gray_rank(ranks ^ (ranks >> np.uint64(1))).tolist() == list(range(256))


def test_close_pairs_share_a_node(spark):
    rng = random.Random(3)
    a = [rng.getrandbits(64) for _ in range(300)]
    b = [x ^ sum({1 << rng.randrange(64) for _ in range(4)}) for x in a]
    signed = [x - (1 << 64) if x >> 63 else x for x in a + b]
    prints = spark.createDataFrame([(x,) for x in set(signed)], "print long")
    edges = stars(close_prints(prints, 4, node_rows=5))
    root = {r.u: r.v for r in edges.collect()}
    for x, y in zip(signed[:300], signed[300:], strict=True):
        assert root.get(x, x) == root.get(y, y)
    largest = pattern_nodes(prints, 4, 5).groupBy("mask", "bits").count().agg({"count": "max"}).first()[0]
    assert largest <= 5


def test_stars(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(60)]
    hub = [(1000, 1000 + i) for i in range(1, 200)]
    loose = [(2000 + rng.randrange(200), 2000 + rng.randrange(200)) for _ in range(120)]
    pairs = chain + hub + loose
    rng.shuffle(pairs)
    got = {r.u: r.v for r in stars(spark.createDataFrame(pairs, "u long, v long")).collect()}
    nodes = sorted({x for p in pairs for x in p})
    at = {x: k for k, x in enumerate(nodes)}
    label = hamming.components(len(nodes), np.array([at[a] for a, _ in pairs]), np.array([at[b] for _, b in pairs]))
    assert {x: got.get(x, x) for x in nodes} == {x: nodes[label[at[x]]] for x in nodes}


def test_empty_tables(spark):
    assert substring_dedup(empty(spark)).count() == near_duplicates(empty(spark)).count() == 0
    assert one_of_each(empty(spark)).count() == 0
