"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

from llm.cases import empty, frame, rows, text

from beatline.llm import ranked_search as search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, top=10):
    held = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    many = sum(1 for _, c in held if c)
    every = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = Counter()
    for item, asked in items:
        scored = []
        for i, c in held:
            n, score = sum(c.values()), 0
            for t in TERM.findall((asked or "").translate(LOWER)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * c[t] // (1000 * c[t] + 8 * (25 + 75 * n * many // every)))
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scored)[:top], 1):
            out[item, rank, i, -score] += 1
    return out


def items(spark, given):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in given], "item_id long, text string, id string, rank int")


ASKED = [
    (1, None), (2, ""), (3, "?!"), (4, "the THE The of"), (5, "ÉTÉ été große"), (6, "nowhere"), (7, "same line other x 12"),
    (8, "12 3rd 🙂ok"), (8, "12 3rd 🙂ok"), (None, "thands tioning"), (9, text(random.Random(9), 300)),
]


def test_all_scores(spark):
    given = rows()
    found = search.ranked_search(frame(spark, given), items(spark, ASKED)).collect()
    assert Counter(map(tuple, found)) == brute([(i, t) for i, t, _, _ in given], ASKED)


def test_any_width_and_blocks_of_queries(spark, monkeypatch):
    """One coordinate for all terms, queries in several passes, tasks merged in two rounds."""
    given = rows(5)
    monkeypatch.setattr(search, "QUERY_BYTES", 400)
    monkeypatch.setattr(search, "MERGED", 2)
    for width in (1, 7):
        found = search.ranked_search(frame(spark, given), items(spark, ASKED), top=3, width=width).collect()
        assert Counter(map(tuple, found)) == brute([(i, t) for i, t, _, _ in given], ASKED, 3)


def test_sketches_bound_every_count(spark):
    """A sketch's coordinate is at least the count of every term hashed there, so no bound is below a score."""
    import numpy as np

    rng = random.Random(2)
    common = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join(rng.choices(common, k=80))) for i in range(3000)]
    asked = [" ".join(rng.choices(common, k=6)) for _ in range(5)]
    queries = search.lookup(asked, search.WIDTH)
    held = search.index(spark.createDataFrame(docs, "id long, text string").coalesce(1), queries).toArrow().to_batches()
    assert sum(map(len, held)) == len(docs)
    for batch in held:
        row, place, _ = search._ragged(batch.column("places"))
        _, most, _ = search._ragged(batch.column("most"))
        owner, term, _ = search._ragged(batch.column("terms"))
        _, tf, _ = search._ragged(batch.column("tfs"))
        sketch = np.zeros((len(batch), search.WIDTH), np.int64)
        sketch[row, place] = most
        assert (sketch[owner, queries.coordinates[term]] >= tf).all()


def test_empty_tables(spark):
    asked = items(spark, ASKED)
    assert search.ranked_search(empty(spark), asked).count() == 0
    assert search.ranked_search(frame(spark, rows()), asked.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert search.ranked_search(blank, asked).count() == 0
