"""Quality rules, exact and line deduplication, mixing."""

import base64
import hashlib
import math
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from llm.cases import SPACE, empty, frame, null_last, rows, words

from beatline.llm.exact_dedup import exact_dedup, unique_rows
from beatline.llm.line_dedup import LineIndex, line_dedup
from beatline.llm.mixing import mix, mixed_rows
from beatline.llm.quality import BANDS, Band, kept_documents, quality

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("keep,hot_rows", [("smallest", 2000), ("largest", 2000), ("smallest", 3), ("largest", 3)])
def test_exact_dedup(spark, keep, hot_rows):
    given = rows()
    groups = defaultdict(list)
    for i, t, *_ in given:
        groups[t or ""].append(i)
    found = exact_dedup(frame(spark, given), keep=keep, hot_rows=hot_rows).collect()
    assert len(found) == len(given)
    by_sha = defaultdict(list)
    for r in found:
        by_sha[r.text_sha256].append(r)
    for t, ids in groups.items():
        got = by_sha[hashlib.sha256(t.encode()).hexdigest()]
        known = [i for i in ids if i is not None]
        want = (min if keep == "smallest" else max)(known) if known else None
        assert sorted((r.id for r in got), key=null_last) == sorted(ids, key=null_last)
        assert {(r.keep_id, r.group_size) for r in got} == {(want, len(ids))}
        assert [r.id for r in got if r.kept] == [want]


def test_unique_rows(spark):
    given = rows()
    kept = unique_rows(frame(spark, given), hot_rows=5)
    assert kept.columns == frame(spark, given).columns
    assert Counter(r.text or "" for r in kept.collect()) == Counter({t or "": 1 for _, t, *_ in given})


def key(line):
    return line.encode().strip(SPACE.encode()).lower().decode()


def cut(t, frequent):
    lines = (t or "").split("\n")
    kept = [x for x in lines if key(x) not in frequent]
    return len(lines), len(lines) - len(kept), "\n".join(kept)


def brute_lines(given, least=10):
    seen = Counter()
    for _, t, *_ in given:
        seen.update({key(x) for x in (t or "").split("\n")} - {""})
    return {k for k, n in seen.items() if n >= least}


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
def test_line_dedup(spark, broadcast_bytes):
    given = rows()
    frequent = brute_lines(given)
    assert {"same line", "some shared boilerplate"} <= frequent
    got = line_dedup(frame(spark, given), broadcast_bytes=broadcast_bytes).collect()
    want = Counter((i, *cut(t, frequent)) for i, t, *_ in given)
    assert Counter((r.id, r.n_lines, r.n_dropped, r.kept) for r in got) == want


def test_line_index_is_reversible(spark):
    first, more = rows(), rows(1)
    index = LineIndex(spark, shards=3, min_docs=10)
    index.insert(frame(spark, first))
    before = sorted((bytes(r.key), r.n) for r in index.refs.collect())
    index.insert(frame(spark, more))
    asked = frame(spark, first)
    both = brute_lines(first + more)
    assert {r.kept for r in index.apply(asked).collect()} == {cut(t, both)[2] for _, t, *_ in first}
    index.delete(frame(spark, more))
    assert sorted((bytes(r.key), r.n) for r in index.refs.collect()) == before
    alone = brute_lines(first)
    assert alone != both
    assert {r.kept for r in index.apply(asked).collect()} == {cut(t, alone)[2] for _, t, *_ in first}
    with pytest.raises(ValueError, match="never inserted"):
        index.delete(frame(spark, [(1, "a line nobody has seen", None, None)]))


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        load = sum(weight[s] for s in order if s not in capped)
        free = share * total - sum(most * sizes[s] for s in capped)
        target = {s: most * sizes[s] if s in capped else free * weight[s] / load for s in order}
        above = {s for s in order if s not in capped and target[s] > most * sizes[s]}
        if not above:
            return target
        capped |= above


def test_mix(spark):
    given = rows()
    sizes = Counter()
    for _, t, _, s in given:
        sizes[s] += len(words(t))
    got = mix(frame(spark, given)).collect()
    assert len(got) == len(given)
    targets = brute_targets(sizes)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.source_size == sizes[r.source]
        assert math.isclose(r.target, targets[r.source])
        assert r.taken == r.size * r.times and 0 <= r.times <= 2
        taken[r.source] += r.taken
    # Rows of one id are taken together, so a source misses its target by half of the largest such unit at most.
    unit = Counter()
    for i, t, _, s in given:
        unit[s, i] += len(words(t))
    for (s, _), n in unit.items():
        largest[s] = max(largest[s], n)
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= largest[s] / 2 + 1e-6
    again = mix(frame(spark, given)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_larger_mixes_are_supersets(spark):
    docs = frame(spark, rows())
    small = Counter({(r.id, r.size, r.source): r.times for r in mix(docs, share=0.5).collect()})
    large = {(r.id, r.size, r.source): r.times for r in mix(docs, share=0.9).collect()}
    assert all(large[k] >= n for k, n in small.items())


def test_mixed_rows(spark):
    docs = frame(spark, rows())
    want = Counter()
    for r in mix(docs).collect():
        want[r.id] += r.times
    got = mixed_rows(docs)
    assert got.columns == docs.columns
    assert Counter(r.doc_id for r in got.collect()) == +want


def brute_base(t):
    own, w = t or "", words(t)
    windows = defaultdict(list)
    for i in range(len(w) - 7):
        windows[tuple(w[i : i + 8])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in own.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(own.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def brute_rates(t):
    import sentencepiece
    from tokenizers import Tokenizer

    w = words(t)
    sp, bp = sentencepiece.SentencePieceProcessor(model_file=PIECES), Tokenizer.from_file(BYTES)
    ids = [i for x in w for i in sp.encode(x)]
    n = Counter(ids)
    entropy = -sum(c / len(ids) * math.log2(c / len(ids)) for c in n.values())
    chars = sum(map(len, w))
    byte = sum(len(bp.encode(" " + x, add_special_tokens=False).ids) for x in w)
    return chars / len(ids), chars / byte, sum(sp.is_byte(i) for i in ids) / len(ids), entropy


def test_quality(spark):
    given = [r for r in rows() if r[1] is None or "<|" not in r[1]]
    got = quality(frame(spark, given), PIECES, BYTES).collect()
    want = Counter((i, *brute_base(t)) for i, t, *_ in given)
    assert Counter((r.id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    by_id = {i: t for i, t, *_ in given if i not in (None, 33)}
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
        if r.id in by_id and r.n_words:
            rates = brute_rates(by_id[r.id])
            assert all(map(math.isclose, (r.chars_per_piece, r.chars_per_byte_token, r.byte_share), rates[:3]))
            assert math.isclose(r.entropy, rates[3], abs_tol=1e-9)
            band = BANDS[r.band]
            inside = (
                band.chars_per_piece[0] <= rates[0] <= band.chars_per_piece[1]
                and band.chars_per_byte_token[0] <= rates[1] <= band.chars_per_byte_token[1]
                and rates[2] <= band.most_byte_share
                and rates[3] >= band.least_entropy_share * min(9, math.log2(round(r.word_chars / rates[0]))) - 1e-9
            )
            assert r.kept == (inside and not r.base_failed)
        elif not r.n_words:
            assert r.entropy is None and not r.kept


def test_bands_by_language_and_script(spark):
    cyrillic = " ".join(["это", "простой", "текст", "который", "читают", "люди", "каждый", "день", "дома"] * 3 + list("абвгдежз"))
    given = [(1, cyrillic, None, None), (2, cyrillic, "ru", None), (3, "12 34 " * 20, None, None)]
    strict = BANDS | {"ru": Band(chars_per_piece=(50.0, 60.0))}
    got = {r.id: r for r in quality(frame(spark, given), PIECES, BYTES, bands=strict, most_repeats=1.0).collect()}
    assert (got[1].band, got[2].band, got[3].band) == ("CYRILLIC", "ru", "*")
    assert got[1].kept and not got[2].kept
    kept = kept_documents(frame(spark, given), PIECES, BYTES, bands=strict, most_repeats=1.0)
    assert kept.columns == frame(spark, given).columns and 1 in {r.doc_id for r in kept.collect()}


def junk(rng):
    """Texts that pass the base rules and are no language."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    return {
        "letter soup": " ".join("".join(rng.choices(letters, k=rng.randint(3, 9))) for _ in range(300)),
        "encoded": " ".join(base64.b64encode(rng.randbytes(57)).decode() for _ in range(40)),
        "hexadecimal": " ".join(rng.randbytes(16).hex() for _ in range(60)),
        "symbols": " ".join("".join(rng.choices("#*$%&|<>=+-_/^~", k=rng.randint(2, 8))) for _ in range(200)),
    }


def test_junk_is_rejected_in_every_language(spark):
    given = [
        (10 * k + j, t, lang, name)
        for k, lang in enumerate(["en", "de", "fr", "es"])
        for j, (name, t) in enumerate(junk(random.Random(7)).items())
    ]
    got = {r.id: r for r in quality(frame(spark, given), PIECES, BYTES).collect()}
    assert not any(r.base_failed for r in got.values())
    assert [(lang, name) for i, _, lang, name in given if got[i].kept] == []


def test_empty_tables(spark):
    docs = empty(spark)
    assert exact_dedup(docs).count() == line_dedup(docs).count() == mix(docs).count() == 0
    assert quality(docs, PIECES, BYTES).count() == mixed_rows(docs).count() == 0
