"""Documents with everything awkward, and brute-force answers in plain Python."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id string, row string, kept boolean, n int, key binary, `a.b` string, bits long"
)
WORDS = ["tion", "thand", "of", "the", "été", "große", "x", "l'eau", "don't", "and,", "12", "3rd", "🙂ok", "Ünder", "aaaa", "|"]


def text(rng, words):
    parts = []
    for _ in range(words):
        parts.append(rng.choice(WORDS) + rng.choice(["", "", "", "s", "ing"]))
        parts.append(rng.choice([" ", " ", " ", " ", "  ", "\n", "\t", " \n"]))
    return "".join(parts)


def rows(seed=0):
    """(doc_id, text, lang, source): nulls, empty and long texts, ties, repeated rows."""
    rng = random.Random(seed)
    out = [
        (1, None, "en", "b"),
        (2, "", None, None),
        (3, " \t\n\n", "en", "a"),
        (None, "a text without an id of its own", "en", "a"),
        (None, None, None, None),
        (4, "one", "xx", ""),
        (5, "trailing space ", "en", "b"),
        (6, "  two  leading", "fr", "b"),
        (7, "ends <|endoftext|>here <|endoftext|>", "en", "c"),
        (13, "<|endoftext|>" * 12, "en", "c"),
        (8, "odd\x1cbreaks\x85and\xa0spaces there　 \x00end", "en", "c"),
        (9, "été İstanbul ΣΑΣ ſ", "el", "c"),
        (10, "▁already ▁escaped▁", "en", "c"),
        (11, "w" * 300 + " " + "ab" * 120, "en", "c"),
        (12, "Same Line \nother\n same line\n\nSAME LINE", "en", "c"),
    ]
    long_text = text(rng, 4000)
    out += [(20, long_text, "en", "a"), (21, long_text, "en", "a"), (21, long_text, "en", "a")]
    passage = " ".join(rng.choice(WORDS) + str(i % 7) for i in range(40))
    for i in range(30, 60):
        own = text(rng, rng.randint(1, 60))
        out.append((i, own + passage + text(rng, 5) if i % 3 == 0 else own, rng.choice(["en", "fr", None]), rng.choice("abcde")))
    out += [(60 + i, "same line\nSome shared boilerplate\n" + text(rng, 4), "en", "a") for i in range(12)]
    out += [(80 + i, long_text[:600], "en", "hot") for i in range(25)]
    out += [(33, "a second text under a known id", "en", "b"), (33, "a second text under a known id", "en", "b")]
    rng.shuffle(out)
    return out


def frame(spark, given):
    full = [(i, t, lang, s, 0, "clash", "clash", False, 7, b"k", "dot", 1) for i, t, lang, s in given]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


SPACE = " \t\n\r\x0b\x0c"


def words(t):
    return [w.decode() for w in (t or "").encode().split()]


def null_last(x):
    return (x is None, x or 0)
