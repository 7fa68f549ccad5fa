"""The pipeline, stage by stage, against brute force on its own input."""

from collections import Counter, defaultdict

import corpus_pipeline
import public_tokenizers
import sentencepiece
from llm.cases import rows, words
from llm.test_near import brute_groups, brute_print

from beatline.llm.quality import quality
from beatline.runtime import scratch_path


def documents(spark):
    given = [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows()]
    path = scratch_path(spark, "sf")
    spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{path}/documents.parquet"
    )
    return path


def bag(df):
    return Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect())


def test_stages(spark):
    path = documents(spark)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "exact dedup", "near dedup", "mixing", "sentencepiece"]

    good = stages["quality rules"](spark, docs, path).cache()
    judged = quality(docs, corpus_pipeline.PIECES, corpus_pipeline.BYTES).where("kept").collect()
    assert good.columns == docs.columns
    assert Counter(r.doc_id for r in good.collect()) == Counter(r.id for r in judged) and good.count() > 10
    assert all(len(words(r.text)) >= 20 for r in good.collect())

    unique = stages["exact dedup"](spark, good, path).cache()
    least = {}
    for r in good.collect():
        if r.text not in least or (r.doc_id is not None and r.doc_id < (least[r.text] or 1 << 60)):
            least[r.text] = r.doc_id
    assert unique.columns == docs.columns
    assert {r.text: r.doc_id for r in unique.collect()} == least and unique.count() == len(least)

    apart = stages["near dedup"](spark, unique, path).cache()
    held = unique.collect()
    groups = brute_groups([brute_print(r.text, 4) for r in held], 4)
    best = defaultdict(list)
    for g, r in zip(groups, held, strict=True):
        best[g].append(r.doc_id)
    assert apart.columns == docs.columns
    assert Counter(r.doc_id for r in apart.collect()) == Counter(min(ids) for ids in best.values())

    mixed = stages["mixing"](spark, apart, path).cache()
    assert mixed.columns == docs.columns
    kinds, times = bag(apart), bag(mixed)
    assert set(times) <= set(kinds) and max(times.values()) <= 2
    total = sum(len(words(k[1])) * n for k, n in kinds.items())
    taken = sum(len(words(k[1])) * n for k, n in times.items())
    largest = defaultdict(int)
    for k in kinds:
        largest[k[3]] = max(largest[k[3]], len(words(k[1])))
    assert abs(taken - 1.5 * total) <= sum(largest.values())

    encoded = stages["sentencepiece"](spark, mixed, path).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter()
    for (i, t, *_), n in times.items():
        want[i, tuple(library.encode(t))] += n
    assert Counter((r.doc_id, tuple(r.ids)) for r in encoded) == want
    assert all(r.round_trip for r in encoded)

    whole = corpus_pipeline.run(spark, path).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in whole) == want


def test_empty(spark):
    path = scratch_path(spark, "sf")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{path}/documents.parquet"
    )
    assert corpus_pipeline.run(spark, path).count() == 0
