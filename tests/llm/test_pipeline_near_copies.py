"""The near-copy stage links on 5-word shingles at 80 %; op9_jaccard alone keeps 3 words and 90 %."""

import functools
import random

import corpus_pipeline
import test_jaccard
from tradeloom.llm import jaccard

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def test_one_changed_word_is_a_near_copy(spark):
    base = [f"w{i}" for i in range(54)]
    changed = [*base[:27], "other", *base[28:]]
    docs = spark.createDataFrame([(i, " ".join(t), "en", "s", 1) for i, t in ((1, base), (2, changed), (3, [f"v{i}" for i in range(54)]))], SCHEMA)
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == [1, 3]
    assert jaccard.keep_first(docs).count() == 3


def test_stage_like_comparing_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(test_jaccard, "shingles", functools.partial(test_jaccard.shingles, size=5))
    rng = random.Random(12)
    rows = [r for r in test_jaccard.corpus(6) if r[0] is not None]
    base = [f"b{i}" for i in range(240)]
    rows += [(1000 + i, " ".join(test_jaccard.edited(rng, base, rng.randint(0, 6)))) for i in range(40)]
    expected = sorted(i for i, _, c in test_jaccard.brute(rows, 80) if i == c)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).repartition(4)
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == expected
