import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tradeloom.llm import lm_scores, packing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(words, n):
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(texts):
    docs = [WORD.findall((t or "").translate(LOWER)) for t in texts]
    every = {n: sum((grams(d, n) for d in docs), Counter()) for n in (1, 2, 3)}
    total, out = sum(map(len, docs)), []
    for d in docs:
        own = {n: grams(d, n) for n in (1, 2, 3)}
        count = lambda g: every[len(g)][g] - own[len(g)][g]  # noqa: E731, B023

        def score(g):
            if len(g) == 1:
                return count(g) / (total - len(d)) if count(g) > 0 else 0.4 / (total - len(d) + 1)
            return count(g) / count(g[:-1]) if count(g) > 0 else 0.4 * score(g[1:])

        out.append((len(d), sum(math.log(score(tuple(d[max(0, i - 2) : i + 1]))) for i in range(len(d)))))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_like_counting_everything(spark, seed):
    rng = random.Random(seed)
    texts = [rng.choice([" ", "\n", " \t "]).join(rng.choices(["The", "the", "cat", "sät", "on", "mat.", f"w{rng.randrange(200)}"], k=rng.randint(0, 60))) for _ in range(200)]
    texts += [None, "", "  ", "alone", "the", "two words", "the cat " * 20_000, texts[5], texts[5], "x\u0085y é"]
    docs = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, n_words int").repartition(5)
    out = lm_scores.score(docs)
    assert out.columns == ["doc_id", "text", "n_words", "log_score", "mean_log_score"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == len(texts)
    for i, (n, log) in enumerate(brute(texts)):
        assert got[i]["n_words"] == n and got[i]["log_score"] == pytest.approx(log, rel=1e-9, abs=1e-9)
        assert (got[i]["mean_log_score"] is None) == (n == 0)


@pytest.mark.parametrize("texts", [[], [None], ["only one document here"], ["", "one"]])
def test_little_to_count(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [(r["n_words"], pytest.approx(r["log_score"])) for r in lm_scores.score(docs).orderBy("doc_id").collect()] == brute(texts)


def test_planes():
    values = np.array([0, 1, 255, 256, 2**40], np.uint64)
    assert packing.unplanes(packing.planes(values), np.uint64).tolist() == values.tolist()
