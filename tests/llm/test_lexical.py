import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from oracle import connect, differences
from tradeloom.llm import lexical
from tradeloom.llm.queries import OP13_SQL, op13_lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    """The contract, document by document."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        found = []
        for i, bag in bags:
            m = 10 + (90 * sum(bag.values()) * n_docs) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in own if bag[t])
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, partitions=3, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(partitions)
    return sorted((tuple(r) for r in lexical.search(d, spark.createDataFrame(items, "item_id long, text string"), **more).collect()), key=str)


def corpus(rng, n, common="the of and to in"):
    rare = [f"w{i}" for i in range(200)]
    docs = []
    for i in range(n):
        words = rng.choices(common.split(), k=rng.randint(0, 30)) + rng.choices(rare, weights=[1 / (j + 1) for j in range(200)], k=rng.randint(0, 20))
        rng.shuffle(words)
        docs.append((i, " ".join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return docs


@pytest.mark.parametrize("sizes", [(1 << 16, 1 << 13), (64, 16), (200, 7)])
def test_like_a_plain_version(spark, monkeypatch, sizes):
    rng = random.Random(sizes[1])
    docs = corpus(rng, 400)
    items = [(j, " ".join(rng.choices(["the", "of", "and", "zzz", *[f"W{i}" for i in range(40)]], k=rng.randint(1, 15)))) for j in range(25)]
    # In this process, as tasks import the module anew: many segments and windows, so that lists are skipped.
    monkeypatch.setattr(lexical, "SEGMENT_DOCUMENTS", sizes[0])
    monkeypatch.setattr(lexical, "WINDOW", sizes[1])
    assert run(spark, docs, items) == plain(docs, items)
    assert local(docs, items) == plain(docs, items)


def local(docs, items, k=10):
    """The task function run here, where the sizes above hold."""
    import numpy as np
    import pyarrow as pa

    class Shared:
        pass

    bags = [Counter(terms(t)) for _, t in docs]
    n_docs, total = sum(map(bool, bags)), sum(sum(b.values()) for b in bags)
    df = Counter(t for b in bags for t in b)
    own = [sorted(set(terms(t))) for _, t in items]
    every = sorted({t for x in own for t in x})
    pairs = {}
    for t in every:
        block = next(iter(lexical.blocks(pa.array([t]))))
        words = block.words(lexical.ALNUM, lower=True)
        pairs[t] = tuple(int(words.hashes(h).view(np.int64)[0]) for h in (lexical.FIRST, lexical.SECOND))
    known = lexical.Terms(list(pairs.values()))
    weights = np.zeros(len(known), np.int64)
    for t, p in pairs.items():
        if df[t]:
            weights[known.number[p]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
    shared = Shared()
    shared.value = (known, weights, [np.array([known.number[pairs[t]] for t in x], np.int64) for x in own], n_docs, total)
    batches = [pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in docs[a : a + 37]], "text": [t for _, t in docs[a : a + 37]]}) for a in range(0, len(docs), 37)]
    rows = [r for b in lexical._searcher(shared, "text", "doc_id", k)(iter(batches)) for r in b.to_pylist()]
    out, rank = [], Counter()
    for r in rows:
        rank[r["number"]] += 1
        out.append((items[r["number"]][0], rank[r["number"]], r["doc_id"], r["score"]))
    return sorted(out, key=str)


def test_one_text_in_a_third_of_all_documents(spark):
    rng = random.Random(9)
    docs = corpus(rng, 300) + [(1000 + i, "the w1 of w2 w3") for i in range(150)]
    items = [(1, "w1 w2 w3"), (2, "the of"), (3, "w9 the")]
    assert run(spark, docs, items, 5) == plain(docs, items)


def test_nulls_ties_repeats_and_names(spark):
    docs = [(5, "a b"), (3, "a b"), (None, "a b"), (3, "a b"), (4, None), (6, ""), (7, "c"), (8, "..."), (9, "Éa ÉA éa"), (10, "x " * 5000 + "q")]
    items = [(None, "a"), (None, "c"), (1, "A a b"), (1, "c"), (2, None), (3, ""), (4, "none"), (5, "éa"), (6, "q x")]
    assert run(spark, docs, items) == plain(docs, items)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("number", "score", "rank", "item", "_salt", "term")})
    i = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("x") for c in ("item", "a", "b", "doc_id")})
    assert sorted((tuple(r) for r in lexical.search(d, i).collect()), key=str) == plain(docs, items)


def test_passes_and_k_and_text_ids(spark):
    rng = random.Random(2)
    docs = corpus(rng, 120)
    items = [(j, " ".join(rng.choices([f"w{i}" for i in range(30)], k=4))) for j in range(12)]
    assert run(spark, docs, items, pairs_per_pass=7) == plain(docs, items)
    assert run(spark, docs, items, k=3) == plain(docs, items, 3)
    named = spark.createDataFrame([(f"i{j}", t) for j, t in items], "item_id string, text string")
    got = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"), named)
    assert sorted((int(r[0][1:]), *r[1:]) for r in got.collect()) == sorted(plain(docs, items))


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == [] and run(spark, [(1, "a")], []) == [] and run(spark, [(1, None)], [(1, "a")]) == []


def test_query_matches_sql_on_more_rows(spark):
    folder = "/root/testdata/sf0.01"
    assert differences(op13_lexical(spark, folder), connect(folder), OP13_SQL) == []
