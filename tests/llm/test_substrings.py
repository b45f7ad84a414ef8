import random
import re

import numpy as np
import pytest

from tradeloom.llm import substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k):
    words = [WORD.findall(t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words, strict=True):
        if i is not None:
            for p in range(len(w) - k + 1):
                key = tuple(w[p : p + k])
                first[key] = min(first.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for p in range(len(w) - k + 1):
            if i is not None and first[tuple(w[p : p + k])] < i:
                gone[p : p + k] = [True] * k
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out, key=str)


def corpus(seed, small=False):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(3 if small else 400)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(5, 60))] for _ in range(6)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(0, 5)):
            part = rng.choice(passages)
            cut = rng.randint(0, len(part) - 1)
            words += rng.choice([part, part[cut:], part[:cut], [rng.choice(vocabulary) for _ in range(rng.randint(0, 30))]])
        rows.append((i, rng.choice([" ", "  ", "\n", "\t "]).join(words)))
    rows += [(200 + i, rows[5][1]) for i in range(30)] + [(300, None), (301, ""), (302, "   x\u0085y\x1cz"), (303, "a " * 30_000), (304, "a " * 40_000)]
    rows += [(7, rows[9][1]), (7, rows[7][1]), (None, rows[8][1]), (None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, small, k, gram", [(1, False, 13, 8), (2, True, 13, 8), (3, True, 5, 3), (4, False, 13, 13)])
def test_like_comparing_all_windows(spark, seed, small, k, gram):
    rows = corpus(seed, small)
    docs = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, kept string, chunk int").repartition(5)
    out = substrings.remove_repeats(docs, k=k, gram=gram)
    assert out.columns == ["doc_id", "text", "chunk", "n_words", "n_removed", "spans", "kept"]
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in out.collect()), key=str)
    assert got == brute(rows, k)


def test_paths_of_the_graph(spark):
    passage = [f"p{i}" for i in range(40)]
    mine = lambda n, c: [f"{c}{i}" for i in range(n)]
    rows = [(1, passage), (2, mine(5, "b") + passage + mine(5, "c")), (3, mine(3, "d") + passage[:20] + mine(9, "e")), (4, mine(20, "f"))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    out = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in substrings.remove_repeats(docs).collect()}
    # Edges 0-7 of the passage are in three documents, 8-27 in two: the path branches after edge 7.
    assert out == {1: [], 2: [(5, 20, 1), (13, 32, 1)], 3: [(3, 20, 1)], 4: []}


def test_no_rows(spark):
    assert substrings.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_colliding_hashes_are_told_apart():
    # Same 64-bit hash, other check: two rows of edges, not one.
    run = substrings._find_edges(1, 1, "doc_id", "text")
    import pyarrow as pa

    table = pa.table({"doc_id": pa.array([1, 2]), "text": ["a b", "a c"], "_chunk": pa.array([0, 0], pa.int32())})
    anchors = substrings._find_anchors(1, 1, "doc_id", "text")((pa.scalar(0),), table)
    edges = run((pa.scalar(0),), table, anchors)
    assert edges.num_rows == 3 and np.all(edges.column("more").to_numpy() >= 0)
