import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.test_jaccard import brute
from tradeloom.llm import jaccard


def quoting(seed, docs):
    """Texts of their own that quote a passage which all others quote as well; every tenth is edited once more."""
    rng = random.Random(seed)
    common, rows = [f"p{i}" for i in range(25)], []
    for i in range(docs):
        own = [f"o{i}-{k}" for k in range(rng.randint(38, 42))]
        words = own[:20] + common + own[20:]
        rows.append((len(rows), " ".join(words)))
        if i % 10 == 0:
            words[5] = f"e{i}"
            rows.append((len(rows), " ".join(words)))
    return rows


def test_sets_with_a_common_passage_are_no_crowd(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MANY", 4)
    dealt, in_blocks = [], jaccard._in_blocks
    monkeypatch.setattr(jaccard, "_in_blocks", lambda members, sets: dealt.append(members.count()) or in_blocks(members, sets))
    met, meeting = [], jaccard._meeting
    monkeypatch.setattr(jaccard, "_meeting", lambda members, *a: met.append(members.count()) or meeting(members, *a))
    rows = quoting(3, 200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in jaccard.link(docs, percent=80).collect()), key=str) == brute(rows, 80)
    assert dealt == []
    # There were crowded signatures; their members were told apart.
    assert met and met[0] > 50


@pytest.mark.parametrize("most", [1 << 19, 3, 0])
def test_texts_that_are_mostly_common_lose_no_link(spark, monkeypatch, most):
    monkeypatch.setattr(jaccard, "MANY", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 5)
    monkeypatch.setattr(jaccard, "COMMON", 2)
    monkeypatch.setattr(jaccard, "MOST_COMMON", most)
    rng = random.Random(most)
    parts = [[f"c{p}-{i}" for i in range(30)] for p in range(4)]
    rows = []
    for i in range(90):
        words = [w for p in rng.sample(parts, 3) for w in p]
        for k in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"n{i}-{k}"
        rows.append((i, " ".join(words)))
    rows += [(7, rows[3][1]), (None, rows[4][1]), (200, None), (201, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in jaccard.link(docs).collect()), key=str) == brute(rows)


def test_linked_sets_share_a_first_feature(spark):
    rng = np.random.default_rng(7)
    sets = []
    for i in range(60):
        both = rng.integers(1, 1 << 63, rng.integers(1, 60)).astype(np.uint64)
        sets += [np.unique(np.r_[both, rng.integers(1, 1 << 63, rng.integers(0, 1 + len(both) // 8)).astype(np.uint64)]) for _ in range(2)]
    every = np.unique(np.concatenate(sets))
    common = np.sort(rng.choice(every, len(every) // 2, replace=False))
    table = pa.table({"id": pa.array(range(len(sets)), pa.int64()), "features": pa.array([s.tobytes() for s in sets], pa.binary())})
    first = {}
    for r in jaccard._prefixes(spark.createDataFrame(table), (common, rng.integers(17, 40, len(common))), 80).collect():
        first.setdefault(r.id, set()).add(r.sign)
    for i, x in enumerate(sets):
        assert len(first[i]) == len(x) - -(-80 * len(x) // 100) + 1
        for j, y in enumerate(sets[:i]):
            shared = len(np.intersect1d(x, y))
            if 100 * shared >= 80 * (len(x) + len(y) - shared):
                assert first[i] & first[j]
