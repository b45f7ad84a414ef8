import random
import re

import numpy as np
import pytest

from tradeloom.llm import jaccard

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=3):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, percent=90):
    sets = [shingles(t) for _, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for p, (i, _) in enumerate(rows):
        for q in range(p):
            j = rows[q][0]
            if i is None or j is None or not sets[p] or not sets[q]:
                continue
            common = len(sets[p] & sets[q])
            if 100 * common >= percent * (len(sets[p]) + len(sets[q]) - common):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return sorted(((i, len(s), None if i is None else top(i)) for (i, _), s in zip(rows, sets, strict=True)), key=str)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words) + 1)
        kind = rng.randrange(3)
        if kind == 0 and at < len(words):
            words[at] = f"e{rng.randrange(10**6)}"
        elif kind == 1:
            words.insert(at, f"e{rng.randrange(10**6)}")
        elif len(words) > 1:
            del words[min(at, len(words) - 1)]
    return words


def corpus(seed):
    rng = random.Random(seed)
    rows, n = [], 0
    for _ in range(25):
        base = [f"W{rng.randrange(3000)}é" for _ in range(rng.choice([1, 2, 3, 5, 8, 15, 25, 40, 80, 200]))]
        for _ in range(rng.randint(1, 9)):
            rows.append((n, " ".join(edited(rng, base, rng.randint(0, max(1, len(base) // 25))))))
            n += 1
    # A chain: each one links to the next, the ends do not.
    base = [f"c{i}" for i in range(120)]
    for step in range(12):
        rows.append((n, "\n".join(base)))
        base = edited(rng, base, 1)
        n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \t"), (n + 3, "UPPER case"), (n + 4, "upper CASE"), (n + 5, "x " * 20_000), (n + 6, "x x x x"), (None, rows[0][1]), (None, None)]
    rows += [(n + 10 + i, rows[3][1]) for i in range(20)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, many", [(1, 100), (2, 2)])
def test_like_comparing_all_pairs(spark, monkeypatch, seed, many):
    monkeypatch.setattr(jaccard, "MANY", many)
    monkeypatch.setattr(jaccard, "BLOCK", 5)
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, 1, "y") for i, t in rows], "doc_id long, text string, size int, sign string").repartition(4)
    got = sorted((tuple(r) for r in jaccard.link(docs).collect()), key=str)
    assert got == brute(rows)


@pytest.mark.parametrize("many, block", [(100, 256), (3, 8)])
def test_copies_that_only_link_to_their_base(spark, monkeypatch, many, block):
    monkeypatch.setattr(jaccard, "MANY", many)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(8)
    base = [f"b{i}" for i in range(200)]
    rows = [(50, " ".join(base))]
    for i in range(50):
        words = list(base)
        for at in rng.sample(range(3, 197), 3):
            words[at] = f"n{i}-{at}"
        rows.append((i, " ".join(words)))
    got = sorted((tuple(r) for r in jaccard.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute(rows)


def test_two_texts_of_one_id_tie_their_classes(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(5, a), (5, b), (1, a), (2, b), (9, "other words here")]
    got = {(r["doc_id"], r["component_id"]) for r in jaccard.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(5, 1), (1, 1), (2, 1), (9, 9)}


def test_first_of_each_group_stays(spark):
    rows = corpus(3)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, node int")
    firsts = {(i, c) for i, _, c in brute(rows)}
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted([str(i) for i, c in firsts if i is not None and i == c] + ["None", "None"])


def test_no_rows(spark):
    assert jaccard.link(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(5)
    for _ in range(300):
        common = rng.integers(1, 2**63, rng.integers(1, 150)).astype(np.uint64)
        more = [rng.integers(1, 2**63, rng.integers(0, 1 + len(common) // 9)).astype(np.uint64) for _ in range(2)]
        sets = [np.unique(np.concatenate([common, m])) for m in more]
        both = len(np.intersect1d(*sets))
        if 100 * both < 90 * (len(sets[0]) + len(sets[1]) - both) or both == len(sets[0]) == len(sets[1]):
            continue  # equal sets are one node and need no signature
        row, feature = np.repeat([0, 1], [len(s) for s in sets]), np.concatenate(sets)
        signer, sign, _ = jaccard._signatures(row, feature, 2, 90)
        assert set(sign[signer == 0].tolist()) & set(sign[signer == 1].tolist())


def test_sketches_never_differ_more_than_sets():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (0, 1, 5, 31, 32, 33, 300, 5000)]
    sets += [np.sort(np.r_[s[: len(s) * 9 // 10], rng.integers(0, 1 << 63, len(s) // 10 + 1).astype(np.uint64)]) for s in sets]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    packed, at = jaccard._sketches(row, np.concatenate(sets), len(sets))
    own = [packed[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    for s, x in zip(sets, own, strict=True):
        assert len(x) >= max(8, len(s) / 4) and 8 * len(x) <= max(64, 4 * len(s))
        for t, y in zip(sets, own, strict=True):
            length = min(len(x), len(y))
            apart = int(np.bitwise_count(jaccard._folded(x, length) ^ jaccard._folded(y, length)).sum())
            assert apart <= len(np.setxor1d(s, t)) and (apart - len(np.setxor1d(s, t))) % 2 == 0


def test_few_pairs_are_compared_in_one_pass(spark, monkeypatch):
    passes, similar = [], jaccard._similar
    monkeypatch.setattr(jaccard, "_similar", lambda *a: passes.append(a) or similar(*a))
    words = [f"w{i}" for i in range(100)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join([*words, "x"])), (3, "other words here")], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard.link(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3}
    assert len(passes) == 1
