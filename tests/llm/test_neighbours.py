import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeloom.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, query_ids, k):
    data = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    out = {}
    for q in query_ids:
        near = sorted((float(np.sqrt(((v - data[q]) ** 2).sum())), i) for i, v in data.items() if i != q)
        out[q] = near[:k]
    return out


def found(spark, rows, modulus, k=10, **options):
    vectors = neighbours.usable(spark.createDataFrame(rows, SCHEMA))
    index = neighbours.build(vectors)
    got = {}
    for r in neighbours.search(index, index.where(F.col("vec_id") % modulus == 0), k, **options).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    return {q: [x[1:] for x in sorted(v)] for q, v in got.items()}


@pytest.mark.parametrize("copies", [0, 400])
def test_recall_against_brute_force(spark, copies):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=32).astype(np.float32).tolist(), 0) for i in range(1200)]
    hot = rng.normal(size=32)
    rows += [(1200 + i, (hot + 1e-3 * rng.normal(size=32)).astype(np.float32).tolist(), 0) for i in range(copies)]
    got = found(spark, rows, 50)
    known = brute([r[:2] for r in rows], got, 10)
    assert set(got) == {r[0] for r in rows if r[0] % 50 == 0}
    hits = sum(len({i for _, i in got[q]} & {i for _, i in known[q]}) for q in got)
    assert hits >= 0.9 * 10 * len(got)
    exact = {q: dict((i, s) for s, i in brute([r[:2] for r in rows], [q], len(rows))[q]) for q in list(got)[:5]}
    assert all(abs(exact[q][i] - s) < 1e-12 for q in exact for s, i in got[q])


def test_unusable_rows_ties_and_repeats(spark):
    good = [(i, [float(i), 1.0, 0.0], 1) for i in range(0, 12)]
    bad = [(100, None, 1), (101, [0.0, 0.0, 0.0], 1), (102, [1.0, None, 2.0], 1), (103, [float("nan"), 1.0, 1.0], 1), (104, [float("inf"), 1.0, 1.0], 1), (105, [1.0, 2.0], 1), (None, [1.0, 2.0, 3.0], 1), (106, [], 1)]
    twice = [(3, [3.0, 1.0, 0.0], 1), (20, [5.0, 1.0, 0.0], 1), (21, [5.0, 1.0, 0.0], 1)]
    got = found(spark, good + bad + twice, 5, k=30)
    assert set(got) == {0, 5, 10, 20}
    assert [i for _, i in got[5]] == [20, 21, 4, 6, 3, 7, 2, 8, 1, 9, 0, 10, 11]
    assert got[5][0][0] == 0.0


@pytest.mark.parametrize("rows", [[], [(0, None, 1)], [(100, [1.0, 2.0], 1)]])
def test_nothing_to_find(spark, rows):
    assert found(spark, rows, 50) == {}


def test_footrule():
    near = np.array([[0, 1, 2], [2, 1, 0], [3, 4, 5], [1, 0, 3]], np.int32)
    place = lambda row, p: list(row).index(p) if p in row else 3
    expected = [sum(abs(place(near[0], p) - place(r, p)) for p in range(6)) for r in near]
    assert neighbours.InvertedFiles(near, 6).footrule(near[0]).tolist() == expected
