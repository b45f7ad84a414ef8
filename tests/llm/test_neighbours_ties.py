"""Exact copies that tie at the rerank cut."""

import numpy as np
import pytest

from test_neighbours import brute, found
from tradeloom.llm import neighbours


@pytest.mark.parametrize("share", [3, 2])
def test_copies_of_a_third_and_of_half_of_the_rows(spark, share):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=32).astype(np.float32).tolist(), 0) for i in range(1500)]
    hot = rng.normal(size=32).astype(np.float32).tolist()
    # Ids are dealt to copies and others alike, so the smallest ids among the copies stand anywhere in a shard.
    copies = set(rng.permutation(1500)[: 1500 // share].tolist())
    rows = [(i, hot if i in copies else v, 0) for i, v, _ in rows]
    got = {q: v for q, v in found(spark, rows, 10).items() if q in copies}
    known = brute([r[:2] for r in rows], got, 10)
    assert got and all(got[q] == known[q] for q in got)


def test_nothing_that_ties_at_the_cut_is_left_out():
    import pyarrow as pa

    # All vectors have the same prefix: every footrule distance ties, and only the exact one tells them apart.
    ids = np.random.default_rng(4).permutation(400)
    values = ids.astype(float)
    table = lambda at: pa.table({"vec_id": ids[at], "vector": [[v, 1.0] for v in values[at]], "near": [np.array([0, 1], np.int32)] * len(ids[at])})
    got = neighbours._nearest(10, 2, 0.05)(table(slice(None)), table(np.flatnonzero(ids == 0))).to_pydict()
    assert got["vec_id"] == list(range(1, 11)) and got["score"] == [float(i) for i in range(1, 11)]
