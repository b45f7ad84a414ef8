import random

import numpy as np
import pytest

from tradeloom.llm import suffixes
from tradeloom.llm.textcols import mix, unmix


def brute(rows, depth):
    """Rows in the order of ids and texts; null ids stand apart."""
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], (r[1] or "").encode()))
    seen, out = set(), []
    for i, text in order:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - depth + 1):
            window = raw[p : p + depth]
            if window in seen:
                gone[p : p + depth] = b"\1" * depth
            seen.add(window)
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        out.append((i, len(raw), sum(gone), spans, bytes(c for c, g in zip(raw, gone, strict=True) if not g)))
    out += [(None, len((t or "").encode()), 0, 0, (t or "").encode()) for i, t in rows if i is None]
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdeé日 \n") for _ in range(rng.randint(40, 500))) for _ in range(8)]
    rows = []
    for i in range(80):
        text = ""
        for _ in range(rng.randint(0, 5)):
            part = rng.choice(passages)
            cut = rng.randint(0, len(part))
            text += rng.choice([part, part[cut:], part[:cut], "".join(rng.choice("xyz ") for _ in range(rng.randint(0, 200)))])
        rows.append((i * 3 - 50, text))
    rows += [(500 + i, rows[5][1]) for i in range(30)] + [(600, None), (601, ""), (602, "a" * 99), (603, "a" * 100), (604, "a" * 101), (605, "ab" * 3000), (606, "b" * 5000)]
    rows += [(7, rows[9][1]), (7, rows[7][1]), (None, rows[8][1]), (None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, depth, gram", [(1, 100, 32), (2, 100, 32), (3, 20, 7), (4, 30, 30)])
def test_like_comparing_all_windows(spark, seed, depth, gram):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, kept string, chunk int").repartition(5)
    out = suffixes.remove_repeats(docs, depth=depth, gram=gram)
    assert out.columns == ["doc_id", "text", "chunk", "n_bytes", "n_removed", "spans", "kept"]
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in out.collect()), key=str)
    assert got == brute(rows, depth)


def test_no_rows(spark):
    assert suffixes.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_groups_by_passes():
    rng = np.random.default_rng(1)
    digits = [rng.integers(0, 12, 500).astype(np.uint32) for _ in range(3)]
    members, group = suffixes.repeated_groups(digits)
    keys = list(zip(*(d.tolist() for d in digits), strict=True))
    assert set(members.tolist()) == {i for i, k in enumerate(keys) if keys.count(k) > 1}
    assert {(keys[m], g) for m, g in zip(members.tolist(), group.tolist(), strict=True)} == {(k, g) for k, g in dict((keys[m], g) for m, g in zip(members.tolist(), group.tolist(), strict=True)).items()}


def test_sliding_and_mixing():
    values = np.random.default_rng(2).integers(0, 2**63, 200).astype(np.uint64)
    for width in (1, 2, 7, 69, 200, 201):
        assert suffixes.sliding(values, width, True).tolist() == [min(values[i : i + width].tolist()) for i in range(200 - width + 1)]
        assert suffixes.sliding(values, width, False).tolist() == [max(values[i : i + width].tolist()) for i in range(200 - width + 1)]
    assert (unmix(mix(values)) == values).all()
