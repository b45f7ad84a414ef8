import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tradeloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def known():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(5)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    cuts = [every[i : i + 5000] for i in range(0, len(every), 5000)]
    alone = [f"a{c}b {c} {c}{c} 1{c}2" for c in (chr(c) for c in range(0x3100))]
    mixed = ["".join(rng.choice("aab eé'st\n\t 12.,ñ日😀 \u0085\x1c") for _ in range(rng.randint(1, 300))) for _ in range(300)]
    edge = [None, "", " ", "   ", "a" * 50_000, "ab" * 30_000, " " * 9000, "x<|endoftext|>y <|endoftext|><|endoftext|> z", "<|endoftext|>", "\0added:x \0added:<|endoftext|>", "I'll don't 'S"]
    return [*cuts, " ".join(alone), *mixed, *edge]


def test_encode_and_decode_like_the_library(spark, known):
    rows = [(i, t, "kept") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(4)
    out = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert len(out) == len(rows)
    for row in out:
        expected = known.encode(row["text"] or "", add_special_tokens=False).ids
        assert list(row["ids"]) == expected, repr((row["text"] or "")[:80])
        assert row["decoded"] == known.decode(expected, skip_special_tokens=False)


def test_decode_broken_bytes_and_nulls(spark, known):
    rows = [(0, [160, 247]), (1, []), (2, None), (3, known.encode("日本😀").ids[:-1])]
    out = {r[0]: r["decoded"] for r in bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH).collect()}
    assert out[1] == out[2] == ""
    assert out[0] == known.decode([160, 247]) and out[3] == known.decode(rows[3][1])


def test_no_rows(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_overlapping_pairs():
    vocab = bpe.Vocabulary(PATH)
    for n in range(1, 40):
        ids, counts = bpe.merge_pieces([b"a" * n, b"b"], vocab)
        assert counts.sum() == len(ids) and counts[1] == 1
        assert b"".join(vocab.bytes[vocab.offsets[i] : vocab.offsets[i] + vocab.lengths[i]].tobytes() for i in ids[: counts[0]]) == b"a" * n


def test_forgetting_changes_nothing(monkeypatch, known):
    monkeypatch.setattr(bpe, "KNOWN_PIECES", 5)
    encoder = bpe.Encoder(bpe.Vocabulary(PATH))
    for text in ["one two three four five six seven", "two three eight", "one nine ten two"]:
        values, counts = encoder.encode([text, None, text])
        expected = known.encode(text).ids
        assert values.tolist() == expected * 2 and np.array_equal(counts, [len(expected), 0, len(expected)])
