import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import sentencepiece

from tradeloom.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts():
    rng = random.Random(12)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    cuts = [every[i : i + 3000] for i in range(0, len(every), 90_000)]
    mixed = ["".join(rng.choice("aab eé'st\n\t 12.,ñ日😀 \u0085\x1cthein▁") for _ in range(rng.randint(1, 300))) for _ in range(300)]
    edge = [None, "", " ", "   ", "\n", "▁", "▁▁ a", "a" * 5000, "ab" * 3000, " " * 3000, "the" * 2000, "<s>x</s><0x41> <unk>", "x\0y", "ﬁ　x "]
    return [*cuts, *mixed, *edge]


def test_encode_and_decode_like_the_library(spark, library):
    rows = [(i, t, "kept") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(4)
    out = pieces.decode(pieces.encode(docs, PATH), PATH).collect()
    assert len(out) == len(rows)
    for row in out:
        expected = library.encode(row["text"] or "")
        assert list(row["ids"]) == expected, repr((row["text"] or "")[:80])
        assert row["decoded"] == (library.decode(expected) if expected else "")


def test_compare_finds_no_difference_in_whole_tables(spark):
    assert pieces.compare(spark.read.parquet(f"{FOLDER}/documents.parquet"), PATH).count() == 0


def test_compare_shows_a_difference(spark, monkeypatch):
    # The vocabulary is made here and sent to the tasks: one that takes the least score first.
    real = pieces.Vocabulary._pairs

    def wrong(vocab, *args):
        real(vocab, *args)
        vocab.place = vocab.place.max() - vocab.place

    monkeypatch.setattr(pieces.Vocabulary, "_pairs", wrong)
    docs = spark.createDataFrame([(1, "international transformation")], "doc_id long, text string")
    assert pieces.compare(docs, PATH).count() == 1


def test_decode_any_ids(spark, library):
    rng = random.Random(3)
    rows = [(i, [rng.choice([0, 1, 2, 3 + rng.randrange(256), rng.randrange(32000), 28705, 259, 260]) for _ in range(rng.randint(1, 12))]) for i in range(2000)]
    out = {r["doc_id"]: r["decoded"] for r in pieces.decode(spark.createDataFrame([*rows, (-1, []), (-2, None)], "doc_id long, ids array<int>"), PATH).collect()}
    assert out.pop(-1) == out.pop(-2) == ""
    assert out == {i: library.decode(ids) for i, ids in rows}


def test_no_rows_and_clashing_names(spark):
    assert pieces.encode(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
    row = pieces.encode(spark.createDataFrame([(1, "x y", "mine", 7)], "doc_id long, text string, symbols string, _chunk int"), PATH).first()
    assert (row["symbols"], row["_chunk"], row["text"]) == ("mine", 7, "x y")


def test_heap_and_side_by_side_agendas_agree(library):
    vocab = pieces.Vocabulary(PATH)
    rng = random.Random(4)
    words = ["▁" + "".join(rng.choice("aeinstrh") for _ in range(rng.randint(1, 60))) for _ in range(300)] + ["a" * n for n in range(1, 40)]
    symbols = [vocab.char_of[[ord(c) for c in w]].astype(np.int64) for w in words]
    values, counts = pieces.merge_short(np.concatenate(symbols), np.array([len(s) for s in symbols]), vocab)
    ends = np.cumsum(counts)
    for own, end, n in zip(symbols, ends, counts, strict=True):
        assert pieces.merge_long(own.tolist(), vocab) == values[end - n : end].tolist()


def test_forgetting_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(pieces, "KNOWN_SEGMENTS", 3)
    encoder = pieces.Encoder(pieces.Vocabulary(PATH))
    for text in ["one two three four five six seven", "two three eight", "one nine ten two"]:
        values, counts = encoder.encode([text, None, text])
        expected = library.encode(text)
        assert values.tolist() == expected * 2 and counts.tolist() == [len(expected), 0, len(expected)]


def test_a_vocabulary_without_bytes_gives_one_unknown_for_a_run():
    vocab = pieces.Vocabulary(PATH)
    vocab.fallback = False
    values, counts = pieces.Encoder(vocab).encode(["a日\x01\x02b"])
    assert (values == vocab.unknown).sum() == 1 and counts[0] == len(values)


def test_ids_are_decoded_in_parts():
    lists = pa.array([[1] * 3, None, [2] * 4, [], [3] * 9, [4]], pa.list_(pa.int32()))
    parts = list(pieces._parts(lists, pc.list_value_length, 7))
    assert [x for p in parts for x in p.to_pylist()] == lists.to_pylist()
    assert [sum(map(len, filter(None, p.to_pylist()))) for p in parts] == [7, 9, 1]
