import random
import zlib

import pyarrow as pa
import pytest

from tradeloom.llm import toxicity

BAD, WORDS = ["scumbag", "idiotic", "moronic"], [a + b for a in "ba ko li mu te ra".split() for b in "ner sil tok vam dor".split()]


def corpus(n=600, seed=3):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words, toxic = rng.choices(WORDS, k=rng.randint(20, 60)), i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        docs.append((i, " ".join(words), "x", 9.5))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels = corpus()
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, score double")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), labels


def test_held_out_accuracy_and_misspellings(spark, trained):
    docs, labels, known = trained
    model = toxicity.train(docs, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    out = [(got[i], t) for i, t in known if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(out) > 80 and sum((s >= 0.5) == bool(t) for s, t in out) / len(out) > 0.95
    # Never seen as they are, but most of their n-grams were.
    rows = [(0, " ".join(WORDS) + " idiotics scumbagg moronicc"), (1, " ".join(WORDS) + " konerr litokk musill")]
    bent = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert bent[0] > 0.5 > bent[1]


def test_labels_of_the_held_out_fifth_are_not_used(spark, trained):
    docs, labels, _ = trained
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, turned)
    assert a.bias == b.bias and (a.projected == b.projected).all()


def test_edges(spark, trained):
    docs, labels, _ = trained
    model = toxicity.train(docs, labels)
    rows = [(1, None), (2, ""), (3, "!!! ---"), (None, "a"), (5, "moronic " * 20_000), (5, "moronic " * 20_000), (6, "é" * 30_000)]
    out = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert len(out) == 7 and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["text"] in (None, "", "!!! ---")}) == 1
    assert len({r["score"] for r in out if r["doc_id"] == 5}) == 1 and min(r["score"] for r in out if r["doc_id"] == 5) > 0.5


@pytest.mark.parametrize("rows, expected", [([], 0.5), ([(1, 0), (2, 0)], 0.0), ([(1, 1), (2, 1), (3, None), (None, 0)], 1.0)])
def test_without_two_classes(spark, trained, rows, expected):
    docs = trained[0]
    model = toxicity.train(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
    assert toxicity.score(docs.limit(3), model).first()["score"] == pytest.approx(expected, abs=1e-6)
    assert toxicity.score(docs.where("false"), model).count() == 0


def test_toxic_documents_go(spark, trained):
    docs, labels, known = trained
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    clean = {i for i, t in known if not t}
    assert len(ids & clean) > 0.97 * len(clean) and len(ids - clean) < 8


def test_training_rows_lie_in_two_arrays():
    table = pa.Table.from_batches([
        pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(b, pa.list_(pa.int32())), pa.array(c, pa.list_(pa.float32()))], ["toxic", "buckets", "counts"])
        for t, b, c in (([1, 0], [[3, 5], []], [[1.0, 2.0], []]), ([1], [[7]], [[4.0]]))
    ])
    rows = toxicity._local(table)
    assert [(t, b.tolist(), c.tolist()) for t, b, c in rows] == [(1, [3, 5], [1.0, 2.0]), (0, [], []), (1, [7], [4.0])]
    assert rows[0][1].base is rows[2][1].base is not None and rows[0][2].base is rows[2][2].base is not None
