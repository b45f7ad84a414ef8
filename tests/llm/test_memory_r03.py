"""What the executors and the driver hold at a time."""

import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from tradeloom.llm import bpe, decontamination, jaccard, lm_scores, pii, textcols, toxicity
from tradeloom.llm.chunks import BATCH
from tradeloom.llm.packing import planes, unplanes


@pytest.fixture
def written(monkeypatch):
    """The frames that were written, as (characters of the plan, rows in a batch to a worker)."""
    seen, parquet = [], DataFrameWriter.parquet

    def record(self, *args, **more):
        seen.append((len(self._df._jdf.queryExecution().toString()), self._df.sparkSession.conf.get(BATCH)))
        return parquet(self, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", record)
    return seen


def said(chunks):
    """Rows as chunks say them: sorted hashes as differences, and their counts."""
    keys = [planes(np.diff(k, prepend=np.uint64(0))) for k, _ in chunks]
    counts = [planes(c) for _, c in chunks]
    number = pa.array(range(len(chunks)), pa.int32())
    return pa.table([pa.array([3] * len(chunks), pa.int32()), number, pa.array(keys, pa.binary()), pa.array(counts, pa.binary()), pa.array([7] * len(chunks), pa.int64())], ["_range", "_chunk", "keys", "counts", "words"])


def test_a_range_is_summed_slice_by_slice():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 400_000).astype(np.uint64) * np.uint64(2)
    chunks = [(np.unique(rng.choice(pool, 30_000)), None) for _ in range(40)]
    chunks = [(k, rng.integers(1, 9, len(k)).astype(np.uint32)) for k, _ in chunks]
    table, entries = said(chunks), sum(len(k) for k, _ in chunks)
    tracemalloc.start()
    out = lm_scores._sum((pa.scalar(3),), table)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    every = Counter()
    for k, c in chunks:
        every.update(dict(zip(k.tolist(), c.tolist(), strict=True)))
    for (k, _), totals in zip(chunks, out.column("totals"), strict=True):
        assert unplanes(totals.as_py(), np.int64).tolist() == [every[x] for x in k.tolist()]
    assert out.select(["_chunk", "_range", "words"]).equals(table.select(["_chunk", "_range", "words"]))
    assert most < 32 * entries


@pytest.mark.parametrize("hashes", [[], [0], [5], [2**64 - 1], [0, 2**64 - 1], [2**63, 2**63 + 1]])
def test_slices_lose_no_hash(hashes):
    chunks = [(np.array(hashes, np.uint64), np.full(len(hashes), 2, np.uint32)), (np.array(hashes[:1], np.uint64), np.full(len(hashes[:1]), 3, np.uint32))]
    out = [unplanes(x.as_py(), np.int64).tolist() for x in lm_scores._sum((pa.scalar(3),), said(chunks)).column("totals")]
    assert out == [[5, *[2] * (len(hashes) - 1)], [5]] if hashes else out == [[], []]


def test_a_hasher_holds_what_its_texts_need():
    hasher = textcols.Hasher(4)
    hasher.prefix(np.zeros(1000, np.uint8))
    assert len(hasher.powers) == len(hasher.backs) == 1024


def test_near_copies_pass_small_batches(spark, written):
    before = spark.conf.get(BATCH)
    docs = spark.createDataFrame([(i, f"some words that {i % 3} rows have") for i in range(9)], "doc_id long, text string")
    assert jaccard.keep_first(docs).count() == 3
    assert written and {rows for _, rows in written} == {str(jaccard.BATCH_ROWS)}
    assert spark.conf.get(BATCH) == before


def test_personal_data_has_no_large_constant_in_its_plans(spark, written):
    docs = spark.createDataFrame([(i, f"Zebulon {'wrote' if i % 2 else 'called'} {i} zeb@example.com") for i in range(8)] + [(i, "nothing") for i in range(8, 99)], "doc_id long, text string")
    found = {r["doc_id"]: [s["kind"] for s in r["personal"]] for r in pii.find_personal_data(docs).collect()}
    assert "remove" in found[0] and found[50] == []
    assert max(size for size, _ in written) < 1_000_000


def test_toxicity_takes_few_texts_apart_at_a_time():
    texts = [f"word{i} other{i % 7}" for i in range(3000)] + [None, "", "Ünï Ⱥ " * 30_000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    parts = list(toxicity._parts(iter([batch])))
    assert [i for own, _ in parts for i in own.column("doc_id").to_pylist()] == list(range(len(texts)))
    assert max(own.num_rows for own, _ in parts) <= toxicity.ROWS
    assert [block.data[a:b].tobytes().decode() for _, block in parts for a, b in zip(block.bounds[:-1], block.bounds[1:], strict=True)] == [(t or "").lower() for t in texts]


def test_the_driver_gets_the_model_and_no_training_documents(spark, monkeypatch):
    texts = [f"{'vile' if i % 3 == 0 else 'kind'} words of text {i} {'and more ' * (i % 5)}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7, "doc_id").sortWithinPartitions("doc_id")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    seen, to_arrow = [], type(docs).toArrow
    monkeypatch.setattr(type(docs), "toArrow", lambda self: seen.append(to_arrow(self)) or seen[-1])
    model = toxicity.train(docs, labels)
    assert sum(len(x) for x in seen) == 1
    # It is the model of the documents in their order.
    order = [(r["doc_id"], r["text"]) for r in docs.where(~toxicity.held_out(docs.doc_id)).collect()]
    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in order]), pa.array([int(i % 3 == 0) for i, _ in order], pa.int32())], ["text", "toxic"])
    plain = toxicity.fit(toxicity._local(pa.Table.from_batches(list(toxicity._counts(iter([batch]))))))
    assert np.array_equal(model.weight, plain.weight)
    assert np.allclose(model.projected, plain.projected, atol=1e-4) and model.bias == pytest.approx(plain.bias, abs=1e-4)


def test_packed_numbers_take_the_bytes_they_need():
    assert len(planes(np.ones(1000, np.int64))) <= 1001
    for kind in (np.uint16, np.uint32, np.uint64, np.int64):
        for values in ([], [0], [255, 1], [256, 0, 3], [np.iinfo(kind).max, 0], [np.iinfo(kind).min, 1]):
            assert unplanes(planes(np.array(values, kind)), kind).tolist() == values


def test_each_task_scores_as_many_chunks(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = spark.createDataFrame([(i, f"word{i % 9} and word{i}") for i in range(600)], "doc_id long, text string")
    dealt = lm_scores.chunked(lm_scores.score(docs), "doc_id", lm_scores.CHUNKS_PER_PARTITION)
    found = dealt.select(F.spark_partition_id().alias("task"), "_chunk").distinct().groupBy("task").count().collect()
    assert [r["count"] for r in found] == [lm_scores.CHUNKS_PER_PARTITION] * parts


def test_tokens_are_decoded_in_parts(spark):
    lists = pa.array([[1] * 3, None, [], [2] * 500, [3]], pa.list_(pa.int32()))
    assert [x.to_pylist() for x in bpe._slices(lists, 4)] == [[[1] * 3, None, []], [[2] * 500], [[3]]]
    texts = [None, "", *(f"Some text {i}, ünï " * (1 + i % 4) for i in range(300)), "long " * 300_000, "end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    path = public_tokenizers.path("byte_bpe_50k.json")
    found = bpe.decode(bpe.encode(docs, path), path).collect()
    assert {r["doc_id"]: r["decoded"] for r in found} == {i: t or "" for i, t in enumerate(texts)}


def test_decontamination_takes_small_blocks(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(decontamination, "blocks", lambda column, limit=textcols.BLOCK_BYTES: taken.append(limit) or textcols.blocks(column, limit))
    batch = pa.RecordBatch.from_arrays([pa.array(["b"]), pa.array(["some words " * 20])], ["item", "text"])
    assert sum(x.num_rows for x in decontamination._windows_of_items(13)(iter([batch]))) > 0
    assert taken and max(taken) <= 1 << 19
