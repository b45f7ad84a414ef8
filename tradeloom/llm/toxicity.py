"""Toxicity scores: the weighted mean of a text's subword embeddings, through a linear softmax.

Each word stands for the hash buckets of itself and of its character n-grams (with marks for its begin
and end), so a misspelling that was never seen shares most of its vectors with the word it bends. The
embeddings and the softmax are trained together, in numpy, on at most ``LABELLED_ROWS`` labelled
documents, picked by a hash of their id: the only part that does not grow with the data. A training
document comes to the one task that trains as at most ``BUCKETS`` counts, and the driver gets the model
alone, two numbers a bucket. Only the text is an input of the score.

All texts are then scored in the tasks, against two numbers for each bucket, its weight and its vector's
projection: the projection of a mean of vectors is the mean of their projections.

Null and empty texts have no subwords; their score is that of the softmax's bias. Labels of unknown
documents, null labels and null ids train nothing; a document that is labelled both ways counts as
toxic. With fewer than two classes among the labels, every score is their share of toxic ones (one half
without labels). Repeated rows are scored one by one. Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunks import small_batches
from .textcols import ALNUM, Block, Hasher, blocks, mix

BUCKETS = 1 << 17
LABELLED_ROWS = 6000
SIZES = (3, 4, 5)
DIMENSIONS = 8
EPOCHS = 10
LEAST_STEPS = 20_000  # documents seen in training; few labelled ones are gone through more often
BATCH = 32
RATE = 2.0
SOFTMAX_RATE = 0.005
SPREAD = 10.0
MIN_TEXTS = 5
#: Texts, and bytes of them, whose words a task takes apart at a time.
ROWS, BLOCK_BYTES = 256, 1 << 19
HASHER = Hasher(6)


def held_out(doc_id: Column) -> Column:
    """A fifth of the documents, by the CRC-32 of the id's text; their labels are never trained on."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0


def _subwords(words: list[str], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of each subword of distinct words."""
    letters = np.frombuffer("".join(f"<{w}>\n" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    stop = letters == 10
    word = np.cumsum(stop) - stop
    owners, buckets = [np.arange(len(words))], [hashes]
    for n in SIZES:
        count = max(0, len(letters) - n + 1)
        gram = np.full(count, n, np.uint64)
        for k in range(n):
            gram = gram * np.uint64(0x100000001B3) + letters[k : k + count]
        # A window ends inside the word it begins in; the line end belongs to none.
        inside = (word[:count] == word[n - 1 : n - 1 + count]) & ~stop[n - 1 : n - 1 + count]
        owners.append(word[:count][inside])
        buckets.append(mix(gram[inside]))
    return np.concatenate(owners), (np.concatenate(buckets) % np.uint64(BUCKETS)).astype(np.int64)


def _features(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: each word's row, each word's number among the distinct ones, and the subwords of those."""
    words = block.words(ALNUM)
    hashes = words.hashes(HASHER)
    distinct, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    texts = [words.data[s:e].tobytes().decode() for s, e in zip(words.starts[first], words.ends[first], strict=True)]
    owners, buckets = _subwords(texts, distinct)
    return words.rows, number, owners, buckets


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Block]]:
    """Few rows at a time, with the block of their lower-cased texts."""
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS):
            some = batch.slice(low, ROWS)
            for block in blocks(pc.utf8_lower(some.column("text")), BLOCK_BYTES):
                yield some.slice(block.first, len(block)), block


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket counts of each text."""
    for own, block in _parts(batches):
        rows, number, owners, buckets = _features(block)
        order = np.argsort(owners, kind="stable")
        begins = np.searchsorted(owners[order], np.arange(number.max(initial=-1) + 2))
        out = []
        for row in range(len(block)):
            words = number[np.searchsorted(rows, row) : np.searchsorted(rows, row, "right")]
            kinds, times = np.unique(words, return_counts=True)
            lengths = begins[kinds + 1] - begins[kinds]
            at = np.repeat(begins[kinds] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
            total = np.bincount(buckets[order][at], weights=np.repeat(times, lengths), minlength=1)
            used = np.flatnonzero(total)
            out.append((used, total[used]))
        yield pa.RecordBatch.from_arrays([own.column("toxic"), pa.array([x[0] for x in out], pa.list_(pa.int32())), pa.array([x[1] for x in out], pa.list_(pa.float32()))], ["toxic", "buckets", "counts"])


@dataclass
class Model:
    """Log-odds of label 1: bias + the mean of ``projected`` over a text's subwords, weighted by ``weight``."""

    weight: np.ndarray
    projected: np.ndarray
    bias: float


def _rarity(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The weight of each bucket in a mean (squared log of its rarity), and in how many texts it is."""
    texts = np.zeros(BUCKETS)
    for _, buckets, _ in rows:
        texts[buckets] += 1
    return np.log((len(rows) + 1) / (texts + 1)) ** 2 + 1e-6, texts


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 6) -> Model:
    """Embeddings and softmax by gradient steps on the cross-entropy of small batches.

    Rows are (label, buckets, counts). Means are weighted by rarity, as words such as articles
    would otherwise drown the few that matter; a bucket in fewer than ``MIN_TEXTS`` texts keeps a zero
    vector, as an unseen one has.
    """
    labels = np.array([r[0] for r in rows], np.int64)
    weight, texts = _rarity(rows)
    share = float(labels.mean()) if len(labels) else 0.5
    if len(set(labels.tolist())) < 2:
        odds = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return Model(weight, np.zeros(BUCKETS), float(odds))
    used = texts >= MIN_TEXTS
    # What goes into a mean is worked out batch by batch: the rows are the only thing as large as the training set.
    lengths = np.array([len(r[1]) for r in rows])
    sums = np.array([max((counts * weight[buckets]).sum(), 1e-9) for _, buckets, counts in rows])
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-0.01, 0.01, (BUCKETS, DIMENSIONS)).astype(np.float32)
    vectors[~used] = 0
    sign = rng.choice([-1.0, 1.0], DIMENSIONS)[:, None]
    softmax = (SPREAD * (sign * np.array([[-1.0, 1.0]]) + rng.uniform(-0.1, 0.1, (DIMENSIONS, 2)))).astype(np.float32)
    bias = np.log(np.array([1 - share, share], np.float32))
    epochs = max(EPOCHS, LEAST_STEPS // len(rows))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // BATCH)):
            buckets = np.concatenate([rows[i][1] for i in part])
            keep = used[buckets]
            owner = np.repeat(np.arange(len(part)), lengths[part])[keep]
            buckets, counts = buckets[keep], np.concatenate([rows[i][2] for i in part])[keep]
            known, at = np.unique(buckets, return_inverse=True)
            table = np.zeros((len(part), len(known)), np.float32)
            table[owner, at] = counts * weight[buckets] / sums[part][owner]
            means = table @ vectors[known]
            logits = means @ softmax + bias
            odds = np.exp(logits - logits.max(1, keepdims=True))
            wrong = odds / odds.sum(1, keepdims=True)
            wrong[np.arange(len(part)), labels[part]] -= 1
            to_softmax = means.T @ wrong
            vectors[known] -= rate * (table.T @ (wrong @ softmax.T))
            softmax -= np.clip(SOFTMAX_RATE * rate * to_softmax, -0.1, 0.1)
            bias -= SOFTMAX_RATE * rate * wrong.sum(0)
    return Model(weight, vectors @ (softmax[:, 1] - softmax[:, 0]).astype(float), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS) -> Model:
    """A model from the labels outside the held-out fifth."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled_rows)
    # At most labelled_rows ids and labels: a bounded broadcast.
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "toxic", F.coalesce("text", F.lit("")).alias("text"))
    counted = texts.mapInArrow(_counts, "toxic int, buckets array<int>, counts array<float>")
    # In the order of the documents, whatever the order in which they arrive: the model depends on it.
    dealt = counted.withColumn("at", F.monotonically_increasing_id()).repartition(1).sortWithinPartitions("at")
    with small_batches(docs.sparkSession, ROWS):
        found = dealt.mapInArrow(_fitted, "weight array<double>, projected array<double>, bias double").toArrow()
    if not len(found):
        return fit([])
    weight, projected = (found.column(name)[0].values.to_numpy() for name in ("weight", "projected"))
    return Model(weight, projected, found.column("bias")[0].as_py())


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of all rows, in one row."""
    every = list(batches)
    if not every:
        return
    rows = _local(pa.Table.from_batches(every))
    # The Arrow batches go before the fit begins, and what they took is given back.
    every.clear()
    pa.default_memory_pool().release_unused()
    model = fit(rows)
    numbers = [pa.array([x], pa.list_(pa.float64())) for x in (model.weight, model.projected)]
    yield pa.RecordBatch.from_arrays([*numbers, pa.array([model.bias])], ["weight", "projected", "bias"])


def _local(table: pa.Table) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Rows as parts of two arrays, copied chunk by chunk."""
    ends = np.cumsum([0, *pc.list_value_length(table.column("buckets")).to_pylist()]).tolist()
    both = np.empty(ends[-1], np.int32), np.empty(ends[-1], np.float32)
    for name, flat in zip(("buckets", "counts"), both, strict=True):
        low = 0
        for chunk in table.column(name).chunks:
            values = chunk.flatten().to_numpy(zero_copy_only=False)
            flat[low : low + len(values)] = values
            low += len(values)
    labels = table.column("toxic").to_pylist()
    return [(int(t == 1), both[0][low:high], both[1][low:high]) for t, low, high in zip(labels, ends[:-1], ends[1:], strict=True)]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Each row with ``score``, the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.drop("score")
    schema = T.StructType([*base.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for own, block in _parts(batches):
            rows, number, owners, buckets = _features(block)
            kinds = number.max(initial=-1) + 1
            sizes = np.bincount(owners, model.weight[buckets], kinds)
            sums = np.bincount(owners, (model.weight * model.projected)[buckets], kinds)
            total = np.bincount(rows, sums[number], len(block))
            count = np.bincount(rows, sizes[number], len(block))
            scores = 1 / (1 + np.exp(-np.clip(model.bias + total / np.maximum(count, 1e-9), -50, 50)))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(scores, pa.float64())], [*own.schema.names, "score"])

    return base.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with a score below one half, as they are."""
    return score(docs, train(docs, labels)).where("score < 0.5").select(docs.columns)
