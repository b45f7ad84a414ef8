"""Stupid-backoff scores of documents against all the other documents of the corpus.

The score of a word after the two before it is the count of the three over the count of the two; if the
three occur in no other document, ``ALPHA`` times the score after one word, and so on down to the word's
share of all words, and for a word that no other document has, 1 / (words + 1). A document's own
occurrences are taken off every count, or each of its n-grams would be known.

Counts are relational tables, dealt by hash: each chunk of documents says its n-grams with their counts,
the chunks' rows of one hash range are summed, and each chunk gets the totals of what it said back, to
join them to the n-grams of its documents and sum the logarithms. An n-gram is one entry for each chunk,
however common it is. Since entries are many and small, the rows of a chunk and hash range travel as one
row of sorted 64-bit hashes; totals come back in the same order. Of words and pairs all are counted, of
triples only those whose pairs other documents have, as no other can be known there.

Words lie between white space, with A-Z lower-cased. Null and wordless texts have no words and score 0.
Repeated rows are documents of their own: what a copy says counts. Other columns are kept; the columns
added here replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.session import work_dir

from .chunks import chunked, grouped, short_lived_shuffles, small_batches
from .packing import edges, planes, unplanes
from .textcols import NOT_SPACE, Block, Hasher, blocks

ALPHA = 0.4
CHUNKS_PER_PARTITION = 4
SLICES = 16
BLOCK_BYTES = 1 << 19
#: Rows of packed hashes, or documents, that go to or come from a Python worker at a time.
BATCH_ROWS = 32
HASHER = Hasher(2)
SAID = "_range int, _chunk int, keys binary, counts binary, words long"
TOLD = "_chunk int, _range int, totals binary, words long"


class _Ngrams:
    """Words, pairs and triples of a block by hash, with the rows they are in."""

    def __init__(self, block: Block, most: int):
        words = block.words(NOT_SPACE, lower=True)
        hashes = words.hashes(HASHER)
        self.first, self.rows = block.first, words.rows
        self.counts = np.diff(words.first)
        self.inside = {n: words.within(n) for n in range(1, most + 1)}
        self.hash = {n: HASHER.windows(hashes, n) for n in range(1, most + 1)}


def _say(chunk: int, ranges: int, keys: list[np.ndarray], words: int = 0) -> pa.Table:
    """The distinct hashes of a chunk with their counts, a row for each range of hashes; the first has its words."""
    found, counts = np.unique(np.concatenate(keys) if keys else np.empty(0, np.uint64), return_counts=True)
    edge = edges(found, ranges)
    out: dict[str, list] = {"_range": [], "_chunk": [], "keys": [], "counts": []}
    for i in range(ranges):
        low, high = edge[i], edge[i + 1]
        if low < high:
            out["_range"].append(i)
            out["_chunk"].append(chunk)
            out["keys"].append(planes(np.diff(found[low:high], prepend=np.uint64(0))))
            out["counts"].append(planes(counts[low:high].astype(np.uint32)))
    out["words"] = [words, *[0] * (len(out["keys"]) - 1)] if out["keys"] else []
    return pa.table([pa.array(out["_range"], pa.int32()), pa.array(out["_chunk"], pa.int32()), pa.array(out["keys"], pa.binary()), pa.array(out["counts"], pa.binary()), pa.array(out["words"], pa.int64())], ["_range", "_chunk", "keys", "counts", "words"])


def _sum(key: tuple, table: pa.Table) -> pa.Table:
    """The totals of one range of hashes, for each chunk in the order of its own hashes.

    Each chunk's hashes are sorted, so the range is summed slice by slice: only a slice of all chunks is sorted at a time.
    """
    keys = [np.cumsum(unplanes(x.as_py(), np.uint64), dtype=np.uint64) for x in table.column("keys")]
    counts = [unplanes(x.as_py(), np.uint32) for x in table.column("counts")]
    table = table.select(["_chunk", "_range", "words"])
    totals = [np.empty(len(k), np.int64) for k in keys]
    for cuts in _slices(keys):
        order, sums = _sums_of_equal(*(np.concatenate([x[a:b] for x, (a, b) in zip(side, cuts, strict=True)]) for side in (keys, counts)))
        every = np.empty(len(order), np.int64)
        every[order] = sums
        begin = 0
        for x, (a, b) in zip(totals, cuts, strict=True):
            x[a:b] = every[begin : begin + b - a]
            begin += b - a
    del keys, counts
    # In small batches, so that neither side holds all of them a second time.
    out = []
    for low in range(0, len(totals), BATCH_ROWS):
        out.append(pa.array([planes(x) for x in totals[low : low + BATCH_ROWS]], pa.binary()))
        totals[low : low + BATCH_ROWS] = [None] * len(out[-1])
    return pa.table([table.column("_chunk"), table.column("_range"), pa.chunked_array(out, pa.binary()), table.column("words")], ["_chunk", "_range", "totals", "words"])


def _slices(keys: list[np.ndarray]) -> Iterator[list[tuple[int, int]]]:
    """Where each of ``SLICES`` equal parts of the hashes' span lies in each chunk's sorted hashes."""
    filled = [k for k in keys if len(k)]
    if not filled:
        return
    low, high = int(min(k[0] for k in filled)), int(max(k[-1] for k in filled))
    limits = np.array([low + (high - low) * i // SLICES for i in range(1, SLICES)], np.uint64)
    at = [np.r_[0, np.searchsorted(k, limits), len(k)].tolist() for k in keys]
    for i in range(SLICES):
        yield [(x[i], x[i + 1]) for x in at]


def _sums_of_equal(every: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts hashes, and, in that order, the sum of the counts of each one's equals."""
    order = np.argsort(every, kind="stable")
    if not len(order):
        return order, np.empty(0, np.int64)
    every = every[order]
    new = np.r_[True, every[1:] != every[:-1]]
    sums = np.add.reduceat(counts[order], np.flatnonzero(new), dtype=np.int64)
    return order, sums[np.cumsum(new, dtype=np.int32) - 1]


def _totals(told: pa.Table) -> np.ndarray:
    """What a chunk was told, in the order of its hashes."""
    order = np.argsort(told.column("_range").to_numpy())
    parts = told.column("totals").take(pa.array(order))
    return np.concatenate([unplanes(x.as_py(), np.int64) for x in parts]) if len(parts) else np.empty(0, np.int64)


def _grams(table: pa.Table, text_col: str, most: int = 3) -> list[_Ngrams]:
    return [_Ngrams(block, most) for block in blocks(table.column(text_col), BLOCK_BYTES)]


class _Elsewhere:
    """Counts in other documents of the n-grams of a chunk: its totals, without the row's own occurrences."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]], told: pa.Table):
        hashes, rows = (np.concatenate([p[i] for p in parts]) if parts else np.empty(0, t) for i, t in enumerate((np.uint64, np.int32)))
        totals = _totals(told)
        # The sort is stable and rows ascend, so those of a row lie together among equal hashes.
        order = np.argsort(hashes, kind="stable")
        hashes, rows = hashes[order], rows[order]
        other = hashes[1:] != hashes[:-1]
        one = np.zeros(min(1, len(hashes)), bool)
        key = np.cumsum(np.r_[one, other], dtype=np.int32)
        own = np.cumsum(np.r_[one, other | (rows[1:] != rows[:-1])], dtype=np.int32)
        del hashes, rows, other
        assert len(totals) == (key[-1] + 1 if len(key) else 0)
        counts = np.empty(len(order), np.int64)
        counts[order] = totals[key] - np.bincount(own)[own] if len(own) else 0
        self.parts = np.split(counts, np.cumsum([len(p[0]) for p in parts])[:-1]) if parts else []


def _parts(grams: list[_Ngrams], n: int, use: list[np.ndarray] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, rows) of the n-grams of each block that lie in a row, or of the chosen ones."""
    chosen = use or [g.inside[n] for g in grams]
    return [(g.hash[n][u], (g.first + g.rows[: len(u)][u]).astype(np.int32)) for g, u in zip(grams, chosen, strict=True)]


def _short(grams: list[_Ngrams]) -> list[np.ndarray]:
    return [h for n in (1, 2) for h, _ in _parts(grams, n)]


def _words_and_pairs(grams: list[_Ngrams], told: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Of each block: counts elsewhere of its words, of its pairs, and which triples have two known pairs."""
    found = _Elsewhere([*_parts(grams, 1), *_parts(grams, 2)], told).parts
    words, pairs, triples = found[: len(grams)], [], []
    for gram, known in zip(grams, found[len(grams) :], strict=True):
        every = np.zeros(len(gram.hash[2]), np.int64)
        every[gram.inside[2]] = known
        pairs.append(every)
        triples.append(gram.inside[3] & (every[:-1] > 0) & (every[1:] > 0) if len(every) > 1 else np.zeros(len(gram.hash[3]), bool))
    return words, pairs, triples


def _say_short(ranges: int, text_col: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        grams = _grams(table, text_col, 2)
        return _say(key[0].as_py(), ranges, _short(grams), sum(len(g.rows) for g in grams))

    return run


def _say_triples(ranges: int, text_col: str):
    def run(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        grams = _grams(table, text_col)
        if not grams:
            return _say(0, ranges, [])
        use = _words_and_pairs(grams, told)[2]
        return _say(key[0].as_py(), ranges, [h for h, _ in _parts(grams, 3, use)])

    return run


def _score(total_words: int, text_col: str, columns: list[str]):
    def run(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        grams = _grams(table, text_col)
        counts, scores = np.empty(0, np.int64), np.empty(0)
        if grams:
            triple = np.asarray(told.column("triples").to_numpy(zero_copy_only=False), bool)
            words, pairs, use = _words_and_pairs(grams, told.filter(pa.array(~triple)))
            third = _Elsewhere(_parts(grams, 3, use), told.filter(pa.array(triple))).parts
            counts = np.concatenate([g.counts for g in grams])
            scores = np.concatenate([_sums(*x, total_words) for x in zip(grams, words, pairs, use, third, strict=True)])
        mean = pa.array(scores / np.maximum(counts, 1), mask=counts == 0)
        return pa.table([*(table.column(c) for c in columns), pa.array(counts, pa.int64()), pa.array(scores), mean], [*columns, "n_words", "log_score", "mean_log_score"])

    return run


def _sums(gram: _Ngrams, words: np.ndarray, pairs: np.ndarray, use: np.ndarray, third: np.ndarray, total: int) -> np.ndarray:
    """The sum of the logarithms of each row's words."""
    size = len(gram.rows)
    if not size:
        return np.zeros(len(gram.counts))
    rest = (total - gram.counts)[gram.rows]
    # From the shortest history to the longest: what is known after more words replaces what backs off to fewer.
    log = np.where(words > 0, np.log(np.maximum(words, 1)) - np.log(np.maximum(rest, 1)), np.log(ALPHA) - np.log(rest + 1))
    for n, count, before in ((2, pairs, words), (3, np.zeros(len(use), np.int64), pairs)):
        if n == 3:
            count[use] = third
        last = np.flatnonzero(gram.inside[n])
        more, fewer = count[last], before[last]
        at = last + n - 1
        log[at] = np.where(more > 0, np.log(np.maximum(more, 1)) - np.log(np.maximum(fewer, 1)), np.log(ALPHA) + log[at])
    return np.bincount(gram.rows, log, len(gram.counts))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document with ``n_words``, ``log_score`` (natural) and ``mean_log_score``, which is null without words."""
    spark, path = docs.sparkSession, work_dir(docs.sparkSession, "lm-scores")
    base = docs.drop("n_words", "log_score", "mean_log_score")
    dealt = chunked(base, id_col, CHUNKS_PER_PARTITION)
    slim = dealt.select(text_col, "_chunk", id_col)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, parts * 2 // 3)
    with short_lived_shuffles(spark), small_batches(spark, BATCH_ROWS):
        said = grouped(slim, "_chunk", parts).applyInArrow(_say_short(ranges, text_col), SAID)
        grouped(said, "_range", ranges).applyInArrow(_sum, TOLD).write.parquet(f"{path}/short")
        short = spark.read.parquet(f"{path}/short")
        said = grouped(slim, "_chunk", parts).cogroup(grouped(short, "_chunk", parts)).applyInArrow(_say_triples(ranges, text_col), SAID)
        grouped(said, "_range", ranges).applyInArrow(_sum, TOLD).write.parquet(f"{path}/triples")
    triples = spark.read.parquet(f"{path}/triples")
    words = short.agg(F.sum("words").alias("n")).first()["n"] or 0
    told = short.withColumn("triples", F.lit(False)).unionByName(triples.withColumn("triples", F.lit(True)))
    schema = T.StructType([*base.schema.fields, *T.StructType.fromDDL("n_words long, log_score double, mean_log_score double").fields])
    return grouped(dealt, "_chunk", parts).cogroup(grouped(told, "_chunk", parts)).applyInArrow(_score(words, text_col, base.columns), schema)
