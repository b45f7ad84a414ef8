"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned over all training texts.

Windows of ``n`` words of the benchmark items (a shorter item is one window) are collected, as long as
there are at most ``WINDOWS_PER_PASS`` of them, into one broadcast table of sorted hashes. Each task
hashes the windows of its texts and looks them up; a hit counts after its words have been compared. A
benchmark with more windows is scanned in several passes over the documents, each with a part of the
hash range, and what the passes hit is put together by document.

Null and empty texts have no words and hit nothing; null and wordless benchmark items have no window.
Windows of an item with a null id count as hit, but add no name to ``items``. Repeated document rows are
judged one by one, and repeated items count once in ``items``. Other columns
of the documents are kept; the columns added here replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textcols import ALNUM, Block, Hasher, Words, blocks, covered

N = 13
#: Most windows in one broadcast: about 100 bytes each, so some 200 MB. More are scanned in passes.
WINDOWS_PER_PASS = 2_000_000

ADDED = "n_words long, n_hit long, items array<string>, hits array<struct<start:long,end:long>>"
#: Bytes of texts whose windows a task takes at a time.
BLOCK_BYTES = 1 << 19
HASHER = Hasher(10)


def _windows_of_items(n: int):
    """(item_id, text) -> one row for each window of an item: hash, number of words, words, item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item").to_pylist()
            for block in blocks(batch.column("text"), BLOCK_BYTES):
                words = block.words(ALNUM, lower=True)
                hashes = words.hashes(HASHER)
                out = {"hash": [], "size": [], "words": [], "item": []}
                for row in range(len(block)):
                    low, high = int(words.first[row]), int(words.first[row + 1])
                    size = min(n, high - low)
                    if size:
                        got = HASHER.windows(hashes[low:high], size).view(np.int64)
                        out["hash"] += got.tolist()
                        out["size"] += [size] * len(got)
                        out["words"] += [words.text(i, i + size) for i in range(low, high - size + 1)]
                        out["item"] += [ids[block.first + row]] * len(got)
                yield pa.RecordBatch.from_pydict(out, pa.schema([("hash", pa.int64()), ("size", pa.int32()), ("words", pa.binary()), ("item", pa.string())]))

    return run


def benchmark_windows(benchmark: DataFrame, n: int = N, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows of the benchmark with the items that have them."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    windows = items.mapInArrow(_windows_of_items(n), "hash long, size int, words binary, item string")
    return windows.groupBy("hash", "size", "words").agg(F.collect_set("item").alias("items"))


class _Lookup:
    """Sorted hashes of each window size; the words and items behind a hash."""

    def __init__(self, rows: list):
        self.known: dict[int, dict[bytes, list[str]]] = {}
        by_size: dict[int, list[int]] = {}
        for row in rows:
            by_size.setdefault(row["size"], []).append(row["hash"])
            self.known.setdefault(row["size"], {})[bytes(row["words"])] = row["items"]
        self.sorted = {size: np.unique(np.array(x, np.int64).view(np.uint64)) for size, x in by_size.items()}

    def hits(self, words: Words, hashes: np.ndarray) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, number of words, items) of each window that occurs."""
        for size, known in self.sorted.items():
            windows = HASHER.windows(hashes, size)
            at = np.minimum(np.searchsorted(known, windows), len(known) - 1)
            for i in np.flatnonzero((known[at] == windows) & words.within(size)).tolist():
                if (items := self.known[size].get(words.text(i, i + size))) is not None:
                    yield i, size, items


def _scan(block: Block, lookup: _Lookup) -> tuple[Words, np.ndarray, dict[int, set[str]]]:
    """The words of a block, which of them are hit, and the items that each row has."""
    words = block.words(ALNUM, lower=True)
    found = list(lookup.hits(words, words.hashes(HASHER)))
    items: dict[int, set[str]] = {}
    for i, _, names in found:
        items.setdefault(int(words.rows[i]), set()).update(names)
    starts, sizes = (np.array([x[k] for x in found], np.int64) for k in (0, 1))
    return words, covered(starts, sizes, len(words)), items


def find_contamination(docs: DataFrame, benchmark: DataFrame, n: int = N, text_col: str = "text", id_col: str = "item_id", windows_per_pass: int = WINDOWS_PER_PASS) -> DataFrame:
    """Each document with ``n_words``, ``n_hit``, ``items`` (sorted ids of the items with occurring windows)
    and ``hits``: the runs of hit words as byte ranges of the UTF-8 text, from a run's first word to its last.
    """
    spark = docs.sparkSession
    base = docs.drop(*(x.split()[0] for x in ADDED.split(", ")))
    windows = benchmark_windows(benchmark, n, id_col)
    total = windows.count()
    passes = max(1, -(-total // windows_per_pass))
    if passes == 1:
        return _one_pass(spark, base, windows, text_col)
    # More windows than one broadcast may hold: passes, told apart by hash, then one row per document again.
    marked = base.withColumn("_row", F.monotonically_increasing_id())
    marked = marked.withColumn("_row", F.struct("_row", F.xxhash64(text_col)))
    parts = None
    for k in range(passes):
        part = _one_pass(spark, marked, windows.where(F.pmod("hash", F.lit(passes)) == k), text_col)
        parts = part if parts is None else parts.unionByName(part)
    firsts = [F.first(c).alias(c) for c in base.columns]
    merged = parts.groupBy("_row").agg(*firsts, F.first("n_words").alias("n_words"), F.flatten(F.collect_list("items")).alias("items"), F.flatten(F.collect_list("hits")).alias("hits"))
    return _recount(merged.drop("_row"), base.columns, text_col)


def _one_pass(spark: SparkSession, docs: DataFrame, windows: DataFrame, text_col: str) -> DataFrame:
    shared = spark.sparkContext.broadcast(windows.collect())
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(ADDED).fields])
    return docs.mapInArrow(_scanner(shared, text_col), schema)


def _scanner(shared, text_col: str):
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(shared.value)
        for batch in batches:
            for block in blocks(batch.column(text_col), BLOCK_BYTES):
                words, hit, items = _scan(block, lookup)
                sums = np.r_[0, np.cumsum(hit)]
                n_hit = sums[words.first[1:]] - sums[words.first[:-1]]
                hits = [_runs(block, words, hit, row) if n_hit[row] else [] for row in range(len(block))]
                names = [sorted(items.get(row, ())) for row in range(len(block))]
                own = batch.slice(block.first, len(block))
                more = [pa.array(np.diff(words.first), pa.int64()), pa.array(n_hit, pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(hits, span)]
                yield pa.RecordBatch.from_arrays([*own.columns, *more], [*own.schema.names, "n_words", "n_hit", "items", "hits"])

    return run


def _runs(block: Block, words: Words, hit: np.ndarray, row: int) -> list[dict[str, int]]:
    low, high = words.first[row], words.first[row + 1]
    edge = np.flatnonzero(np.diff(np.r_[False, hit[low:high], False].astype(np.int8)))
    shift = block.bounds[row]
    return [{"start": int(words.starts[low + a] - shift), "end": int(words.ends[low + b - 1] - shift)} for a, b in edge.reshape(-1, 2)]


def _recount(merged: DataFrame, columns: list[str], text_col: str) -> DataFrame:
    """After several passes: the union of the hit ranges, and the words inside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("hits").to_pylist()
            for block in blocks(batch.column(text_col), BLOCK_BYTES):
                words = block.words(ALNUM, lower=True)
                ranges = [(block.bounds[r] + x["start"], block.bounds[r] + x["end"]) for r in range(len(block)) for x in found[block.first + r]]
                low, high = (np.searchsorted(words.starts, np.array([x[k] for x in ranges], np.int64)) for k in (0, 1))
                hit = covered(low, high - low, len(words))
                sums = np.r_[0, np.cumsum(hit)]
                own = batch.slice(block.first, len(block))
                put = {
                    "n_hit": pa.array(sums[words.first[1:]] - sums[words.first[:-1]], pa.int64()),
                    "items": pa.array([sorted(set(x)) for x in own.column("items").to_pylist()], pa.list_(pa.string())),
                    "hits": pa.array([_runs(block, words, hit, r) for r in range(len(block))], own.schema.field("hits").type),
                }
                yield pa.RecordBatch.from_arrays([put.get(name, own.column(name) if name in own.schema.names else None) for name in [*columns, "n_words", "n_hit", "items", "hits"]], [*columns, "n_words", "n_hit", "items", "hits"])

    schema = T.StructType([*(merged.schema[c] for c in columns), *T.StructType.fromDDL(ADDED).fields])
    return merged.mapInArrow(run, schema)


def is_contaminated():
    """At least a twentieth of a document's words is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, as they are."""
    found = find_contamination(docs, benchmark, **options)
    return found.where(~is_contaminated()).select(docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """All documents, without the bytes of their hit runs."""
    found = find_contamination(docs, benchmark, text_col=text_col, **options)
    schema = found.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            for i, spans in enumerate(batch.column("hits").to_pylist()):
                if spans:
                    raw, keep, at = texts[i].encode(), [], 0
                    for x in spans:
                        keep.append(raw[at : x["start"]])
                        at = x["end"]
                    texts[i] = b"".join([*keep, raw[at:]]).decode()
            yield batch.set_column(batch.schema.get_field_index(text_col), text_col, pa.array(texts, pa.string()))

    return found.mapInArrow(run, schema).select(docs.columns)
