"""Ranked lexical search: summed accumulators of short lists as one iterator among long lists.

The score of a document for an item sums, over the item's terms, weight * ((10**9 * tf) div (1000 * tf + 8 * m)),
where weight and m come from the whole corpus (see ``statistics`` and ``weights``). All of it is integers.

``search`` scans the documents twice. The first scan counts documents, terms, and the documents that hold
each term of the items. In the second, every task cuts its documents into segments of bounded size, inverts
each into posting lists of the items' terms, and evaluates all items over it:

* Term at a time: the shortest lists of an item, up to ``SHORT`` of the segment's documents in all, are summed
  into accumulators, sorted by document. From there on they are one iterator with a known greatest score.
* Document at a time: the long lists join that iterator in windows of documents. Lists that could not lift a
  document among the best even together are never iterated; they are sought (by binary search) for the
  documents that the other lists name, the greatest bound first, and a document is passed over as soon as
  what it has and the bounds of the lists to come stay below the tenth best score so far.

A task hands on its ten best documents of each item, and these meet in two groupings, so no group grows with
the documents. Pruning is exact: only scores strictly below the tenth best are passed over.

Items go to the tasks in a broadcast of at most ``PAIRS_PER_PASS`` (item, term) pairs; more items take more
passes over the documents. Null and empty texts have no terms. Documents with the same text or id are all
ranked; of equal scores the smaller id comes first, a null id last. Rows of ``items`` with one id are one
item with the terms of all of them (a null id is an item as well), and repeated terms count once. Document
ids are integers. An item without terms, or without a matching document, has no rows. Empty tables give no rows. Only the id and text
columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textcols import ALNUM, Hasher, Words, blocks

K = 10
#: Most (item, term) pairs in one broadcast: about 100 bytes each.
PAIRS_PER_PASS = 500_000
#: A segment ends after so many documents or postings.
SEGMENT_DOCUMENTS = 1 << 16
SEGMENT_POSTINGS = 1 << 21
#: Accumulators of an item cover at most this share of a segment's documents, but one list at least.
SHORT = 1 / 16
#: Long lists are joined in windows of so many documents; after each the tenth best score is known anew.
WINDOW = 1 << 13
#: Groups in which the best documents of all tasks meet before they meet by item.
SALTS = 64

FIRST, SECOND = Hasher(13), Hasher(1313)


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, text) -> one row for each word of the text: the item and the word's two hashes."""
    for batch in batches:
        for block in blocks(batch.column("text")):
            words = block.words(ALNUM, lower=True)
            item = batch.column("item").take(pa.array(block.first + words.rows))
            yield pa.RecordBatch.from_arrays([item, *(pa.array(words.hashes(h).view(np.int64)) for h in (FIRST, SECOND))], ["item", "a", "b"])


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, a, b): the distinct terms of each item as two 64-bit hashes. ``item`` is a struct of the id, so a null id is an item."""
    named = items.select(F.struct(F.col(id_col).alias("id")).alias("item"), F.col(text_col).alias("text"))
    schema = T.StructType([named.schema["item"], T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    return named.mapInArrow(_term_rows, schema).distinct()


class Terms:
    """The items' terms, told apart by two 64-bit hashes; a term's number is its place in ``a``."""

    def __init__(self, pairs: list[tuple[int, int]]):
        known = sorted(set(pairs), key=lambda p: (p[0] % (1 << 64), p[1]))
        self.a = np.array([p[0] for p in known], np.int64).view(np.uint64)
        self.b = np.array([p[1] for p in known], np.int64).view(np.uint64)
        self.number = {p: i for i, p in enumerate(known)}
        #: Most terms with one first hash: 1, but for a collision.
        self.deepest = int(np.unique(self.a, return_counts=True)[1].max(initial=0))

    def __len__(self) -> int:
        return len(self.a)

    def of(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The words that are terms, and their numbers. Both hashes must agree; the second is taken of likely words only."""
        if not len(self):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        hashes = words.hashes(FIRST)
        at = np.minimum(np.searchsorted(self.a, hashes), len(self) - 1)
        likely = np.flatnonzero(self.a[at] == hashes)
        at = at[likely]
        again = SECOND.ranges(SECOND.prefix(words.data), words.starts[likely], words.ends[likely])
        found = np.full(len(likely), -1, np.int64)
        for k in range(self.deepest):
            near = np.minimum(at + k, len(self) - 1)
            same = (self.a[near] == hashes[likely]) & (self.b[near] == again)
            found[same] = near[same]
        return likely[found >= 0], found[found >= 0]


def _postings(words: Words, terms: Terms, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, row, tf) of one block, sorted by term, then row."""
    at, numbers = terms.of(words)
    keys, tf = np.unique(numbers * rows + words.rows[at], return_counts=True)
    return keys // max(rows, 1), keys % max(rows, 1), tf


def statistics(docs: DataFrame, terms: Terms, text_col: str = "text") -> DataFrame:
    """(term, n): the documents that hold each term; term -1 has the documents with terms, -2 all their terms with repeats."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, df, seen, total = shared.value, np.zeros(len(shared.value), np.int64), 0, 0
        for batch in batches:
            for block in blocks(batch.column(0)):
                words = block.words(ALNUM, lower=True)
                term, _, _ = _postings(words, known, len(block))
                df += np.bincount(term, minlength=len(known))
                seen += int((np.diff(words.first) > 0).sum())
                total += len(words)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[held, -1, -2], pa.int64()), pa.array(np.r_[df[held], seen, total], pa.int64())], ["term", "n"])

    return docs.select(text_col).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def weight(documents: int, held: Column) -> Column:
    """floor(1000 * ln((2 N + 2) / (2 df + 1))), in doubles."""
    return F.floor(1000 * F.ln(F.lit(2 * documents + 2).cast("double") / (2 * held + 1).cast("double"))).cast("long")


class _Segment:
    """Posting lists of some documents: list of term t is docs[first[t]:first[t + 1]], with the scores it gives."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, tf: np.ndarray, ids: np.ndarray, m: np.ndarray, weights: np.ndarray):
        order = np.lexsort((doc, term))
        term, self.docs, tf = term[order], doc[order], tf[order]
        self.scores = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[self.docs]))
        self.first = np.searchsorted(term, np.arange(len(weights) + 1))
        self.ids = ids
        filled = np.flatnonzero(np.diff(self.first))
        self.bounds = np.zeros(len(weights), np.int64)
        if len(filled):
            self.bounds[filled] = np.maximum.reduceat(self.scores, self.first[filled])


class _Best:
    """The best (score, id) of one item so far; ``least`` is the score that a further document must reach."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.scores, self.ids, self.known = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        kept = scores >= self.least
        if not kept.any():
            return
        scores, ids, known = (np.r_[old, new[kept]] for old, new in ((self.scores, scores), (self.ids, ids), (self.known, known)))
        order = np.lexsort((ids, ~known, -scores))[: self.k]
        self.scores, self.ids, self.known = scores[order], ids[order], known[order]
        if len(order) == self.k:
            self.least = max(1, int(self.scores[-1]))


def _seek(segment: _Segment, term: int, docs: np.ndarray) -> np.ndarray:
    """What a list gives to each of the (sorted) documents, found by binary search."""
    low, high = segment.first[term], segment.first[term + 1]
    own = segment.docs[low:high]
    at = np.minimum(np.searchsorted(own, docs), len(own) - 1)
    return np.where(own[at] == docs, segment.scores[low + at], 0)


def _sum(docs: list[np.ndarray], scores: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct documents in order, with the sum of their scores."""
    if len(docs) == 1:
        return docs[0], scores[0]
    every, gained = np.concatenate(docs), np.concatenate(scores)
    order = np.argsort(every, kind="stable")
    every, gained = every[order], gained[order]
    first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]) if len(every) else np.empty(0, np.int64)
    return every[first], np.add.reduceat(gained, first) if len(first) else gained


def evaluate(segment: _Segment, known: np.ndarray, terms: np.ndarray, best: _Best) -> None:
    """One item over one segment; ``known`` says which document ids are not null."""
    sizes = segment.first[terms + 1] - segment.first[terms]
    terms = terms[(sizes > 0) & (segment.bounds[terms] > 0)]
    if not len(terms) or segment.bounds[terms].sum() < best.least:
        return
    sizes = segment.first[terms + 1] - segment.first[terms]
    terms, sizes = (x[np.argsort(sizes, kind="stable")] for x in (terms, sizes))
    # Term at a time: accumulators of the short lists.
    n_short = max(1, int((np.cumsum(sizes) <= len(segment.ids) * SHORT).sum()))
    spans = [slice(segment.first[t], segment.first[t + 1]) for t in terms[:n_short]]
    acc_docs, acc = _sum([segment.docs[s] for s in spans], [segment.scores[s] for s in spans])
    # Long lists, the greatest bound first; rest[i] is what lists i and later can give together.
    long = terms[n_short:]
    long = long[np.argsort(-segment.bounds[long], kind="stable")]
    rest = np.r_[np.cumsum(segment.bounds[long][::-1])[::-1], 0]
    for low in range(0, len(segment.ids), WINDOW) if len(long) else (0,):
        high = low + WINDOW if len(long) else len(segment.ids)
        # Lists whose bounds, with all after them, stay below the least score name no documents of their own.
        essential = int((rest[:-1] >= best.least).sum())
        a, b = np.searchsorted(acc_docs, (low, high))
        docs, scores = [acc_docs[a:b]], [acc[a:b]]
        for t in long[:essential].tolist():
            first, last = segment.first[t], segment.first[t + 1]
            c, d = np.searchsorted(segment.docs[first:last], (low, high)) + first
            docs.append(segment.docs[c:d])
            scores.append(segment.scores[c:d])
        found, sums = _sum(docs, scores)
        for i in range(essential, len(long)):
            hopeful = sums + rest[i] >= best.least
            found, sums = found[hopeful], sums[hopeful]
            if not len(found):
                break
            sums = sums + _seek(segment, int(long[i]), found)
        if len(found):
            best.add(sums, segment.ids[found], known[found])


def _searcher(shared, text_col: str, id_col: str, k: int):
    """Each task: its ``k`` best documents of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights, items, documents, total = shared.value
        best = [_Best(k) for _ in items]
        parts: list[tuple] = []
        held = postings = 0

        def finish() -> None:
            nonlocal parts, held, postings
            if parts:
                term, doc, tf, ids, known, lengths = (np.concatenate([p[i] for p in parts]) for i in range(6))
                m = 10 + (90 * lengths * documents) // max(total, 1)
                segment = _Segment(term, doc, tf, ids, m, weights)
                for own, found in zip(items, best, strict=True):
                    evaluate(segment, known, own, found)
            parts, held, postings = [], 0, 0

        for batch in batches:
            column = batch.column(id_col)
            ids, known = column.fill_null(0).cast(pa.int64()).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)
            for block in blocks(batch.column(text_col)):
                words = block.words(ALNUM, lower=True)
                term, row, tf = _postings(words, terms, len(block))
                own = slice(block.first, block.first + len(block))
                parts.append((term, row + held, tf, ids[own], known[own], np.diff(words.first)))
                held, postings = held + len(block), postings + len(term)
                if held >= SEGMENT_DOCUMENTS or postings >= SEGMENT_POSTINGS:
                    finish()
        finish()
        counts = [len(b.scores) for b in best]
        numbers = np.repeat(np.arange(len(items)), counts)
        ids, known, scores = (np.concatenate([getattr(b, x) for b in best]) if best else np.empty(0, np.int64) for x in ("ids", "known", "scores"))
        out = [pa.array(numbers, pa.int64()), pa.array(ids.astype(np.int64), pa.int64(), mask=~known.astype(bool)), pa.array(scores.astype(np.int64), pa.int64())]
        yield pa.RecordBatch.from_arrays(out, ["number", id_col, "score"])

    return run


def _one_pass(docs: DataFrame, pairs: list, kind: T.DataType, k: int, text_col: str, id_col: str) -> DataFrame:
    """The ``k`` best documents of the items in ``pairs``, a bounded list of (item, a, b)."""
    spark = docs.sparkSession
    terms = Terms([(p["a"], p["b"]) for p in pairs])
    counted = statistics(docs, terms, text_col).collect()  # one row a term of the items
    held = {r["term"]: r["n"] for r in counted}
    documents, total = held.pop(-1, 0), held.pop(-2, 0)
    rows = spark.createDataFrame([(t, n) for t, n in held.items()], "term long, n long")
    weights = np.zeros(len(terms), np.int64)
    for r in rows.select("term", weight(documents, F.col("n")).alias("w")).collect():
        weights[r["term"]] = r["w"]
    by_item: dict = {}
    for p in pairs:
        by_item.setdefault(p["item"]["id"], []).append(terms.number[(p["a"], p["b"])])
    names = list(by_item)
    shared = spark.sparkContext.broadcast((terms, weights, [np.array(sorted(by_item[x]), np.int64) for x in names], documents, total))
    found = docs.select(id_col, text_col).mapInArrow(_searcher(shared, text_col, id_col, k), f"number long, `{id_col}` long, score long")
    best_first = [F.col("score").desc(), F.col(id_col).asc_nulls_last()]
    salted = found.withColumn("_salt", F.spark_partition_id() % SALTS)
    for keys in (["number", "_salt"], ["number"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best_first))).where(F.col("rank") <= k)
    labels = spark.createDataFrame(list(enumerate(names)), T.StructType([T.StructField("number", T.LongType()), T.StructField("item", kind)]))
    return salted.join(F.broadcast(labels), "number").select("item", F.col("rank").cast("int").alias("rank"), id_col, "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = K, text_col: str = "text", id_col: str = "doc_id",
    item_col: str = "item_id", item_text: str = "text", pairs_per_pass: int = PAIRS_PER_PASS,
) -> DataFrame:
    """(item, rank, document, score): the ``k`` best documents of each item with a score above 0, ranked from 1."""
    spark = docs.sparkSession
    pairs = item_terms(items, item_col, item_text)
    total = pairs.count()
    schema = f"`{item_col}` {items.schema[item_col].dataType.simpleString()}, rank int, `{id_col}` {docs.schema[id_col].dataType.simpleString()}, score long"
    passes = max(1, -(-total // pairs_per_pass))
    parts = []
    for i in range(passes):
        # All pairs of an item are in one pass; a single item is never cut.
        own = pairs.where(F.pmod(F.xxhash64("item.id"), F.lit(passes)) == i).collect()
        if own:
            parts.append(_one_pass(docs, own, items.schema[item_col].dataType, k, text_col, id_col))
    if not parts:
        return spark.createDataFrame([], schema)
    found = reduce(DataFrame.unionByName, parts)
    return found.select(
        F.col("item").alias(item_col), "rank",
        F.col(id_col).cast(docs.schema[id_col].dataType).alias(id_col), "score",
    )
