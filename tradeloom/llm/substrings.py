"""Substring dedup on words: a De Bruijn graph of the repeated k-mers, compacted along its paths.

Every window of ``k`` words is an edge between the (k-1)-mers at its ends. Only windows whose anchor (the
least hash of an inner gram of ``GRAM`` words; equal windows have equal anchors) is in two documents or
more can repeat, and only they become edges. A table of edges holds for each the first and last
document and the edges before and after it, joined to its occurrences. Where each occurrence of an edge
is followed by the same edge, which always follows it, the path does not branch, and the two compact.
So every document gets its repeated spans, each a path with one first document, and the words of spans
whose first document is a smaller id go.

Edges are told apart by 96 hash bits of their words. Jobs: anchors, edges, spans; each writes a table in
the shared folder, and its shuffle files go when it ends. All shuffles go by hash or by chunk of
documents, with what a chunk's documents share said once (see ``chunks``).

Windows lie in one row. Rows of the same id are one document: they do not repeat each other. Rows
with a null id remove nothing and lose nothing. Null texts have no words. Other columns are kept; the
columns added here replace columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.session import work_dir

from .chunks import chunked, extremes, ids_of, short_lived_shuffles, signed, unsigned
from .textcols import NOT_SPACE, Block, Hasher, Words, blocks, covered

K = 13
GRAM = 8
PASSES = 2
HASHER, CHECKER = Hasher(1), Hasher(101)
SPAN = "struct<start:int,words:int,first_doc:long>"
ADDED = f"n_words long, n_removed long, spans array<{SPAN}>, kept string"


def _anchors(words: Words, hashes: np.ndarray, k: int, gram: int) -> np.ndarray:
    """The anchor of each window of k words."""
    grams, count = HASHER.windows(hashes, gram), max(0, len(words) - k + 1)
    least = grams[:count].copy()
    for i in range(1, k - gram + 1):
        np.minimum(least, grams[i : i + count], out=least)
    return least


def _find_anchors(k: int, gram: int, id_col: str, text_col: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids, known = ids_of(table, id_col)
        parts = []
        for block in blocks(table.column(text_col)):
            words = block.words(NOT_SPACE)
            rows = words.rows[: max(0, len(words) - k + 1)] + block.first
            use = words.within(k) & known[rows]
            parts.append(extremes(_anchors(words, words.hashes(HASHER), k, gram)[use], ids[rows][use]))
        anchors, low, _, _, high = extremes(*(np.concatenate([p[i] for p in parts]) for i in range(3)))
        return pa.table([signed(anchors), pa.array(low), pa.array(high), pa.array(np.full(len(low), key[0].as_py()), pa.int32())], ["anchor", "low", "high", "_chunk"])

    return run


class _Edges:
    """The windows of a block that may repeat: where they are, and their hashes."""

    def __init__(self, block: Block, k: int, gram: int, anchors: np.ndarray, known: np.ndarray):
        self.words = block.words(NOT_SPACE)
        count = max(0, len(self.words) - k + 1)
        hashes = self.words.hashes(HASHER)
        own = _anchors(self.words, hashes, k, gram)
        at = np.minimum(np.searchsorted(anchors, own), max(0, len(anchors) - 1))
        rows = self.words.rows[:count]
        repeated = anchors[at] == own if len(anchors) else np.zeros(count, bool)
        self.at = np.flatnonzero(repeated & self.words.within(k) & known[rows + block.first])
        self.rows = rows[self.at]
        self.hash = HASHER.windows(hashes, k)[self.at]
        self.check = (CHECKER.windows(self.words.hashes(CHECKER), k)[self.at] >> np.uint64(33)).astype(np.int32)
        #: Does the next edge follow this one directly, in the same row?
        self.follows = (np.diff(self.at) == 1) & (np.diff(self.rows) == 0) if len(self.at) else np.zeros(0, bool)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Short hashes of the edges before and after each edge; 0 is none."""
        short = (self.hash >> np.uint64(34)).astype(np.int32) + 1
        before, after = np.zeros(len(self.at), np.int32), np.zeros(len(self.at), np.int32)
        before[1:][self.follows], after[:-1][self.follows] = short[:-1][self.follows], short[1:][self.follows]
        return before, after


def _find_edges(k: int, gram: int, id_col: str, text_col: str, part: int = 0, parts_of: int = 1):
    def run(key: tuple, table: pa.Table, repeated: pa.Table) -> pa.Table:
        ids, known = ids_of(table, id_col)
        anchors = np.sort(unsigned(repeated.column("anchor")))
        parts: list[tuple] = []
        for block in blocks(table.column(text_col)):
            edges = _Edges(block, k, gram, anchors, known)
            before, after = edges.links()
            use = edges.hash % np.uint64(parts_of) == part
            parts.append(tuple(x[use] for x in (edges.hash, edges.check, ids[edges.rows + block.first], before, after)))
        hashes, check, docs, before, after = ((np.concatenate([p[i] for p in parts]) if parts else np.empty(0, t)) for i, t in enumerate((np.uint64, np.int32, np.int64, np.int32, np.int32)))
        # One row for each edge of the chunk. (Two checks under one hash keep apart as two rows.)
        order = np.lexsort((check, hashes))
        hashes, check = hashes[order], check[order]
        number = np.cumsum(np.r_[False, (hashes[1:] != hashes[:-1]) | (check[1:] != check[:-1])]) if len(hashes) else np.empty(0, np.int64)
        distinct, low, high, before_low, before_high, after_low, after_high = extremes(number, docs[order], before[order], after[order])
        first = np.searchsorted(number, distinct)
        # Few and narrow columns: this is the largest shuffle.
        before, after = (np.where(x == y, x, BRANCHES).astype(np.int64) for x, y in ((before_low, before_high), (after_low, after_high)))
        chunk = np.full(len(low), key[0].as_py(), np.int32)
        return pa.table([signed(hashes[first]), pa.array(check[first]), pa.array(before << 32 | after & 0xFFFFFFFF), pa.array(low), pa.array(high - low), pa.array(chunk)], ["edge", "check", "links", "low", "more", "_chunk"])

    return run


EDGES = "edge long, check int, links long, low long, more long, _chunk int"
#: Links are 1 to SHORT; in place of one, 0 says that no edge stands there, and BRANCHES that several do.
SHORT, BRANCHES = 1 << 30, -1


def _compact(edges: DataFrame) -> DataFrame:
    """(_chunk, edge, check, first_doc, enters, leaves): the repeated edges, with the chunks that have them.

    ``enters`` says that the same edge stands before each occurrence, ``leaves`` that the same stands after.
    One exchange brings an edge's rows together (one for each chunk at most) and joins them to what they have
    in common.
    """
    edge = Window.partitionBy("edge", "check")
    before, after = F.shiftright("links", 32), F.col("links").bitwiseAND(F.lit(0xFFFFFFFF))
    alike = lambda link: F.min(link).over(edge).between(1, SHORT) & (F.min(link).over(edge) == F.max(link).over(edge))
    nodes = edges.withColumns({
        "first_doc": F.min("low").over(edge), "last_doc": F.max(F.col("low") + F.col("more")).over(edge),
        "enters": alike(before), "leaves": alike(after),
    })
    # A chunk whose documents are all the first one keeps everything.
    return nodes.where((F.col("first_doc") < F.col("last_doc")) & (F.col("low") + F.col("more") > F.col("first_doc"))).select("_chunk", "edge", "check", "first_doc", "enters", "leaves")


def _find_spans(k: int, gram: int, id_col: str, text_col: str, columns: list[str]):
    def run(key: tuple, table: pa.Table, repeated: pa.Table) -> pa.Table:
        ids, known = ids_of(table, id_col)
        order = np.lexsort((repeated.column("check").to_numpy(), unsigned(repeated.column("edge"))))
        edge, check, first_doc = unsigned(repeated.column("edge"))[order], repeated.column("check").to_numpy()[order], repeated.column("first_doc").to_numpy()[order]
        enters, leaves = (repeated.column(c).to_numpy()[order] for c in ("enters", "leaves"))
        total, removed, spans, kept = [], [], [], []
        for block in blocks(table.column(text_col)):
            words = block.words(NOT_SPACE)
            count = max(0, len(words) - k + 1)
            hashes = HASHER.windows(words.hashes(HASHER), k)
            checks = (CHECKER.windows(words.hashes(CHECKER), k) >> np.uint64(33)).astype(np.int32)
            left, right = np.searchsorted(edge, hashes), np.searchsorted(edge, hashes, "right")
            found = np.full(count, -1)
            for step in range(int((right - left).max(initial=0))):
                here = left + step < right
                here[here] &= check[(left + step)[here]] == checks[here]
                found[here] = (left + step)[here]
            rows = words.rows[:count]
            at = np.flatnonzero((found >= 0) & words.within(k))
            own = ids[rows[at] + block.first]
            at = at[known[rows[at] + block.first] & (first_doc[found[at]] < own)]
            gone = covered(at, k, len(words))
            entry = found[at]
            # A path goes on from one edge to the next where it branches at neither.
            same = (np.diff(at) == 1) & (rows[at[1:]] == rows[at[:-1]]) & leaves[entry[:-1]] & enters[entry[1:]] & (first_doc[entry[1:]] == first_doc[entry[:-1]]) if len(at) else np.empty(0, bool)
            begin = np.flatnonzero(np.r_[True, ~same]) if len(at) else np.empty(0, np.int64)
            end = np.r_[begin[1:], len(at)] - 1 if len(at) else begin
            path_row = rows[at[begin]] if len(at) else begin
            for row in range(len(block)):
                low, high = int(words.first[row]), int(words.first[row + 1])
                total.append(high - low)
                lost = gone[low:high]
                removed.append(int(lost.sum()))
                if removed[-1]:
                    own_paths = range(*np.searchsorted(path_row, [row, row + 1]).tolist())
                    spans.append([{"start": int(at[begin[p]]) - low, "words": int(at[end[p]] - at[begin[p]]) + k, "first_doc": int(first_doc[entry[begin[p]]])} for p in own_paths])
                    keep = np.flatnonzero(~lost) + low
                    kept.append(b" ".join(words.data[s:e].tobytes() for s, e in zip(words.starts[keep], words.ends[keep], strict=True)))
                else:
                    spans.append([])
                    kept.append(words.text(low, high))
        more = [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("first_doc", pa.int64())]))), pa.array(kept, pa.binary()).cast(pa.string())]
        return pa.table([*(table.column(c) for c in columns), *more], [*columns, "n_words", "n_removed", "spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, k: int = K, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document with ``n_words``, ``n_removed``, ``spans`` (repeated paths that a smaller id has: first
    word, words, and that id) and ``kept``, the words left, joined by one space.
    """
    spark = docs.sparkSession
    base = docs.drop(*(x.split()[0] for x in ADDED.split(", ")))
    path = work_dir(spark, "substrings")
    dealt = chunked(base, id_col)
    slim = dealt.select(id_col, text_col, "_chunk")
    with short_lived_shuffles(spark):
        anchors = slim.groupBy("_chunk").applyInArrow(_find_anchors(k, gram, id_col, text_col), "anchor long, low long, high long, _chunk int")
        everywhere = anchors.withColumns({"first": F.expr("min(low) OVER (PARTITION BY anchor)"), "last": F.expr("max(high) OVER (PARTITION BY anchor)")})
        everywhere.where("first < last").select("_chunk", "anchor").write.parquet(f"{path}/anchors")
        repeated = spark.read.parquet(f"{path}/anchors")
        for part in range(PASSES):
            # The edges of a part of the hashes at a time, to halve what lies on disk at once.
            edges = slim.groupBy("_chunk").cogroup(repeated.groupBy("_chunk")).applyInArrow(_find_edges(k, gram, id_col, text_col, part, PASSES), EDGES)
            _compact(edges).write.mode("append").parquet(f"{path}/edges")
    compacted = spark.read.parquet(f"{path}/edges")
    schema = T.StructType([*base.schema.fields, *T.StructType.fromDDL(ADDED).fields])
    return dealt.groupBy("_chunk").cogroup(compacted.groupBy("_chunk")).applyInArrow(_find_spans(k, gram, id_col, text_col, base.columns), schema)
