"""Suffix dedup on bytes: a radix sort of suffixes that is limited to the depth that matters.

Suffixes count by their first ``DEPTH`` bytes only, so ones that sort alike are exactly the repeated
windows of that length, and all but the first of them go. Three digits stand for the bytes: 32 bits of
the first half, 32 of the second, 16 of both. The first pass is dealt out by Spark, by a mix of the
digits, so that a phrase that very many texts share does not meet in one task; the passes of a task go
from the leading digit to the last and drop, after each, the suffixes that are alone in their group.

Suffixes next to each other mostly share their anchor, the least hash of an inner gram of ``GRAM`` bytes, and
equal suffixes always have equal anchors. A run of suffixes with one anchor is a piece. An anchor of one piece
has no repeats. Where all pieces of an anchor are alike, they are judged whole: equal pieces are equal
suffixes, place by place. Only suffixes of the other anchors, where copies part, go through the sort.

Chunks are ranges of ids, so the chunk that has the first one of a group is the one of least number: a chunk
says its anchors and the digits of its suffixes once each, the latter packed by range, and is told which
are repeated and whether an earlier chunk has them.

Jobs: anchors, digits, removal; each writes a table in the shared folder, and its shuffle files go when
it ends. Rows of one id are one document, in the order of their texts. Rows with a null id remove nothing
and lose nothing. Null texts are empty. Other columns are kept; the columns added here replace columns of
the same name. What is left of a text may break a character, so it is binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.session import work_dir

from .chunks import extremes, ids_of, short_lived_shuffles, signed, unsigned
from .packing import edges, planes, unplanes
from .textcols import Block, Hasher, blocks, covered, mix, unmix

DEPTH = 100
GRAM = 32
CHUNKS_PER_PARTITION = 4
BLOCK_BYTES = 1 << 20
HASHER, CHECKER = Hasher(4), Hasher(104)
SAID = "_range int, _chunk int, leading binary, last binary"
TOLD = "_chunk int, _range int, state binary"
ADDED = "n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"
#: A piece whose anchor stands in it more than once is unlike any, itself included.
LIMITS = (np.iinfo(np.int64).min, np.iinfo(np.int64).max)
#: What a chunk is told about a suffix.
ALONE, FIRST_HERE, FIRST_BEFORE = 0, 1, 2


def sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The least (or greatest) of values[i:i + width] for every i, by running extremes of blocks of that width."""
    count = len(values) - width + 1
    if count <= 0:
        return values[:0]
    pick, edge = (np.minimum, np.iinfo(values.dtype).max) if least else (np.maximum, 0)
    padded = np.full(-(-len(values) // width) * width, edge, values.dtype)
    padded[: len(values)] = values
    tiles = padded.reshape(-1, width)
    ahead = pick.accumulate(tiles, axis=1).ravel()
    back = pick.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(back[:count], ahead[width - 1 : width - 1 + count])


class _Suffixes:
    """The suffixes of a block that are deep enough, with their anchors."""

    def __init__(self, block: Block, depth: int, gram: int, known: np.ndarray):
        self.block, self.depth = block, depth
        size = len(block.data)
        self.sums = HASHER.prefix(block.data)
        count = max(0, size - gram + 1)
        at = np.arange(count)
        self.grams = HASHER.ranges(self.sums, at, at + gram) | np.uint64(1)
        self.width = depth - gram + 1
        self.anchors = sliding(self.grams, self.width, least=True)
        rows = np.repeat(np.arange(len(block)), np.diff(block.bounds))
        whole = rows[: len(self.anchors)] == rows[depth - 1 : depth - 1 + len(self.anchors)]
        self.rows, self.whole = rows, whole & known[rows[: len(self.anchors)] + block.first]
        self.anchors[~self.whole] = 0

    def pieces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of suffixes that share an anchor: where they begin, how many suffixes, and the anchor."""
        own = self.anchors
        begin = np.flatnonzero(self.whole & np.r_[True, (own[1:] != own[:-1]) | ~self.whole[:-1]]) if len(own) else np.empty(0, np.int64)
        if not len(begin):
            return begin, begin, self.grams[:0]
        change = np.flatnonzero(np.r_[(own[1:] != own[:-1]) | ~self.whole[1:], True]) + 1
        return begin, change[np.searchsorted(change, begin, "right")] - begin, own[begin]

    def contents(self, begin: np.ndarray, count: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A hash of each piece's bytes, and whether its anchor stands in it more than once.

        Suffixes of one piece can only be equal if it does.
        """
        around = np.zeros(len(self.anchors) + 2 * (self.width - 1), np.uint64)
        around[self.width - 1 : self.width - 1 + len(self.anchors)] = self.anchors
        at = np.flatnonzero(sliding(around, self.width, least=False) == self.grams)
        known, number = np.unique(self.grams[at], return_inverse=True)
        size = len(self.grams) + 1
        places = np.sort(number * size + at)
        base = np.searchsorted(known, anchor) * size
        last = begin + count - 1
        times = np.searchsorted(places, base + last + self.width) - np.searchsorted(places, base + begin)
        return HASHER.ranges(self.sums, begin, last + self.depth), times > 1

    def digits(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The two leading digits as one number, scrambled, and the last one."""
        half = at + self.depth // 2
        first, second = HASHER.ranges(self.sums, at, half), HASHER.ranges(self.sums, half, at + self.depth)
        leading = (first & np.uint64(0xFFFFFFFF00000000)) | (second >> np.uint64(32))
        last = CHECKER.ranges(CHECKER.prefix(self.block.data), at, at + self.depth) >> np.uint64(48)
        return mix(leading), last.astype(np.uint16)


def repeated_groups(digits: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Members of groups of two or more equal suffixes, and their groups, by passes from the leading digit on."""
    members, group = np.arange(len(digits[0])), np.zeros(len(digits[0]), np.int64)
    for digit in digits:
        own = digit[members]
        order = np.lexsort((own, group))
        members, group, own = members[order], group[order], own[order]
        new = np.r_[True, (group[1:] != group[:-1]) | (own[1:] != own[:-1])] if len(members) else np.empty(0, bool)
        group = np.cumsum(new) - 1
        several = np.bincount(group)[group] > 1 if len(members) else new
        members, group = members[several], group[several]
    return members, group


def _ordered(table: pa.Table, id_col: str, text_col: str) -> pa.Table:
    return table.sort_by([(id_col, "ascending"), (text_col, "ascending")])


def _blocks(table: pa.Table, id_col: str, text_col: str, depth: int, gram: int) -> Iterator[tuple[Block, _Suffixes]]:
    known = ids_of(table, id_col)[1]
    for block in blocks(table.column(text_col), BLOCK_BYTES):
        yield block, _Suffixes(block, depth, gram, known)


def _find_anchors(depth: int, gram: int, id_col: str, text_col: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        parts = []
        for _, suffixes in _blocks(table, id_col, text_col, depth, gram):
            begin, count, anchor = suffixes.pieces()
            if len(begin):
                content, several = suffixes.contents(begin, count, anchor)
                content = content.view(np.int64)
                parts.append((anchor, np.where(several, LIMITS[0], content), np.where(several, LIMITS[1], content)))
        anchor, low, high = (np.concatenate([p[i] for p in parts]) if parts else np.empty(0, t) for i, t in enumerate((np.uint64, np.int64, np.int64)))
        found, least, _, _, most = extremes(anchor, low, high)
        n = np.unique(anchor, return_counts=True)[1]
        return pa.table([signed(found), pa.array(n, pa.int32()), pa.array(least), pa.array(most), pa.array(np.full(len(found), key[0].as_py()), pa.int32())], ["anchor", "n", "low", "high", "_chunk"])

    return run


def _in(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)] == values


def _all_digits(table: pa.Table, repeated: pa.Table, id_col: str, text_col: str, depth: int, gram: int):
    """For each block the suffixes that are judged singly, and the place of each among the chunk's distinct
    ones; those; the first of each; and for each block its pieces that are judged whole.
    """
    mixed = np.array(repeated.column("mixed").to_numpy(zero_copy_only=False), bool)
    anchors = unsigned(repeated.column("anchor"))
    single, plain = np.sort(anchors[mixed]), np.sort(anchors[~mixed])
    own, wholes = [], []
    for block, suffixes in _blocks(table, id_col, text_col, depth, gram):
        begin, count, anchor = suffixes.pieces()
        use = _in(single, anchor)
        shift = begin[use] - (np.cumsum(count[use]) - count[use])
        at = np.repeat(shift, count[use]) + np.arange(count[use].sum())
        own.append((block, at, *suffixes.digits(at)))
        use = _in(plain, anchor)
        wholes.append((begin[use], count[use], anchor[use]))
    if not own:
        return [], np.empty(0, np.uint64), np.empty(0, np.uint16), np.empty(0, np.int64), np.empty(0, np.int64), []
    leading, last = np.concatenate([x[2] for x in own]), np.concatenate([x[3] for x in own])
    order = np.lexsort((last, leading))
    sorted_leading, sorted_last = leading[order], last[order]
    new = np.r_[True, (sorted_leading[1:] != sorted_leading[:-1]) | (sorted_last[1:] != sorted_last[:-1])] if len(order) else np.empty(0, bool)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    # The sort is stable: the first of equal ones is the first in the order of ids, texts and places.
    return [(block, at) for block, at, _, _ in own], sorted_leading[first], sorted_last[first], number, order[first], wholes


def _say(depth: int, gram: int, ranges: int, id_col: str, text_col: str):
    def run(key: tuple, table: pa.Table, repeated: pa.Table) -> pa.Table:
        _, leading, last, number, _, _ = _all_digits(_ordered(table, id_col, text_col), repeated, id_col, text_col, depth, gram)
        several = np.bincount(number, minlength=len(leading)) > 1
        edge = edges(leading, ranges)
        filled = [i for i in range(ranges) if edge[i] < edge[i + 1]]
        # The low bit of the last digit gives way to whether the chunk has several.
        last = last & np.uint16(0xFFFE) | several
        return pa.table([
            pa.array(filled, pa.int32()), pa.array([key[0].as_py()] * len(filled), pa.int32()),
            pa.array([planes(np.diff(leading[edge[i] : edge[i + 1]], prepend=np.uint64(0))) for i in filled], pa.binary()),
            pa.array([planes(last[edge[i] : edge[i + 1]]) for i in filled], pa.binary()),
        ], ["_range", "_chunk", "leading", "last"])

    return run


def _judge(key: tuple, table: pa.Table) -> pa.Table:
    """Which of a range's suffixes are repeated, and where the first one is."""
    parts = [np.cumsum(unplanes(x.as_py(), np.uint64), dtype=np.uint64) for x in table.column("leading")]
    last = np.concatenate([unplanes(x.as_py(), np.uint16) for x in table.column("last")])
    chunk = np.repeat(table.column("_chunk").to_numpy(), [len(p) for p in parts])
    leading = unmix(np.concatenate(parts))
    members, group = repeated_groups([(leading >> np.uint64(32)).astype(np.uint32), leading.astype(np.uint32), last >> np.uint16(1)])
    state = np.where(last & np.uint16(1), FIRST_HERE, ALONE).astype(np.uint8)
    if len(members):
        least = np.full(group[-1] + 1, np.iinfo(np.int32).max)
        np.minimum.at(least, group, chunk[members])
        state[members] = np.where(chunk[members] > least[group], FIRST_BEFORE, FIRST_HERE)
    begin = np.r_[0, np.cumsum([len(p) for p in parts])]
    return pa.table([table.column("_chunk"), table.column("_range"), pa.array([state[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:], strict=True)], pa.binary())], ["_chunk", "_range", "state"])


def _remove(depth: int, gram: int, id_col: str, text_col: str, columns: list[str]):
    def run(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        table = _ordered(table, id_col, text_col)
        repeated = told.filter(told.column("anchor").is_valid())
        answers = told.filter(told.column("state").is_valid())
        own, leading, _, number, first, wholes = _all_digits(table, repeated, id_col, text_col, depth, gram)
        order = np.argsort(answers.column("_range").to_numpy())
        state = np.frombuffer(b"".join(x.as_py() for x in answers.column("state").take(pa.array(order))), np.uint8)
        assert len(state) == len(leading)
        goes = state[number] != ALONE
        goes[first[state == FIRST_HERE]] = False
        # Of pieces that are alike everywhere all go, but for the first one if it is here.
        anchor = np.concatenate([w[2] for w in wholes]) if wholes else np.empty(0, np.uint64)
        stays = np.zeros(len(anchor), bool)
        stays[np.unique(anchor, return_index=True)[1]] = True
        before = np.sort(unsigned(repeated.filter(repeated.column("before")).column("anchor")))
        leaves = ~stays | _in(before, anchor)
        sizes, removed, spans, kept, low, piece = [], [], [], [], 0, 0
        for (block, at), (begin, count, _) in zip(own, wholes, strict=True):
            use, out = goes[low : low + len(at)], leaves[piece : piece + len(begin)]
            low, piece = low + len(at), piece + len(begin)
            starts = np.concatenate([at[use], begin[out]])
            width = np.concatenate([np.full(int(use.sum()), depth), count[out] - 1 + depth])
            gone = covered(starts, width, len(block.data))
            for row in range(len(block)):
                a, b = block.bounds[row], block.bounds[row + 1]
                lost = gone[a:b]
                edge = np.flatnonzero(np.diff(np.r_[False, lost, False].astype(np.int8))).reshape(-1, 2)
                sizes.append(int(b - a))
                removed.append(int((edge[:, 1] - edge[:, 0]).sum()))
                spans.append([{"start": int(x), "end": int(y)} for x, y in edge])
                kept.append(block.data[a:b][~lost].tobytes() if len(edge) else block.data[a:b].tobytes())
        more = [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())]
        return pa.table([*(table.column(c) for c in columns), *more], [*columns, "n_bytes", "n_removed", "spans", "kept"])

    return run


def _by_ranges(docs: DataFrame, id_col: str) -> DataFrame:
    """With ``_chunk``, numbers that grow with the id; about as many ids in each."""
    chunks = CHUNKS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = F.col(id_col).cast("long")
    cuts = docs.agg(F.percentile_approx(number, [i / chunks for i in range(1, chunks)], 20 * chunks).alias("cuts")).first()["cuts"] or []
    limits = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("int")
    def chunk_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(limits, ids.fillna(0).to_numpy(np.int64), "right").astype(np.int32))

    return docs.withColumn("_chunk", chunk_of(F.coalesce(number, F.xxhash64(*docs.columns))))


def remove_repeats(docs: DataFrame, depth: int = DEPTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document with ``n_bytes``, ``n_removed``, ``spans`` (the maximal removed runs, as bytes of the
    UTF-8 text) and ``kept`` (the bytes left).
    """
    spark, path = docs.sparkSession, work_dir(docs.sparkSession, "suffixes")
    base = docs.drop(*(x.split()[0] for x in ADDED.split(", "))).withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")))
    dealt = _by_ranges(base, id_col)
    slim = dealt.select(id_col, text_col, "_chunk")
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) * 2 // 3)
    with short_lived_shuffles(spark):
        anchors = slim.groupBy("_chunk").applyInArrow(_find_anchors(depth, gram, id_col, text_col), "anchor long, n int, low long, high long, _chunk int")
        # An anchor has a row for each chunk at most.
        common = {"total": "sum(n)", "least": "min(low)", "most": "max(high)", "first": "min(_chunk)"}
        anchors = anchors.withColumns({name: F.expr(f"{sql} OVER (PARTITION BY anchor)") for name, sql in common.items()})
        anchors = anchors.where("total > 1 OR least < most")
        anchors.selectExpr("_chunk", "anchor", "least < most AS mixed", "first < _chunk AS before").write.parquet(f"{path}/anchors")
        repeated = spark.read.parquet(f"{path}/anchors")
        said = slim.groupBy("_chunk").cogroup(repeated.groupBy("_chunk")).applyInArrow(_say(depth, gram, ranges, id_col, text_col), SAID)
        said.groupBy("_range").applyInArrow(_judge, TOLD).write.parquet(f"{path}/told")
    told = spark.read.parquet(f"{path}/told").unionByName(repeated, allowMissingColumns=True)
    schema = T.StructType([*base.schema.fields, *T.StructType.fromDDL(ADDED).fields])
    return dealt.groupBy("_chunk").cogroup(told.groupBy("_chunk")).applyInArrow(_remove(depth, gram, id_col, text_col, base.columns), schema)
