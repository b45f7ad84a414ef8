"""Similarity join of documents on their sets of word n-grams, by PartEnum signatures.

Two documents link when ``100 * |A & B| >= PERCENT * |A | B|`` of their sets of ``SHINGLE``-word windows.
Documents of equal sets are one node. Sizes are cut into bands, so that linked sets lie in one band or in
neighbours, which bounds the number k of features in which they can differ. For a band, hashes deal the
features to k // 2 + 1 groups and a spare one, of three parts each. Linked sets differ in at most one
feature in two or more of the groups, and there agree on two of the three parts: so each group gives three
signatures, one for each pair of parts. A set that has more empty pairs than one group's signs the empty
ones as well; any other shares a signature that is not empty. (k = 1 needs no spare group; k = 0 needs no
signature, as equal sets are one node.) No link is lost.

Sets that share a signature are compared, but not all with all: first with one leader of each
signature, the set with the most company, beginning with the leader of most signatures of a set. What is
then in one component needs no further comparison. Of signatures that still span several, all pairs across components follow: as rows where a signature has up
to ``MANY`` members. More members have mostly no more in common than a feature or two that many sets have. They are
told apart by prefixes: features are ordered by the number of sets that have them, rarest first, and linked sets share one
of the features by which a set may differ from a linked one, and one more. So two members are compared
if the first features of their sets meet. Only where more than ``MANY`` sets meet in so rare a feature all are compared, in
blocks, where a task compares two blocks of members and returns no more links than members.

A comparison begins with parity sketches: a set flips one of at least twice as many bits for each feature, so
sketches differ in no more bits than sets do in features. Only sets whose sketches are near enough are read in
full, and their exact intersection decides. A sketch has a sixteenth of the bytes of its set, or less.

Shuffles go by id, set, or signature. Joins on signatures and leaders, which can be hot, have an exchange
on either side. Steps write their results in the shared folder. Null ids link with nothing and are their
own class (null); null, empty and wordless texts have empty sets and link with nothing; rows that repeat
an id are one document, which links if one of its texts does. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.session import work_dir

from .chunks import short_lived_shuffles, signed, small_batches
from .textcols import NOT_SPACE, Block, Hasher, blocks, mix

SHINGLE = 3
PERCENT = 90
SPARE = 1
MANY = 32
#: Sets in which a feature is common, and the most common features that are told apart; all others come first in prefixes.
COMMON = 16
MOST_COMMON = 1 << 19
PASSES = 4
PASS_BYTES = 64 << 20
BLOCK = 256
#: Rows that go to a Python worker at a time, and bytes of text whose sets it holds at a time.
BATCH_ROWS = 1000
BLOCK_BYTES = 1 << 19
HASHER = Hasher(9)
U64 = np.uint64


def _sets(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of a block, sorted by row and feature, each once. Fewer words than a window are one feature."""
    words = block.words(NOT_SPACE, lower=True)
    hashes = words.hashes(HASHER)
    inside = words.within(size)
    rows, features = [words.rows[: len(inside)][inside]], [HASHER.windows(hashes, size)[inside]]
    counts = np.diff(words.first)
    for fewer in range(1, size):
        short = np.flatnonzero(counts == fewer)
        if len(short):
            rows.append(short)
            features.append(HASHER.windows(hashes, fewer)[words.first[short]])
    row, feature = np.concatenate(rows), np.concatenate(features)
    order = np.lexsort((feature, row))
    row, feature = row[order], feature[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (feature[1:] != feature[:-1])] if len(row) else np.empty(0, bool)
    return row[new], feature[new]


def _sums(row: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Sums modulo 2**64 of sorted rows' values."""
    total = np.r_[U64(0), np.cumsum(values, dtype=np.uint64)]
    edge = np.searchsorted(row, np.arange(rows + 1))
    return total[edge[1:]] - total[edge[:-1]]


def sets_of(docs: DataFrame, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, one, two): each row's set size and 128 bits that stand for the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1), BLOCK_BYTES):
                row, feature = _sets(block, size)
                counts = np.bincount(row, minlength=len(block))
                one, two = (_sums(row, mix(feature ^ U64(seed)), len(block)) for seed in (0x5BD1E995, 0xC2B2AE35))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, len(block)), pa.array(counts, pa.int64()), signed(one), signed(two)], ["doc_id", "n_shingles", "one", "two"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(run, "doc_id long, n_shingles long, one long, two long")


class Bands:
    """Bands of set sizes. Sets that may link are in one band or in two that follow each other."""

    def __init__(self, percent: int, largest: int):
        self.low = [1]
        while self.low[-1] <= largest:
            self.low.append(self.low[-1] * 100 // percent + 1)
        self.low.append(self.low[-1] * 100 // percent + 1)
        high = np.array([*self.low[1:], 2 * self.low[-1]]) - 1
        #: Of sets up to this size, linked ones differ in at most so many features.
        differ = 2 * high * (100 - percent) // (100 + percent)
        # Sets that may not differ are one node already. Where one feature may, one group has it.
        self.spare = np.where(differ > 1, SPARE, 0)
        self.groups = np.where(differ > 0, differ // 2 + 1 + self.spare, 0)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, sizes, "right") - 1


def _signatures(row: np.ndarray, feature: np.ndarray, rows: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, signature) of each set's own band and of the next; the sizes of the sets."""
    sizes = np.bincount(row, minlength=rows)
    bands = Bands(percent, int(sizes.max(initial=1)))
    signers, signs = [], []
    filled = np.flatnonzero(sizes)
    for step in (0, 1):
        level = np.zeros(rows, np.int64)
        level[filled] = bands.of(sizes[filled]) + step
        groups = np.where(sizes > 0, bands.groups[level], 0)
        begin = np.cumsum(groups) - groups
        scattered = mix(feature ^ mix(level[row].astype(np.uint64) + U64(77)))
        signing = groups[row] > 0
        slot = 3 * begin[row[signing]] + (scattered[signing] % (3 * groups[row[signing]]).astype(np.uint64)).astype(np.int64)
        total = 3 * int(groups.sum())
        value = mix(feature[signing] + U64(0x9E3779B97F4A7C15))
        halves = [np.bincount(slot, (value >> U64(s) & U64(0xFFFFFFFF)).astype(float), total) for s in (0, 32)]
        count = np.bincount(slot, minlength=total)
        owner = np.repeat(np.arange(rows), groups)
        # A pair of parts is what its group holds without the third part.
        low, high, left = (x.reshape(-1, 3).sum(1)[:, None] - x.reshape(-1, 3) for x in (*halves, count))
        empty = (left == 0).any(1)
        exposed = np.bincount(owner, empty, rows) > bands.spare[level]
        number = np.arange(len(owner)) - begin[owner]
        place = (level[owner] * 1_000_003 + number)[:, None] * 3 + np.arange(3)
        sign = mix(mix(low.astype(np.uint64)) + mix(high.astype(np.uint64) + U64(1)) * U64(3) + mix(place.astype(np.uint64)))
        use = (left > 0) | exposed[owner][:, None]
        signers.append(np.repeat(owner, 3).reshape(-1, 3)[use])
        signs.append(sign[use])
    return np.concatenate(signers), np.concatenate(signs), sizes


def signatures(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(sign, id, size): the signatures of each row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for block in blocks(batch.column(1), BLOCK_BYTES):
                row, feature = _sets(block, size)
                signer, sign, sizes = _signatures(row, feature, len(block), percent)
                yield pa.RecordBatch.from_arrays([signed(sign), pa.array(ids[block.first + signer], pa.int64()), pa.array(sizes[signer], pa.int32())], ["sign", "id", "size"])

    known = docs.where(F.col(id_col).isNotNull())
    return known.select(F.col(id_col).cast("long").alias("id"), text_col).mapInArrow(run, "sign long, id long, size int")


def _sketches(row: np.ndarray, feature: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, edges) of the parity sketches of sorted rows' sets: twice to four times as many bits as features, a power of two."""
    sizes = np.bincount(row, minlength=rows)
    bits = np.maximum(64, 1 << (np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64) + 1))
    begin = np.cumsum(bits) - bits
    place = begin[row] + (mix(feature ^ U64(0xA0761D6478BD642F)) & (bits[row] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(place, minlength=int(bits.sum())).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little"), np.r_[begin, bits.sum()] // 8


def _folded(sketch: np.ndarray, length: int) -> np.ndarray:
    """A sketch in fewer bytes: buckets are the low bits of hashes, so the halves add up."""
    while len(sketch) > length:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def _full_sets(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n, sketch, features): each row's set, its size, and its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1), BLOCK_BYTES):
                row, feature = _sets(block, size)
                edge = np.searchsorted(row, np.arange(len(block) + 1))
                packed, at = _sketches(row, feature, len(block))
                cut = lambda values, edges: pa.array([values[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, len(block)), pa.array(np.diff(edge), pa.int64()), cut(packed, at), cut(feature, edge)], ["id", "n", "sketch", "features"])

    return docs.select(F.col(id_col).cast("long").alias("id"), text_col).mapInArrow(run, "id long, n long, sketch binary, features binary")


def _near(pairs: DataFrame, features: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches do not rule a link out, with the number of features of both sets."""
    side = lambda x: features.select(F.col("id").alias(x), F.col("n").alias(f"{x}_n"), F.col("sketch").alias(f"{x}_sketch"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("a_n").to_numpy() + batch.column("b_n").to_numpy()
            left, right = (batch.column(f"{x}_sketch") for x in ("a", "b"))
            lengths = [np.diff(np.frombuffer(s.buffers()[1], np.int32)[s.offset : s.offset + len(s) + 1]) for s in (left, right)]
            apart = np.zeros(len(sizes), np.int64)
            alike = np.flatnonzero(lengths[0] == lengths[1])
            if len(alike):
                x, y = (np.frombuffer(b"".join(s.take(pa.array(alike)).to_pylist()), np.uint8) for s in (left, right))
                ends = np.cumsum(lengths[0][alike])
                apart[alike] = np.add.reduceat(np.bitwise_count(x ^ y).astype(np.int64), np.r_[0, ends[:-1]])
            for i in np.flatnonzero(lengths[0] != lengths[1]).tolist():
                x, y = (np.frombuffer(s[i].as_buffer(), np.uint8) for s in (left, right))
                length = min(len(x), len(y))
                apart[i] = np.bitwise_count(_folded(x, length) ^ _folded(y, length)).sum()
            every = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sizes, pa.int64())], ["a", "b", "n"])
            yield every.filter(pa.array((100 + percent) * apart <= (100 - percent) * sizes))

    return both.mapInArrow(run, "a long, b long, n long").distinct()


def _linked(spark: SparkSession, pairs: DataFrame, features: DataFrame, percent: int, path: str) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough: those with near sketches, compared in passes, each of which holds a part of their sets on disk.

    There are no more passes than the bytes of these sets need.
    """
    near = _near(pairs, features, percent)
    near.write.parquet(f"{path}-near")
    near, features = spark.read.schema(near.schema).parquet(f"{path}-near"), features.select("id", "features")
    both, pairs = near.agg(F.sum("n")).first()[0], near.select("a", "b")
    if both is None:
        return pairs
    passes = min(PASSES, 1 + 8 * both // PASS_BYTES)
    for k in range(passes):
        own = lambda c: F.pmod(F.xxhash64(c), F.lit(passes)) == k  # noqa: E731, B023
        _similar(pairs.where(own("a")), features.where(own("id")), features, percent).write.mode("append").parquet(path)
    return spark.read.schema(pairs.schema).parquet(path)


def _similar(pairs: DataFrame, left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    wanted = pairs.select(F.col("b").alias("id")).distinct()
    both = pairs.join(left.select(F.col("id").alias("a"), F.col("features").alias("left")), "a")
    both = both.join(right.join(wanted, "id", "left_semi").select(F.col("id").alias("b"), F.col("features").alias("right")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (left, right))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "left", "right").mapInArrow(run, "a long, b long").distinct()


def components(spark: SparkSession, edges: DataFrame, path: str) -> DataFrame:
    """(id, component): the least id that each id of (a, b) reaches, by alternating large and small stars.

    A star's least id is found by an aggregation and joined back, so a centre with very many neighbours
    is pre-aggregated and its join can be split.
    """
    current, rounds = edges, 0
    while True:
        pairs = current.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        ways = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ways.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = ways.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        down = large.where("a > b").distinct()
        least = down.groupBy("a").agg(F.min("b").alias("least"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b")))
        small.where("a <> b").distinct().write.parquet(f"{path}/stars-{rounds}")
        current = spark.read.schema(small.schema).parquet(f"{path}/stars-{rounds}")
        # Done when these are stars: who has a centre has one, and is none.
        centres = current.select(F.col("b").alias("a")).distinct()
        if current.select("a").unionByName(centres).groupBy("a").count().where("count > 1").isEmpty():
            return current.select(F.col("a").alias("id"), F.col("b").alias("component"))
        rounds += 1


def _labels(members: DataFrame, parts: DataFrame) -> DataFrame:
    return members.join(parts, "id", "left").withColumn("component", F.coalesce("component", "id"))


def link(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of the documents."""
    spark, path = docs.sparkSession, work_dir(docs.sparkSession, "jaccard")
    with short_lived_shuffles(spark), small_batches(spark, BATCH_ROWS):
        labels = _components_of_sets(spark, docs, path, size, percent, id_col, text_col)
    one = spark.read.parquet(f"{path}/nodes").select("doc_id", "n_shingles", F.coalesce("node", "doc_id").alias("id"))
    return _labels(one, labels).select("doc_id", "n_shingles", F.col("component").alias("component_id"))


def _components_of_sets(spark: SparkSession, docs: DataFrame, path: str, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    # Equal sets are one node, the least id that has it.
    sets = stored(sets_of(docs, size, id_col, text_col), "sets")
    nodes = sets.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("one", "two", "n_shingles").agg(F.min("doc_id").alias("node"))
    nodes = nodes.select(F.col("one").alias("_one"), F.col("two").alias("_two"), F.col("n_shingles").alias("_n"), "node")
    same = (F.col("one") == F.col("_one")) & (F.col("two") == F.col("_two")) & (F.col("n_shingles") == F.col("_n")) & F.col("doc_id").isNotNull()
    own = stored(sets.join(nodes, same, "left").select("doc_id", "n_shingles", "node"), "nodes")
    # An id with several texts ties their sets together.
    several = own.where("node IS NOT NULL").groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("top"), F.collect_set("node").alias("all")).where("b < top")
    tied = stored(several.select(F.explode("all").alias("a"), "b").unionByName(several.select(F.col("doc_id").alias("a"), "b")).where("a <> b"), "tied")

    firsts = own.where("doc_id = node").select(F.col("doc_id").alias(id_col)).distinct()
    signs = signatures(docs.select(id_col, text_col).join(firsts, id_col, "left_semi"), size, percent, id_col, text_col)
    shared = signs.withColumn("members", F.expr("count(1) OVER (PARTITION BY sign)")).where("members > 1")
    shared = stored(shared, "shared")
    company = shared.groupBy("id").agg(F.sum("members").alias("company"))
    order = Window.partitionBy("sign").orderBy(F.desc("company"), "id")
    ranked = stored(shared.join(company, "id").select("sign", "id", "size", F.row_number().over(order).alias("rank")), "ranked")
    wanted = ranked.select(F.col("id").alias(id_col)).distinct()
    features = stored(_full_sets(docs.select(id_col, text_col).join(wanted, id_col, "left_semi"), size, id_col, text_col), "features")

    # First everyone with one leader, that of most of its signatures; then with the others that are not in its component by then.
    leading = ranked.where("rank = 1").select("sign", F.col("id").alias("b"), F.col("size").alias("b_size"))
    led = _fitting(ranked.where("rank > 1").join(leading, "sign"), percent).groupBy("id", "b").agg(F.count(F.lit(1)).alias("n"))
    led = stored(led, "led")
    nearest = led.groupBy("id").agg(F.max_by("b", F.struct("n", "b")).alias("b"))
    nearest = stored(_sorted_pairs(nearest), "nearest-pairs")
    links = tied.unionByName(_linked(spark, nearest, features, percent, f"{path}/nearest-links"))
    parts = components(spark, links, f"{path}/components-0")
    pairs = stored(_sorted_pairs(led), "leader-pairs")
    others = _apart(pairs.join(nearest, ["a", "b"], "left_anti"), parts)
    more = _linked(spark, stored(others, "other-pairs"), features, percent, f"{path}/other-links")
    if not more.isEmpty():
        links = links.unionByName(more)
        parts = components(spark, links, f"{path}/components-1")
    # Then what signatures that still span several components hold: all pairs in them across components.
    spans = {"least": F.expr("min(component) OVER (PARTITION BY sign)"), "most": F.expr("max(component) OVER (PARTITION BY sign)"), "last": F.expr("max(rank) OVER (PARTITION BY sign)")}
    left = _labels(ranked, parts).withColumns(spans).where("least < most AND last > 2")
    left = stored(left.select("sign", "id", "size", "rank", "component", "last"), "open")
    few = left.where(F.col("last") <= MANY)
    others = few.select("sign", F.col("id").alias("b"), F.col("size").alias("b_size"), F.col("rank").alias("b_rank"), F.col("component").alias("b_component"))
    across = few.join(others, "sign").where("rank > b_rank AND b_rank > 1 AND component <> b_component")
    across = stored(_pairs(across, percent).join(pairs, ["a", "b"], "left_anti"), "pairs")
    found = _linked(spark, across, features, percent, f"{path}/links")
    crowded = stored(left.where(F.col("last") > MANY).select("id", "size", "component").distinct(), "crowded")
    if not crowded.isEmpty():
        # What these may link with otherwise is known by now; among them, whose first features meet is compared.
        meeting = stored(_meeting(crowded, _prefixes(features, _common(_counts(spark, features, f"{path}/common")), percent)), "meeting")
        few = meeting.where(F.col("last") <= MANY)
        others = few.select("sign", F.col("id").alias("b"), F.col("size").alias("b_size"), F.col("component").alias("b_component"))
        across = few.join(others, "sign").where("id > b AND component <> b_component")
        across = stored(_pairs(across, percent).join(pairs, ["a", "b"], "left_anti"), "rare-pairs")
        found = found.unionByName(_linked(spark, across, features, percent, f"{path}/rare-links"))
        many = meeting.where(F.col("last") > MANY)
        if not many.isEmpty():
            found = found.unionByName(stored(_block_links(spark, many, features, f"{path}/crowds", percent), "crowd-links"))
    return parts if found.isEmpty() else components(spark, links.unionByName(found), f"{path}/components-2")


def _counts(spark: SparkSession, features: DataFrame, path: str) -> DataFrame:
    """(feature, sets): the features that more than ``COMMON`` sets have, and how many these are. As in ``_linked``, in passes."""
    total = features.agg(F.sum("n")).first()[0] or 0
    passes = min(PASSES, 1 + 8 * total // PASS_BYTES)

    def part(k: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in blocks(batch.column("features"), BLOCK_BYTES):
                    feature = block.data.view(np.uint64)
                    yield pa.RecordBatch.from_arrays([signed(feature[feature % U64(passes) == k])], ["feature"])

        return run

    for k in range(passes):
        each = features.select("features").mapInArrow(part(k), "feature long")
        counts = each.groupBy("feature").agg(F.count(F.lit(1)).alias("sets")).where(F.col("sets") > COMMON)
        counts.write.mode("append").parquet(path)
    return spark.read.schema(counts.schema).parquet(path)


def _common(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The ``MOST_COMMON`` features that most sets have, sorted, and the sets of each."""
    most = counts.orderBy(F.desc("sets"), "feature").limit(MOST_COMMON).toArrow()
    feature, sets = most.column("feature").to_numpy().view(np.uint64), most.column("sets").to_numpy()
    order = np.argsort(feature)
    return feature[order], sets[order]


def _prefixes(features: DataFrame, common: tuple[np.ndarray, np.ndarray], percent: int) -> DataFrame:
    """(sign, id): the first features of each set, one more than may be missing from a set that it links with.

    Rare features come before common ones, and these by the number of their sets; hashes break ties. Any order
    that is the same for all sets would do: two sets that link share one of their first features.
    """
    shared = features.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sets = shared.value
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for block in blocks(batch.column("features"), BLOCK_BYTES):
                feature, edge = block.data.view(np.uint64), block.bounds // 8
                size = np.diff(edge)
                row = np.repeat(np.arange(len(block)), size)
                rank = np.zeros(len(feature), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, feature), len(known) - 1)
                    rank = np.where(known[at] == feature, sets[at], 0)
                order = np.lexsort((feature, rank, row))
                first = order[np.arange(len(feature)) - edge[row] < (size - -(-percent * size // 100) + 1)[row]]
                yield pa.RecordBatch.from_arrays([signed(feature[first]), pa.array(ids[block.first + row[first]], pa.int64())], ["sign", "id"])

    return features.select("id", "features").mapInArrow(run, "sign long, id long")


def _meeting(members: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(sign, id, size, component, last): the members whose prefixes have a feature that spans several components; last: how many meet in it."""
    shared = prefixes.withColumn("_sets", F.expr("count(1) OVER (PARTITION BY sign)")).where("_sets > 1").select("sign", "id")
    spans = {"least": F.expr("min(component) OVER (PARTITION BY sign)"), "most": F.expr("max(component) OVER (PARTITION BY sign)"), "last": F.expr("count(1) OVER (PARTITION BY sign)")}
    return shared.join(members, "id").withColumns(spans).where("least < most").select("sign", "id", "size", "component", "last")


def _fitting(joined: DataFrame, percent: int) -> DataFrame:
    """The rows whose sizes allow a link."""
    return joined.where(100 * F.least("size", "b_size") >= percent * F.greatest("size", "b_size"))


def _sorted_pairs(found: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), the greater id first."""
    return found.select(F.greatest("id", "b").alias("a"), F.least("id", "b").alias("b")).distinct()


def _pairs(joined: DataFrame, percent: int) -> DataFrame:
    return _sorted_pairs(_fitting(joined, percent))


def _apart(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs (a, b) that are not in one component."""
    for name in ("a", "b"):
        known = parts.select(F.col("id").alias(name), F.col("component").alias(f"{name}_part"))
        pairs = pairs.join(known, name, "left").withColumn(f"{name}_part", F.coalesce(f"{name}_part", name))
    return pairs.where("a_part <> b_part").select("a", "b")


def _block_links(spark: SparkSession, many: DataFrame, features: DataFrame, path: str, percent: int) -> DataFrame:
    """Links among the members of crowded prefix features, compared block by block.

    Features of one level (the greatest band of their members) with members in common are one crowd, so
    that its sizes lie in two bands. Its members are dealt to blocks of about ``BLOCK``,
    and a task compares two blocks; it returns links that connect what is connected, not all of them.
    """
    low = Bands(percent, many.agg(F.max("size")).first()[0]).low
    banded = many.withColumn("band", F.size(F.filter(F.array(*map(F.lit, low)), lambda x: x <= F.col("size"))))
    first = banded.groupBy("sign").agg(F.max("band").alias("level"), F.min("id").alias("b"))
    node = lambda x: F.xxhash64(x, "level")
    keyed = many.join(first, "sign").select("id", "b", "level", F.col("component").alias("part"))
    crowds = components(spark, keyed.select(node("id").alias("a"), node("b").alias("b")), path)
    members = _labels(keyed.select(F.col("id").alias("doc"), "part", node("id").alias("id")).distinct(), crowds)
    members = members.select(F.col("doc").alias("id"), "part", F.col("component").alias("crowd"))

    def near(key: tuple, table: pa.Table) -> pa.Table:
        ids, part, n, block = (table.column(c).to_numpy() for c in ("id", "part", "n", "block"))
        sketches = [np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("sketch")]
        lengths = np.array([len(x) for x in sketches])
        wanted = np.zeros(len(ids), bool)
        for length in np.unique(lengths).tolist():
            # Sets that may link have sketches of one length, or of one and its double.
            some = np.flatnonzero((lengths == length) | (lengths == 2 * length))
            packed = np.stack([_folded(sketches[i], length) for i in some]).view(np.uint64)
            for i, x in enumerate(some.tolist()):
                apart = np.bitwise_count(packed ^ packed[i]).sum(1, dtype=np.int64)
                close = ((100 + percent) * apart <= (100 - percent) * (n[some] + n[x])) & (part[some] != part[x])
                if key[1] != key[2]:
                    close &= block[some] != block[x]
                wanted[x] |= close.any()
        return pa.table([pa.array(ids[wanted], pa.int64()), pa.array(np.full(wanted.sum(), key[0].as_py()), pa.int64())], ["id", "crowd"])

    # First by sketches: who is near anyone of another component. Only these are read in full.
    found = _in_blocks(members, features.select("id", "n", "sketch")).applyInArrow(near, "id long, crowd long").distinct()
    found.write.parquet(f"{path}-near")
    members = members.join(spark.read.parquet(f"{path}-near"), ["id", "crowd"], "left_semi")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids, block = table.column("id").to_numpy(), table.column("block").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("features")]
        counts = np.array([len(x) for x in sets])
        every, number, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), counts)
        shared = times[number] > 1
        owner, column = owner[shared], (np.cumsum(times > 1) - 1)[number[shared]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        common = np.zeros((len(sets), len(sets)), np.float32)
        for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            low, high = np.searchsorted(column, [start, start + 4096])
            part = np.zeros((len(sets), 4096), np.float32)
            part[owner[low:high], column[low:high] - start] = 1
            common += part @ part.T
        close = 100 * common >= percent * (counts[:, None] + counts[None, :] - common)
        if key[1] != key[2]:
            close &= block[:, None] != block[None, :]
        top = list(range(len(sets)))

        def find(x: int) -> int:
            while top[x] != x:
                top[x] = x = top[top[x]]
            return x

        out = []
        for x, y in np.argwhere(np.triu(close, 1)).tolist():
            p, q = find(x), find(y)
            if p != q:
                top[p] = q
                out.append((max(ids[x], ids[y]), min(ids[x], ids[y])))
        return pa.table([pa.array([int(x[i]) for x in out], pa.int64()) for i in (0, 1)], ["a", "b"])

    return _in_blocks(members, features.select("id", "features")).applyInArrow(run, "a long, b long")


def _in_blocks(members: DataFrame, sets: DataFrame) -> GroupedData:
    """Members of crowds in blocks of about ``BLOCK``: each goes to the pairs of its own block with each block of its crowd.

    Pairs of blocks are dealt to all partitions whatever their bytes, as the work is in comparing.
    """
    sizes = members.groupBy("crowd").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    dealt = members.join(sizes, "crowd").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("id", "part", "crowd", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    key, partitions = ["crowd", "low", "high"], int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.join(sets, "id").repartition(partitions, *key).groupBy(*key)


def keep_first(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document with the least id of each component, as it is; rows with null ids stay."""
    firsts = link(docs, size, percent, id_col, text_col).where("doc_id = component_id").select(F.col("doc_id").alias("_first")).distinct()
    kept = docs.join(firsts, F.col(id_col).cast("long") == F.col("_first"), "left_semi")
    return kept.unionByName(docs.where(F.col(id_col).isNull())).select(docs.columns)
