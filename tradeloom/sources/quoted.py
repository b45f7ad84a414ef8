"""Quoted CSV read in splits, although values may hold line breaks.

Spark's own reader takes a file with line breaks in values whole, in one task. Here the file is read as lines, in
splits, and a line is seen as a function of whether it begins inside a quoted value: it ends inside or outside.
These functions compose like numbers add, so a first scan composes those of each split, a prefix over the few splits
of a file tells which ones begin inside a value, and a second scan lets every split put its own records together.
The one record that a split border may cut is joined from the pieces that the first scan kept, however many splits
it crosses. Records are then parsed by the JVM's CSV parser, with the same rules and results as a whole-file read.

Lines end in LF or CRLF, empty ones are passed over, and a value keeps the line breaks it has. A quote opens a value only at its start, and a
doubled one stands for itself; text after a closing quote belongs to the value, up to the next comma. The one
broadcast has a row for each split: a millionth of the input. Both scans must see the same splits; should they change
between the scans (by another number of cores, say), the read fails and can be repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship, work_dir

#: A whole value or none, before a comma: quoted, or not beginning with a quote.
_VALUE = r'(?:"(?:[^"]|"")*"(?:[^",][^,]*)?|[^",][^,]*|)'
_OPEN = r'"(?:[^"]|"")*$'
#: The line ends inside a value if it begins outside one.
FROM_OUTSIDE = rf"^(?:{_VALUE},)*{_OPEN}"
#: The line ends inside a value if it begins inside one: it does not end that value, or begins another.
FROM_INSIDE = rf'^(?:[^"]|"")*(?:$|"(?:[^",][^,]*)?,(?:{_VALUE},)*{_OPEN})'


def _ends(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line ends inside a value, if it begins outside, and if it begins inside."""
    outside, inside = np.zeros(len(lines), bool), np.ones(len(lines), bool)
    quotes = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    if len(quotes):
        some = lines.take(pa.array(quotes))
        outside[quotes] = pc.match_substring_regex(some, FROM_OUTSIDE).to_numpy(zero_copy_only=False)
        inside[quotes] = pc.match_substring_regex(some, FROM_INSIDE).to_numpy(zero_copy_only=False)
    return outside, inside


def _states(outside: np.ndarray, inside: np.ndarray, begin: bool) -> np.ndarray:
    """Whether a value is open before each line, and after the last one."""
    flips = np.cumsum(outside & ~inside)
    fixed = np.maximum.accumulate(np.where(outside == inside, np.arange(len(outside)), -1))
    since = np.where(fixed >= 0, flips - flips[fixed], flips) % 2 == 1
    return np.r_[begin, np.where(fixed >= 0, outside[fixed], begin) ^ since]


def _filled(lines: pa.Array, chosen: np.ndarray) -> bool:
    """Whether any chosen line is more than a line end."""
    sizes = pc.binary_length(lines).to_numpy(zero_copy_only=False)
    return bool((chosen & (sizes > 1)).any()) or any(lines[i].as_py() not in (b"", b"\r") for i in np.flatnonzero(chosen & (sizes == 1)).tolist())


class _Split:
    """The lines of one split so far, for one assumption about how it begins."""

    def __init__(self, inside: bool):
        self.inside = inside  # now
        self.head = inside  # the first record began in an earlier split
        self.pieces: list[bytes] = []  # of the record that is open, or of the head
        self.whole_head: bytes | None = None
        self.any = False  # a record has ended that began here

    def add(self, lines: pa.Array, ends: tuple[np.ndarray, np.ndarray], keep: bool) -> pa.Array | None:
        """The records that end among these lines, if they are to be kept."""
        states = _states(*ends, self.inside)
        before, after = states[:-1], states[1:]
        alone = ~before & ~after
        joined, at = [], []
        for i in np.flatnonzero(~alone).tolist():
            self.pieces.append(lines[i].as_py())
            if not after[i]:
                if self.head:
                    self.whole_head, self.head = b"\n".join(self.pieces), False
                else:
                    self.any = True
                    if keep:
                        joined.append(b"\n".join(self.pieces))
                        at.append(i)
                self.pieces = []
        self.any = self.any or _filled(lines, alone)
        self.inside = bool(states[-1])
        if not keep:
            return None
        single = np.flatnonzero(alone)
        if not at:
            return lines.take(pa.array(single)) if len(single) < len(lines) else lines
        both = pa.concat_arrays([lines.take(pa.array(single)), pa.array(joined, lines.type)])
        return both.take(pa.array(np.argsort(np.r_[single, at], kind="stable")))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool | None, pa.Array]]:
    """(split, inside, lines): stretches of lines of one split, in order. A split is its file, start and length."""
    for batch in batches:
        files, starts, sizes = (batch.column(c) for c in ("file", "start", "size"))
        codes = files.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        changed = [np.r_[True, x[1:] != x[:-1]] for x in (codes, starts.to_numpy(zero_copy_only=False))]
        cuts = np.flatnonzero(changed[0] | changed[1]).tolist() if len(batch) else []
        for low, high in zip(cuts, [*cuts[1:], len(batch)], strict=True):
            split = (files[low].as_py(), starts[low].as_py(), sizes[low].as_py())
            inside = batch.column("inside")[low].as_py() if "inside" in batch.schema.names else None
            yield split, inside, batch.column("line").slice(low, high - low)


MARKS = "file string, start long, size long, out_out boolean, in_in boolean, out_any boolean, out_tail binary, in_head binary, in_tail binary"


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a split: how it ends and what it has of cut records, for either assumption.

    ``out_out``: it ends outside if it begins outside. ``out_any``: then a whole record ends in it. ``in_head``:
    the lines up to the end of the value that was open, null if it does not end here.
    """
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in MARKS.split(", "))])
    key, both = None, None

    def row() -> pa.RecordBatch:
        out, within = both
        tail = lambda s: b"\n".join(s.pieces) if s.inside else None
        values = [*key, not out.inside, within.inside, out.any, tail(out), within.whole_head, tail(within)]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

    for split, _, lines in _runs(batches):
        if split != key:
            if key is not None:
                yield row()
            key, both = split, (_Split(False), _Split(True))
        ends = _ends(lines)
        for one in both:
            one.add(lines, ends, keep=False)
    if key is not None:
        yield row()


def _assembler(whole_files: bool):
    """The records that begin and end in a split; ``first`` is the first of a file. A file in one split also ends its last record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, split, none_yet = None, None, True

        def out(records: pa.Array) -> Iterator[pa.RecordBatch]:
            nonlocal none_yet
            empty = pc.or_(pc.equal(records, b""), pc.equal(records, b"\r"))
            records = records.filter(pc.invert(empty))
            if len(records):
                first = np.zeros(len(records), bool)
                first[0], none_yet = none_yet, False
                yield pa.RecordBatch.from_arrays([pa.array([key[0]] * len(records), pa.string()), records, pa.array(first)], ["file", "record", "first"])

        def end() -> Iterator[pa.RecordBatch]:
            if whole_files and split is not None and split.pieces:
                yield from out(pa.array([b"\n".join(split.pieces)], pa.binary()))

        for at, inside, lines in _runs(batches):
            if at != key:
                yield from end()
                if inside is None and not (whole_files and at[1] == 0):
                    raise ValueError(f"the splits of {at[0]} changed while it was read")
                key, split, none_yet = at, _Split(bool(inside)), at[1] == 0
            yield from out(split.add(lines, _ends(lines), keep=True))
        yield from end()

    return run


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, size, line): every line with its split; a byte order mark goes."""
    read = spark.read.option("lineSep", "\n").text(path)
    file, start, size = (F.col(f"_metadata.file_{x}") for x in ("path", "block_start", "block_length"))
    line = F.when(start == 0, F.regexp_replace("value", r"\A\uFEFF", "")).otherwise(F.col("value"))
    return read.select(file.alias("file"), start.alias("start"), size.alias("size"), line.cast("binary").alias("line"))


def _begins_inside(marks: DataFrame) -> DataFrame:
    """Splits with ``inside``, whether they begin inside a value: the functions of the file's earlier splits, composed."""
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    flips = ~F.col("out_out") & ~F.col("in_in")
    fixed = F.col("out_out") != F.col("in_in")  # ends the same way however it begins
    sums = marks.withColumn("_flips", F.coalesce(F.sum(flips.cast("int")).over(earlier), F.lit(0)))
    last = F.last(F.when(fixed, F.struct(F.col("in_in").alias("to"), F.col("_flips").alias("at"))), ignorenulls=True).over(earlier)
    sums = sums.withColumn("_last", last)
    inside = (F.coalesce("_last.to", F.lit(False)).cast("int") + F.col("_flips") - F.coalesce("_last.at", F.lit(0))) % 2 == 1
    return sums.withColumn("inside", inside).drop("_flips", "_last")


def _cut_records(splits: DataFrame) -> DataFrame:
    """(file, record, first): the records that cross a border, joined from their pieces."""
    tail = F.when(F.col("inside"), F.col("in_tail")).otherwise(F.col("out_tail"))
    # A split within one value has it all as its tail; otherwise its head ends a value and its tail begins one.
    through = F.col("inside") & F.col("in_head").isNull()
    leads = (F.col("start") == 0) & ~F.col("out_any")  # nothing before it in its file
    piece = lambda nth, begins, text: F.struct(F.lit(nth).alias("nth"), begins.alias("begins"), text.alias("text"))
    head = piece(0, F.lit(False), F.when(through, F.col("in_tail")).when(F.col("inside"), F.col("in_head")))
    pieces = splits.select("file", "start", leads.alias("leads"), F.explode(F.array(head, piece(1, ~through, F.when(~through, tail)))).alias("p"))
    pieces = pieces.where("p.text IS NOT NULL").select("file", "start", "leads", "p.*")
    order = Window.partitionBy("file").orderBy("start", "nth")
    numbered = pieces.withColumn("_record", F.sum(F.col("begins").cast("int")).over(order))
    texts = F.array_sort(F.collect_list(F.struct("start", "nth", F.col("text").cast("string").alias("text"))))
    whole = numbered.groupBy("file", "_record").agg(texts.alias("x"), F.bool_or(F.col("begins") & F.col("leads")).alias("first"))
    return whole.select("file", F.array_join("x.text", "\n").cast("binary").alias("record"), "first")


def _smallest_split(spark: SparkSession) -> int:
    """No split that ends before its file is shorter than this."""
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    return min(size(spark.conf.get(f"spark.sql.files.{x}")) for x in ("maxPartitionBytes", "openCostInBytes"))


def _largest(spark: SparkSession, path: str) -> int:
    """The length of the largest file of a path."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return max((s.getLen() for s in system.listStatus(root)), default=0)


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, first): every CSV record of a file or folder as one text, without its line end; ``first`` is the first record of a file.

    Files too short to be split begin outside a value, and the first scan is not needed.
    """
    ship(spark)
    lines, schema = _lines(spark, path), "file string, record binary, first boolean"
    if _largest(spark, path) <= _smallest_split(spark):
        found = lines.mapInArrow(_assembler(True), schema)
    else:
        folder = work_dir(spark, "quoted-csv")
        lines.mapInArrow(_mark, MARKS).write.parquet(folder)
        splits = _begins_inside(spark.read.parquet(folder))
        begin = splits.select("file", "start", "size", "inside")
        known = lines.join(F.broadcast(begin), ["file", "start", "size"], "left")
        found = known.mapInArrow(_assembler(False), schema).unionByName(_cut_records(splits))
    return found.select("file", F.regexp_replace(F.col("record").cast("string"), r"\r\z", "").alias("record"), "first")
