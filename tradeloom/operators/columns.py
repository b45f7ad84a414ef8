"""Per-column operators: counts and first values of every column of a table."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship

NESTED = (T.ArrayType, T.MapType, T.StructType)


def _column(field: T.StructField) -> Column:
    return F.col(f"`{field.name}`")


def text_value(field: T.StructField) -> Column:
    """The value as text."""
    c = _column(field)
    if isinstance(field.dataType, NESTED):
        return F.when(c.isNotNull(), F.to_json(F.struct(c.alias("v"))))
    return F.base64(c) if isinstance(field.dataType, T.BinaryType) else c.cast("string")


def _countable(field: T.StructField) -> tuple[str, Column]:
    """A common type, and the value in it such that equal means equal.

    Every text becomes the SHA-256 of the whole text, so that long ones shuffle no more than short ones.
    """
    c = _column(field)
    if isinstance(field.dataType, T.IntegralType):
        return "bigint", c.cast("bigint")
    if isinstance(field.dataType, T.FractionalType) and not isinstance(field.dataType, T.DecimalType):
        return "double", c.cast("double")
    if isinstance(field.dataType, (T.StringType, T.BinaryType, *NESTED)):
        return "string", F.sha2(text_value(field).cast("binary"), 256)
    return field.dataType.simpleString(), c


def column_counts(df: DataFrame) -> DataFrame:
    """Per column: rows, non-NULL values and distinct non-NULL values.

    Columns of one type are unpivoted together and counted in one grouping; as each type reads
    just its own columns, the table is still read once. Repeated values meet before the shuffle.
    """
    kinds: dict[str, list[Column]] = {}
    for field in df.schema.fields:
        kind, value = _countable(field)
        kinds.setdefault(kind, []).append(value.alias(field.name))
    parts = [
        df.select(*values)
        .unpivot([], "*", "column", "value")
        .groupBy("column")
        .agg(
            F.count("*").alias("total_rows"),
            F.count("value").alias("non_null_count"),
            F.count_distinct("value").alias("unique_count"),
        )
        for values in kinds.values()
    ]
    # Every column is in one part only; saying so lets a caller that drops the counts skip them.
    counts = [F.max(c).alias(c) for c in ("total_rows", "non_null_count", "unique_count")]
    return reduce(DataFrame.unionAll, parts).groupBy("column").agg(*counts)


#: Registers of a sketch, as a power of two: 16 kB a column, a standard error of 0.8 %.
SKETCH_BITS = 14


def _sketchable(field: T.StructField) -> Column:
    """The value as text, the two zeros as one."""
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return F.when(_column(field) == 0, F.lit(0.0)).otherwise(_column(field)).cast("string")
    return text_value(field)


def column_sketches(df: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """(file, column, total_rows, non_null_count, sketch) of each input file and column.

    One scan; a task hands on one sketch for each of its files and columns, whatever the rows. Sketches
    can be stored, and those of later files united with them: nothing is scanned again. Rows that
    come from no file have the empty file name.
    """
    values = [_sketchable(f).alias(f"_{i}") for i, f in enumerate(df.schema.fields)]
    parts = [
        F.struct(
            F.lit(name).alias("column"),
            F.count("*").alias("total_rows"),
            F.count(f"_{i}").alias("non_null_count"),
            F.hll_sketch_agg(f"_{i}", F.lit(bits)).alias("sketch"),
        )
        for i, name in enumerate(df.columns)
    ]
    per_file = df.select(F.input_file_name().alias("file"), *values).groupBy("file").agg(F.array(*parts).alias("parts"))
    return per_file.select("file", F.inline("parts"))


def sketch_counts(sketches: DataFrame) -> DataFrame:
    """The counts of ``column_counts`` from sketches; ``unique_count`` is an estimate."""
    return sketches.groupBy("column").agg(
        F.sum("total_rows").alias("total_rows"),
        F.sum("non_null_count").alias("non_null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_count"),
    )


def _sort_keys(df: DataFrame, order_by: list[str] | None) -> list[Column]:
    """Columns whose ascending order, NULL first, is that of the input files or of ``order_by``."""
    if not order_by:
        # Inside a task the numbers grow in the order in which the rows of a block are read.
        file, number = [F.input_file_name(), F.input_file_block_start()], F.monotonically_increasing_id()
        try:
            df.select(*file)
        except AnalysisException:  # rows joined from several sources have no file
            return [number]
        return [*file, number]
    keys = []
    for name in order_by:
        if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
            keys.append(F.isnan(F.col(f"`{name}`")) & F.col(f"`{name}`").isNotNull())
        keys.append(F.col(f"`{name}`"))
    return keys


def _whole(table: pa.Table) -> list[pa.Array]:
    """Each column as one array; the tables here hold at least one row."""
    return [pa.concat_arrays(column.chunks) for column in table.columns]


def _heads(k: int, keys: int):
    """Arrow batches to the first k values of each column of a task, merged batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, pa.Table] = {}
        names = [f"_k{i}" for i in range(keys)]
        order = [(name, "ascending") for name in names]
        for batch in batches:
            table = pa.Table.from_batches([batch])
            # Sorted once a batch, by the keys alone; a column takes its first values from that order.
            places = pc.sort_indices(table.select(names), sort_keys=order, null_placement="at_start")
            for c in range(table.num_columns - keys):
                values = table.column(keys + c)
                chosen = places.filter(values.is_valid().take(places))[:k]
                if not len(chosen):
                    continue
                head = table.select([*names, f"_v{c}"]).take(chosen).rename_columns([*names, "value"])
                if c in best:
                    head = pa.concat_tables([best[c], head]).combine_chunks()
                    head = head.take(pc.sort_indices(head.select(names), sort_keys=order, null_placement="at_start")[:k])
                best[c] = head
        for c, head in best.items():
            # Made anew, as all batches of a stream must agree on what may be NULL.
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(head), c, np.int32)), *_whole(head)], ["column", *names, "value"])

    return run


#: Lots in which the tasks' first values meet before those of a column meet in one task.
LOTS = 256


def first_values(df: DataFrame, k: int, order_by: list[str] | None = None) -> DataFrame:
    """(column, value, nth): the first k non-NULL values of every column, as text.

    The order is that of ``order_by``, or of the input files: by name, block and place in the block. One
    scan serves all columns: a task keeps the k first values of each, and only those leave it. They meet in
    ``LOTS`` lots and then by column, so that no task gets more than ``LOTS * k`` values however many
    tasks there were. Rows of equal ``order_by`` come in any order; without files and without
    ``order_by`` the order is that of the partitions.
    """
    keys = _sort_keys(df, order_by)
    names = [f"_k{i}" for i in range(len(keys))]
    fields = df.schema.fields
    ship(df.sparkSession)
    cells = df.select(
        *[key.alias(name) for key, name in zip(keys, names, strict=True)],
        *[text_value(f).alias(f"_v{i}") for i, f in enumerate(fields)],
    )
    kinds = ", ".join(f"{name} {cells.schema[name].dataType.simpleString()}" for name in names)
    heads = cells.mapInArrow(_heads(k, len(keys)), f"column int, {kinds}, value string")
    lot = F.pmod(F.spark_partition_id(), F.lit(LOTS))
    for group in (["column", "_lot"], ["column"]):
        place = F.row_number().over(Window.partitionBy(*group).orderBy(*names))
        heads = (heads.withColumn("_lot", lot) if "_lot" in group else heads).withColumn("nth", place).where(F.col("nth") <= k)
    labels = F.array(*[F.lit(f.name) for f in fields]).cast("array<string>")
    return heads.select(F.get(labels, F.col("column")).alias("column"), "value", "nth")
