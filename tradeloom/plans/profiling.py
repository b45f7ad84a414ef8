"""Column profiles of tables and of folders of CSV files."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import percent
from ..operators.columns import column_counts, column_sketches, first_values, sketch_counts
from ..session import small_frame
from ..sources.files import discover, file_name, read_inferred
from .quality import union

SAMPLES = 3
TYPE_SAMPLES = 100

PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("total_columns", T.IntegerType()),
        T.StructField("column", T.StringType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("dtype", T.StringType()),
        T.StructField("non_null_count", T.LongType()),
        T.StructField("null_count", T.LongType()),
        T.StructField("null_pct", T.DoubleType()),
        T.StructField("unique_count", T.LongType()),
        T.StructField("sample_values", T.ArrayType(T.StringType())),
        T.StructField("suggested_type", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


def _declared(df: DataFrame) -> DataFrame:
    """(position, column, dtype) of the declared columns."""
    fields = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return small_frame(df.sparkSession, fields, "position int, column string, dtype string")


def _suggestion(dtype: Column, all_dates: Column, all_numbers: Column) -> Column:
    """Text that parses throughout is a datetime or a number; numbers are numeric; an all-NULL
    column counts as numeric; any other type keeps its own name."""
    text = F.when(all_dates.isNull(), "numeric").when(all_dates, "datetime").when(all_numbers, "numeric")
    return (
        F.when(dtype == "string", text.otherwise("string"))
        .when(dtype.rlike("^(tinyint|smallint|int|bigint|float|double|decimal.*)$"), "numeric")
        .when(dtype.isin("timestamp", "timestamp_ntz", "date"), "datetime")
        .otherwise(dtype)
    )


def column_samples(df: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """Per column: the first three values and whether the first hundred all parse.

    At most a hundred values per column reach this aggregate.
    """
    value = F.col("value")
    kept = F.when(F.col("nth") <= SAMPLES, F.struct("nth", "value"))
    return (
        first_values(df, TYPE_SAMPLES, order_by)
        .groupBy("column")
        .agg(
            F.transform(F.array_sort(F.collect_list(kept)), lambda s: s["value"]).alias("sample_values"),
            F.bool_and(value.try_cast("timestamp_ntz").isNotNull()).alias("all_dates"),
            F.bool_and(value.try_cast("double").isNotNull()).alias("all_numbers"),
        )
    )


def suggested_types(df: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """(column, dtype, suggested_type) from the first hundred values of each column."""
    return _declared(df).join(column_samples(df, order_by), "column", "left").select(
        "column", "dtype", _suggestion(F.col("dtype"), F.col("all_dates"), F.col("all_numbers")).alias("suggested_type")
    )


def sample_values(df: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """(column, nth, value): the first three non-NULL values of every column."""
    return first_values(df, SAMPLES, order_by).select("column", "nth", "value")


def profile(df: DataFrame, name: str, order_by: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """One row per column with counts, samples and a suggested type.

    ``approximate`` estimates the distinct counts by sketches, with a standard error of 0.8 %: no value is shuffled.
    """
    nulls = F.col("total_rows") - F.col("non_null_count")
    counts = sketch_counts(column_sketches(df)) if approximate else column_counts(df)
    joined = _declared(df).join(counts, "column", "left").join(column_samples(df, order_by), "column", "left")
    return joined.select(
        F.lit(name).alias("file_name"),
        "total_rows",
        F.lit(len(df.columns)).alias("total_columns"),
        "column",
        "position",
        "dtype",
        "non_null_count",
        nulls.alias("null_count"),
        percent(nulls, F.col("total_rows"), 1).cast("double").alias("null_pct"),
        "unique_count",
        F.coalesce("sample_values", F.array().cast("array<string>")).alias("sample_values"),
        _suggestion(F.col("dtype"), F.col("all_dates"), F.col("all_numbers")).alias("suggested_type"),
        F.lit(None).cast("string").alias("error"),
    )


def profile_failure(spark: SparkSession, name: str, error: Exception) -> DataFrame:
    """The single row of a file that could not be read."""
    known = {"file_name": name, "error": str(error)}
    return small_frame(spark, [tuple(known.get(n) for n in PROFILE_SCHEMA.names)], PROFILE_SCHEMA)


def profile_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Profiles of CSV files; a file that fails gives one row with its error."""
    parts = []
    for path in paths:
        try:
            parts.append(profile(read_inferred(spark, path), file_name(path)))
        except (PySparkException, ValueError) as error:
            parts.append(profile_failure(spark, file_name(path), error))
    return union(parts) if parts else small_frame(spark, [], PROFILE_SCHEMA)


def profile_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles of every CSV file of a folder."""
    return profile_files(spark, discover(spark, folder))


def profile_summary(profiles: DataFrame) -> DataFrame:
    """(total_files, successful_files, total_columns, total_rows) over profiles."""
    files = profiles.groupBy("file_name").agg(
        F.max(F.col("error").isNull()).alias("ok"), F.max("total_columns").alias("columns"),
        F.max("total_rows").alias("rows"),
    )
    return files.agg(
        F.count("*").alias("total_files"),
        F.count_if("ok").alias("successful_files"),
        F.coalesce(F.sum("columns"), F.lit(0)).alias("total_columns"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
    )


def write_profile_json(profiles: DataFrame, path: str) -> None:
    """One JSON object per file with its columns nested in file order."""
    details = F.struct(
        "position", "column", "dtype", "non_null_count", "null_count", "null_pct", "unique_count", "sample_values",
        "suggested_type",
    )
    nested = profiles.groupBy("file_name", "total_rows", "total_columns", "error").agg(
        F.array_sort(F.collect_list(F.when(F.col("column").isNotNull(), details))).alias("columns")
    )
    nested.write.mode("overwrite").json(path)
