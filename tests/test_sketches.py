"""Distinct counts from mergeable sketches."""

import pytest
from pyspark.sql import functions as F

from tradeloom.operators.columns import column_counts, column_sketches, sketch_counts
from tradeloom.plans import profiling


def rows(spark, start, stop):
    return spark.range(start, stop, 1, 3).select(
        "id",
        (F.col("id") % 700).cast("double").alias("price"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("name "), F.col("id") % 9000)).alias("some name"),
        F.when(F.col("id") % 2 == 0, F.lit(-0.0)).otherwise(F.lit(0.0)).alias("zero"),
        F.lit(None).cast("string").alias("nothing"),
    )


def test_estimates_are_near_and_other_counts_exact(spark):
    df = rows(spark, 0, 40000)
    exact = {r["column"]: r for r in column_counts(df).collect()}
    got = {r["column"]: r for r in sketch_counts(column_sketches(df)).collect()}
    assert set(got) == set(exact) == set(df.columns)
    for name, r in got.items():
        assert (r["total_rows"], r["non_null_count"]) == (exact[name]["total_rows"], exact[name]["non_null_count"])
        assert r["unique_count"] == pytest.approx(exact[name]["unique_count"], rel=0.032)
    assert got["zero"]["unique_count"] == 1 and got["nothing"]["unique_count"] == 0


def test_stored_sketches_unite_with_those_of_later_files(spark, tmp_path):
    first, later, store = (str(tmp_path / n) for n in ("first", "later", "store"))
    rows(spark, 0, 20000).write.parquet(first)
    column_sketches(spark.read.parquet(first)).write.parquet(store)
    rows(spark, 10000, 40000).write.parquet(later)
    column_sketches(spark.read.parquet(later)).write.mode("append").parquet(store)
    kept = spark.read.parquet(store)
    assert kept.select("file").distinct().count() > 2
    united = sorted(map(tuple, sketch_counts(kept).collect()))
    assert united == sorted(map(tuple, sketch_counts(column_sketches(spark.read.parquet(first, later))).collect()))


def test_profile_with_estimates(spark):
    df = rows(spark, 0, 3000)
    exact, got = (profiling.profile(df, "x", ["id"], approximate=a).drop("unique_count").collect() for a in (False, True))
    assert sorted(map(str, exact)) == sorted(map(str, got))


def test_no_rows(spark):
    assert sketch_counts(column_sketches(rows(spark, 0, 0))).collect() == []
