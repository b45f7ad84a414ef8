"""The first values of all columns in one scan."""

import pytest
from pyspark.sql import functions as F

from tradeloom.operators.columns import first_values


def by_column(df):
    found = {}
    for r in df.orderBy("column", "nth").collect():
        found.setdefault(r.column, []).append(r.value)
    return found


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Three files read in the order of their names; values of ``late`` stand in the last one only."""
    path = tmp_path_factory.mktemp("first")
    for n in range(3):
        rows = [f"{n * 1000 + i},{'x' if n == 2 and i > 900 else ''},{'' if i % 2 else i}" for i in range(1000)]
        (path / f"part-{n}.csv").write_text("\n".join(["id,late,even", *rows]) + "\n")
    return str(path)


def test_file_order_in_one_scan(spark, folder):
    df = spark.read.csv(folder, header=True, schema="id int, late string, even int")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    try:
        got = first_values(df, 5)
        assert not tracker.getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert by_column(got) == {"id": ["0", "1", "2", "3", "4"], "late": ["x"] * 5, "even": ["0", "2", "4", "6", "8"]}


def test_like_a_sort(spark):
    """Any number of tasks and batches gives what sorting each column gives: NULL and NaN in their places."""
    df = spark.range(3000, numPartitions=7).select(
        F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 13 == 0, float("nan")).otherwise(F.pmod(F.hash("id"), F.lit(9999)) / 7.0).alias("key"),
        "id",
        F.when(F.col("id") % 5 > 0, F.col("id")).alias("some"),
        F.lit(None).cast("string").alias("none"),
        F.array("id").alias("a.b"),
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        got = by_column(first_values(df, 700, ["key", "id"]))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {"id": df.select("key", "id"), "some": df.where("some IS NOT NULL").select("key", "id")}
    for column, rows in want.items():
        assert got[column] == [str(r.id) for r in rows.orderBy("key", "id").limit(700).collect()]
    assert "none" not in got and got["a.b"][0] == '{"v":[0]}'


def test_edges(spark):
    assert by_column(first_values(spark.createDataFrame([], "a int"), 3)) == {}
    df = spark.createDataFrame([(1, "x"), (None, None), (2, "y")], "`_k0` int, `value` string").coalesce(1)
    assert by_column(first_values(df, 1)) == {"_k0": ["1"], "value": ["x"]}
    joined = spark.range(3).join(spark.range(3).withColumn("b", F.col("id") * 2), "id")
    assert sorted(by_column(first_values(joined, 9))["b"]) == ["0", "2", "4"]
