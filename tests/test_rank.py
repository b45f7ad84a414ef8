"""Ranks over all rows without a task that holds them all."""

import datetime as dt
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradeloom.operators.ordered import with_rank


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("bits", [2, 10])
def test_like_sql(spark, descending, bits):
    """Ties, a value of a third of all rows, NULL, NaN, infinities and both zeros."""
    special = F.element_at(F.array(*map(F.lit, [float("nan"), float("inf"), -float("inf"), 0.0, -0.0])), F.pmod("id", F.lit(5)).cast("int") + 1)
    value = F.when(F.col("id") % 3 == 0, 7.5).when(F.col("id") % 17 == 0, None).when(F.col("id") % 19 == 0, special)
    df = spark.range(5000).select("id", value.otherwise(F.pmod(F.hash("id"), F.lit(900)) / 8.0).alias("v"))
    order = F.desc_nulls_first("v") if descending else F.asc_nulls_first("v")
    want = df.withColumn("r", F.rank().over(Window.orderBy(order)).cast("bigint"))
    got = with_rank(df, "v", "r", descending, bits)
    assert got.columns == ["id", "v", "r"]
    assert {r.id: r.r for r in got.collect()} == {r.id: r.r for r in want.collect()}


def test_no_unpartitioned_window(spark):
    plan = with_rank(spark.range(100).withColumn("v", F.col("id") % 7), "v", "r")._jdf.queryExecution().optimizedPlan().toString()
    windows = re.findall(r"Window \[.*", plan)
    assert windows and all("[_place" in w for w in windows)


@pytest.mark.parametrize("rows, want", [([], {}), ([(None,)] * 2, {None: 1}), ([("b",), ("a",), ("b",)], {"b": 1, "a": 3})])
def test_edges(spark, rows, want):
    """Empty tables and texts; columns called like those used inside come back as they were."""
    df = spark.createDataFrame(rows, "`_value` string")
    assert {r["_value"]: r.r for r in with_rank(df, "_value", "r").collect()} == want
    day = spark.createDataFrame([(dt.date(2020, 1, 2), 1), (dt.date(2020, 1, 1), 2)], "d date, `_place` int")
    assert {(r.d.day, r._place, r.r) for r in with_rank(day, "d", "r").collect()} == {(2, 1, 1), (1, 2, 2)}
