import datetime as dt

import pytest
from pyspark.sql import functions as F

from tradeloom.functions import casting
from tradeloom.functions.expressions import elapsed_days, percent, pretty_size
from tradeloom.sources.files import clean


def cast(spark, rule, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("v"))).collect()]


@pytest.mark.parametrize(
    ("rule", "values", "expected"),
    [
        (casting.as_text, ["01037", "nan", "NA", "", None, "None", " x"], ["01037", None, None, None, None, None, " x"]),
        (
            casting.as_int,
            ["4", "4.7", "-4.7", " 12 ", "abc", "", None, "1e3", "9007199254740993", "1d", "inf", "99999999999999999999"],
            [4, 4, -4, 12, 0, 0, 0, 1000, 9007199254740993, 0, 0, 0],
        ),
        (
            casting.as_float,
            ["1.5", ".5", "5.", "-2", "1e-2", "1d", "2.5f", "nan", "x", "", None, "1,5"],
            [1.5, 0.5, 5.0, -2.0, 0.01, None, None, None, None, None, None, None],
        ),
        (
            casting.as_datetime,
            ["2018-01-02 03:04:05", "2018-01-02", "2018-01-02T03:04:05", "2018-13-02", "soon", "NaN", None],
            [dt.datetime(2018, 1, 2, 3, 4, 5), dt.datetime(2018, 1, 2), dt.datetime(2018, 1, 2, 3, 4, 5), None, None, None, None],
        ),
    ],
)
def test_casts(spark, rule, values, expected):
    assert cast(spark, rule, values) == expected


def test_clean_skips_absent_and_passes_undeclared_columns(spark):
    df = spark.createDataFrame([("7", "keep")], "n string, other string")
    got = clean(df, {"n": "int", "absent": "float"})
    assert got.columns == ["n", "other"] and got.first() == (7, "keep")


def test_expressions(spark):
    one = spark.range(1)
    a, b = F.expr("TIMESTAMP_NTZ '2018-01-31'"), F.expr("TIMESTAMP_NTZ '2018-02-28 12:00:00'")
    assert one.select(elapsed_days(a, b)).first()[0] == 28.5
    months = one.selectExpr("timestampdiff(MONTH, TIMESTAMP_NTZ '2018-01-31', TIMESTAMP_NTZ '2018-02-28')")
    assert months.first()[0] == 0
    assert one.select(percent(F.lit(1), F.lit(0), 1)).first()[0] is None
    assert str(one.select(percent(F.lit(1), F.lit(8), 1)).first()[0]) == "12.5"
    assert [pretty_size(n) for n in (0, 10239, 10240, 5 << 20, 50 << 30)] == ["0 bytes", "10239 bytes", "10 kB", "5120 kB", "50 GB"]
