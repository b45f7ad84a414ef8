"""Exact quantiles by digits, order keys, and previews with NULL keys."""

import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import tables
from tradeloom.operators.ordered import exact_quantiles, from_order_key, order_key
from tradeloom.plans import marts

EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, 1 - 2**-53, 1 + 2**-52, 2.0**52, 2.0**53 + 2, 1e308, 1.7976931348623157e308, 0.1, 1e-300, 1e300, float("inf"), 3.0, 8.0, 1000.0, 1e15, 1e22]


def test_order_keys_are_the_bits_of_the_values(spark):
    rng = np.random.default_rng(1)
    some = [struct.unpack(">d", rng.bytes(8))[0] for _ in range(3000)]
    values = [v for v in [*EDGES, *(-e for e in EDGES), *some, *(2.0**i for i in range(-1074, 1024)), *(math.nextafter(2.0**i, 0) for i in range(-1000, 1024, 7))] if not math.isnan(v)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", order_key(F.col("v")).alias("k")).collect()
    for r in got:
        bits = struct.unpack(">q", struct.pack(">d", abs(r["v"])))[0]
        assert r["k"] == (-bits if r["v"] < 0 else bits), r["v"]
        assert from_order_key(r["k"]) == r["v"]


@pytest.mark.parametrize("fetch", [1, 30, 4096])
def test_quantiles_of_hard_columns(spark, fetch):
    rng = np.random.default_rng(2)
    samples = {
        "edges": np.array([e for e in EDGES if not math.isinf(e)] * 3),
        "scales": 10.0 ** rng.uniform(-300, 300, 500) * rng.choice([-1, 1], 500),
        "near": 1 + rng.integers(0, 50, 800) * 2.0**-52,
        "all equal": np.full(300, -7.25),
    }
    wanted = {"lo": 0.0, "a": 0.013, "q1": 0.25, "m": 0.5, "q3": 0.75, "b": 0.987, "hi": 1.0}
    for name, values in samples.items():
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double").repartition(3)
        got = exact_quantiles(df, "v", wanted, fetch).first()
        np.testing.assert_allclose([got[w] for w in wanted], np.quantile(values, list(wanted.values())), rtol=1e-12, err_msg=name)


def test_quantiles_of_other_types_and_infinity(spark):
    wanted = {"q1": 0.25, "hi": 1.0}
    money = spark.sql("SELECT CAST(id * 0.01 AS DECIMAL(10,2)) AS v FROM range(101)")
    assert tuple(exact_quantiles(money, "v", wanted).first()) == (0.25, 1.0)
    whole = spark.range(5)
    assert tuple(exact_quantiles(whole, "id", wanted).first()) == (1.0, 4.0)
    top = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),)], "v double")
    assert exact_quantiles(top, "v", {"hi": 1.0, "m": 0.5}).first()["m"] == 2.0


def test_previews_start_with_a_null_key_as_the_views_do(spark):
    t = tables(spark)
    t["sellers"] = t["sellers"].unionByName(t["sellers"].limit(1).withColumn("seller_id", F.lit(None).cast("string")))
    t["products"] = t["products"].unionByName(t["products"].limit(1).withColumn("product_id", F.lit(None).cast("string")))
    t["orders"] = t["orders"].unionByName(t["orders"].limit(1).withColumn("order_id", F.lit(None).cast("string")))
    for preview, view, key in (
        (marts.seller_performance_preview, marts.seller_performance, "seller_id"),
        (marts.product_performance_preview, marts.product_performance, "product_id"),
        (marts.order_summary_preview, marts.order_summary, "order_id"),
    ):
        got = preview(t, 3).collect()
        assert got[0][key] is None
        assert [r[key] for r in got] == [r[key] for r in view(t).orderBy(key).limit(3).collect()]
