"""One key holds 40% of the rows: the join on it must be split over several tasks by AQE, and
the result must stay whole. Thresholds are lowered to the size of the test data."""

import pytest
from pyspark.sql import functions as F

from tradeloom.plans import marts

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    # A partition is split by the map tasks that wrote it, so there must be several.
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
ROWS = 100_000


@pytest.fixture()
def low_thresholds(spark):
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield
    for name in SMALL:
        spark.conf.unset(name)


def hot(key: str, prefix: str, others: int):
    """40% of the ids are the hot key, the others are spread evenly."""
    share = F.xxhash64("id", F.lit(key)) % 10
    return F.when(F.abs(share) < 4, F.lit(f"{prefix}0")).otherwise(F.concat(F.lit(prefix), (F.col("id") % others).cast("string")))


@pytest.fixture(scope="module")
def skewed(spark):
    ids = spark.range(ROWS, numPartitions=8)
    orders = 20_000
    return {
        "order_items": ids.select(
            hot("order", "o", orders).alias("order_id"), F.col("id").alias("order_item_id"),
            hot("product", "p", 90_000).alias("product_id"), F.concat(F.lit("s"), F.col("id") % 300).alias("seller_id"),
            F.lit(1.25).alias("price"), F.lit(0.25).alias("freight_value"),
        ),
        "order_reviews": ids.select(hot("review", "o", orders).alias("order_id"), (F.col("id") % 5 + 1).alias("review_score")),
        "products": spark.range(90_000).select(
            F.concat(F.lit("p"), "id").alias("product_id"), F.concat(F.lit("c"), F.col("id") % 20).alias("product_category_name")
        ),
        "product_category_translation": spark.range(10).select(
            F.concat(F.lit("c"), "id").alias("product_category_name"), F.concat(F.lit("e"), "id").alias("product_category_name_english")
        ),
        "sellers": spark.range(300).select(
            F.concat(F.lit("s"), "id").alias("seller_id"), F.lit("city").alias("seller_city"), F.lit("ST").alias("seller_state")
        ),
        "orders": ids.select(
            F.concat(F.lit("o"), "id").alias("order_id"), hot("customer", "c", 30_000).alias("customer_id"), F.lit("shipped").alias("order_status"),
            F.expr("TIMESTAMP_NTZ '2018-01-01'").alias("order_purchase_timestamp"),
            F.expr("TIMESTAMP_NTZ '2018-01-03'").alias("order_delivered_customer_date"),
        ),
        "customers": spark.range(30_000, numPartitions=8).select(
            F.concat(F.lit("c"), "id").alias("customer_id"), F.concat(F.lit("u"), "id").alias("customer_unique_id"),
            F.lit("city").alias("customer_city"), F.lit("ST").alias("customer_state"),
            F.when(F.col("id") % 10 < 4, "z0").otherwise(F.concat(F.lit("z"), F.col("id") % 900)).alias("customer_zip_code_prefix"),
        ),
        "geolocation": spark.range(900).select(
            F.concat(F.lit("z"), "id").alias("geolocation_zip_code_prefix"), F.lit(1.0).alias("geolocation_lat"), F.lit(2.0).alias("geolocation_lng")
        ),
    }


def run(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("build", [marts.product_performance, marts.seller_performance, marts.category_performance])
def test_hot_order_is_split(spark, skewed, low_thresholds, build):
    rows, plan = run(build(skewed))
    assert "skew=true" in plan
    # Every item counts once per review of its order (or once without reviews).
    per_order = skewed["order_reviews"].groupBy("order_id").count()
    copies = skewed["order_items"].join(per_order, "order_id", "left").agg(F.sum(F.coalesce("count", F.lit(1)))).first()[0]
    assert sum(r.total_revenue or 0 for r in rows) == pytest.approx(1.25 * copies, rel=1e-12)


def test_hot_customer_is_split(spark, skewed, low_thresholds):
    rows, plan = run(marts.customer_ltv(skewed))
    assert "skew=true" in plan
    assert sum(r.total_orders for r in rows) == ROWS
    rows, plan = run(marts.order_summary(skewed))
    assert "skew=true" in plan
    assert len(rows) == ROWS


def test_hot_zip_is_split(spark, skewed, low_thresholds):
    rows, plan = run(marts.geo_lookup(skewed))
    assert "skew=true" in plan
    assert len(rows) == 30_000 and all(r.latitude == 1.0 for r in rows)
