"""Business datasets. Each takes the dict of canonical tables and returns one DataFrame.

Where an order has several items and several reviews, the product, seller, customer and
category marts count every item once per review and every score once per item. That is the
defined result (revenue is *not* de-duplicated); ``operators.rollups`` explains how it is
reached without joining items to reviews row by row.

Keys are documented but not enforced. Attribute rows that repeat a key are folded together
after the last join, on its own partitioning, so the fold adds no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import (
    elapsed_days,
    mean_elapsed_days,
    money_resums,
    money_sums,
    money_total,
    ratio,
)
from ..operators.ordered import with_rank
from ..operators.rollups import (
    item_measures,
    item_sums,
    per_key,
    review_measures,
    weighted_sums,
    reviewed_lines,
)

Tables = Mapping[str, DataFrame]

PREVIEW_ROWS = 10


def order_summary(t: Tables) -> DataFrame:
    """One row per order with its customer, elapsed delivery days and item totals.

    Orders without items stay, with product_count 0 and NULL totals.
    """
    orders = t["orders"].select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date"
    )
    customers = t["customers"].select("customer_id", "customer_unique_id", "customer_city", "customer_state")
    totals = {"total_product_value": "price", "total_freight_value": "freight", "total_order_value": "value"}
    items = (
        t["order_items"]
        .groupBy("order_id")
        .agg(F.count_distinct("product_id").alias("product_count"), *item_sums())
        .select("order_id", "product_count", *[money_total(part).alias(name) for name, part in totals.items()])
    )
    keys = [
        "order_id", "customer_id", "customer_unique_id", "customer_city", "customer_state", "order_status",
        "order_purchase_timestamp", "order_delivered_customer_date",
    ]
    days = elapsed_days(F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date"))
    return (
        orders.join(customers, "customer_id", "left")
        .join(items, "order_id", "left")
        .groupBy(*keys)
        .agg(
            F.max(days).alias("delivery_days"),
            F.coalesce(F.max("product_count"), F.lit(0)).alias("product_count"),
            *[(F.max(name) * F.count("*")).alias(name) for name in totals],
        )
    )


def product_performance(t: Tables) -> DataFrame:
    """One row per product; unsold products stay with times_ordered 0 and NULL measures."""
    # (order, product) is unique in these, so counting rows counts distinct orders.
    sold = (
        reviewed_lines(t["order_items"], t["order_reviews"], "product_id")
        .groupBy("product_id")
        .agg(F.count("order_id").alias("times_ordered"), *weighted_sums())
    )
    keys = ["product_id", "product_category_name", "product_category_name_english"]
    return (
        t["products"]
        .select("product_id", "product_category_name")
        .join(_translation(t), "product_category_name", "left")
        .join(sold, "product_id", "left")
        .groupBy(*keys)
        .agg(
            F.coalesce(F.max("times_ordered"), F.lit(0)).alias("times_ordered"),
            (money_total("price", F.max) * F.count("*")).alias("total_revenue"),
            ratio(money_total("price", F.max), F.max("priced")).alias("avg_price"),
            ratio(F.max("score_total"), F.max("scored")).alias("avg_review_score"),
        )
    )


def seller_performance(t: Tables) -> DataFrame:
    """One row per seller; sellers without sales stay with zero counts and NULL measures."""
    sold = (
        reviewed_lines(t["order_items"], t["order_reviews"], "seller_id")
        .groupBy("seller_id")
        .agg(F.count("order_id").alias("total_orders"), *weighted_sums())
    )
    # Products are counted apart: two distinct counts in one grouping would triple its rows.
    products = t["order_items"].select("seller_id", "product_id").distinct().groupBy("seller_id")
    sold = sold.join(products.agg(F.count("product_id").alias("unique_products_sold")), "seller_id", "left")
    return (
        t["sellers"]
        .select("seller_id", "seller_city", "seller_state")
        .join(sold, "seller_id", "left")
        .groupBy("seller_id", "seller_city", "seller_state")
        .agg(
            F.coalesce(F.max("total_orders"), F.lit(0)).alias("total_orders"),
            F.coalesce(F.max("unique_products_sold"), F.lit(0)).alias("unique_products_sold"),
            (money_total("price", F.max) * F.count("*")).alias("total_revenue"),
            ratio(money_total("price", F.max), F.max("priced")).alias("avg_product_price"),
            ratio(money_total("freight", F.max), F.max("freighted")).alias("avg_freight_value"),
            ratio(F.max("score_total"), F.max("scored")).alias("avg_review_score"),
        )
    )


def daily_orders(t: Tables) -> DataFrame:
    """One row per purchase date."""
    bought, delivered = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")

    def having(status: str) -> Column:
        return F.count_if(F.col("order_status") == status)

    return (
        t["orders"]
        .groupBy(F.to_date(bought).alias("order_date"))
        .agg(
            F.count("*").alias("order_count"),
            F.count_distinct("customer_id").alias("unique_customers"),
            having("delivered").alias("delivered_orders"),
            having("canceled").alias("cancelled_orders"),
            mean_elapsed_days(bought, delivered).cast("decimal(10,2)").alias("avg_delivery_days"),
        )
    )


def customer_ltv(t: Tables) -> DataFrame:
    """One row per person and state: a person seen in two states has two rows."""
    # One row per order on every side, so these joins share one partitioning and cannot skew.
    items = (
        t["order_items"]
        .groupBy("order_id")
        .agg(F.count("*").alias("lines"), *money_sums("(price + freight_value)", "value"))
    )
    orders = (
        t["orders"]
        .select("order_id", "customer_id", "order_purchase_timestamp")
        .join(items, "order_id", "left")
        .join(t["order_reviews"].groupBy("order_id").agg(*review_measures()), "order_id", "left")
        .withColumns({"copies": F.coalesce("reviews", F.lit(1)), "lines": F.coalesce("lines", F.lit(1))})
    )
    return (
        t["customers"]
        .select("customer_id", "customer_unique_id", "customer_state")
        .join(orders, "customer_id")
        .groupBy("customer_unique_id", "customer_state")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.min("order_purchase_timestamp").alias("first_order_date"),
            F.max("order_purchase_timestamp").alias("last_order_date"),
            *money_resums("value", "copies"),
            F.sum(F.col("score_total") * F.col("lines")).alias("score_total"),
            F.sum(F.col("scored") * F.col("lines")).alias("scored"),
        )
        .select(
            "customer_unique_id",
            "customer_state",
            "total_orders",
            "first_order_date",
            "last_order_date",
            money_total("value").alias("lifetime_value"),
            ratio(F.col("score_total"), F.col("scored")).alias("avg_review_score"),
        )
    )


def category_performance(t: Tables) -> DataFrame:
    """One row per category label (English name, else native). Products without a category are
    left out; native names that share an English name are one category."""
    labels = (
        t["products"]
        .where(F.col("product_category_name").isNotNull())
        .select("product_id", "product_category_name")
        .join(_translation(t), "product_category_name", "left")
        .select(
            "product_id",
            F.coalesce("product_category_name_english", "product_category_name").alias("category"),
        )
    )
    sales = t["order_items"].join(labels, "product_id")
    # (order, category) is unique here. A category may hold a third of the orders: only the
    # partial sums of each task meet in its group.
    measures = (
        reviewed_lines(sales, t["order_reviews"], "category")
        .groupBy("category")
        .agg(F.count("order_id").alias("order_count"), *weighted_sums())
        .withColumn("total_revenue", money_total("price"))
    )
    products = (
        t["order_items"]
        .select("product_id")
        .distinct()
        .join(labels, "product_id")
        .groupBy("category")
        .agg(F.count_distinct("product_id").alias("unique_products"))
    )
    ranked = with_rank(measures, "total_revenue", "revenue_rank")
    return ranked.join(products, "category").select(
        "category",
        "order_count",
        "unique_products",
        "total_revenue",
        ratio(F.col("total_revenue"), F.col("priced")).alias("avg_price"),
        ratio(F.col("score_total"), F.col("scored")).alias("avg_review_score"),
        "revenue_rank",
    )


def customer_lifetime_value(summary: DataFrame) -> DataFrame:
    """Orders and value per person over the order summary; no review weighting here."""
    sums = summary.groupBy("customer_unique_id").agg(
        F.count("*").alias("total_orders"), *money_sums("total_order_value", "value")
    )
    return sums.select("customer_unique_id", "total_orders", money_total("value").alias("lifetime_value"))


def geo_sales(summary: DataFrame) -> DataFrame:
    """Orders and mean delivery days per customer state over the order summary."""
    return summary.groupBy("customer_state").agg(
        F.count("*").alias("orders"),
        mean_elapsed_days(
            F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
        ).alias("avg_delivery"),
    )


def top_categories(performance: DataFrame) -> DataFrame:
    """Product-grain rows with their category, highest revenue first, unsold products on top."""
    return performance.select(
        F.coalesce("product_category_name_english", "product_category_name").alias("category"),
        "total_revenue",
        "avg_review_score",
    ).orderBy(F.desc_nulls_first("total_revenue"))


def order_summary_preview(t: Tables, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows of the order summary by order id."""
    keys = _first_keys(t["orders"], "order_id", rows)
    small = {
        **t,
        "orders": _restrict(t["orders"], keys, "order_id"),
        "order_items": _restrict(t["order_items"], keys, "order_id"),
    }
    return order_summary(small).orderBy("order_id").limit(rows)


def product_performance_preview(t: Tables, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows of the product performance view by product id."""
    keys = _first_keys(t["products"], "product_id", rows)
    small = {
        **t,
        "products": _restrict(t["products"], keys, "product_id"),
        "order_items": _restrict(t["order_items"], keys, "product_id"),
    }
    return product_performance(small).orderBy("product_id").limit(rows)


def seller_performance_preview(t: Tables, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows of the seller performance view by seller id."""
    keys = _first_keys(t["sellers"], "seller_id", rows)
    small = {
        **t,
        "sellers": _restrict(t["sellers"], keys, "seller_id"),
        "order_items": _restrict(t["order_items"], keys, "seller_id"),
    }
    return seller_performance(small).orderBy("seller_id").limit(rows)


def zip_coordinates(t: Tables) -> DataFrame:
    """One mean coordinate per zip prefix."""

    def mean(name: str) -> Column:
        # Exact where ten decimals hold the coordinate, so that the mean does not depend on task order.
        fixed = F.col(name).cast("decimal(20,10)")
        rest = F.col(name) - fixed.cast("double")
        rest = F.when(F.abs(rest) > F.abs(F.col(name)) * 1e-15, rest).otherwise(F.when(rest.isNotNull(), F.lit(0.0)))
        return ratio(F.sum(fixed).cast("double") + F.sum(rest), F.count(fixed))

    return per_key(
        t["geolocation"],
        "geolocation_zip_code_prefix",
        mean("geolocation_lat").alias("latitude"),
        mean("geolocation_lng").alias("longitude"),
    )


def geo_lookup(t: Tables) -> DataFrame:
    """Customers with the coordinates of their zip prefix, NULL where the prefix is unknown."""
    return (
        t["customers"]
        .join(
            zip_coordinates(t),
            F.col("customer_zip_code_prefix") == F.col("geolocation_zip_code_prefix"),
            "left",
        )
        .select("customer_id", "customer_zip_code_prefix", "customer_state", "latitude", "longitude")
    )


def _translation(t: Tables) -> DataFrame:
    return t["product_category_translation"].select("product_category_name", "product_category_name_english")


def _first_keys(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The first keys in the order of the view, where NULL comes first."""
    return df.select(key).distinct().orderBy(key).limit(rows).select(F.struct(key).alias("_key"))


def _restrict(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    # Spark broadcasts the keys if they are as few as those of a preview. Structs of NULL are equal.
    return df.join(keys, F.struct(key) == F.col("_key"), "left_semi")


# The refreshable datasets of the analytics layer and the views of the raw layer.
MATERIALIZED = {
    "mv_daily_orders": daily_orders,
    "mv_customer_ltv": customer_ltv,
    "mv_category_performance": category_performance,
}
VIEWS = {
    "v_order_summary": order_summary,
    "v_product_performance": product_performance,
    "v_seller_performance": seller_performance,
}
