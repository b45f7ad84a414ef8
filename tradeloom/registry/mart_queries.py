"""Registered queries over the marts, and their SQL counterparts.

The SQL joins items and reviews row by row, so it checks the roll-up arithmetic independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import money_sums, money_total
from ..plans import marts
from ..sources.star import canonical
from .star_sql import with_star


def _mart(build, *decimals: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = build(canonical(spark, folder))
        return df.withColumns({c: F.col(c).cast("double") for c in decimals})

    return run


def _tax_relief(spark: SparkSession, folder: str) -> DataFrame:
    """Sums of amounts of six decimals, per return flag."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    sums = lines.groupBy("l_returnflag").agg(*money_sums("(l_extendedprice * l_discount * l_tax)", "relief"))
    return sums.select("l_returnflag", F.round(money_total("relief"), 3).alias("relief"))


QUERIES = {
    "six_decimal_sums": _tax_relief,
    "order_summary": _mart(marts.order_summary),
    "product_performance": _mart(marts.product_performance),
    "seller_performance": _mart(marts.seller_performance),
    "daily_orders": _mart(marts.daily_orders, "avg_delivery_days"),
    "customer_ltv": _mart(marts.customer_ltv),
    "category_performance": _mart(marts.category_performance),
    "customer_lifetime_value": _mart(lambda t: marts.customer_lifetime_value(marts.order_summary(t))),
    "geo_sales": _mart(lambda t: marts.geo_sales(marts.order_summary(t))),
    "top_categories": _mart(lambda t: marts.top_categories(marts.product_performance(t))),
    "order_summary_preview": _mart(marts.order_summary_preview),
    "product_performance_preview": _mart(marts.product_performance_preview),
    "seller_performance_preview": _mart(marts.seller_performance_preview),
    "geo_lookup": _mart(marts.geo_lookup),
}

ORDER_SUMMARY = """
    SELECT o.order_id, o.customer_id, customer_unique_id, customer_city, customer_state, order_status,
           bought AS order_purchase_timestamp, delivered AS order_delivered_customer_date,
           epoch(delivered - bought) / 86400 AS delivery_days,
           COUNT(DISTINCT product_id) AS product_count,
           CAST(SUM(price_m) AS DOUBLE) AS total_product_value,
           CAST(SUM(freight_m) AS DOUBLE) AS total_freight_value,
           CAST(SUM(price_m + freight_m) AS DOUBLE) AS total_order_value
    FROM c_orders o
    LEFT JOIN c_customers c ON c.customer_id = o.customer_id
    LEFT JOIN c_items i ON i.order_id = o.order_id
    GROUP BY o.order_id, o.customer_id, customer_unique_id, customer_city, customer_state, order_status, bought, delivered"""

PRODUCT_PERFORMANCE = """
    SELECT p.product_id, p.native AS product_category_name, english AS product_category_name_english,
           COUNT(DISTINCT i.order_id) AS times_ordered,
           CAST(SUM(price_m) AS DOUBLE) AS total_revenue,
           CAST(SUM(price_m) AS DOUBLE) / COUNT(price) AS avg_price,
           CAST(SUM(review_score) AS DOUBLE) / COUNT(review_score) AS avg_review_score
    FROM c_products p
    LEFT JOIN c_items i ON i.product_id = p.product_id
    LEFT JOIN c_reviews r ON r.order_id = i.order_id
    LEFT JOIN c_translation t ON t.native = p.native
    GROUP BY p.product_id, p.native, english"""

SELLER_PERFORMANCE = """
    SELECT s.seller_id, seller_city, seller_state,
           COUNT(DISTINCT i.order_id) AS total_orders,
           COUNT(DISTINCT i.product_id) AS unique_products_sold,
           CAST(SUM(price_m) AS DOUBLE) AS total_revenue,
           CAST(SUM(price_m) AS DOUBLE) / COUNT(price) AS avg_product_price,
           CAST(SUM(freight_m) AS DOUBLE) / COUNT(freight_value) AS avg_freight_value,
           CAST(SUM(review_score) AS DOUBLE) / COUNT(review_score) AS avg_review_score
    FROM c_sellers s
    LEFT JOIN c_items i ON i.seller_id = s.seller_id
    LEFT JOIN c_reviews r ON r.order_id = i.order_id
    GROUP BY s.seller_id, seller_city, seller_state"""

DAILY_ORDERS = """
    SELECT CAST(bought AS DATE) AS order_date, COUNT(*) AS order_count,
           COUNT(DISTINCT customer_id) AS unique_customers,
           COUNT(*) FILTER (WHERE order_status = 'delivered') AS delivered_orders,
           COUNT(*) FILTER (WHERE order_status = 'canceled') AS cancelled_orders,
           CAST(CAST(AVG(epoch(delivered - bought) / 86400) AS DECIMAL(10,2)) AS DOUBLE) AS avg_delivery_days
    FROM c_orders GROUP BY 1"""

CUSTOMER_LTV = """
    SELECT customer_unique_id, customer_state, COUNT(DISTINCT o.order_id) AS total_orders,
           MIN(bought) AS first_order_date, MAX(bought) AS last_order_date,
           CAST(SUM(price_m + freight_m) AS DOUBLE) AS lifetime_value,
           CAST(SUM(review_score) AS DOUBLE) / COUNT(review_score) AS avg_review_score
    FROM c_customers c
    JOIN c_orders o ON o.customer_id = c.customer_id
    LEFT JOIN c_items i ON i.order_id = o.order_id
    LEFT JOIN c_reviews r ON r.order_id = o.order_id
    GROUP BY customer_unique_id, customer_state"""

CATEGORY_PERFORMANCE = """
    SELECT COALESCE(english, p.native) AS category,
           COUNT(DISTINCT i.order_id) AS order_count, COUNT(DISTINCT i.product_id) AS unique_products,
           CAST(SUM(price_m) AS DOUBLE) AS total_revenue,
           CAST(SUM(price_m) AS DOUBLE) / COUNT(price) AS avg_price,
           CAST(SUM(review_score) AS DOUBLE) / COUNT(review_score) AS avg_review_score,
           RANK() OVER (ORDER BY SUM(price_m) DESC NULLS FIRST) AS revenue_rank
    FROM c_products p
    LEFT JOIN c_translation t ON t.native = p.native
    JOIN c_items i ON i.product_id = p.product_id
    LEFT JOIN c_reviews r ON r.order_id = i.order_id
    WHERE p.native IS NOT NULL
    GROUP BY COALESCE(english, p.native)"""

ORACLE = {
    "six_decimal_sums": """
        SELECT l_returnflag, round(CAST(sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(6,2))
               * CAST(l_tax AS DECIMAL(6,2)) AS DECIMAL(38,8))) AS DOUBLE), 3) AS relief
        FROM lineitem GROUP BY l_returnflag""",
    "order_summary": with_star(ORDER_SUMMARY),
    "product_performance": with_star(PRODUCT_PERFORMANCE),
    "seller_performance": with_star(SELLER_PERFORMANCE),
    "daily_orders": with_star(DAILY_ORDERS),
    "customer_ltv": with_star(CUSTOMER_LTV),
    "category_performance": with_star(CATEGORY_PERFORMANCE),
    "customer_lifetime_value": with_star(
        """SELECT customer_unique_id, COUNT(*) AS total_orders,
                  CAST(SUM(CAST(total_order_value AS DECIMAL(18,4))) AS DOUBLE) AS lifetime_value
           FROM v_summary GROUP BY customer_unique_id""",
        v_summary=ORDER_SUMMARY,
    ),
    "geo_sales": with_star(
        """SELECT customer_state, COUNT(*) AS orders,
                  CAST(SUM(CAST(delivery_days AS DECIMAL(18,4))) AS DOUBLE) / COUNT(delivery_days) AS avg_delivery
           FROM v_summary GROUP BY customer_state""",
        v_summary=ORDER_SUMMARY,
    ),
    "top_categories": with_star(
        """SELECT COALESCE(product_category_name_english, product_category_name) AS category, total_revenue,
                  avg_review_score
           FROM v_products ORDER BY total_revenue DESC NULLS FIRST""",
        v_products=PRODUCT_PERFORMANCE,
    ),
    "order_summary_preview": with_star(
        "SELECT * FROM v_summary ORDER BY order_id LIMIT 10", v_summary=ORDER_SUMMARY
    ),
    "product_performance_preview": with_star(
        "SELECT * FROM v_products ORDER BY product_id LIMIT 10", v_products=PRODUCT_PERFORMANCE
    ),
    "seller_performance_preview": with_star(
        "SELECT * FROM v_sellers ORDER BY seller_id LIMIT 10", v_sellers=SELLER_PERFORMANCE
    ),
    "geo_lookup": with_star(
        """SELECT customer_id, customer_zip_code_prefix, customer_state, latitude, longitude
           FROM c_customers LEFT JOIN (
               SELECT zip, CAST(SUM(CAST(lat AS DECIMAL(20,10))) AS DOUBLE) / COUNT(lat) AS latitude,
                      CAST(SUM(CAST(lng AS DECIMAL(20,10))) AS DOUBLE) / COUNT(lng) AS longitude
               FROM c_geolocation GROUP BY zip
           ) ON zip = customer_zip_code_prefix"""
    ),
}
