"""Registered queries for the 21 indicators and their report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.kpis import LABELS, kpi, kpi_report
from ..sources.star import canonical
from .star_sql import with_star


def _single(name: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = kpi(canonical(spark, folder), name)
        return df.select(F.col(name).cast("double")) if isinstance(df.schema[name].dataType, T.DecimalType) else df

    return run


def _report(spark: SparkSession, folder: str) -> DataFrame:
    return kpi_report(spark, canonical(spark, folder))


QUERIES = {f"kpi_{name}": _single(name) for name in LABELS} | {"kpi_report": _report}


def _share(condition: str, table: str) -> str:
    return f"""SELECT COUNT(*) || ' (' || CAST(CAST(COUNT(*) * 100.0 /
               (SELECT COUNT(*) FROM {table}) AS DECIMAL(10,1)) AS VARCHAR) || '%)' FROM {table} WHERE {condition}"""


# One scalar query each; money and mean values are decimals with two places.
SCALARS = {
    "total_orders": "SELECT COUNT(*) FROM c_orders",
    "orders_with_reviews": "SELECT COUNT(DISTINCT o.order_id) FROM c_orders o JOIN c_reviews r ON r.order_id = o.order_id",
    "unique_customers": "SELECT COUNT(DISTINCT customer_unique_id) FROM c_customers",
    "repeat_customers": """SELECT COUNT(*) FROM (
        SELECT customer_unique_id FROM c_customers GROUP BY customer_unique_id HAVING COUNT(*) > 1)""",
    "active_sellers": "SELECT COUNT(DISTINCT seller_id) FROM c_items",
    "product_categories": "SELECT COUNT(DISTINCT native) FROM c_products",
    "first_order_date": "SELECT CAST(MIN(bought) AS DATE) FROM c_orders",
    "last_order_date": "SELECT CAST(MAX(bought) AS DATE) FROM c_orders",
    "coverage_months": """SELECT CAST(12 * extract(year FROM a) + extract(month FROM a) AS BIGINT)
        FROM (SELECT age(MAX(bought), MIN(bought)) AS a FROM c_orders)""",
    "total_revenue": "SELECT CAST(SUM(CAST(payment_value AS DECIMAL(18,4))) AS DECIMAL(38,2)) FROM c_payments",
    "avg_order_value": """SELECT CAST(CAST(SUM(paid) AS DOUBLE) / COUNT(*) AS DECIMAL(38,2)) FROM (
        SELECT order_id, SUM(CAST(payment_value AS DECIMAL(18,4))) AS paid FROM c_payments GROUP BY order_id)""",
    "avg_product_price": "SELECT CAST(CAST(SUM(price_m) AS DOUBLE) / COUNT(price) AS DECIMAL(38,2)) FROM c_items",
    "avg_freight": "SELECT CAST(CAST(SUM(freight_m) AS DOUBLE) / COUNT(freight_m) AS DECIMAL(38,2)) FROM c_items",
    "avg_review_score": "SELECT CAST(CAST(SUM(review_score) AS DOUBLE) / COUNT(*) AS DECIMAL(38,2)) FROM c_reviews",
    "five_star_reviews": _share("review_score = 5", "c_reviews"),
    "one_star_reviews": _share("review_score = 1", "c_reviews"),
    "states_with_orders": "SELECT COUNT(DISTINCT customer_state) FROM c_customers",
    "cities_with_orders": "SELECT COUNT(DISTINCT customer_city) FROM c_customers",
    "top_state": """SELECT customer_state || ' (' || COUNT(*) || ' orders)'
        FROM c_orders o JOIN c_customers c ON c.customer_id = o.customer_id
        GROUP BY customer_state ORDER BY COUNT(*) DESC, customer_state LIMIT 1""",
    "delivered_orders": _share("order_status = 'delivered'", "c_orders"),
    "cancelled_orders": _share("order_status = 'canceled'", "c_orders"),
}
DECIMALS = {"total_revenue", "avg_order_value", "avg_product_price", "avg_freight", "avg_review_score"}
COUNTS = {
    "total_orders", "orders_with_reviews", "unique_customers", "repeat_customers", "active_sellers",
    "product_categories", "states_with_orders", "cities_with_orders",
}


def _text(name: str) -> str:
    cell = f"({SCALARS[name]})"
    return f"format('{{:,}}', {cell})" if name in COUNTS else f"CAST({cell} AS VARCHAR)"


def _report_sql() -> str:
    rows = [
        f"SELECT {i} AS position, '{category}' AS category, '{label}' AS check_name, {_text(name)} AS value"
        for i, (name, (category, label)) in enumerate(LABELS.items(), start=1)
    ]
    return with_star("\nUNION ALL\n".join(rows))


def _scalar_sql(name: str) -> str:
    cell = f"({SCALARS[name]})"
    return with_star(f"SELECT {f'CAST({cell} AS DOUBLE)' if name in DECIMALS else cell} AS {name}")


ORACLE = {f"kpi_{name}": _scalar_sql(name) for name in LABELS} | {"kpi_report": _report_sql()}
