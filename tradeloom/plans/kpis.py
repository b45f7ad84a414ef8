"""The 21 business indicators: one typed function each, and one fused report.

The report reads each base table once per grain instead of running 21 queries.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import LOW_BITS, MONEY_SCALE, money_parts, money_sums
from ..session import small_frame

Tables = Mapping[str, DataFrame]

# Report category and label of every indicator, in report order.
LABELS: dict[str, tuple[str, str]] = {
    "total_orders": ("Key Metrics", "Total Orders"),
    "orders_with_reviews": ("Key Metrics", "Orders with Reviews"),
    "unique_customers": ("Key Metrics", "Unique Customers"),
    "repeat_customers": ("Key Metrics", "Repeat Customers"),
    "active_sellers": ("Key Metrics", "Active Sellers"),
    "product_categories": ("Key Metrics", "Product Categories"),
    "first_order_date": ("Time Range", "First Order Date"),
    "last_order_date": ("Time Range", "Last Order Date"),
    "coverage_months": ("Time Range", "Data Coverage (months)"),
    "total_revenue": ("Financial Metrics", "Total Revenue (BRL)"),
    "avg_order_value": ("Financial Metrics", "Average Order Value (BRL)"),
    "avg_product_price": ("Financial Metrics", "Average Product Price (BRL)"),
    "avg_freight": ("Financial Metrics", "Average Freight Cost (BRL)"),
    "avg_review_score": ("Customer Satisfaction", "Average Review Score"),
    "five_star_reviews": ("Customer Satisfaction", "5-Star Reviews"),
    "one_star_reviews": ("Customer Satisfaction", "1-Star Reviews"),
    "states_with_orders": ("Geographic Distribution", "States with Orders"),
    "cities_with_orders": ("Geographic Distribution", "Cities with Orders"),
    "top_state": ("Geographic Distribution", "Top State by Orders"),
    "delivered_orders": ("Order Status", "Delivered Orders"),
    "cancelled_orders": ("Order Status", "Cancelled Orders"),
}


def _total(high: str, low: str, rest: str) -> str:
    """The total of partial money sums (see functions.expressions) in ticks; NULL if no decimal can hold it."""
    whole = f"CAST({high} AS DECIMAL(28,0)) * {1 << LOW_BITS} + CAST({low} AS DECIMAL(28,0))"
    return f"({whole} + try_cast({rest} * {MONEY_SCALE} AS DECIMAL(38,6)))"


def _ticks(column: str) -> str:
    """The exact sum of a money column, in ticks."""
    parts = money_parts(column)
    return _total(*(f"sum({parts[p]})" for p in ("hi", "lo", "rest")))


def _rounded(total: str, count: str, scale: int = 1) -> str:
    """total / count / scale, rounded half up to two places in decimal arithmetic."""
    divisor = f"CAST({count} * {scale} AS DECIMAL(20,0))"
    return f"CAST(round(try_divide(CAST({total} AS DECIMAL(38,6)), {divisor}), 2) AS DECIMAL(38,2))"


def _share(condition: str) -> str:
    """Text like ``1968 (32.8%)``: the matching rows and their share of all rows."""
    part = f"count_if({condition})"
    share = f"CAST(round(try_divide(CAST({part} AS DECIMAL(20,0)) * 100, CAST(count(*) AS DECIMAL(20,0))), 1) AS DECIMAL(10,1))"
    return f"concat(CAST({part} AS STRING), ' (', CAST({share} AS STRING), '%)')"


# One-row packs: several indicators from one pass over one table.


def order_pack(t: Tables) -> DataFrame:
    bought = "order_purchase_timestamp"
    return t["orders"].selectExpr(
        "count(*) AS total_orders",
        f"CAST(min({bought}) AS DATE) AS first_order_date",
        f"CAST(max({bought}) AS DATE) AS last_order_date",
        f"timestampdiff(MONTH, min({bought}), max({bought})) AS coverage_months",
        _share("order_status = 'delivered'") + " AS delivered_orders",
        _share("order_status = 'canceled'") + " AS cancelled_orders",
    )


def reviewed_pack(t: Tables) -> DataFrame:
    """Distinct order ids that occur on both sides.

    Stacking the two id columns and grouping once takes a single shuffle of ids, already
    combined per task, and no sorted join.
    """
    orders = t["orders"].selectExpr("order_id", "true AS placed", "false AS reviewed")
    reviews = t["order_reviews"].selectExpr("order_id", "false AS placed", "true AS reviewed")
    ids = orders.unionAll(reviews).where("order_id IS NOT NULL").groupBy("order_id")
    found = ids.agg(F.bool_or("placed").alias("placed"), F.bool_or("reviewed").alias("reviewed"))
    return found.selectExpr("count_if(placed AND reviewed) AS orders_with_reviews")


def customer_pack(t: Tables) -> DataFrame:
    """Persons, repeaters, states, cities and the top state from one grouping of (kind, value).

    Orders are counted per customer before they are joined. The top state is the first by name
    among equals.
    """
    orders = t["orders"].groupBy("customer_id").agg(F.count("*").alias("orders"))
    pairs = (
        t["customers"]
        .join(orders, "customer_id", "left")
        .selectExpr(
            "orders", "CAST(customer_unique_id AS STRING) AS person", "customer_state AS state", "customer_city AS city"
        )
        .unpivot("orders", ["person", "state", "city"], "kind", "value")
    )
    groups = pairs.groupBy("kind", "value").agg(F.count("*").alias("customers"), F.sum("orders").alias("orders"))
    top = "min(CASE WHEN kind = 'state' AND orders > 0 THEN struct(-orders AS orders, value) END)"
    return groups.selectExpr(
        "count_if(kind = 'person' AND value IS NOT NULL) AS unique_customers",
        "count_if(kind = 'person' AND customers > 1) AS repeat_customers",
        "count_if(kind = 'state' AND value IS NOT NULL) AS states_with_orders",
        "count_if(kind = 'city' AND value IS NOT NULL) AS cities_with_orders",
        f"concat({top}.value, ' (', CAST(-{top}.orders AS STRING), ' orders)') AS top_state",
    )


def item_pack(t: Tables) -> DataFrame:
    def mean(column: str) -> str:
        return _rounded(_ticks(column), f"count({column})", MONEY_SCALE)

    return t["order_items"].selectExpr(
        "count(DISTINCT seller_id) AS active_sellers",
        mean("price") + " AS avg_product_price",
        mean("freight_value") + " AS avg_freight",
    )


def product_pack(t: Tables) -> DataFrame:
    return t["products"].selectExpr("count(DISTINCT product_category_name) AS product_categories")


def payment_pack(t: Tables) -> DataFrame:
    """Revenue, and the mean of the per-order totals."""
    orders = t["order_payments"].groupBy("order_id").agg(*money_sums("payment_value", "paid"))
    total = _total("sum(paid_hi)", "sum(paid_lo)", "sum(paid_rest)")
    return orders.selectExpr(
        _rounded(total, "1", MONEY_SCALE) + " AS total_revenue",
        _rounded(total, "count(paid_hi)", MONEY_SCALE) + " AS avg_order_value",
    )


def review_pack(t: Tables) -> DataFrame:
    return t["order_reviews"].selectExpr(
        _rounded("sum(review_score)", "count(review_score)") + " AS avg_review_score",
        _share("review_score = 5") + " AS five_star_reviews",
        _share("review_score = 1") + " AS one_star_reviews",
    )


PACKS: dict[Callable[[Tables], DataFrame], tuple[str, ...]] = {
    order_pack: (
        "total_orders", "first_order_date", "last_order_date", "coverage_months", "delivered_orders",
        "cancelled_orders",
    ),
    reviewed_pack: ("orders_with_reviews",),
    customer_pack: (
        "unique_customers", "repeat_customers", "states_with_orders", "cities_with_orders", "top_state",
    ),
    item_pack: ("active_sellers", "avg_product_price", "avg_freight"),
    product_pack: ("product_categories",),
    payment_pack: ("total_revenue", "avg_order_value"),
    review_pack: ("avg_review_score", "five_star_reviews", "one_star_reviews"),
}


def _repeaters(t: Tables) -> DataFrame:
    persons = t["customers"].groupBy("customer_unique_id").agg(F.count("*").alias("customers"))
    return persons.agg(F.count_if(F.col("customers") > 1).alias("repeat_customers"))


def _top_state(t: Tables) -> DataFrame:
    """Orders are counted per customer before the join, and per state in each task before the shuffle."""
    orders = t["orders"].groupBy("customer_id").agg(F.count("*").alias("orders"))
    held = t["customers"].select("customer_id", "customer_state").join(orders, "customer_id")
    states = held.groupBy("customer_state").agg(F.sum("orders").alias("orders"))
    top = "min(struct(-orders AS orders, customer_state AS value))"
    return states.selectExpr(f"concat({top}.value, ' (', CAST(-{top}.orders AS STRING), ' orders)') AS top_state")


# Asked for alone, these need not unpivot the customers as their pack does.
ALONE: dict[str, Callable[[Tables], DataFrame]] = {
    "unique_customers": lambda t: t["customers"].selectExpr("count(DISTINCT customer_unique_id) AS unique_customers"),
    "repeat_customers": _repeaters,
    "states_with_orders": lambda t: t["customers"].selectExpr("count(DISTINCT customer_state) AS states_with_orders"),
    "cities_with_orders": lambda t: t["customers"].selectExpr("count(DISTINCT customer_city) AS cities_with_orders"),
    "top_state": _top_state,
}


def kpi(t: Tables, name: str) -> DataFrame:
    """One indicator as a typed one-row, one-column DataFrame.

    Only the chosen column of its pack is computed; Catalyst prunes the others.
    """
    if name in ALONE:
        return ALONE[name](t)
    pack = next(build for build, names in PACKS.items() if name in names)
    return pack(t).select(name)


COUNTS = {
    "total_orders", "orders_with_reviews", "unique_customers", "repeat_customers", "active_sellers",
    "product_categories", "states_with_orders", "cities_with_orders",
}


def _report_rows(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Counts with thousands separators, other values as text, NULL as "No data"."""
    order, cells = list(LABELS), []
    for name in names:
        category, label = LABELS[name]
        text = f"format_number({name}, 0)" if name in COUNTS else f"CAST({name} AS STRING)"
        cells.append(f"{order.index(name) + 1}, '{category}', '{label}', coalesce({text}, 'No data')")
    return df.selectExpr(f"stack({len(names)}, {', '.join(cells)}) AS (position, category, check_name, value)")


def _error_rows(spark: SparkSession, names: tuple[str, ...], error: Exception) -> DataFrame:
    order = list(LABELS)
    text = f"Error - {error}"
    rows = [(order.index(name) + 1, *LABELS[name], text) for name in names]
    return small_frame(spark, rows, "position int, category string, check_name string, value string")


def kpi_report_checked(spark: SparkSession, t: Tables) -> DataFrame:
    """The rows of ``kpi_report``, computed now: a check that fails while it runs fails alone.

    Packs run one after another; the indicators of a pack that fails are tried singly. One short
    text for each indicator passes through the driver.
    """
    rows: list[tuple] = []
    for build, names in PACKS.items():
        try:
            rows += [tuple(r) for r in _report_rows(build(t), names).collect()]
        except (KeyError, PySparkException):
            for name in names:
                try:
                    rows += [tuple(r) for r in _report_rows(kpi(t, name), (name,)).collect()]
                except (KeyError, PySparkException) as error:
                    rows += [tuple(r) for r in _error_rows(spark, (name,), error).collect()]
    return small_frame(spark, sorted(rows), "position int, category string, check_name string, value string")


def kpi_report(spark: SparkSession, t: Tables) -> DataFrame:
    """(position, category, check_name, value) for all indicators.

    A pack whose table or column is missing reports the error in its own rows only.
    """
    parts = []
    for build, names in PACKS.items():
        try:
            parts.append(_report_rows(build(t), names))
        except (KeyError, AnalysisException) as error:
            parts.append(_error_rows(spark, names, error))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionAll(part)
    return report
