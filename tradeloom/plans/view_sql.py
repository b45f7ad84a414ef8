"""SQL text of the summary views, for views that are stored in the catalog.

The text gives the rows of the functions of the same names in ``plans.marts``. ``{raw}`` is the database of
the tables and ``{views}`` that of the views, both already quoted.
"""

from __future__ import annotations

from dataclasses import dataclass

from ..functions.expressions import LOW_BITS, MICROS_PER_DAY, MONEY_SCALE, money_parts


@dataclass(frozen=True)
class View:
    """``needs`` names the views that the text reads."""

    name: str
    sql: str
    needs: tuple[str, ...] = ()
    comment: str = ""


def _money(amount: str, weight: str = "1L") -> str:
    """The exact total of an amount, each row counted ``weight`` times."""
    hi, lo, rest = (f"sum(({part}) * {weight})" for part in money_parts(amount).values())
    return f"((CAST({hi} AS DOUBLE) * {1 << LOW_BITS}D + CAST({lo} AS DOUBLE)) / {MONEY_SCALE}D + {rest})"


def _days(start: str, end: str) -> str:
    return f"timestampdiff(MICROSECOND, {start}, {end}) / {MICROS_PER_DAY}D"


def _mean(total: str, count: str) -> str:
    return f"try_divide(CAST({total} AS DOUBLE), CAST({count} AS DOUBLE))"


# Every item once for each review of its order, by a weight instead of a join of the two.
LINES = """reviews AS (
  SELECT order_id, count(*) AS reviews, count(review_score) AS scored, sum(review_score) AS score_total
  FROM {raw}.order_reviews WHERE order_id IS NOT NULL GROUP BY order_id
), lines AS (
  SELECT i.order_id, i.product_id, i.seller_id, i.price, i.freight_value, coalesce(r.reviews, 1L) AS copies,
    coalesce(r.scored, 0L) AS scored, coalesce(r.score_total, 0L) AS score_total
  FROM {raw}.order_items i LEFT JOIN reviews r ON i.order_id = r.order_id
)"""
MEASURES = f"""{_money('price', 'copies')} AS price, {_money('freight_value', 'copies')} AS freight,
    sum(if(price IS NULL, 0L, copies)) AS priced, sum(if(freight_value IS NULL, 0L, copies)) AS freighted,
    sum(score_total) AS score_total, sum(scored) AS scored"""

ORDER_SUMMARY = f"""WITH items AS (
  SELECT order_id, count(DISTINCT product_id) AS product_count, {_money('price')} AS product_value,
    {_money('freight_value')} AS freight, {_money('(price + freight_value)')} AS order_value
  FROM {{raw}}.order_items GROUP BY order_id
)
SELECT o.order_id, o.customer_id, c.customer_unique_id, c.customer_city, c.customer_state, o.order_status,
  o.order_purchase_timestamp, o.order_delivered_customer_date,
  max({_days('o.order_purchase_timestamp', 'o.order_delivered_customer_date')}) AS delivery_days,
  coalesce(max(i.product_count), 0L) AS product_count, max(i.product_value) * count(*) AS total_product_value,
  max(i.freight) * count(*) AS total_freight_value, max(i.order_value) * count(*) AS total_order_value
FROM {{raw}}.orders o LEFT JOIN {{raw}}.customers c ON o.customer_id = c.customer_id
  LEFT JOIN items i ON o.order_id = i.order_id
GROUP BY ALL"""

PRODUCT_PERFORMANCE = f"""WITH {LINES}, sold AS (
  SELECT product_id, count(DISTINCT order_id) AS times_ordered, {MEASURES}
  FROM lines GROUP BY product_id
)
SELECT p.product_id, p.product_category_name, n.product_category_name_english,
  coalesce(max(s.times_ordered), 0L) AS times_ordered, max(s.price) * count(*) AS total_revenue,
  {_mean('max(s.price)', 'max(s.priced)')} AS avg_price,
  {_mean('max(s.score_total)', 'max(s.scored)')} AS avg_review_score
FROM {{raw}}.products p
  LEFT JOIN {{raw}}.product_category_translation n ON p.product_category_name = n.product_category_name
  LEFT JOIN sold s ON p.product_id = s.product_id
GROUP BY ALL"""

SELLER_PERFORMANCE = f"""WITH {LINES}, sold AS (
  SELECT seller_id, count(DISTINCT order_id) AS total_orders, {MEASURES}
  FROM lines GROUP BY seller_id
), offered AS (
  SELECT seller_id, count(DISTINCT product_id) AS products FROM {{raw}}.order_items GROUP BY seller_id
)
SELECT v.seller_id, v.seller_city, v.seller_state, coalesce(max(s.total_orders), 0L) AS total_orders,
  coalesce(max(f.products), 0L) AS unique_products_sold, max(s.price) * count(*) AS total_revenue,
  {_mean('max(s.price)', 'max(s.priced)')} AS avg_product_price,
  {_mean('max(s.freight)', 'max(s.freighted)')} AS avg_freight_value,
  {_mean('max(s.score_total)', 'max(s.scored)')} AS avg_review_score
FROM {{raw}}.sellers v LEFT JOIN sold s ON v.seller_id = s.seller_id
  LEFT JOIN offered f ON v.seller_id = f.seller_id
GROUP BY ALL"""

CUSTOMER_LIFETIME_VALUE = f"""SELECT customer_unique_id, count(*) AS total_orders,
  {_money('total_order_value')} AS lifetime_value
FROM {{views}}.v_order_summary GROUP BY customer_unique_id"""

TOP_CATEGORIES = """SELECT coalesce(product_category_name_english, product_category_name) AS category, total_revenue,
  avg_review_score
FROM {views}.v_product_performance ORDER BY total_revenue DESC NULLS FIRST"""

STORED_VIEWS = [
    View("v_customer_lifetime_value", CUSTOMER_LIFETIME_VALUE, ("v_order_summary",), "Orders and value of each person"),
    View("v_top_categories", TOP_CATEGORIES, ("v_product_performance",), "Products by revenue with their category"),
    View("v_order_summary", ORDER_SUMMARY, comment="Orders with their customer, delivery days and totals"),
    View("v_product_performance", PRODUCT_PERFORMANCE, comment="Sales and scores of each product"),
    View("v_seller_performance", SELLER_PERFORMANCE, comment="Sales and scores of each seller"),
]
