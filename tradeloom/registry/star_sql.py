"""The star-to-canonical mapping of ``sources.star`` as SQL, for the oracle queries."""

CTES = {
    "c_customers": """
        SELECT o_orderkey AS customer_id, o_custkey AS customer_unique_id,
               printf('%05d', o_custkey) AS customer_zip_code_prefix,
               c_mktsegment AS customer_city, n_name AS customer_state
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "c_orders": """
        SELECT o_orderkey AS order_id, o_orderkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
               o_orderdate AS bought, first_ship AS handed_over,
               CASE WHEN o_orderstatus = 'F' THEN last_ship END AS delivered
        FROM orders LEFT JOIN (
            SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM lineitem GROUP BY ALL
        ) ON o_orderkey = l_orderkey""",
    "c_items": """
        SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_shipdate AS shipping_limit_date, l_extendedprice AS price,
               l_extendedprice * l_tax AS freight_value,
               CAST(l_extendedprice AS DECIMAL(18,4)) AS price_m,
               CAST(l_extendedprice * l_tax AS DECIMAL(18,4)) AS freight_m
        FROM lineitem""",
    "c_payments": """
        SELECT o_orderkey AS order_id, CAST(1 AS BIGINT) AS payment_sequential,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(
                   CASE WHEN o_orderpriority = '2-HIGH' THEN 0.6 ELSE 1.0 END AS DECIMAL(2,1)) AS DOUBLE) AS payment_value
        FROM orders
        UNION ALL
        SELECT o_orderkey, CAST(2 AS BIGINT),
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.4 AS DECIMAL(2,1)) AS DOUBLE)
        FROM orders WHERE o_orderpriority = '2-HIGH'""",
    "c_reviews": """
        SELECT o_orderkey AS order_id, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS review_score,
               o_orderdate + INTERVAL 40 DAY AS review_creation_date
        FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL
        SELECT o_orderkey, 6 - CAST(substr(o_orderpriority, 1, 1) AS BIGINT), o_orderdate + INTERVAL 40 DAY
        FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT'""",
    "c_products": """
        SELECT p_partkey AS product_id, CASE WHEN p_size > 1 THEN p_type END AS native FROM part""",
    "c_translation": """
        SELECT DISTINCT p_type AS native, CASE WHEN p_type = 'MEDIUM' THEN 'standard' ELSE lower(p_type) END AS english
        FROM part WHERE p_type <> 'PROMO'""",
    "c_sellers": """
        SELECT s_suppkey AS seller_id, s_name AS seller_city, n_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "c_geolocation": """
        SELECT printf('%05d', c_custkey) AS zip, c_acctbal / 1000 AS lat, -c_acctbal / 500 AS lng
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        UNION ALL
        SELECT printf('%05d', s_suppkey), s_acctbal / 1000, -s_acctbal / 500
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
}


def with_star(body: str, **more: str) -> str:
    """A query over the canonical CTEs it mentions, and over further CTEs given by name."""
    known = {**CTES, **more}
    wanted: set[str] = set()

    def mark(text: str) -> None:
        for name, sql in known.items():
            if name not in wanted and name in text:
                wanted.add(name)
                mark(sql)

    mark(body)
    parts = ",\n".join(f"{name} AS ({sql})" for name, sql in known.items() if name in wanted)
    return f"WITH {parts}\n{body}" if parts else body
