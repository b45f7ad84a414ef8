import random

from pyspark.sql import functions as F

from tradeloom.plans import marts


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns[:1])).collect()]


def test_order_summary(shop):
    got = {r.order_id: r for r in marts.order_summary(shop).collect()}
    assert len(got) == 5
    o1 = got["o1"]
    assert (o1.customer_unique_id, o1.customer_state, o1.product_count) == ("u1", "SP", 1)
    assert o1.delivery_days == 5.5
    assert (o1.total_product_value, o1.total_freight_value, o1.total_order_value) == (30.3, 3.05, 33.35)
    # No items: zero products, NULL totals.
    assert (got["o3"].product_count, got["o3"].total_order_value, got["o3"].delivery_days) == (0, None, None)
    # A line without freight has no value of its own.
    assert (got["o2"].total_product_value, got["o2"].total_freight_value, got["o2"].total_order_value) == (0.0, None, None)
    assert (got["o5"].customer_unique_id, got["o5"].total_product_value, got["o5"].total_freight_value) == (None, None, 3.0)


def test_repeated_attribute_rows_fold_like_a_grouped_join(shop):
    """Keys are not enforced: a repeated order or product row doubles sums, not rows or counts."""
    doubled = {**shop, "orders": shop["orders"].unionAll(shop["orders"]), "products": shop["products"].unionAll(shop["products"])}
    plain = {r.order_id: r for r in marts.order_summary(shop).collect()}
    for r in marts.order_summary(doubled).collect():
        base = plain[r.order_id]
        assert r.product_count == base.product_count
        assert r.total_order_value == (None if base.total_order_value is None else 2 * base.total_order_value)
    products = {r.product_id: r for r in marts.product_performance(doubled).collect()}
    assert len(products) == 5
    assert (products["p1"].times_ordered, products["p1"].total_revenue, products["p1"].avg_price) == (1, 121.2, 15.15)


def test_product_performance_counts_items_once_per_review(shop):
    got = {r.product_id: tuple(r)[1:] for r in marts.product_performance(shop).collect()}
    assert got == {
        # 2 lines x 2 reviews: revenue 2 * 30.30, mean price unchanged, mean score of 5 and 2.
        "p1": ("moveis", "furniture", 1, 60.6, 15.15, 3.5),
        "p2": ("mobilia", "furniture", 1, 0.0, 0.0, 6.0),
        "p3": (None, None, 1, 7.0, 7.0, 1.0),
        "p4": ("sem_nome", None, 1, None, None, None),
        "p5": ("moveis", "furniture", 0, None, None, None),
    }


def test_seller_performance(shop):
    got = rows(marts.seller_performance(shop))
    assert got == [
        ("s1", "sao paulo", "SP", 2, 2, 60.6, 60.6 / 5, 6.1 / 4, (5 + 2 + 5 + 2 + 6) / 5),
        ("s2", "rio", "RJ", 2, 2, 7.0, 7.0, 1.75, 1.0),
        ("s3", "rio", "RJ", 0, 0, None, None, None, None),
    ]


def test_category_performance_merges_labels_and_ranks_nulls_first(shop):
    got = {r.category: tuple(r)[1:] for r in marts.category_performance(shop).collect()}
    assert got == {
        "sem_nome": (1, 1, None, None, None, 1),
        "furniture": (2, 2, 60.6, 60.6 / 5, 4.0, 2),
    }


def test_customer_ltv_is_per_person_and_state(shop):
    got = {(r.customer_unique_id, r.customer_state): r for r in marts.customer_ltv(shop).collect()}
    assert set(got) == {("u1", "SP"), ("u1", "RJ"), ("u2", "RJ"), ("u3", "SP")}
    assert (got["u1", "SP"].total_orders, got["u1", "SP"].lifetime_value, got["u1", "SP"].avg_review_score) == (1, 66.7, 3.5)
    assert (got["u1", "RJ"].lifetime_value, got["u1", "RJ"].avg_review_score) == (7.5, 1.0)
    assert (got["u3", "SP"].total_orders, got["u3", "SP"].lifetime_value, got["u3", "SP"].avg_review_score) == (1, None, None)


def test_daily_orders(shop):
    got = {str(r.order_date): r for r in marts.daily_orders(shop).collect()}
    day = got["2018-01-31"]
    assert (day.order_count, day.unique_customers, day.delivered_orders, day.cancelled_orders) == (2, 2, 2, 0)
    assert str(day.avg_delivery_days) == "5.50"
    assert (got["2018-02-28"].cancelled_orders, got["2018-02-28"].avg_delivery_days) == (1, None)
    assert got["2020-12-31"].unique_customers == 0


def test_summary_datasets(shop):
    summary = marts.order_summary(shop)
    value = {r.customer_unique_id: (r.total_orders, r.lifetime_value) for r in marts.customer_lifetime_value(summary).collect()}
    # Unlike customer_ltv, no review weighting and one row per person.
    assert value == {"u1": (2, 40.85), "u2": (1, None), "u3": (1, None), None: (1, None)}
    geo = {r.customer_state: (r.orders, r.avg_delivery) for r in marts.geo_sales(summary).collect()}
    assert geo == {"SP": (2, 5.5), "RJ": (2, 1.0), None: (1, None)}


def test_top_categories_puts_unsold_products_on_top(shop):
    got = [r.total_revenue for r in marts.top_categories(marts.product_performance(shop)).collect()]
    assert got == [None, None, 60.6, 7.0, 0.0]


def test_previews_are_the_head_of_the_view(shop):
    for preview, view, key in (
        (marts.order_summary_preview, marts.order_summary, "order_id"),
        (marts.product_performance_preview, marts.product_performance, "product_id"),
        (marts.seller_performance_preview, marts.seller_performance, "seller_id"),
    ):
        assert rows(preview(shop, 2), key) == rows(view(shop), key)[:2]


def test_geo_lookup_averages_per_prefix(shop):
    got = {r.customer_id: (r.latitude, r.longitude) for r in marts.geo_lookup(shop).collect()}
    assert got == {"c1": (-23.6, -46.7), "c3": (-23.6, -46.7), "c2": (-22.9, -43.2), "c4": (None, None)}


def test_rollups_equal_the_plain_join_on_random_data(spark):
    """The review-weight arithmetic against the row-by-row join, with NULLs and hot keys."""
    rng = random.Random(7)

    def pick(prefix, n, hot=0.35):
        return f"{prefix}0" if rng.random() < hot else rng.choice([None] + [f"{prefix}{i}" for i in range(n)])

    money = [None, 0.0, 1.25, 9.99, 100.01]
    shop = {
        "order_items": spark.createDataFrame(
            [(pick("o", 40), i, pick("p", 12), pick("s", 5), rng.choice(money), rng.choice(money)) for i in range(400)],
            "order_id string, order_item_id bigint, product_id string, seller_id string, price double, freight_value double",
        ),
        "order_reviews": spark.createDataFrame(
            [(pick("o", 40, 0.2), rng.choice([None, 0, 1, 3, 5])) for _ in range(80)], "order_id string, review_score bigint"
        ),
        "products": spark.createDataFrame(
            [(f"p{i}", rng.choice([None, "a", "b", "c"])) for i in range(14)], "product_id string, product_category_name string"
        ),
        "product_category_translation": spark.createDataFrame(
            [("a", "x"), ("b", "x")], "product_category_name string, product_category_name_english string"
        ),
        "sellers": spark.createDataFrame(
            [(f"s{i}", "city", "ST") for i in range(6)], "seller_id string, seller_city string, seller_state string"
        ),
        "customers": spark.createDataFrame(
            [(f"c{i}", f"u{i % 7}", f"ST{i % 2}") for i in range(30)],
            "customer_id string, customer_unique_id string, customer_state string",
        ),
        "orders": spark.createDataFrame(
            [(f"o{i}", pick("c", 30, 0.3)) for i in range(40)], "order_id string, customer_id string"
        ).withColumn("order_purchase_timestamp", F.expr("TIMESTAMP_NTZ '2018-01-01'")),
    }
    for name, df in shop.items():
        df.createOrReplaceTempView(name)
    total = "CAST(sum(CAST(price AS DECIMAL(18,4))) AS DOUBLE)"
    both = "CAST(sum(CAST(price AS DECIMAL(18,4)) + CAST(freight_value AS DECIMAL(18,4))) AS DOUBLE)"
    score = "avg(review_score)"
    sales = "LEFT JOIN order_reviews r ON i.order_id = r.order_id"
    translated = "LEFT JOIN product_category_translation t ON p.product_category_name = t.product_category_name"
    expected = {
        marts.product_performance: f"""
            SELECT p.product_id, p.product_category_name, product_category_name_english, count(DISTINCT i.order_id),
                   {total}, try_divide({total}, count(price)), {score}
            FROM products p LEFT JOIN order_items i ON p.product_id = i.product_id {sales} {translated}
            GROUP BY ALL""",
        marts.seller_performance: f"""
            SELECT s.seller_id, seller_city, seller_state, count(DISTINCT i.order_id), count(DISTINCT i.product_id),
                   {total}, try_divide({total}, count(price)),
                   try_divide(CAST(sum(CAST(freight_value AS DECIMAL(18,4))) AS DOUBLE), count(freight_value)), {score}
            FROM sellers s LEFT JOIN order_items i ON s.seller_id = i.seller_id {sales} GROUP BY ALL""",
        marts.category_performance: f"""
            SELECT coalesce(product_category_name_english, p.product_category_name) AS category,
                   count(DISTINCT i.order_id), count(DISTINCT i.product_id), {total}, try_divide({total}, count(price)), {score},
                   rank() OVER (ORDER BY {total} DESC NULLS FIRST)
            FROM products p {translated} JOIN order_items i ON p.product_id = i.product_id {sales}
            WHERE p.product_category_name IS NOT NULL GROUP BY 1""",
        marts.customer_ltv: f"""
            SELECT customer_unique_id, customer_state, count(DISTINCT o.order_id), min(order_purchase_timestamp),
                   max(order_purchase_timestamp), {both}, {score}
            FROM customers c JOIN orders o ON c.customer_id = o.customer_id
            LEFT JOIN order_items i ON o.order_id = i.order_id LEFT JOIN order_reviews r ON o.order_id = r.order_id
            GROUP BY customer_unique_id, customer_state""",
    }
    for build, sql in expected.items():
        want = sorted((tuple(r) for r in spark.sql(sql).collect()), key=str)
        got = sorted((tuple(r) for r in build(shop).collect()), key=str)
        assert len(got) == len(want), build.__name__
        for g, w in zip(got, want, strict=True):
            assert g == w, (build.__name__, g, w)
