"""Registered queries over data quality, profiling, casts and models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import column_counts, column_sketches, sketch_counts
from ..plans import models, profiling, quality
from ..sources.files import clean
from ..sources.specs import LINKS
from ..sources.star import StarTables, canonical
from .star_sql import with_star

# The given orders run from 1995 on, so the accepted range is set to fit them.
RANGE = ("1996-01-01", "2000-12-31")
RULES = quality.standard_rules(*RANGE)
MORE_LINKS = [*LINKS, ("orders", "order_id", "order_items", "order_id")]
FRESHNESS = {
    "orders": "order_purchase_timestamp",
    "order_items": "shipping_limit_date",
    "order_reviews": "review_creation_date",
}
AS_OF = "2002-01-01"


def _on(table: str, build):
    return lambda spark, folder: build(canonical(spark, folder)[table])


def _on_all(build):
    return lambda spark, folder: build(canonical(spark, folder))


def _on_star(table: str, build):
    return lambda spark, folder: build(spark.read.parquet(f"{folder}/{table}.parquet"))


def _run_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.run_rules(spark, canonical(spark, folder), RULES)


def _counts(df: DataFrame, name: str) -> DataFrame:
    return profiling.profile(df, name).select(
        "file_name", "total_rows", "total_columns", "column", "position", "non_null_count", "null_count", "unique_count"
    )


def _metric_trend(spark: SparkSession, folder: str) -> DataFrame:
    events = spark.read.parquet(f"{folder}/events.parquet")
    orders = canonical(spark, folder)["orders"]
    history = quality.daily_row_counts(events, "events", "ts", F.col("event_type")).unionAll(
        quality.daily_row_counts(orders, "orders", "order_purchase_timestamp", F.col("order_status"))
    )
    return quality.metric_trend(history)


def _dirty_lines(lineitem: DataFrame) -> DataFrame:
    """Line items as raw text with the kinds of damage the casts must survive."""
    flag = F.col("l_returnflag")

    def text(name: str) -> Column:
        return F.col(name).cast("string")

    quantity = F.when(flag == "R", F.lit("NA")).when(F.col("l_linestatus") == "O", F.concat(text("l_quantity"), F.lit(" pcs")))
    return lineitem.select(
        text("l_orderkey").alias("order_id"),
        F.when(flag == "N", F.lit("nan")).otherwise(F.lpad(text("l_suppkey"), 5, "0")).alias("zip"),
        quantity.otherwise(text("l_quantity")).alias("quantity"),
        F.when(flag == "A", F.lit("n/a")).otherwise(text("l_extendedprice")).alias("price"),
        F.when(flag == "A", F.lit("not a date")).otherwise(text("l_shipdate")).alias("shipped"),
        F.col("l_linenumber").alias("extra"),
    )


def _clean_casts(spark: SparkSession, folder: str) -> DataFrame:
    declared = {
        "order_id": "string", "zip": "string", "quantity": "int", "price": "float", "shipped": "datetime",
        "absent": "int",
    }
    return clean(_dirty_lines(spark.read.parquet(f"{folder}/lineitem.parquet")), declared)


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _suggested(spark: SparkSession, folder: str) -> DataFrame:
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    text = orders.select("o_orderkey", *[F.col(c).cast("string").alias(f"{c}_text") for c in orders.columns])
    return profiling.suggested_types(text, ["o_orderkey"])


def _profile_summary(spark: SparkSession, folder: str) -> DataFrame:
    star = StarTables(spark, folder)
    return profiling.profile_summary(quality.union(profiling.profile(df, name) for name, df in star.items()))


def _approximate(df: DataFrame) -> DataFrame:
    """Counts from sketches, and whether the estimates are within four standard errors of the exact counts."""
    exact = column_counts(df).select("column", F.col("unique_count").alias("exact"))
    got = sketch_counts(column_sketches(df)).join(exact, "column")
    near = F.abs(F.col("unique_count") - F.col("exact")) <= F.greatest(F.lit(1), 0.032 * F.col("exact"))
    return got.select("column", "total_rows", "non_null_count", near.alias("near"))


QUERIES = {
    "dup_check_single": _on("order_items", lambda df: quality.check_duplicates(df, "order_id")),
    "dup_check_composite": _on("order_items", lambda df: quality.check_duplicates(df, ["order_id", "order_item_id"])),
    "date_profile": _on(
        "orders",
        lambda df: quality.profile_date_column(df, "order_delivered_customer_date").withColumn(
            "null_percentage", F.col("null_percentage").cast("double")
        ),
    ),
    "rule_missing_customer": _on("orders", lambda df: quality.violations(df, RULES[0].predicate)),
    "rule_nonpositive_price": _on("order_items", lambda df: quality.violations(df, RULES[1].predicate)),
    "rule_score_range": _on("order_reviews", lambda df: quality.violations(df, RULES[2].predicate)),
    "rule_date_range": _on("orders", lambda df: quality.violations(df, RULES[3].predicate)),
    "rule_delivered_no_date": _on("orders", lambda df: quality.violations(df, RULES[4].predicate)),
    "run_rules": _run_rules,
    "rule_pass_rates": lambda spark, folder: quality.rule_pass_rates(_run_rules(spark, folder)),
    "rule_metrics": lambda spark, folder: quality.rule_metrics(_run_rules(spark, folder)).withColumn(
        "metric_value", F.col("metric_value").cast("double")
    ).drop("details"),
    "test_unique": _on("order_items", lambda df: quality.test_unique(df, "order_id")),
    "test_not_null": _on(
        "orders", lambda df: quality.test_not_null(df, "order_delivered_customer_date").select("order_id", "order_status")
    ),
    "null_audit": _on("orders", quality.null_audit),
    "completeness": _on_all(quality.completeness_report),
    "referential_integrity": _on_all(lambda t: quality.referential_integrity(t, MORE_LINKS)),
    "outliers_iqr": _on_star("documents", lambda df: quality.outliers_iqr(df.select("doc_id", "n_chars"), "n_chars")),
    "outlier_bounds": _on("order_items", lambda df: quality.outlier_bounds(df, "price")),
    "freshness": _on_all(lambda t: quality.freshness(t, FRESHNESS, AS_OF)),
    "metric_trend": _metric_trend,
    "profile_orders": _on_star("orders", lambda df: _counts(df, "orders")),
    "profile_part": _on_star("part", lambda df: _counts(df, "part")),
    "profile_lineitem": _on_star("lineitem", lambda df: _counts(df, "lineitem")),
    "profile_documents": _on_star("documents", lambda df: _counts(df, "documents")),
    "profile_approximate": _on_star("documents", _approximate),
    "profile_samples": _on_star("orders", lambda df: profiling.sample_values(df, ["o_orderkey"])),
    "suggested_types": _suggested,
    "profile_summary": _profile_summary,
    "clean_casts": _clean_casts,
    "model_union": _on_star("orders", lambda df: models.with_null_id(df, "o_custkey")),
    "model_ref_filter": _on_star("orders", lambda df: models.second_model(models.with_null_id(df, "o_custkey"))),
}

_LOW, _HIGH = RANGE
VIOLATIONS = [
    "SELECT COUNT(*) FROM c_orders WHERE customer_id IS NULL",
    "SELECT COUNT(*) FROM c_items WHERE price <= 0",
    "SELECT COUNT(*) FROM c_reviews WHERE review_score < 1 OR review_score > 5",
    f"SELECT COUNT(*) FROM c_orders WHERE bought < TIMESTAMP '{_LOW}' OR bought > TIMESTAMP '{_HIGH}'",
    "SELECT COUNT(*) FROM c_orders WHERE order_status = 'delivered' AND delivered IS NULL",
]


def _violations_sql(i: int) -> str:
    return with_star(f"SELECT ({VIOLATIONS[i]}) AS violations")


def _rule_results() -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT CAST({i + 1} AS BIGINT) AS rule_id, '{r.name}' AS rule_name, '{r.table}' AS table_name,
            CAST(({VIOLATIONS[i]}) AS VARCHAR) AS actual, '0' AS expected, ({VIOLATIONS[i]}) = 0 AS passed,
            '{r.severity}' AS severity"""
        for i, r in enumerate(RULES)
    )


def _completeness_sql(table: str, name: str, columns: list[tuple[str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS table_name, '{column}' AS "column", COUNT(*) AS total_rows,
            COUNT(*) - COUNT({source}) AS null_count,
            CAST(CAST((COUNT(*) - COUNT({source})) * 100.0 / COUNT(*) AS DECIMAL(10,1)) AS DOUBLE) AS null_pct
            FROM {table}"""
        for column, source in columns
    )


ORDER_COLUMNS = [
    ("order_id", "order_id"), ("customer_id", "customer_id"), ("order_status", "order_status"),
    ("order_purchase_timestamp", "bought"), ("order_approved_at", "bought"),
    ("order_delivered_carrier_date", "handed_over"), ("order_delivered_customer_date", "delivered"),
    ("order_estimated_delivery_date", "bought"),
]
ITEM_COLUMNS = [
    (c, c) for c in ("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value")
]
PRODUCT_COLUMNS = [("product_id", "product_id"), ("product_category_name", "native")] + [
    (c, "product_id") for c in ("product_name_lenght", "product_length_cm", "product_weight_g")
]


# Of the other tables: the CTE, and for each column one of the CTE that is NULL where it is.
MORE_COLUMNS = {
    "customers": ("c_customers", [(c, c) for c in (
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state")]),
    "geolocation": ("c_geolocation", [
        ("geolocation_zip_code_prefix", "zip"), ("geolocation_lat", "lat"), ("geolocation_lng", "lng"),
        ("geolocation_city", "zip"), ("geolocation_state", "zip")]),
    "order_payments": ("c_payments", [
        ("order_id", "order_id"), ("payment_type", "order_id"), ("payment_installments", "order_id"),
        ("payment_sequential", "payment_sequential"), ("payment_value", "payment_value")]),
    "order_reviews": ("c_reviews", [
        ("review_id", "order_id"), ("order_id", "order_id"), ("review_score", "review_score"),
        ("review_creation_date", "review_creation_date")]),
    "sellers": ("c_sellers", [
        ("seller_id", "seller_id"), ("seller_zip_code_prefix", "seller_id"), ("seller_city", "seller_city"),
        ("seller_state", "seller_state")]),
    "product_category_translation": ("c_translation", [
        ("product_category_name", "native"), ("product_category_name_english", "english")]),
}


def _orphans_sql() -> str:
    ctes = {
        "orders": "c_orders", "order_items": "c_items", "order_payments": "c_payments", "order_reviews": "c_reviews",
        "products": "c_products", "sellers": "c_sellers", "customers": "c_customers",
    }
    return "\nUNION ALL\n".join(
        f"""SELECT '{child}' AS child_table, '{column}' AS child_column, '{parent}' AS parent_table,
            COUNT(DISTINCT {column}) AS orphan_keys, COUNT(*) AS orphan_rows FROM {ctes[child]}
            WHERE {column} IS NOT NULL AND {column} NOT IN (
                SELECT {key} FROM {ctes[parent]} WHERE {key} IS NOT NULL)"""
        for child, column, parent, key in MORE_LINKS
    )


def _profile_sql(table: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{table}' AS file_name, COUNT(*) AS total_rows, {len(columns)} AS total_columns, '{c}' AS "column",
            {i} AS position, COUNT({c}) AS non_null_count, COUNT(*) - COUNT({c}) AS null_count,
            COUNT(DISTINCT {c}) AS unique_count FROM {table}"""
        for i, c in enumerate(columns)
    )


STAR_COLUMNS = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
    ],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
}


def _samples_sql() -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", CAST(row_number() OVER (ORDER BY o_orderkey) AS INTEGER) AS nth,
            CAST({c} AS VARCHAR) AS value FROM orders WHERE {c} IS NOT NULL
            QUALIFY row_number() OVER (ORDER BY o_orderkey) <= 3"""
        for c in STAR_COLUMNS["orders"]
    )


def _suggested_sql() -> str:
    # Year-like numbers also parse as timestamps in Spark, as they do in pandas.
    head = "(SELECT CAST({c} AS VARCHAR) AS v FROM orders WHERE {c} IS NOT NULL ORDER BY o_orderkey LIMIT 100)"
    parts = ["SELECT 'o_orderkey' AS \"column\", 'bigint' AS dtype, 'numeric' AS suggested_type"]
    for c in STAR_COLUMNS["orders"]:
        parts.append(
            f"""SELECT '{c}_text', 'string', CASE WHEN bool_and(TRY_CAST(v AS TIMESTAMP) IS NOT NULL) THEN 'datetime'
                WHEN bool_and(TRY_CAST(v AS DOUBLE) IS NOT NULL) THEN 'numeric' ELSE 'string' END
                FROM {head.format(c=c)}"""
        )
    return "\nUNION ALL\n".join(parts)


ORACLE = {
    "dup_check_single": with_star("""
        SELECT COUNT(*) AS duplicate_count, CAST(SUM(n - 1) AS BIGINT) AS total_duplicates
        FROM (SELECT order_id, COUNT(*) AS n FROM c_items GROUP BY order_id HAVING COUNT(*) > 1)"""),
    "dup_check_composite": with_star("""
        SELECT COUNT(*) AS duplicate_count, CAST(SUM(n - 1) AS BIGINT) AS total_duplicates
        FROM (SELECT COUNT(*) AS n FROM c_items GROUP BY order_id, order_item_id HAVING COUNT(*) > 1)"""),
    "date_profile": with_star("""
        SELECT CAST(MIN(delivered) AS DATE) AS min_date, CAST(MAX(delivered) AS DATE) AS max_date,
               CAST(CAST(MAX(delivered) AS DATE) - CAST(MIN(delivered) AS DATE) AS INTEGER) AS date_range_days,
               COUNT(*) - COUNT(delivered) AS null_count,
               CAST(CAST((COUNT(*) - COUNT(delivered)) * 100.0 / COUNT(*) AS DECIMAL(5,2)) AS DOUBLE) AS null_percentage
        FROM c_orders"""),
    "rule_missing_customer": _violations_sql(0),
    "rule_nonpositive_price": _violations_sql(1),
    "rule_score_range": _violations_sql(2),
    "rule_date_range": _violations_sql(3),
    "rule_delivered_no_date": _violations_sql(4),
    "run_rules": with_star(_rule_results()),
    "rule_pass_rates": with_star(
        """SELECT table_name, severity, COUNT(*) AS rules, COUNT(*) FILTER (WHERE passed) AS passed_rules,
                  CAST(CAST(COUNT(*) FILTER (WHERE passed) * 100.0 / COUNT(*) AS DECIMAL(10,1)) AS DOUBLE) AS pass_rate
           FROM v_results GROUP BY table_name, severity""",
        v_results=_rule_results(),
    ),
    "rule_metrics": with_star(
        """SELECT table_name, rule_name AS metric_name, CAST(actual AS DOUBLE) AS metric_value,
                  CASE WHEN passed THEN 'PASS' ELSE severity END AS metric_status FROM v_results""",
        v_results=_rule_results(),
    ),
    "test_unique": with_star(
        "SELECT order_id AS unique_field, COUNT(*) AS n_records FROM c_items GROUP BY order_id HAVING COUNT(*) > 1"
    ),
    "test_not_null": with_star("SELECT order_id, order_status FROM c_orders WHERE delivered IS NULL"),
    "null_audit": with_star(
        'SELECT "column", null_count, null_pct FROM v_all WHERE null_count > 0',
        v_all=_completeness_sql("c_orders", "orders", ORDER_COLUMNS),
    ),
    "completeness": with_star(
        "\nUNION ALL\n".join(
            [
                _completeness_sql("c_orders", "orders", ORDER_COLUMNS),
                _completeness_sql("c_items", "order_items", ITEM_COLUMNS),
                _completeness_sql("c_products", "products", PRODUCT_COLUMNS),
                *[_completeness_sql(cte, name, columns) for name, (cte, columns) in MORE_COLUMNS.items()],
            ]
        )
    ),
    "referential_integrity": with_star(_orphans_sql()),
    "outliers_iqr": """
        WITH q AS (SELECT quantile_cont(CAST(n_chars AS DOUBLE), 0.25) AS q1,
                          quantile_cont(CAST(n_chars AS DOUBLE), 0.75) AS q3 FROM documents)
        SELECT doc_id, n_chars, q1 - (q3 - q1) * 1.5 AS lower_bound, q3 + (q3 - q1) * 1.5 AS upper_bound
        FROM documents, q WHERE n_chars < q1 - (q3 - q1) * 1.5 OR n_chars > q3 + (q3 - q1) * 1.5""",
    "outlier_bounds": with_star("""
        SELECT q1, q3, q1 - (q3 - q1) * 1.5 AS lower_bound, q3 + (q3 - q1) * 1.5 AS upper_bound
        FROM (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM c_items)"""),
    "freshness": with_star(
        "\nUNION ALL\n".join(
            f"""SELECT '{name}' AS table_name, MAX({column}) AS latest,
                CAST(DATE '{AS_OF}' - CAST(MAX({column}) AS DATE) AS INTEGER) AS lag_days FROM {table}"""
            for name, column, table in (
                ("orders", "bought", "c_orders"),
                ("order_items", "shipping_limit_date", "c_items"),
                ("order_reviews", "review_creation_date", "c_reviews"),
            )
        )
    ),
    "metric_trend": with_star(
        """SELECT table_name, metric_name, check_timestamp, metric_value,
                  lag(metric_value) OVER w AS previous_value, metric_value - lag(metric_value) OVER w AS change
           FROM v_history WINDOW w AS (PARTITION BY table_name, metric_name ORDER BY check_timestamp)""",
        v_history="""
            SELECT 'events' AS table_name, event_type AS metric_name,
                   CAST(date_trunc('day', ts) AS TIMESTAMP) AS check_timestamp, COUNT(*) AS metric_value
            FROM events GROUP BY ALL
            UNION ALL
            SELECT 'orders', order_status, CAST(date_trunc('day', bought) AS TIMESTAMP), COUNT(*)
            FROM c_orders GROUP BY ALL""",
    ),
    **{f"profile_{name}": _profile_sql(name, columns) for name, columns in STAR_COLUMNS.items()},
    "profile_approximate": "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", COUNT(*) AS total_rows, COUNT({c}) AS non_null_count, TRUE AS near FROM documents"""
        for c in ("doc_id", "text", "lang", "source", "n_chars")
    ),
    "profile_samples": _samples_sql(),
    "suggested_types": _suggested_sql(),
    "profile_summary": """
        SELECT CAST(7 AS BIGINT) AS total_files, CAST(7 AS BIGINT) AS successful_files,
               (SELECT COUNT(*) FROM (DESCRIBE nation)) + (SELECT COUNT(*) FROM (DESCRIBE customer)) +
               (SELECT COUNT(*) FROM (DESCRIBE supplier)) + (SELECT COUNT(*) FROM (DESCRIBE part)) +
               (SELECT COUNT(*) FROM (DESCRIBE orders)) + (SELECT COUNT(*) FROM (DESCRIBE lineitem)) +
               (SELECT COUNT(*) FROM (DESCRIBE events)) AS total_columns,
               (SELECT COUNT(*) FROM nation) + (SELECT COUNT(*) FROM customer) + (SELECT COUNT(*) FROM supplier) +
               (SELECT COUNT(*) FROM part) + (SELECT COUNT(*) FROM orders) + (SELECT COUNT(*) FROM lineitem) +
               (SELECT COUNT(*) FROM events) AS total_rows""",
    "clean_casts": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               CASE WHEN l_returnflag <> 'N' THEN lpad(CAST(l_suppkey AS VARCHAR), 5, '0') END AS zip,
               CASE WHEN l_returnflag = 'R' OR l_linestatus = 'O' THEN 0 ELSE CAST(trunc(l_quantity) AS BIGINT) END AS quantity,
               CASE WHEN l_returnflag <> 'A' THEN l_extendedprice END AS price,
               CASE WHEN l_returnflag <> 'A' THEN l_shipdate END AS shipped,
               l_linenumber AS extra
        FROM lineitem""",
    "model_union": "SELECT o_custkey AS id FROM orders UNION ALL SELECT NULL",
    "model_ref_filter": "SELECT id FROM (SELECT o_custkey AS id FROM orders UNION ALL SELECT NULL) WHERE id = 1",
}
