"""Registered jobs that write: CSV and manifest loads, refresh, statistics, monitoring.

Each run uses databases and a folder of its own, under the shared work folder.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import quality
from ..session import work_dir
from ..sources.files import Manifest, read_inferred, read_table
from ..sources.specs import ORDER_ITEMS, TABLES
from ..sources.star import canonical
from ..warehouse import catalog, loading, monitoring
from .check_queries import RULES
from .mart_queries import CUSTOMER_LTV, DAILY_ORDERS
from .star_sql import with_star

# How many columns the adapter gives each table.
COLUMNS = {
    "customers": 5, "geolocation": 5, "orders": 8, "order_items": 7, "order_payments": 5, "order_reviews": 4,
    "products": 5, "sellers": 4, "product_category_translation": 2,
}
STORED = ("customers", "orders", "order_items", "order_reviews", "products", "product_category_translation")


def _layers(spark: SparkSession) -> str:
    """New databases for this run; returns their name prefix."""
    prefix = f"run_{uuid.uuid4().hex[:12]}_"
    catalog.create_layers(spark, prefix, work_dir(spark, "warehouse"))
    return prefix


def _file_name(table: str) -> str:
    return TABLES[table].file_pattern.replace("*", "shop_")


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def _csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = work_dir(spark, "csv")
    _write_csv(canonical(spark, folder)["order_items"], path)
    return read_table(spark, path, ORDER_ITEMS)


def _csv_line_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with line breaks, written to CSV by as many tasks as read them, and read back in splits."""
    path = work_dir(spark, "csv")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "text")
    whole = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    docs.write.options(**whole).csv(path)
    back = read_inferred(spark, path, multi_line=True)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.length(text).alias("n_chars"), F.sha2(text, 256).alias("text_sha256"))


def _load_all(spark: SparkSession, folder: str) -> DataFrame:
    """All files but the sellers, whose absence must not stop the rest."""
    source, prefix = work_dir(spark, "raw"), _layers(spark)
    for name, df in canonical(spark, folder).items():
        if name != "sellers":
            _write_csv(df, f"{source}/{_file_name(name)}")
    history = f"{prefix}data_quality.load_history"
    loading.load_all(spark, source, f"{prefix}raw_data", history=history)
    return spark.table(history).select("table_name", "load_status", "rows_loaded")


def _manifest_load(spark: SparkSession, folder: str) -> DataFrame:
    source, prefix = work_dir(spark, "manifest"), _layers(spark)
    for name, df in canonical(spark, folder).items():
        _write_csv(df, f"{source}/{name}.csv")
    text = json.dumps({
        "files": [{"file": f"{n}.csv", "table": f"{n}_dataset", "format": "csv", "header": True} for n in TABLES],
        "target_schema": f"{prefix}raw_data",
    })
    summary = loading.load_manifest(spark, Manifest.from_json(text), source)
    return summary.select("table_name", "status", "rows")


def _stored(spark: SparkSession, folder: str, names: tuple[str, ...]) -> str:
    prefix = _layers(spark)
    t = canonical(spark, folder)
    for name in names:
        catalog.write_table(t[name], f"{prefix}raw_data", name, TABLES[name].layout)
    return prefix


def _refresh_all(spark: SparkSession, folder: str) -> DataFrame:
    prefix = _stored(spark, folder, STORED)
    t = catalog.load_tables(spark, f"{prefix}raw_data")
    return catalog.refresh_all(spark, t, f"{prefix}analytics").select("name", "row_count")


def _analyze_schema(spark: SparkSession, folder: str) -> DataFrame:
    prefix = _stored(spark, folder, tuple(TABLES))
    return catalog.analyze_schema(spark, f"{prefix}raw_data")


def _table_stats(spark: SparkSession, folder: str) -> DataFrame:
    schema = f"{_stored(spark, folder, ('order_items',))}raw_data"
    # The size is known before anything was analyzed.
    known = F.col("table_size") != "0 bytes"
    return catalog.table_stats(spark, schema, "order_items").select("row_count", "column_count", known.alias("has_size"))


def _quality_metrics(spark: SparkSession, folder: str) -> DataFrame:
    prefix = _layers(spark)
    table = f"{prefix}data_quality.quality_metrics"
    results = quality.run_rules(spark, canonical(spark, folder), RULES)
    monitoring.append_metrics(spark, quality.rule_metrics(results), table)
    return spark.table(table).selectExpr(
        "table_name", "metric_name", "CAST(metric_value AS DOUBLE) AS metric_value", "metric_status"
    )


def _stored_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rules kept in a table and run by their stored SQL over stored tables."""
    prefix = _stored(spark, folder, ("orders", "order_items", "order_reviews"))
    table = f"{prefix}data_quality.validation_rules"
    rules = [quality.Rule(r.name, r.table, sql=r.query(f"{prefix}raw_data"), severity=r.severity) for r in RULES]
    monitoring.store_rules(spark, rules, table)
    return quality.run_stored_rules(spark, table)


QUERIES = {
    "csv_round_trip": _csv_round_trip,
    "csv_line_breaks": _csv_line_breaks,
    "load_all_summary": _load_all,
    "manifest_load": _manifest_load,
    "refresh_all": _refresh_all,
    "analyze_schema": _analyze_schema,
    "table_stats": _table_stats,
    "quality_metrics": _quality_metrics,
    "stored_rules": _stored_rules,
}


def _loaded(table: str, cte: str) -> str:
    return f"SELECT '{table}' AS table_name, 'SUCCESS' AS load_status, COUNT(*) AS rows_loaded FROM {cte}"


def _oracle() -> dict[str, str]:
    from .check_queries import ORACLE as CHECKS

    loaded = {
        "customers": "c_customers", "geolocation": "c_geolocation", "orders": "c_orders", "order_items": "c_items",
        "order_payments": "c_payments", "order_reviews": "c_reviews", "products": "c_products",
        "product_category_translation": "c_translation",
    }
    return {
        "csv_round_trip": with_star("""
            SELECT CAST(order_id AS VARCHAR) AS order_id, order_item_id, CAST(product_id AS VARCHAR) AS product_id,
                   CAST(seller_id AS VARCHAR) AS seller_id, shipping_limit_date, price, freight_value FROM c_items"""),
        "csv_line_breaks": """
            SELECT doc_id, nullif(lang, '') AS lang, CAST(length(coalesce(text, '')) AS INTEGER) AS n_chars, sha256(coalesce(text, '')) AS text_sha256
            FROM documents""",
        "load_all_summary": with_star(
            "\nUNION ALL\n".join(
                [*[_loaded(t, c) for t, c in loaded.items()], "SELECT 'sellers', 'FAILED', NULL"]
            )
        ),
        "manifest_load": with_star("\nUNION ALL\n".join(
            f"SELECT '{n}_dataset' AS table_name, 'SUCCESS' AS status, COUNT(*) AS rows FROM {c}"
            for n, c in {**loaded, "sellers": "c_sellers"}.items()
        )),
        "refresh_all": with_star(
            """SELECT 'mv_daily_orders' AS name, (SELECT COUNT(*) FROM v_daily) AS row_count
               UNION ALL SELECT 'mv_customer_ltv', (SELECT COUNT(*) FROM v_ltv)
               UNION ALL SELECT 'mv_category_performance', (
                   SELECT COUNT(DISTINCT COALESCE(english, p.native))
                   FROM c_products p LEFT JOIN c_translation t ON t.native = p.native
                   WHERE product_id IN (SELECT product_id FROM c_items))""",
            v_daily=DAILY_ORDERS,
            v_ltv=CUSTOMER_LTV,
        ),
        "analyze_schema": with_star("\nUNION ALL\n".join(
            f"SELECT '{n}' AS table_name, COUNT(*) AS row_count, CAST({COLUMNS[n]} AS BIGINT) AS columns FROM {c}"
            for n, c in {**loaded, "sellers": "c_sellers"}.items()
        )),
        "table_stats": "SELECT COUNT(*) AS row_count, 7 AS column_count, TRUE AS has_size FROM lineitem",
        "quality_metrics": CHECKS["rule_metrics"],
        "stored_rules": CHECKS["run_rules"],
    }


ORACLE = _oracle()
