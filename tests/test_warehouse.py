import json
import uuid

import pytest

from tradeloom.plans import marts, profiling, quality
from tradeloom.sources.files import Manifest, discover, may_break_lines, read_table
from tradeloom.sources.specs import ORDER_REVIEWS, TABLES, Layout
from tradeloom.warehouse import catalog, loading, monitoring

FILES = {
    "shop_customers_dataset.csv": (
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        "c1,u1,01037,sao paulo,SP\nc2,u2,nan,NA,RJ\n"
    ),
    "shop_orders_dataset.csv": (
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
        "order_delivered_customer_date,order_estimated_delivery_date\n"
        "o1,c1,delivered,2018-01-31 10:00:00,,bad date,2018-02-05 12:00:00,2018-02-10\n"
    ),
    "shop_order_items_dataset.csv": (
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,extra\no1,1,p1,s1,2018-02-01,ten,x\no1,2.9,p1,s1,,5.5,y\n"
    ),
    "shop_order_reviews_dataset.csv": (
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
        'r1,o1,abc,,"good, but\n""late"", twice",2018-02-06,\nr2,o1,4.7,nan,,2018-02-07,\n'
    ),
    "product_category_name_translation.csv": "product_category_name,product_category_name_english\nmoveis,furniture\n",
    "empty_products_dataset.csv": "",
    "notes.txt": "not a table",
}


@pytest.fixture()
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path)


@pytest.fixture()
def prefix(spark):
    name = f"t{uuid.uuid4().hex[:8]}_"
    catalog.create_layers(spark, name)
    return name


def test_layers_have_comments(spark, prefix):
    assert spark.catalog.getDatabase(f"{prefix}raw_data").description == catalog.LAYERS["raw_data"]


def test_discover_lists_files_and_folders_of_parts(spark, folder, tmp_path):
    parts = tmp_path / "more_sellers_dataset.csv"
    parts.mkdir()
    (parts / "part-0.csv").write_text("seller_id\ns1\n")
    (parts / "part-1.csv").write_text("seller_id\ns2\n")
    names = [p.rsplit("/", 1)[1] for p in discover(spark, folder)]
    assert names == sorted([*[n for n in FILES if n.endswith(".csv")], "more_sellers_dataset.csv"])
    assert read_table(spark, f"{folder}/more_sellers_dataset.csv", TABLES["sellers"]).count() == 2


def test_multi_line_quoted_text(spark, folder):
    got = read_table(spark, f"{folder}/shop_order_reviews_dataset.csv", ORDER_REVIEWS).orderBy("review_id").collect()
    assert [r.review_score for r in got] == [0, 4]
    assert got[0].review_comment_message == 'good, but\n"late", twice'
    assert got[1].review_comment_title is None


def test_only_files_with_line_breaks_are_read_whole():
    assert may_break_lines("/x/shop_order_reviews_dataset.csv") and may_break_lines("/x/unknown.csv")
    assert not may_break_lines("/x/shop_orders_dataset.csv")


def test_load_all_isolates_failures(spark, folder, prefix):
    raw, history = f"{prefix}raw_data", f"{prefix}data_quality.load_history"
    summary = loading.load_all(spark, folder, raw, history=history)
    status = {r.table_name: (r.status, r.rows) for r in summary.collect()}
    assert status["customers"] == ("SUCCESS", 2) and status["order_reviews"] == ("SUCCESS", 2)
    assert status["products"][0] == "FAILED" and status["sellers"][0] == "FAILED"
    assert loading.loaded_any(summary)
    customers = {r.customer_id: r for r in spark.table(f"{raw}.customers").collect()}
    assert customers["c1"].customer_zip_code_prefix == "01037"
    assert (customers["c2"].customer_zip_code_prefix, customers["c2"].customer_city) == (None, None)
    order = spark.table(f"{raw}.orders").first()
    assert (order.order_approved_at, order.order_delivered_carrier_date) == (None, None)
    items = spark.table(f"{raw}.order_items").orderBy("order_item_id")
    assert [(r.order_item_id, r.price, r.extra) for r in items.collect()] == [(1, None, "x"), (2, 5.5, "y")]
    # A second load replaces the tables and appends to the history with new ids.
    loading.load_all(spark, folder, raw, history=history)
    stored = spark.table(history).collect()
    assert len(stored) == 18 and len({r.load_id for r in stored}) == 18
    assert spark.table(f"{raw}.customers").count() == 2
    assert catalog.add_comments(spark, raw) == 5 + 3
    described = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {raw}.orders").collect()}
    assert described["order_status"] == TABLES["orders"].column_comments["order_status"]


def test_manifest_load(spark, folder, prefix, tmp_path):
    text = json.dumps({
        "files": [
            {"file": "product_category_name_translation.csv", "table": "translation", "format": "csv", "header": True},
            {"file": "missing.csv", "table": "missing", "format": "csv", "header": True},
        ],
        "target_schema": f"{prefix}raw_data",
    })
    (tmp_path / "manifest.json").write_text(text)
    manifest = Manifest.from_file(spark, f"{folder}/manifest.json")
    got = {r.table_name: (r.status, r.rows) for r in loading.load_manifest(spark, manifest, folder).collect()}
    assert got == {"translation": ("SUCCESS", 1), "missing": ("FAILED", None)}


def test_layouts_keep_rows_and_prune(spark, shop, prefix):
    raw = f"{prefix}raw_data"
    items = shop["order_items"]
    for layout in (
        None,
        Layout(sort_by=("order_id",)),
        Layout(sort_by=("order_id",), range_clustered=True),
        Layout(partition_by=("seller_id",), sort_by=("order_id",)),
        Layout(bucket_by=("order_id",), buckets=4),
    ):
        catalog.write_table(items, raw, "items", layout)
        stored = spark.table(f"{raw}.items").select(items.columns)
        assert sorted(map(str, stored.collect())) == sorted(map(str, items.collect()))


def test_bucketed_join_and_group_need_no_exchange(spark, shop, prefix):
    raw = f"{prefix}raw_data"
    layout = Layout(bucket_by=("order_id",), buckets=4)
    for name in ("order_items", "order_reviews"):
        catalog.write_table(shop[name], raw, name, layout)
    t = {n: spark.table(f"{raw}.{n}") for n in ("order_items", "order_reviews")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        from tradeloom.operators.rollups import item_measures, with_review_weights

        lines = t["order_items"].groupBy("order_id", "product_id").agg(*item_measures())
        plan = with_review_weights(lines, t["order_reviews"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan


def test_refresh_views_stats(spark, shop, prefix):
    raw, marts_db = f"{prefix}raw_data", f"{prefix}analytics"
    for name, df in shop.items():
        catalog.write_table(df, raw, name, TABLES[name].layout)
    t = catalog.load_tables(spark, raw)
    assert set(t) == set(TABLES)
    got = {r.name: r.row_count for r in catalog.refresh_all(spark, t, marts_db).collect()}
    assert got == {"mv_daily_orders": 4, "mv_customer_ltv": 4, "mv_category_performance": 2}
    again = catalog.refresh_all(spark, t, marts_db, ["mv_daily_orders"]).collect()
    assert [(r.name, r.row_count) for r in again] == [("mv_daily_orders", 4)]
    assert catalog.create_views(spark, t) == list(marts.VIEWS)
    assert spark.table("v_order_summary").count() == 5
    before = catalog.table_stats(spark, raw, "orders").first()
    assert (before.row_count, before.column_count, before.last_analyzed) == (5, 5, None)
    assert catalog.analyze_schema(spark, raw).count() == 9
    after = catalog.table_stats(spark, raw, "orders").first()
    assert after.last_analyzed is not None and after.table_size != "0 bytes"


def test_rules_and_metrics_are_stored(spark, shop, prefix):
    raw, checks = f"{prefix}raw_data", f"{prefix}data_quality"
    for name in ("orders", "order_items", "order_reviews"):
        catalog.write_table(shop[name], raw, name)
    rules = [quality.Rule(r.name, r.table, sql=r.query(raw), severity=r.severity) for r in quality.standard_rules()]
    monitoring.store_rules(spark, rules, f"{checks}.validation_rules")
    results = quality.run_stored_rules(spark, f"{checks}.validation_rules")
    direct = quality.run_rules(spark, shop, quality.standard_rules())
    assert sorted(map(str, results.collect())) == sorted(map(str, direct.collect()))
    for _ in range(2):
        monitoring.append_metrics(spark, quality.rule_metrics(results), f"{checks}.quality_metrics")
    stored = spark.table(f"{checks}.quality_metrics").collect()
    assert len(stored) == 10 and len({r.metric_id for r in stored}) == 10
    assert json.loads(stored[0].details)["expected"] == "0"


def test_profile_folder(spark, folder, tmp_path):
    profiles = profiling.profile_folder(spark, folder)
    got = {(r.file_name, r.column): r for r in profiles.collect()}
    status = got["shop_orders_dataset.csv", "order_status"]
    assert (status.total_rows, status.total_columns, status.unique_count, status.sample_values) == (1, 8, 1, ["delivered"])
    assert got["shop_orders_dataset.csv", "order_purchase_timestamp"].suggested_type == "datetime"
    assert got["shop_orders_dataset.csv", "order_delivered_carrier_date"].suggested_type == "string"
    assert got["shop_orders_dataset.csv", "order_approved_at"].suggested_type == "numeric"
    message = got["shop_order_reviews_dataset.csv", "review_comment_message"]
    assert (message.non_null_count, message.null_count, message.null_pct) == (1, 1, 50.0)
    assert got["empty_products_dataset.csv", None].error
    summary = profiling.profile_summary(profiles).first()
    assert tuple(summary) == (6, 5, 5 + 8 + 7 + 7 + 2, 8)
    out = str(tmp_path / "profile")
    profiling.write_profile_json(profiles, out)
    files = {r.file_name: r for r in spark.read.json(out).collect()}
    assert [c.column for c in files["product_category_name_translation.csv"]["columns"]] == [
        "product_category_name", "product_category_name_english",
    ]
    assert files["empty_products_dataset.csv"].error


def test_profile_against_pandas(spark):
    import pandas as pd

    rows = [(i % 7, None if i % 3 else f"t{i % 5}" + "x" * (i % 90), float(i % 4) * (-1 if i % 8 else 0)) for i in range(500)]
    pdf = pd.DataFrame(rows, columns=["a", "b", "c"])
    df = spark.createDataFrame(rows, "a int, b string, c double")
    got = {r.column: r for r in profiling.profile(df, "t").collect()}
    for c in pdf.columns:
        assert (got[c].non_null_count, got[c].unique_count) == (pdf[c].count(), pdf[c].nunique())
        assert len(got[c].sample_values) == 3
    assert got["b"].sample_values == pdf["b"].dropna().head(3).tolist()
    assert [got[c].suggested_type for c in pdf.columns] == ["numeric", "string", "numeric"]
