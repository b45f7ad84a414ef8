import datetime as dt
from collections import defaultdict
from decimal import Decimal

import numpy as np
from pyspark.sql import functions as F

from tradeloom.operators.ordered import exact_quantiles
from tradeloom.plans import quality
from tradeloom.plans.models import MODELS, failing_rows, run_models


def test_check_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1), ("b", 1)], "k string, n int")
    assert tuple(quality.check_duplicates(df, "k").first()) == (2, 3)
    assert tuple(quality.check_duplicates(df, ["k", "n"]).first()) == (2, 2)
    assert tuple(quality.check_duplicates(df.where("k = 'b'"), "k").first()) == (0, None)


def test_unique_test_agrees_with_duplicates(shop):
    for table, key in (("order_items", "order_id"), ("customers", "customer_unique_id")):
        failing = quality.test_unique(shop[table], key).collect()
        count, extra = quality.check_duplicates(shop[table], key).first()
        assert (len(failing), sum(r.n_records - 1 for r in failing)) == (count, extra)


def test_date_profile(spark, shop):
    got = quality.profile_date_column(shop["orders"], "order_delivered_customer_date").first()
    assert tuple(got) == (dt.date(2016, 1, 1), dt.date(2018, 2, 5), 766, 3, Decimal("60.00"))
    empty = quality.profile_date_column(shop["orders"].where("order_id = 'o2'"), "order_delivered_customer_date").first()
    assert tuple(empty) == (None, None, None, 1, Decimal("100.00"))


def test_rules(spark, shop):
    got = quality.run_rules(spark, shop, quality.standard_rules()).orderBy("rule_id").collect()
    # o5 has no customer; p2 costs 0; scores 6 and 0; o4 is too early and o5 is after the last
    # midnight; o2 has no date.
    assert [(r.actual, r.passed) for r in got] == [("1", False), ("1", False), ("2", False), ("2", False), ("1", False)]
    assert [r.severity for r in got] == ["ERROR"] * 3 + ["WARNING"] * 2
    rates = {(r.table_name, r.severity): r.pass_rate for r in quality.rule_pass_rates(quality.run_rules(spark, shop, quality.standard_rules())).collect()}
    assert rates["orders", "ERROR"] == 0.0


def test_inactive_and_sql_rules(spark, shop):
    shop["orders"].createOrReplaceTempView("shop_orders")
    rules = [
        quality.Rule("off", "orders", "TRUE", active=False),
        quality.Rule("five orders", "orders", sql="SELECT COUNT(*) FROM shop_orders", expected="5"),
        quality.Rule("null result", "orders", sql="SELECT CAST(NULL AS INT)"),
    ]
    got = quality.run_rules(spark, shop, rules).orderBy("rule_id").collect()
    assert [(r.rule_id, r.actual, r.passed) for r in got] == [(2, "5", True), (3, None, False)]


def test_links(shop):
    got = {(r.child_table, r.parent_table): (r.orphan_keys, r.orphan_rows) for r in quality.referential_integrity(shop).collect()}
    assert got["order_reviews", "orders"] == (1, 1)
    assert got["orders", "customers"] == (0, 0)
    assert got["order_items", "products"] == (0, 0)


def test_completeness_and_null_audit(shop):
    got = {(r.table_name, r.column): (r.null_count, r.null_pct) for r in quality.completeness_report(shop).collect()}
    assert got["orders", "customer_id"] == (1, 20.0)
    assert got["order_items", "price"] == (1, 20.0)
    audit = quality.null_audit(shop["orders"]).collect()
    assert {r.column for r in audit} == {"customer_id", "order_delivered_customer_date"}


def test_exact_quantiles_against_numpy(spark):
    rng = np.random.default_rng(3)
    samples = {
        "spread": rng.normal(size=2001),
        "ties": np.repeat([1.0, 2.0, 2.0, 9.0], 500),
        "two": np.array([1.0, 4.0]),
        "one": np.array([5.0]),
        "hot": np.concatenate([np.full(700, 3.0), rng.uniform(size=1300)]),
    }
    wanted = {"p10": 0.10, "q1": 0.25, "mid": 0.5, "q3": 0.75, "max": 1.0}
    for name, values in samples.items():
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(4)
        # A coarse sketch forces several values into each bracket.
        for k in (50, 4000):
            got = exact_quantiles(df, "v", wanted, k).first()
            np.testing.assert_allclose([got[w] for w in wanted], np.quantile(values, list(wanted.values())), rtol=1e-12, err_msg=name)
    empty = exact_quantiles(spark.createDataFrame([], "v double"), "v", wanted).first()
    assert set(empty) == {None}


def test_outliers(spark):
    df = spark.createDataFrame([(i, float(i % 10)) for i in range(100)] + [(100, 500.0), (101, None)], "id int, v double")
    got = quality.outliers_iqr(df, "v").collect()
    assert [(r.id, r.v) for r in got] == [(100, 500.0)]
    assert got[0].lower_bound < 0 < got[0].upper_bound < 500


def test_freshness(shop):
    got = quality.freshness(shop, {"orders": "order_purchase_timestamp"}, "2021-01-10").first()
    assert (got.table_name, got.lag_days) == ("orders", 10)


def test_metric_trend_equals_a_plain_lag(spark):
    day = dt.datetime(2020, 1, 1)
    # Metric "hot" holds most rows and spans many months, with empty months in between.
    history = [("t", "hot", day + dt.timedelta(days=int(n * n / 3)), n * 1.5 if n % 5 else None) for n in range(60)]
    history += [("t", "cold", day + dt.timedelta(days=40 * n), float(n)) for n in range(4)]
    df = spark.createDataFrame(history, "table_name string, metric_name string, check_timestamp timestamp_ntz, metric_value double")
    want = defaultdict(list)
    for _, name, at, value in sorted(history, key=lambda r: r[2]):
        before = want[name][-1][1] if want[name] else None
        want[name].append((at, value, before))
    for name, expected in want.items():
        got = quality.metric_trend(df).where(F.col("metric_name") == name).orderBy("check_timestamp").collect()
        assert [(r.check_timestamp, r.metric_value, r.previous_value) for r in got] == expected


def test_models(spark):
    done = run_models(spark)
    assert sorted((r.id for r in done["first_model"].collect()), key=str) == [1, None]
    assert [r.id for r in done["second_model"].collect()] == [1]
    assert spark.catalog.tableExists("dbt_dev.first_model")
    results = {
        m.name: {r.test: r.failures for r in failing_rows(done[m.name], m).collect()} for m in MODELS
    }
    # The first model is meant to fail its not_null test.
    assert results == {"first_model": {"unique": 0, "not_null": 1}, "second_model": {"unique": 0, "not_null": 0}}


def test_model_kind_and_target(spark):
    prod = run_models(spark, target="prod")
    assert spark.catalog.tableExists("analytics.first_model")
    assert "analytics_second_model" in [t.name for t in spark.catalog.listTables() if t.isTemporary]
    assert prod["second_model"].count() == 1
