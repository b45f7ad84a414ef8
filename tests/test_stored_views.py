"""Stored views: their rows, another session, needs, replacing, dropping and making them again."""

import math

import pytest

from tradeloom.plans import marts
from tradeloom.plans.models import run_models
from tradeloom.plans.view_sql import STORED_VIEWS, View
from tradeloom.warehouse import catalog, views


@pytest.fixture(scope="module")
def stored(spark, shop):
    for name in ("views_raw", "views_out"):
        spark.sql(f"CREATE DATABASE {name}")
    for name, df in shop.items():
        catalog.write_table(df, "views_raw", name)
    made = views.store_views(spark, "views_raw", "views_out")
    yield made
    for name in ("views_raw", "views_out"):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(df):
    def plain(v):
        return round(v, 9) if isinstance(v, float) and math.isfinite(v) else v

    return sorted(str([plain(r[c]) for c in sorted(df.columns)]) for r in df.collect())


def test_same_rows_as_the_marts(spark, shop, stored):
    summary, performance = marts.order_summary(shop), marts.product_performance(shop)
    want = {
        "v_order_summary": summary,
        "v_product_performance": performance,
        "v_seller_performance": marts.seller_performance(shop),
        "v_customer_lifetime_value": marts.customer_lifetime_value(summary),
        "v_top_categories": marts.top_categories(performance),
    }
    assert set(want) == set(stored) == {v.name for v in STORED_VIEWS}
    other = spark.newSession()
    for name, df in want.items():
        got = other.table(f"views_out.{name}")
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in df.schema], name
        assert rows(got) == rows(df), name


def test_needs_come_first(stored):
    assert stored.index("v_order_summary") < stored.index("v_customer_lifetime_value")
    with pytest.raises(ValueError, match="need each other"):
        views.in_order([View("a", "", ("b",)), View("b", "", ("a",))])


def test_replace_drop_and_restore(spark, stored):
    views.store_views(spark, "views_raw", "views_out", [View("v_one", "SELECT 1 AS n"), View("v_two", "SELECT n + 1 AS n FROM {views}.v_one", ("v_one",))])
    views.store_views(spark, "views_raw", "views_out", [View("v_one", "SELECT 5 AS n")])
    assert spark.table("views_out.v_two").first().n == 6
    with pytest.raises(Exception, match="no_such_table"):
        views.store_views(spark, "views_raw", "views_out", [View("v_one", "SELECT * FROM no_such_table")])
    assert spark.table("views_out.v_one").first().n == 5
    with pytest.raises(ValueError, match="needed by v_two"):
        views.drop_view(spark, "views_out", "v_one")
    for name in ("v_two", "v_one", "v_order_summary"):
        spark.sql(f"DROP VIEW views_out.{name}")
    assert {r["name"] for r in views.list_views(spark, "views_out").where("NOT stored").collect()} == {"v_two", "v_one", "v_order_summary"}
    again = views.restore(spark, "views_out")
    assert len(again) == len(stored) + 2 and spark.table("views_out.v_two").first().n == 6
    for name in ("v_two", "v_one"):
        views.drop_view(spark, "views_out", name)
    assert not spark.catalog.tableExists("views_out.v_one") and views.registered(spark, "views_out").keys() == set(stored)


def test_a_model_is_a_view_of_its_database(spark):
    done = run_models(spark)
    first, second = done["first_model"], done["second_model"]
    assert rows(spark.newSession().table("dbt_dev.second_model")) == rows(second) == rows(first.where("id = 1"))
