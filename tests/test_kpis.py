import datetime as dt
from decimal import Decimal

from tradeloom.plans.kpis import LABELS, PACKS, kpi, kpi_report


def test_every_indicator_belongs_to_one_pack():
    named = [name for names in PACKS.values() for name in names]
    assert sorted(named) == sorted(LABELS) and len(named) == 21


def test_values(shop):
    expected = {
        "total_orders": 5,
        "orders_with_reviews": 4,
        "unique_customers": 3,
        "repeat_customers": 1,
        "active_sellers": 2,
        "product_categories": 3,
        "first_order_date": dt.date(2015, 12, 31),
        "last_order_date": dt.date(2020, 12, 31),
        "coverage_months": 59,
        "total_revenue": Decimal("38.35"),
        # Two orders have a paid total; the unpaid third does not count.
        "avg_order_value": Decimal("19.18"),
        "avg_product_price": Decimal("9.33"),
        "avg_freight": Decimal("1.64"),
        "avg_review_score": Decimal("2.80"),
        "five_star_reviews": "1 (16.7%)",
        "one_star_reviews": "1 (16.7%)",
        "states_with_orders": 2,
        "cities_with_orders": 2,
        "top_state": "RJ (2 orders)",
        "delivered_orders": "3 (60.0%)",
        "cancelled_orders": "1 (20.0%)",
    }
    assert {name: kpi(shop, name).first()[0] for name in LABELS} == expected


def test_report_has_the_same_values_as_text(spark, shop):
    report = kpi_report(spark, shop).orderBy("position").collect()
    assert [r.check_name for r in report] == [label for _, label in LABELS.values()]
    assert [r.value for r in report[:1]] == ["5"]
    for row, name in zip(report, LABELS, strict=True):
        assert row.value == str(kpi(shop, name).first()[0])


def test_report_isolates_a_missing_table_and_empty_tables(spark, shop):
    broken = {k: v for k, v in shop.items() if k != "products"}
    broken["order_payments"] = shop["order_payments"].limit(0)
    broken["order_reviews"] = shop["order_reviews"].drop("review_score")
    got = {r.check_name: r.value for r in kpi_report(spark, broken).collect()}
    assert got["Product Categories"].startswith("Error")
    assert got["5-Star Reviews"].startswith("Error")
    assert got["Total Revenue (BRL)"] == "No data"
    assert got["Total Orders"] == "5"
