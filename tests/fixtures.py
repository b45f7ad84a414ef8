"""Hand-written canonical tables. Orders:

o1  two items, two reviews (fan-out), delivered       p1 x2 from s1
o2  delivered without a date, one item without freight p2 from s1
o3  canceled, no items, one review without a score
o4  before 2016, person u1 again but in another state  p3 (no category) from s2
o5  last day of the range at noon, no customer         p4 (untranslated), price missing
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def tables(spark: SparkSession) -> dict[str, DataFrame]:
    def frame(rows: list[tuple], schema: str) -> DataFrame:
        return spark.createDataFrame(rows, schema)

    return {
        "customers": frame(
            [
                ("c1", "u1", "01037", "sao paulo", "SP"),
                ("c2", "u2", "20031", "rio", "RJ"),
                ("c3", "u3", "01037", "sao paulo", "SP"),
                ("c4", "u1", "99999", "rio", "RJ"),
            ],
            "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, "
            "customer_state string",
        ),
        "geolocation": frame(
            [("01037", -23.5, -46.6, "sao paulo", "SP"), ("01037", -23.7, -46.8, "são paulo", "SP"), ("20031", -22.9, -43.2, "rio", "RJ")],
            "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
            "geolocation_city string, geolocation_state string",
        ),
        "orders": frame(
            [
                ("o1", "c1", "delivered", at("2018-01-31T00:00:00"), at("2018-02-05T12:00:00")),
                ("o2", "c2", "delivered", at("2018-01-31T10:00:00"), None),
                ("o3", "c3", "canceled", at("2018-02-28T00:00:00"), None),
                ("o4", "c4", "delivered", at("2015-12-31T23:59:59"), at("2016-01-01T23:59:59")),
                ("o5", None, "shipped", at("2020-12-31T12:00:00"), None),
            ],
            "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
            "order_delivered_customer_date timestamp_ntz",
        ),
        "order_items": frame(
            [
                ("o1", 1, "p1", "s1", 10.10, 1.05),
                ("o1", 2, "p1", "s1", 20.20, 2.00),
                ("o2", 1, "p2", "s1", 0.0, None),
                ("o4", 1, "p3", "s2", 7.0, 0.5),
                ("o5", 1, "p4", "s2", None, 3.0),
            ],
            "order_id string, order_item_id bigint, product_id string, seller_id string, price double, "
            "freight_value double",
        ),
        "order_payments": frame(
            [("o1", 1, "card", 20.0), ("o1", 2, "voucher", 13.35), ("o2", 1, "card", 5.0), ("o3", 1, "card", None)],
            "order_id string, payment_sequential bigint, payment_type string, payment_value double",
        ),
        "order_reviews": frame(
            [("r1", "o1", 5), ("r2", "o1", 2), ("r3", "o2", 6), ("r4", "o3", None), ("r5", "o4", 1), ("r6", "gone", 0)],
            "review_id string, order_id string, review_score bigint",
        ),
        "products": frame(
            [
                ("p1", "moveis"), ("p2", "mobilia"), ("p3", None), ("p4", "sem_nome"), ("p5", "moveis"),
            ],
            "product_id string, product_category_name string",
        ),
        "sellers": frame(
            [("s1", "sao paulo", "SP"), ("s2", "rio", "RJ"), ("s3", "rio", "RJ")],
            "seller_id string, seller_city string, seller_state string",
        ),
        "product_category_translation": frame(
            [("moveis", "furniture"), ("mobilia", "furniture")],
            "product_category_name string, product_category_name_english string",
        ),
    }
