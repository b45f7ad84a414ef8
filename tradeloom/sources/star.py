"""The nine canonical tables derived from a star schema (orders, lineitem, customer, part...).

Everything stays lazy, so a mart that needs two columns of one table scans just those.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Tables = dict[str, DataFrame]


def _zip(key: str) -> Column:
    """A key as a zip prefix of five digits or more; padded, never cut."""
    return F.format_string("%05d", F.col(key))


def _customers(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    return (
        orders.select("o_orderkey", "o_custkey")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("customer_id"),
            F.col("o_custkey").alias("customer_unique_id"),
            _zip("o_custkey").alias("customer_zip_code_prefix"),
            F.col("c_mktsegment").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
        )
    )


def _orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    shipped = lineitem.groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")
    )
    status = F.col("o_orderstatus")
    return orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderkey").alias("customer_id"),
        F.when(status == "F", "delivered").when(status == "O", "shipped").otherwise("canceled").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.col("o_orderdate").alias("order_approved_at"),
        F.col("first_ship").alias("order_delivered_carrier_date"),
        F.when(status == "F", F.col("last_ship")).alias("order_delivered_customer_date"),
        (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("order_estimated_delivery_date"),
    )


def _order_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
    )


def _order_payments(orders: DataFrame) -> DataFrame:
    """High-priority orders are paid 60 : 40, all others at once."""
    total = F.col("o_totalprice").cast("decimal(18,2)")

    def part(number: int, share: str):
        return F.struct(
            F.lit(number).cast("bigint").alias("payment_sequential"),
            (total * F.lit(share).cast("decimal(2,1)")).cast("double").alias("payment_value"),
        )

    split = F.array(part(1, "0.6"), part(2, "0.4"))
    paid = F.when(F.col("o_orderpriority") == "2-HIGH", split).otherwise(F.array(part(1, "1.0")))
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("payment_type"),
        F.lit(1).cast("bigint").alias("payment_installments"),
        F.inline(paid),
    )


def _order_reviews(orders: DataFrame) -> DataFrame:
    """The priority digit is the score. Canceled orders have no review; urgent ones have two."""
    digit = F.substring("o_orderpriority", 1, 1).cast("bigint")

    def review(number: int, score):
        return F.struct(F.lit(number).cast("bigint").alias("review_number"), score.alias("review_score"))

    written = F.when(
        F.col("o_orderpriority") == "1-URGENT", F.array(review(1, digit), review(2, 6 - digit))
    ).otherwise(F.array(review(1, digit)))
    return (
        orders.where(F.col("o_orderstatus") != "P")
        .select(
            F.col("o_orderkey").alias("order_id"),
            (F.col("o_orderdate") + F.expr("INTERVAL 40 DAYS")).alias("review_creation_date"),
            F.inline(written),
        )
        .select(
            F.concat_ws("-", "order_id", "review_number").alias("review_id"),
            "order_id",
            "review_score",
            "review_creation_date",
        )
    )


def _products(part: DataFrame) -> DataFrame:
    size = F.col("p_size").cast("double")
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_size") > 1, F.col("p_type")).alias("product_category_name"),
        F.length("p_name").cast("double").alias("product_name_lenght"),
        size.alias("product_length_cm"),
        (size * 10).alias("product_weight_g"),
    )


def _translation(part: DataFrame) -> DataFrame:
    """PROMO stays untranslated; MEDIUM and STANDARD share one English name."""
    english = F.when(F.col("p_type") == "MEDIUM", "standard").otherwise(F.lower("p_type"))
    return (
        part.where(F.col("p_type") != "PROMO")
        .select(F.col("p_type").alias("product_category_name"), english.alias("product_category_name_english"))
        .distinct()
    )


def _sellers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("seller_id"),
        _zip("s_suppkey").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


def _geolocation(customer: DataFrame, supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """A coordinate per customer and per supplier, so some prefixes have several."""

    def points(df: DataFrame, key: str, nation_key: str, balance: str, city: str) -> DataFrame:
        return df.join(nation, F.col(nation_key) == F.col("n_nationkey")).select(
            _zip(key).alias("geolocation_zip_code_prefix"),
            (F.col(balance) / 1000).alias("geolocation_lat"),
            (-F.col(balance) / 500).alias("geolocation_lng"),
            F.col(city).alias("geolocation_city"),
            F.col("n_name").alias("geolocation_state"),
        )

    return points(customer, "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment").unionAll(
        points(supplier, "s_suppkey", "s_nationkey", "s_acctbal", "s_name")
    )


STAR_TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Canonical table -> (builder, the star tables it takes).
BUILDERS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "customers": (_customers, ("orders", "customer", "nation")),
    "geolocation": (_geolocation, ("customer", "supplier", "nation")),
    "orders": (_orders, ("orders", "lineitem")),
    "order_items": (_order_items, ("lineitem",)),
    "order_payments": (_order_payments, ("orders",)),
    "order_reviews": (_order_reviews, ("orders",)),
    "products": (_products, ("part",)),
    "sellers": (_sellers, ("supplier", "nation")),
    "product_category_translation": (_translation, ("part",)),
}


class StarTables(Mapping):
    """Star tables by name, each opened on first use: opening reads a file footer."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self.opened: Tables = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in STAR_TABLES:
            raise KeyError(name)
        if name not in self.opened:
            self.opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self.opened[name]

    def __iter__(self) -> Iterator[str]:
        return iter(STAR_TABLES)

    def __len__(self) -> int:
        return len(STAR_TABLES)


class CanonicalTables(Mapping):
    """The nine tables by canonical name, each planned on first use."""

    def __init__(self, star: StarTables) -> None:
        self.star = star
        self.planned: Tables = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.planned:
            build, sources = BUILDERS[name]
            self.planned[name] = build(*[self.star[s] for s in sources])
        return self.planned[name]

    def __iter__(self) -> Iterator[str]:
        return iter(BUILDERS)

    def __len__(self) -> int:
        return len(BUILDERS)


def canonical(spark: SparkSession, folder: str) -> CanonicalTables:
    return CanonicalTables(StarTables(spark, folder))
