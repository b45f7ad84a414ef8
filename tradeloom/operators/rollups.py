"""Roll-ups that carry item and review measures without joining raw rows to raw rows.

Items and reviews both hang off an order, so a plain items-reviews join repeats every item
once per review of its order (and the reverse). The marts want exactly those repeated totals.
They are reached here by arithmetic: reviews are reduced to one row per order, and its review
count multiplies the item sums. No product of two groups is ever written out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import money_resums, money_sums


def per_key(df: DataFrame, key: str, *measures: Column) -> DataFrame:
    """One row per non-NULL key, ready to be joined to a side whose keys may be skewed.

    Grouping also on a hash of the key changes no result, but the rows then arrive hashed on
    two columns, so joining on the key gives this side its own exchange. AQE splits a hot key
    only when both join inputs are exchanges. A table bucketed on the key still needs none.
    Where the other side has few rows per key, a plain ``groupBy`` saves that exchange.
    """
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key, F.xxhash64(key).alias("_spread"))
        .agg(*measures)
        .drop("_spread")
    )


def review_measures() -> list[Column]:
    """Review rows, scored rows and the score total."""
    return [
        F.count("*").alias("reviews"),
        F.count("review_score").alias("scored"),
        F.sum("review_score").alias("score_total"),
    ]


def item_sums() -> list[Column]:
    """Exact sums of price, freight and both; NULL when no line has a value."""
    return [
        *money_sums("price", "price"),
        *money_sums("freight_value", "freight"),
        *money_sums("(price + freight_value)", "value"),
    ]


def item_measures() -> list[Column]:
    """Line counts next to the sums; Catalyst drops the ones a mart does not use."""
    return [
        F.count("*").alias("lines"),
        F.count("price").alias("priced"),
        F.count("freight_value").alias("freighted"),
        *item_sums(),
    ]


def with_review_weights(lines: DataFrame, reviews: DataFrame) -> DataFrame:
    """Left-join the reviews of the order. ``copies`` is how often the plain join repeats a line."""
    joined = lines.join(per_key(reviews, "order_id", *review_measures()), "order_id", "left")
    return joined.select(
        *lines.columns,
        F.coalesce("reviews", F.lit(1)).alias("copies"),
        F.coalesce("scored", F.lit(0)).alias("scored"),
        F.coalesce("score_total", F.lit(0)).alias("score_total"),
    )


def reviewed_lines(items: DataFrame, reviews: DataFrame, *keys: str) -> DataFrame:
    """Item sums per order and ``keys``, with the review weights of the order.

    The reviews join the raw items, so one exchange on the order serves the join and the grouping.
    """
    joined = with_review_weights(items.select("order_id", *keys, "price", "freight_value"), reviews)
    weights = [F.max(name).alias(name) for name in ("copies", "scored", "score_total")]
    return joined.groupBy("order_id", *keys).agg(*item_measures(), *weights)


def weighted_sums() -> list[Column]:
    """Sums over the plain join: prices once per review of the order, scores once per line."""
    return [
        *money_resums("price", "copies"),
        *money_resums("freight", "copies"),
        F.sum(F.col("priced") * F.col("copies")).alias("priced"),
        F.sum(F.col("freighted") * F.col("copies")).alias("freighted"),
        F.sum(F.col("score_total") * F.col("lines")).alias("score_total"),
        F.sum(F.col("scored") * F.col("lines")).alias("scored"),
    ]
