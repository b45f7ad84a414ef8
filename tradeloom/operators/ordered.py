"""Order-dependent operators that never sort the whole input in one task."""

from __future__ import annotations

import math
import operator
import struct
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import small_frame
from .clustering import place_of, unused

#: Counts of one pass and digit; also the most rows that a last pass counts by value.
DIGIT_BITS = 12
DIGITS = 1 << DIGIT_BITS
KEY_BITS = 64


def order_key(value: Column) -> Column:
    """The bits of a DOUBLE as a BIGINT that sorts as the value does; -0.0 and 0.0 are one.

    A positive double's bits grow with it. They are its exponent, a logarithm put right where rounding missed it,
    and its fraction, which a division by a power of two leaves exact. Negative values are the negative keys.
    """
    size = F.abs(value)
    tiny = size < 2.0**-1022
    guess = F.floor(F.log2(size))
    guess = F.when(F.pow(F.lit(2.0), guess) > size, guess - 1).when(F.pow(F.lit(2.0), guess + 1) <= size, guess + 1).otherwise(guess)
    guess = F.greatest(F.least(guess, F.lit(1023)), F.lit(-1022))
    fraction = ((size / F.pow(F.lit(2.0), guess) - 1) * 2.0**52).cast("bigint")
    normal = F.shiftleft(guess.cast("bigint") + 1023, 52) + fraction
    bits = F.when(size == 0, F.lit(0)).when(size == float("inf"), F.lit(2047 << 52)).when(tiny, (size * 2.0**537 * 2.0**537).cast("bigint")).otherwise(normal)
    return F.when(value < 0, -bits).otherwise(bits)


def from_order_key(key: int) -> float:
    """The value of a key."""
    size = struct.unpack(">d", struct.pack(">q", abs(key)))[0]
    return -size if key < 0 else size


def _select(known: DataFrame, wanted: Callable[[int], set[int]], fetch: int) -> tuple[int, dict[int, int]]:
    """The number of rows, and the key at each wanted place (from 0) in ascending order.

    A pass counts the next digit of the keys that share the leading digits of a wanted place, and each place
    descends into the digit that holds it. Once those hold no more than ``fetch`` rows, the rest is counted by
    value. At most six passes; none sorts or shuffles more than counts.
    """
    total, shift, before, held = None, KEY_BITS, KEY_BITS, 0
    at: dict[int, int] = {}  # place wanted -> place among the rows with its leading digits
    leading: dict[int, int] = {}  # place wanted -> those digits
    while True:
        shift = max(shift - DIGIT_BITS, 0)
        rows = known
        if total is not None:
            rows = known.where(F.shiftright("_k", before).isin(sorted(set(leading.values()))))
            if held <= fetch:
                shift = 0
        counted = rows.groupBy(F.shiftright("_k", shift).alias("digits")).count().collect()
        counts = sorted((r["digits"], r["count"]) for r in counted)
        if total is None:
            total = sum(n for _, n in counts)
            at = {p: p for p in wanted(total)}
            if not total:
                return 0, {}
        for place, rest in at.items():
            own = [(d, n) for d, n in counts if place not in leading or d >> (before - shift) == leading[place]]
            for digits, n in own:
                if rest < n:
                    break
                rest -= n
            at[place], leading[place] = rest, digits
        if shift == 0:
            return total, leading
        sizes = dict(counts)
        held, before = sum(sizes[d] for d in set(leading.values())), shift


def exact_quantiles(df: DataFrame, value: str, probabilities: dict[str, float], fetch: int = DIGITS) -> DataFrame:
    """One row of linearly interpolated quantiles, one DOUBLE column per name. NULL and NaN are
    left out.

    Same definition as SQL PERCENTILE_CONT, which gathers the column in one task. Here the order statistics are
    selected digit by digit on the 64 bits of the values: every pass scans the column and brings at most 4096 counts
    for each wanted place to the driver. No task holds more than its split, whatever the values, and however many
    rows are equal. The passes run when this is called.
    """
    c = F.col(value).cast("double")
    known = df.where(F.col(value).isNotNull() & ~F.isnan(c)).select(order_key(c).alias("_k"))

    def places(total: int) -> dict[str, tuple[int, int, float]]:
        found = {}
        for name, p in probabilities.items():
            at = float(p) * (total - 1)
            found[name] = (math.floor(at), math.ceil(at), at - math.floor(at))
        return found

    total, keys = _select(known, lambda n: {x for low, high, _ in places(n).values() for x in (low, high)} if n else set(), fetch)
    row: list[float | None] = [None] * len(probabilities)
    if total:
        at = {place: from_order_key(key) for place, key in keys.items()}
        row = [at[low] + part * (at[high] - at[low]) for low, high, part in places(total).values()]
    return small_frame(df.sparkSession, [tuple(row)], ", ".join(f"`{name}` double" for name in probabilities))


def with_previous(
    df: DataFrame, group: list[str], order: str, value: str, previous: str, bucket: Column
) -> DataFrame:
    """LAG(value) OVER (PARTITION BY group ORDER BY order), splitting a long group into buckets.

    ``bucket`` must grow with ``order`` (e.g. its month). Inside a bucket the lag is local; the
    first row of a bucket takes the last value of the group's preceding bucket.
    """
    cut = df.withColumn("_bucket", bucket)
    local = Window.partitionBy(*group, "_bucket").orderBy(order)
    lasts = (
        cut.groupBy(*group, "_bucket")
        .agg(F.max_by(F.struct(F.col(value).alias("v")), order).alias("_last"))
        .withColumn("_carried", F.lag("_last").over(Window.partitionBy(*group).orderBy("_bucket")))
        .select("_carried", *[F.col(k).alias(f"_key{i}") for i, k in enumerate([*group, "_bucket"])])
    )
    rows = cut.withColumn("_nth", F.row_number().over(local)).withColumn(previous, F.lag(value).over(local))
    # NULL is a group of its own in a window, so the groups are matched null-safe.
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate([*group, "_bucket"])]
    earlier = F.when(F.col("_nth") == 1, F.col("_carried.v")).otherwise(F.col(previous))
    return rows.join(lasts, reduce(operator.and_, same), "left").select(*df.columns, earlier.alias(previous))


#: Cut points that divide the values to be ranked into ranges.
RANK_BITS = 10


def with_rank(df: DataFrame, value: str, name: str, descending: bool = True, bits: int = RANK_BITS) -> DataFrame:
    """Add the SQL RANK of ``value`` over all rows, as BIGINT; NULL ranks first if descending, also first if not.

    No task sorts the whole input. Equal values meet first, as (value, rows). Cut points, the values with the
    least hashes, divide those into ranges; each range adds up its own rows in order, and the total of
    the ranges before it is carried into it: at most ``2**bits`` numbers. Both are scalar subqueries, so nothing
    runs while the plan is built, and the same values give the same cuts in every task that is run again.
    """
    key, rows = unused(df, "_value"), unused(df, "_rows")
    counts = df.groupBy(F.col(f"`{value}`").alias(key)).agg(F.count("*").alias(rows))
    most = (1 << bits) - 1
    sample = counts.where(F.col(key).isNotNull()).orderBy(F.xxhash64(key), key).limit(most)
    cuts = sample.agg(F.array_sort(F.collect_list(key)).alias("cuts"))
    at = place_of(F.col(key), F.col("_cuts"), bits)
    # Ranges are numbered in the order of the ranks; that of NULL lies before all others.
    place = F.when(F.col(key).isNull(), F.lit(-(1 << bits))).otherwise(-at if descending else at)
    placed = counts.withColumn("_cuts", cuts.scalar()).select(key, rows, place.alias("_place"))
    totals = placed.groupBy("_place").agg(F.sum(rows).alias("total"))
    totals = totals.agg(F.collect_list(F.struct("_place", "total")).alias("totals"))
    before = F.aggregate(
        F.filter("_totals", lambda t: t["_place"] < F.col("_place")), F.lit(0).cast("bigint"), lambda sum_, t: sum_ + t["total"]
    )
    order = F.col(key).desc_nulls_first() if descending else F.col(key).asc_nulls_first()
    inside = Window.partitionBy("_place").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        placed.withColumn("_inside", F.coalesce(F.sum(rows).over(inside), F.lit(0)))
        .withColumn("_totals", totals.scalar())
        .select(key, (before + F.col("_inside") + 1).alias(name))
    )
    # Equal values, however many, get their rank by a join that AQE can split.
    return df.join(ranked, F.col(f"`{value}`").eqNullSafe(F.col(key)), "left").drop(key)
