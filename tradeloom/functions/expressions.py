"""Scalar and aggregate expressions shared by the marts and the indicators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
# Amounts of up to four decimals are summed exactly, in whole ten-thousandths, so totals do not depend
# on task order as sums of doubles do. Each is split into a high and a low part and both are summed as
# BIGINT: primitive arithmetic (decimal sums take twice as long), and no overflow below 2**43 rows. An
# overflow would raise, not wrap. What the ten-thousandths leave over (more decimals, amounts too large
# for them, infinity, NaN) is summed as DOUBLE beside them; a difference of the size of a double's own
# rounding is none.
MONEY_SCALE = 10_000
LOW_BITS = 20
LARGEST_MONEY = 9e11
ROUNDING = 1e-15

PARTS = ("hi", "lo", "rest")


def money_parts(amount: str) -> dict[str, str]:
    """SQL of the three parts of an amount: high and low ten-thousandths, and the rest."""
    fits = f"abs({amount}) < {LARGEST_MONEY!r}D"
    whole = f"rint({amount} * {MONEY_SCALE})"
    ticks = f"CASE WHEN {fits} THEN CAST({whole} AS BIGINT) WHEN {amount} IS NOT NULL THEN 0L END"
    over = f"({amount} - {whole} / {MONEY_SCALE}.0D)"
    close = f"abs({over}) <= abs({amount}) * {ROUNDING!r}D"
    return {
        "hi": f"shiftright({ticks}, {LOW_BITS})",
        "lo": f"({ticks}) & {(1 << LOW_BITS) - 1}",
        "rest": f"CASE WHEN {fits} THEN CASE WHEN {close} THEN 0.0D ELSE {over} END ELSE CAST({amount} AS DOUBLE) END",
    }


def money_sums(amount: str, name: str) -> list[Column]:
    """The partial sums of an amount (SQL text), to be read back by ``money_total``."""
    return [F.expr(f"sum({sql})").alias(f"{name}_{part}") for part, sql in money_parts(amount).items()]


def money_resums(name: str, weight: str) -> list[Column]:
    """Sums of earlier sums, each counted ``weight`` times."""
    return [F.sum(F.col(f"{name}_{part}") * F.col(weight)).alias(f"{name}_{part}") for part in PARTS]


def money_total(name: str, pick: Callable[[Column], Column] = lambda c: c) -> Column:
    """The total as DOUBLE, NULL when nothing was summed."""
    high, low, rest = (pick(F.col(f"{name}_{part}")).cast("double") for part in PARTS)
    return (high * float(1 << LOW_BITS) + low) / F.lit(float(MONEY_SCALE)) + rest


def ratio(total: Column, count: Column) -> Column:
    """total / count as DOUBLE, NULL (not an ANSI error) when the count is zero or NULL."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def elapsed_micros(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def elapsed_days(start: Column, end: Column) -> Column:
    """Fractional days between two timestamps; negative when the end comes first."""
    return elapsed_micros(start, end) / F.lit(float(MICROS_PER_DAY))


def mean_elapsed_days(start: Column, end: Column) -> Column:
    """Exact average of elapsed days: whole microseconds are summed, then divided once."""
    micros = elapsed_micros(start, end)
    total = F.sum(micros.cast("decimal(20,0)")).cast("double")
    return ratio(total / F.lit(float(MICROS_PER_DAY)), F.count(micros))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole, rounded half up in decimal arithmetic; NULL for an empty whole."""
    share = F.try_divide(part.cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)"), whole.cast("decimal(20,0)"))
    return F.round(share, digits)


def pretty_size(num_bytes: int) -> str:
    """Size text in the manner of a database console: bytes, kB, MB, GB, TB."""
    size, units = int(num_bytes), ["bytes", "kB", "MB", "GB", "TB"]
    while size >= 10 * 1024 and len(units) > 1:
        size = (size + 512) // 1024
        units.pop(0)
    return f"{size} {units[0]}"
