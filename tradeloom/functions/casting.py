"""Forgiving casts from CSV text to the four declared types.

Spark 4 is ANSI by default, so a plain cast of a bad value raises. These never do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts pandas reads as missing by default.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


# Spark raises and catches an exception for each bad text in a failed cast, and also takes Java
# forms such as "1d" for numbers, so numbers are recognized first.
WHOLE = r"^\s*[+-]?[0-9]{1,19}\s*$"
NUMBER = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*(?:[eE][+-]?[0-9]+)?|\.[0-9]+(?:[eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"


def as_text(c: Column) -> Column:
    """Text with every missing-value spelling turned into NULL. Leading zeros stay."""
    return F.when(~c.isin(MISSING_TEXTS), c)


def as_float(c: Column) -> Column:
    """DOUBLE, NULL when missing or unparseable. The pattern takes none of the missing texts."""
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def as_int(c: Column) -> Column:
    """BIGINT with the fraction cut off; missing or unparseable gives 0, not NULL."""
    whole = F.when(c.rlike(WHOLE), c.try_cast("bigint"))
    return F.coalesce(whole, as_float(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def as_datetime(c: Column) -> Column:
    """TIMESTAMP_NTZ, NULL when unparseable."""
    return as_text(c).try_cast("timestamp_ntz")


CASTS = {"string": as_text, "int": as_int, "float": as_float, "datetime": as_datetime}
