"""Places of values among cut points, and Z-order keys made of them.

Cut points come from a sample of bounded size. They decide where rows lie, never what a result is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows sampled for the cuts of a layout, and the bits that a Z-order key has at most.
SAMPLE_ROWS = 1 << 14
KEY_BITS = 60
MOST_BITS = 10


def place_of(value: Column, cuts: Column, bits: int) -> Column:
    """How many of the ascending ``cuts`` (fewer than 2**bits) are at most the value; 0 for NULL.

    A binary search of ``bits`` steps in an array: no join, no shuffle.
    """
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(bits))])

    def step(at: Column, width: Column) -> Column:
        return F.when(F.get(cuts, at + width - 1) <= value, at + width).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def cut_points(df: DataFrame, columns: tuple[str, ...], bits: int, rows: int = SAMPLE_ROWS) -> list[list]:
    """Ascending different cut points for each column, fewer than 2**bits, from a sample of rows.

    The sample is the rows that a generator gives the least numbers: each task keeps ``rows`` at most.
    """
    wanted = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(columns)]
    sample = df.select(*wanted).orderBy(F.rand(7)).limit(rows)
    sets = sample.agg(*[F.array_sort(F.collect_list(f"_{i}")).alias(f"_{i}") for i in range(len(columns))]).first()
    most = (1 << bits) - 1
    found = []
    for values in sets:
        values = [v for v in values if v == v]  # NaN is beyond every cut
        different = sorted(set(values))
        if len(different) > most:
            different = sorted({values[(n + 1) * len(values) // (most + 1)] for n in range(most)})
        found.append(different)
    return found


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_zorder_key(df: DataFrame, columns: tuple[str, ...], name: str, bits: int | None = None) -> DataFrame:
    """Add a BIGINT whose bits are those of the places of all ``columns``, interleaved.

    Rows near in the key are near in every column, so files and row groups cut from that order have
    narrow ranges in each of them. Places are spread over the whole scale: a column of eight values
    has its three bits among the highest. NULL counts with the smallest values. Where no column has
    a value, as in an empty table, there is nothing to order by and no key is added.
    """
    bits = bits or min(MOST_BITS, KEY_BITS // len(columns))
    types = df.select(*[F.col(f"`{c}`") for c in columns]).schema.fields
    places = {}
    for j, (column, cuts) in enumerate(zip(columns, cut_points(df, columns, bits), strict=True)):
        if cuts:
            literal = F.array(*[F.lit(c) for c in cuts]).cast(f"array<{types[j].dataType.simpleString()}>")
            place = place_of(F.col(f"`{column}`"), literal, bits)
            places[unused(df, f"{name}_{j}")] = (j, F.floor(place * F.lit(1 << bits) / F.lit(len(cuts) + 1)).cast("bigint"))
    if not places:
        return df
    key, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    for column, (j, _) in places.items():
        for i in range(bits):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(F.col(column), i).bitwiseAND(one), i * len(columns) + j))
    # The places are columns of their own first, so that each is searched once a row.
    placed = df.withColumns({column: place for column, (_, place) in places.items()})
    return placed.withColumn(name, key).drop(*places)
