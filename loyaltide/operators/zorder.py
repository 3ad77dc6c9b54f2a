"""Clustering by several columns at once, along a space-filling curve.

Each column's values become the number of one of 2**bits buckets of about equal
rows, taken from a quantile sketch; the bits of the buckets' numbers, interleaved
with the highest first, are the place of a row on a Z-shaped curve through all
columns. Rows that are near on the curve are near in every column, so files cut
along it hold a narrow range of each of them, where a sort by the columns in
turn leaves all but the first spread over all files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loyaltide.functions.columns import quoted

BITS = 8  # buckets per column: 256
SKETCH_ACCURACY = 10_000


def place_on_line(field: T.StructField) -> Column:
    """The column as a double in the same order, so far as a double tells; text by its first six bytes."""
    value = quoted(field.name)
    match field.dataType:
        case T.StringType() | T.BinaryType() | T.VarcharType() | T.CharType():
            head = F.rpad(F.hex(F.substring(value.cast("binary"), 1, 6)), 12, "0")
            return F.conv(head, 16, 10).cast("double")
        case T.TimestampType() | T.TimestampNTZType() | T.DateType():
            return F.unix_micros(value.cast("timestamp")).cast("double")
        case T.BooleanType():
            return value.cast("int").cast("double")
        case T.NumericType():
            return F.nullif(value.cast("double"), F.lit(float("nan")))
    raise ValueError(f"a table cannot be ordered by {field.name} of type {field.dataType.simpleString()}")


def bucket_edges(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> list[list[float]]:
    """Per column the lower edges of the buckets 1, 2, ...: one pass, and 2**bits - 1 numbers a column."""
    shares = [i / 2 ** bits for i in range(1, 2 ** bits)]
    found = df.agg(*[F.percentile_approx(place_on_line(df.schema[c]), shares, SKETCH_ACCURACY) for c in columns]).first()
    return [list(edges or [0.0] * len(shares)) for edges in found]


def bucket(place: Column, edges: Sequence[float], bits: int = BITS) -> Column:
    """The number of edges at or below the place, by bisection; 0 for null."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    known = F.lit(list(edges))

    def step(low: Column, size: Column) -> Column:
        return F.when(place >= F.get(known, low + size - 1), low + size).otherwise(low)

    return F.aggregate(steps, F.lit(0), step)


def curve_place(buckets: Sequence[Column], bits: int = BITS) -> Column:
    """The buckets' bits interleaved, the first column's highest bit in front."""
    parts = []
    for bit in range(bits):
        for at, number in enumerate(buckets):
            own = F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("bigint")
            parts.append(F.shiftleft(own, bit * len(buckets) + len(buckets) - 1 - at))
    place = parts[0]
    for part in parts[1:]:
        place = place.bitwiseOR(part)
    return place


def z_ordered(df: DataFrame, columns: Sequence[str], files: int | None = None, bits: int = BITS) -> DataFrame:
    """``df`` ranged and sorted along the curve through ``columns``; ``files`` is the number of ranges.

    ``df`` is read three times (edges, ranges, rows), so it should be stored. Rows
    with one place may be split over several ranges by a hash of the row.
    """
    if not columns or bits * len(columns) > 62:
        raise ValueError("the curve's places have 62 bits, for all columns together")
    edges = bucket_edges(df, columns, bits)
    rows = df.withColumns({f"__bucket_{i}": bucket(place_on_line(df.schema[c]), e, bits)
                           for i, (c, e) in enumerate(zip(columns, edges))})
    numbers = [F.col(f"__bucket_{i}") for i in range(len(columns))]
    placed = rows.withColumn("__place", curve_place(numbers, bits))
    keys = (F.col("__place"), F.xxhash64(*map(quoted, df.columns)))
    ranged = placed.repartitionByRange(files, *keys) if files else placed.repartitionByRange(*keys)
    return ranged.sortWithinPartitions("__place").select(*map(quoted, df.columns))
