"""Explicit row order: packed ordinals, first-seen numbering, display sorts."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evalflow.session import settle


def pack_order(*parts: tuple[Column, int]) -> Column:
    """Several integers as one ``decimal(38,0)`` that sorts like them.

    Each part comes with the number of decimal digits kept for it; a negative value or
    one with more digits is an error. A fixed-width ordinal lets
    last-write-wins aggregates hash instead of sort. Parts are first put together
    as longs of up to 18 digits, which leaves little decimal arithmetic.
    """
    if sum(width for _, width in parts) > 38:
        raise ValueError("the digits do not fit decimal(38)")
    longs: list[tuple[Column, int]] = []
    for part, width in parts:
        value = part.cast("long")
        # a value with more digits would spill into its neighbour
        value = F.when(value.isNull() | value.between(0, 10**width - 1), value).otherwise(
            F.raise_error(F.concat(F.lit(f"no place for more than {width} digits: "), value.cast("string"))).cast("long")
        )
        if longs and longs[-1][1] + width <= 18:
            head, digits = longs.pop()
            longs.append((head * 10**width + value, digits + width))
        else:
            longs.append((value, width))
    packed = None
    below = sum(width for _, width in longs)
    for value, width in longs:
        below -= width
        shifted = value.cast("decimal(18,0)") * F.lit(Decimal(10**below))
        packed = shifted if packed is None else packed + shifted
    return packed.cast("decimal(38,0)")


def leading_digits(packed: Column, digits: int, keep: int) -> Column:
    """First digits of a packed ordinal: buckets that never decrease along it."""
    return F.left(F.lpad(packed.cast("string"), digits, "0"), F.lit(keep)).cast("long")


def number_in_order(groups: DataFrame, order: Column, bucket: Column, id_col: str = "id") -> DataFrame:
    """0-based dense ids in the order of ``order``, without a one-task window.

    ``bucket`` must not decrease along ``order`` and splits the rows into small
    ranges. Rows are numbered inside their bucket; bucket sizes, one row per
    bucket, give each bucket's start. The result does not depend on
    partitioning, so a retried task numbers its rows the same way. The groups
    are read twice, so they are settled first.
    """
    marked = settle(groups.withColumns({"_order": order, "_bucket": bucket}))
    sizes = marked.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("_bucket").alias("_b"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("_order"))
    return (
        marked.withColumn("_place", place)
        .join(starts, F.col("_bucket") == F.col("_b"))
        .withColumn(id_col, (F.col("_start") + F.col("_place") - 1).cast("long"))
        .drop("_order", "_bucket", "_b", "_start", "_place")
    )


def sorted_nulls_last(df: DataFrame, keys: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """Global ascending sort with nulls last.

    ``ties`` lists further columns: they make the order total, and let the range
    shuffle cut through a key that holds a large share of the rows.
    """
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in [*keys, *ties]])


def sorted_nulls_as_blank(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Global sort where a null text counts as the empty text."""
    return df.orderBy(*[F.coalesce(F.col(k), F.lit("")) for k in keys])
