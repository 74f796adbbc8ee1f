"""Calendar counts over request tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counts_by_period(
    df: DataFrame, date: str, pattern: str, *, where: Column | None = None, name: str = "period", count: str = "rows"
) -> DataFrame:
    """Row counts per formatted date, in order; ``pattern`` as ``yyyy-MM`` or ``yyyy``."""
    rows = df if where is None else df.where(where)
    return (
        rows.groupBy(F.date_format(date, pattern).alias(name))
        .agg(F.count(F.lit(1)).alias(count))
        .orderBy(name)
    )
