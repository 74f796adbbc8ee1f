"""Long metric rows to nested metric structs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalflow import constants as C
from evalflow.functions.literals import literal


def last_values(df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Column) -> DataFrame:
    """Last row wins per key, and ``first_seen``, the smallest ordinal of the key.

    A null written last stays null. All buffers have fixed width, so this is a
    hash aggregate with map-side combine.
    """
    return df.groupBy(*keys).agg(
        *[F.max_by(v, order).alias(v) for v in values], F.min(order).alias("first_seen")
    )


def metric_struct(value: str, fields: Mapping[str, str] = C.SCALING_METRIC_FIELDS) -> Column:
    """Aggregate: one struct field per known metric, null when absent."""
    parts = [f"max({value}) FILTER (WHERE metric = {literal(m)}) AS {f}" for m, f in fields.items()]
    return F.expr(f"struct({', '.join(parts)})")


def pivot_metrics(
    df: DataFrame, keys: Sequence[str], structs: Mapping[str, str], order: Column
) -> DataFrame:
    """One row per key with a metric struct per ``structs`` entry (name -> value column).

    Two steps: rows shrink to one per key and metric, then the few metrics of a
    key fold into structs.
    """
    latest = last_values(df, [*keys, "metric"], list(structs.values()), order)
    return latest.groupBy(*keys).agg(
        *[metric_struct(value).alias(name) for name, value in structs.items()],
        F.min("first_seen").alias("first_seen"),
    )
