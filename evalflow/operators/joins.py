"""Joins: the document spine, guarded lookups, payload updates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matches(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on all keys; Spark still hashes on it."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def key_sets(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Distinct keys over several frames, a null key counting as equal.

    One distinct over the union: rows collapse in each task before the shuffle.
    """
    parts = [frame.select(*keys) for frame in frames]
    return reduce(DataFrame.unionAll, parts).distinct()


def _tests(keys: Sequence[str], null_safe: Sequence[str]) -> Column:
    tests = [
        F.col(k).eqNullSafe(F.col(f"_r_{k}")) if k in null_safe else F.col(k) == F.col(f"_r_{k}")
        for k in keys
    ]
    return reduce(lambda a, b: a & b, tests)


def left_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: Sequence[str] = ()
) -> DataFrame:
    """Left join keeping one copy of the keys; only ``null_safe`` keys match nulls.

    No hint: Spark broadcasts ``right`` when its size estimate is under
    ``autoBroadcastJoinThreshold`` and otherwise shuffles, where adaptive skew
    handling splits a hot key of the left side over several tasks. For sides whose
    keys may be hot see :mod:`evalflow.operators.skew`.
    """
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    return left.join(renamed, _tests(keys, null_safe), "left").drop(*[f"_r_{k}" for k in keys])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def unmatched_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``df`` that ``other`` lacks."""
    return df.select(*keys).join(other.select(*keys), list(keys), "left_anti").distinct()


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "rows") -> None:
    """Fail when a key occurs twice. Runs a job that brings back one row at most."""
    bad = duplicate_keys(df, keys).limit(1).collect()
    if bad:
        raise ValueError(f"Multiple {what} found for {bad[0].asDict()}")


def require_matches(df: DataFrame, other: DataFrame, keys: Sequence[str], what: str = "rows") -> None:
    """Fail when a key of ``df`` is absent from ``other``."""
    bad = unmatched_keys(df, other, keys).limit(1).collect()
    if bad:
        raise ValueError(f"No {what} found for {bad[0].asDict()}")


def skip_listed(df: DataFrame, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(listed.select(*keys), list(keys), "left_anti")


def group_by_rules(
    df: DataFrame, column: str, rules: DataFrame, out: str, *, turn: str | None = None
) -> DataFrame:
    """``out``: the group of the longest rule whose prefix starts the value, else the value itself.

    ``rules`` is a table ``(prefix, group)`` of any size, compared in lower case without outer
    blanks; of two rules with one prefix that of the smallest ``turn`` counts, and without
    that column the smallest group. Only the lengths that prefixes have come to the driver. Each
    distinct value meets the rules by equality on its beginnings of those lengths, so no
    pair of value and rule is formed that does not match.
    """
    plain = F.lower(F.btrim("prefix"))
    first = F.struct(F.col(turn), F.col("group")) if turn else F.struct("group")
    table = rules.where(F.col("prefix").isNotNull() & F.col("group").isNotNull())
    lengths = sorted(r[0] for r in table.select(F.length(plain)).distinct().collect())
    # one rule a prefix, so that a value meets one rule of each length at most
    table = table.groupBy(plain.alias("_start")).agg(F.min(first).alias("_first"))
    if lengths[:1] == [0]:
        raise ValueError("an empty prefix would match everything")
    if not lengths:
        return df.withColumn(out, F.col(f"`{column}`"))
    value = F.lower("_value")
    starts = F.transform(
        F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(value)), lambda n: F.substring(value, F.lit(1), n)
    )
    values = df.select(F.col(f"`{column}`").alias("_value")).where(F.col("_value").isNotNull()).distinct()
    offers = values.select("_value", F.explode(starts).alias("_start")).join(table, "_start")
    longest = F.max_by(F.col("_first.group"), F.length("_start"))
    groups = offers.groupBy("_value").agg(longest.alias("_group")).withColumnRenamed("_value", "_match")
    joined = df.join(groups, F.col(f"`{column}`") == F.col("_match"), "left")
    return joined.withColumn(out, F.coalesce("_group", F.col(f"`{column}`"))).drop("_match", "_group")


def overwrite(old: Column, new: Column) -> Column:
    """Update rule: a present new value always wins."""
    return F.coalesce(new, old)


def fill_if_missing(old: Column, new: Column) -> Column:
    """Update rule: a new value is used, as text, where the old is null or ``N/A``."""
    text = old.cast("string")
    return F.when(text.isNull() | (text == "N/A"), F.coalesce(new.cast("string"), text)).otherwise(text)


UPDATE_RULES = {"overwrite": overwrite, "fill_missing": fill_if_missing}


def apply_updates(
    df: DataFrame, updates: DataFrame, key: str, fields: Sequence[str], rule: str = "overwrite"
) -> DataFrame:
    """Set-based cell updates: join the updates by key, merge by the rule."""
    merge = UPDATE_RULES[rule]
    side = updates.select(key, *[F.col(f).alias(f"_new_{f}") for f in fields])
    joined = left_join(df, side, [key])
    columns = {
        f: merge(F.col(f) if f in df.columns else F.lit(None).cast("string"), F.col(f"_new_{f}"))
        for f in fields
    }
    return joined.withColumns(columns).drop(*[f"_new_{f}" for f in fields])
