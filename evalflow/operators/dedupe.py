"""De-duplication by canonical content, and one row per configuration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_records(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct rows over the key columns only: a hash aggregate with map-side combine."""
    return df.select(*keys).distinct()


def _hash_first(keys: Sequence[str]) -> Column:
    """Hash of the keys, to group by before the keys themselves.

    Grouping stays exact. Where Spark groups by sorting it compares the hash,
    not long texts that all start alike.
    """
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("_hash")


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """First row per key in the given order.

    ``row_number() = 1`` is cut in every map task before the shuffle (a window
    group limit), so a key that holds a third of all rows sends one row per task.
    """
    hashed = df.withColumn("_hash", _hash_first([key]))
    rank = Window.partitionBy("_hash", key).orderBy(*order)
    ranked = hashed.withColumn("_rank", F.row_number().over(rank)).where("_rank = 1")
    return ranked.drop("_rank", "_hash")


def record_digest(keys: Sequence[str]) -> Column:
    """SHA-256 over the key columns, nulls told apart from text: the key records meet by."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys]), {"ignoreNullFields": "false"}), 256)


def merge_copies(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], paths: Sequence[str]
) -> DataFrame:
    """One row per key with the path values of its first copy and the copy count.

    Records meet by digest. The minimum of a struct is combined in each map task, so one
    row per record and task crosses the shuffle, with the record's text once.
    """
    carried = [*paths, *keys]
    first = F.min(F.struct(*order, *[F.col(f"`{c}`").alias(f"_p{i}") for i, c in enumerate(carried)]))
    merged = df.groupBy(record_digest(keys).alias("record")).agg(
        first.alias("_first"), F.count(F.lit(1)).alias("copies")
    )
    values = {c: F.col(f"_first._p{i}").alias(c) for i, c in enumerate(carried)}
    return merged.select("record", *[values[c] for c in [*keys, *paths]], "copies")


def copy_paths(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], paths: Sequence[str]
) -> DataFrame:
    """Every distinct path of every record, one row each: ``(record, role, path, first_seen)``.

    ``record`` is the digest that :func:`merge_copies` gives, so no text is repeated per
    path, and a record with any number of copies never becomes one value; ``first_seen``
    gives the order of its paths.
    """
    roles = F.array(
        *[F.struct(F.lit(p).alias("role"), F.col(f"`{p}`").alias("path")) for p in paths]
    )
    long = df.select(record_digest(keys).alias("record"), F.struct(*order).alias("_seen"), F.inline(roles))
    return long.groupBy("record", "role", "path").agg(F.min("_seen").alias("first_seen"))
