"""Left joins whose keys may be hot on either side: measured first, then salted.

A sketch of each side's keys (one small aggregate, no shuffle of rows) names the keys that
may stand in more rows than a task should get; those few are counted exactly. Their rows are
dealt over as many parts as the counts ask for and meet copies of the other side's
rows. All other keys go through the same join as they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalflow.operators.joins import left_join

#: Rows of one key that one task may get.
SPLIT_ROWS = 1_000_000
#: Keys a side may name as hot, and counters its sketch holds. A key beyond both stands in
#: less than a thousandth of the side's rows.
HOT_KEYS, COUNTERS = 1000, 16384
#: Parts that one key is dealt over on one side.
MOST_PARTS = 1000

_LEFT, _RIGHT, _FOUND, _I, _J = "_left_parts", "_right_parts", "_found", "_salt_left", "_salt_right"


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def hot_keys(frames: Mapping[str, DataFrame], keys: Sequence[str], split_rows: int = SPLIT_ROWS) -> list[Row]:
    """``keys`` and a row count per frame of every key that stands in ``split_rows`` rows of one.

    Runs one job over the keys, and a second over the candidates where there are any. What
    comes back is bounded by ``HOT_KEYS`` per frame, give or take keys of one hash.
    """
    hashes = [f.select(F.lit(name).alias("side"), _hash(keys).alias("h")) for name, f in frames.items()]
    sketches = (
        reduce(DataFrame.unionAll, hashes)
        .groupBy("side")
        .agg(F.expr(f"approx_top_k(h, {HOT_KEYS}, {COUNTERS})").alias("top"))
        .collect()
    )
    hot = sorted({x["item"] for row in sketches for x in row["top"] if x["count"] >= split_rows})
    if not hot:
        return []
    rows = [
        f.where(_hash(keys).isin(hot)).select(*keys, F.lit(name).alias("_side"))
        for name, f in frames.items()
    ]
    counts = [F.count_if(F.col("_side") == name).alias(f"rows_{name}") for name in frames]
    counted = reduce(DataFrame.unionAll, rows).groupBy(*keys).agg(*counts)
    return counted.where(F.greatest(*[f"rows_{n}" for n in frames], F.lit(0)) >= split_rows).collect()


def _parts(rows: int, split_rows: int) -> int:
    return max(1, min(MOST_PARTS, -(-rows // split_rows)))


def _content(df: DataFrame) -> Column:
    """Hash of a row, over the columns that have one."""

    def hashable(kind: T.DataType) -> bool:
        text = kind.simpleString()
        return "variant" not in text and "map<" not in text

    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if hashable(f.dataType)])


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    hot: Sequence[tuple[Sequence, int, int]],
    *,
    null_safe: Sequence[str] = (),
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """The rows of a left join, hot keys dealt over many tasks; one join whatever is hot.

    ``hot`` holds ``(key values, rows on the left, rows on the right)``; the counts decide how
    finely a key is dealt, and rows on the right above ``split_rows`` must be true, for a left
    row of such a key has a partner, so that its copies without one are left out. A row's
    part is a hash of its content: a repeated task deals it alike.
    """
    sized = [
        (*values, _parts(l, split_rows), _parts(r, split_rows))
        for values, l, r in hot
        if all(v is not None or k in null_safe for k, v in zip(keys, values))
    ]
    sized = [row for row in sized if max(row[-2:]) > 1]
    if not sized:
        return left_join(left, right, keys, null_safe)
    kinds = [T.StructField(k, right.schema[k].dataType) for k in keys]
    schema = T.StructType([*kinds, T.StructField(_LEFT, T.IntegerType()), T.StructField(_RIGHT, T.IntegerType())])
    # a row per hot key, so its size has a bound
    table = F.broadcast(left.sparkSession.createDataFrame(sized, schema))

    def dealt(frame: DataFrame, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        part = F.when(F.col(own) > 1, F.pmod(_content(frame), F.col(own)).cast("int")).otherwise(0)
        copies = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
        return left_join(frame, table, keys, null_safe).withColumn(mine, part).withColumn(theirs, F.explode(copies))

    lefts = dealt(left, _LEFT, _RIGHT, _I, _J)
    rights = dealt(right, _RIGHT, _LEFT, _J, _I).drop(_LEFT, _RIGHT).withColumn(_FOUND, F.lit(True))
    joined = left_join(lefts, rights, [*keys, _I, _J], null_safe)
    met = F.col(_FOUND) | (F.coalesce(F.col(_RIGHT), F.lit(1)) == 1)
    return joined.where(met).drop(_LEFT, _RIGHT, _I, _J, _FOUND)
