"""Evaluation metrics held in a run's summary document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalflow.functions.jsontext import object_fields
from evalflow.operators.columns import compute_once

_PREFIX = "oe_eval_metrics"


def summary_metrics(
    df: DataFrame, summary: str = "summary", keys: Sequence[str] = ("run_id",)
) -> DataFrame:
    """Long table ``(keys, task, metric, value)`` from a summary JSON column; no shuffle.

    ``prefix/task/metric`` keys give a metric. A ``prefix/task`` key gives the
    metric ``value``, or all its fields when it is an object and comes before the
    task's other keys, which then win. Other keys and nulls are left out.
    ``extra_metrics`` is flattened and its non-null fields win over the task's
    other metrics; ``task_config`` is dropped.

    A document is cut into rows where it was read. What one key has to know of
    another travels with it: ``_x`` holds the few values that are objects, ``_k``
    the key names, and only where a document has a whole task as an object.
    Rows never meet again.
    """
    docs = compute_once(df, {"_m": object_fields(F.col(summary))}, keep=keys)
    objects = F.map_filter("_m", lambda _, v: F.startswith(v, F.lit("{")))
    docs = compute_once(docs, {"_x": objects}, keep=[*keys, "_m"])
    has_whole = F.exists(F.map_keys("_x"), lambda k: F.size(F.split(k, "/")) == 2)
    names = F.map_keys(F.map_filter("_m", lambda _, v: v.isNotNull()))
    docs = compute_once(docs, {"_k": F.when(has_whole, names)})
    cells = docs.select(*keys, "_x", "_k", F.explode("_m").alias("_key", "_value"))
    cells = compute_once(
        cells.where(F.col("_key").startswith(_PREFIX) & F.col("_value").isNotNull()),
        {"_parts": F.split("_key", "/")},
    ).where(F.size("_parts").isin(2, 3))
    cells = cells.withColumns(
        {
            "task": F.col("_parts")[1],
            "_stem": F.concat_ws("/", F.col("_parts")[0], F.col("_parts")[1]),
            "_name": F.get("_parts", F.lit(2)),
        }
    )
    # a whole task: an object, and no key of the task with a metric before it
    place = F.array_position("_k", F.col("_key")).cast("int")
    named_before = F.exists(
        F.slice("_k", F.lit(1), place),
        lambda k: F.startswith(k, F.concat("_stem", F.lit("/"))) & (F.size(F.split(k, "/")) == 3),
    )
    maybe_whole = F.col("_name").isNull() & F.startswith("_value", F.lit("{"))
    cells = cells.withColumn("_whole", maybe_whole & ~named_before)
    cells = cells.select(*keys, "_x", "_k", "task", "_stem", "_whole", F.inline(_entries()))

    # keys of their own beat the fields of a whole task, extra metrics beat both
    source = F.when(F.col("_extra"), F.lit("extra_metrics")).otherwise(F.col("metric"))
    has_own_key = F.array_contains("_k", F.concat_ws("/", "_stem", source))
    extra_text = F.coalesce(
        F.col("_x")[F.concat("_stem", F.lit("/extra_metrics"))],
        F.get_json_object(F.col("_x")[F.col("_stem")], "$.extra_metrics"),
    )
    unbeaten = extra_text.isNull() | object_fields(extra_text)[F.col("metric")].isNull()
    kept = cells.where(
        F.col("value").isNotNull()
        & ~(F.col("_whole") & F.coalesce(has_own_key, F.lit(False)))
        & (F.col("_extra") | ((F.col("metric") != "task_config") & unbeaten))
    )
    return kept.select(*keys, "task", "metric", "value")


def _entries() -> Column:
    """Metrics of one cell: itself, or the fields of an object that is opened."""

    def entry(name: Column, value: Column, extra: bool) -> Column:
        return F.struct(name.alias("metric"), value.alias("value"), F.lit(extra).alias("_extra"))

    def fields(value: Column, extra: bool) -> Column:
        return F.transform(F.map_entries(object_fields(value)), lambda x: entry(x["key"], x["value"], extra))

    def field(x: Column) -> Column:
        return F.when(x["metric"] == "extra_metrics", fields(x["value"], True)).otherwise(F.array(x))

    name, value = F.col("_name"), F.col("_value")
    return (
        F.when(F.col("_whole"), F.flatten(F.transform(fields(value, False), field)))
        .when(name == "extra_metrics", fields(value, True))
        .otherwise(F.array(entry(F.coalesce(name, F.lit("value")), value, False)))
    )


def summary_task_maps(
    df: DataFrame, summary: str = "summary", keys: Sequence[str] = ("run_id",)
) -> DataFrame:
    """One row per run and task: ``metrics`` map, or ``scalar`` when only a value exists.

    Rows first shrink to one per metric name, so a map holds names, not rows.
    """
    long = summary_metrics(df, summary, keys)
    single = long.groupBy(*keys, "task", "metric").agg(F.max("value").alias("value"))
    maps = single.groupBy(*keys, "task").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("_map")
    )
    only_value = (F.size("_map") == 1) & F.map_contains_key("_map", "value")
    return maps.select(
        *keys,
        "task",
        F.when(only_value, F.col("_map")["value"]).alias("scalar"),
        F.when(~only_value, F.col("_map")).alias("metrics"),
    )
