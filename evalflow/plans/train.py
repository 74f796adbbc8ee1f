"""Train results: dict-literal metrics to flat typed columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalflow import constants as C
from evalflow import schemas
from evalflow.functions.jsontext import is_plain_dict, python_literal_to_json
from evalflow.functions.lookups import acc_baseline, normalize_recipe
from evalflow.functions.numbers import parse_size
from evalflow.functions.text import group_by_prefix
from evalflow.operators.ordering import sorted_nulls_last


def parse_metrics(df: DataFrame, column: str = "metrics") -> DataFrame:
    """Expand the metrics literal into ``_m`` and the unknown keys into ``extra_metrics``."""
    text = python_literal_to_json(F.col(column))
    options = {"allowSingleQuotes": "true"}
    known = list(schemas.TRAIN_METRICS.names)
    every = F.from_json(F.col("_text"), "map<string,string>", options)
    extra = F.map_filter(every, lambda name, _: ~name.isin(known))
    return df.withColumn("_text", text).withColumns(
        {
            "_m": F.from_json(F.col("_text"), schemas.TRAIN_METRICS, options),
            "extra_metrics": F.when(F.size(extra) > 0, extra),
        }
    ).drop("_text")


def bad_metrics(df: DataFrame, column: str = "metrics") -> DataFrame:
    """Rows whose metrics text cannot be read, for quarantine.

    Plain dicts are known to be readable and are not parsed for it.
    """
    text = python_literal_to_json(F.col(column))
    read = F.from_json(text, "map<string,string>", {"allowSingleQuotes": "true"})
    # a condition of its own branch: the parser runs only where the first test fails
    unread = F.when(is_plain_dict(F.col(column)), F.lit(False)).otherwise(read.isNull() | (F.size(read) < 0))
    return df.where(F.col(column).isNotNull() & unread)


def parse_train_results(
    df: DataFrame,
    *,
    prefixes: Mapping[str, str] = C.TASK_GROUP_PREFIXES,
    strict_sizes: bool = False,
    keep_extra: bool = False,
) -> DataFrame:
    """All columns of the parsed table, unsorted; one narrow pass over the input."""
    parsed = parse_metrics(df)
    metrics = [f"_m.{old} AS {new}" for old, new in C.TRAIN_METRIC_RENAMES.items()]
    kept = [c for c in df.columns if c not in ("metrics", "chinchilla")]
    return parsed.select(
        *kept,
        *[F.expr(m) for m in metrics],
        normalize_recipe(F.col("data")).alias("recipe"),
        (F.col("tokens") / 1e6).alias("tokens_millions"),
        (F.col("compute") / 1e15).alias("compute_e15"),
        acc_baseline(F.col("task")).alias("acc_baseline"),
        F.lit(C.PROB_BASELINE).alias("prob_baseline"),
        parse_size(F.col("params"), strict=strict_sizes).alias("params_numeric"),
        group_by_prefix(F.col("task"), prefixes).alias("task_group"),
        *(["extra_metrics"] if keep_extra else []),
    )


def sorted_train_results(df: DataFrame, *, strict_sizes: bool = False, **options) -> DataFrame:
    """Parsed table in size and step order; the other keys settle ties.

    Rows are sorted before the metrics are parsed: the sort runs over its input
    twice, once to find the range limits, and parsing then stays out of that.
    """
    ties = [c for c in ("data", "task", "seed") if c in df.columns]
    sized = df.withColumn("_size", parse_size(F.col("params"), strict=strict_sizes))
    ordered = sorted_nulls_last(sized, ["_size", "step"], ties).drop("_size")
    return parse_train_results(ordered, strict_sizes=strict_sizes, **options)
