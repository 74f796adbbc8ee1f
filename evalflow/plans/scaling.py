"""Scaling-law fits: long rows to nested prediction and truth tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalflow import constants as C
from evalflow.functions import setups
from evalflow.functions.lookups import normalize_recipe
from evalflow.operators.ordering import number_in_order
from evalflow.operators.pivots import pivot_metrics

KEYS = ["task", "recipe", "setup"]


def prepare_fits(fits: DataFrame) -> DataFrame:
    """Normalized recipe in place of ``mix``, and the one-step flag."""
    return fits.withColumns(
        {"recipe": normalize_recipe(F.col("mix")), "one_step": setups.is_one_step(F.col("setup"))}
    ).drop("mix")


ONE_STEP = {"pred_task_metrics": "stacked_pred"}
TWO_STEP = {
    "pred_task_losses": "step_1_pred",
    "pred_task_loss_to_metrics": "step_2_pred",
    "pred_task_metrics": "stacked_pred",
}
TRUE = {"task_losses": "step_1_y", "task_metrics": "step_2_y"}


def numbered_groups(
    fits: DataFrame, one_step: bool, structs: Mapping[str, str], order: Column, bucket: Column
) -> DataFrame:
    """Pivoted groups of one kind with their ids by first appearance."""
    flag = F.col("one_step")
    rows = prepare_fits(fits).where(flag if one_step else ~flag)
    wide = pivot_metrics(rows, KEYS, structs, order)
    return number_in_order(wide, F.col("first_seen"), bucket).drop("first_seen")


def _predictions(groups: DataFrame, structs: Mapping[str, str]) -> DataFrame:
    config = setups.fit_config(F.col("setup")).alias("fit_config")
    return groups.select("id", "task", "recipe", config, *structs)


def _truth(groups: DataFrame) -> DataFrame:
    """Default setup only; ids count all two-step groups, so they have gaps."""
    return groups.where(F.col("setup") == C.TRUE_METRICS_SETUP).select("id", "task", "recipe", *TRUE)


def one_step_predictions(fits: DataFrame, order: Column, bucket: Column) -> DataFrame:
    return _predictions(numbered_groups(fits, True, ONE_STEP, order, bucket), ONE_STEP)


def two_step_predictions(fits: DataFrame, order: Column, bucket: Column) -> DataFrame:
    return _predictions(numbered_groups(fits, False, TWO_STEP, order, bucket), TWO_STEP)


def true_metrics(fits: DataFrame, order: Column, bucket: Column) -> DataFrame:
    return _truth(numbered_groups(fits, False, TRUE, order, bucket))


def parse_scaling_laws(
    fits: DataFrame, macro_avg: DataFrame, order: Column, bucket: Column
) -> dict[str, DataFrame]:
    """The four output tables by file name.

    ``order`` is the row ordinal of ``fits``; ``bucket`` cuts ``first_seen``, an
    ordinal of the same kind, into ranges.
    """
    two_step = numbered_groups(fits, False, {**TWO_STEP, **TRUE}, order, bucket)
    return {
        "scaling_law_pred_one_step.parquet": one_step_predictions(fits, order, bucket),
        "scaling_law_pred_two_step.parquet": _predictions(two_step, TWO_STEP),
        "scaling_law_true.parquet": _truth(two_step),
        "macro_avg.parquet": macro_avg,
    }
