"""Scaling-law tables with ``lineitem`` as the fit rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.shape import case_sql, pick, pick_sql, table
from evalflow import constants as C
from evalflow.operators.ordering import leading_digits, pack_order
from evalflow.plans import scaling
from evalflow.plans import tables as table_plans
from evalflow.session import fresh_folder

MIXES = ["C4", "DCLM-baseline", "DCLM-Baseline", "no_code", "house_mix"]
SETUPS = [
    "3_param-default",
    "2_param-default",
    "3_param-1_step",
    "5_param-helper_points-step2=0.5",
    "3_param-no_750M_no_530M",
    "5_param-1_step-helper_points",
    "5_param-no_90M",
]
METRICS = [*C.SCALING_METRIC_FIELDS, "bits"]
DIGITS = 37


def fits(spark, folder):
    """Fit rows with ``row_order``: order, line, part and supplier numbers and the
    quantity, packed."""
    rows = table(spark, folder, "lineitem")
    order = pack_order(
        (F.col("l_orderkey"), 12), (F.col("l_linenumber"), 1), (F.col("l_partkey"), 12), (F.col("l_suppkey"), 10),
        (F.col("l_quantity").cast("int"), 2),
    )
    return rows.select(
        F.col("l_returnflag").alias("task"),
        pick(F.col("l_suppkey") % len(MIXES), MIXES).alias("mix"),
        pick(F.col("l_linenumber") - 1, SETUPS).alias("setup"),
        pick(F.col("l_partkey") % len(METRICS), METRICS).alias("metric"),
        F.col("l_quantity").alias("step_1_y"),
        F.col("l_extendedprice").alias("step_1_pred"),
        F.col("l_discount").alias("step_2_y"),
        F.col("l_tax").alias("step_2_pred"),
        F.when(F.col("l_quantity") <= 45, F.col("l_extendedprice")).alias("stacked_pred"),
        order.alias("row_order"),
    )


BUCKET_DIGITS = 7


def _arguments(spark, folder):
    bucket = leading_digits(F.col("first_seen"), DIGITS, BUCKET_DIGITS)
    return fits(spark, folder), F.col("row_order"), bucket


def _flat(df, structs):
    """Plain columns in place of the structs; held-out sizes as one text."""
    out = [F.col(c) for c in ("id", "task", "recipe")]
    if "fit_config" in df.columns:
        out += [
            F.col("fit_config.name").alias("setup"),
            F.col("fit_config.one_step").cast("int").alias("one_step"),
            F.col("fit_config.params").alias("params"),
            F.col("fit_config.filtering").alias("filtering"),
            F.col("fit_config.helper_point").cast("int").alias("helper_point"),
            F.array_join("fit_config.heldout", ",").alias("heldout"),
        ]
    for name in structs:
        out += [F.col(f"{name}.{f}").alias(f"{name}_{f}") for f in C.SCALING_METRIC_FIELDS.values()]
    return df.select(*out)


def _job(spark, folder):
    """The whole job over a stored fit file, its rows in the order of ``row_order``."""
    root = fresh_folder(spark, "fits")
    ordered = fits(spark, folder).orderBy("row_order").drop("row_order")
    ordered.write.parquet(f"{root}/{C.SCALING_FIT_FILE}")
    spark.range(1).write.parquet(f"{root}/{C.MACRO_AVG_FILE}")
    return table_plans.parse_scaling(spark, root, f"{root}/out")


def job_one_step(spark, folder):
    return _flat(_job(spark, folder)["scaling_law_pred_one_step.parquet"], ["pred_task_metrics"])


def one_step(spark, folder):
    return _flat(scaling.one_step_predictions(*_arguments(spark, folder)), ["pred_task_metrics"])


def two_step(spark, folder):
    return _flat(
        scaling.two_step_predictions(*_arguments(spark, folder)),
        ["pred_task_losses", "pred_task_loss_to_metrics", "pred_task_metrics"],
    )


def truth(spark, folder):
    return _flat(scaling.true_metrics(*_arguments(spark, folder)), ["task_losses", "task_metrics"])


def _sql(where, structs, config, last=""):
    recipe = case_sql("mix", {m: C.RECIPES.get(m, m) for m in MIXES}, "mix")
    heldout = {
        "3_param-no_750M_no_530M": "1B,750M,530M",
        "5_param-no_90M": "1B,90M",
    }
    values = ", ".join(f"arg_max_null({v}, row_order) AS {v}" for v in structs.values())
    fields = ", ".join(
        f"max({v}) FILTER (WHERE metric = '{m}') AS {name}_{f}"
        for name, v in structs.items()
        for m, f in C.SCALING_METRIC_FIELDS.items()
    )
    shown = ", ".join(f"{name}_{f}" for name in structs for f in C.SCALING_METRIC_FIELDS.values())
    parts = (
        f"""setup, CAST(contains(setup, '1_step') AS INTEGER) AS one_step, substr(setup, 1, 1) AS params,
        CASE WHEN contains(setup, 'step2=0.5') THEN '50_Percent' ELSE 'None' END AS filtering,
        CAST(contains(setup, 'helper_points') AS INTEGER) AS helper_point,
        {case_sql("setup", heldout, "'1B'")} AS heldout,"""
        if config
        else ""
    )
    return f"""
    WITH fits AS (
        SELECT l_returnflag AS task, {pick_sql(f"l_suppkey % {len(MIXES)}", MIXES)} AS mix,
            {pick_sql("l_linenumber - 1", SETUPS)} AS setup,
            {pick_sql(f"l_partkey % {len(METRICS)}", METRICS)} AS metric,
            l_quantity AS step_1_y, l_extendedprice AS step_1_pred, l_discount AS step_2_y,
            l_tax AS step_2_pred, CASE WHEN l_quantity <= 45 THEN l_extendedprice END AS stacked_pred,
            (((CAST(l_orderkey AS HUGEINT) * 10 + l_linenumber) * 1000000000000 + l_partkey)
                * 10000000000 + l_suppkey) * 100 + CAST(l_quantity AS INTEGER) AS row_order
        FROM lineitem
    ), latest AS (
        SELECT task, {recipe} AS recipe, setup, metric, {values}, min(row_order) AS seen
        FROM fits WHERE {where} GROUP BY ALL
    ), wide AS (
        SELECT task, recipe, setup, {fields}, min(seen) AS seen
        FROM latest GROUP BY task, recipe, setup
    ), numbered AS (
        SELECT *, row_number() OVER (ORDER BY seen) - 1 AS id FROM wide
    )
    SELECT id, task, recipe, {parts} {shown} FROM numbered {last}
    """


QUERIES = {
    "scaling_one_step": one_step,
    "scaling_two_step": two_step,
    "scaling_true": truth,
    "scaling_job_one_step": job_one_step,
}
SQL = {
    "scaling_one_step": _sql("contains(setup, '1_step')", {"pred_task_metrics": "stacked_pred"}, True),
    "scaling_two_step": _sql(
        "NOT contains(setup, '1_step')",
        {
            "pred_task_losses": "step_1_pred",
            "pred_task_loss_to_metrics": "step_2_pred",
            "pred_task_metrics": "stacked_pred",
        },
        True,
    ),
    "scaling_true": _sql(
        "NOT contains(setup, '1_step')",
        {"task_losses": "step_1_y", "task_metrics": "step_2_y"},
        False,
        f"WHERE setup = '{C.TRUE_METRICS_SETUP}'",
    ),
}
SQL["scaling_job_one_step"] = SQL["scaling_one_step"]
