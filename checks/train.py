"""Train results with ``lineitem`` as the result rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.shape import case_sql, pick, pick_sql, table
from evalflow import constants as C
from evalflow.plans import train

SIZES = ["4M", "150M", " 1b ", "750m", "2T", "10K", "x"]
MIXES = ["Falcon+CC (QC 20%)", "C4", "DCLM-Baseline", "house mix"]
TASKS = ["mmlu_anatomy", "MMLU_law", "csqa", "boolq", "arc_easy", "other"]
# metric name -> source column, in the order of the literal
NUMBERS = {
    "acc_raw": "l_discount",
    "margin": "l_tax",
    "correct_choice": "l_linenumber",
    "total_prob_per_char": "l_quantity",
}


def result_rows(spark, folder):
    numbers = [F.concat(F.lit(f"'{m}': "), F.col(c).cast("string"), F.lit(", ")) for m, c in NUMBERS.items()]
    literal = F.concat(
        F.lit("{"), *numbers, F.lit("'no_answer': None, 'primary_metric': "),
        F.when(F.col("l_linenumber") == 7, F.lit("None")).otherwise(F.col("l_discount").cast("string")),
        F.lit("}"),
    )
    return table(spark, folder, "lineitem").select(
        pick(F.col("l_linenumber") - 1, SIZES).alias("params"),
        pick(F.col("l_suppkey") % len(MIXES), MIXES).alias("data"),
        pick(F.col("l_partkey") % len(TASKS), TASKS).alias("task"),
        F.col("l_orderkey").alias("step"),
        F.col("l_returnflag").alias("seed"),
        F.lit("5xC").alias("chinchilla"),
        (F.col("l_quantity") * 1e6).alias("tokens"),
        (F.col("l_extendedprice") * 1e12).alias("compute"),
        literal.alias("metrics"),
    )


def train_parse(spark, folder):
    return train.sorted_train_results(result_rows(spark, folder))


def _sql():
    numbers = " || ".join(f"'''{m}'': ' || CAST({c} AS VARCHAR) || ', '" for m, c in NUMBERS.items())
    metrics = ",\n".join(
        f"CAST(json_extract_string(m, '$.{old}') AS DOUBLE) AS {new}" for old, new in C.TRAIN_METRIC_RENAMES.items()
    )
    known = {m: C.RECIPES.get(m, m) for m in MIXES}
    sizes = {"4M": 4e6, "150M": 150e6, " 1b ": 1e9, "750m": 750e6, "2T": 2e12, "10K": 10e3}
    return f"""
    WITH rows AS (
        SELECT {pick_sql("l_linenumber - 1", SIZES)} AS params,
            {pick_sql(f"l_suppkey % {len(MIXES)}", MIXES)} AS data,
            {pick_sql(f"l_partkey % {len(TASKS)}", TASKS)} AS task,
            l_orderkey AS step, l_returnflag AS seed, l_quantity * 1e6 AS tokens,
            l_extendedprice * 1e12 AS compute,
            '{{' || {numbers} || '''no_answer'': None, ''primary_metric'': '
                || CASE WHEN l_linenumber = 7 THEN 'None' ELSE CAST(l_discount AS VARCHAR) END || '}}' AS literal
        FROM lineitem
    ), parsed AS (
        SELECT *, CAST(replace(replace(literal, '''', '"'), 'None', 'null') AS JSON) AS m FROM rows
    )
    SELECT params, data, task, step, seed, tokens, compute,
        {metrics},
        {case_sql("data", known, "data")} AS recipe,
        tokens / 1e6 AS tokens_millions,
        compute / 1e15 AS compute_e15,
        CAST({case_sql("task", C.TASK_ACC_BASELINES, "0.25")} AS DOUBLE) AS acc_baseline,
        CAST(0 AS DOUBLE) AS prob_baseline,
        CAST({case_sql("params", sizes, "NULL")} AS DOUBLE) AS params_numeric,
        CASE WHEN starts_with(lower(task), 'mmlu_') THEN 'mmlu' ELSE task END AS task_group
    FROM parsed
    ORDER BY params_numeric NULLS LAST, step NULLS LAST, data, task, seed
    """


QUERIES = {"train_parse": train_parse}
SQL = {"train_parse": _sql()}
