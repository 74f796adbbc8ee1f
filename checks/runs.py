"""Run classification, hydration and normalization with ``events`` as runs."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from checks.shape import choose_sql, fill_sql, pick_expr, pick_sql, quoted, table
from evalflow import constants as C
from evalflow.operators.summaries import summary_metrics, summary_task_maps
from evalflow.plans import runs
from evalflow.session import fresh_folder

# One id form per pattern, and two that match none.
TEMPLATES = [
    "{t8}_{exp}_DD-{rec}-{size}_main_{tok}Mtx{n}_--learning_rate=5e-05",
    "{t8}_{exp}_DD-{rec}-{size}_main_{tok}M_toks_--learning_rate=5e-05",
    "{t8}_{exp}_DD-{rec}-{size}_Ft_--learning_rate=5e-05",
    "{t6}_{exp}_DD-{rec}-x-{size}_Ft_learning_rate=5e-05",
    "{t6}_{exp}_150M_finetune_{tok}Mtx{n}_DD-{rec}-{size}-5000-{n}_lr=1e-05",
    "{t6}_{exp}_150M_finetune_Ft_DD-{rec}-{size}-5000-{n}_lr=1e-05",
    "{t6}_{exp}_150M_pile_finetune_{tok}Mtx{n}_DD-{rec}-{size}-5000-{n}",
    "{t6}_{exp}_150M_{label}_finetune_Ft_DD-{rec}-{size}-5000-{n}",
    "{t6}_{exp}_150M_finetune_{tok}Mtx{n}_DD-{rec}-{size}-5000-{n}",
    "{t6}_{exp}_150M_finetune_Ft_DD-{rec}-{size}-5000-{n}",
    "{t6}_{exp}_DD-d-{rec}-150M_Ft_DD-{rec}-{size}-5000-{n}_lr=1e-05",
    "{t8}_{exp}_DD-d-{rec}-150M_Ft_DD-{rec}-{size}-5000-{n}_lr=1e-05",
    "{t6}_{exp}_150M_finetune_{tok}Gtx{n}_DD-{rec}-{size}-5000-{n}_lr=1e-05",
    "{t8}_{exp}_DD-{rec}-{size}_main_default_--max_train_samples={tok}_--reduce_loss=sum",
    "{t8}_{exp}_DD-{rec}-{size}_main_default",
    "{t8}_{exp}_dd__{rec}-{size}__main__{tok}Mt_lr=1e-5_default_--learning_rate=2e-5",
    "{exp}_main_default",
    "{exp}_junk",
]
RECIPES = ["c4", "dolma17", "no_code"]
SIZES = ["10M", "1B", "150M"]
LABELS = ["c4_en-valppl", "pile_foo", "mmlu_average_acc_raw", "zzz"]


def run_table(spark, folder):
    """Runs with ids of every form and config / summary JSON, some of it unusable."""
    n = F.col("event_id")
    values = {
        "t8": "date_format(ts, 'yyyy_MM_dd-HH_mm_ss')",
        "t6": "date_format(ts, 'yyMMdd-HHmmss')",
        "exp": "concat('e', event_id)",
        "rec": pick_expr("user_id % 3", RECIPES),
        "size": pick_expr("event_id % 3", SIZES),
        "tok": "(user_id % 50 + 1)",
        "n": "(user_id % 4 + 1)",
        "label": pick_expr("user_id % 4", LABELS),
    }
    forms = [fill_sql(t, values, "STRING") for t in TEMPLATES]
    run_id = F.expr(choose_sql(f"event_id % {len(TEMPLATES)}", forms))
    k = F.get_json_object("props", "$.k")
    config = F.concat(
        F.lit('{"learning_rate":0.5,"seed":'), k, F.lit(',"num_train_epochs":3,"initial_checkpoint_recipe":"falcon"}')
    )
    return table(spark, folder, "events").select(
        run_id.alias("run_id"),
        F.when(n % 11 == 0, F.lit("oops")).when(n % 7 != 0, config).alias("config"),
        F.when(n % 5 != 0, F.concat(F.lit('{"total_tokens":'), k, F.lit(',"x":null}'))).alias("summary"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
    )


def _ids(spark, folder):
    return run_table(spark, folder).select("run_id")


def classify_runs(spark, folder):
    return runs.classified(_ids(spark, folder))


def run_type_counts(spark, folder):
    return runs.run_type_counts(runs.classified(_ids(spark, folder), drop_types=None))


def observed_run_counts(spark, folder):
    """The same counts, taken while the classified runs are written."""
    return runs.write_classified(_ids(spark, folder), fresh_folder(spark, "observed"))


def classification_log(spark, folder):
    return runs.classification_log(_ids(spark, folder))


def matched_runs(spark, folder):
    return runs.by_run_type(runs.classified(_ids(spark, folder)), ["matched"])["matched"]


def hydrate_runs(spark, folder):
    payloads = run_table(spark, folder)
    return runs.hydrate(runs.classified(payloads.select("run_id")), payloads)


def normalize_runs(spark, folder):
    """Runs through all stages; the payload columns sit beside the ids, so nothing is joined."""
    out = runs.process_runs(run_table(spark, folder).drop("created_at"))
    return out.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


def run_summaries(spark, folder):
    """Summary documents with scalar, nested, extra and unrelated keys."""
    k = F.get_json_object("props", "$.k")
    kind, value = F.col("event_type"), F.col("value").cast("string")
    summary = F.concat(
        F.lit('{"oe_eval_metrics/'), kind, F.lit('":'), k,
        F.lit(',"oe_eval_metrics/'), kind, F.lit('/acc":'), value,
        F.lit(',"oe_eval_metrics/piqa":'), value,
        F.lit(',"other":2,"oe_eval_metrics/x/y/z":1,"oe_eval_metrics/n/none":null,'),
        F.lit('"oe_eval_metrics/b/extra_metrics":{"p":'), k, F.lit(',"q":null,"acc":"big"},'),
        F.lit('"oe_eval_metrics/b/acc":0.25,"oe_eval_metrics/b/task_config":{"a":1}}'),
    )
    return table(spark, folder, "events").select(
        F.col("event_id").alias("run_id"), F.when(F.col("event_id") % 9 != 0, summary).alias("summary")
    )


def summary_long(spark, folder):
    return summary_metrics(run_summaries(spark, folder))


def summary_maps(spark, folder):
    maps = summary_task_maps(run_summaries(spark, folder))
    pairs = F.transform(F.array_sort(F.map_entries("metrics")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return maps.select("run_id", "task", "scalar", F.array_join(pairs, ";").alias("metrics"))


def runs_since(spark, folder):
    dated = run_table(spark, folder).select("run_id", "created_at")
    return runs.with_plain_ids(runs.since(dated, "created_at", "2024-01-15"))


_VALUES = {
    "t8": "strftime(ts, '%Y_%m_%d-%H_%M_%S')",
    "t6": "strftime(ts, '%y%m%d-%H%M%S')",
    "exp": "('e' || event_id)",
    "rec": pick_sql("user_id % 3", RECIPES),
    "size": pick_sql("event_id % 3", SIZES),
    "tok": "(user_id % 50 + 1)",
    "n": "(user_id % 4 + 1)",
    "label": pick_sql("user_id % 4", LABELS),
}
_ID = choose_sql(f"event_id % {len(TEMPLATES)}", [fill_sql(t, _VALUES) for t in TEMPLATES])
_PLACE = "CASE {} END".format(
    " ".join(f"WHEN regexp_matches(run_id, {quoted(p)}) THEN {i}" for i, (_, _, p, _) in enumerate(C.RUN_PATTERNS))
)


def _only_group(pattern, wanted):
    """The pattern with a single capturing group, since the SQL engine counts to nine."""
    pieces = re.split(r"(?<!\\)\((?!\?)", pattern)
    marks = ["(" if i == wanted else "(?:" for i in range(len(pieces) - 1)]
    return pieces[0] + "".join(mark + piece for mark, piece in zip(marks, pieces[1:]))


def _group(field):
    whens = " ".join(
        f"WHEN {i} THEN regexp_extract(run_id, {quoted(_only_group(p, names.index(field)))}, 1)"
        for i, (_, _, p, names) in enumerate(C.RUN_PATTERNS)
        if field in names
    )
    return f"CASE place {whens} END AS {field}"


_TYPE = "CASE place {} ELSE CASE WHEN contains(run_id, 'main_default') AND NOT contains(run_id, 'dpo') AND NOT contains(run_id, '--reduce_loss=') THEN 'old' ELSE 'other' END END".format(
    " ".join(f"WHEN {i} THEN {quoted(t)}" for i, (_, t, _, _) in enumerate(C.RUN_PATTERNS))
)
_NAME = "CASE place {} END".format(
    " ".join(f"WHEN {i} THEN {quoted(n)}" for i, (n, _, _, _) in enumerate(C.RUN_PATTERNS))
)
_RUNS = f"""
    src AS (
        SELECT {_ID} AS run_id, event_id AS n, json_extract_string(props, '$.k') AS k, ts FROM events
    ), placed AS (SELECT *, {_PLACE} AS place FROM src),
    typed AS (
        SELECT run_id, n, k, place, {_TYPE} AS run_type, {_NAME} AS pattern_name,
            {", ".join(_group(f) for f in C.RUN_METADATA[:-1])}
        FROM placed
    )
"""
_SHOWN = "run_id, run_type, " + ", ".join(C.RUN_METADATA)
_GOOD = "(n % 11 <> 0 AND n % 7 <> 0)"
_HYDRATED = f"""
    hydrated AS (
        SELECT run_id, run_type, pattern_name, timestamp, exp_name, initial_checkpoint_size,
            num_finetune_tokens_per_epoch, num_finetune_tokens, comparison_model_size, comparison_metric,
            lr1, lr2, reduce_loss,
            coalesce(initial_checkpoint_recipe, CASE WHEN {_GOOD} THEN 'falcon' END) AS initial_checkpoint_recipe,
            initial_checkpoint_steps,
            coalesce(lr, CASE WHEN {_GOOD} THEN '0.5' END) AS lr,
            coalesce(seed, CASE WHEN {_GOOD} THEN k END) AS seed,
            coalesce(num_finetune_epochs, CASE WHEN {_GOOD} THEN '3' END) AS num_finetune_epochs,
            CASE WHEN n % 5 <> 0 THEN k END AS num_finetuned_tokens_real
        FROM typed WHERE run_type <> 'old'
    )
"""
_TOKENS = """CASE WHEN {c} IS NULL THEN NULL ELSE
    CAST(regexp_extract({c}, '^(\\d+)', 1) AS DOUBLE)
    * CASE WHEN contains({c}, 'M') THEN 1e6 WHEN contains({c}, 'G') OR contains({c}, 'B') THEN 1e9 ELSE 1 END END"""

# canonical labels of the comparison metrics that occur in matched runs
_LABELS = {
    "pile": "pile None",
    "c4_en-valppl": "c4 en valppl",
    "pile_foo": "pile None foo",
    "mmlu_average_acc_raw": "mmlu average acc raw",
    "zzz": "None None zzz",
}
_SUMMARY = """
    docs AS (
        SELECT event_id AS run_id, event_type, json_extract_string(props, '$.k') AS k, CAST(value AS VARCHAR) AS v
        FROM events WHERE event_id % 9 <> 0
    ), long AS (
        SELECT run_id, event_type AS task, 'value' AS metric, k AS value FROM docs
        UNION ALL SELECT run_id, event_type, 'acc', v FROM docs
        UNION ALL SELECT run_id, 'piqa', 'value', v FROM docs
        UNION ALL SELECT run_id, 'b', 'p', k FROM docs
        UNION ALL SELECT run_id, 'b', 'acc', 'big' FROM docs
    )
"""

QUERIES = {
    "classify_runs": classify_runs,
    "run_type_counts": run_type_counts,
    "observed_run_counts": observed_run_counts,
    "classification_log": classification_log,
    "matched_runs": matched_runs,
    "hydrate_runs": hydrate_runs,
    "normalize_runs": normalize_runs,
    "summary_metrics": summary_long,
    "summary_task_maps": summary_maps,
    "runs_since": runs_since,
}
SQL = {
    "classify_runs": f"WITH {_RUNS} SELECT {_SHOWN} FROM typed WHERE run_type <> 'old'",
    "run_type_counts": f"WITH {_RUNS} SELECT run_type, pattern_name, count(*) AS runs FROM typed GROUP BY ALL",
    "observed_run_counts": f"WITH {_RUNS} SELECT run_type, pattern_name, count(*) AS runs FROM typed GROUP BY ALL",
    "classification_log": f"WITH {_RUNS} SELECT run_id, run_type, pattern_name AS pattern FROM typed",
    "matched_runs": f"""
    WITH {_RUNS} SELECT {", ".join(runs.type_columns("matched"))} FROM typed WHERE run_type = 'matched'
    ORDER BY pattern_name, run_id
    """,
    "hydrate_runs": f"WITH {_RUNS}, {_HYDRATED} SELECT {_SHOWN}, num_finetuned_tokens_real FROM hydrated",
    "normalize_runs": f"""
    WITH {_RUNS}, {_HYDRATED}, filled AS (
        SELECT * REPLACE (
            coalesce(num_finetune_epochs, '1') AS num_finetune_epochs,
            coalesce(initial_checkpoint_steps, 'main') AS initial_checkpoint_steps,
            CASE WHEN run_type = 'matched' THEN coalesce(comparison_metric, 'pile') END AS comparison_metric
        ) FROM hydrated
    ), counted AS (
        SELECT *, contains(run_id, '_Ft_') AS whole,
            {_TOKENS.format(c="num_finetune_tokens")} AS tok,
            {_TOKENS.format(c="num_finetune_tokens_per_epoch")} AS per_epoch,
            {_TOKENS.format(c="num_finetuned_tokens_real")} AS real
        FROM filled
    )
    SELECT run_id, run_type, pattern_name, exp_name, initial_checkpoint_recipe AS ckpt_data,
        initial_checkpoint_size AS ckpt_params, initial_checkpoint_steps AS ckpt_steps, comparison_model_size,
        CASE comparison_metric {" ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in _LABELS.items())} END
            AS comparison_metric,
        seed, lr, lr1, lr2, reduce_loss,
        CASE WHEN contains(timestamp, '_') THEN strftime(strptime(timestamp, '%Y_%m_%d-%H_%M_%S'), '%Y-%m-%d %H:%M:%S')
            ELSE strftime(strptime(timestamp, '%y%m%d-%H%M%S'), '%Y-%m-%d %H:%M:%S') END AS timestamp,
        CASE WHEN whole THEN 665127434 ELSE per_epoch END AS num_finetune_tokens_per_epoch,
        CASE WHEN whole THEN 2 ELSE CAST(num_finetune_epochs AS DOUBLE) END AS num_finetune_epochs,
        CASE WHEN whole THEN 1330254868 ELSE coalesce(tok, per_epoch * CAST(num_finetune_epochs AS DOUBLE)) END
            AS num_finetune_tokens,
        CASE WHEN whole THEN 1330254868 ELSE real END AS num_finetuned_tokens_real
    FROM counted
    """,
    "summary_metrics": f"WITH {_SUMMARY} SELECT * FROM long",
    "summary_task_maps": f"""
    WITH {_SUMMARY}
    SELECT run_id, task, CASE WHEN count(*) = 1 AND min(metric) = 'value' THEN min(value) END AS scalar,
        CASE WHEN count(*) > 1 OR min(metric) <> 'value'
            THEN string_agg(metric || '=' || value, ';' ORDER BY metric) END AS metrics
    FROM long GROUP BY run_id, task
    """,
    "runs_since": f"""
    WITH {_RUNS}
    SELECT run_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at,
        trim(regexp_replace(lower(run_id), '[-_/()%+,\\s]+', ' ', 'g')) AS rid2
    FROM src WHERE ts >= TIMESTAMP '2024-01-15'
    """,
}
