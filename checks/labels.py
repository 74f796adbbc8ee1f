"""Metric labels and normalized text."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.shape import choose_sql, fill_sql, pick_expr, pick_sql, quoted, table
from evalflow import constants as C
from evalflow.functions.labels import add_label_parts, canonical_labels
from evalflow.functions.text import is_missing, normalize_text

ALL_TASKS = list(dict.fromkeys(t for group in C.CATALOG_TASKS.values() for t in group))
STARTS = [*ALL_TASKS, "mmlu", "zzz", "high_school"]
ENDS = [*C.CATALOG_METRICS, "", "foo", "acc_raw_extra"]
FORMS = ["{task}_{metric}", " {task}-{metric} ", "{task}/{metric}", "{metric}({task})"]


def _forms(values, text):
    forms = [fill_sql(f, values, text) for f in FORMS]
    return choose_sql(f"user_id % {len(FORMS)}", [f"upper({f})" if i == 1 else f for i, f in enumerate(forms)])


def raw_labels(spark, folder):
    values = {
        "task": pick_expr(f"event_id % {len(STARTS)}", STARTS),
        "metric": pick_expr(f"(event_id + user_id) % {len(ENDS)}", ENDS),
    }
    label = F.expr(_forms(values, "STRING"))
    return table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_id") % 101 != 0, label).alias("label")
    )


def metric_labels(spark, folder):
    return add_label_parts(raw_labels(spark, folder), "label").drop("label")


def canonical(spark, folder):
    return canonical_labels(raw_labels(spark, folder), "label", "canonical").select("event_id", "canonical")


def normalized_text(spark, folder):
    parts = table(spark, folder, "part").select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("key"),
        F.concat(F.lit("  "), "p_name", F.lit("+"), "p_brand", F.lit(" ("), "p_type", F.lit(", "), F.col("p_size").cast("string"), F.lit("%) ")).alias("raw"),
    )
    orders = table(spark, folder, "orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("key"),
        F.when(F.col("o_orderkey") % 13 == 0, F.lit(" -/ ")).when(F.col("o_orderkey") % 17 != 0, F.col("o_orderpriority")).alias("raw"),
    )
    return parts.unionByName(orders).select(
        "key",
        normalize_text(F.col("raw")).alias("words"),
        normalize_text(F.col("raw"), "_").alias("joined"),
        is_missing(F.col("raw")).cast("int").alias("missing"),
    )


def _plain(name):
    return " ".join(name.lower().replace("-", " ").replace("_", " ").split())


_CLEAN = "nullif(trim(regexp_replace(lower({c}), '[-_/()%+,\\s]+', ' ', 'g')), '')"
_LABELS = """
    labels AS (
        SELECT event_id, CASE WHEN event_id % 101 <> 0 THEN {forms} END AS label FROM events
    ), clean AS (SELECT event_id, {clean} AS words FROM labels),
    tasks AS (SELECT DISTINCT name, length(name) - length(replace(name, ' ', '')) AS n FROM (VALUES {tasks}) t(name)),
    metrics AS (SELECT DISTINCT name FROM (VALUES {metrics}) t(name)),
    tasked AS (
        SELECT c.event_id, c.words, arg_max(t.name, t.n) AS task
        FROM clean c LEFT JOIN tasks t ON starts_with(c.words || ' ', t.name || ' ') GROUP BY c.event_id, c.words
    ), rests AS (
        SELECT event_id, task,
            CASE WHEN task IS NULL THEN words ELSE nullif(substr(words, length(task) + 2), '') END AS rest
        FROM tasked
    ), parsed AS (
        SELECT r.event_id, r.task, m.name AS metric, CASE WHEN m.name IS NULL THEN r.rest END AS unmatched
        FROM rests r LEFT JOIN metrics m ON m.name = r.rest AND r.task IS NOT NULL
    )
""".format(
    forms=_forms(
        {
            "task": pick_sql(f"event_id % {len(STARTS)}", STARTS),
            "metric": pick_sql(f"(event_id + user_id) % {len(ENDS)}", ENDS),
        },
        "VARCHAR",
    ),
    clean=_CLEAN.format(c="label"),
    tasks=", ".join(f"({quoted(_plain(t))})" for t in ALL_TASKS),
    metrics=", ".join(f"({quoted(_plain(m))})" for m in C.CATALOG_METRICS),
)

QUERIES = {
    "metric_labels": metric_labels,
    "canonical_labels": canonical,
    "normalize_text": normalized_text,
}
SQL = {
    "metric_labels": f"WITH {_LABELS} SELECT event_id, task, metric, unmatched FROM parsed",
    "canonical_labels": f"""
    WITH {_LABELS}
    SELECT event_id, coalesce(task, 'None') || ' ' || coalesce(metric, 'None') || coalesce(' ' || unmatched, '')
        AS canonical
    FROM parsed
    """,
    "normalize_text": f"""
    WITH raws AS (
        SELECT 'p' || p_partkey AS key,
            '  ' || p_name || '+' || p_brand || ' (' || p_type || ', ' || p_size || '%) ' AS raw
        FROM part
        UNION ALL
        SELECT 'o' || o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN ' -/ '
            WHEN o_orderkey % 17 <> 0 THEN o_orderpriority END
        FROM orders
    )
    SELECT key, {_CLEAN.format(c="raw")} AS words, replace({_CLEAN.format(c="raw")}, ' ', '_') AS joined,
        CAST(raw IS NULL OR trim(raw) = '' AS INTEGER) AS missing
    FROM raws
    """,
}
