"""Document export and configuration dedupe.

``documents`` play the predictions, ``labels`` the recorded inputs,
``conversations`` the requests; metrics are counted per task.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.shape import table
from evalflow.plans import export


def _dir():
    return F.concat(F.lit("/runs/r"), (F.col("doc_id") % 3).cast("string"))


def _prefix():
    return F.concat(F.lit("task-"), F.lpad((F.col("doc_id") % 20).cast("string"), 3, "0"), F.lit("-t"))


def _name():
    return F.concat(F.lit("name-"), F.floor((F.col("doc_id") % 20) / 2).cast("string"))


def artifacts(spark, folder):
    """Predictions, recorded inputs, requests and metrics in engine columns."""
    docs = table(spark, folder, "documents")
    preds = docs.select(
        _dir().alias("results_dir"), _prefix().alias("file_prefix"), "doc_id", "source", "n_chars", "text"
    )
    named = F.when(F.col("doc_id") % 20 < 14, _name()).alias("task_name")
    recs = table(spark, folder, "labels").select(
        _dir().alias("results_dir"), _prefix().alias("file_prefix"), "doc_id", named, "quality", "toxic"
    )
    turns = table(spark, folder, "conversations").withColumn("doc_id", F.col("conv_id"))
    reqs = turns.select(
        _dir().alias("results_dir"),
        _prefix().alias("file_prefix"),
        "doc_id",
        F.col("turn").alias("idx"),
        F.when(F.col("doc_id") % 20 < 6, _name()).alias("task_name"),
        "role",
        F.col("text").alias("request.text"),
    )
    task = (
        F.when(F.col("doc_id") % 20 < 14, _name())
        .when(F.col("doc_id") % 20 < 18, F.lit("t"))
        .otherwise(F.lit("aggregate"))
    )
    metrics = (
        docs.groupBy(_dir().alias("results_dir"), task.alias("task_name"))
        .agg(F.count(F.lit(1)).alias("num_instances"), F.sum("n_chars").alias("chars"))
        .withColumn("task_config", F.struct(F.col("num_instances").alias("n"), F.col("task_name").alias("task")))
    )
    return preds, recs, reqs, metrics


def spine_export(spark, folder):
    return export.export_documents(*artifacts(spark, folder))


def skewed_artifacts(spark, folder):
    """A third of the predictions on one document, a third of the requests on another."""
    docs = table(spark, folder, "documents")
    where = [F.lit("/runs/r0").alias("results_dir"), F.lit("task-000-t").alias("file_prefix")]

    def moved(key, to):
        return F.when(key % 3 == 0, F.lit(to)).otherwise(key).alias("doc_id")

    preds = docs.select(*where, moved(F.col("doc_id"), -1), "source", "n_chars")
    recs = table(spark, folder, "labels").select(*where, "doc_id", F.lit("t").alias("task_name"), "quality")
    key = F.col("o_orderkey")
    reqs = table(spark, folder, "orders").select(
        *where, moved(key, -2), (key % 40).alias("idx"), F.lit("t").alias("task_name"), "o_custkey"
    )
    metrics = docs.groupBy(F.lit("/runs/r0").alias("results_dir"), F.lit("t").alias("task_name")).agg(
        F.count(F.lit(1)).alias("num_instances")
    )
    return preds, recs, reqs, metrics


def spine_export_hot_keys(spark, folder):
    return export.export_documents(*skewed_artifacts(spark, folder), split_rows=20)


def task_name_map(spark, folder):
    preds, recs, reqs, _ = artifacts(spark, folder)
    return export.task_names(preds, recs, reqs)


def metrics_to_prefix(spark, folder):
    preds, recs, reqs, metrics = artifacts(spark, folder)
    return export.metrics_by_prefix(metrics, export.task_names(preds, recs, reqs)).select(
        "results_dir", "file_prefix", "task_name", "num_instances", "chars"
    )


def _exported(spark, folder):
    """Orders as exported rows whose configuration text comes in two key orders."""
    k, p, t = (F.col("o_custkey") % 400).cast("string"), F.col("o_orderstatus"), F.col("o_orderpriority")
    forward = F.concat(F.lit('{"k":'), k, F.lit(',"task_name":"'), t, F.lit('","p":"'), p, F.lit('"}'))
    backward = F.concat(F.lit('{"p":"'), p, F.lit('","task_name":"'), t, F.lit('","k":'), k, F.lit(".0}"))
    config = F.when(F.col("o_orderkey") % 2 == 0, forward).otherwise(backward)
    return table(spark, folder, "orders").select(
        F.concat(F.lit("task-"), F.lpad((F.col("o_custkey") % 50).cast("string"), 3, "0")).alias("file_prefix"),
        F.lit("/runs/r0").alias("results_dir"),
        (F.col("o_orderkey") % 100).alias("doc_id"),
        F.col("o_orderkey").alias("row_path"),
        F.col("o_orderstatus").alias("prd_status"),
        F.when(F.col("o_orderkey") % 7 != 0, config).alias("met_task_config"),
    )


def config_rank_dedupe(spark, folder):
    return export.dedupe_configurations(_exported(spark, folder), ties=("doc_id", "row_path"))


def config_rank_dedupe_raw(spark, folder):
    return export.dedupe_configurations(
        _exported(spark, folder), key_mode="raw", ties=("doc_id", "row_path")
    )


_INPUTS = """
    preds AS (
        SELECT '/runs/r' || (doc_id % 3) AS results_dir,
            'task-' || lpad(CAST(doc_id % 20 AS VARCHAR), 3, '0') || '-t' AS file_prefix,
            doc_id, source, n_chars, text
        FROM documents
    ), recs AS (
        SELECT '/runs/r' || (doc_id % 3) AS results_dir,
            'task-' || lpad(CAST(doc_id % 20 AS VARCHAR), 3, '0') || '-t' AS file_prefix, doc_id,
            CASE WHEN doc_id % 20 < 14 THEN 'name-' || ((doc_id % 20) // 2) END AS task_name, quality, toxic
        FROM labels
    ), reqs AS (
        SELECT '/runs/r' || (conv_id % 3) AS results_dir,
            'task-' || lpad(CAST(conv_id % 20 AS VARCHAR), 3, '0') || '-t' AS file_prefix,
            conv_id AS doc_id, turn AS idx,
            CASE WHEN conv_id % 20 < 6 THEN 'name-' || ((conv_id % 20) // 2) END AS task_name, role, text
        FROM conversations
    ), metrics AS (
        SELECT '/runs/r' || (doc_id % 3) AS results_dir,
            CASE WHEN doc_id % 20 < 14 THEN 'name-' || ((doc_id % 20) // 2)
                WHEN doc_id % 20 < 18 THEN 't' ELSE 'aggregate' END AS task_name,
            count(*) AS num_instances, CAST(sum(n_chars) AS BIGINT) AS chars
        FROM documents GROUP BY ALL
    ), prefixes AS (
        SELECT results_dir, file_prefix FROM preds UNION SELECT results_dir, file_prefix FROM recs
        UNION SELECT results_dir, file_prefix FROM reqs
    ), named AS (
        SELECT results_dir, file_prefix, max(task_name) AS task_name FROM (
            SELECT results_dir, file_prefix, task_name FROM recs
            UNION ALL SELECT results_dir, file_prefix, task_name FROM reqs
        ) GROUP BY ALL
    ), names AS (
        SELECT p.results_dir, p.file_prefix,
            coalesce(n.task_name, regexp_replace(p.file_prefix, '^task-\\d+-', '')) AS task_name
        FROM prefixes p LEFT JOIN named n USING (results_dir, file_prefix)
    ), met AS (
        SELECT n.results_dir, n.file_prefix, m.task_name, m.num_instances, m.chars
        FROM metrics m JOIN names n USING (results_dir, task_name)
    )
"""

_EXPORTED = """
    exported AS (
        SELECT 'task-' || lpad(CAST(o_custkey % 50 AS VARCHAR), 3, '0') AS file_prefix,
            o_orderkey % 100 AS doc_id, o_orderkey, o_orderstatus AS prd_status,
            CASE WHEN o_orderkey % 7 = 0 THEN NULL
                WHEN o_orderkey % 2 = 0 THEN '{"k":' || (o_custkey % 400) || ',"task_name":"'
                    || o_orderpriority || '","p":"' || o_orderstatus || '"}'
                ELSE '{"p":"' || o_orderstatus || '","task_name":"' || o_orderpriority || '","k":'
                    || (o_custkey % 400) || '.0}' END AS met_task_config,
            CASE WHEN o_orderkey % 7 <> 0 THEN (o_custkey % 400) || '/' || o_orderstatus END AS content
        FROM orders
    )
"""


def _dedupe_sql(key):
    return f"""
    WITH {_EXPORTED}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY file_prefix, doc_id, o_orderkey) AS place
        FROM exported
    )
    SELECT DISTINCT doc_id, prd_status, met_task_config FROM ranked WHERE {key} IS NULL OR place = 1
    """


QUERIES = {
    "spine_export": spine_export,
    "spine_export_hot_keys": spine_export_hot_keys,
    "task_name_map": task_name_map,
    "metrics_to_prefix": metrics_to_prefix,
    "config_rank_dedupe": config_rank_dedupe,
    "config_rank_dedupe_raw": config_rank_dedupe_raw,
}
SQL = {
    "spine_export": f"""
    WITH {_INPUTS}, spine AS (
        SELECT results_dir, file_prefix, doc_id, CAST(NULL AS BIGINT) AS idx FROM preds
        UNION SELECT results_dir, file_prefix, doc_id, NULL FROM recs
        UNION SELECT results_dir, file_prefix, doc_id, idx FROM reqs
    )
    SELECT s.results_dir, s.file_prefix, s.doc_id, s.idx,
        p.source AS prd_source, p.n_chars AS prd_n_chars, p.text AS prd_text,
        r.task_name AS rin_task_name, r.quality AS rin_quality, r.toxic AS rin_toxic,
        q.task_name AS req_task_name, q.role AS req_role, q.text AS req_request_text,
        m.task_name AS met_task_name, m.num_instances AS met_num_instances, m.chars AS met_chars,
        CASE WHEN m.task_name IS NOT NULL
            THEN '{{"n":' || m.num_instances || ',"task":"' || m.task_name || '"}}' END AS met_task_config
    FROM spine s
    LEFT JOIN preds p USING (results_dir, file_prefix, doc_id)
    LEFT JOIN recs r USING (results_dir, file_prefix, doc_id)
    LEFT JOIN reqs q ON q.results_dir = s.results_dir AND q.file_prefix = s.file_prefix
        AND q.doc_id = s.doc_id AND q.idx IS NOT DISTINCT FROM s.idx
    LEFT JOIN met m ON m.results_dir = s.results_dir AND m.file_prefix = s.file_prefix
    """,
    "spine_export_hot_keys": """
    WITH preds AS (
        SELECT CASE WHEN doc_id % 3 = 0 THEN -1 ELSE doc_id END AS doc_id, source, n_chars FROM documents
    ), reqs AS (
        SELECT CASE WHEN o_orderkey % 3 = 0 THEN -2 ELSE o_orderkey END AS doc_id, o_orderkey % 40 AS idx, o_custkey
        FROM orders
    ), spine AS (
        SELECT doc_id, CAST(NULL AS BIGINT) AS idx FROM preds UNION SELECT doc_id, NULL FROM labels
        UNION SELECT doc_id, idx FROM reqs
    )
    SELECT '/runs/r0' AS results_dir, 'task-000-t' AS file_prefix, s.doc_id, s.idx, p.source AS prd_source,
        p.n_chars AS prd_n_chars, CASE WHEN r.doc_id IS NOT NULL THEN 't' END AS rin_task_name, r.quality AS rin_quality,
        CASE WHEN q.doc_id IS NOT NULL THEN 't' END AS req_task_name, q.o_custkey AS req_o_custkey,
        't' AS met_task_name, (SELECT count(*) FROM documents) AS met_num_instances
    FROM spine s LEFT JOIN preds p ON p.doc_id = s.doc_id LEFT JOIN labels r ON r.doc_id = s.doc_id
    LEFT JOIN reqs q ON q.doc_id = s.doc_id AND q.idx IS NOT DISTINCT FROM s.idx
    """,
    "task_name_map": f"WITH {_INPUTS} SELECT results_dir, file_prefix, task_name FROM names",
    "metrics_to_prefix": f"WITH {_INPUTS} SELECT * FROM met",
    "config_rank_dedupe": _dedupe_sql("content"),
    "config_rank_dedupe_raw": _dedupe_sql("met_task_config"),
}
