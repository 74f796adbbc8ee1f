"""Record dedupe with ``events`` as lines of many results files."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.shape import table
from evalflow.plans import metrics_all
from evalflow.session import settle
from evalflow.sources import files, records

_CHUNK = 20_000
ROLES = ("predictions", "recorded-inputs", "requests")


def _k():
    return F.get_json_object("props", "$.k").cast("long")


def lines(spark, folder):
    """Result lines: two key orders, ``1`` and ``1.0``, some without a task, some broken.

    A folder name carries a chunk number of the events, so files stay bounded.
    """
    k, idx = _k().cast("string"), (_k() % 8).cast("string")
    name = F.col("event_type")
    forward = F.concat(
        F.lit('{"task_name":"'), name, F.lit('","task_idx":'), idx, F.lit(',"metrics":{"k":'), k, F.lit(',"b":true}}')
    )
    backward = F.concat(
        F.lit('{"metrics":{"b":true, "k":'), k, F.lit(".0},"), F.lit('"task_idx":'), idx, F.lit(',"task_name":"'), name, F.lit('"}')
    )
    no_name = F.concat(F.lit('{"task_name":'), k, F.lit("}"))
    number = F.col("event_id")
    line = (
        F.when(number % 97 == 0, F.concat(F.lit("broken "), k))
        .when(number % 89 == 0, F.concat(F.lit("["), k, F.lit("]")))
        .when(number % 83 == 0, no_name)
        .when(number % 2 == 0, forward)
        .otherwise(backward)
    )
    folder_name = F.concat(
        F.lit("/runs/r"), (F.col("user_id") % 13).cast("string"), F.lit("c"), F.floor(number / _CHUNK).cast("string")
    )
    return table(spark, folder, "events").select(
        F.concat(folder_name, F.lit("/metrics-all.jsonl")).alias("path"), line.alias("line")
    )


def artifact_paths(spark, folder):
    """Paths of task files: one role exists for each task of a directory."""
    role = F.element_at(
        F.array(*[F.lit(r) for r in ROLES]), ((F.col("user_id") % 13 + _k() % 8) % 3).cast("int") + 1
    )
    path = F.concat(
        F.lit("/runs/r"), (F.col("user_id") % 13).cast("string"), F.lit("c"),
        F.floor(F.col("event_id") / _CHUNK).cast("string"), F.lit("/task-"),
        F.lpad((_k() % 8).cast("string"), 3, "0"), F.lit("-"), F.col("event_type"), F.lit("-"), role, F.lit(".jsonl"),
    )
    return table(spark, folder, "events").select(path.alias("path")).distinct()


def enriched(spark, folder):
    index = files.artifact_index(artifact_paths(spark, folder))
    return metrics_all.enriched_records(metrics_all.directory_records(lines(spark, folder)), index)


def _plain(df):
    return df.withColumnsRenamed({"recorded-inputs": "recorded_inputs"})


def record_dedupe(spark, folder):
    return _plain(enriched(spark, folder))


def record_merge(spark, folder):
    return _plain(metrics_all.merged_records(enriched(spark, folder)).drop("record"))


def record_merge_strict(spark, folder):
    return _plain(metrics_all.merged_records(enriched(spark, folder), strict=True).drop("record"))


def _long(spark, folder):
    """Paths of all copies, each with the text of its record."""
    rows = enriched(spark, folder)
    texts = metrics_all.merged_records(rows).select("record", "canon")
    return metrics_all.record_paths(rows).join(texts, "record")


def record_copy_paths(spark, folder):
    return _long(spark, folder).select(
        "canon", "role", "path", F.col("first_seen._dir").alias("seen_dir"), F.col("first_seen._file").alias("seen_file")
    )


def record_path_arrays(spark, folder):
    """The long form in its order: the paths of a record as they were first seen.

    Rows are numbered inside ranges of the sorted table, so no record has to fit one task.
    """
    order = ["canon", "role", F.col("first_seen._dir"), "path"]
    ranged = (
        _long(spark, folder)
        .repartitionByRange(8, *order)
        .sortWithinPartitions(*order)
        .select("canon", "role", "path", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("n"))
    )
    ranged = settle(ranged)
    sizes = ranged.groupBy("range").agg(F.count("*").alias("size"), F.min("n").alias("first"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    return ranged.join(starts, "range").select(
        "canon", "role", "path", (F.col("start") + F.col("n") - F.col("first") + 1).alias("place")
    )


def quarantine(spark, folder):
    """Rejected lines with their reason; the time of the run is left out."""
    return metrics_all.rejected_records(lines(spark, folder)).select("path", "line", "reason")


def field_counts(spark, folder):
    return records.field_names(lines(spark, folder), "line")


_LINES = """
    src AS (
        SELECT event_id, event_type, user_id, '/runs/r' || (user_id % 13) || 'c' || (event_id // 20000) AS result_dir,
            CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
        FROM events
    ), good AS (
        SELECT DISTINCT result_dir, result_dir || '/metrics-all.jsonl' AS eval_results_path,
            '{"metrics":{"b":true,"k":' || k || '},"task_idx":' || (k % 8) || ',"task_name":"' || event_type || '"}'
                AS canon,
            event_type AS task_name, CAST(k % 8 AS INTEGER) AS task_idx,
            'task-' || lpad(CAST(k % 8 AS VARCHAR), 3, '0') || '-' || event_type AS task_file_stem
        FROM src WHERE event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 <> 0
    ), found AS (
        SELECT DISTINCT result_dir, 'task-' || lpad(CAST(k % 8 AS VARCHAR), 3, '0') || '-' || event_type AS stem,
            list_extract(['predictions', 'recorded-inputs', 'requests'], CAST((user_id % 13 + k % 8) % 3 AS INTEGER) + 1) AS role
        FROM src
    ), paths AS (
        SELECT result_dir, stem, role, result_dir || '/' || stem || '-' || role || '.jsonl' AS path FROM found
    ), enriched AS (
        SELECT g.*, a.path AS predictions, b.path AS recorded_inputs, c.path AS requests
        FROM good g
        LEFT JOIN paths a ON a.result_dir = g.result_dir AND a.stem = g.task_file_stem AND a.role = 'predictions'
        LEFT JOIN paths b ON b.result_dir = g.result_dir AND b.stem = g.task_file_stem AND b.role = 'recorded-inputs'
        LEFT JOIN paths c ON c.result_dir = g.result_dir AND c.stem = g.task_file_stem AND c.role = 'requests'
    ), long AS (
        SELECT canon, 'result_dir' AS role, result_dir AS path, result_dir, eval_results_path FROM enriched
        UNION ALL SELECT canon, 'eval_results_path', eval_results_path, result_dir, eval_results_path FROM enriched
        UNION ALL SELECT canon, 'predictions', predictions, result_dir, eval_results_path FROM enriched
        UNION ALL SELECT canon, 'recorded-inputs', recorded_inputs, result_dir, eval_results_path FROM enriched
        UNION ALL SELECT canon, 'requests', requests, result_dir, eval_results_path FROM enriched
    )
"""


def _merge_sql(keys):
    firsts = ", ".join(
        f"arg_min_null({c}, result_dir) AS {c}"
        for c in ("result_dir", "eval_results_path", "predictions", "recorded_inputs", "requests")
        if c not in keys
    )
    return f"""
    WITH {_LINES}
    SELECT {", ".join(keys)}, {firsts}, count(*) AS copies,
        any_value(task_name) AS task_name, any_value(task_idx) AS task_idx,
        any_value(task_file_stem) AS task_file_stem
    FROM enriched GROUP BY {", ".join(keys)}
    """


QUERIES = {
    "record_dedupe": record_dedupe,
    "record_dedupe_paths": record_merge,
    "record_dedupe_strict": record_merge_strict,
    "record_copy_paths": record_copy_paths,
    "record_path_arrays": record_path_arrays,
    "quarantine": quarantine,
    "field_counts": field_counts,
}
SQL = {
    "record_dedupe": f"WITH {_LINES} SELECT * FROM enriched",
    "record_dedupe_paths": _merge_sql(["canon"]),
    "record_dedupe_strict": _merge_sql(["canon", "recorded_inputs"]),
    "record_copy_paths": f"""
    WITH {_LINES}
    SELECT canon, role, path, min(result_dir) AS seen_dir, min(eval_results_path) AS seen_file
    FROM long GROUP BY canon, role, path
    """,
    "record_path_arrays": f"""
    WITH {_LINES}, firsts AS (
        SELECT canon, task_name, task_idx, task_file_stem, role, path, min(result_dir) AS seen
        FROM (SELECT l.*, e.task_name, e.task_idx, e.task_file_stem FROM long l
            JOIN (SELECT DISTINCT canon, task_name, task_idx, task_file_stem FROM enriched) e USING (canon))
        GROUP BY ALL
    )
    SELECT canon, role, path, row_number() OVER (ORDER BY canon, role, seen, path NULLS FIRST) AS place
    FROM firsts
    """,
    "quarantine": f"""
    WITH {_LINES}, bad AS (
        SELECT result_dir || '/metrics-all.jsonl' AS path, k,
            CASE WHEN event_id % 97 = 0 THEN 'not JSON' WHEN event_id % 89 = 0 THEN 'no object'
                ELSE 'task_name must be a string' END AS reason
        FROM src WHERE event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 83 = 0
    )
    SELECT path, CASE reason WHEN 'not JSON' THEN 'broken ' || k ELSE '[' || k || ']' END AS line, reason
    FROM bad WHERE reason <> 'task_name must be a string'
    UNION ALL
    SELECT DISTINCT path, '{{"task_name":' || k || '}}', reason
    FROM bad WHERE reason = 'task_name must be a string'
    """,
    "field_counts": f"""
    WITH {_LINES}, kept AS (
        SELECT event_id % 83 = 0 AS nameless FROM src WHERE event_id % 97 <> 0 AND event_id % 89 <> 0
    )
    SELECT 'task_name' AS field, count(*) AS rows FROM kept
    UNION ALL SELECT 'task_idx', count(*) FROM kept WHERE NOT nameless
    UNION ALL SELECT 'metrics', count(*) FROM kept WHERE NOT nameless
    """,
}
