"""Dump folders written from the tables, then read by the file sources and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import records as record_lines
from checks import runs as run_rows
from checks.documents import artifacts
from checks.dump import write_files
from checks.shape import table
from evalflow.plans import export, metrics_all
from evalflow.session import fresh_folder
from evalflow.sources import files
from evalflow.streaming import ingest

_CHUNK = 100_000
_BATCH_BYTES = 64 << 20


def _relative(c, root):
    return F.regexp_replace(c, f"^(file:)?/*{root.lstrip('/')}/", "")


def _dump(spark, folder):
    """Evaluation directories as files: documents, labels, conversations and metrics.

    File names carry a chunk number of the documents, so files stay bounded.
    """
    root = fresh_folder(spark, "dump")
    preds, recs, reqs, metrics = artifacts(spark, folder)

    def lines(df, artifact):
        chunk = F.floor(F.col("doc_id") / _CHUNK).cast("string")
        file = F.concat(
            F.substring("results_dir", 2, 100), F.lit("/"), "file_prefix", chunk, F.lit(f"-{artifact}.jsonl")
        )
        fields = [c for c in df.columns if c not in ("results_dir", "file_prefix")]
        return df.select(file.alias("file"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in fields])).alias("line"))

    shaped = [
        lines(preds.select("results_dir", "file_prefix", "doc_id", F.col("source").alias("task_hash"), F.col("text").alias("label")), "predictions"),
        lines(recs.select("results_dir", "file_prefix", "doc_id", "task_name", F.col("quality").alias("label")), "recorded-inputs"),
        lines(reqs.select("results_dir", "file_prefix", "doc_id", "idx", "task_name", F.col("role").alias("request_type")), "requests"),
        metrics.select(
            F.concat(F.substring("results_dir", 2, 100), F.lit("/metrics-all.jsonl")).alias("file"),
            F.to_json(F.struct("task_name", "num_instances")).alias("line"),
        ),
    ]
    rows = shaped[0]
    for part in shaped[1:]:
        rows = rows.unionAll(part)
    write_files(rows, root)
    return root


def manifest(spark, folder):
    root = _dump(spark, folder)
    found = files.manifest(spark, root)
    return found.select(*[_relative(F.col(c), root).alias(c) if c != "artifact" else c for c in found.columns])


def eval_export(spark, folder):
    """Dump files through the whole export job."""
    root = _dump(spark, folder)
    out = export.run_export(
        spark, root, fresh_folder(spark, "export"), fresh_folder(spark, "work")
    )["data"]
    return out.select(
        "slug", "file_prefix", F.col("doc_id").cast("long").alias("doc_id"), "idx", "prd_task_hash", "prd_label", "rin_task_name",
        "rin_label", "req_request_type", "met_task_name", "met_num_instances",
    )


def _document_lines(spark, folder):
    """Documents as predictions of one run, conversations as requests, in files with odd names.

    Ids are text, lines hold a field that no schema declares, and some requests an index that
    is no number.
    """
    def name(key, artifact):
        return F.concat(F.lit("runs/r/task-002-x%20y"), F.floor(F.col(key) / _CHUNK).cast("string"), F.lit(f"-{artifact}.jsonl"))

    docs = table(spark, folder, "documents").select(
        name("doc_id", "predictions").alias("file"),
        F.to_json(F.struct(F.concat(F.lit("q"), "doc_id").alias("doc_id"), F.col("lang").alias("task_hash"), F.col("source").alias("brand_new"))).alias("line"),
    )
    turns = table(spark, folder, "conversations").withColumn("idx", F.when(F.col("conv_id") % 7 == 0, F.lit("bad")).otherwise(F.col("turn").cast("string")))
    idx = F.when(F.col("idx") == "bad", F.lit('"bad"')).otherwise(F.col("idx"))
    turns = turns.select(
        name("conv_id", "requests").alias("file"),
        F.concat(F.lit('{"doc_id":"q'), "conv_id", F.lit('","idx":'), idx, F.lit(',"request_type":"'), "role", F.lit('"}')).alias("line"),
    )
    metrics = spark.range(1).select(F.lit("runs/r/metrics-all.jsonl").alias("file"), F.lit('{"task_name":"none"}').alias("line"))
    return docs.unionAll(turns).unionAll(metrics)


def eval_export_odd_fields(spark, folder):
    """Nothing of odd files is lost: what the export holds, and what it set aside."""
    root = fresh_folder(spark, "odd")
    write_files(_document_lines(spark, folder), root)
    job = export.run_export(spark, root, fresh_folder(spark, "export"), fresh_folder(spark, "work"))
    kept = job["data"].select(
        "slug", "file_prefix", "doc_id", "idx", "prd_task_hash",
        F.get_json_object("prd_undeclared_fields", "$.brand_new").alias("brand_new"),
        "req_request_type", F.lit(None).cast("string").alias("reason"),
    )
    aside = job["quarantine"].select(
        *[F.lit(None).cast("string").alias(c) for c in ("slug", "file_prefix")],
        F.get_json_object("line", "$.doc_id").alias("doc_id"), F.lit(None).cast("long").alias("idx"),
        *[F.lit(None).cast("string").alias(c) for c in ("prd_task_hash", "brand_new")],
        F.get_json_object("line", "$.request_type").alias("req_request_type"), "reason",
    )
    return kept.unionAll(aside)


def eval_export_two_roots(spark, folder):
    """Two roots with runs of one name; the first root is exported again by force."""
    roots = [fresh_folder(spark, "left") + "/a", fresh_folder(spark, "right") + "/b"]
    docs = table(spark, folder, "documents")
    for side, root in enumerate(roots):
        own = docs.where(F.col("doc_id") % 2 == side).select(
            F.concat(F.lit("x/run__1/task-001-t"), F.floor(F.col("doc_id") / _CHUNK).cast("string"), F.lit("-predictions.jsonl")).alias("file"),
            F.to_json(F.struct("doc_id", F.col("source").alias("task_hash"))).alias("line"),
        )
        metrics = spark.range(1).select(F.lit("x/run__1/metrics-all.jsonl").alias("file"), F.lit('{"task_name":"none"}').alias("line"))
        write_files(own.unionAll(metrics), root)
    out = fresh_folder(spark, "export")
    export.run_export(spark, roots, out, fresh_folder(spark, "work"))
    job = export.run_export(
        spark, roots, out, fresh_folder(spark, "work"), wanted_dirs=[f"{roots[0].removeprefix('file://')}/x/run__1"], force=True
    )
    return job["data"].select("slug", "doc_id", "prd_task_hash")


def results_load(spark, folder):
    """Results files written out, then loaded and merged across directories."""
    root = fresh_folder(spark, "results")
    lines = record_lines.lines(spark, folder)
    write_files(lines.select(F.substring("path", 2, 200).alias("file"), "line"), root)
    merged = metrics_all.load_all_results(spark, root)["records"]
    return merged.select(
        "canon", "task_name", "task_idx", _relative(F.col("result_dir"), root).alias("result_dir"), "copies"
    )


def incremental_ingest(spark, folder):
    """Two runs over a growing folder; the second reads only the new files."""
    root, out = fresh_folder(spark, "growing"), fresh_folder(spark, "ingested")
    lines = record_lines.lines(spark, folder).select(F.substring("path", 2, 200).alias("file"), "line")
    early = F.col("file").rlike(r"/r[0-5]c")
    for part in (early, ~early):
        write_files(lines.where(part), root)
        ingest.ingest_new_files(spark, root, out).awaitTermination()
    read = spark.read.parquet(f"{out}/records")
    return read.select(_relative(F.col("path"), root).alias("path"), "canon")


def stream_dedupe(spark, folder):
    """Distinct records per directory, kept by a stateful stream."""
    root, out = fresh_folder(spark, "stream"), fresh_folder(spark, "distinct")
    lines = record_lines.lines(spark, folder).select(F.substring("path", 2, 200).alias("file"), "line")
    write_files(lines, root)
    kept = ingest.stream_records(ingest.stream_lines(spark, root, bytes_per_batch=_BATCH_BYTES))
    query = (
        kept.select("results_dir", "canon")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{out}/_progress")
        .trigger(availableNow=True)
        .start(f"{out}/data")
    )
    query.awaitTermination()
    read = spark.read.parquet(f"{out}/data")
    return read.select(_relative(F.col("results_dir"), root).alias("results_dir"), "canon")


def stream_classify(spark, folder):
    """Runs classified as a stream; shows the classification log written beside them."""
    out = fresh_folder(spark, "classified")
    stored = fresh_folder(spark, "runs")
    run_rows.run_table(spark, folder).select("run_id").write.parquet(stored)
    stream = spark.readStream.schema("run_id string").parquet(stored)
    ingest.classify_stream(stream, out).awaitTermination()
    return spark.read.parquet(f"{out}/classification_log").select("run_id", "run_type", "pattern")


QUERIES = {
    "manifest": manifest,
    "eval_export": eval_export,
    "eval_export_odd_fields": eval_export_odd_fields,
    "eval_export_two_roots": eval_export_two_roots,
    "results_load": results_load,
    "incremental_ingest": incremental_ingest,
    "stream_record_dedupe": stream_dedupe,
    "stream_classify_runs": stream_classify,
}

_DUMP = """
    preds AS (
        SELECT 'runs/r' || (doc_id % 3) AS dir, 'task-' || lpad(CAST(doc_id % 20 AS VARCHAR), 3, '0') || '-t'
            || (doc_id // 100000) AS file_prefix, doc_id, source, text FROM documents
    ), recs AS (
        SELECT 'runs/r' || (doc_id % 3) AS dir, 'task-' || lpad(CAST(doc_id % 20 AS VARCHAR), 3, '0') || '-t'
            || (doc_id // 100000) AS file_prefix, doc_id, quality,
            CASE WHEN doc_id % 20 < 14 THEN 'name-' || ((doc_id % 20) // 2) END AS task_name FROM labels
    ), reqs AS (
        SELECT 'runs/r' || (conv_id % 3) AS dir, 'task-' || lpad(CAST(conv_id % 20 AS VARCHAR), 3, '0') || '-t'
            || (conv_id // 100000) AS file_prefix, conv_id AS doc_id, turn AS idx, role,
            CASE WHEN conv_id % 20 < 6 THEN 'name-' || ((conv_id % 20) // 2) END AS task_name FROM conversations
    ), metrics AS (
        SELECT 'runs/r' || (doc_id % 3) AS dir,
            CASE WHEN doc_id % 20 < 14 THEN 'name-' || ((doc_id % 20) // 2)
                WHEN doc_id % 20 < 18 THEN 't' ELSE 'aggregate' END AS task_name, count(*) AS num_instances
        FROM documents GROUP BY ALL
    )
"""
QUERIES_SQL_NAMES = """
    names AS (
        SELECT dir, file_prefix, coalesce(max(task_name), regexp_replace(file_prefix, '^task-\\d+-', '')) AS task_name
        FROM (SELECT dir, file_prefix, NULL AS task_name FROM preds
            UNION ALL SELECT dir, file_prefix, task_name FROM recs
            UNION ALL SELECT dir, file_prefix, task_name FROM reqs)
        GROUP BY dir, file_prefix
    )
"""
_RUNS_SQL = run_rows.SQL["classification_log"]

SQL = {
    "manifest": f"""
    WITH {_DUMP}
    SELECT DISTINCT dir AS results_dir, 'metrics-all' AS artifact, dir || '/metrics-all.jsonl' AS path FROM metrics
    UNION SELECT dir, 'predictions', dir || '/' || file_prefix || '-predictions.jsonl' FROM preds
    UNION SELECT dir, 'recorded-inputs', dir || '/' || file_prefix || '-recorded-inputs.jsonl' FROM recs
    UNION SELECT dir, 'requests', dir || '/' || file_prefix || '-requests.jsonl' FROM reqs
    """,
    "eval_export": f"""
    WITH {_DUMP}, {QUERIES_SQL_NAMES}, spine AS (
        SELECT dir, file_prefix, doc_id, CAST(NULL AS BIGINT) AS idx FROM preds
        UNION SELECT dir, file_prefix, doc_id, NULL FROM recs
        UNION SELECT dir, file_prefix, doc_id, idx FROM reqs
    )
    SELECT replace(s.dir, '/', '__') AS slug, s.file_prefix, s.doc_id, s.idx, p.source AS prd_task_hash,
        CAST(to_json(p.text) AS VARCHAR) AS prd_label, r.task_name AS rin_task_name,
        CAST(r.quality AS VARCHAR) AS rin_label, q.role AS req_request_type,
        m.task_name AS met_task_name, m.num_instances AS met_num_instances
    FROM spine s
    LEFT JOIN preds p ON p.dir = s.dir AND p.file_prefix = s.file_prefix AND p.doc_id = s.doc_id
    LEFT JOIN recs r ON r.dir = s.dir AND r.file_prefix = s.file_prefix AND r.doc_id = s.doc_id
    LEFT JOIN reqs q ON q.dir = s.dir AND q.file_prefix = s.file_prefix AND q.doc_id = s.doc_id
        AND q.idx IS NOT DISTINCT FROM s.idx
    LEFT JOIN (SELECT n.dir, n.file_prefix, x.task_name, x.num_instances
        FROM metrics x JOIN names n ON n.dir = x.dir AND n.task_name = x.task_name) m
        ON m.dir = s.dir AND m.file_prefix = s.file_prefix
    """,
    "eval_export_odd_fields": """
    WITH preds AS (
        SELECT 'task-002-x%20y' || (doc_id // 100000) AS f, 'q' || doc_id AS d, lang, source FROM documents
    ), reqs AS (
        SELECT 'task-002-x%20y' || (conv_id // 100000) AS f, 'q' || conv_id AS d, turn, role, conv_id % 7 = 0 AS bad
        FROM conversations
    ), spine AS (
        SELECT f, d, CAST(NULL AS BIGINT) AS idx FROM preds
        UNION SELECT f, d, turn FROM reqs WHERE NOT bad
    )
    SELECT 'runs__r' AS slug, s.f AS file_prefix, s.d AS doc_id, s.idx, p.lang AS prd_task_hash,
        p.source AS brand_new, q.role AS req_request_type, CAST(NULL AS VARCHAR) AS reason
    FROM spine s LEFT JOIN preds p ON p.f = s.f AND p.d = s.d
    LEFT JOIN (SELECT * FROM reqs WHERE NOT bad) q ON q.f = s.f AND q.d = s.d AND q.turn = s.idx
    UNION ALL
    SELECT NULL, NULL, d, NULL, NULL, NULL, role, 'a value does not fit its type' FROM reqs WHERE bad
    """,
    "eval_export_two_roots": """
    SELECT CASE doc_id % 2 WHEN 0 THEN 'a' ELSE 'b' END || '__x__run_%5F1' AS slug,
        CAST(doc_id AS VARCHAR) AS doc_id, source AS prd_task_hash FROM documents
    """,
    "results_load": f"""
    WITH {record_lines._LINES}
    SELECT canon, any_value(task_name) AS task_name, any_value(task_idx) AS task_idx,
        substr(min(result_dir), 2) AS result_dir, count(*) AS copies
    FROM enriched GROUP BY canon
    """,
    "incremental_ingest": f"""
    WITH {record_lines._LINES}
    SELECT substr(result_dir, 2) || '/metrics-all.jsonl' AS path,
        CASE WHEN event_id % 83 = 0 THEN '{{"task_name":' || k || '}}'
            ELSE '{{"metrics":{{"b":true,"k":' || k || '}},"task_idx":' || (k % 8) || ',"task_name":"'
                || event_type || '"}}' END AS canon
    FROM src WHERE event_id % 97 <> 0 AND event_id % 89 <> 0
    """,
    "stream_record_dedupe": f"""
    WITH {record_lines._LINES}
    SELECT DISTINCT substr(result_dir, 2) AS results_dir,
        CASE WHEN event_id % 83 = 0 THEN '{{"task_name":' || k || '}}'
            ELSE '{{"metrics":{{"b":true,"k":' || k || '}},"task_idx":' || (k % 8) || ',"task_name":"'
                || event_type || '"}}' END AS canon
    FROM src WHERE event_id % 97 <> 0 AND event_id % 89 <> 0
    """,
    "stream_classify_runs": _RUNS_SQL,
}
