"""Whole jobs and their side tables: manifests, sidecars, overrides, sinks, orders of rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import archives as packed
from checks import documents as spine
from checks import runs as run_rows
from checks import train as train_rows
from checks.dump import write_files
from checks.shape import table
from checks.stored import numbered
from evalflow import schemas
from evalflow.plans import export, runs, tables
from evalflow.session import fresh_folder
from evalflow.sources import files, records
from evalflow.sources.archives import list_archives

FIVE = ("predictions", "recorded-inputs", "requests", "config", "metrics")


def _tail(c, parts):
    """The last parts of a path."""
    return F.array_join(F.slice(F.split(c, "/"), -parts, parts), "/")


def _nations(spark, folder):
    """A directory a region, and of each nation one file of every artifact in turn."""
    root = fresh_folder(spark, "nations")
    nations = table(spark, folder, "nation")
    where = F.concat(F.lit("r"), "n_regionkey", F.lit("/"))
    stem = F.concat(F.lit("task-"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0"), F.lit("-"), F.replace("n_name", F.lit(" "), F.lit("_")))
    kinds = F.array(*[F.lit(f"-{a}.{'json' if a in ('config', 'metrics') else 'jsonl'}") for a in FIVE])
    line = F.to_json(F.struct(F.col("n_name").alias("task_name"), F.col("n_nationkey").alias("num_instances")))
    rows = nations.select(F.concat(where, stem, F.get(kinds, (F.col("n_nationkey") % 5).cast("int"))).alias("file"), line.alias("line"))
    metrics = nations.select(F.concat(where, stem, F.lit("-metrics.json")).alias("file"), line.alias("line"))
    results = nations.select(F.concat(where, F.lit("metrics-all.jsonl")).alias("file"), F.lit("{}").alias("line")).distinct()
    write_files(rows.unionAll(metrics).unionAll(results).distinct(), root)
    return root


def manifest_five(spark, folder):
    """The manifest over all five kinds of artifact, two of them JSON documents."""
    found = files.manifest(spark, _nations(spark, folder), artifacts=FIVE)
    return found.select(_tail(F.col("results_dir"), 1).alias("dir"), "artifact", _tail(F.col("path"), 2).alias("path"))


def json_documents(spark, folder):
    """Documents that hold one JSON value a file."""
    rows = records.read_json_artifact(spark, _nations(spark, folder), "metrics")
    return rows.select("file_prefix", "doc_id", "task_name", "num_instances", _tail(F.col("path"), 2).alias("path"))


def spine_without_inputs(spark, folder):
    """An export whose recorded inputs and requests are empty typed tables."""
    preds = table(spark, folder, "documents").select(
        F.lit("d").alias("results_dir"), F.lit("task-000-t").alias("file_prefix"), F.col("doc_id").cast("string").alias("doc_id"), "lang"
    )

    def empty(kind):
        return schemas.empty(spark, kind).withColumns({"results_dir": F.lit("d"), "file_prefix": F.lit("")})

    metrics = schemas.empty(spark, schemas.METRICS_ALL).withColumn("results_dir", F.lit("d"))
    out = export.export_documents(preds, empty(schemas.RECORDED_INPUTS), empty(schemas.REQUESTS), metrics)
    return out.select("file_prefix", "doc_id", "idx", "prd_lang", "rin_doc", "req_request_type", "met_num_instances")


def spine_one_document(spark, folder):
    """The export of one document id."""
    return export.export_documents(*spine.artifacts(spark, folder), doc_id=20)


def export_sidecar(spark, folder):
    """What an export of one document says of its inputs."""
    root = fresh_folder(spark, "sidecar")
    docs = table(spark, folder, "documents")
    name = F.concat(F.lit("runs/"), "lang", F.lit("/task-000-x"), F.floor(F.col("doc_id") / 100).cast("string"), F.lit("-predictions.jsonl"))
    results = docs.select(F.concat(F.lit("runs/"), "lang", F.lit("/metrics-all.jsonl")).alias("file")).distinct()
    rows = docs.select(name.alias("file"), F.to_json(F.struct("doc_id")).alias("line"))
    write_files(rows.unionAll(results.withColumn("line", F.lit('{"task_name":"n"}'))), root)
    job = export.run_export(spark, root, fresh_folder(spark, "export"), fresh_folder(spark, "work"), doc_id=7)
    return job["manifest"].select("slug", "artifact", _tail(F.col("path"), 2).alias("path"), "doc_id_filter")


def train_job(spark, folder):
    """Shards to the train table and on to where it is published, counted there."""
    root, out = fresh_folder(spark, "shards"), fresh_folder(spark, "parsed")
    rows = train_rows.result_rows(spark, folder)
    half = F.col("step") % 2 == 0
    rows.where(half).write.parquet(f"{root}/a")
    rows.where(~half).write.parquet(f"{root}/b")
    tables.parse_train(spark, [f"{root}/a", f"{root}/b"], out, target=f"{out}/published")
    read = spark.read.parquet(f"{out}/published/train_results.parquet")
    return read.groupBy("recipe", "task_group", "params_numeric").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("step")).alias("steps"), F.count("acc_baseline").alias("baselines")
    )


def own_classifier(df, column):
    """Types by words in a run's name, no patterns."""
    kind = F.when(F.col(column).contains("finetune"), "tuned").when(F.col(column).contains("default"), "old").otherwise("plain")
    return df.withColumns({"run_type": kind, "pattern_name": F.lit("OWN")})


def runs_overrides(spark, folder):
    """Runs processed with a classifier, fields, names and defaults of the caller's own."""
    out = runs.process_runs(
        run_rows.run_table(spark, folder).drop("created_at"),
        classifier=own_classifier,
        config_fields={"origin": "initial_checkpoint_recipe"},
        summary_fields={"seen": "total_tokens"},
        column_map={"origin": "first_recipe"},
        defaults={"no_such_column": "x"},
    )
    return out.select("run_id", "run_type", "pattern_name", "first_recipe", F.col("seen").cast("long").alias("seen"))


def matched_run_order(spark, folder):
    """Matched runs with their place in pattern and id order."""
    rows = runs.by_run_type(runs.classified(run_rows._ids(spark, folder)), ["matched"])["matched"]
    return numbered(rows.select("pattern_name", "run_id")).select("pattern_name", "run_id", "place")


def archive_order(spark, folder):
    """Archives of one setting with their place in path order."""
    listed = list_archives(spark, packed._archived(spark, folder, 20), "c4", "4M", 2)
    return numbered(listed.select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"))).select("name", "place")


_KIND = """CASE n_nationkey % 5 WHEN 0 THEN 'predictions' WHEN 1 THEN 'recorded-inputs' WHEN 2 THEN 'requests'
    WHEN 3 THEN 'config' ELSE 'metrics' END"""
_STEM = "'task-' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') || '-' || replace(n_name, ' ', '_')"

QUERIES = {
    "manifest_five": manifest_five,
    "json_documents": json_documents,
    "spine_without_inputs": spine_without_inputs,
    "spine_one_document": spine_one_document,
    "export_sidecar": export_sidecar,
    "train_job": train_job,
    "runs_overrides": runs_overrides,
    "matched_run_order": matched_run_order,
    "archive_order": archive_order,
}
SQL = {
    "manifest_five": f"""
    WITH made AS (
        SELECT n_regionkey, {_STEM} AS stem, {_KIND} AS artifact FROM nation
        UNION SELECT n_regionkey, {_STEM}, 'metrics' FROM nation
    )
    SELECT 'r' || n_regionkey AS dir, artifact,
        'r' || n_regionkey || '/' || stem || '-' || artifact || CASE WHEN artifact IN ('config', 'metrics') THEN '.json' ELSE '.jsonl' END AS path
    FROM made
    UNION ALL SELECT DISTINCT 'r' || n_regionkey, 'metrics-all', 'r' || n_regionkey || '/metrics-all.jsonl' FROM nation
    """,
    "json_documents": f"""
    SELECT {_STEM} AS file_prefix, CAST(NULL AS VARCHAR) AS doc_id, n_name AS task_name, n_nationkey AS num_instances,
        'r' || n_regionkey || '/' || {_STEM} || '-metrics.json' AS path
    FROM nation
    """,
    "spine_without_inputs": """
    SELECT 'task-000-t' AS file_prefix, CAST(doc_id AS VARCHAR) AS doc_id, CAST(NULL AS BIGINT) AS idx, lang AS prd_lang,
        CAST(NULL AS VARCHAR) AS rin_doc, CAST(NULL AS VARCHAR) AS req_request_type, CAST(NULL AS BIGINT) AS met_num_instances
    FROM documents
    """,
    "spine_one_document": f"SELECT * FROM ({spine.SQL['spine_export']}) WHERE doc_id = 20",
    "export_sidecar": """
    SELECT DISTINCT 'runs__' || lang || '__doc7' AS slug, 'predictions' AS artifact,
        lang || '/task-000-x' || (doc_id // 100) || '-predictions.jsonl' AS path, '7' AS doc_id_filter FROM documents
    UNION ALL SELECT DISTINCT 'runs__' || lang || '__doc7', 'metrics-all', lang || '/metrics-all.jsonl', '7' FROM documents
    """,
    "train_job": f"""
    SELECT recipe, task_group, params_numeric, count(*) AS rows, CAST(sum(step) AS BIGINT) AS steps, count(acc_baseline) AS baselines
    FROM ({train_rows.SQL['train_parse']}) GROUP BY ALL
    """,
    "runs_overrides": f"""
    WITH {run_rows._RUNS}, made AS (
        SELECT run_id, CASE WHEN contains(run_id, 'finetune') THEN 'tuned' WHEN contains(run_id, 'default') THEN 'old'
            ELSE 'plain' END AS run_type, n, k FROM src
    )
    SELECT run_id, run_type, 'OWN' AS pattern_name, CASE WHEN n % 11 <> 0 AND n % 7 <> 0 THEN 'falcon' END AS first_recipe,
        CASE WHEN n % 5 <> 0 THEN CAST(k AS BIGINT) END AS seen
    FROM made WHERE run_type <> 'old'
    """,
    "matched_run_order": f"""
    WITH {run_rows._RUNS}
    SELECT pattern_name, run_id, row_number() OVER (ORDER BY pattern_name, run_id) AS place FROM typed WHERE run_type = 'matched'
    """,
    "archive_order": """
    SELECT name, row_number() OVER (ORDER BY name) AS place
    FROM (SELECT DISTINCT 'part-' || (conv_id // 20) || '.tar.gz' AS name FROM conversations)
    """,
}
