"""Exports over several runs: unreadable files, new and wider fields, commits."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.dump import write_files
from checks.shape import table
from evalflow.plans import export
from evalflow.session import fresh_folder
from evalflow.sinks import snapshots
from evalflow.sinks.tables import write_table
from evalflow.sources import files

_CHUNK = 100_000


def _lines(docs, folder, *fields):
    """Predictions of documents in files of ``folder`` (a column), and a results file for each."""
    name = F.concat(folder, F.lit("/task-000-x"), F.floor(F.col("doc_id") / _CHUNK).cast("string"), F.lit("-predictions.jsonl"))
    rows = docs.select(name.alias("file"), F.to_json(F.struct("doc_id", *fields)).alias("line"))
    results = docs.select(F.concat(folder, F.lit("/metrics-all.jsonl")).alias("file")).distinct()
    return rows.unionAll(results.select("file", F.lit('{"task_name":"none"}').alias("line")))


def _remove(spark, path):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def eval_export_unreadable(spark, folder):
    """Directories of every language, one of which loses its files after they were listed."""
    root = fresh_folder(spark, "unreadable")
    docs = table(spark, folder, "documents")
    write_files(_lines(docs, F.concat(F.lit("runs/"), "lang"), F.col("source").alias("task_hash")), root)
    kept = fresh_folder(spark, "listing")
    files.manifest(spark, root, lengths=True).write.parquet(kept)
    lost = spark.read.parquet(kept).where("results_dir like '%/de' and artifact = 'predictions'").select("path").collect()
    for row in lost:
        _remove(spark, row["path"])
    job = export.run_export(
        spark, root, fresh_folder(spark, "export"), fresh_folder(spark, "work"), listing=spark.read.parquet(kept)
    )
    name = F.regexp_extract(F.regexp_replace("path", "/[^/]*$", ""), "([^/]+)$", 1)
    unread = job["quarantine"].groupBy(F.concat(F.lit("runs__"), name).alias("slug")).agg(F.count(F.lit(1)).alias("unread"))
    rows = job["data"].groupBy("slug").agg(F.count(F.lit(1)).alias("rows"), F.count("prd_task_hash").alias("hashes"))
    return job["status"].join(rows, "slug", "left").join(unread, "slug", "left").na.fill(0)


def eval_export_new_fields(spark, folder):
    """Two runs; the second brings a field no run had and numbers that are no longer whole."""
    root, out = fresh_folder(spark, "fields"), fresh_folder(spark, "export")
    docs = table(spark, folder, "documents")
    even = F.col("doc_id") % 2 == 0
    write_files(_lines(docs.where(even), F.lit("runs/a"), F.col("n_chars").alias("size")), root)
    export.run_export(spark, root, out, fresh_folder(spark, "work"))
    later = docs.where(~even).withColumn("size", F.col("n_chars") + 0.5)
    write_files(_lines(later, F.lit("runs/b"), "size", F.when(F.col("doc_id") % 3 == 0, F.col("lang")).alias("tongue")), root)
    data = export.run_export(spark, root, out, fresh_folder(spark, "work"))["data"]
    return data.select("slug", F.col("doc_id").cast("long").alias("doc_id"), "prd_size", "prd_tongue")


def eval_export_commits(spark, folder):
    """Three states of one export: the first run, after a run that died, after a run without rows."""
    root, out = fresh_folder(spark, "commits"), fresh_folder(spark, "export")
    docs = table(spark, folder, "documents")
    write_files(_lines(docs, F.concat(F.lit("runs/"), "lang"), "source"), root)
    first = export.run_export(spark, root, out, fresh_folder(spark, "work"))["data"].groupBy("slug").count().withColumn("state", F.lit("first"))
    # a job that ended between its data and its commit
    lost = docs.select(F.lit("runs__en").alias("slug"), F.col("doc_id").cast("string").alias("doc_id"))
    write_table(lost, f"{out}/data/version=000000000001-lost", partition_by=("slug",))
    died = export.exported(spark, out)["data"].groupBy("slug").count().withColumn("state", F.lit("died"))
    listing = files.manifest(spark, root).where("results_dir like '%/fr' and artifact = 'predictions'")
    for row in listing.select("path").collect():
        _remove(spark, row["path"])
    again = export.run_export(spark, root, out, fresh_folder(spark, "work"), force=True)["data"]
    again = again.groupBy("slug").count().withColumn("state", F.lit("again"))
    rows = first.unionByName(died).unionByName(again)
    return rows.withColumn("commits", F.lit(snapshots.current(spark, out).number + 1)).withColumnRenamed("count", "rows")


QUERIES = {
    "eval_export_unreadable": eval_export_unreadable,
    "eval_export_new_fields": eval_export_new_fields,
    "eval_export_commits": eval_export_commits,
}
SQL = {
    "eval_export_unreadable": f"""
    SELECT 'runs__' || lang AS slug, CASE WHEN lang = 'de' THEN 'failed' ELSE 'processed' END AS status,
        CASE WHEN lang = 'de' THEN 0 ELSE count(*) END AS rows, CASE WHEN lang = 'de' THEN 0 ELSE count(source) END AS hashes,
        CASE WHEN lang = 'de' THEN count(DISTINCT doc_id // {_CHUNK}) ELSE 0 END AS unread
    FROM documents GROUP BY lang
    """,
    "eval_export_new_fields": """
    SELECT CASE WHEN doc_id % 2 = 0 THEN 'runs__a' ELSE 'runs__b' END AS slug, doc_id,
        n_chars + CASE WHEN doc_id % 2 = 0 THEN 0.0 ELSE 0.5 END AS prd_size,
        CASE WHEN doc_id % 2 = 1 AND doc_id % 3 = 0 THEN lang END AS prd_tongue
    FROM documents
    """,
    "eval_export_commits": """
    SELECT 'runs__' || lang AS slug, count(*) AS rows, state, 2 AS commits
    FROM documents, (VALUES ('first'), ('died'), ('again')) s(state)
    WHERE NOT (state = 'again' AND lang = 'fr') GROUP BY lang, state
    """,
}
