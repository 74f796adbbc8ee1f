"""New result files as a stream: ingest, de-duplicate, classify."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from evalflow import constants as C
from evalflow.functions.jsontext import canonical_json
from evalflow.functions.paths import parent_dir
from evalflow.operators.columns import compute_once
from evalflow.functions.runids import classify_runs
from evalflow.plans.runs import Classifier
from evalflow.sinks.tables import write_table
from evalflow.sources.files import Roots, check_roots, decoded_path
from evalflow.sources.records import canonical_lines


def stream_lines(
    spark: SparkSession,
    roots: Roots,
    glob: str = C.RESULTS_FILE,
    *,
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
) -> DataFrame:
    """Stream of ``(path, line, modified)`` over files as they appear below the roots.

    A batch is bounded by a number of files or by their bytes, not by both. A batch has a
    fixed cost, a state commit in each shuffle partition among it: over many small files a bound in
    bytes keeps that cost in proportion to the data. A file larger than it is a batch alone.
    """
    if files_per_batch and bytes_per_batch:
        raise ValueError("a batch is bounded by files or by bytes, not by both")
    folders = check_roots(spark, roots)
    reader = (
        spark.readStream.format("text")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    streams = [reader.load(folder) for folder in folders]
    return (
        reduce(DataFrame.unionByName, [s.select("*", "_metadata") for s in streams])
        .select(
            decoded_path(F.col("_metadata.file_path")).alias("path"),
            F.col("value").alias("line"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
        .where(F.trim("line") != "")
    )


def stream_records(lines: DataFrame, *, within: str | None = None) -> DataFrame:
    """Distinct canonical records per results directory.

    State holds one digest per record and directory and grows with them. With
    ``within`` (such as ``"30 days"``) it is bounded: records are compared with
    those whose files were modified that close. The batch job is exact either way.
    """
    texts = compute_once(lines, {"canon": canonical_json(F.col("line"))})
    rows = texts.where(F.startswith("canon", F.lit("{"))).withColumns(
        {"results_dir": parent_dir(F.col("path")), "digest": F.sha2("canon", 256)}
    ).drop("line")
    if within:
        return rows.withWatermark("modified", within).dropDuplicatesWithinWatermark(["results_dir", "digest"])
    return rows.dropDuplicates(["results_dir", "digest"])


def ingest_new_files(
    spark: SparkSession, root: Roots, out: str, *, glob: str = C.RESULTS_FILE, files_per_batch: int | None = None
) -> StreamingQuery:
    """Append the records of files not seen before, then stop.

    The checkpoint is the list of finished files: a second run reads only new
    ones. Bad lines go to a quarantine table of the same batch. A batch that is
    run again after a failure replaces its own partition.
    """
    lines = stream_lines(spark, root, glob, files_per_batch=files_per_batch)

    def write_batch(batch: DataFrame, number: int) -> None:
        rows = canonical_lines(batch).withColumn("batch", F.lit(number)).persist()
        good = rows.where(F.col("reason").isNull()).select("path", "canon", "batch")
        bad = rows.where(F.col("reason").isNotNull()).select(
            "path", "line", "reason", F.current_timestamp().alias("at"), "batch"
        )
        write_table(good, f"{out}/records", partition_by=("batch",), rebalance=False)
        write_table(bad, f"{out}/quarantine", partition_by=("batch",), rebalance=False)
        rows.unpersist()

    return (
        lines.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", f"{out}/_progress")
        .trigger(availableNow=True)
        .start()
    )


def classify_stream(runs: DataFrame, out: str, *, classifier: Classifier = classify_runs) -> StreamingQuery:
    """Classified runs and, as a second table, the classification log.

    A batch is classified once; both tables are written from the kept rows.
    """

    def write_batch(batch: DataFrame, number: int) -> None:
        rows = classifier(batch, "run_id").withColumn("batch", F.lit(number)).persist()
        kept = rows.where(F.col("run_type") != "old")
        log = rows.select("run_id", "run_type", F.col("pattern_name").alias("pattern"), "batch")
        write_table(kept, f"{out}/runs", partition_by=("batch", "run_type"))
        write_table(log, f"{out}/classification_log", partition_by=("batch",), rebalance=False)
        rows.unpersist()

    return (
        runs.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", f"{out}/_progress")
        .trigger(availableNow=True)
        .start()
    )
