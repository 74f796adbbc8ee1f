"""All results files: distinct records with their artifact paths, copies merged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalflow import constants as C
from evalflow.functions.paths import parent_dir, task_stem
from evalflow.operators.columns import compute_once
from evalflow.operators.dedupe import copy_paths, distinct_records, merge_copies
from evalflow.operators.joins import left_join
from evalflow.sources import files, records


RECORD = ("canon", "task_name", "task_idx", "task_file_stem")


def with_task(rows: DataFrame) -> DataFrame:
    """Add task name, index and file stem read from the canonical record."""
    fields = F.from_json("canon", "task_name variant, task_idx variant")
    parsed = compute_once(rows, {"_f": fields})
    name, idx = F.col("_f.task_name"), F.col("_f.task_idx")
    text = F.when(F.schema_of_variant(name) == "STRING", F.try_variant_get(name, "$", "string"))
    whole = F.when(F.schema_of_variant(idx) == "BIGINT", F.try_variant_get(idx, "$", "int"))
    named = compute_once(parsed, {"task_name": text, "task_idx": whole}, keep=rows.columns)
    return named.withColumn("task_file_stem", task_stem(F.col("task_idx"), F.col("task_name")))


def directory_records(lines: DataFrame) -> DataFrame:
    """Distinct records per results directory, in canonical form."""
    rows = records.canonical_records(lines).select(
        parent_dir(F.col("path")).alias("result_dir"), F.col("path").alias("eval_results_path"), "canon"
    )
    return with_task(distinct_records(rows, ["result_dir", "eval_results_path", "canon"]))


def enriched_records(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Records with the artifact paths of their task; records without a text task name are left out."""
    sides = index.withColumnRenamed("stem", "task_file_stem")
    return left_join(
        rows.where(F.col("task_name").isNotNull()), sides, ["result_dir", "task_file_stem"]
    )


def rejected_records(lines: DataFrame) -> DataFrame:
    """Quarantine: lines that are no object, and records without a text task name."""
    nameless = directory_records(lines).where(F.col("task_name").isNull())
    return records.bad_lines(lines).unionByName(
        nameless.select(
            F.col("eval_results_path").alias("path"),
            F.col("canon").alias("line"),
            F.lit("task_name must be a string").alias("reason"),
            F.current_timestamp().alias("at"),
        )
    )


def _copies(rows: DataFrame, strict: bool) -> tuple[DataFrame, list[str], list[str]]:
    """Rows with their place in the order, the content columns and the path columns."""
    keys = [*RECORD, *(["recorded-inputs"] if strict else [])]
    ordered = rows.withColumns({"_dir": F.col("result_dir"), "_file": F.col("eval_results_path")})
    return ordered, keys, [p for p in C.PATH_COLUMNS if p not in keys]


def merged_records(rows: DataFrame, *, strict: bool = False) -> DataFrame:
    """One row per distinct content with the paths of its first copy; lazy.

    With ``strict`` the recorded-inputs path counts as content, so copies in two
    directories that hold that file stay apart.
    """
    ordered, keys, paths = _copies(rows, strict)
    return merge_copies(ordered, keys, ["_dir", "_file"], paths)


def record_paths(rows: DataFrame, *, strict: bool = False) -> DataFrame:
    """Every path of every copy, one row each, by the ``record`` of :func:`merged_records`; lazy."""
    ordered, keys, paths = _copies(rows, strict)
    return copy_paths(ordered, keys, ["_dir", "_file"], paths)


def load_all_results(spark: SparkSession, roots: files.Roots, *, strict: bool = False) -> dict[str, DataFrame]:
    """The merged record tables of every results file below the roots.

    Nothing runs before a table is asked for.
    """
    lines = records.read_lines(spark, roots, C.RESULTS_FILE)
    index = files.artifact_index(files.discover(spark, roots, "task-*.jsonl"))
    rows = enriched_records(directory_records(lines), index)
    return {
        "records": merged_records(rows, strict=strict),
        "paths": record_paths(rows, strict=strict),
        "rejected": rejected_records(lines),
    }
