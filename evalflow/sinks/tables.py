"""Table sinks and job bookkeeping."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalflow.operators.columns import stringify
from evalflow.operators.joins import skip_listed
from evalflow.sources.files import require_files


def write_table(
    df: DataFrame,
    path: str,
    *,
    partition_by: tuple[str, ...] = (),
    rebalance: bool = True,
    mode: str = "overwrite",
) -> None:
    """Parquet; with partitions, an overwrite replaces only the partitions it writes.

    Rows of a partition are first brought together, or each task would write a
    file into every partition; a partition too large for one task is split again.
    ``rebalance=False`` is for frames that hold a single partition.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic" if partition_by else "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_text_table(df: DataFrame, path: str, **options) -> None:
    """Parquet with every column as text, for frames no other writer accepts."""
    write_table(stringify(df), path, **options)


def cut_lineage(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: later jobs start there."""
    write_table(df, path)
    return spark.read.schema(df.schema).parquet(path)


def plan_work(wanted: DataFrame, finished: DataFrame, *, force: bool = False) -> DataFrame:
    """``(slug, status)`` with ``skipped`` for finished slugs unless forced."""
    if force:
        return wanted.select("slug").distinct().withColumn("status", F.lit("processed"))
    todo = skip_listed(wanted.select("slug").distinct(), finished, ["slug"])
    done = wanted.select("slug").distinct().join(finished, "slug", "left_semi")
    return todo.withColumn("status", F.lit("processed")).unionByName(
        done.withColumn("status", F.lit("skipped"))
    )


def status_counts(work: DataFrame) -> DataFrame:
    return work.groupBy("status").agg(F.count(F.lit(1)).alias("directories"))


def publish(spark: SparkSession, tables: Mapping[str, str], target: str) -> None:
    """Copy finished tables to a target folder; all must exist before the first copy."""
    require_files(spark, list(tables.values()))
    for name, path in tables.items():
        spark.read.parquet(path).write.mode("overwrite").parquet(f"{target.rstrip('/')}/{name}")
