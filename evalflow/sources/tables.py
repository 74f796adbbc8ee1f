"""Parquet, CSV and converted JSON tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalflow import constants as C
from evalflow.operators.columns import stringify, union_by_name
from evalflow.sources.files import check_roots, decoded_path, require_files


def read_shards(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All shards as one table; every shard must exist."""
    return spark.read.parquet(*require_files(spark, paths))


def with_source_order(df: DataFrame) -> DataFrame:
    """Add ``source_path`` and ``source_row``, the place of each Parquet row."""
    return df.select(
        "*",
        decoded_path(F.col("_metadata.file_path")).alias("source_path"),
        F.col("_metadata.row_index").alias("source_row"),
    )


def read_cached(spark: SparkSession, folder: str) -> DataFrame:
    """All Parquet files of a folder merged by column name."""
    check_roots(spark, folder)
    return spark.read.option("mergeSchema", "true").parquet(folder)


def read_tables(spark: SparkSession, paths: Sequence[str]) -> dict[str, DataFrame]:
    """One frame per file, keyed by file stem; every file must exist."""
    require_files(spark, paths)
    return {PurePosixPath(p).stem: spark.read.parquet(p) for p in paths}


def merge_as_text(frames: Sequence[DataFrame]) -> DataFrame:
    """Tables of different dumps by column name, all columns as text."""
    return union_by_name(*[stringify(f) for f in frames])


def read_csv_view(
    spark: SparkSession, path: str, view: str, schema: T.StructType | None = None
) -> DataFrame:
    """CSV with a header row; registers the view when it does not exist yet.

    Without a schema the types are inferred, which reads the file once more.
    """
    reader = spark.read.option("header", "true")
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", "true").csv(path)
    if not spark.catalog.tableExists(view):
        df.createOrReplaceTempView(view)
    return spark.table(view)


def write_json_rows(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").json(path)


def json_to_parquet(spark: SparkSession, source: str, target: str, schema: T.StructType | None = None) -> DataFrame:
    """Convert JSON lines once; a finished target is read as it is."""
    reader = spark.read.schema(schema) if schema else spark.read
    reader.json(source).write.mode("ignore").parquet(target)
    return spark.read.parquet(target)


def table_paths(folder: str) -> Mapping[str, str]:
    """Names and paths of all input and output tables below one folder."""
    names = [
        *C.TRAIN_SHARDS,
        C.SCALING_FIT_FILE,
        C.MACRO_AVG_FILE,
        C.TRAIN_TABLE,
        *C.SCALING_TABLES,
        *C.RUN_TABLES,
    ]
    return {PurePosixPath(n).stem: f"{folder.rstrip('/')}/{n}" for n in names}
