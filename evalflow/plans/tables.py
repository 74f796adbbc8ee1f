"""Read, transform and write in one call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evalflow import constants as C
from evalflow.operators.ordering import leading_digits, pack_order
from evalflow.plans.scaling import parse_scaling_laws
from evalflow.plans.train import bad_metrics, sorted_train_results
from evalflow.sinks.tables import publish, write_table
from evalflow.sources.tables import read_shards, with_source_order

_FILE_DIGITS, _ROW_DIGITS = 9, 12
# A bucket holds up to a million rows of one file.
_BUCKET_DIGITS = 6


def parse_train(spark: SparkSession, shards: Sequence[str], out: str, *, target: str | None = None) -> DataFrame:
    """Shards to the sorted train table; rows with unreadable metrics beside it."""
    source = read_shards(spark, shards)
    write_table(sorted_train_results(source), f"{out}/{C.TRAIN_TABLE}")
    write_table(bad_metrics(source), f"{out}/train_quarantine.parquet")
    if target:
        publish(spark, {C.TRAIN_TABLE: f"{out}/{C.TRAIN_TABLE}"}, target)
    return spark.read.parquet(f"{out}/{C.TRAIN_TABLE}")


def with_ordinal(df: DataFrame) -> DataFrame:
    """Rows with ``source_ordinal``: number of their file in path order, and row in the file, packed.

    Only the files are numbered in one task, a row each; a fixed-width number lets
    last-write-wins aggregates hash instead of sort.
    """
    files = df.select("source_path").distinct()
    numbered = files.withColumn("_file", F.row_number().over(Window.orderBy("source_path")))
    ordinal = pack_order((F.col("_file"), _FILE_DIGITS), (F.col("source_row"), _ROW_DIGITS))
    return df.join(numbered, "source_path").withColumn("source_ordinal", ordinal).drop("_file")


def source_order() -> tuple[Column, Column]:
    """Row ordinal of :func:`with_ordinal`, and buckets of it for numbering."""
    digits = _FILE_DIGITS + _ROW_DIGITS
    return F.col("source_ordinal"), leading_digits(F.col("first_seen"), digits, digits - _BUCKET_DIGITS)


def parse_scaling(
    spark: SparkSession, folder: str, out: str, *, target: str | None = None
) -> dict[str, DataFrame]:
    """Fit and macro-average files of a folder to the four output tables."""
    fit, macro = (f"{folder.rstrip('/')}/{name}" for name in (C.SCALING_FIT_FILE, C.MACRO_AVG_FILE))
    fits = with_ordinal(with_source_order(read_shards(spark, [fit]))).drop("source_path", "source_row")
    order, bucket = source_order()
    tables = parse_scaling_laws(fits, read_shards(spark, [macro]), order, bucket)
    for name, table in tables.items():
        write_table(table, f"{out}/{name}")
    if target:
        publish(spark, {name: f"{out}/{name}" for name in tables}, target)
    return {name: spark.read.parquet(f"{out}/{name}") for name in tables}
