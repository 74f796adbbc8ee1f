"""JSON lines and whole JSON documents as typed rows, bad rows set aside."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalflow import schemas
from evalflow.functions.jsontext import canonical_json
from evalflow.functions.paths import artifact_prefix
from evalflow.operators.columns import compute_once
from evalflow.sources.files import Roots, check_roots, decoded_path, topmost


def read_lines(spark: SparkSession, roots: Roots, glob: str) -> DataFrame:
    """``(path, line)`` of all non-blank lines of the matching files."""
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .text(check_roots(spark, roots))
    )
    return lines.select(
        decoded_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("line")
    ).where(F.trim("line") != "")


def read_claimed(spark: SparkSession, claimed: DataFrame, glob: str) -> DataFrame:
    """``(results_dir, path, line, bytes)`` of every line of the files listed as ``(results_dir, path)``.

    Folders are read, not lists of files: the driver holds the topmost directories alone. A
    file is a row source of every directory that claims it. A file that is gone or breaks off
    yields the lines before that and no error; ``bytes``, the length of a line with its
    end, tells (:func:`unread_files`). Blank lines are kept for that count.
    """
    folders = topmost([row[0] for row in claimed.select("results_dir").distinct().toLocalIterator()])
    if not folders:
        return spark.createDataFrame([], "results_dir string, path string, line string, bytes long")
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("lineSep", "\n")
        .option("ignoreMissingFiles", "true")
        .option("ignoreCorruptFiles", "true")
        .text([re.sub(r"([\\*?\[\]{}])", r"\\\1", f) for f in folders])
    )
    lines = lines.select(
        decoded_path(F.col("_metadata.file_path")).alias("path"),
        F.regexp_replace("value", "\r$", "").alias("line"),
        (F.octet_length("value") + 1).cast("long").alias("bytes"),
    )
    return lines.join(claimed.select("results_dir", "path").distinct(), "path").select("results_dir", "path", "line", "bytes")


def unread_files(claimed: DataFrame, lines: DataFrame) -> DataFrame:
    """``(results_dir, path, length, read)`` of listed files that were not read to their end.

    ``claimed`` has the length each file was listed with. The last line may lack its end,
    and a byte order mark is no part of any line; a file that lost just two or three bytes
    passes for one with such a mark, and its last line is then no JSON.
    """
    seen = lines.groupBy("results_dir", "path").agg(F.sum("bytes").alias("read"))
    both = claimed.select("results_dir", "path", "length").join(seen, ["results_dir", "path"], "left")
    both = both.withColumn("read", F.coalesce("read", F.lit(0)))
    return both.where(~(F.col("read") - F.col("length")).isin(0, 1, -3, -2) | ((F.col("length") > 3) & (F.col("read") == 0)))


def read_documents(spark: SparkSession, roots: Roots, glob: str) -> DataFrame:
    """``(path, line)`` with each whole file as one text."""
    files = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("wholetext", "true")
        .text(check_roots(spark, roots))
    )
    return files.select(
        decoded_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("line")
    )


def parsed_lines(lines: DataFrame) -> DataFrame:
    """Lines with their JSON value ``v`` (null when the text is no JSON), parsed once."""
    return compute_once(lines, {"v": F.try_parse_json("line")})


def is_object(v: Column) -> Column:
    """True when a parsed value is a JSON object."""
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def bad_lines(lines: DataFrame) -> DataFrame:
    """Quarantine table ``(path, line, reason, at)`` of lines that are no JSON object."""
    reason = F.when(F.col("v").isNull(), F.lit("not JSON")).otherwise(F.lit("no object"))
    return parsed_lines(lines).where(~is_object(F.col("v"))).select(
        "path", "line", reason.alias("reason"), F.current_timestamp().alias("at")
    )


UNDECLARED = "undeclared_fields"
_MISFIT = "_misfit"


def landed_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """All columns of ``lines`` but the text, the declared fields, the rest, ``bad_line`` and ``reason``.

    Absent fields are null; fields beyond the schema stay together as JSON text in
    ``undeclared_fields``. A line that is no JSON object, or has a value that does not fit
    its declared type, keeps its text in ``bad_line``, so one pass over the text yields both
    rows and quarantine. The typed reader alone would also take a line with rubbish
    behind its object.
    """
    kept = [c for c in lines.columns if c != "line"]
    parsed = parsed_lines(lines)
    reason = F.when(F.col("v").isNull(), F.lit("not JSON")).when(~is_object(F.col("v")), F.lit("no object"))
    judged = compute_once(parsed, {"_reason": reason}, keep=[*kept, "line"])
    good = F.when(F.col("_reason").isNull(), F.col("line"))
    marked = T.StructType([*schema.fields, T.StructField(_MISFIT, T.StringType())])
    typed = F.from_json(good, marked, {"columnNameOfCorruptRecord": _MISFIT})
    others = F.map_filter(F.from_json("line", "map<string,variant>"), lambda name, _: ~name.isin(schema.fieldNames()))
    rows = compute_once(judged, {"_r": typed}, keep=[*kept, "line", "_reason"])
    reason = F.coalesce("_reason", F.when(F.col("_r")[_MISFIT].isNotNull(), F.lit("a value does not fit its type")))
    return rows.select(
        *kept,
        *[F.col("_r")[name].alias(name) for name in schema.fieldNames()],
        F.when(F.size(others) > 0, F.to_json(others)).alias(UNDECLARED),
        F.when(reason.isNotNull(), F.col("line")).alias("bad_line"),
        reason.alias("reason"),
    )


def good_rows(landed: DataFrame) -> DataFrame:
    return landed.where(F.col("reason").isNull()).drop("bad_line", "reason")


def quarantined(landed: DataFrame) -> DataFrame:
    """Lines set aside, blank ones left out."""
    return landed.where(F.col("reason").isNotNull() & (F.btrim("bad_line") != "")).select(
        "path", F.col("bad_line").alias("line"), "reason", F.current_timestamp().alias("at")
    )


def typed_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared fields of all good lines beside the other columns of ``lines``."""
    return good_rows(landed_lines(lines, schema))


def read_artifact(
    spark: SparkSession, roots: Roots, artifact: str, schema: T.StructType | None = None
) -> DataFrame:
    """Rows of all ``*-<artifact>.jsonl`` files with ``path`` and ``file_prefix``."""
    rows = typed_lines(
        read_lines(spark, roots, f"*-{artifact}.jsonl"), schema or schemas.ARTIFACTS[artifact]
    )
    return rows.withColumn("file_prefix", artifact_prefix(F.col("path"), artifact))


def read_json_artifact(
    spark: SparkSession, roots: Roots, artifact: str, schema: T.StructType | None = None
) -> DataFrame:
    """One row per ``*-<artifact>.json`` document; ``doc_id`` is a null text."""
    lines = read_documents(spark, roots, f"*-{artifact}.json")
    if schema is None and artifact not in schemas.ARTIFACTS:
        rows = parsed_lines(lines).where(is_object(F.col("v"))).select("path", F.col("v").alias(artifact))
    else:
        rows = typed_lines(lines, schema or schemas.ARTIFACTS[artifact])
    return rows.withColumns(
        {
            "file_prefix": artifact_prefix(F.col("path"), artifact),
            "doc_id": F.lit(None).cast("string"),
        }
    )


def canonical_lines(lines: DataFrame) -> DataFrame:
    """Every line, parsed once: ``(path, canon)`` of objects, ``line`` and ``reason`` of others."""
    texts = compute_once(lines, {"_canon": canonical_json(F.col("line"))}, keep=["path", "line"])
    good = F.startswith("_canon", F.lit("{"))
    reason = F.when(F.col("_canon").isNull(), F.lit("not JSON")).when(~good, F.lit("no object"))
    return texts.select("path", F.when(good, F.col("_canon")).alias("canon"), "line", reason.alias("reason"))


def canonical_records(lines: DataFrame) -> DataFrame:
    """``(path, canon)`` of the JSON objects, keys sorted at every level."""
    texts = compute_once(lines, {"canon": canonical_json(F.col("line"))}, keep=["path"])
    # a JSON text that starts with a brace is an object
    return texts.where(F.startswith("canon", F.lit("{")))


def field_names(df: DataFrame, column: str) -> DataFrame:
    """Distinct top-level keys over all JSON objects of a column, with row counts."""
    return (
        df.select(F.explode(F.json_object_keys(column)).alias("field"))
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def json_shape(df: DataFrame, column: str) -> DataFrame:
    """One row: the merged schema of all JSON values of a column."""
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("shape"))


def unknown_fields(df: DataFrame, column: str, known: Sequence[str]) -> DataFrame:
    """Keys the declared schema does not cover."""
    return field_names(df, column).where(~F.col("field").isin(list(known)))
