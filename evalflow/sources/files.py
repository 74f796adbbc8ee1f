"""File discovery and path tables."""

from __future__ import annotations

import re
from collections.abc import Sequence
from pathlib import PurePath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evalflow import constants as C
from evalflow.functions.paths import base_name, parent_dir
from evalflow.operators.columns import compute_once

Roots = str | PurePath | Sequence[str | PurePath]


def root_list(roots: Roots) -> list[str]:
    """One or several roots as text, without a slash at the end."""
    several = roots if isinstance(roots, (list, tuple)) else [roots]
    odd = [r for r in several if not isinstance(r, (str, PurePath))]
    if odd:
        raise ValueError(f"not a path: {odd[0]!r}")
    return [str(r).rstrip("/") or "/" for r in several]


def _status(spark: SparkSession, path: str):
    """Hadoop file status of each match of a path or glob; None when absent."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if any(ch in path for ch in "*?[{"):
        return fs.globStatus(jvm_path)
    return [fs.getFileStatus(jvm_path)] if fs.exists(jvm_path) else None


def check_roots(spark: SparkSession, roots: Roots) -> list[str]:
    """Roots as text, after looking that each is a folder or matches one."""
    listed = root_list(roots)
    kinds = {root: [s.isDirectory() for s in _status(spark, root) or ()] for root in listed}
    if absent := [root for root, matches in kinds.items() if not matches]:
        raise FileNotFoundError(f"nothing at {', '.join(absent)}")
    if plain := [root for root, matches in kinds.items() if not any(matches)]:
        raise NotADirectoryError(f"a file, not a folder: {', '.join(plain)}")
    return listed


def folders(spark: SparkSession, roots: Roots) -> list[str]:
    """The folders that the roots are or, as globs, match."""
    matches = [s for root in check_roots(spark, roots) for s in _status(spark, root) if s.isDirectory()]
    return sorted({re.sub(r"^file:/+", "/", s.getPath().toString()) for s in matches})


def require_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    missing = [p for p in paths if not _status(spark, p)]
    if missing:
        raise FileNotFoundError(f"Files not found: {missing}")
    return list(paths)


def plain_path(c: Column) -> Column:
    """Path without the local scheme."""
    return F.regexp_replace(c, r"^file:/+", "/")


def decoded_path(c: Column) -> Column:
    """The same of a path that its reader gives with URL escapes, as file metadata does."""
    # "+" is no escape in a path, so it is kept from the form decoder
    return plain_path(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))))


def discover(spark: SparkSession, roots: Roots, glob: str) -> DataFrame:
    """Files below the roots at any depth: ``(path, length, modified)``.

    Only file status is read. Directories whose names start with ``_`` or ``.``
    are visited only when they are a root themselves, or match a glob root.
    """
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(check_roots(spark, roots))
    )
    return found.select(
        plain_path(F.col("path")).alias("path"), "length", F.col("modificationTime").alias("modified")
    )


def _ancestors(path: Column) -> Column:
    """All directories above a path, nearest last."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(2), F.greatest(F.size(parts) - 1, F.lit(2))),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"),
    )


def results_dirs(results: DataFrame) -> DataFrame:
    """Directories that hold a results file, from a path table."""
    return results.select(parent_dir(F.col("path")).alias("results_dir")).distinct()


def artifact_role(path: Column, artifacts: Sequence[str] = C.DOC_ARTIFACTS) -> Column:
    role = F.lit(None).cast("string")
    for artifact in artifacts:
        suffix = f"-{artifact}.{C.ARTIFACT_EXTENSIONS[artifact]}"
        role = F.when(path.endswith(suffix), F.lit(artifact)).otherwise(role)
    return role


def manifest(
    spark: SparkSession,
    roots: Roots,
    *,
    artifacts: Sequence[str] = C.DOC_ARTIFACTS,
    results_file: str = C.RESULTS_FILE,
    lengths: bool = False,
) -> DataFrame:
    """``(results_dir, artifact, path)`` of every results directory, with ``length`` if asked.

    The tree is listed once. A file belongs to every results directory above it, so a
    nested directory's files show up under its parent too. Paths meet directories by
    equality on each ancestor; no pair of unrelated path and directory is ever formed.
    """
    columns = ["results_dir", "artifact", "path", *(["length"] if lengths else [])]
    found = discover(spark, roots, f"{{{results_file},*.json,*.jsonl}}")
    results = found.where(base_name(F.col("path")) == results_file)
    files = found.withColumn("artifact", artifact_role(F.col("path"), artifacts)).where(F.col("artifact").isNotNull())
    claimed = files.withColumn("results_dir", F.explode(_ancestors(F.col("path")))).join(
        results_dirs(results), "results_dir"
    )
    own = results.withColumns({"results_dir": parent_dir(F.col("path")), "artifact": F.lit("metrics-all")})
    return own.select(*columns).unionByName(claimed.select(*columns))


def topmost(folders: Sequence[str]) -> list[str]:
    """The folders that lie in none of the others."""
    kept: list[str] = []
    for folder in sorted(set(folders), key=lambda f: f.rstrip("/") + "/"):
        if not kept or not f"{folder}/".startswith(f"{kept[-1].rstrip('/')}/"):
            kept.append(folder)
    return kept


def artifact_index(paths: DataFrame, artifacts: Sequence[str] = C.DOC_ARTIFACTS) -> DataFrame:
    """One row per directory and task stem with a path column per artifact.

    Only files that lie directly in the directory and start with ``task-`` count.
    """
    path = F.col("path")
    parts = {
        "result_dir": parent_dir(path),
        "artifact": artifact_role(path, artifacts),
        "stem": F.regexp_replace(base_name(path), r"-(" + "|".join(artifacts) + r")\.[^.]*$", ""),
    }
    tagged = compute_once(paths, parts, keep=["path"]).where(
        F.col("artifact").isNotNull() & F.col("stem").startswith("task-")
    )
    return tagged.groupBy("result_dir", "stem").agg(
        *[F.max(F.when(F.col("artifact") == a, path)).alias(a) for a in artifacts]
    )
