"""Evaluation directories: one wide row per document and request, then one per configuration.

All directories are one plan. ``dirs`` names the columns that tell directories
apart (``results_dir`` for real dumps); every join carries them, since file
prefixes repeat between directories.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalflow import constants as C
from evalflow import schemas
from evalflow.functions.jsontext import config_key
from evalflow.functions.paths import artifact_prefix, result_slug, task_name_from_prefix
from evalflow.operators import columns as ops
from evalflow.operators import evolve
from evalflow.operators.dedupe import first_per_key
from evalflow.operators.joins import key_sets, left_join
from evalflow.operators.skew import SPLIT_ROWS, hot_keys, salted_left_join
from evalflow.sinks import snapshots
from evalflow.sinks.tables import cut_lineage, plan_work, write_table
from evalflow.sources import files, records

DIRS = ("results_dir",)


def task_names(
    preds: DataFrame, recs: DataFrame, reqs: DataFrame, dirs: Sequence[str] = DIRS
) -> DataFrame:
    """Task name of every file prefix: the largest recorded one, else from the prefix.

    One pass over the union of all three inputs gives the prefixes and their names
    together, so nothing is joined back. The distinct hashes rows away in each
    task; the maximum then sees a few rows per prefix.
    """
    keys = [*dirs, "file_prefix"]
    named = [f.select(*keys, "task_name") for f in (recs, reqs)]
    rows = preds.select(*keys, F.lit(None).cast("string").alias("task_name"))
    for frame in named:
        rows = rows.unionByName(frame)
    largest = rows.distinct().groupBy(*keys).agg(F.max("task_name").alias("task_name"))
    return largest.withColumn(
        "task_name", F.coalesce("task_name", task_name_from_prefix(F.col("file_prefix")))
    )


def metrics_by_prefix(metrics: DataFrame, names: DataFrame, dirs: Sequence[str] = DIRS) -> DataFrame:
    """Metrics rows of every file prefix of their task.

    Aggregate tasks have no files and drop out; a task with several prefixes
    repeats under each.
    """
    if "task_name" not in metrics.columns:
        return names.select(*dirs, "file_prefix").limit(0)
    return metrics.join(names, [*dirs, "task_name"])


def export_documents(
    preds: DataFrame,
    recs: DataFrame,
    reqs: DataFrame,
    metrics: DataFrame,
    *,
    dirs: Sequence[str] = DIRS,
    doc_id: int | str | None = None,
    prefixes: Mapping[str, str] = C.EXPORT_PREFIXES,
    config: DataFrame | None = None,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Document spine with everything known about each document and request.

    ``metrics`` rows carry a task name and are matched to file prefixes here.
    A ``doc_id`` filters the spine only; Spark carries it into the other sides.
    Metrics join the narrow spine first, so that the wide rows are not shuffled by
    file. Each artifact is joined once. Documents with more than ``split_rows`` rows of an
    artifact are found first, by a job over the keys, and their rows dealt over many tasks.
    """
    file_key = [*dirs, "file_prefix"]
    doc_key = [*file_key, "doc_id"]
    spine_key = [*doc_key, "idx"]
    if "idx" not in reqs.columns:
        reqs = reqs.withColumn("idx", F.lit(None).cast("long"))
    no_idx = F.lit(None).cast("long").alias("idx")

    spine = key_sets(
        [preds.select(*doc_key, no_idx), recs.select(*doc_key, no_idx), reqs.select(*spine_key)], spine_key
    )
    if doc_id is not None:
        spine = spine.where(F.col("doc_id") == F.lit(doc_id).cast(spine.schema["doc_id"].dataType))
    met = metrics_by_prefix(metrics, task_names(preds, recs, reqs, dirs), dirs)

    def side(frame: DataFrame, artifact: str, keys: Sequence[str]) -> DataFrame:
        skip = {*dirs, "path", *ops.EXPORT_SKIP[artifact]}
        return frame.select(*keys, *ops.prefixed(frame, prefixes[artifact], skip))

    met_side = side(met, "metrics", file_key)
    out = left_join(spine, met_side, file_key)
    artifacts = {"preds": preds, "recs": recs, "reqs": reqs}
    found = hot_keys(artifacts, doc_key, split_rows)
    hot = {tuple(r[k] for k in doc_key): (r["rows_preds"], r["rows_recs"], r["rows_reqs"]) for r in found}
    # rows of a key on the left: its spine, then times what was joined to it
    to_preds = [(k, q + 1, p) for k, (p, _, q) in hot.items()]
    to_recs = [(k, (q + 1) * max(1, p), r) for k, (p, r, q) in hot.items()]
    out = salted_left_join(out, side(preds, "predictions", doc_key), doc_key, to_preds, split_rows=split_rows)
    out = salted_left_join(out, side(recs, "recorded-inputs", doc_key), doc_key, to_recs, split_rows=split_rows)
    wide = {k: max(1, p) * max(1, r) for k, (p, r, _) in hot.items()}
    # a request key is hot only in a document that is hot
    requests = hot_keys({"reqs": reqs}, spine_key, split_rows) if any(q for _, _, q in hot.values()) else []
    to_reqs = [(tuple(r[k] for k in spine_key), wide.get(tuple(r[k] for k in doc_key), 1), r["rows_reqs"]) for r in requests]
    out = salted_left_join(
        out, side(reqs, "requests", spine_key), spine_key, to_reqs, null_safe=["idx"], split_rows=split_rows
    )
    if config is not None:
        out = left_join(out, side(config, "config", file_key), file_key)
    met_columns = [c for c in met_side.columns if c not in file_key]
    first = [c for c in out.columns if c not in met_columns]
    return out.select(*first, *met_columns)


def dedupe_configurations(
    exported: DataFrame,
    *,
    config: str = "met_task_config",
    key_mode: str = "structural",
    drop: Sequence[str] | None = None,
    extend: bool = False,
    ties: Sequence[str] = ("doc_id", "idx"),
) -> DataFrame:
    """One row per task configuration, then distinct rows without source columns.

    Rows without a configuration all stay. Ties in ``file_prefix`` are settled
    by the listed columns that exist and at last by the content of the row.
    """
    if not ops.drop_source_columns(exported, drop, extend=extend).columns:
        raise ValueError(ops.NOTHING_KEPT)
    if config not in exported.columns:
        return ops.drop_source_columns(exported, drop, extend=extend).distinct()
    # a null configuration gives a null key, so those rows need no key at all
    with_config, without = (exported.where(F.col(config).isNotNull()), exported.where(F.col(config).isNull()))
    fields = [F.col(f"`{c}`") for c in sorted(exported.columns)]
    content = F.xxhash64(*fields, *[c.isNull() for c in fields])  # a hash alone skips nulls
    keyed = ops.compute_once(with_config, {"_key": config_key(F.col(config), mode=key_mode), "_row": content})
    order = [c for c in ("file_prefix", *ties) if c in exported.columns]
    first = first_per_key(keyed, "_key", [*order, "_row"]).drop("_key", "_row")
    return ops.drop_source_columns(without.unionByName(first), drop, extend=extend).distinct()


def dedupe_exports(spark: SparkSession, folder: str, out: str, **options) -> DataFrame:
    """De-duplicate an export, or any folder of exported Parquet files, into a table outside of it."""
    if f"{out.rstrip('/')}/".startswith(f"{folder.rstrip('/')}/"):
        raise ValueError("the output must lie outside the folder that is read")
    files.check_roots(spark, folder)
    if snapshots.current(spark, folder).entries:
        exported = snapshots.read(spark, folder, "data").drop("slug")
    else:
        exported = spark.read.option("mergeSchema", "true").parquet(folder).drop("slug", "version")
    write_table(dedupe_configurations(exported, **options), out)
    return spark.read.parquet(out)


#: Where the fields found so far are kept between commits.
_FIELDS = "fields of {}"


class _Landing:
    """Artifacts of the directories to do, read once into Parquet.

    Directories whose files were not read to the end, or whose reading ended in an error, are
    set aside with the reason; the others go on.
    """

    def __init__(self, spark: SparkSession, work: str, todo: DataFrame):
        self.spark, self.work, self.todo = spark, work, todo
        self.rows: dict[str, DataFrame] = {}
        self.failures: list[DataFrame] = []

    def land(self, name: str) -> None:
        role, glob = ("metrics-all", C.RESULTS_FILE) if name == "metrics" else (name, f"*-{name}.{C.ARTIFACT_EXTENSIONS[name]}")
        claimed = self.todo.where(F.col("artifact") == role)
        done = self._read(name, glob, claimed, 1, 0)
        rows = done[0] if done else self._rows(name, glob, claimed.limit(0))
        for more in done[1:]:
            rows = rows.unionByName(more)
        self.rows[name] = rows
        unread = records.unread_files(claimed, rows)
        if self.failures:
            unread = unread.join(self._failed_dirs(), "results_dir", "left_anti")
        reason = F.format_string("%d of %d bytes were read", "read", "length")
        self.failures.append(unread.select("results_dir", "path", reason.alias("reason"), F.lit(role).alias("artifact")))

    def _rows(self, name: str, glob: str, claimed: DataFrame) -> DataFrame:
        rows = records.landed_lines(records.read_claimed(self.spark, claimed, glob), schemas.ARTIFACTS[name])
        return rows if name == "metrics" else rows.withColumn("file_prefix", artifact_prefix(F.col("path"), name))

    def _read(self, name: str, glob: str, claimed: DataFrame, modulus: int, part: int) -> list[DataFrame]:
        """Land the files; after an error each half of their directories, down to single ones."""
        mine = claimed.where(F.pmod(F.xxhash64("results_dir"), F.lit(modulus)) == part)
        try:
            return [cut_lineage(self.spark, self._rows(name, glob, mine), f"{self.work}/rows/{name}/{modulus}-{part}")]
        except PySparkException as error:
            folders = mine.select("results_dir").distinct().take(2)
            if not folders:
                raise
            if len(folders) == 2 and modulus < 1 << 40:
                return [f for half in (part, part + modulus) for f in self._read(name, glob, claimed, 2 * modulus, half)]
            reason = str(error).strip().split("\n")[0][:500]
            failed = mine.select("results_dir", "path", F.lit(reason).alias("reason"), "artifact")
            self.failures.append(failed)
            return []

    def _failed_dirs(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [f.select("results_dir") for f in self.failures]).distinct()

    def finish(self) -> DataFrame:
        """``(results_dir, path, reason, artifact)`` of all that could not be read; their directories' rows leave."""
        failures = cut_lineage(self.spark, reduce(DataFrame.unionByName, self.failures), f"{self.work}/failures")
        if failures.take(1):
            failed = failures.select("results_dir").distinct()
            self.rows = {name: rows.join(failed, "results_dir", "left_anti") for name, rows in self.rows.items()}
        return failures


def run_export(
    spark: SparkSession,
    roots: files.Roots,
    out: str,
    work: str,
    *,
    wanted_dirs: Sequence[str] | None = None,
    force: bool = False,
    doc_id: int | str | None = None,
    slug_prefix: str = "",
    promote: bool = True,
    listing: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Export every results directory below the roots as one table, a commit per run.

    ``work`` is a shared folder for landed artifacts. The tree is listed once, into the
    manifest, and only directories still to do are read. JSON is parsed once, into Parquet,
    and each later step reads only the columns it needs from there. Each line belongs to
    every directory that claims its file. Directories that are already finished are skipped
    unless ``force``. Two directories with one slug are an error.

    A bad line, or one with a value that does not fit its type, goes to the quarantine table
    and stops nothing; neither does a file that cannot be read to its end: it is named in the
    quarantine, its directory is ``failed`` in ``status``, keeps what it had in ``out`` and is
    tried again by the next run.

    Fields that no schema declares stay as JSON text in ``<prefix>_undeclared_fields``, and
    unless ``promote`` is off get typed columns too. The fields found are kept with the commit:
    later runs add to them and widen their types, and the table reads in the newest schema.

    ``listing`` is a manifest made before, with lengths, in place of listing the tree now.
    ``out`` is read with :func:`exported`; what a commit holds appears at once
    (:mod:`evalflow.sinks.snapshots`).
    """
    listed = files.check_roots(spark, roots)
    before = snapshots.current(spark, out)
    found = files.manifest(spark, roots, lengths=True) if listing is None else listing
    if wanted_dirs is not None:
        found = found.where(F.col("results_dir").isin([d.rstrip("/") for d in wanted_dirs]))
    found = found.withColumn(
        "slug", result_slug(F.col("results_dir"), listed, prefix=slug_prefix, doc_id=doc_id)
    ).withColumn("doc_id_filter", F.lit(doc_id).cast("string"))
    found = cut_lineage(spark, found, f"{work}/manifest")
    if not found.take(1):
        raise FileNotFoundError(f"no results directory below {roots}")
    shared = found.groupBy("slug").agg(F.min("results_dir").alias("a"), F.max("results_dir").alias("b"))
    if clash := shared.where("a <> b").take(1):
        raise ValueError(f"one slug for two directories: {clash[0].asDict()}")
    finished = snapshots.parts(spark, out, at=before).select("slug")
    planned = cut_lineage(spark, plan_work(found, finished, force=force), f"{work}/planned")
    todo = found.join(planned.where("status = 'processed'").select("slug"), "slug", "left_semi")

    landing = _Landing(spark, work, todo)
    for name in (*C.DOC_ARTIFACTS, "metrics"):
        landing.land(name)
    failures = landing.finish()
    failed = failures.select("results_dir").distinct()
    broken = todo.join(failed, "results_dir", "left_semi").select("slug").distinct()
    status = planned.join(broken.withColumn("_broken", F.lit(True)), "slug", "left").select(
        "slug", F.when(F.col("_broken"), F.lit("failed")).otherwise(F.col("status")).alias("status")
    )
    status = cut_lineage(spark, status, f"{work}/status")
    aside = [records.quarantined(rows).withColumn("artifact", F.lit(name)) for name, rows in landing.rows.items()]
    aside.append(
        failures.select("path", F.lit(None).cast("string").alias("line"), "reason", F.current_timestamp().alias("at"), "artifact").distinct()
    )

    good = {name: records.good_rows(rows).drop("bytes") for name, rows in landing.rows.items()}
    notes = {}
    for name, rows in good.items() if promote else ():
        known = schemas.from_json_text(before.notes.get(_FIELDS.format(name), T.StructType([]).json()))
        fields = schemas.merged_schema(known, evolve.found_schema(rows, records.UNDECLARED))
        notes[_FIELDS.format(name)] = fields.json()
        good[name] = evolve.promoted(rows, records.UNDECLARED, fields)
    wide = export_documents(*[good[a] for a in (*C.DOC_ARTIFACTS, "metrics")], doc_id=doc_id)
    done = todo.join(broken, "slug", "left_anti")
    slugs = done.select("results_dir", "slug").distinct()
    if status.where("status = 'processed'").take(1):
        snapshots.commit(
            spark,
            out,
            {
                "data": left_join(wide, slugs, ["results_dir"]),
                "manifest": done.select("slug", "results_dir", "artifact", "path", "doc_id_filter"),
            },
            slugs,
            notes=notes,
            before=before,
        )
    tables = exported(spark, out) if snapshots.current(spark, out).entries else {}
    return {**tables, "status": status, "quarantine": ops.union_by_name(*aside)}


def exported(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """``data`` and ``manifest`` of an export as of its last commit."""
    at = snapshots.current(spark, out)
    return {name: snapshots.read(spark, out, name, at=at) for name in ("data", "manifest")}
