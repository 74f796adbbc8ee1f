"""Experiment runs: classify, hydrate from config and summary, normalize."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from evalflow import constants as C
from evalflow.functions.jsontext import object_fields
from evalflow.functions.labels import NO_LABEL, canonical_labels
from evalflow.functions.lookups import restore_recipe
from evalflow.functions.numbers import CONVERTERS, to_number
from evalflow.functions.runids import classify_runs
from evalflow.functions.text import normalize_text
from evalflow.operators import columns as ops
from evalflow.operators.joins import UPDATE_RULES, left_join
from evalflow.operators.ordering import sorted_nulls_as_blank
from evalflow.sinks.tables import write_table

Classifier = Callable[[DataFrame, str], DataFrame]

RUN_COLUMNS = ("run_id", "run_type", *C.RUN_METADATA)


def classified(
    runs: DataFrame,
    run_id_col: str = "run_id",
    *,
    drop_types: Iterable[str] | None = ("old",),
    classifier: Classifier = classify_runs,
) -> DataFrame:
    """Runs with type and metadata, without the dropped types."""
    out = classifier(runs, run_id_col)
    drop = list(drop_types or [])
    return out.where(~F.col("run_type").isin(drop)) if drop else out


def classification_log(
    runs: DataFrame, run_id_col: str = "run_id", *, classifier: Classifier = classify_runs
) -> DataFrame:
    return classifier(runs, run_id_col).select(
        F.col(run_id_col).alias("run_id"), "run_type", F.col("pattern_name").alias("pattern")
    )


def run_type_counts(runs: DataFrame) -> DataFrame:
    return runs.groupBy("run_type", "pattern_name").agg(F.count(F.lit(1)).alias("runs"))


def _kinds() -> list[tuple[str, str | None]]:
    """Every type with the patterns that lead to it; the last two follow none."""
    return [*dict.fromkeys((kind, name) for name, kind, _, _ in C.RUN_PATTERNS), ("old", None), ("other", None)]


def observed_counts(runs: DataFrame, kinds: Iterable[tuple[str, str | None]] | None = None) -> tuple[DataFrame, Observation]:
    """Classified runs whose rows are counted by type and pattern as they go to wherever they go.

    No pass of its own: the counts are there when the rows have been written, see
    :func:`counts_from`. ``kinds`` are the pairs of a classifier of one's own.
    """
    seen = Observation()
    pairs = list(kinds or _kinds())
    counts = [
        F.count_if((F.col("run_type") == kind) & F.col("pattern_name").eqNullSafe(F.lit(name))).alias(f"k{i}")
        for i, (kind, name) in enumerate(pairs)
    ]
    seen.pairs = pairs
    return runs.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def counts_from(spark: SparkSession, seen: Observation) -> DataFrame:
    """The rows of :func:`run_type_counts`, from what a write observed; rows of other kinds are an error."""
    got = seen.get
    rows = [(kind, name, got[f"k{i}"]) for i, (kind, name) in enumerate(seen.pairs) if got[f"k{i}"]]
    if sum(r[2] for r in rows) != got["rows"]:
        raise ValueError(f"{got['rows']} rows, of which {sum(r[2] for r in rows)} are of a known kind")
    return spark.createDataFrame(rows, "run_type string, pattern_name string, runs long")


def write_classified(
    runs: DataFrame, out: str, run_id_col: str = "run_id", *, classifier: Classifier = classify_runs, kinds=None
) -> DataFrame:
    """Classified runs written by type, and their counts, from one pass over the runs."""
    rows, seen = observed_counts(classifier(runs, run_id_col), kinds)
    write_table(rows, out, partition_by=("run_type",))
    return counts_from(runs.sparkSession, seen)


def type_columns(run_type: str) -> list[str]:
    """Metadata columns the patterns of one run type can fill."""
    fields = {f for _, kind, _, names in C.RUN_PATTERNS if kind == run_type for f in names}
    return ["run_id", *[c for c in C.RUN_METADATA[:-1] if c in fields], "pattern_name"]


def by_run_type(runs: DataFrame, run_types: Iterable[str]) -> dict[str, DataFrame]:
    """One frame per type, ``run_id`` first, in pattern and id order."""
    return {
        kind: sorted_nulls_as_blank(
            runs.where(F.col("run_type") == kind).select(*type_columns(kind)), ["pattern_name", "run_id"]
        )
        for kind in run_types
    }


def hydrate(
    runs: DataFrame,
    payloads: DataFrame | None = None,
    *,
    summary_fields: Mapping[str, str] = C.RUN_SUMMARY_FIELDS,
    config_fields: Mapping[str, str] = C.RUN_CONFIG_FIELDS,
    check: bool = True,
) -> DataFrame:
    """Fill run columns from the ``summary`` (wins) and ``config`` (fills gaps) JSON.

    With ``payloads`` the two documents are joined by ``run_id``; without, they
    are columns of ``runs`` and nothing is shuffled. A run that finds no payload, or more than
    one, fails the job unless ``check`` is off; the join itself counts them.
    """
    if payloads is not None:
        documents = payloads.select("run_id", *[c for c in ("summary", "config") if c in payloads.columns])
        if check:
            documents = documents.withColumn("_payloads", F.count(F.lit(1)).over(Window.partitionBy("run_id")))
        runs = left_join(runs.drop("summary", "config"), documents, ["run_id"])
        if check:
            found = F.coalesce("_payloads", F.lit(0)).cast("string")
            message = F.concat(F.lit("a run needs one payload, found "), found, F.lit(" for "), F.col("run_id"))
            one = F.when(F.col("_payloads") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
            runs = runs.where(one).drop("_payloads")
    for source, fields, rule in (
        ("summary", summary_fields, "overwrite"),
        ("config", config_fields, "fill_missing"),
    ):
        if not fields or source not in runs.columns:
            continue
        runs = runs.withColumn("_fields", object_fields(F.col(source)))
        merge = UPDATE_RULES[rule]
        merged = {
            target: merge(
                F.col(target) if target in runs.columns else F.lit(None).cast("string"),
                F.col("_fields")[field],
            )
            for target, field in fields.items()
        }
        runs = runs.withColumns(merged).drop("_fields")
    return runs.drop("summary", "config")


def fill_defaults(runs: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Defaults for the columns a run's type has: those of its patterns and hydrated ones."""
    if "run_type" not in runs.columns:
        return ops.fill_missing(runs, defaults)
    hydrated = {*C.RUN_CONFIG_FIELDS, *C.RUN_SUMMARY_FIELDS}
    filled = {}
    for name, default in defaults.items():
        if name not in runs.columns:
            continue
        value = F.coalesce(F.col(name), F.lit(default).cast(runs.schema[name].dataType))
        if name not in hydrated:
            types = {kind for _, kind, _, names in C.RUN_PATTERNS if name in names}
            value = F.when(F.col("run_type").isin(sorted(types)), value).otherwise(F.col(name))
        filled[name] = value
    return runs.withColumns(filled)


def token_defaults(df: DataFrame) -> DataFrame:
    """Token columns of full fine-tuning runs (``_Ft_`` in the id) are fixed."""
    if "run_id" not in df.columns:
        return df
    total = C.FULL_FT_EPOCHS * C.FULL_FT_TOKENS
    return ops.assign_where(
        df,
        F.contains(F.col("run_id"), F.lit("_Ft_")),
        {
            "num_finetune_tokens_per_epoch": C.FULL_FT_TOKENS,
            "num_finetune_epochs": C.FULL_FT_EPOCHS,
            "num_finetune_tokens": total,
            "num_finetuned_tokens_real": total,
        },
    )


def token_totals(df: DataFrame) -> DataFrame:
    """Totals from tokens per epoch and epochs, where no total is known."""
    per_epoch, epochs, total = (
        "num_finetune_tokens_per_epoch",
        "num_finetune_epochs",
        "num_finetune_tokens",
    )
    if not {per_epoch, epochs} <= set(df.columns):
        return df
    df = ops.ensure_column(df, total)
    df = df.withColumns({c: to_number(F.col(c)) for c in (per_epoch, epochs, total)})
    return df.withColumn(total, F.coalesce(F.col(total), F.col(per_epoch) * F.col(epochs)))


def matched_labels(df: DataFrame) -> DataFrame:
    """Canonical comparison metric of matched runs; others keep theirs.

    A missing metric counts as the label of no label, which is then
    canonicalized like any other.
    """
    df = ops.ensure_column(df, "comparison_metric")
    old = F.col("comparison_metric")
    matched = F.col("run_type") == "matched" if "run_type" in df.columns else F.lit(True)
    raw = df.withColumn("_raw", F.when(matched, F.coalesce(old, F.lit(NO_LABEL))))
    label = F.when(matched, F.col("_label")).otherwise(old)
    return (
        canonical_labels(raw, "_raw", "_label")
        .withColumn("comparison_metric", label)
        .drop("_raw", "_label")
    )


Hook = Callable[[DataFrame], DataFrame]

# Hooks that look at the run type themselves and so need no rows set aside.
RUN_HOOKS: dict[str, Hook] = {"matched": matched_labels}


def apply_hooks(runs: DataFrame, hooks: Mapping[str, Hook]) -> DataFrame:
    """Each hook over the rows of its run type only; other rows pass by."""
    for kind, hook in hooks.items():
        if RUN_HOOKS.get(kind) is hook or "run_type" not in runs.columns:
            runs = hook(runs)
            continue
        own = F.col("run_type").eqNullSafe(kind)
        runs = runs.where(~own).unionByName(hook(runs.where(own)), allowMissingColumns=True)
    return runs


def normalize(
    runs: DataFrame,
    *,
    defaults: Mapping[str, object] | None = None,
    renames: Mapping[str, str] | None = None,
    converters: Mapping[str, str] = C.RUN_CONVERTERS,
    registry: Mapping[str, Callable[[Column], Column]] = CONVERTERS,
    recipe_mode: str = "noop",
    hooks: Mapping[str, Hook] = RUN_HOOKS,
) -> DataFrame:
    """Defaults, recipes, renames, converters, token defaults, totals, hooks.

    The order is part of the result: renames come before converters, fixed token
    counts overwrite hydrated ones. ``recipe_mode="original"`` turns normalized
    recipes back into display names; the default leaves them.
    """
    known = {k: v for k, v in (defaults or {}).items() if k in C.RUN_DEFAULTS}
    out = fill_defaults(runs, {**C.RUN_DEFAULTS, **known})
    if recipe_mode == "original":
        for name in C.RUN_RECIPE_COLUMNS:
            out = ops.apply_if_column(out, name, restore_recipe)
    elif recipe_mode != "noop":
        raise ValueError(f"unknown recipe mode {recipe_mode!r}")
    out = ops.rename_present(out, {**C.RUN_COLUMN_RENAMES, **(renames or {})})
    out = ops.apply_converters(out, converters, registry)
    out = token_totals(token_defaults(out))
    return apply_hooks(out, hooks)


def process_runs(
    runs: DataFrame,
    payloads: DataFrame | None = None,
    *,
    drop_types: Iterable[str] | None = ("old",),
    defaults: Mapping[str, object] | None = None,
    column_map: Mapping[str, str] | None = None,
    config_fields: Mapping[str, str] | None = None,
    summary_fields: Mapping[str, str] | None = None,
    recipe_mode: str = "noop",
    check: bool = True,
    classifier: Classifier = classify_runs,
    hooks: Mapping[str, Hook] | None = None,
) -> DataFrame:
    """Classify, hydrate and normalize all run types in one frame.

    Caller maps, hooks by run type among them, are merged over the built-in ones, key by key.
    """
    typed = classified(runs, drop_types=drop_types, classifier=classifier)
    full = hydrate(
        typed,
        payloads,
        summary_fields={**C.RUN_SUMMARY_FIELDS, **(summary_fields or {})},
        config_fields={**C.RUN_CONFIG_FIELDS, **(config_fields or {})},
        check=check,
    )
    return normalize(
        full, defaults=defaults, renames=column_map, recipe_mode=recipe_mode, hooks={**RUN_HOOKS, **(hooks or {})}
    )


def since(runs: DataFrame, column: str, earliest: str) -> DataFrame:
    """Rows at or after a date; unreadable dates are dropped."""
    return runs.where(F.try_to_timestamp(F.col(column).cast("string")) >= F.lit(earliest).cast("timestamp"))


def with_plain_ids(runs: DataFrame) -> DataFrame:
    return runs.withColumn("rid2", normalize_text(F.col("run_id")))
