"""Metric labels such as ``mmlu_average_acc_raw`` split into task and metric."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalflow import constants as C
from evalflow.functions.literals import literal_list
from evalflow.functions.text import normalize_text


def _plain(name: str) -> str:
    return " ".join(name.lower().replace("-", " ").replace("_", " ").split())


TASKS = sorted({_plain(t) for group in C.CATALOG_TASKS.values() for t in group})
METRICS = sorted({_plain(m) for m in C.CATALOG_METRICS})
_LONGEST = max(len(task.split()) for task in TASKS)


def add_label_parts(df: DataFrame, label: str) -> DataFrame:
    """Add ``task``, ``metric`` and ``unmatched`` of a label column.

    The longest task whose words start the label wins; the remaining words are
    the metric when they equal one, else they are unmatched. The catalogue is
    fixed, so each leading run of words is tested against a literal set: no
    join, no shuffle. Steps are separate columns so the text is cleaned once.
    """
    words, rest = F.col("_words"), F.col("_rest")
    heads = [f"substring_index(_words, ' ', {n})" for n in range(_LONGEST, 0, -1)]
    task = ", ".join(f"CASE WHEN {h} IN ({literal_list(TASKS)}) THEN {h} END" for h in heads)
    known_metric = F.expr(f"_rest IN ({literal_list(METRICS)})")
    after_task = F.substring(words, F.length("task") + 2, F.length(words))
    return (
        df.withColumn("_words", normalize_text(F.col(label)))
        .withColumn("task", F.expr(f"coalesce({task})"))
        .withColumn(
            "_rest",
            F.when(F.col("task").isNull(), words).otherwise(F.nullif(after_task, F.lit(""))),
        )
        .withColumn("metric", F.when(F.col("task").isNotNull() & known_metric, rest))
        .withColumn("unmatched", F.when(F.col("metric").isNull(), rest))
        .drop("_words", "_rest")
    )


def canonical_labels(df: DataFrame, label: str, out: str | None = None, *, strict: bool = False) -> DataFrame:
    """Replace (or add as ``out``) a label by ``task metric [unmatched]``.

    A missing task or metric reads ``None``; with ``strict`` such a label, or
    one with unmatched words, is an error.
    """
    task, metric, unmatched = F.col("task"), F.col("metric"), F.col("unmatched")
    text = F.concat_ws(" ", F.coalesce(task, F.lit("None")), F.coalesce(metric, F.lit("None")), unmatched)
    if strict:
        shown = F.coalesce(F.col("_label").cast("string"), F.lit("null"))
        error = F.raise_error(F.concat(F.lit("Invalid metric label: "), shown)).cast("string")
        text = F.when(task.isNotNull() & metric.isNotNull() & unmatched.isNull(), text).otherwise(error)
    kept = [F.col(f"`{c}`") for c in df.columns if c != (out or label)]
    packed = df.select(F.struct(*kept).alias("_row") if kept else F.lit(0).alias("_row"), F.col(label).alias("_label"))
    parsed = add_label_parts(packed, "_label").select("_row", text.alias(out or label))
    return parsed.select("_row.*", out or label) if kept else parsed.drop("_row")


NO_LABEL = "None None"
