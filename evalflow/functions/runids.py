"""Run-id classification by the registered patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalflow import constants as C
from evalflow.functions.literals import literal_array
from evalflow.operators.columns import compute_once

# All patterns as one alternation. Each is anchored at both ends, so the first
# alternative that fits is the first pattern that matches.
_ANY_PATTERN = "|".join(regex for _, _, regex, _ in C.RUN_PATTERNS)
_FIELDS = C.RUN_METADATA[:-1]
_BREAK, _NEXT = "\u0001", "\u0002"


def _replacement() -> str:
    """Text that lists the value of each field, then marks the matched pattern.

    Groups of patterns that did not match are blank, so all groups of a field side
    by side are its value. The mark is a row of separators, one per pattern, with
    the matched pattern's first group, which is never blank, in its place.
    """
    groups = [name for _, _, _, names in C.RUN_PATTERNS for name in names]
    values = ["".join(f"${i + 1}" for i, g in enumerate(groups) if g == field) for field in _FIELDS]
    firsts, seen = [], 1
    for _, _, _, names in C.RUN_PATTERNS:
        firsts.append(f"${seen}")
        seen += len(names)
    return _BREAK.join([*values, _NEXT.join(firsts)])


def pattern_parts(run_id: Column) -> Column:
    """Field values and the pattern mark from one regex pass; a single part if none matches."""
    return F.split(F.regexp_replace(run_id, _ANY_PATTERN, _replacement()), _BREAK)


def pattern_place(parts: Column) -> Column:
    """Place of the matched pattern, null when none matched."""
    mark = F.get(parts, F.lit(len(_FIELDS)))
    before = F.length(mark) - F.length(F.ltrim(mark, F.lit(_NEXT)))
    return F.when(F.size(parts) == len(_FIELDS) + 1, before)


def legacy_type(run_id: Column) -> Column:
    """``old`` for default runs of the first naming scheme, else ``other``."""
    old = (
        F.contains(run_id, F.lit("main_default"))
        & ~F.contains(run_id, F.lit("dpo"))
        & ~F.contains(run_id, F.lit("--reduce_loss="))
    )
    return F.when(old, F.lit("old")).otherwise(F.lit("other"))


def _by_pattern(place: Column, values: list) -> Column:
    return F.get(literal_array(values), place)


def classify_runs(df: DataFrame, run_id_col: str = "run_id") -> DataFrame:
    """Add ``run_type`` and the metadata columns; every row gets one type.

    Row-local: one regex pass per id, whatever is filtered or selected later.
    """
    if run_id_col not in df.columns:
        raise KeyError(f"Column '{run_id_col}' not found in DataFrame")
    run_id = F.col(run_id_col)
    named = df.withColumn(run_id_col, F.coalesce(run_id.cast("string"), F.lit("None")))
    parted = compute_once(named, {"_parts": pattern_parts(run_id)})
    placed = compute_once(parted, {"_place": pattern_place(F.col("_parts"))})
    place = F.col("_place")
    types = [run_type for _, run_type, _, _ in C.RUN_PATTERNS]
    names = [name for name, _, _, _ in C.RUN_PATTERNS]
    columns = {"run_type": F.coalesce(_by_pattern(place, types), legacy_type(run_id))}
    for i, field in enumerate(_FIELDS):
        columns[field] = F.when(place.isNotNull(), F.nullif(F.col("_parts")[i], F.lit("")))
    columns["pattern_name"] = _by_pattern(place, names)
    return placed.withColumns(columns).drop("_place", "_parts")
