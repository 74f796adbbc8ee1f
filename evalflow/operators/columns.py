"""Column shaping: renames, defaults, prefixes, serialization, drops."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalflow import constants as C
from evalflow.functions.lookups import lookup
from evalflow.functions.numbers import CONVERTERS


def compute_once(df: DataFrame, columns: Mapping[str, Column], keep: Iterable[str] | None = None) -> DataFrame:
    """Add costly columns that later filters and projections only refer to.

    Spark moves a filter below the projection that makes its column, and then
    computes the column once for the filter and once more for the rows that pass.
    It does not do so past a one-element ``inline``, which costs next to nothing.
    """
    kept = df.columns if keep is None else list(keep)
    kept = [F.col(f"`{c}`") for c in kept if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def safe_name(name: str) -> str:
    """Word characters joined by single underscores; ``col`` when none is left."""
    return re.sub(r"[\W_]+", "_", name).strip("_") or "col"


def safe_name_column(c: Column) -> Column:
    """:func:`safe_name` for names held in a column."""
    return F.coalesce(
        F.nullif(F.btrim(F.regexp_replace(c, r"(?U)[\W_]+", "_"), F.lit("_")), F.lit("")), F.lit("col")
    )


def safe_names(names: Iterable[str]) -> dict[str, str]:
    """Old name -> safe name; names that would collide get ``_2``, ``_3``, ..."""
    taken: set[str] = set()
    renames = {}
    for name in names:
        base = safe = safe_name(name)
        n = 1
        while safe in taken:
            n += 1
            safe = f"{base}_{n}"
        taken.add(safe)
        renames[name] = safe
    return renames


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*safe_names(df.columns).values())


_NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def as_text(c: Column, dtype: T.DataType) -> Column:
    """Nested values as JSON text, everything else as plain text."""
    if isinstance(dtype, _NESTED):
        return F.to_json(c)
    return c.cast("string")


def prefixed(df: DataFrame, prefix: str, skip: Iterable[str] = (), *, serialize: bool = True) -> list[Column]:
    """Each column but the skipped ones as ``<prefix>_<safe name>``.

    Structs, lists, maps and variants become JSON text unless ``serialize`` is off; other
    types stay.
    """
    left_out = frozenset(skip)
    types = {f.name: f.dataType for f in df.schema.fields if f.name not in left_out}
    head = f"{prefix.rstrip('_')}_"

    def shown(name: str) -> Column:
        c = F.col(f"`{name}`")
        return as_text(c, types[name]) if serialize and isinstance(types[name], _NESTED) else c

    return [shown(name).alias(head + safe) for name, safe in safe_names(types).items()]


def add_prefix(df: DataFrame, prefix: str, skip: Iterable[str] = ("file_prefix", "doc_id")) -> DataFrame:
    skip = set(skip)
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in skip})


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text, so tables of different dumps always merge."""
    return df.select([as_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def rename_present(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(renames))


def ensure_column(df: DataFrame, name: str, default: object = None, dtype: str = "string") -> DataFrame:
    """Add a missing column; fill its nulls when it exists and a default is given."""
    if name not in df.columns:
        value = F.lit(default)
        return df.withColumn(name, value.cast(dtype) if default is None else value)
    if default is None:
        return df
    return fill_missing(df, {name: default})


def fill_missing(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill nulls (and NaN) of the columns that exist."""
    types = dict(df.dtypes)
    filled = {}
    for name, default in defaults.items():
        if name not in types:
            continue
        c = F.col(name)
        if types[name] in ("double", "float"):
            c = F.nanvl(c, F.lit(None).cast(types[name]))
        filled[name] = F.coalesce(c, F.lit(default).cast(types[name]))
    return df.withColumns(filled) if filled else df


def apply_if_column(df: DataFrame, name: str, change: Callable[[Column], Column]) -> DataFrame:
    return df.withColumn(name, change(F.col(name))) if name in df.columns else df


def apply_converters(
    df: DataFrame,
    converters: Mapping[str, str | Callable[[Column], Column]],
    registry: Mapping[str, Callable[[Column], Column]] = CONVERTERS,
) -> DataFrame:
    """Convert the columns that exist; converters are registry names or functions."""
    present = {
        name: (conv if callable(conv) else registry[conv])(F.col(name))
        for name, conv in converters.items()
        if name in df.columns
    }
    return df.withColumns(present) if present else df


def map_column(df: DataFrame, name: str, mapping: Mapping[str, object]) -> DataFrame:
    return apply_if_column(df, name, lambda c: lookup(c, mapping))


def assign_where(df: DataFrame, mask: Column, values: Mapping[str, object]) -> DataFrame:
    """Set columns where the mask holds, creating them when absent."""
    types = dict(df.dtypes)
    mask = F.coalesce(mask, F.lit(False))
    columns = {}
    for name, value in values.items():
        if name in types:
            columns[name] = F.when(mask, F.lit(value).cast(types[name])).otherwise(F.col(name))
        else:
            columns[name] = F.when(mask, F.lit(value))
    return df.withColumns(columns)


def first_where(value: Column, mask: Column, order: Column) -> Column:
    """Aggregate: value of the first row, by ``order``, where the mask holds."""
    return F.min_by(value, F.when(mask, order))


NOTHING_KEPT = "every column names a source, so nothing would be left to compare"
_SOURCE_NAMES = ("file_prefix", "task_name")
_SOURCE_ENDINGS = ("_path", "_dir")


def drop_source_columns(
    df: DataFrame, drop: Iterable[str] | None = None, *, extend: bool = False
) -> DataFrame:
    """Without the columns that say where a row came from.

    Those are the usual names, or the names in ``drop`` instead (with ``extend`` as well),
    and whatever ends like a path or a folder.
    """
    names = [*(drop or ()), *(_SOURCE_NAMES if extend or not drop else ())]
    content = [c for c in df.columns if not c.endswith(_SOURCE_ENDINGS) and c not in names]
    if not content:
        raise ValueError(NOTHING_KEPT)
    return df.select(*[F.col(f"`{c}`") for c in content])


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; columns a frame lacks are null."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


EXPORT_SKIP = {
    artifact: ("file_prefix", "doc_id", "idx")
    if artifact in C.DOC_ARTIFACTS
    else ("file_prefix", "doc_id")
    for artifact in C.EXPORT_PREFIXES
}
