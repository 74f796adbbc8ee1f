"""Fixed tables as SQL literals: one expression however many entries."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(value: object) -> str:
    """SQL text of a constant."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"{value!r}D"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_list(values: Iterable[object]) -> str:
    return ", ".join(literal(v) for v in values)


def literal_array(values: Iterable[object]) -> Column:
    return F.expr(f"array({literal_list(values)})")


def literal_map(mapping: Mapping[object, object]) -> Column:
    pairs = ", ".join(f"{literal(k)}, {literal(v)}" for k, v in mapping.items())
    return F.expr(f"map({pairs})")
