"""Small helpers that say the same thing in Spark and in SQL."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evalflow.functions.literals import literal_array, literal_list


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def pick(index: Column, options: Sequence[str]) -> Column:
    return F.get(literal_array(options), index.cast("int"))


def pick_sql(index: str, options: Sequence[str]) -> str:
    return f"list_extract([{', '.join(quoted(o) for o in options)}], CAST({index} AS INTEGER) + 1)"


def case_sql(value: str, mapping: dict, default: str) -> str:
    def lit(v):
        return quoted(v) if isinstance(v, str) else repr(v)

    whens = " ".join(f"WHEN {quoted(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {value} {whens} ELSE {default} END"


def fill_sql(template: str, values: dict[str, str], text: str = "VARCHAR") -> str:
    """``"{a}_x_{b}"`` as a SQL concatenation of expressions."""
    parts = [p for p in re.split(r"(\{\w+\})", template) if p]
    return "(" + " || ".join(
        f"CAST({values[p[1:-1]]} AS {text})" if re.fullmatch(r"\{\w+\}", p) else quoted(p) for p in parts
    ) + ")"


def choose_sql(index: str, options: Sequence[str]) -> str:
    """SQL that evaluates the option at a 0-based index."""
    return f"CASE {index} {' '.join(f'WHEN {i} THEN {o}' for i, o in enumerate(options))} END"


def pick_expr(index: str, options: Sequence[str]) -> str:
    """Spark SQL for the text at a 0-based index of a fixed list."""
    return f"array({literal_list(options)})[CAST({index} AS INT)]"
