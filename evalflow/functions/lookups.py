"""Dictionary lookups and display orders as literals: no join, no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from evalflow import constants as C
from evalflow.functions.literals import literal_array, literal_map


def lookup(c: Column, mapping: Mapping[str, object], default: Column | None = None) -> Column:
    """Mapped value; without a match the default, or the value itself.

    For fixed tables of a few hundred entries; larger ones are joins.
    """
    if not mapping:
        return c if default is None else default
    return F.coalesce(literal_map(mapping)[c], c if default is None else default)


def normalize_recipe(c: Column) -> Column:
    return lookup(c, C.RECIPES)


def restore_recipe(c: Column) -> Column:
    """Display spelling of a normalized recipe."""
    return lookup(c, C.RECIPE_ORIGINALS)


def acc_baseline(task: Column) -> Column:
    return lookup(task, C.TASK_ACC_BASELINES, F.lit(C.DEFAULT_ACC_BASELINE))


def display_rank(c: Column, order: Sequence[str]) -> Column:
    """1-based place in a display order; null for unknown values."""
    place = F.array_position(literal_array(order), c)
    return F.nullif(place, F.lit(0).cast("long"))
