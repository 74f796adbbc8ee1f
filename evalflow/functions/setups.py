"""Parts of a scaling-law setup name such as ``5_param-helper_points-step2=0.5``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_one_step(setup: Column) -> Column:
    return F.contains(setup, F.lit("1_step"))


def fit_params(setup: Column) -> Column:
    return F.substring(setup, 1, 1)


def filtering(setup: Column) -> Column:
    return F.when(F.contains(setup, F.lit("step2=0.5")), F.lit("50_Percent")).otherwise(F.lit("None"))


def has_helper_point(setup: Column) -> Column:
    return F.contains(setup, F.lit("helper_points"))


def heldout(setup: Column) -> Column:
    """Model sizes held out of the fit, always starting with ``1B``."""
    parts = F.filter(F.split(setup, "-"), lambda part: F.contains(part, F.lit("no_")))
    names = F.flatten(F.transform(parts, lambda part: F.split(part, "no_")))
    names = F.filter(names, lambda name: name != "")
    return F.concat(
        F.array(F.lit("1B")),
        F.transform(names, lambda name: F.btrim(name, F.lit("_"))),
    )


def fit_config(setup: Column) -> Column:
    return F.struct(
        setup.alias("name"),
        is_one_step(setup).alias("one_step"),
        fit_params(setup).alias("params"),
        filtering(setup).alias("filtering"),
        has_helper_point(setup).alias("helper_point"),
        heldout(setup).alias("heldout"),
    )
