"""Fields that no schema declares, found in the data and turned into typed columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalflow.schemas import merged_schema

#: Fields that are given columns of their own; rarer ones stay in the JSON text alone.
MOST_FIELDS = 500

#: Types of JSON values as a parsed value names them.
_KINDS = {
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "FLOAT": T.DoubleType(),
    "DECIMAL": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "VOID": T.NullType(),
}


def _fields(text: Column) -> Column:
    return F.from_json(text, "map<string,variant>")


def found_schema(df: DataFrame, column: str, *, most: int = MOST_FIELDS) -> T.StructType:
    """Fields of the JSON objects of a column, each in the narrowest type that fits all its values.

    Whole numbers are ``bigint``, other numbers ``double``; text, lists, objects and mixed values
    are text. Only kinds of values come to the driver, of the ``most`` commonest names. Of names
    that differ in case alone the first in order is taken.
    """
    cells = df.where(F.col(column).isNotNull()).select(F.explode(_fields(F.col(column))).alias("name", "v"))
    kind = F.regexp_extract(F.schema_of_variant("v"), r"^\w+", 0)
    kinds = cells.groupBy("name").agg(F.count(F.lit(1)).alias("rows"), F.collect_set(kind).alias("kinds"))
    rows = kinds.orderBy(F.col("rows").desc(), "name").limit(most).collect()
    out, seen = T.StructType([]), set()
    for row in sorted(rows, key=lambda r: r["name"]):
        if row["name"].lower() in seen:
            continue
        seen.add(row["name"].lower())
        for name in row["kinds"]:
            out = merged_schema(out, T.StructType([T.StructField(row["name"], _KINDS.get(name, T.StringType()))]))
    return T.StructType([f for f in out.fields if not isinstance(f.dataType, T.NullType)])


def promoted(df: DataFrame, column: str, schema: T.StructType, taken: Iterable[str] = ()) -> DataFrame:
    """Add a typed column for each field of the schema; the JSON text stays as it is.

    Fields whose name is a column already stay in the text alone. A value that does not
    fit, which a schema found in the same rows rules out, is null.
    """
    names = {c.lower() for c in (*df.columns, *taken)}
    fields = [f for f in schema.fields if f.name.lower() not in names]
    if not fields:
        return df

    def typed(f: T.StructField) -> Column:
        v = F.col("_fields")[f.name]
        if not isinstance(f.dataType, T.StringType):
            return F.try_variant_get(v, "$", f.dataType.simpleString())
        plain = F.schema_of_variant(v) == "STRING"
        return F.when(plain, F.try_variant_get(v, "$", "string")).otherwise(F.to_json(v))

    opened = df.withColumn("_fields", _fields(F.col(column)))
    return opened.select(*[F.col(f"`{c}`") for c in df.columns], *[typed(f).alias(f.name) for f in fields])
