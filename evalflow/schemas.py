"""Declared schemas, so no result depends on what a sample of the data holds."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalflow import constants as C


_TYPES = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "variant": T.VariantType(),
}


def _struct(text: str) -> T.StructType:
    """Struct from ``"name type, name type"``, usable before a session exists."""
    pairs = [field.split() for field in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Eval-directory artifacts. Free-form values stay VARIANT until they are written.
METRICS_ALL = _struct(
    "task_name string, task_hash string, model_hash string, model_config variant,"
    " task_config variant, compute_config variant, processing_time double,"
    " current_date string, num_instances bigint, beaker_info variant, metrics variant,"
    " task_idx int"
)
PREDICTIONS = _struct(
    "doc_id string, native_id variant, metrics variant, model_output variant,"
    " label variant, task_hash string, model_hash string"
)
RECORDED_INPUTS = _struct(
    "doc variant, task_name string, doc_id string, native_id variant, label variant,"
    " requests variant"
)
REQUESTS = _struct(
    "request_type string, doc variant, request variant, idx bigint, task_name string,"
    " doc_id string, native_id variant, label variant"
)
ARTIFACTS = {
    "predictions": PREDICTIONS,
    "recorded-inputs": RECORDED_INPUTS,
    "requests": REQUESTS,
    "metrics": METRICS_ALL,
}

# Question-answer instances.
ANSWER = _struct(
    "is_greedy boolean, logits_per_byte double, logits_per_char double,"
    " logits_per_token double, num_chars int, num_tokens int, num_tokens_all int,"
    " sum_logits double, sum_logits_uncond double"
)
QUESTION = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("native_id", T.LongType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("model_output", T.ArrayType(ANSWER)),
    ]
)
# Train results: every metric is a number; integer indexes read as doubles too.
TRAIN_METRICS = T.StructType(
    [T.StructField(m, T.DoubleType()) for m in [*C.TRAIN_METRIC_RENAMES, *C.TRAIN_METRICS_DROPPED]]
)
TRAIN_INPUT = _struct(
    "params string, data string, task string, step bigint, seed string, chinchilla string,"
    " tokens double, compute double, metrics string"
)
RUNS = _struct("run_id string, config string, summary string, created_at string")
QUARANTINE = _struct("path string, line string, reason string, at timestamp")


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Typed frame without rows; joins and unions with it keep every column."""
    return spark.createDataFrame([], schema)


# Schemas that grow: a field may be added, and its type may become wider, never narrower.

_NUMBERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType())


def widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both; text when nothing else does."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _NUMBERS and b in _NUMBERS:
        return _NUMBERS[max(_NUMBERS.index(a), _NUMBERS.index(b))]
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged_schema(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widened(a.elementType, b.elementType))
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """Fields of both, the old ones first; names that differ in case alone are one field."""
    fields = {f.name.lower(): f for f in old.fields}
    for f in new.fields:
        known = fields.get(f.name.lower())
        kind = f.dataType if known is None else widened(known.dataType, f.dataType)
        fields[f.name.lower()] = T.StructField(f.name if known is None else known.name, kind)
    return T.StructType(list(fields.values()))


def from_json_text(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame with every field of the schema in its type, absent ones null; other columns stay."""
    names = {c.lower(): c for c in df.columns}
    held = {f.name: f.dataType for f in df.schema.fields}

    def value(f: T.StructField) -> Column:
        own = names.get(f.name.lower())
        if own is None:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c = F.col(f"`{own}`")
        if held[own] == f.dataType:
            return c.alias(f.name)
        nested = isinstance(held[own], (T.StructType, T.ArrayType, T.MapType, T.VariantType))
        return (F.to_json(c) if nested and f.dataType == T.StringType() else c.cast(f.dataType)).alias(f.name)

    wanted = {f.name.lower() for f in schema.fields}
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() not in wanted]
    return df.select(*[value(f) for f in schema.fields], *rest)
