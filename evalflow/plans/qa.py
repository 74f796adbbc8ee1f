"""Question-answer instances: payloads, file metadata, metric rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalflow import schemas
from evalflow.functions.jsontext import canonical_json

FILE_KEYS = ("data", "params", "seed", "task", "step")


def _field(name: str):
    return F.try_variant_get(F.try_parse_json("line"), f"$.{name}", "variant")


def question_payloads(lines: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``payload``: the record without metrics and hashes, answers as ``model_output``."""
    fields = F.from_json("line", "map<string,variant>")
    kept = F.map_filter(fields, lambda k, _: ~k.isin("metrics", "task_hash", "model_hash"))
    both = F.map_contains_key(kept, "answer_outputs")
    kept = F.when(both, F.map_filter(kept, lambda k, _: k != "model_output")).otherwise(kept)
    named = F.transform_keys(
        kept, lambda k, _: F.when(k == "answer_outputs", F.lit("model_output")).otherwise(k)
    )
    return lines.select(*keys, canonical_json(F.to_json(named)).alias("payload"))


def typed_questions(payloads: DataFrame, keys: Sequence[str] = (), *, strict: bool = False) -> DataFrame:
    """Payloads as declared types; ``strict`` makes a value that does not fit an error."""
    options = {"mode": "FAILFAST"} if strict else {}
    typed = F.from_json("payload", schemas.QUESTION, options)
    return payloads.select(*keys, typed.alias("_q")).select(*keys, "_q.*")


def task_outputs(lines: DataFrame) -> DataFrame:
    """One row per question with its file metadata, in the declared types.

    The nested form with all questions of a file in one array would put a whole
    file into one value, so questions stay rows.
    """
    keys = [*FILE_KEYS, "task_hash", "model_hash"]
    tagged = lines.withColumns(
        {
            "task_hash": F.try_variant_get(F.try_parse_json("line"), "$.task_hash", "string"),
            "model_hash": F.try_variant_get(F.try_parse_json("line"), "$.model_hash", "string"),
        }
    )
    return typed_questions(question_payloads(tagged, keys), keys)


def file_metadata(lines: DataFrame, keys: Sequence[str] = FILE_KEYS) -> DataFrame:
    """Distinct task and model hashes per file."""
    text = {n: F.try_variant_get(F.try_parse_json("line"), f"$.{n}", "string") for n in ("task_hash", "model_hash")}
    return lines.select(*[c.alias(n) for n, c in text.items()], *keys).distinct()


def metric_rows(lines: DataFrame, names: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """The named metrics as columns, and the record's own ``doc_id``."""
    metrics = F.from_json(F.to_json(_field("metrics")), "map<string,string>")
    doc_id = F.try_variant_get(F.try_parse_json("line"), "$.doc_id", "long")
    return lines.select(
        *keys, metrics.alias("_m"), doc_id.alias("doc_id")
    ).select(*keys, *[F.col("_m")[n].alias(n) for n in names if n != "doc_id"], "doc_id")


def metric_entries(lines: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Long form ``(doc_id, metric, value)`` of all metrics, whatever their names."""
    metrics = F.from_json(F.to_json(_field("metrics")), "map<string,string>")
    doc_id = F.try_variant_get(F.try_parse_json("line"), "$.doc_id", "long")
    return lines.select(
        *keys, doc_id.alias("doc_id"), F.explode(metrics).alias("metric", "value")
    ).where(F.col("metric") != "doc_id")


def output_keys(payloads: DataFrame, order: str, keys: Sequence[str] = ()) -> DataFrame:
    """Sorted fields of the first answer of the first payload that has answers."""
    first = F.to_json(F.try_variant_get(F.try_parse_json("payload"), "$.model_output[0]", "variant"))
    found = payloads.select(*keys, order, F.sort_array(F.json_object_keys(first)).alias("_keys"))
    return found.where(F.col("_keys").isNotNull()).groupBy(*keys).agg(
        F.min_by("_keys", order).alias("output_keys")
    )
