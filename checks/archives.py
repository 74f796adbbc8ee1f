"""Question-answer instances with ``conversations`` as instance lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.dump import write_archives
from checks.shape import table
from evalflow.plans import qa
from evalflow.session import fresh_folder
from evalflow.sources.archives import list_archives, read_archive_lines

_FILE = ("task", "step")


def instance_lines(spark, folder):
    """One instance line per turn; every third has no answers, some use the later field name."""
    n = F.col("conv_id") * 7 + F.col("turn")
    answer = F.struct(
        F.lit(True).alias("is_greedy"),
        (n % 9).cast("int").alias("num_tokens"),
        ((n % 8) / 4).alias("sum_logits"),
    )
    answers = F.when(n % 3 != 0, F.array(answer, answer)).otherwise(F.array().cast(f"array<{_ANSWER}>"))
    record = F.struct(
        F.lit("m1").alias("model_hash"),
        F.concat(F.lit("t"), (F.col("conv_id") % 3).cast("string")).alias("task_hash"),
        F.col("conv_id").alias("doc_id"),
        F.col("turn").alias("native_id"),
        (n % 4).cast("int").alias("label"),
        F.struct((n % 2).alias("acc"), F.lit(99).alias("doc_id"), F.length("text").alias("chars")).alias("metrics"),
        F.col("text"),
        F.when(n % 2 == 0, answers).alias("answer_outputs"),
        F.when(n % 2 == 1, answers).alias("model_output"),
    )
    return table(spark, folder, "conversations").select(
        F.col("role").alias("task"),
        (F.col("conv_id") % 5).cast("int").alias("step"),
        (F.col("conv_id") * 100000 + F.col("turn")).alias("place"),
        F.to_json(record).alias("line"),
    )


_ANSWER = "struct<is_greedy:boolean,num_tokens:int,sum_logits:double>"


def qa_payloads(spark, folder):
    return qa.question_payloads(instance_lines(spark, folder), ["place"])


def qa_questions(spark, folder):
    """Typed questions; the answers shown by their count and their logit sum."""
    typed = qa.typed_questions(qa.question_payloads(instance_lines(spark, folder), ["place"]), ["place"])
    total = F.aggregate("model_output", F.lit(0.0), lambda s, a: s + a["sum_logits"])
    return typed.select(
        "place", "doc_id", "native_id", "label", F.size("model_output").alias("answers"), total.alias("logits")
    )


def qa_metadata(spark, folder):
    return qa.file_metadata(instance_lines(spark, folder), _FILE)


def qa_preview(spark, folder):
    rows = qa.metric_rows(instance_lines(spark, folder), ["acc", "chars"], ["place"])
    return rows.select("place", F.col("acc").cast("long").alias("acc"), F.col("chars").cast("long").alias("chars"), "doc_id")


def qa_metric_entries(spark, folder):
    return qa.metric_entries(instance_lines(spark, folder), ["place"])


def payload_keys(spark, folder):
    payloads = qa.question_payloads(instance_lines(spark, folder), [*_FILE, "place"])
    keys = qa.output_keys(payloads, "place", _FILE)
    return keys.select(*_FILE, F.array_join("output_keys", ",").alias("output_keys"))


def _archived(spark, folder, size=500):
    """Instance lines packed into archives of ``size`` conversations each."""
    root = fresh_folder(spark, "archives")
    part = F.floor(F.col("place") / 100000 / size).cast("string")
    rows = instance_lines(spark, folder).select(
        F.concat(F.lit("c4/4M/seed-2/part-"), part, F.lit(".tar.gz")).alias("archive"),
        F.concat(F.lit("x/step-"), F.col("step").cast("string"), F.lit("/"), "task", F.lit(".jsonl")).alias("member"),
        F.col("line"),
    )
    write_archives(rows, root)
    return root


def archive_lines(spark, folder):
    lines = read_archive_lines(spark, _archived(spark, folder))
    doc = F.get_json_object("line", "$.doc_id").cast("long").alias("doc_id")
    turn = F.get_json_object("line", "$.native_id").cast("long").alias("native_id")
    return lines.select("data", "params", "seed", "step", "task", doc, turn, F.length("line").cast("long").alias("chars"))


def archive_list(spark, folder):
    listed = list_archives(spark, _archived(spark, folder), "c4", "4M", 2)
    return listed.select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "data", "params", "seed")


_SRC = """
    src AS (
        SELECT role AS task, CAST(conv_id % 5 AS INTEGER) AS step, conv_id * 100000 + turn AS place,
            conv_id, turn, text, conv_id * 7 + turn AS n
        FROM conversations
    ), shaped AS (
        SELECT *, 'd' AS d, CASE WHEN n % 3 = 0 THEN '[]' ELSE
            '[' || one || ',' || one || ']' END AS answers
        FROM (SELECT *, '{"is_greedy":true,"num_tokens":' || (n % 9) || ',"sum_logits":'
            || CASE n % 8 WHEN 0 THEN '0' WHEN 4 THEN '1' ELSE CAST((n % 8) / 4 AS VARCHAR) END || '}' AS one FROM src)
    )
"""

QUERIES = {
    "qa_payloads": qa_payloads,
    "qa_questions": qa_questions,
    "qa_metadata": qa_metadata,
    "qa_preview": qa_preview,
    "qa_metric_entries": qa_metric_entries,
    "payload_keys": payload_keys,
    "archive_lines": archive_lines,
    "archive_list": archive_list,
}
SQL = {
    "qa_payloads": f"""
    WITH {_SRC}
    SELECT place, '{{"doc_id":' || conv_id || ',"label":' || (n % 4) || ',"model_output":' || answers
        || ',"native_id":' || turn || ',"text":' || CAST(to_json(text) AS VARCHAR) || '}}' AS payload
    FROM shaped
    """,
    "qa_questions": f"""
    WITH {_SRC}
    SELECT place, conv_id AS doc_id, turn AS native_id, CAST(n % 4 AS INTEGER) AS label,
        CASE WHEN n % 3 = 0 THEN 0 ELSE 2 END AS answers,
        CASE WHEN n % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE 2 * ((n % 8) / 4) END AS logits
    FROM src
    """,
    "qa_metadata": f"""
    WITH {_SRC} SELECT DISTINCT 't' || (conv_id % 3) AS task_hash, 'm1' AS model_hash, task, step FROM src
    """,
    "qa_preview": f"""
    WITH {_SRC} SELECT place, n % 2 AS acc, length(text) AS chars, conv_id AS doc_id FROM src
    """,
    "qa_metric_entries": f"""
    WITH {_SRC}
    SELECT place, conv_id AS doc_id, 'acc' AS metric, CAST(n % 2 AS VARCHAR) AS value FROM src
    UNION ALL SELECT place, conv_id, 'chars', CAST(length(text) AS VARCHAR) FROM src
    """,
    "payload_keys": f"""
    WITH {_SRC}
    SELECT DISTINCT task, step, 'is_greedy,num_tokens,sum_logits' AS output_keys FROM src WHERE n % 3 <> 0
    """,
    "archive_lines": f"""
    WITH {_SRC}
    SELECT 'c4' AS data, '4M' AS params, 2 AS seed, step, task, conv_id AS doc_id, turn AS native_id,
        length('{{"model_hash":"m1","task_hash":"t' || (conv_id % 3) || '","doc_id":' || conv_id || ',"native_id":'
            || turn || ',"label":' || (n % 4) || ',"metrics":{{"acc":' || (n % 2) || ',"doc_id":99,"chars":'
            || length(text) || '}},"text":' || CAST(to_json(text) AS VARCHAR) || ',"'
            || CASE WHEN n % 2 = 0 THEN 'answer_outputs' ELSE 'model_output' END || '":'
            || replace(replace(answers, '"sum_logits":0}}', '"sum_logits":0.0}}'), '"sum_logits":1}}', '"sum_logits":1.0}}')
            || '}}') AS chars
    FROM shaped
    """,
    "archive_list": """
    SELECT DISTINCT 'part-' || (conv_id // 500) || '.tar.gz' AS name, 'c4' AS data, '4M' AS params, 2 AS seed
    FROM conversations
    """,
}
