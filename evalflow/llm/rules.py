"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule is a condition over one text that rejects it. What a rule costs and how
many texts it rejects is estimated on a sample; the rules are then asked in the
order of rejections per cost, and a text that one rule rejects is not shown to the
later ones. The sample decides the order alone, never a verdict: a text is kept
when no rule rejects it, in whatever order they are asked.

Defined results: a null or empty text has no words and is rejected; equal rows get
equal verdicts, each its own row; an empty table gives an empty table; other columns
of the input are left alone (``filter_documents``) or ignored (``quality_counts``).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalflow.llm.common import SPACE, written

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

#: Rows of the sample on which cost and selectivity are estimated.
SAMPLE_ROWS = 1000

# Limits of the rules, each a whole number so that any engine decides alike.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 5
MAX_DUP_LINE_PERCENT = 30
MIN_DUP_LINES = 3  # fewer may be a title or a closing line
MAX_SHOUT_PERCENT = 30
MIN_LETTER_PERCENT = 50
MIN_MEAN_WORD, MAX_MEAN_WORD = 2, 25


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, SPACES, "")).cast("long")


def count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def word_lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.translate(line, SPACES, "") != "")


def dup_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def repeat_words(text_words: Column) -> Column:
    """Words that lie in a window of three words found at least twice in the text.

    Windows are compared by 64-bit hash. Texts without a repeated window, which the
    distinct count shows, stop there; otherwise windows are sorted with their
    places, and the places of repeated ones cover three words each, less overlap.
    """

    def hashes(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        )

    def places(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def equal(s: Column, i: Column) -> Column:
            return F.coalesce(F.get(s, i)["h"] == F.get(s, i + 1)["h"], F.lit(False))

        return bound(
            ordered,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(s, lambda x, i: equal(s, i - 1) | equal(s, i)),
                    lambda x: x["i"],
                )
            ),
        )

    def covered(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda x, i: F.coalesce(F.least(F.lit(3), F.get(p, i + 1) - x), F.lit(3))),
            F.lit(0),
            lambda total, x: total + x,
        )

    def counted(w: Column) -> Column:
        return bound(
            hashes(w),
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(bound(places(h), covered)),
        )

    return bound(text_words, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(counted(w))).cast("long")


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Column], Column]


def _percent(part: Column, whole: Column, limit: int) -> Column:
    return part * 100 > whole * limit


RULES = (
    Rule("few_words", lambda t: F.size(words(t)) < MIN_WORDS),
    Rule("repeats", lambda t: bound(words(t), lambda w: _percent(repeat_words(w), F.size(w), MAX_REPEAT_PERCENT))),
    Rule("symbols", lambda t: _percent(count_of(t, SYMBOLS), word_chars(t), MAX_SYMBOL_PERCENT)),
    Rule(
        "dup_lines",
        lambda t: bound(
            word_lines(t),
            lambda x: (dup_lines(x) >= MIN_DUP_LINES) & _percent(dup_lines(x), F.size(x), MAX_DUP_LINE_PERCENT),
        ),
    ),
    Rule("shouting", lambda t: _percent(count_of(t, "!"), F.size(words(t)), MAX_SHOUT_PERCENT)),
    Rule("letters", lambda t: F.length(F.regexp_replace(t, r"[^\p{L}]+", "")) * 100 < word_chars(t) * MIN_LETTER_PERCENT),
    Rule(
        "word_length",
        lambda t: bound(
            F.size(words(t)),
            lambda n: (word_chars(t) < n * MIN_MEAN_WORD) | (word_chars(t) > n * MAX_MEAN_WORD),
        ),
    ),
)

#: The two rules that every caller of the contract agrees on.
BASE = ("few_words", "repeats")


@dataclass(frozen=True)
class Estimate:
    name: str
    seconds: float
    rejected: int


def estimates(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Seconds and rejections of each rule over the first rows of the table, ``rows`` at most.

    The rows are taken partition by partition until there are enough, and kept as a file.
    """
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    sample = written(docs.sparkSession.createDataFrame(texts.take(rows), "text string").coalesce(1), "sample")
    found = []
    for rule in rules:
        began = time.perf_counter()
        hit = sample.select(F.sum(rule.rejects(F.col("text")).cast("int"))).first()[0]
        found.append(Estimate(rule.name, time.perf_counter() - began, hit or 0))
    return found


def cascade_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """The rules by rejections per second, the best first."""
    by_name = {e.name: e for e in estimates(docs, rules, rows)}
    gain = {n: (e.rejected + 0.5) / max(e.seconds, 1e-4) for n, e in by_name.items()}
    return tuple(sorted(rules, key=lambda r: -gain[r.name]))


def verdict(text: Column, rules: tuple[Rule, ...]) -> Column:
    """False at the first rule that rejects; later rules are then not evaluated."""
    branch = F
    for rule in rules:
        branch = branch.when(F.coalesce(rule.rejects(text), F.lit(False)), F.lit(False))
    return branch.otherwise(F.lit(True))


def filter_documents(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, all columns as they are."""
    order = cascade_order(docs, RULES, rows)
    return docs.filter(verdict(F.coalesce(docs["text"], F.lit("")), order))


def quality_counts(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts of every document, and whether the cascade keeps it.

    The rules that the counts decide are read off them; the others run in the
    cascade's order, and only for documents that have not failed yet.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rest = tuple(r for r in cascade_order(docs, RULES, rows) if r.name not in (*BASE, "symbols"))
    parts = docs.select("doc_id", text.alias("text")).select(
        "doc_id",
        "text",
        bound(
            words(F.col("text")),
            lambda w: F.struct(F.size(w).cast("long").alias("n"), repeat_words(w).alias("repeats")),
        ).alias("w"),
    )
    counts = parts.select(
        "doc_id",
        "text",
        F.col("w.n").alias("n_words"),
        word_chars(F.col("text")).alias("word_chars"),
        count_of(F.col("text"), SYMBOLS).alias("n_symbols"),
        dup_lines(word_lines(F.col("text"))).alias("n_dup_lines"),
        F.col("w.repeats").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | _percent(F.col("n_repeat_words"), F.col("n_words"), MAX_REPEAT_PERCENT)
    symbols = _percent(F.col("n_symbols"), F.col("word_chars"), MAX_SYMBOL_PERCENT)
    return counts.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        F.when(failed | symbols, F.lit(False)).otherwise(verdict(F.col("text"), rest)).alias("kept"),
    )


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document of the table."""
    return quality_counts(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"

SQL = {
    "op10_quality_rules": f"""
WITH d AS (
  SELECT doc_id, t, {_WORDS} AS w,
         [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
win AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS k
  FROM (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d))),
cover AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM win WHERE k >= 2) GROUP BY doc_id),
counts AS (
  SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(cover.n, 0) AS n_repeat_words,
         length(t) - length(replace(t, '!', '')) AS shouts,
         length(regexp_replace(t, '[^\\p{{L}}]', '', 'g')) AS letters
  FROM d LEFT JOIN cover ON d.doc_id = cover.doc_id),
base AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 5 * word_chars OR (n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines)
            OR 100 * shouts > 30 * n_words OR 100 * letters < 50 * word_chars
            OR word_chars < 2 * n_words OR word_chars > 25 * n_words) AS kept
FROM base""",
}
QUERIES = {"op10_quality_rules": op10_quality_rules}
