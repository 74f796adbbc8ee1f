"""JSON text: canonical form, configuration keys, Python dict literals."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def canonical_json(c: Column) -> Column:
    """JSON text with keys sorted at every level and numbers by value.

    Null when the text is no JSON, so bad rows can go to quarantine.
    """
    return F.to_json(F.try_parse_json(c))


def config_key(c: Column, *, ignore: tuple[str, ...] = ("task_name",), mode: str = "structural") -> Column:
    """Key under which two configurations count as the same.

    ``structural`` drops the ignored top-level fields and compares the rest by
    content; ``raw`` compares the stored text. Text that is no JSON object
    stands for itself in both modes, so only a null gives a null key.
    """
    if mode == "raw":
        return c
    if mode != "structural":
        raise ValueError(f"unknown key mode {mode!r}")
    fields = F.from_json(c, "map<string,variant>")
    kept = F.map_filter(fields, lambda name, _: ~name.isin(*ignore))
    return F.coalesce(canonical_json(F.to_json(kept)), canonical_json(c), c)


# A quoted text, or one of the words that JSON spells otherwise.
_QUOTED_OR_WORD = (
    r"""('[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+")|\b(None|True|False)\b"""
)
_WORDS = {"None": "null", "True": "true", "False": "false"}
# A flat dict of plain lower-case names and numbers or words, as metrics are written. The
# number of entries is bounded, as the matcher recurses over them.
_ENTRY = r"'[a-z0-9_]*+': (?:-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][-+]?[0-9]++)?+|None|True|False)"
_PLAIN_DICT = rf"^\{{(?:{_ENTRY}(?:, {_ENTRY}){{0,200}}+)?+\}}\z"


def is_plain_dict(c: Column) -> Column:
    """Whether a text is surely a readable dict literal; other texts may be readable too."""
    return c.rlike(_PLAIN_DICT)


def python_literal_to_json(c: Column) -> Column:
    """Dict literal as relaxed JSON: None, True and False outside quotes become JSON words.

    Read the result with ``allowSingleQuotes``. One pass marks the words, and passes over
    quoted texts whole; marks with nothing between them stood behind a quoted text. In a plain
    dict no quoted text holds one of the words, so they are replaced as they stand.
    """
    text, plain = F.regexp_replace(c, _QUOTED_OR_WORD, "$1\x01$2\x02"), c
    for word, spelled in {"": "", **_WORDS}.items():
        text = F.replace(text, F.lit(f"\x01{word}\x02"), F.lit(spelled))
        plain = F.replace(plain, F.lit(word), F.lit(spelled)) if word else plain
    return F.when(is_plain_dict(c), plain).otherwise(text)


def object_fields(c: Column) -> Column:
    """Top-level fields of a JSON object as ``map<string,string>``; null if bad.

    Scalars come as bare text, nested values as JSON text.
    """
    return F.from_json(c, "map<string,string>")


def register_sql(spark: SparkSession) -> None:
    """Make ``normalize_config(text)`` and ``canonical_json(text)`` known to SQL.

    They are SQL functions, so a query that calls them is planned like one that
    spells them out; no Python runs per row.
    """
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION canonical_json(c STRING) RETURNS STRING"
        " RETURN to_json(try_parse_json(c))"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION normalize_config(c STRING) RETURNS STRING RETURN coalesce("
        "to_json(try_parse_json(to_json(map_filter(from_json(c, 'map<string,variant>'),"
        " (k, v) -> k <> 'task_name')))), to_json(try_parse_json(c)), c)"
    )
