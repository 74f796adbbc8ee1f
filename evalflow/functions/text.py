"""Text normalization and prefix grouping."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that separate words, plus any Unicode white space.
_SEPARATORS = r"(?U)[-_/()%+,\s\x1c-\x1f]+"
_BLANKS = r"(?U)[\s\x1c-\x1f]+"


def is_missing(c: Column, *, floating: bool = False) -> Column:
    """Null or blank text; with ``floating`` also NaN."""
    blank = F.regexp_replace(c.cast("string"), _BLANKS, "") == ""
    missing = c.isNull() | blank
    return missing | F.isnan(c) if floating else missing


def normalize_text(c: Column, joiner: str = " ") -> Column:
    """Lower-case words joined by ``joiner``; null when nothing is left."""
    words = F.trim(F.regexp_replace(F.lower(c.cast("string")), _SEPARATORS, " "))
    if joiner != " ":
        words = F.replace(words, F.lit(" "), F.lit(joiner))
    return F.nullif(words, F.lit(""))


def _prefix_table(prefixes) -> list[tuple[str, str]]:
    """The rules as ``(prefix in lower case, group)``, after checking each."""
    rules = list((prefixes.items() if isinstance(prefixes, Mapping) else prefixes) or ())
    wrong_kind = next((r for r in rules if not isinstance(r, tuple) or [type(x) for x in r] != [str, str]), None)
    if wrong_kind is not None:
        raise TypeError(f"a rule is a pair of texts, not {wrong_kind!r}")
    table = [(start.strip().lower(), group) for start, group in rules]
    if any(start == "" for start, _ in table):
        raise ValueError("an empty prefix would match everything")
    return table


def group_by_prefix(
    c: Column, prefixes: Mapping[str, str] | Iterable[tuple[str, str]] | None
) -> Column:
    """Group of the longest matching prefix, else the value itself.

    Every rule that matches offers its length and its group; the longest offer wins, and of two
    rules with one prefix the one given first.
    """
    table = _prefix_table(prefixes)
    if not table:
        return c
    lowered = F.lower(c)
    offers = [
        F.when(lowered.startswith(start), F.struct(F.lit(len(start)).alias("size"), F.lit(-i).alias("turn"), F.lit(group).alias("group")))
        for i, (start, group) in enumerate(table)
    ]
    best = F.greatest(*offers) if len(offers) > 1 else offers[0]
    return F.coalesce(best["group"], c)
