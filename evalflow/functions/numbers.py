"""Numbers and time stamps read from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(c: Column) -> Column:
    """Double, or null when the text is no number."""
    return c.try_cast("double")


def parse_size(c: Column, *, strict: bool = False) -> Column:
    """``10M`` / ``1b`` / ``2.5K`` as a double; a K, M, B or T suffix is required.

    Anything else is null, or an error of the whole query when ``strict``.
    """
    text = F.upper(F.trim(c.cast("string")))
    unit = (
        F.when(text.endswith("T"), F.lit(1e12))
        .when(text.endswith("B"), F.lit(1e9))
        .when(text.endswith("M"), F.lit(1e6))
        .when(text.endswith("K"), F.lit(1e3))
    )
    size = F.left(text, F.length(text) - 1).try_cast("double") * unit
    if not strict:
        return size
    message = F.concat(F.lit("Invalid size string: "), F.coalesce(c.cast("string"), F.lit("null")))
    return F.when(size.isNotNull(), size).otherwise(F.raise_error(message).cast("double"))


def token_count(c: Column) -> Column:
    """Token counts such as ``10M``, ``5B``, ``3G``, ``500Mt`` or plain digits.

    The converter this stands for is configured but was never defined; the rule
    here is ours: M is 1e6, B and G are 1e9, a trailing ``t`` is ignored.
    """
    text = F.trim(c.cast("string"))
    body = F.rtrim(text, F.lit("t"))
    scale = F.when(body.endswith("M"), F.lit(1e6)).when(body.rlike("[BG]$"), F.lit(1e9))
    scaled = F.left(body, F.length(body) - 1).try_cast("double") * scale
    counted = text.rlike(r"^\d+[MBG]?t?$")
    return F.when(counted, F.when(scale.isNull(), body.try_cast("double")).otherwise(scaled)).otherwise(
        text.try_cast("double")
    )


def parse_timestamp(c: Column) -> Column:
    """``2025_08_21-08_24_43`` or ``250821-082443``; null when neither fits.

    Two-digit years from 69 on belong to the 1900s. Text of another form is not
    handed to the parser, whose failures are slow.
    """
    text = c.cast("string")
    century = F.when(F.left(text, F.lit(2)) >= "69", F.lit("19")).otherwise(F.lit("20"))
    digits = F.when(
        text.rlike(r"^\d{4}_\d{2}_\d{2}-\d{2}_\d{2}_\d{2}$"), F.replace(text, F.lit("_"), F.lit(""))
    ).when(text.rlike(r"^\d{6}-\d{6}$"), F.concat(century, text))
    return F.try_to_timestamp(digits, F.lit("yyyyMMdd-HHmmss"))


CONVERTERS = {
    "timestamp.v1": parse_timestamp,
    "tokens_to_number.v1": token_count,
    "number": to_number,
}
