"""Expressions over text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what Python's float() accepts as a finite decimal, or by name.
PYTHON_FLOAT = (
    r"^\s*[+-]?((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?|(?i:inf|infinity|nan))\s*$"
)


def numeric_text(text: Column, numbers: str = "strict", python_numbers: bool = False) -> Column:
    """Text with thousands commas to double.

    ``strict`` raises on NULL, blank and garbage whatever the session's ANSI mode; ``lenient`` gives NULL.
    """
    plain = F.replace(text.cast("string"), F.lit(","), F.lit(""))
    if python_numbers:
        plain = F.when(plain.rlike(PYTHON_FLOAT), F.replace(plain, F.lit("_"), F.lit("")))
    value = plain.try_cast("double")
    if numbers == "lenient":
        return value
    if numbers != "strict":
        raise ValueError(f"numbers must be 'strict' or 'lenient', got {numbers!r}")
    shown = F.coalesce(text.cast("string"), F.lit("NULL"))
    failure = F.raise_error(F.concat(F.lit("not a number: "), shown)).cast("double")
    return F.coalesce(value, failure)


def cast_long(value: Column, numbers: str = "strict") -> Column:
    """To bigint; ``strict`` follows the session's ANSI mode, ``lenient`` gives NULL on bad text."""
    return value.try_cast("bigint") if numbers == "lenient" else value.cast("bigint")


def contains_marker(text: Column, marker: str, ignore_case: bool = False) -> Column:
    """Whether ``marker`` occurs in ``text`` (NULL for NULL)."""
    return F.lower(text).contains(marker.lower()) if ignore_case else text.contains(marker)
