"""Small text rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_text(value: Column) -> Column:
    """True where at least one character is not white space, Unicode spaces and separators counted."""
    return F.coalesce(value.rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(False))


def statements(script: Column) -> Column:
    """The non-blank statements of a ``;``-separated script, in order."""
    return F.filter(F.split(script, ";", -1), has_text)


def strip_newlines(value: Column) -> Column:
    return F.btrim(value, F.lit("\n"))


def drop_final_newline(value: Column) -> Column:
    """Remove exactly one newline from the end."""
    return F.regexp_replace(value, r"\n\z", "")


def lines(text: Column) -> Column:
    """The lines of a file; inner blank lines stay and an empty file has none."""
    return F.when(text != "", F.split(drop_final_newline(text), "\n", -1)).otherwise(
        F.array().cast("array<string>")
    )
