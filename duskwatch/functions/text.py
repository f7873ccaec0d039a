"""Small text helpers built from Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strip(text: Column) -> Column:
    """Drop leading and trailing whitespace of every kind (``trim`` only drops blanks)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def filled(text: Column) -> Column:
    """True when the text is neither NULL nor empty."""
    return F.coalesce(text != "", F.lit(False))


def null_if_empty(text: Column) -> Column:
    return F.when(text != "", text)


def message(template: str, *args: Column) -> Column:
    """Fill ``%s`` places of a template from columns."""
    return F.format_string(template, *[a.cast("string") for a in args])


def strip_fences(text: Column) -> Column:
    """Remove every Markdown code fence marker, then surrounding whitespace."""
    return strip(F.regexp_replace(text, r"```(?:json)?", ""))


def outer_fences(text: Column) -> Column:
    """Remove one opening and one closing fence at the ends of the text only."""
    opened = F.regexp_replace(strip(text), r"^```(?:json)?", "")
    return strip(F.regexp_replace(opened, r"```$", ""))


def given(*texts: Column) -> Column:
    """Array of the texts that are not NULL, in order (texts are never empty).

    Not a filter with a lambda: those evaluate their whole input without
    generated code.
    """
    return F.array_remove(F.array(*[F.coalesce(t, F.lit("")) for t in texts]), "")


# The default layout of JSON writers cuts instants to milliseconds.
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def json_text(column: Column | str) -> Column:
    """JSON of a struct or map, with explicit nulls and microsecond instants."""
    return F.to_json(column, {"ignoreNullFields": "false", "timestampFormat": JSON_TIME})
