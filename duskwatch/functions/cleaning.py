"""Field cleaning rules as column expressions.

Each rule gives the cleaned value and a warning; the warning is NULL when there
is nothing to report.  All rules are total: bad input never fails a job.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, functions as F

from duskwatch.functions.text import filled, message, null_if_empty, strip

# Synonyms accepted on input.
SEVERITIES = {
    "info": "INFO",
    "low": "LOW",
    "medium": "MEDIUM",
    "med": "MEDIUM",
    "high": "HIGH",
    "critical": "CRITICAL",
    "crit": "CRITICAL",
}
ACTIONS = {
    "allow": "ALLOW",
    "permit": "ALLOW",
    "pass": "ALLOW",
    "block": "BLOCK",
    "deny": "BLOCK",
    "drop": "DROP",
    "alert": "ALERT",
    "monitor": "ALERT",
}

# Warning texts.
W_TIME_MISSING = "missing timestamp — using current UTC time"
W_TIME_NO_ZONE = "timestamp '%s' has no timezone — assuming UTC"
W_TIME_BAD = "unparseable timestamp '%s' — using current UTC time"
W_IP = "invalid IP in %s: '%s' — set to null"
W_DOMAIN = "invalid domain '%s' — set to null"
W_PORT = "invalid port %s — set to null"
W_SEVERITY_MISSING = "missing severity — defaulting to INFO"
W_SEVERITY_UNKNOWN = "unknown severity '%s' — defaulting to INFO"
W_ACTION_UNKNOWN = "unknown action '%s' — set to null"
W_TYPE_MISSING = "missing event_type — defaulting to UNKNOWN"

# Timestamp layouts tried after ISO 8601, in this order.
TIME_LAYOUTS = (
    "yyyy/MM/dd HH:mm:ss",
    "dd/MMM/yyyy:HH:mm:ss Z",
    "yyyyMMdd'T'HHmmss",
    "MMM dd yyyy HH:mm:ss",
    "MM/dd/yyyy HH:mm:ss",
)
# Layout families tried last, on the text without weekday and with single blanks: what a
# text of the family looks like, and its layouts.  Names are English, zones numeric.
TIME_FAMILIES = (
    (r"^\d{1,2} [A-Za-z]{3,}", ("d MMM yyyy HH:mm:ss[ Z]", "d MMMM yyyy HH:mm:ss[ Z]",
                                "d MMM yyyy h:mm:ss a", "d MMMM yyyy h:mm:ss a")),
    (r"^[A-Za-z]{3,} \d{1,2},? \d{4}", ("MMM d[,] yyyy HH:mm:ss[ Z]", "MMMM d[,] yyyy HH:mm:ss[ Z]",
                                        "MMM d[,] yyyy h:mm:ss a", "MMMM d[,] yyyy h:mm:ss a")),
    (r"^\d{1,2}/\d{1,2}/\d{4} .*[AP]M$", ("M/d/yyyy h:mm:ss a", "M/d/yyyy h:mm a")),
    (r"^[A-Za-z]{3} \d{1,2} [\d:]+ \d{4}$", ("MMM d HH:mm:ss yyyy",)),
)
# A system log's time has no year.
NO_YEAR = r"^[A-Za-z]{3} \d{1,2} \d{2}:\d{2}:\d{2}$"
WEEKDAY = r"^\s*(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,?\s+"
ZONE_SUFFIX = r"(?:Z|UTC|GMT|[+-]\d{2}:?\d{2})$"
DOTTED_QUAD = (r"^(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}"
               r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\z")
MAX_DOMAIN = 253
MAX_PORT = 65535


class Cleaned(NamedTuple):
    value: Column
    warning: Column


def lookup(table: dict, key: Column, value_type: str = "string") -> Column:
    """Value of a small fixed table, NULL for keys it lacks."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.create_map(*pairs)[key].cast(value_type)


def instant(text: Column, as_of: Column | None = None) -> Column:
    """Parse a timestamp text; NULL when no known layout fits.

    A text without a year gets that of ``as_of``, and is unreadable without one.
    """
    return F.coalesce(F.try_to_timestamp(text),
                      *[F.try_to_timestamp(text, F.lit(layout)) for layout in TIME_LAYOUTS],
                      _by_family(text, as_of))


def _by_family(text: Column, as_of: Column | None) -> Column:
    """Instants of the layout families; evaluated for texts only that nothing else could read."""
    plain = F.regexp_replace(F.regexp_replace(text, WEEKDAY, ""), r"\s+", " ")
    plain = F.regexp_replace(strip(plain), r" (?:GMT|UTC|UT|Z)$", " +0000")
    plain = F.regexp_replace(plain, r"(?i)([ap])\.?m\.?$", "$1M")
    plain = F.regexp_replace(F.regexp_replace(plain, "aM$", "AM"), "pM$", "PM")
    found = [F.when(plain.rlike(shape), F.coalesce(*[F.try_to_timestamp(plain, F.lit(x)) for x in layouts]))
             for shape, layouts in TIME_FAMILIES]
    if as_of is not None:
        dated = F.concat_ws(" ", F.year(as_of).cast("string"), plain)
        found.append(F.when(plain.rlike(NO_YEAR), F.try_to_timestamp(dated, F.lit("yyyy MMM d HH:mm:ss"))))
    return F.coalesce(*found)


def clean_timestamp(text: Column, as_of: Column) -> Cleaned:
    parsed = instant(text, as_of)
    value = F.coalesce(F.when(filled(text), parsed), as_of)
    warning = (F.when(~filled(text), F.lit(W_TIME_MISSING))
               .when(parsed.isNull(), message(W_TIME_BAD, text))
               .when(~text.rlike(ZONE_SUFFIX), message(W_TIME_NO_ZONE, text)))
    return Cleaned(value, warning)


def clean_optional_timestamp(text: Column, as_of: Column) -> Cleaned:
    """As :func:`clean_timestamp`, but an absent text is NULL and silent."""
    inner = clean_timestamp(text, as_of)
    return Cleaned(F.when(filled(text), inner.value), F.when(filled(text), inner.warning))


def clean_ip(text: Column, field: str) -> Cleaned:
    """Keep a dotted-quad IPv4 address, without a port suffix."""
    host = F.when(text.startswith("["), text).otherwise(F.substring_index(text, ":", 1))
    good = host.rlike(DOTTED_QUAD)
    return Cleaned(F.when(filled(text) & good, host),
                   F.when(filled(text) & ~good, message(W_IP, F.lit(field), host)))


def clean_domain(text: Column) -> Cleaned:
    name = F.lower(strip(text))
    bad = (F.char_length(name) > MAX_DOMAIN) | F.contains(name, F.lit(" "))
    return Cleaned(F.when(filled(text) & ~bad, name),
                   F.when(filled(text) & bad, message(W_DOMAIN, name)))


def clean_port(number: Column) -> Cleaned:
    good = number.between(0, MAX_PORT)
    return Cleaned(F.when(good, number).cast("int"), F.when(~good, message(W_PORT, number)))


def clean_severity(text: Column) -> Cleaned:
    known = lookup(SEVERITIES, strip(F.lower(text)))
    return Cleaned(
        F.coalesce(F.when(filled(text), known), F.lit("INFO")),
        F.when(~filled(text), F.lit(W_SEVERITY_MISSING))
         .when(known.isNull(), message(W_SEVERITY_UNKNOWN, text)))


def clean_action(text: Column) -> Cleaned:
    known = lookup(ACTIONS, strip(F.lower(text)))
    return Cleaned(F.when(filled(text), known),
                   F.when(filled(text) & known.isNull(), message(W_ACTION_UNKNOWN, text)))


def clean_event_type(text: Column) -> Cleaned:
    return Cleaned(F.when(filled(text), strip(F.upper(text))).otherwise(F.lit("UNKNOWN")),
                   F.when(~filled(text), F.lit(W_TYPE_MISSING)))


def clean_tcp_flags(text: Column) -> Column:
    flags = F.transform(F.split(text, ","), lambda flag: F.upper(strip(flag)))
    return F.coalesce(F.filter(flags, lambda flag: flag != ""), F.array().cast("array<string>"))


def clean_user(text: Column) -> Column:
    return null_if_empty(F.lower(strip(text)))


def upper_or_null(text: Column) -> Column:
    return null_if_empty(F.upper(text))


def counter(number: Column) -> Column:
    """Counts are never NULL and never negative."""
    return F.greatest(F.coalesce(number, F.lit(0)), F.lit(0)).cast("bigint")
