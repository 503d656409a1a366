"""Casts and ratios whose failure mode matters: NULL, or an error, but never silent drift."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_bigint(text: Column) -> Column:
    return text.try_cast("bigint")


def strict_bigint(text: Column, label: str) -> Column:
    """Raises on text that is not an integer, whatever the session's ANSI setting."""
    number = text.try_cast("bigint")
    bad = F.raise_error(F.concat(F.lit(f"{label}: not an integer: "), text)).cast("bigint")
    return F.when(text.isNotNull() & number.isNull(), bad).otherwise(number)


def safe_timestamp(text: Column) -> Column:
    """Needs a full year-month-day; a bare `try_cast` would also take `2026` or `2026-09`."""
    return F.when(text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), text.try_cast("timestamp"))


def safe_boolean(text: Column) -> Column:
    """Only true/false; a bare `try_cast` would also take `yes` or `1`."""
    word = F.lower(text)
    return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def cents_to_usd(text: Column) -> Column:
    return safe_bigint(text) / F.lit(100)


def cents(usd: Column) -> Column:
    return F.rint(usd * 100).cast("bigint")


def sum_usd(usd: Column) -> Column:
    """A sum in whole cents: the same in whatever order tasks add up, also after a retry."""
    return F.sum(cents(usd)) / F.lit(100)


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, one decimal; NULL when the whole is 0 or NULL."""
    return F.round(F.try_divide(part, whole) * 100, 1)


def part_after_at(email: Column) -> Column:
    """Second `@`-separated part; NULL without an `@`, `b` for `a@b@c`."""
    return F.get(F.split(email, "@"), F.lit(1))


def local_part_key(email: Column) -> Column:
    """Mailbox name with its dots removed: `john.smith@x` and `johnsmith@x` agree."""
    return F.replace(F.get(F.split(email, "@"), F.lit(0)), F.lit("."), F.lit(""))


def domain_from_name(name: Column) -> Column:
    """Rule-derived web domain: lower case, letters and digits only, first 24, `.com`."""
    kept = F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]", "")
    return F.concat(F.substring(kept, 1, 24), F.lit(".com"))


def decimal_text(number: Column) -> Column:
    """A double as plain decimal text, also from 1e7 up where Spark writes `1.0E7`."""
    plain = F.regexp_replace(
        number.cast("string").try_cast("decimal(38,18)").cast("string"), r"(\.\d+?)0+$", "$1"
    )
    large = (F.abs(number) >= 1e7) & (F.abs(number) < 1e16)
    return F.when(large, plain).otherwise(number.cast("string"))


def blank_if_missing(value: Column, is_double: bool = False) -> Column:
    """Text for a CRM field: NULL and NaN become the empty string."""
    if is_double:
        return F.coalesce(F.when(~F.isnan(value), decimal_text(value)), F.lit(""))
    return F.coalesce(value.cast("string"), F.lit(""))
