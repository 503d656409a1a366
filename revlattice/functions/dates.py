"""Date expressions. Every "today" is an explicit `as_of`, so results can be repeated."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = dt.date | str | None


def as_day(as_of: AsOf) -> Column:
    """The run's date as a column; None means the current date."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def days_before(as_of: AsOf, days: int) -> Column:
    return F.date_sub(as_day(as_of), days)


def week_start(moment: Column) -> Column:
    """Monday of the week a date or timestamp falls in."""
    return F.trunc(F.to_date(moment), "week")


def days_between(later: Column, earlier: Column) -> Column:
    return F.date_diff(later, earlier).cast("bigint")
