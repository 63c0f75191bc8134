"""Weeks that start on Monday, weekends that start on Friday."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from retailgrain.rules.fixed_values import LABEL_JOINER

FRIDAY = 4
SUNDAY = 6


def week_start(day: Column) -> Column:
    """The Monday of the week, as a date."""
    return F.date_sub(F.to_date(day), F.weekday(day))


def iso_week(day: Column) -> Column:
    return F.weekofyear(day)


def _span_label(monday: Column, first: int, last: int) -> Column:
    return F.concat(
        F.date_format(F.date_add(monday, first), "MM-dd"),
        F.lit(LABEL_JOINER),
        F.date_format(F.date_add(monday, last), "MM-dd"),
    )


def week_label(day: Column) -> Column:
    return _span_label(week_start(day), 0, SUNDAY)


def weekend_label(day: Column, first_weekend_day: int = FRIDAY) -> Column:
    return _span_label(week_start(day), first_weekend_day, SUNDAY)


def weekend_flag(day: Column, first_weekend_day: int = FRIDAY) -> Column:
    return F.weekday(day) >= first_weekend_day


def report_window(as_of: dt.date, weeks: int = 10) -> tuple[dt.date, dt.date]:
    """Start and end Monday of the last ``weeks`` full weeks before ``as_of``."""
    end = as_of - dt.timedelta(days=as_of.weekday())
    return end - dt.timedelta(weeks=weeks), end


def report_month(as_of: dt.date) -> int:
    """The month of the day before ``as_of``."""
    return (as_of - dt.timedelta(days=1)).month
