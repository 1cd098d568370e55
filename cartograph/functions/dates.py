"""Date helpers: parts, names, year-month codes, window bounds."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartograph.functions.scalars import col_


def as_date(value) -> Column:
    """A literal date (string 'YYYY-MM-DD' or datetime.date) or a date column."""
    if isinstance(value, (_dt.date, str)):
        return F.lit(str(value)).cast("date")
    return col_(value)


def add_days(date: str, days: int) -> str:
    return (_dt.date.fromisoformat(date) + _dt.timedelta(days=days)).isoformat()


def date_parts(c="t_dat") -> list[Column]:
    """year, month, day, Sunday=1 weekday, Monday=0 weekday, ISO week, day and month names."""
    d = col_(c)
    return [
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.dayofweek(d).alias("day_of_week_sun1"),
        F.weekday(d).alias("day_of_week_mon0"),
        F.weekofyear(d).alias("iso_week"),
        F.date_format(d, "E").alias("day_name"),
        F.date_format(d, "MMM").alias("month_name"),
    ]


def year_month_code(c="t_dat") -> Column:
    """year*100 + month, e.g. 202009."""
    return F.year(col_(c)) * 100 + F.month(col_(c))


def code_year(code) -> Column:
    return (col_(code) / 100).cast("int")


def code_month(code) -> Column:
    return F.pmod(col_(code), F.lit(100))


def months_between_codes(later, earlier) -> Column:
    """(year difference)*12 + (month difference) of two year-month codes."""
    return (code_year(later) - code_year(earlier)) * 12 + (code_month(later) - code_month(earlier))


def year_month_label(year, month) -> Column:
    """'YYYY-MM' with a zero-padded month."""
    return F.concat(col_(year).cast("string"), F.lit("-"), F.lpad(col_(month).cast("string"), 2, "0"))


def is_weekend(c="t_dat") -> Column:
    """Saturday or Sunday (Spark dayofweek 7 or 1)."""
    return F.dayofweek(col_(c)).isin(1, 7)
