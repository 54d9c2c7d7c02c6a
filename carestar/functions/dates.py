"""Date keys and calendar attributes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_DAY = dt.date(1900, 1, 1)
LAST_DAY = dt.date(2099, 12, 31)
OPEN_END = dt.date(9999, 12, 31)


def moment(value: dt.datetime) -> Column:
    """A driver-side time as a literal that no session time zone can shift."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def date_key(day: Column) -> Column:
    """The integer yyyymmdd; keeps date order, so key ranges equal date ranges."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def day_of_key(key: Column) -> Column:
    return F.make_date(
        F.floor(key / 10000).cast("int"),
        F.floor(key / 100).cast("int") % 100,
        key % 100,
    )


def key_of(day: dt.date) -> int:
    """The date key of a driver-side date."""
    return day.year * 10000 + day.month * 100 + day.day


def bounded_date_key(day: Column) -> Column:
    """The key of a day inside the calendar, NULL for any other."""
    return F.when(day.between(F.lit(FIRST_DAY), F.lit(LAST_DAY)), date_key(day))


def calendar_attributes(day: Column) -> dict[str, Column]:
    """Calendar columns; the week starts on Monday and weeks are ISO weeks."""
    weekday = F.weekday(day) + 1
    return {
        "date_key": date_key(day),
        "full_date": day,
        "year": F.year(day).cast("smallint"),
        "quarter": F.quarter(day).cast("tinyint"),
        "month": F.month(day).cast("tinyint"),
        "month_name": F.date_format(day, "MMMM"),
        "week_of_year": F.weekofyear(day).cast("tinyint"),
        "day_of_month": F.dayofmonth(day).cast("tinyint"),
        "day_of_week": weekday.cast("tinyint"),
        "day_name": F.date_format(day, "EEEE"),
        "is_weekend": weekday.isin(6, 7),
    }
