import datetime as dt

import pytest

from carestar.functions.dates import bounded_date_key, date_key, day_of_key, key_of
from carestar.operators.calendar import InvalidRange, calendar, missing_days
from pyspark.sql import functions as F


def test_attributes(spark):
    days = {
        r.full_date: r
        for r in calendar(spark, dt.date(1900, 1, 1), dt.date(2099, 12, 31)).collect()
    }
    assert len(days) == 73049
    sunday = days[dt.date(2021, 1, 3)]
    assert (sunday.week_of_year, sunday.day_of_week, sunday.is_weekend) == (53, 7, True)
    assert (sunday.day_name, sunday.month_name) == ("Sunday", "January")
    leap = days[dt.date(2000, 2, 29)]
    assert (leap.date_key, leap.quarter, leap.month, leap.day_of_month) == (20000229, 1, 2, 29)
    assert leap.fiscal_year is None and leap.fiscal_quarter is None
    assert dt.date(1900, 2, 28) in days


def test_bad_ranges(spark):
    day = dt.date(2020, 1, 1)
    for first, last in ((None, day), (day, None), (day, dt.date(2019, 1, 1))):
        with pytest.raises(InvalidRange):
            calendar(spark, first, last)


def test_only_missing_days(spark):
    held = calendar(spark, dt.date(2020, 1, 1), dt.date(2020, 1, 10))
    wanted = calendar(spark, dt.date(2020, 1, 5), dt.date(2020, 1, 12))
    days = [r.full_date.day for r in missing_days(held, wanted).orderBy("full_date").collect()]
    assert days == [11, 12]


def test_date_keys(spark):
    days = [dt.date(1899, 12, 31), dt.date(1900, 1, 1), dt.date(2099, 12, 31), dt.date(2100, 1, 1), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select(
        "d", date_key(F.col("d")).alias("k"), bounded_date_key(F.col("d")).alias("b"),
        day_of_key(date_key(F.col("d"))).alias("back"),
    ).collect()
    assert [r.back for r in rows] == days
    assert [r.b for r in rows] == [None, 19000101, 20991231, None, None]
    assert [r.k for r in rows[:4]] == [key_of(d) for d in days[:4]]
