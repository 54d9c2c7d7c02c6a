"""The calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.functions.dates import calendar_attributes, moment
from carestar.operators.upsert import insert_missing
from carestar.schemas import WAREHOUSE


class InvalidRange(ValueError):
    """A date range with a missing or reversed bound."""


def check_range(first: dt.date | None, last: dt.date | None) -> None:
    if first is None or last is None or last < first:
        raise InvalidRange(f"invalid date range: {first} .. {last}")


def calendar(
    spark: SparkSession, first: dt.date, last: dt.date, now: Column | None = None
) -> DataFrame:
    """One row per day of the inclusive range; the fiscal columns stay NULL."""
    check_range(first, last)
    stamp = now if now is not None else moment(dt.datetime(1900, 1, 1))
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("full_date")
    )
    return _in_schema(
        days.select(*[c.alias(n) for n, c in calendar_attributes(F.col("full_date")).items()]),
        stamp,
    )


def calendar_of(days: DataFrame, day: str, now: Column | None = None) -> DataFrame:
    """Calendar rows for the distinct days of a DataFrame column."""
    stamp = now if now is not None else moment(dt.datetime(1900, 1, 1))
    distinct = days.select(F.col(day).cast("date").alias("full_date")).distinct()
    columns = calendar_attributes(F.col("full_date"))
    return _in_schema(distinct.select(*[c.alias(n) for n, c in columns.items()]), stamp)


def _in_schema(days: DataFrame, stamp: Column) -> DataFrame:
    schema = WAREHOUSE["dim_date"]
    filled = (
        days.withColumn("fiscal_year", F.lit(None).cast("smallint"))
        .withColumn("fiscal_quarter", F.lit(None).cast("tinyint"))
        .withColumn("create_at", stamp)
        .withColumn("update_at", stamp)
    )
    return filled.select(*schema.names)


def missing_days(existing: DataFrame | None, wanted: DataFrame) -> DataFrame:
    """The calendar rows not held yet."""
    return insert_missing(existing, wanted, ["full_date"])
