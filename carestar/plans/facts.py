"""Transaction facts over a date range."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestar.functions.dates import FIRST_DAY, LAST_DAY, bounded_date_key, date_key, moment
from carestar.operators.dimensions import UNKNOWN_CODE
from carestar.operators.lookup import as_of_lookup
from carestar.plans import dims
from carestar.schemas import WAREHOUSE
from carestar.session import written

_PATIENT_RULES = ("drop", "unknown", "error", "null")


def conform(df: DataFrame, table: str, now: dt.datetime) -> DataFrame:
    """Columns of the table in order and type; the row key is set when it is stored."""
    row_key, *_ = WAREHOUSE[table].names
    keyed = df.withColumn(row_key, F.lit(None)).withColumn("load_dts", moment(now))
    columns = []
    for field in WAREHOUSE[table]:
        name, kind = field.name, field.dataType.simpleString()
        # Text keeps the collation it has.
        columns.append(name if kind == "string" else f"CAST({name} AS {kind}) AS {name}")
    return keyed.selectExpr(*columns)


def _with_dimension(
    rows: DataFrame,
    dim: dims.HistoryDim,
    members: DataFrame,
    day: Column,
    ranges: DataFrame | None = None,
) -> DataFrame:
    return as_of_lookup(
        rows,
        members,
        fact_key=dim.natural_key,
        on=day,
        natural_key=dim.natural_key,
        surrogate_key=dim.surrogate_key,
        ranges=ranges,
    )


def ranges_of(table: str) -> str:
    """The name under which a warehouse holds the timeline of a dimension, if it does."""
    return f"{table}_ranges"


def _with_dimensions(
    rows: DataFrame,
    warehouse: dict[str, DataFrame],
    wanted: tuple[dims.HistoryDim, ...],
    day: str,
    on_missing: str,
) -> DataFrame:
    """Look up each dimension as of ``day``.

    A fact needs its patient: without one the row is dropped, gets the unknown
    member, or fails the load, as ``on_missing`` says. Other members may be
    absent (NULL), or the unknown member with ``on_missing="unknown"``. With
    "null" the row stays without its patient, for the writer to count and drop.

    Patients come last. They are the dimension that is too large to broadcast, and rows
    move to them with the keys of the other dimensions, which are narrower than their text.
    """
    if on_missing not in _PATIENT_RULES:
        raise ValueError(f"unknown rule for missing members {on_missing!r}")
    for dim in sorted(wanted, key=lambda dim: dim is dims.PATIENT):
        ranges = warehouse.get(ranges_of(dim.table))
        rows = _with_dimension(rows, dim, warehouse[dim.table], F.col(day), ranges)
        key = F.col(dim.surrogate_key)
        if on_missing == "unknown":
            rows = rows.withColumn(dim.surrogate_key, F.coalesce(key, F.lit(dims.UNKNOWN_KEY)))
        elif dim is dims.PATIENT and on_missing == "drop":
            rows = rows.where(key.isNotNull())
        elif dim is dims.PATIENT and on_missing == "error":
            missing = F.concat(F.lit("no patient as of the fact date: "), F.col(dim.natural_key))
            failing = F.raise_error(F.coalesce(missing, F.lit("fact without patient")))
            rows = rows.withColumn(dim.surrogate_key, F.coalesce(key, failing.cast("bigint")))
    return rows


def _started(column: str, first: dt.date, last: dt.date) -> Column:
    """Bounds on the bare column, so that the scan can skip row groups."""
    after = last + dt.timedelta(days=1) if last < dt.date.max else None
    lower = F.col(column) >= F.lit(first)
    return lower if after is None else lower & (F.col(column) < F.lit(after))


def encounter_source(encounters: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    zero = F.lit(0).cast("decimal(18,2)")
    return encounters.where(F.col("Id").isNotNull() & _started("START", first, last)).select(
        F.col("Id").alias("encounter_id"),
        F.to_date("START").alias("encounter_date"),
        F.col("PATIENT").alias("patient_id"),
        F.col("PROVIDER").alias("provider_id"),
        F.col("PAYER").alias("payer_id"),
        F.col("ORGANIZATION").alias("organization_id"),
        F.col("ENCOUNTERCLASS").alias("encounter_class"),
        F.col("CODE").alias("encounter_code"),
        F.col("DESCRIPTION").alias("encounter_description"),
        F.col("REASONCODE").alias("reason_code"),
        F.coalesce("BASE_ENCOUNTER_COST", zero).alias("base_cost"),
        F.coalesce("TOTAL_CLAIM_COST", zero).alias("total_claim_cost"),
        F.coalesce("PAYER_COVERAGE", zero).alias("payer_coverage"),
    )


def fact_encounter(
    staging: Mapping[str, DataFrame],
    warehouse: dict[str, DataFrame],
    first: dt.date,
    last: dt.date,
    now: dt.datetime,
    on_missing: str = "drop",
) -> DataFrame:
    """Encounters that start in the range, one row each."""
    rows = _with_dimensions(
        encounter_source(staging["encounters"], first, last),
        warehouse,
        (dims.PATIENT, dims.PROVIDER, dims.ORGANIZATION, dims.PAYER),
        "encounter_date",
        on_missing,
    )
    rows = rows.withColumn("encounter_date_key", date_key(F.col("encounter_date")))
    rows = rows.withColumn("out_of_pocket", F.col("total_claim_cost") - F.col("payer_coverage"))
    return conform(rows, "fact_encounter", now)


def _care_site(
    encounters: DataFrame, rows: DataFrame, key: str, first: dt.date, last: dt.date
) -> DataFrame:
    """Where the encounters of ``rows`` took place. Encounters are of any month, so they are
    first cut down to the ids asked for, which a small range broadcasts. A range that holds
    every day asks for them all, and its rows are not worked out a second time for their ids."""
    site = encounters.select(
        F.col("Id").alias("_encounter"),
        F.col("PROVIDER").alias("provider_id"),
        F.col("ORGANIZATION").alias("organization_id"),
    )
    if first <= FIRST_DAY and last >= LAST_DAY:
        return site
    wanted = rows.select(F.col(key).alias("_encounter")).distinct()
    return site.join(wanted, "_encounter", "left_semi")


def condition_source(
    conditions: DataFrame, encounters: DataFrame, first: dt.date, last: dt.date
) -> DataFrame:
    rows = conditions.where(
        F.col("START").between(F.lit(first), F.lit(last)) & F.col("CODE").isNotNull()
    ).select(
        F.col("START").alias("start_date"),
        F.col("STOP").alias("stop_date"),
        F.col("PATIENT").alias("patient_id"),
        F.col("ENCOUNTER").alias("encounter_id"),
        F.col("CODE").alias("condition_code"),
        F.col("DESCRIPTION").alias("condition_description"),
    )
    site = _care_site(encounters, rows, "encounter_id", first, last)
    return rows.join(site, rows["encounter_id"] == site["_encounter"], "left").drop("_encounter")


def fact_condition(
    staging: Mapping[str, DataFrame],
    warehouse: dict[str, DataFrame],
    first: dt.date,
    last: dt.date,
    now: dt.datetime,
    on_missing: str = "drop",
) -> DataFrame:
    """Conditions that start in the range; active while they have no usable stop."""
    codes = warehouse["dim_condition_code"].select(
        F.col("code").alias("condition_code"), "condition_code_key"
    )
    rows = condition_source(staging["conditions"], staging["encounters"], first, last)
    rows = _with_dimensions(
        rows.join(codes, "condition_code"),
        warehouse,
        (dims.PATIENT, dims.PROVIDER, dims.ORGANIZATION),
        "start_date",
        on_missing,
    )
    rows = (
        rows.withColumn("start_date_key", date_key(F.col("start_date")))
        .withColumn("stop_date_key", bounded_date_key(F.col("stop_date")))
        .withColumn("is_active", F.col("stop_date_key").isNull().cast("int"))
    )
    return conform(rows, "fact_condition", now)


# Sums whose type is wider than the column that holds them.
_SUMMED = ("base_cost", "payer_coverage", "dispense_count")


def medication_source(
    medications: DataFrame, encounters: DataFrame, first: dt.date, last: dt.date
) -> DataFrame:
    """One row per patient, start day and code."""
    rows = medications.where(F.col("START").between(F.lit(first), F.lit(last)))
    site = _care_site(encounters, rows, "ENCOUNTER", first, last)
    joined = rows.join(site, rows["ENCOUNTER"] == site["_encounter"], "left")
    zero = F.lit(0).cast("decimal(18,2)")
    return joined.groupBy(
        F.col("PATIENT").alias("patient_id"),
        F.col("START").alias("start_date"),
        F.coalesce("CODE", F.lit(UNKNOWN_CODE)).alias("medication_code"),
    ).agg(
        F.max("STOP").alias("stop_date"),
        F.max("PAYER").alias("payer_id"),
        F.max("ENCOUNTER").alias("encounter_id"),
        F.max("REASONCODE").alias("reason_code"),
        F.max("provider_id").alias("provider_id"),
        F.max("organization_id").alias("organization_id"),
        F.sum(F.coalesce("BASE_COST", zero)).alias("base_cost"),
        F.sum(F.coalesce("PAYER_COVERAGE", zero)).alias("payer_coverage"),
        F.sum(F.coalesce("DISPENSES", F.lit(1))).alias("dispense_count"),
    )


def fact_medications(
    staging: Mapping[str, DataFrame],
    warehouse: dict[str, DataFrame],
    first: dt.date,
    last: dt.date,
    now: dt.datetime,
    on_missing: str = "drop",
    aside: list[str] | None = None,
) -> DataFrame:
    """Prescriptions that start in the range, at the grain of the source plan.

    They are worked out once and written aside, as wide as the table keeps them: the shuffles
    by encounter and by prescription, the widest of a load, are off the disk before those by
    patient and by month begin. ``aside`` is given the folder, to be removed once the facts
    are stored.
    """
    codes = warehouse["dim_medication"].select("medication_code", "medication_key")
    rows = medication_source(staging["medications"], staging["encounters"], first, last)
    kinds = WAREHOUSE["fact_medications"]
    kept = {name: F.col(name).cast(kinds[name].dataType) for name in _SUMMED}
    rows = written(rows.withColumns(kept), "prescriptions", aside)
    rows = _with_dimensions(
        rows.join(codes, "medication_code"),
        warehouse,
        (dims.PATIENT, dims.PROVIDER, dims.ORGANIZATION, dims.PAYER),
        "start_date",
        on_missing,
    )
    rows = (
        rows.withColumn("start_date_key", date_key(F.col("start_date")))
        .withColumn("stop_date_key", bounded_date_key(F.col("stop_date")))
        .withColumn("is_active", F.col("stop_date_key").isNull().cast("int"))
        .withColumn("out_of_pocket", F.col("base_cost") - F.col("payer_coverage"))
    )
    return conform(rows, "fact_medications", now)


def medication_span(
    medications: DataFrame, first: dt.date, last: dt.date
) -> tuple[dt.date, dt.date]:
    """Days the calendar must cover: first start to last stop of the range's rows."""
    bounds = (
        medications.where(F.col("START").between(F.lit(first), F.lit(last)))
        .agg(
            F.min("START").alias("low"),
            F.max(F.coalesce("STOP", "START")).alias("high"),
        )
        .first()
    )
    return bounds["low"] or first, bounds["high"] or last


DROPPED = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("fact_table", "patient_id", "encounter_id", "code")]
    + [T.StructField("fact_date", T.DateType()), T.StructField("date_key", T.IntegerType())]
)


def dropped_name(table: str) -> str:
    """The table that holds the source rows a fact table could not take."""
    return f"{table}_dropped"


def dropped(
    table: str,
    staging: Mapping[str, DataFrame],
    warehouse: dict[str, DataFrame],
    first: dt.date,
    last: dt.date,
) -> DataFrame:
    """Who, when, where and what of the source rows that have no patient to be a fact of."""
    if table == "fact_encounter":
        rows = encounter_source(staging["encounters"], first, last)
        day, code = "encounter_date", "encounter_code"
    elif table == "fact_condition":
        rows = condition_source(staging["conditions"], staging["encounters"], first, last)
        day, code = "start_date", "condition_code"
    else:
        rows = medication_source(staging["medications"], staging["encounters"], first, last)
        day, code = "start_date", "medication_code"
    rows = rows.select(
        F.lit(table).alias("fact_table"),
        "patient_id",
        "encounter_id",
        F.col(code).alias("code"),
        F.col(day).alias("fact_date"),
        date_key(F.col(day)).alias("date_key"),
    )
    ranges = warehouse.get(ranges_of(dims.PATIENT.table))
    lost = rows_without_patient(rows, warehouse[dims.PATIENT.table], "fact_date", ranges)
    return lost.drop(dims.PATIENT.surrogate_key)


def rows_without_patient(
    source: DataFrame, patients: DataFrame, day: str, ranges: DataFrame | None = None
) -> DataFrame:
    """Fact source rows that have no patient version on their day."""
    found = _with_dimension(source, dims.PATIENT, patients, F.col(day), ranges)
    return found.where(F.col(dims.PATIENT.surrogate_key).isNull())
