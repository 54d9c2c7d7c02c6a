"""The dimensions: what each is built from and which columns it tracks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.functions.dates import moment
from carestar.operators.dimensions import (
    UNKNOWN_CODE,
    UNKNOWN_KEY,
    new_codes,
    next_versions,
    unknown_version,
    with_unknown_member,
)
from carestar.operators.surrogate import dense_ids
from carestar.schemas import WAREHOUSE
from carestar.sources.literal import no_rows


@dataclass(frozen=True)
class HistoryDim:
    """A type-2 dimension; ``tracked`` columns open a new version when they change."""

    table: str
    surrogate_key: str
    natural_key: str
    tracked: Sequence[str]
    unknown: dict[str, str]
    source: Callable[[Mapping[str, DataFrame]], DataFrame]


@dataclass(frozen=True)
class CodeDim:
    table: str
    surrogate_key: str
    code: str
    description: str
    staging: str
    unknown: str


def _lowered(*names: str) -> list[str]:
    return [f"{name} AS {name.lower()}" for name in names]


def _patients(staging: Mapping[str, DataFrame]) -> DataFrame:
    rows = staging["patients"].where(F.col("Id").isNotNull())
    return rows.selectExpr(
        "Id AS patient_id",
        "FIRST AS first_name",
        "LAST AS last_name",
        *_lowered("BIRTHDATE", "DEATHDATE", "GENDER", "RACE", "ETHNICITY"),
        *_lowered("CITY", "STATE", "ZIP", "COUNTY"),
        *_lowered("HEALTHCARE_EXPENSES", "HEALTHCARE_COVERAGE"),
        "year(BIRTHDATE) AS birth_year",
    )


def _organizations(staging: Mapping[str, DataFrame]) -> DataFrame:
    rows = staging["organizations"].where(F.col("Id").isNotNull())
    names = ("NAME", "CITY", "STATE", "ZIP", "PHONE", "REVENUE", "UTILIZATION")
    return rows.selectExpr("Id AS organization_id", *_lowered(*names))


def _providers(staging: Mapping[str, DataFrame]) -> DataFrame:
    rows = staging["providers"].where(F.col("Id").isNotNull())
    names = ("NAME", "GENDER", "SPECIALITY", "CITY", "STATE", "ZIP", "UTILIZATION")
    return rows.selectExpr(
        "Id AS provider_id", "ORGANIZATION AS organization_id", *_lowered(*names)
    )


def _payers(staging: Mapping[str, DataFrame]) -> DataFrame:
    """Payers with their greatest ownership among the coverage periods."""
    periods = staging["payer_transitions"].where(F.col("PAYER").isNotNull())
    owned = periods.groupBy(F.col("PAYER").alias("_payer")).agg(
        F.max("OWNERSHIP").alias("ownership")
    )
    rows = staging["payers"].where(F.col("Id").isNotNull())
    names = ("NAME", "CITY", "STATE_HEADQUARTERED", "ZIP", "PHONE")
    sums = ("AMOUNT_COVERED", "AMOUNT_UNCOVERED", "REVENUE", "UNIQUE_CUSTOMERS", "MEMBER_MONTHS")
    return rows.join(owned, rows["Id"] == owned["_payer"], "left").selectExpr(
        "Id AS payer_id", *_lowered(*names), "ownership", *_lowered(*sums)
    )


# Tracked columns, in hash order, and the unknown members.
PATIENT = HistoryDim(
    "dim_patient",
    "patient_key",
    "patient_id",
    (
        "city",
        "state",
        "zip",
        "county",
        "deathdate",
        "healthcare_expenses",
        "healthcare_coverage",
    ),
    {"first_name": "Unknown", "last_name": "Patient"},
    _patients,
)
ORGANIZATION = HistoryDim(
    "dim_organization",
    "organization_key",
    "organization_id",
    ("name", "city", "state", "revenue", "utilization"),
    {"name": "Unknown Organization"},
    _organizations,
)
PROVIDER = HistoryDim(
    "dim_provider",
    "provider_key",
    "provider_id",
    ("organization_id", "speciality", "city", "state", "utilization"),
    {"name": "Unknown Provider"},
    _providers,
)
PAYER = HistoryDim(
    "dim_payer",
    "payer_key",
    "payer_id",
    ("ownership", "amount_covered", "revenue", "unique_customers"),
    {"name": "Unknown Payer"},
    _payers,
)
HISTORY_DIMS = (PATIENT, ORGANIZATION, PROVIDER, PAYER)

CONDITION_CODE = CodeDim(
    "dim_condition_code", "condition_code_key", "code", "description", "conditions",
    "Unknown Condition",
)
MEDICATION = CodeDim(
    "dim_medication", "medication_key", "medication_code", "medication_description", "medications",
    "Unknown Medication",
)
CODE_DIMS = (CONDITION_CODE, MEDICATION)


def unknown_row(spark: SparkSession, dim: HistoryDim, now: dt.datetime) -> DataFrame:
    """A dimension that holds its unknown member only: the state before any load."""
    empty = no_rows(spark, WAREHOUSE[dim.table])
    values = unknown_version(dim.surrogate_key, dim.natural_key, dim.unknown, now)
    return with_unknown_member(empty, dim.surrogate_key, values)


def unknown_code_row(spark: SparkSession, dim: CodeDim, now: dt.datetime) -> DataFrame:
    """The unknown code takes the first ordinary key."""
    empty = no_rows(spark, WAREHOUSE[dim.table])
    values = {
        dim.surrogate_key: 1,
        dim.code: UNKNOWN_CODE,
        dim.description: dim.unknown,
        "create_at": now,
        "update_at": now,
    }
    return with_unknown_member(empty, dim.code, values)


def history_options(dim: HistoryDim, as_of: dt.date, now: dt.datetime, valid_from: str) -> dict:
    return {
        "natural_key": dim.natural_key,
        "surrogate_key": dim.surrogate_key,
        "tracked": dim.tracked,
        "as_of": as_of,
        "now": moment(now),
        "valid_from": valid_from,
    }


def code_additions(
    dim: CodeDim, existing: DataFrame, staging: DataFrame, now: dt.datetime
) -> DataFrame:
    """Rows to append for codes the dimension has not seen."""
    codes = new_codes(existing, staging, "CODE", "DESCRIPTION", (dim.code, dim.description))
    last = existing.agg(F.max(dim.surrogate_key)).scalar()
    keyed = dense_ids(codes, dim.surrogate_key, [dim.code], after=last)
    filled = {"create_at": moment(now), "update_at": moment(now)}
    columns = []
    for field in WAREHOUSE[dim.table]:
        if field.name in (dim.surrogate_key, dim.code, dim.description):
            columns.append(F.col(field.name))
        else:
            value = filled.get(field.name, F.lit(None).cast(field.dataType))
            columns.append(value.alias(field.name))
    return keyed.select(*columns)


__all__ = [
    "CODE_DIMS",
    "CONDITION_CODE",
    "HISTORY_DIMS",
    "MEDICATION",
    "ORGANIZATION",
    "PATIENT",
    "PAYER",
    "PROVIDER",
    "UNKNOWN_KEY",
    "CodeDim",
    "HistoryDim",
    "code_additions",
    "history_options",
    "next_versions",
    "unknown_code_row",
    "unknown_row",
]
