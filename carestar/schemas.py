"""The data model: eight entities through landing and staging, and the star schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(18, 4)
POINT = T.DecimalType(18, 10)
DAY = T.DateType()
MOMENT = T.TimestampNTZType()
WHOLE = T.IntegerType()


@dataclass(frozen=True)
class Column:
    """One source column: its landing width and the rule that types it.

    ``rule`` is ``id`` (trim, clip), ``text`` (trim, clip, blank to NULL),
    ``flat`` (as ``text`` with control characters turned into spaces), ``when``
    (date or moment) or ``number``; ``spec`` is the clip width of the text rules
    and the Spark type of the other two.
    """

    name: str
    width: int
    rule: str
    spec: int | T.DataType
    required: bool = False

    @property
    def staged_type(self) -> T.DataType:
        return T.StringType() if isinstance(self.spec, int) else self.spec


@dataclass(frozen=True)
class Entity:
    name: str
    csv: str
    columns: tuple[Column, ...]
    keys: tuple[str, ...]
    filter_column: str
    # One row per key, or every row of the newest batch that shares the key.
    one_row_per_key: bool
    # The day that facts of the entity are loaded by; staging is kept by its month.
    day_column: str | None = None

    @property
    def landing_table(self) -> str:
        return "Landing_" + "_".join(part.capitalize() for part in self.name.split("_"))

    @property
    def staging_table(self) -> str:
        return self.landing_table.replace("Landing_", "Staging_")

    @property
    def column_names(self) -> list[str]:
        return [column.name for column in self.columns]

    @property
    def source_schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, T.StringType()) for name in self.column_names])

    @property
    def landing_schema(self) -> T.StructType:
        return T.StructType(list(self.source_schema) + _stamps())

    @property
    def staging_schema(self) -> T.StructType:
        typed = [T.StructField(c.name, c.staged_type) for c in self.columns]
        return T.StructType(typed + _stamps())


def _stamps() -> list[T.StructField]:
    return [
        T.StructField("create_at", MOMENT),
        T.StructField("update_at", MOMENT),
        T.StructField("batch_id", T.StringType()),
    ]


def _c(name, width, rule, spec, required=False):
    return Column(name, width, rule, spec, required)


# Column names, landing widths, clip widths and target types.
PATIENTS = Entity(
    "patients",
    "patients.csv",
    (
        _c("Id", 36, "id", 36, True),
        _c("BIRTHDATE", 10, "when", DAY),
        _c("DEATHDATE", 10, "when", DAY),
        _c("SSN", 11, "flat", 11),
        _c("DRIVERS", 50, "text", 50),
        _c("PASSPORT", 50, "text", 50),
        _c("PREFIX", 10, "text", 10),
        _c("FIRST", 100, "text", 100),
        _c("LAST", 100, "text", 100),
        _c("SUFFIX", 10, "text", 10),
        _c("MAIDEN", 100, "text", 100),
        _c("MARITAL", 20, "text", 20),
        _c("RACE", 50, "text", 50),
        _c("ETHNICITY", 50, "text", 50),
        _c("GENDER", 1, "text", 1),
        _c("BIRTHPLACE", 255, "flat", 255),
        _c("ADDRESS", 255, "flat", 255),
        _c("CITY", 100, "text", 100),
        _c("STATE", 50, "text", 50),
        _c("COUNTY", 100, "text", 100),
        _c("ZIP", 10, "text", 10),
        _c("LAT", 50, "number", MONEY),
        _c("LON", 50, "number", MONEY),
        _c("HEALTHCARE_EXPENSES", 20, "number", MONEY),
        _c("HEALTHCARE_COVERAGE", 20, "number", MONEY),
    ),
    ("Id",),
    "Id",
    True,
)

ENCOUNTERS = Entity(
    "encounters",
    "encounters.csv",
    (
        _c("Id", 36, "id", 36),
        _c("START", 50, "when", MOMENT),
        _c("STOP", 50, "when", MOMENT),
        _c("PATIENT", 36, "text", 36),
        _c("ORGANIZATION", 36, "text", 36),
        _c("PROVIDER", 36, "text", 36),
        _c("PAYER", 36, "text", 36),
        _c("ENCOUNTERCLASS", 50, "text", 50),
        _c("CODE", 20, "text", 20),
        _c("DESCRIPTION", 255, "flat", 255),
        _c("BASE_ENCOUNTER_COST", 20, "number", MONEY),
        _c("TOTAL_CLAIM_COST", 20, "number", MONEY),
        _c("PAYER_COVERAGE", 20, "number", MONEY),
        _c("REASONCODE", 20, "text", 20),
        _c("REASONDESCRIPTION", 255, "flat", 255),
    ),
    ("Id",),
    "Id",
    True,
    "START",
)

CONDITIONS = Entity(
    "conditions",
    "conditions.csv",
    (
        _c("START", 10, "when", DAY),
        _c("STOP", 10, "when", DAY),
        _c("PATIENT", 36, "text", 36),
        _c("ENCOUNTER", 36, "text", 36),
        _c("CODE", 20, "text", 20),
        _c("DESCRIPTION", 255, "flat", 255),
    ),
    ("PATIENT", "START", "CODE"),
    "PATIENT",
    False,
    "START",
)

MEDICATIONS = Entity(
    "medications",
    "medications.csv",
    (
        _c("START", 10, "when", DAY),
        _c("STOP", 10, "when", DAY),
        _c("PATIENT", 36, "text", 36),
        _c("PAYER", 36, "text", 36),
        _c("ENCOUNTER", 36, "text", 36),
        _c("CODE", 20, "text", 20),
        _c("DESCRIPTION", 255, "flat", 255),
        _c("BASE_COST", 20, "number", MONEY),
        _c("PAYER_COVERAGE", 20, "number", MONEY),
        _c("DISPENSES", 10, "number", WHOLE),
        _c("TOTALCOST", 20, "number", MONEY),
        _c("REASONCODE", 20, "text", 20),
        _c("REASONDESCRIPTION", 255, "flat", 255),
    ),
    ("PATIENT", "START", "CODE"),
    "PATIENT",
    False,
    "START",
)

ORGANIZATIONS = Entity(
    "organizations",
    "organizations.csv",
    (
        _c("Id", 100, "id", 36),
        _c("NAME", 255, "text", 255),
        _c("ADDRESS", 255, "flat", 255),
        _c("CITY", 100, "text", 100),
        _c("STATE", 100, "text", 50),
        _c("ZIP", 100, "text", 10),
        _c("LAT", 100, "number", POINT),
        _c("LON", 100, "number", POINT),
        _c("PHONE", 100, "text", 20),
        _c("REVENUE", 100, "number", MONEY),
        _c("UTILIZATION", 100, "number", WHOLE),
    ),
    ("Id",),
    "Id",
    True,
)

PROVIDERS = Entity(
    "providers",
    "providers.csv",
    (
        _c("Id", 100, "id", 36),
        _c("ORGANIZATION", 100, "text", 36),
        _c("NAME", 255, "text", 255),
        _c("GENDER", 1, "text", 1),
        _c("SPECIALITY", 100, "text", 100),
        _c("ADDRESS", 255, "flat", 255),
        _c("CITY", 100, "text", 100),
        _c("STATE", 50, "text", 50),
        _c("ZIP", 10, "text", 10),
        _c("LAT", 50, "number", POINT),
        _c("LON", 50, "number", POINT),
        _c("UTILIZATION", 10, "number", WHOLE),
    ),
    ("Id",),
    "Id",
    True,
)

PAYERS = Entity(
    "payers",
    "payers.csv",
    (
        _c("Id", 100, "id", 36),
        _c("NAME", 255, "text", 255),
        _c("ADDRESS", 255, "flat", 255),
        _c("CITY", 100, "text", 100),
        _c("STATE_HEADQUARTERED", 50, "text", 50),
        _c("ZIP", 100, "text", 10),
        _c("PHONE", 100, "text", 20),
        _c("AMOUNT_COVERED", 100, "number", MONEY),
        _c("AMOUNT_UNCOVERED", 100, "number", MONEY),
        _c("REVENUE", 100, "number", MONEY),
        _c("COVERED_ENCOUNTERS", 100, "number", WHOLE),
        _c("UNCOVERED_ENCOUNTERS", 100, "number", WHOLE),
        _c("COVERED_MEDICATIONS", 100, "number", WHOLE),
        _c("UNCOVERED_MEDICATIONS", 100, "number", WHOLE),
        _c("COVERED_PROCEDURES", 100, "number", WHOLE),
        _c("UNCOVERED_PROCEDURES", 100, "number", WHOLE),
        _c("COVERED_IMMUNIZATIONS", 100, "number", WHOLE),
        _c("UNCOVERED_IMMUNIZATIONS", 100, "number", WHOLE),
        _c("UNIQUE_CUSTOMERS", 100, "number", WHOLE),
        _c("QOLS_AVG", 100, "number", RATE),
        _c("MEMBER_MONTHS", 100, "number", WHOLE),
    ),
    ("Id",),
    "Id",
    True,
)

PAYER_TRANSITIONS = Entity(
    "payer_transitions",
    "payer_transitions.csv",
    (
        _c("PATIENT", 100, "text", 36),
        _c("START_YEAR", 10, "number", WHOLE),
        _c("END_YEAR", 10, "number", WHOLE),
        _c("PAYER", 100, "text", 36),
        _c("OWNERSHIP", 50, "text", 50),
    ),
    ("PATIENT", "START_YEAR", "PAYER"),
    "PATIENT",
    False,
)

# In extract order.
ENTITIES: dict[str, Entity] = {
    entity.name: entity
    for entity in (
        PATIENTS,
        ENCOUNTERS,
        CONDITIONS,
        MEDICATIONS,
        ORGANIZATIONS,
        PROVIDERS,
        PAYERS,
        PAYER_TRANSITIONS,
    )
}


_TYPES = {
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": DAY,
    "decimal(18,2)": MONEY,
    "decimal(19,2)": T.DecimalType(19, 2),
    "int": WHOLE,
    "smallint": T.ShortType(),
    "string": T.StringType(),
    "timestamp_ntz": MOMENT,
    "tinyint": T.ByteType(),
}


def _fields(listing: str) -> T.StructType:
    """A schema from "name type, name type"; works before a session exists."""
    pairs = (field.split(" ") for field in listing.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


_VERSION = (
    "valid_from date, valid_to date, is_current boolean, row_hash string, "
    "create_at timestamp_ntz, update_at timestamp_ntz"
)

WAREHOUSE: dict[str, T.StructType] = {
    "dim_date": _fields(
        "date_key int, full_date date, year smallint, quarter tinyint, month tinyint, "
        "month_name string, week_of_year tinyint, day_of_month tinyint, day_of_week tinyint, "
        "day_name string, is_weekend boolean, fiscal_year smallint, fiscal_quarter tinyint, "
        "create_at timestamp_ntz, update_at timestamp_ntz"
    ),
    "dim_patient": _fields(
        "patient_key bigint, patient_id string, first_name string, last_name string, "
        "birthdate date, deathdate date, gender string, race string, ethnicity string, "
        "city string, state string, zip string, county string, "
        "healthcare_expenses decimal(18,2), healthcare_coverage decimal(18,2), birth_year int, "
        + _VERSION
    ),
    "dim_organization": _fields(
        "organization_key bigint, organization_id string, name string, city string, state string, "
        "zip string, phone string, revenue decimal(18,2), utilization int, " + _VERSION
    ),
    "dim_provider": _fields(
        "provider_key bigint, provider_id string, organization_id string, name string, "
        "gender string, speciality string, city string, state string, zip string, "
        "utilization int, " + _VERSION
    ),
    "dim_payer": _fields(
        "payer_key bigint, payer_id string, name string, city string, state_headquartered string, "
        "zip string, phone string, ownership string, amount_covered decimal(18,2), "
        "amount_uncovered decimal(18,2), revenue decimal(18,2), unique_customers int, "
        "member_months int, " + _VERSION
    ),
    "dim_condition_code": _fields(
        "condition_code_key bigint, code string, description string, body_system string, "
        "condition_category string, is_chronic boolean, is_infectious boolean, "
        "create_at timestamp_ntz, update_at timestamp_ntz"
    ),
    "dim_medication": _fields(
        "medication_key bigint, medication_code string, medication_description string"
    ),
    "fact_encounter": _fields(
        "fact_encounter_key bigint, patient_key bigint, encounter_date_key int, "
        "provider_key bigint, organization_key bigint, payer_key bigint, encounter_id string, "
        "encounter_code string, encounter_class string, encounter_description string, "
        "reason_code string, base_cost decimal(18,2), total_claim_cost decimal(18,2), "
        "payer_coverage decimal(18,2), out_of_pocket decimal(19,2), load_dts timestamp_ntz"
    ),
    "fact_encounter_daily": _fields(
        "daily_key bigint, date_key int, organization_key bigint, payer_key bigint, "
        "encounter_class string, encounter_count int, unique_patient_count int, "
        "total_base_cost decimal(18,2), total_claim_cost decimal(18,2), "
        "total_payer_coverage decimal(18,2), total_out_of_pocket decimal(18,2), "
        "hospitalized_count int, total_los_days int, load_dts timestamp_ntz"
    ),
    "fact_condition": _fields(
        "fact_condition_key bigint, patient_key bigint, start_date_key int, stop_date_key int, "
        "condition_code_key bigint, provider_key bigint, organization_key bigint, "
        "encounter_id string, condition_code string, condition_description string, "
        "is_active int, load_dts timestamp_ntz"
    ),
    "fact_condition_daily": _fields(
        "daily_condition_key bigint, date_key int, condition_code_key bigint, "
        "organization_key bigint, new_cases int, active_cases int, resolved_cases int, "
        "cumulative_cases int, hospitalized_cases int, load_dts timestamp_ntz"
    ),
    "fact_medications": _fields(
        "fact_medication_key bigint, patient_key bigint, medication_key bigint, "
        "start_date_key int, stop_date_key int, provider_key bigint, organization_key bigint, "
        "payer_key bigint, encounter_id string, reason_code string, base_cost decimal(18,2), "
        "payer_coverage decimal(18,2), dispense_count int, is_active int, "
        "out_of_pocket decimal(19,2), load_dts timestamp_ntz"
    ),
    "fact_medication_daily": _fields(
        "medication_daily_key bigint, date_key int, medication_key bigint, "
        "organization_key bigint, payer_key bigint, active_patient_count int, "
        "new_prescriptions int, stopped_prescriptions int, total_dispense_count int, "
        "total_base_cost decimal(18,2), total_payer_coverage decimal(18,2), "
        "total_out_of_pocket decimal(18,2), load_dts timestamp_ntz"
    ),
}

CONTROL: dict[str, T.StructType] = {
    "etl_control": _fields(
        "table_name string, last_batch_id string, last_loaded_at timestamp_ntz, "
        "rows_loaded bigint, status string"
    ),
    "etl_run_log": _fields(
        "log_id string, proc_name string, batch_id string, start_time timestamp_ntz, "
        "end_time timestamp_ntz, status string, rows_affected bigint, error_msg string, "
        "params string, created_at timestamp_ntz"
    ),
}

# Uniqueness contracts: table -> key columns (rows with a NULL in a key of the
# last entry are exempt).
UNIQUE = {
    "dim_date": ("full_date",),
    "dim_condition_code": ("code",),
    "dim_medication": ("medication_code",),
    "fact_encounter": ("encounter_id",),
    "fact_medication_daily": ("date_key", "medication_key", "organization_key", "payer_key"),
}

# Referential contracts: (fact, column) -> (dimension, key).
FOREIGN_KEYS = {
    ("fact_encounter", "encounter_date_key"): ("dim_date", "date_key"),
    ("fact_encounter", "patient_key"): ("dim_patient", "patient_key"),
    ("fact_encounter", "provider_key"): ("dim_provider", "provider_key"),
    ("fact_encounter", "payer_key"): ("dim_payer", "payer_key"),
    ("fact_encounter", "organization_key"): ("dim_organization", "organization_key"),
    ("fact_encounter_daily", "date_key"): ("dim_date", "date_key"),
    ("fact_encounter_daily", "organization_key"): ("dim_organization", "organization_key"),
    ("fact_encounter_daily", "payer_key"): ("dim_payer", "payer_key"),
    ("fact_condition", "patient_key"): ("dim_patient", "patient_key"),
    ("fact_condition", "start_date_key"): ("dim_date", "date_key"),
    ("fact_condition", "condition_code_key"): ("dim_condition_code", "condition_code_key"),
    ("fact_condition", "organization_key"): ("dim_organization", "organization_key"),
    ("fact_condition_daily", "date_key"): ("dim_date", "date_key"),
    ("fact_condition_daily", "condition_code_key"): ("dim_condition_code", "condition_code_key"),
    ("fact_condition_daily", "organization_key"): ("dim_organization", "organization_key"),
    ("fact_medications", "patient_key"): ("dim_patient", "patient_key"),
    ("fact_medications", "medication_key"): ("dim_medication", "medication_key"),
    ("fact_medications", "start_date_key"): ("dim_date", "date_key"),
    ("fact_medications", "organization_key"): ("dim_organization", "organization_key"),
    ("fact_medications", "payer_key"): ("dim_payer", "payer_key"),
    ("fact_medication_daily", "date_key"): ("dim_date", "date_key"),
    ("fact_medication_daily", "medication_key"): ("dim_medication", "medication_key"),
    ("fact_medication_daily", "organization_key"): ("dim_organization", "organization_key"),
    ("fact_medication_daily", "payer_key"): ("dim_payer", "payer_key"),
}
