"""The registered queries again, as SQL over the given tables.

Written the plain way (pairing facts with days, window functions, set
operations), to check the library's plans against.
"""

from __future__ import annotations

from pyspark.sql import types as T

from carestar.schemas import ENTITIES, FOREIGN_KEYS, UNIQUE, Column

NOW, LATER = "2024-02-02 03:04:05", "2024-03-02 03:04:05"
BATCH_1, BATCH_2 = "2024-02-01 00:00:00", "2024-03-01 00:00:00"

# -- the text extracts --------------------------------------------------------

_HOMES = "customer JOIN nation ON c_nationkey = n_nationkey"
_START = "(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)))"
_PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"

_FROM = {
    "patients": f"{_HOMES} JOIN region ON n_regionkey = r_regionkey",
    "encounters": f"orders JOIN customer ON o_custkey = c_custkey "
    "JOIN nation ON c_nationkey = n_nationkey",
    "conditions": "events",
    "medications": "lineitem JOIN orders ON l_orderkey = o_orderkey "
    "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
    "organizations": "nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN ("
    "SELECT s_nationkey, sum(CAST(s_acctbal AS DECIMAL(18,2))) AS revenue, count(*) AS staff "
    "FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey",
    "providers": "supplier",
    "payers": "region LEFT JOIN (SELECT n_regionkey, sum(CAST(c_acctbal AS DECIMAL(18,2))) "
    f"AS balance, count(*) AS members FROM {_HOMES} GROUP BY 1) ON n_regionkey = r_regionkey",
    "payer_transitions": _HOMES,
}

_TEXT = {
    "patients": {
        "Id": "CASE WHEN c_custkey % 5 = 0 THEN '  P' || c_custkey || ' ' ELSE 'P' || c_custkey END",
        "BIRTHDATE": "CASE WHEN c_custkey % 10 = 3 THEN '' WHEN c_custkey % 23 = 0 THEN 'unreadable' "
        "ELSE (1940 + c_custkey % 60) || '-0' || (1 + c_custkey % 9) || '-1' || (c_custkey % 10) END",
        "FIRST": "' ' || c_name || '  '",
        "LAST": "n_name",
        "GENDER": "CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'M' END",
        "ADDRESS": "c_name || chr(9) || n_name || chr(13) || chr(10) || c_mktsegment",
        "CITY": "n_name",
        "STATE": "r_name",
        "COUNTY": "c_mktsegment",
        "ZIP": "lpad(CAST(c_custkey AS VARCHAR), 12, '0')",
        "LAT": "(c_custkey % 90) || '.125'",
        "HEALTHCARE_EXPENSES": "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR)",
        "HEALTHCARE_COVERAGE": "CASE WHEN c_custkey % 4 = 0 THEN '' WHEN c_custkey % 7 = 0 THEN 'n/a' "
        "ELSE (c_custkey % 1000) || '.5' END",
    },
    "encounters": {
        "Id": "'E' || o_orderkey",
        "START": f"strftime({_START}, '%Y-%m-%dT%H:%M:%SZ')",
        "STOP": "CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE strftime("
        f"{_START} + to_days(CAST(o_orderkey % 4 AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') END",
        "PATIENT": "'P' || o_custkey",
        "ORGANIZATION": "'O' || c_nationkey",
        "PROVIDER": "CASE WHEN o_orderkey % 17 = 0 THEN '  ' "
        "ELSE 'V' || (o_orderkey % (SELECT count(*) FROM supplier)) END",
        "PAYER": "'Y' || n_regionkey",
        "ENCOUNTERCLASS": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'inpatient' "
        "ELSE lower(o_orderpriority) END",
        "CODE": "o_orderstatus",
        "DESCRIPTION": "'stay' || chr(9) || o_orderpriority || chr(10)",
        "BASE_ENCOUNTER_COST": "CASE WHEN o_orderkey % 13 = 0 THEN '' "
        "ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END",
        "TOTAL_CLAIM_COST": "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)",
        "PAYER_COVERAGE": "CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' ELSE "
        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.5 AS DECIMAL(2,1)) AS VARCHAR) END",
        "REASONCODE": "CASE WHEN o_orderkey % 3 = 0 THEN 'R' || (o_orderkey % 10) ELSE '' END",
    },
    "conditions": {
        "START": "strftime(ts, '%Y-%m-%d')",
        "STOP": "CASE WHEN event_type = 'error' THEN '' ELSE strftime(CAST(ts AS DATE) + "
        "CAST(CAST(floor(value) AS INTEGER) % 20 - 2 AS INTEGER), '%Y-%m-%d') END",
        "PATIENT": "'P' || user_id",
        "ENCOUNTER": "'E' || (event_id % (SELECT count(*) FROM orders))",
        "CODE": "event_type",
        "DESCRIPTION": "event_type || chr(9) || 'finding '",
    },
    "medications": {
        "START": "strftime(l_shipdate, '%Y-%m-%d')",
        "STOP": "CASE WHEN l_returnflag = 'N' THEN '' ELSE "
        "strftime(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER), '%Y-%m-%d') END",
        "PATIENT": "'P' || o_custkey",
        "PAYER": "CASE WHEN l_linenumber = 7 THEN '' ELSE 'Y' || n_regionkey END",
        "ENCOUNTER": "'E' || l_orderkey",
        "CODE": "CASE WHEN l_partkey % 53 = 0 THEN '' ELSE 'M' || (l_partkey % 50) END",
        "DESCRIPTION": "' part' || chr(9) || (l_partkey % 50)",
        "BASE_COST": f"CAST({_PRICE} AS VARCHAR)",
        "PAYER_COVERAGE": f"CAST({_PRICE} * CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR)",
        "DISPENSES": "CASE WHEN l_linenumber = 5 THEN '' ELSE CAST(l_linenumber AS VARCHAR) END",
        "TOTALCOST": f"CAST({_PRICE} AS VARCHAR)",
        "REASONCODE": "l_returnflag",
    },
    "organizations": {
        "Id": "'O' || n_nationkey",
        "NAME": "n_name || ' '",
        "CITY": "n_name",
        "STATE": "r_name",
        "LAT": "n_nationkey || '.0123456789'",
        "REVENUE": "coalesce(CAST(revenue AS VARCHAR), '')",
        "UTILIZATION": "coalesce(CAST(staff AS VARCHAR), '')",
    },
    "providers": {
        "Id": "'V' || s_suppkey",
        "ORGANIZATION": "'O' || s_nationkey",
        "NAME": "s_name",
        "SPECIALITY": "'GROUP ' || (s_suppkey % 7)",
        "UTILIZATION": "CAST(s_suppkey % 50 AS VARCHAR)",
    },
    "payers": {
        "Id": "'Y' || r_regionkey",
        "NAME": "r_name",
        "STATE_HEADQUARTERED": "r_name",
        "AMOUNT_COVERED": "coalesce(CAST(balance AS VARCHAR), '')",
        "REVENUE": "coalesce(CAST(balance AS VARCHAR), '')",
        "UNIQUE_CUSTOMERS": "coalesce(CAST(members AS VARCHAR), '')",
        "QOLS_AVG": "'0.' || (r_regionkey + 1) || '2345'",
        "MEMBER_MONTHS": "coalesce(CAST(members AS VARCHAR), '')",
    },
    "payer_transitions": {
        "PATIENT": "'P' || c_custkey",
        "START_YEAR": "CAST(1995 + c_custkey % 5 AS VARCHAR)",
        "END_YEAR": "CAST(1996 + c_custkey % 5 AS VARCHAR)",
        "PAYER": "'Y' || n_regionkey",
        "OWNERSHIP": "c_mktsegment",
    },
}

# Second snapshot: modulus, tracked change, untracked change.
_CHANGES = {
    "patients": (7, "CITY", "MOVED", "FIRST", "OTHER"),
    "organizations": (7, "NAME", "RENAMED", "PHONE", "555"),
    "providers": (7, "SPECIALITY", "MOVED", "NAME", "OTHER"),
    "payers": (3, "REVENUE", "1.00", "PHONE", "555"),
}


def extract(name: str) -> str:
    text = _TEXT[name]
    columns = ", ".join(f"{text.get(c, chr(39) * 2)} AS {c}" for c in ENTITIES[name].column_names)
    return f"SELECT {columns} FROM {_FROM[name]}"


def _number(column: str) -> str:
    return f"CAST(regexp_extract({column}, '[0-9]+') AS BIGINT)"


def changed_extract(name: str) -> str:
    modulus, tracked, value, untracked, other = _CHANGES[name]
    number = _number("Id")
    return (
        f"SELECT * REPLACE (CASE WHEN {number} % {modulus} = 1 THEN '{value}' ELSE {tracked} END "
        f"AS {tracked}, CASE WHEN {number} % {modulus} = 2 THEN '{other}' ELSE {untracked} END "
        f"AS {untracked}) FROM ({extract(name)})"
    )


def second_extract(name: str) -> str:
    number = _number("Id")
    return (
        f"SELECT * FROM ({changed_extract(name)}) WHERE {number} % 11 <> 0 UNION ALL "
        f"SELECT * REPLACE (left(trim(Id, ' '), 1) || 'N' || {number} AS Id) "
        f"FROM ({extract(name)}) WHERE {number} < 10"
    )


# -- cleaning -----------------------------------------------------------------


def _sql_type(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision},{kind.scale})"
    return {T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP", T.IntegerType: "INTEGER"}[type(kind)]


def _rule(column: Column) -> str:
    name, spec = column.name, column.spec
    if column.rule == "id":
        return f"left(trim({name}, ' '), {spec})"
    if column.rule == "text":
        return f"nullif(left(trim({name}, ' '), {spec}), '')"
    if column.rule == "flat":
        flat = (
            f"left(translate(trim({name}, ' '), chr(13) || chr(10) || chr(9), '   '), {spec})"
        )
        return f"CASE WHEN trim({flat}, ' ') <> '' THEN {flat} END"
    if column.rule == "when":
        return f"try_cast({name} AS {_sql_type(spec)})"
    digits = "[0-9]+" if isinstance(spec, T.IntegerType) else r"([0-9]+\.?[0-9]*|\.[0-9]+)"
    return (
        f"CASE WHEN regexp_full_match({name}, ' *[+-]?{digits} *') "
        f"THEN try_cast({name} AS {_sql_type(spec)}) END"
    )


def clean(name: str, source: str | None = None) -> str:
    entity = ENTITIES[name]
    columns = ", ".join(f"{_rule(c)} AS {c.name}" for c in entity.columns)
    return (
        f"SELECT {columns} FROM ({source or extract(name)}) "
        f"WHERE trim({entity.filter_column}, ' ') <> ''"
    )


def stamped_clean(name: str) -> str:
    return (
        f"SELECT *, 'batch-1' AS batch_id, TIMESTAMP '{BATCH_1}' AS update_at FROM ({clean(name)})"
    )


def with_staging(*names: str, **extra: str) -> str:
    parts = [f"s_{name} AS MATERIALIZED ({clean(name)})" for name in names]
    parts += [f"{name} AS ({body})" for name, body in extra.items()]
    return "WITH " + ", ".join(parts) + " "


def key(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m%d') AS INTEGER)"


# -- dimensions ---------------------------------------------------------------

# Natural key, columns (name -> staging expression), tracked columns, unknown member.
_DIMS = {
    "patients": (
        "patient_id",
        {
            "patient_id": "Id",
            "first_name": "FIRST",
            "last_name": "LAST",
            "birthdate": "BIRTHDATE",
            "deathdate": "DEATHDATE",
            "gender": "GENDER",
            "race": "RACE",
            "ethnicity": "ETHNICITY",
            "city": "CITY",
            "state": "STATE",
            "zip": "ZIP",
            "county": "COUNTY",
            "healthcare_expenses": "HEALTHCARE_EXPENSES",
            "healthcare_coverage": "HEALTHCARE_COVERAGE",
            "birth_year": "CAST(year(BIRTHDATE) AS INTEGER)",
        },
        ("city", "state", "zip", "county", "deathdate", "healthcare_expenses", "healthcare_coverage"),
        {"first_name": "Unknown", "last_name": "Patient"},
    ),
    "organizations": (
        "organization_id",
        {
            "organization_id": "Id",
            "name": "NAME",
            "city": "CITY",
            "state": "STATE",
            "zip": "ZIP",
            "phone": "PHONE",
            "revenue": "REVENUE",
            "utilization": "UTILIZATION",
        },
        ("name", "city", "state", "revenue", "utilization"),
        {"name": "Unknown Organization"},
    ),
    "providers": (
        "provider_id",
        {
            "provider_id": "Id",
            "organization_id": "ORGANIZATION",
            "name": "NAME",
            "gender": "GENDER",
            "speciality": "SPECIALITY",
            "city": "CITY",
            "state": "STATE",
            "zip": "ZIP",
            "utilization": "UTILIZATION",
        },
        ("organization_id", "speciality", "city", "state", "utilization"),
        {"name": "Unknown Provider"},
    ),
    "payers": (
        "payer_id",
        {
            "payer_id": "Id",
            "name": "NAME",
            "city": "CITY",
            "state_headquartered": "STATE_HEADQUARTERED",
            "zip": "ZIP",
            "phone": "PHONE",
            "ownership": "(SELECT max(OWNERSHIP) FROM s_payer_transitions WHERE PAYER = Id)",
            "amount_covered": "AMOUNT_COVERED",
            "amount_uncovered": "AMOUNT_UNCOVERED",
            "revenue": "REVENUE",
            "unique_customers": "UNIQUE_CUSTOMERS",
            "member_months": "MEMBER_MONTHS",
        },
        ("ownership", "amount_covered", "revenue", "unique_customers"),
        {"name": "Unknown Payer"},
    ),
}


def _members(name: str, source: str) -> str:
    _, columns, tracked, _ = _DIMS[name]
    listed = ", ".join(f"{value} AS {column}" for column, value in columns.items())
    parts = ", ".join(f"coalesce(CAST({column} AS VARCHAR), '')" for column in tracked)
    return f"SELECT *, sha256(concat_ws('|', {parts})) AS row_hash FROM (SELECT {listed} FROM ({source}))"


def _history_with(name: str) -> str:
    staging = {"s_payer_transitions": clean("payer_transitions")} if name == "payers" else {}
    bodies = {
        **staging,
        "m1": _members(name, clean(name)),
        "m2": _members(name, clean(name, second_extract(name))),
    }
    return "WITH " + ", ".join(f"{k} AS MATERIALIZED ({v})" for k, v in bodies.items()) + " "


def _versions(name: str, as_of: str, later_from: str) -> str:
    nk, _, _, _ = _DIMS[name]
    return (
        "SELECT m1.*, DATE '1900-01-01' AS valid_from, "
        f"CASE WHEN m2.{nk} IS NOT NULL AND m2.row_hash <> m1.row_hash THEN DATE '{as_of}' - 1 "
        "ELSE DATE '9999-12-31' END AS valid_to, "
        f"NOT (m2.{nk} IS NOT NULL AND m2.row_hash <> m1.row_hash) AS is_current "
        f"FROM m1 LEFT JOIN m2 ON m1.{nk} = m2.{nk} UNION ALL "
        f"SELECT m2.*, CASE WHEN m1.{nk} IS NULL THEN DATE '1900-01-01' ELSE DATE '{later_from}' END, "
        "DATE '9999-12-31', true "
        f"FROM m2 LEFT JOIN m1 ON m1.{nk} = m2.{nk} "
        f"WHERE m1.{nk} IS NULL OR m1.row_hash <> m2.row_hash"
    )


def history(name: str) -> str:
    nk, columns, _, unknown = _DIMS[name]
    values = {nk: "UNKNOWN", **unknown}
    listed = ", ".join(f"'{values[c]}'" if c in values else "NULL" for c in columns)
    return (
        _history_with(name)
        + _versions(name, "2021-06-15", "1900-01-01")
        + f" UNION ALL SELECT {listed}, '00', DATE '1900-01-01', DATE '9999-12-31', true"
    )


def _lookup(later_from: str) -> str:
    with_part = _history_with("patients")
    return (
        with_part
        + f", v AS (SELECT *, row_number() OVER () AS n FROM ({_versions('patients', '1998-07-01', later_from)})), "
        f"e AS ({clean('encounters')}), "
        "c AS (SELECT e.Id AS encounter_id, e.PATIENT AS patient, CAST(e.START AS DATE) AS day, "
        "v.city, v.valid_from, v.is_current, row_number() OVER (PARTITION BY e.Id "
        "ORDER BY v.valid_from DESC, v.is_current DESC) AS rn FROM e LEFT JOIN v "
        "ON v.patient_id = e.PATIENT AND CAST(e.START AS DATE) BETWEEN v.valid_from AND v.valid_to) "
        "SELECT encounter_id, patient, day, city, valid_from, is_current FROM c WHERE rn = 1"
    )


# -- facts --------------------------------------------------------------------


def _clamped(stop: str) -> str:
    return f"CASE WHEN {stop} BETWEEN DATE '1900-01-01' AND DATE '2099-12-31' THEN {key(stop)} END"


_MEMBERS = ("patients", "providers", "organizations", "payers")

_ENCOUNTER_FACT = f"""
    SELECT p.Id AS patient_id, v.Id AS provider_id, o.Id AS organization_id, y.Id AS payer_id,
           {key('e.START')} AS encounter_date_key, e.Id AS encounter_id, e.CODE AS encounter_code,
           e.ENCOUNTERCLASS AS encounter_class, e.DESCRIPTION AS encounter_description,
           e.REASONCODE AS reason_code,
           CAST(coalesce(e.BASE_ENCOUNTER_COST, 0) AS DECIMAL(18,2)) AS base_cost,
           CAST(coalesce(e.TOTAL_CLAIM_COST, 0) AS DECIMAL(18,2)) AS total_claim_cost,
           CAST(coalesce(e.PAYER_COVERAGE, 0) AS DECIMAL(18,2)) AS payer_coverage,
           CAST(coalesce(e.TOTAL_CLAIM_COST, 0) - coalesce(e.PAYER_COVERAGE, 0) AS DECIMAL(19,2))
               AS out_of_pocket
    FROM s_encounters e JOIN s_patients p ON p.Id = e.PATIENT
    LEFT JOIN s_providers v ON v.Id = e.PROVIDER
    LEFT JOIN s_organizations o ON o.Id = e.ORGANIZATION
    LEFT JOIN s_payers y ON y.Id = e.PAYER
    WHERE CAST(e.START AS DATE) BETWEEN DATE '1900-01-01' AND DATE '2099-12-31'"""

_CONDITION_FACT = f"""
    SELECT p.Id AS patient_id, {key('c.START')} AS start_date_key, {_clamped('c.STOP')} AS stop_date_key,
           v.Id AS provider_id, o.Id AS organization_id, c.ENCOUNTER AS encounter_id, c.CODE AS code,
           c.CODE AS condition_code, c.DESCRIPTION AS condition_description,
           CASE WHEN {_clamped('c.STOP')} IS NULL THEN 1 ELSE 0 END AS is_active
    FROM s_conditions c LEFT JOIN s_encounters e ON e.Id = c.ENCOUNTER
    JOIN s_patients p ON p.Id = c.PATIENT
    LEFT JOIN s_providers v ON v.Id = e.PROVIDER
    LEFT JOIN s_organizations o ON o.Id = e.ORGANIZATION
    WHERE c.CODE IS NOT NULL AND c.START BETWEEN DATE '1900-01-01' AND DATE '2099-12-31'"""

_MEDICATION_FACT = f"""
    SELECT p.Id AS patient_id, g.medication_code, {key('g.start_date')} AS start_date_key,
           {_clamped('g.stop_date')} AS stop_date_key, v.Id AS provider_id, o.Id AS organization_id,
           y.Id AS payer_id, g.encounter_id, g.reason_code, g.base_cost, g.payer_coverage,
           g.dispense_count, CASE WHEN {_clamped('g.stop_date')} IS NULL THEN 1 ELSE 0 END AS is_active,
           CAST(g.base_cost - g.payer_coverage AS DECIMAL(19,2)) AS out_of_pocket
    FROM (SELECT m.PATIENT AS patient_id, m.START AS start_date,
                 coalesce(m.CODE, 'UNKNOWN') AS medication_code, max(m.STOP) AS stop_date,
                 max(m.PAYER) AS payer_id, max(m.ENCOUNTER) AS encounter_id,
                 max(m.REASONCODE) AS reason_code, max(e.PROVIDER) AS provider_id,
                 max(e.ORGANIZATION) AS organization_id,
                 CAST(sum(coalesce(m.BASE_COST, 0)) AS DECIMAL(18,2)) AS base_cost,
                 CAST(sum(coalesce(m.PAYER_COVERAGE, 0)) AS DECIMAL(18,2)) AS payer_coverage,
                 CAST(sum(coalesce(m.DISPENSES, 1)) AS INTEGER) AS dispense_count
          FROM s_medications m LEFT JOIN s_encounters e ON e.Id = m.ENCOUNTER
          WHERE m.START BETWEEN DATE '1900-01-01' AND DATE '2099-12-31'
          GROUP BY 1, 2, 3) g
    JOIN s_patients p ON p.Id = g.patient_id
    LEFT JOIN s_providers v ON v.Id = g.provider_id
    LEFT JOIN s_organizations o ON o.Id = g.organization_id
    LEFT JOIN s_payers y ON y.Id = g.payer_id"""


def _days(first: str, last: str) -> str:
    return (
        f"(SELECT {key('d')} AS date_key FROM (SELECT CAST(unnest(generate_series("
        f"TIMESTAMP '{first}', TIMESTAMP '{last}', INTERVAL 1 DAY)) AS DATE) AS d))"
    )


def _encounter_daily(fact: str) -> str:
    return f"""
    SELECT encounter_date_key AS date_key, organization_id, payer_id, encounter_class,
           CAST(count(*) AS INTEGER) AS encounter_count,
           CAST(count(DISTINCT patient_id) AS INTEGER) AS unique_patient_count,
           CAST(sum(base_cost) AS DECIMAL(18,2)) AS total_base_cost,
           CAST(sum(total_claim_cost) AS DECIMAL(18,2)) AS total_claim_cost,
           CAST(sum(payer_coverage) AS DECIMAL(18,2)) AS total_payer_coverage,
           CAST(sum(out_of_pocket) AS DECIMAL(18,2)) AS total_out_of_pocket,
           CAST(count(*) FILTER (encounter_class = 'inpatient') AS INTEGER) AS hospitalized_count,
           0 AS total_los_days
    FROM {fact} WHERE organization_id IS NOT NULL AND payer_id IS NOT NULL
    GROUP BY 1, 2, 3, 4"""


def _condition_daily(first: str, last: str, earlier: str = "0") -> str:
    low, high = first.replace("-", ""), last.replace("-", "")
    return f"""
    SELECT date_key, code, organization_id, new_cases, active_cases, resolved_cases,
           CAST({earlier} + sum(new_cases) OVER (PARTITION BY code, organization_id ORDER BY date_key
                ROWS UNBOUNDED PRECEDING) AS INTEGER) AS cumulative_cases, hospitalized_cases
    FROM (SELECT d.date_key, f.code, f.organization_id,
                 CAST(count(*) FILTER (f.start_date_key = d.date_key) AS INTEGER) AS new_cases,
                 CAST(count(*) FILTER (f.stop_date_key = d.date_key) AS INTEGER) AS resolved_cases,
                 CAST(count(*) FILTER (f.start_date_key <= d.date_key AND
                      (f.stop_date_key > d.date_key OR f.stop_date_key IS NULL)) AS INTEGER)
                      AS active_cases,
                 CAST(count(*) FILTER (e.encounter_class = 'inpatient' AND f.start_date_key <= d.date_key
                      AND (f.stop_date_key >= d.date_key OR f.stop_date_key IS NULL)) AS INTEGER)
                      AS hospitalized_cases
          FROM f_condition f CROSS JOIN {_days(first, last)} d
          LEFT JOIN f_encounter e ON e.encounter_id = f.encounter_id
          WHERE f.start_date_key <= {high} AND f.organization_id IS NOT NULL
          GROUP BY 1, 2, 3) day
    WHERE new_cases > 0 OR active_cases > 0 OR resolved_cases > 0 OR hospitalized_cases > 0
    """.replace("{low}", low)


_EARLIER = (
    "(SELECT count(*) FROM f_condition x WHERE x.code = day.code "
    "AND x.organization_id = day.organization_id AND x.start_date_key < 20240116)"
)


def _medication_daily(first: str, last: str) -> str:
    high = last.replace("-", "")
    return f"""
    SELECT * FROM (
      SELECT d.date_key, f.medication_code, f.organization_id, f.payer_id,
        CAST(count(DISTINCT f.patient_id) FILTER (f.start_date_key <= d.date_key AND
          (f.stop_date_key IS NULL OR f.stop_date_key > d.date_key)) AS INTEGER) AS active_patient_count,
        CAST(count(*) FILTER (f.start_date_key = d.date_key) AS INTEGER) AS new_prescriptions,
        CAST(count(*) FILTER (f.stop_date_key = d.date_key) AS INTEGER) AS stopped_prescriptions,
        CAST(coalesce(sum(dispense_count) FILTER (f.start_date_key = d.date_key), 0) AS INTEGER)
          AS total_dispense_count,
        CAST(coalesce(sum(base_cost) FILTER (f.start_date_key = d.date_key), 0) AS DECIMAL(18,2))
          AS total_base_cost,
        CAST(coalesce(sum(payer_coverage) FILTER (f.start_date_key = d.date_key), 0) AS DECIMAL(18,2))
          AS total_payer_coverage,
        CAST(coalesce(sum(base_cost - payer_coverage) FILTER (f.start_date_key = d.date_key), 0)
          AS DECIMAL(18,2)) AS total_out_of_pocket
      FROM f_medications f CROSS JOIN {_days(first, last)} d
      WHERE f.start_date_key <= {high}
      GROUP BY 1, 2, 3, 4)
    WHERE new_prescriptions > 0 OR stopped_prescriptions > 0 OR active_patient_count > 0
       OR total_dispense_count > 0 OR total_base_cost > 0"""


def _date(column: str) -> str:
    return f"CAST(strptime(CAST({column} AS VARCHAR), '%Y%m%d') AS DATE)"


# Prescriptions of one day each, as (group, patient, day) rows of the days they are open.
def _open_days(first: str, last: str) -> str:
    return f"""
    SELECT DISTINCT medication_code, organization_id, payer_id, patient_id,
           CAST(unnest(generate_series(CAST(greatest({_date('start_date_key')}, DATE '{first}') AS TIMESTAMP),
             CAST(least(coalesce({_date('stop_date_key')} - 1, DATE '{last}'), DATE '{last}') AS TIMESTAMP),
             INTERVAL 1 DAY)) AS DATE) AS day
    FROM f_medications WHERE start_date_key <= {last.replace('-', '')}"""


def _medication_years(*ranges: tuple[str, str]) -> str:
    rows = " UNION ALL ".join(f"SELECT * FROM ({_medication_rows(*days)})" for days in ranges)
    return (
        _with_facts("f_medications")
        + f"""
    SELECT CAST(year(day) AS INTEGER) AS year, medication_code, count(*) AS n_rows,
           sum(active_patient_count) AS active_patient_count, sum(new_prescriptions) AS new_prescriptions,
           sum(stopped_prescriptions) AS stopped_prescriptions,
           sum(total_dispense_count) AS total_dispense_count, sum(total_base_cost) AS total_base_cost,
           sum(total_payer_coverage) AS total_payer_coverage,
           sum(total_base_cost - total_payer_coverage) AS total_out_of_pocket
    FROM ({rows}) GROUP BY 1, 2"""
    )


def _medication_rows(first: str, last: str) -> str:
    """Daily rows by unfolding each prescription, for ranges too long to pair up."""
    low, high = first.replace("-", ""), last.replace("-", "")
    return f"""
    SELECT medication_code, organization_id, payer_id, day,
           sum(a) AS active_patient_count, sum(n) AS new_prescriptions, sum(s) AS stopped_prescriptions,
           sum(dc) AS total_dispense_count, sum(bc) AS total_base_cost, sum(pc) AS total_payer_coverage
    FROM (
      SELECT medication_code, organization_id, payer_id, day, 1 AS a, 0 AS n, 0 AS s, 0 AS dc,
             CAST(0 AS DECIMAL(18,2)) AS bc, CAST(0 AS DECIMAL(18,2)) AS pc
      FROM ({_open_days(first, last)})
      UNION ALL
      SELECT medication_code, organization_id, payer_id, {_date('start_date_key')}, 0, 1, 0,
             dispense_count, base_cost, payer_coverage
      FROM f_medications WHERE start_date_key BETWEEN {low} AND {high}
      UNION ALL
      SELECT medication_code, organization_id, payer_id, {_date('stop_date_key')}, 0, 0, 1, 0, 0, 0
      FROM f_medications WHERE stop_date_key BETWEEN {low} AND {high} AND start_date_key <= {high})
    GROUP BY 1, 2, 3, 4"""


def _with_facts(*facts: str) -> str:
    bodies = {
        "f_encounter": _ENCOUNTER_FACT,
        "f_condition": _CONDITION_FACT,
        "f_medications": _MEDICATION_FACT,
    }
    wanted = [*_MEMBERS, "encounters"]
    wanted += ["conditions"] if "f_condition" in facts else []
    wanted += ["medications"] if "f_medications" in facts else []
    parts = [f"s_{name} AS MATERIALIZED ({clean(name)})" for name in wanted]
    parts += [f"{fact} AS MATERIALIZED ({bodies[fact]})" for fact in facts]
    return "WITH " + ", ".join(parts)


def _audit_dropped() -> str:
    """Rows of patients that were missing, but for the two years that were loaded again."""
    sources = {
        "fact_encounter": "SELECT PATIENT AS patient_id, Id AS encounter_id, CODE AS code, "
        "CAST(START AS DATE) AS fact_date FROM s_encounters",
        "fact_condition": "SELECT PATIENT, ENCOUNTER, CODE, START FROM s_conditions WHERE CODE IS NOT NULL",
        "fact_medications": "SELECT PATIENT, max(ENCOUNTER), coalesce(CODE, 'UNKNOWN') AS code, START "
        "FROM s_medications GROUP BY PATIENT, START, CODE",
    }
    rows = " UNION ALL ".join(f"SELECT '{fact}' AS fact_table, * FROM ({body})" for fact, body in sources.items())
    return with_staging("patients", "encounters", "conditions", "medications") + f"""
    SELECT *, {key('fact_date')} AS date_key FROM ({rows})
    WHERE fact_date BETWEEN DATE '1900-01-01' AND DATE '2099-12-31'
      AND (patient_id IS NULL OR patient_id NOT IN (SELECT Id FROM s_patients WHERE Id IS NOT NULL)
           OR ({_number('patient_id')} % 9 = 0 AND NOT fact_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'))"""


# -- loads --------------------------------------------------------------------

_DIM_COUNTS = """
    SELECT 'dim_condition_code' AS table_name, 1 + (SELECT count(DISTINCT CODE) FROM s_conditions) AS n_rows
    UNION ALL SELECT 'dim_medication', 1 + (SELECT count(DISTINCT CODE) FROM s_medications)
    UNION ALL SELECT 'dim_patient', 1 + (SELECT count(*) FROM s_patients)
    UNION ALL SELECT 'dim_organization', 1 + (SELECT count(*) FROM s_organizations)
    UNION ALL SELECT 'dim_provider', 1 + (SELECT count(*) FROM s_providers)
    UNION ALL SELECT 'dim_payer', 1 + (SELECT count(*) FROM s_payers)"""


def _load_full() -> str:
    """Blank stops are 1900-01-01: nothing open, and one resolved row on that day."""
    blank = "coalesce({}, DATE '1900-01-01')"
    conditions = _CONDITION_FACT.replace("c.STOP", blank.format("c.STOP"))
    medications = _MEDICATION_FACT.replace("max(m.STOP)", f"max({blank.format('m.STOP')})")
    staged = [*_MEMBERS, "encounters", "conditions", "medications"]
    parts = [f"s_{name} AS MATERIALIZED ({clean(name)})" for name in staged]
    parts += [
        f"f_encounter AS MATERIALIZED ({_ENCOUNTER_FACT})",
        f"f_condition AS MATERIALIZED ({conditions})",
        f"f_medications AS MATERIALIZED ({medications})",
    ]
    # Stays count a condition's stop day; everything else ends the day before it.
    stays = f"""
        SELECT code, organization_id, CAST(unnest(generate_series(
                 CAST({_date('start_date_key')} AS TIMESTAMP),
                 CAST({_date('stop_date_key')} - CASE WHEN encounter_id IN (
                   SELECT encounter_id FROM f_encounter WHERE encounter_class = 'inpatient')
                   THEN 0 ELSE 1 END AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
        FROM f_condition WHERE organization_id IS NOT NULL
        UNION SELECT code, organization_id, {_date('start_date_key')} FROM f_condition
              WHERE organization_id IS NOT NULL
        UNION SELECT code, organization_id, {_date('stop_date_key')} FROM f_condition
              WHERE organization_id IS NOT NULL"""
    return (
        "WITH " + ", ".join(parts) + f"""
    SELECT table_name, CAST(n_rows AS BIGINT) AS n_rows FROM ({_DIM_COUNTS}
    UNION ALL SELECT 'dim_date', CAST(DATE '2099-12-31' - DATE '1900-01-01' AS BIGINT) + 1
    UNION ALL SELECT 'fact_encounter', (SELECT count(*) FROM f_encounter)
    UNION ALL SELECT 'fact_condition', (SELECT count(*) FROM f_condition)
    UNION ALL SELECT 'fact_medications', (SELECT count(*) FROM f_medications)
    UNION ALL SELECT 'fact_encounter_daily', (SELECT count(*) FROM ({_encounter_daily('f_encounter')}))
    UNION ALL SELECT 'fact_condition_daily', (SELECT count(*) FROM ({stays}))
    UNION ALL SELECT 'fact_medication_daily',
      (SELECT count(*) FROM ({_medication_rows('1900-01-01', '2099-12-31')})))"""
    )


def _load_partial() -> str:
    """Facts of the data years; conditions start later, so both their tables are empty."""
    last_stop = "(SELECT max(coalesce(STOP, START)) FROM s_medications)"
    return (
        "WITH "
        + ", ".join(
            [f"s_{n} AS MATERIALIZED ({clean(n)})" for n in (*_MEMBERS, "encounters", "conditions", "medications")]
            + [
                f"f_encounter AS MATERIALIZED ({_ENCOUNTER_FACT})",
                f"f_medications AS MATERIALIZED ({_MEDICATION_FACT})",
            ]
        )
        + f"""
    SELECT table_name, CAST(n_rows AS BIGINT) AS n_rows FROM ({_DIM_COUNTS}
    UNION ALL SELECT 'dim_date', CAST(greatest(DATE '2001-12-31', {last_stop}) - DATE '1995-01-01' AS BIGINT) + 1
      + CAST(DATE '2020-07-31' - DATE '2019-01-01' AS BIGINT) + 1
    UNION ALL SELECT 'fact_encounter', (SELECT count(*) FROM f_encounter)
    UNION ALL SELECT 'fact_condition', 0
    UNION ALL SELECT 'fact_medications', (SELECT count(*) FROM f_medications)
    UNION ALL SELECT 'fact_encounter_daily', (SELECT count(*) FROM ({_encounter_daily('f_encounter')}))
    UNION ALL SELECT 'fact_condition_daily', 0
    UNION ALL SELECT 'fact_medication_daily',
      (SELECT count(*) FROM ({_medication_rows('1995-01-01', '2001-12-31')}))
      + (SELECT count(*) FROM ({_medication_rows('2019-01-01', '2020-07-31')})))"""
    )


def _audit_references() -> str:
    number = "CAST(regexp_extract(encounter_id, '[0-9]+') AS BIGINT)"
    planted = {
        ("fact_encounter", "patient_key"): f"SELECT count(*) FROM f_encounter WHERE {number} % 7 = 0",
        ("fact_condition", "organization_key"): f"SELECT count(*) FROM f_condition WHERE {number} % 11 = 0",
        ("fact_medications", "medication_key"): f"SELECT count(*) FROM f_medications WHERE {number} % 13 = 0",
    }
    rows = " UNION ALL ".join(
        f"SELECT '{fact}' AS fact_table, '{column}' AS fact_column, '{dim}' AS dim_table, "
        f"CAST(({planted.get((fact, column), 'SELECT 0')}) AS BIGINT) AS orphan_rows"
        for (fact, column), (dim, _) in FOREIGN_KEYS.items()
    )
    return _with_facts("f_encounter", "f_condition", "f_medications") + f" SELECT * FROM ({rows})"


def _audit_keys() -> str:
    repeated = (
        "SELECT count(*) FROM f_encounter WHERE CAST(regexp_extract(encounter_id, '[0-9]+') AS BIGINT) % 7 = 0"
    )
    rows = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{','.join(keys)}' AS key_columns, "
        f"CAST(({repeated if table == 'fact_encounter' else 'SELECT 0'}) AS BIGINT) AS duplicated_keys"
        for table, keys in UNIQUE.items()
    )
    return _with_facts("f_encounter") + f" SELECT * FROM ({rows})"


_LOADS = (("years", "1995-01-01", "2001-12-31"), ("cases", "2024-01-01", "2024-12-31"),
          ("month", "1998-06-01", "1998-06-30"))


# -- the statements -----------------------------------------------------------


def _change_detect() -> str:
    parts = []
    for name, entity in ENTITIES.items():
        held = extract(name)
        source = changed_extract(name) if name == "patients" else held
        parts.append(
            f"SELECT '{entity.landing_table}' AS table_name, (SELECT count(*) FROM ({source})) AS n_source, "
            f"(SELECT count(*) FROM ({held})) AS n_landed, "
            f"(SELECT count(*) FROM ({source})) = (SELECT count(*) FROM ({held})) AS skip_by_rowcount, "
            f"NOT EXISTS (({source}) EXCEPT ALL ({held})) AND NOT EXISTS (({held}) EXCEPT ALL ({source})) "
            "AS skip_by_fingerprint"
        )
    return " UNION ALL ".join(parts)


def _contents() -> str:
    parts = []
    for name, entity in ENTITIES.items():
        cells = ", ".join(f"coalesce({c}, '')" for c in entity.column_names)
        parts.append(
            f"SELECT '{entity.landing_table}' AS table_name, md5(concat_ws(chr(31), {cells})) AS digest, "
            f"'batch-1' AS batch_id FROM ({extract(name)})"
        )
    return " UNION ALL ".join(parts)


def _extract_summary() -> str:
    loaded = " + ".join(
        f"(SELECT count(*) FROM ({extract(name)}))"
        for name in ENTITIES
        if name not in ("providers", "payer_transitions")
    )
    return (
        f"SELECT 'SUCCESS' AS status, 6 AS n_tables, {loaded} AS total_rows "
        "UNION ALL SELECT 'SKIP', 1, 0 UNION ALL SELECT 'FAILED', 1, 0"
    )


def _stream() -> str:
    second = clean("providers", second_extract("providers"))
    return (
        f"WITH a AS ({clean('providers')}), b AS ({second}) "
        f"SELECT b.*, CASE WHEN a.Id IS NULL THEN TIMESTAMP '{LATER}' ELSE TIMESTAMP '{NOW}' END AS create_at, "
        f"TIMESTAMP '{LATER}' AS update_at FROM b LEFT JOIN a ON a.Id = b.Id "
        f"UNION ALL SELECT a.*, TIMESTAMP '{NOW}', TIMESTAMP '{NOW}' FROM a "
        "WHERE a.Id NOT IN (SELECT Id FROM b)"
    )


def _upsert_by_id() -> str:
    second = clean("patients", second_extract("patients"))
    return (
        f"WITH a AS ({clean('patients')}), b AS ({second}) "
        f"SELECT b.*, CASE WHEN a.Id IS NULL THEN TIMESTAMP '{LATER}' ELSE TIMESTAMP '{NOW}' END AS create_at, "
        f"TIMESTAMP '{BATCH_2}' AS update_at, 'batch-2' AS batch_id FROM b LEFT JOIN a ON a.Id = b.Id "
        f"UNION ALL SELECT a.*, TIMESTAMP '{NOW}', TIMESTAMP '{BATCH_1}', 'batch-1' FROM a "
        "WHERE a.Id NOT IN (SELECT Id FROM b)"
    )


def _staging_incremental() -> str:
    number = _number("Id")
    second = (
        f"SELECT * REPLACE ('2001-02-03T04:05:06Z' AS START) FROM ({extract('encounters')}) WHERE {number} % 7 = 0 "
        f"UNION ALL SELECT * REPLACE ('N' || Id AS Id) FROM ({extract('encounters')}) WHERE {number} % 97 = 0"
    )
    return (
        f"WITH a AS ({clean('encounters')}), b AS ({clean('encounters', second)}) "
        f"SELECT b.*, CASE WHEN a.Id IS NULL THEN TIMESTAMP '{LATER}' ELSE TIMESTAMP '{NOW}' END AS create_at, "
        f"TIMESTAMP '{BATCH_2}' AS update_at, 'batch-2' AS batch_id FROM b LEFT JOIN a ON a.Id = b.Id "
        f"UNION ALL SELECT a.*, TIMESTAMP '{NOW}', TIMESTAMP '{BATCH_1}', 'batch-1' FROM a "
        "WHERE a.Id NOT IN (SELECT Id FROM b)"
    )


def _upsert_composite() -> str:
    return (
        f"WITH a AS ({clean('medications')}), "
        "b AS (SELECT * REPLACE (99 AS DISPENSES) FROM a WHERE REASONCODE = 'R') "
        f"SELECT b.*, TIMESTAMP '{NOW}' AS create_at, TIMESTAMP '{BATCH_2}' AS update_at, "
        "'batch-2' AS batch_id FROM b UNION ALL "
        f"SELECT a.*, TIMESTAMP '{NOW}', TIMESTAMP '{BATCH_1}', 'batch-1' FROM a WHERE NOT EXISTS ("
        "SELECT 1 FROM b WHERE b.PATIENT IS NOT DISTINCT FROM a.PATIENT "
        "AND b.START IS NOT DISTINCT FROM a.START AND b.CODE IS NOT DISTINCT FROM a.CODE)"
    )


def _control() -> str:
    second = "table_name IN ('landing_encounters', 'landing_conditions', 'landing_medications')"
    counts = " UNION ALL ".join(
        f"SELECT '{entity.landing_table}' AS table_name, (SELECT count(*) FROM ({extract(name)})) AS n"
        for name, entity in ENTITIES.items()
    )
    return (
        f"SELECT table_name, CASE WHEN {second} THEN 'batch-2' ELSE 'batch-1' END AS last_batch_id, "
        f"CASE WHEN {second} THEN TIMESTAMP '{LATER}' ELSE TIMESTAMP '{NOW}' END AS last_loaded_at, "
        f"n AS rows_loaded, 'SUCCESS' AS status FROM ({counts})"
    )


_CALENDAR = f"""
    SELECT {key('d')} AS date_key, d AS full_date, year(d) AS year, quarter(d) AS quarter,
           month(d) AS month, monthname(d) AS month_name, weekofyear(d) AS week_of_year,
           day(d) AS day_of_month, isodow(d) AS day_of_week, dayname(d) AS day_name,
           isodow(d) IN (6, 7) AS is_weekend
    FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION
          SELECT CAST(unnest(generate_series(low, high, INTERVAL 1 DAY)) AS DATE)
          FROM (SELECT min(l_shipdate) AS low, max(l_shipdate) AS high FROM lineitem))"""


def _unknown_members() -> str:
    parts = []
    for table, name, label in (
        ("dim_patient", "patients", "Unknown"),
        ("dim_organization", "organizations", "Unknown Organization"),
        ("dim_provider", "providers", "Unknown Provider"),
        ("dim_payer", "payers", "Unknown Payer"),
    ):
        parts.append(
            f"SELECT '{table}' AS table_name, false AS is_unknown, count(*) AS n_rows, "
            f"CAST(NULL AS VARCHAR) AS label FROM ({clean(name)}) "
            f"UNION ALL SELECT '{table}', true, 1, '{label}'"
        )
    return " UNION ALL ".join(parts)


def _islands() -> str:
    far = "DATE '9999-12-31'"
    return f"""
    WITH m AS (SELECT CODE, PATIENT, START AS s, coalesce(STOP, {far}) AS e FROM ({clean('medications')})),
    o AS (SELECT *, max(e) OVER (PARTITION BY CODE, PATIENT ORDER BY s, e
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM m WHERE e > s),
    n AS (SELECT *, sum(CASE WHEN reached IS NULL OR s > reached THEN 1 ELSE 0 END)
             OVER (PARTITION BY CODE, PATIENT ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM o)
    SELECT CODE, PATIENT, min(s) AS start, nullif(max(e), {far}) AS stop FROM n
    GROUP BY CODE, PATIENT, island"""


_OPEN_ORDERS = """
    WITH i AS (SELECT l_linestatus, CAST(l_shipdate AS DATE) AS a,
                      CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS b FROM lineitem),
    c AS (SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31',
                 INTERVAL 1 DAY)) AS DATE) AS day)
    SELECT * FROM (
      SELECT l_linestatus, day, count(*) FILTER (a = day) AS started,
             count(*) FILTER (b = day) AS stopped, count(*) FILTER (a <= day AND b > day) AS in_use,
             count(*) FILTER (a <= day AND b >= day) AS seen
      FROM i CROSS JOIN c WHERE a <= day AND b >= day GROUP BY 1, 2)
    WHERE started > 0 OR stopped > 0 OR in_use > 0 OR seen > 0"""


def _widths() -> str:
    parts = []
    for name, entity in ENTITIES.items():
        for column in entity.columns:
            missing = f"count(*) FILTER ({column.name} IS NULL)" if column.required else "0"
            parts.append(
                f"SELECT '{entity.landing_table}' AS table_name, '{column.name}' AS column_name, "
                f"count(*) FILTER (length({column.name}) > {column.width}) AS too_long, "
                f"{missing} AS missing FROM x_{name}"
            )
    views = ", ".join(f"x_{name} AS MATERIALIZED ({extract(name)})" for name in ENTITIES)
    return f"WITH {views} " + " UNION ALL ".join(parts)


def _unique() -> str:
    parts = []
    for name in ("patients", "encounters", "conditions", "medications"):
        keys = ", ".join(ENTITIES[name].keys)
        where = (
            " WHERE " + " AND ".join(f"{k} IS NOT NULL" for k in ENTITIES[name].keys)
            if name == "medications"
            else ""
        )
        parts.append(
            f"SELECT '{name}' AS table_name, '{','.join(ENTITIES[name].keys)}' AS key_columns, "
            f"count(*) AS duplicated_keys FROM (SELECT {keys} FROM ({clean(name)}){where} "
            f"GROUP BY {keys} HAVING count(*) > 1)"
        )
    return " UNION ALL ".join(parts)


def _foreign_keys() -> str:
    pairs = (
        ("encounters", "PATIENT", "patients"),
        ("encounters", "ORGANIZATION", "organizations"),
        ("encounters", "PROVIDER", "providers"),
        ("encounters", "PAYER", "payers"),
        ("conditions", "PATIENT", "patients"),
        ("conditions", "ENCOUNTER", "encounters"),
        ("medications", "PATIENT", "patients"),
        ("medications", "ENCOUNTER", "encounters"),
    )
    bodies = {
        f"s_{name}": clean(name)
        for name in ("encounters", "conditions", "medications", "organizations", "providers", "payers")
    }
    bodies["s_patients"] = clean("patients", second_extract("patients"))
    views = ", ".join(f"{view} AS MATERIALIZED ({body})" for view, body in bodies.items())
    return f"WITH {views} " + " UNION ALL ".join(
        f"SELECT '{fact}' AS fact_table, '{column}' AS fact_column, '{dim}' AS dim_table, "
        f"count(*) AS orphan_rows FROM s_{fact} WHERE {column} IS NOT NULL "
        f"AND {column} NOT IN (SELECT Id FROM s_{dim})"
        for fact, column, dim in pairs
    )


ORACLE = {
    "landing_ingest": f"SELECT *, TIMESTAMP '{BATCH_1}' AS create_at, TIMESTAMP '{BATCH_1}' AS update_at, "
    f"'batch-1' AS batch_id FROM ({extract('patients')})",
    "landing_contents": _contents(),
    "landing_change_detect": _change_detect(),
    "extract_summary": _extract_summary(),
    "stream_landing_upsert": _stream(),
    "stream_other_header": f"SELECT *, TIMESTAMP '{NOW}' AS create_at, TIMESTAMP '{NOW}' AS update_at, "
    f"TRUE AS second_failed FROM ({clean('providers')})",
    **{f"clean_{name}": stamped_clean(name) for name in ENTITIES},
    "clean_blank_dates": "SELECT coalesce(STOP, DATE '1900-01-01') AS STOP, count(*) AS n_rows "
    f"FROM ({clean('medications')}) GROUP BY 1",
    "clean_collated": f"SELECT count(*) AS n_rows FROM ({clean('encounters')})",
    "upsert_by_id": _upsert_by_id(),
    "upsert_composite": _upsert_composite(),
    "staging_incremental": _staging_incremental(),
    "control_upsert": _control(),
    "dim_date": _CALENDAR,
    "dim_condition_code": f"SELECT CODE AS code, max(DESCRIPTION) AS description FROM ({clean('conditions')}) "
    "WHERE CODE IS NOT NULL GROUP BY 1 UNION ALL SELECT 'UNKNOWN', 'Unknown Condition'",
    "dim_medication": "SELECT CODE AS medication_code, max(DESCRIPTION) AS medication_description "
    f"FROM ({clean('medications')}) WHERE CODE IS NOT NULL GROUP BY 1 "
    "UNION ALL SELECT 'UNKNOWN', 'Unknown Medication'",
    "dim_patient_scd2": history("patients"),
    "dim_organization_scd2": history("organizations"),
    "dim_provider_scd2": history("providers"),
    "dim_payer_scd2": history("payers"),
    "dim_unknown_members": _unknown_members(),
    "surrogate_keys": "SELECT m + 1 AS lowest, m + n AS highest, n AS n_rows, n AS n_keys FROM ("
    "SELECT (SELECT max(c_custkey) FROM customer) AS m, (SELECT count(*) FROM orders) AS n)",
    "asof_lookup": _lookup("1998-07-01"),
    "asof_lookup_overlap": _lookup("1900-01-01"),
    "semi_anti": "SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey "
    "AND o_orderstatus = 'F') AS has_order FROM customer",
    "fact_encounter": _with_facts("f_encounter") + " SELECT * FROM f_encounter",
    "fact_condition": _with_facts("f_condition") + " SELECT * FROM f_condition",
    "fact_medications": _with_facts("f_medications") + " SELECT * FROM f_medications",
    "medication_span": "SELECT min(START) AS low, max(coalesce(STOP, START)) AS high, "
    "CAST(max(coalesce(STOP, START)) - min(START) AS BIGINT) + 1 AS n_days "
    f"FROM ({clean('medications')})",
    "missing_patients": f"SELECT Id AS encounter_id, PATIENT AS patient_id FROM ({clean('encounters')}) "
    f"WHERE PATIENT NOT IN (SELECT Id FROM ({clean('patients', second_extract('patients'))}))",
    "fact_encounter_daily": _with_facts("f_encounter") + _encounter_daily("f_encounter"),
    "fact_condition_daily": _with_facts("f_encounter", "f_condition")
    + _condition_daily("2024-01-01", "2024-12-31"),
    "fact_condition_daily_history": _with_facts("f_encounter", "f_condition")
    + _condition_daily("2024-01-16", "2024-03-31", _EARLIER),
    "fact_medication_daily": _with_facts("f_medications")
    + _medication_daily("2001-05-01", "2001-11-30"),
    "fact_medication_daily_years": _medication_years(("1995-01-01", "2001-12-31")),
    "cumulative_cases": "SELECT event_type, day, new_cases, sum(new_cases) OVER (PARTITION BY event_type "
    "ORDER BY day ROWS UNBOUNDED PRECEDING) AS cumulative_cases FROM (SELECT event_type, "
    "CAST(ts AS DATE) AS day, count(*) AS new_cases FROM events GROUP BY 1, 2)",
    "treatment_islands": _islands(),
    "open_orders_daily": _OPEN_ORDERS,
    "replace_range": f"""
    WITH o AS (SELECT o_orderkey, {key('o_orderdate')} AS date_key, o_orderstatus FROM orders)
    SELECT * FROM o WHERE date_key NOT BETWEEN 19970115 AND 19970610
       AND date_key NOT BETWEEN 19990301 AND 19990331
    UNION ALL SELECT o_orderkey, date_key, 'X' FROM o
    WHERE date_key BETWEEN 19970115 AND 19970610 AND o_orderkey % 2 = 0""",
    "replace_range_frame": """
    SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders
    WHERE o_orderdate NOT BETWEEN TIMESTAMP '1997-01-15' AND TIMESTAMP '1997-06-10'
    UNION ALL SELECT o_orderkey, o_orderdate, 'X' FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-15' AND TIMESTAMP '1997-06-10'
      AND o_orderkey % 2 = 0""",
    "load_full": _load_full(),
    "load_partial": _load_partial(),
    "loaded_fact_encounter": _with_facts("f_encounter") + " SELECT * FROM f_encounter",
    "loaded_fact_condition": _with_facts("f_condition") + " SELECT * FROM f_condition",
    "loaded_fact_medications": _with_facts("f_medications") + " SELECT * FROM f_medications",
    "loaded_fact_condition_daily": _with_facts("f_encounter", "f_condition")
    + _condition_daily("2024-01-01", "2024-12-31"),
    "loaded_fact_medication_daily": _medication_years(("1995-01-01", "2001-12-31"), ("2024-01-01", "2024-12-31")),
    "loaded_fact_encounter_daily": _with_facts("f_encounter") + _encounter_daily("f_encounter"),
    "load_log": " UNION ALL ".join(
        f"SELECT 'warehouse_load' AS proc_name, '{batch}' AS batch_id, 'SUCCESS' AS status, "
        f"'FromDate={low};ToDate={high};AsOfDate=2021-06-15' AS params"
        for batch, low, high in _LOADS
    ),
    "audit_references": _audit_references(),
    "audit_keys": _audit_keys(),
    "audit_dropped": _audit_dropped(),
    "batch_guard": "SELECT 'B' || c_custkey AS batch_id, EXISTS (SELECT 1 FROM orders "
    "WHERE o_custkey = c_custkey AND o_orderpriority IN ('1-URGENT', '2-HIGH') "
    "AND o_orderstatus = 'F') AS skip FROM customer",
    "dq_width": _widths(),
    "dq_unique": _unique(),
    "dq_foreign_keys": _foreign_keys(),
    "text_functions": """
    SELECT doc_id, length(trim(text, ' ')) AS trimmed_length,
           md5(translate(trim(text, ' '), chr(13) || chr(10) || chr(9), '   ')) AS flat_md5,
           left(trim(text, ' '), 50) AS clipped,
           nullif(left(trim(source, ' '), 3), '') AS source,
           CASE WHEN regexp_full_match(left(trim(text, ' '), 4), ' *[+-]?[0-9]+ *')
                THEN try_cast(left(trim(text, ' '), 4) AS INTEGER) END AS number
    FROM documents""",
    "date_functions": f"""
    SELECT o_orderkey, {key('d')} AS date_key, d AS day, d + 30 AS plus_30, d - 1 AS day_before,
           CAST(d - DATE '1998-07-01' AS INTEGER) AS days_since,
           CASE WHEN CAST(d + INTERVAL 99 YEAR AS DATE) <= DATE '2099-12-31'
                THEN {key('CAST(d + INTERVAL 99 YEAR AS DATE)')} END AS bounded_key,
           year(d) AS year, quarter(d) AS quarter, weekofyear(d) AS week, isodow(d) AS weekday,
           monthname(d) AS month_name
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
    "row_hash": """
    SELECT c_custkey, sha256(concat_ws('|', coalesce(nullif(c_mktsegment, 'BUILDING'), ''),
           CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), '')) AS row_hash FROM customer""",
}
