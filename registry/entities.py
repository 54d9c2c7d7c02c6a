"""The given tables rendered as the eight text extracts.

Every source row becomes an entity row. The text is made untidy on purpose
(padding, control characters, blanks, over-long and unreadable values), so that
cleaning has something to do.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.schemas import ENTITIES
from carestar.sources.landing import stamped

FIRST_BATCH = ("batch-1", dt.datetime(2024, 2, 1))
SECOND_BATCH = ("batch-2", dt.datetime(2024, 3, 1))

# Landing tables that a second extract run brings news for.
IN_SECOND_BATCH = ("landing_encounters", "landing_conditions", "landing_medications")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _rows(df: DataFrame, name: str, values: dict[str, str]) -> DataFrame:
    columns = ENTITIES[name].column_names
    return df.selectExpr(*[f"{values.get(c, chr(39) * 2)} AS {c}" for c in columns])


def _money(value: str) -> str:
    return f"CAST(CAST({value} AS DECIMAL(18,2)) AS STRING)"


def _homes(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their nation, of which there are a few dozen."""
    nations = table(spark, folder, "nation")
    return table(spark, folder, "customer").join(nations, F.expr("c_nationkey = n_nationkey"))


def patients(spark: SparkSession, folder: str) -> DataFrame:
    regions = table(spark, folder, "region")
    return _rows(
        _homes(spark, folder).join(regions, F.expr("n_regionkey = r_regionkey")),
        "patients",
        {
            "Id": "if(c_custkey % 5 = 0, concat('  P', c_custkey, ' '), concat('P', c_custkey))",
            "BIRTHDATE": """CASE WHEN c_custkey % 10 = 3 THEN ''
                WHEN c_custkey % 23 = 0 THEN 'unreadable'
                ELSE concat(1940 + c_custkey % 60, '-0', 1 + c_custkey % 9, '-1', c_custkey % 10)
                END""",
            "FIRST": "concat(' ', c_name, '  ')",
            "LAST": "n_name",
            "GENDER": "if(c_custkey % 2 = 0, 'Female', 'M')",
            "ADDRESS": "concat(c_name, char(9), n_name, char(13), char(10), c_mktsegment)",
            "CITY": "n_name",
            "STATE": "r_name",
            "COUNTY": "c_mktsegment",
            "ZIP": "lpad(CAST(c_custkey AS STRING), 12, '0')",
            "LAT": "concat(c_custkey % 90, '.125')",
            "HEALTHCARE_EXPENSES": _money("c_acctbal"),
            "HEALTHCARE_COVERAGE": """CASE WHEN c_custkey % 4 = 0 THEN ''
                WHEN c_custkey % 7 = 0 THEN 'n/a' ELSE concat(c_custkey % 1000, '.5') END""",
        },
    )


def organizations(spark: SparkSession, folder: str) -> DataFrame:
    staff = (
        table(spark, folder, "supplier")
        .groupBy("s_nationkey")
        .agg(
            F.sum(F.col("s_acctbal").cast("decimal(18,2)")).alias("revenue"),
            F.count(F.lit(1)).alias("staff"),
        )
    )
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.expr("n_regionkey = r_regionkey")
    )
    return _rows(
        nations.join(staff, F.expr("n_nationkey = s_nationkey"), "left"),
        "organizations",
        {
            "Id": "concat('O', n_nationkey)",
            "NAME": "concat(n_name, ' ')",
            "CITY": "n_name",
            "STATE": "r_name",
            "LAT": "concat(n_nationkey, '.0123456789')",
            "REVENUE": "coalesce(CAST(revenue AS STRING), '')",
            "UTILIZATION": "coalesce(CAST(staff AS STRING), '')",
        },
    )


def providers(spark: SparkSession, folder: str) -> DataFrame:
    return _rows(
        table(spark, folder, "supplier"),
        "providers",
        {
            "Id": "concat('V', s_suppkey)",
            "ORGANIZATION": "concat('O', s_nationkey)",
            "NAME": "s_name",
            "SPECIALITY": "concat('GROUP ', s_suppkey % 7)",
            "UTILIZATION": "CAST(s_suppkey % 50 AS STRING)",
        },
    )


def payers(spark: SparkSession, folder: str) -> DataFrame:
    members = (
        _homes(spark, folder)
        .groupBy("n_regionkey")
        .agg(
            F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("balance"),
            F.count(F.lit(1)).alias("members"),
        )
    )
    regions = table(spark, folder, "region")
    return _rows(
        regions.join(members, F.expr("r_regionkey = n_regionkey"), "left"),
        "payers",
        {
            "Id": "concat('Y', r_regionkey)",
            "NAME": "r_name",
            "STATE_HEADQUARTERED": "r_name",
            "AMOUNT_COVERED": "coalesce(CAST(balance AS STRING), '')",
            "REVENUE": "coalesce(CAST(balance AS STRING), '')",
            "UNIQUE_CUSTOMERS": "coalesce(CAST(members AS STRING), '')",
            "QOLS_AVG": "concat('0.', r_regionkey + 1, '2345')",
            "MEMBER_MONTHS": "coalesce(CAST(members AS STRING), '')",
        },
    )


def payer_transitions(spark: SparkSession, folder: str) -> DataFrame:
    return _rows(
        _homes(spark, folder),
        "payer_transitions",
        {
            "PATIENT": "concat('P', c_custkey)",
            "START_YEAR": "CAST(1995 + c_custkey % 5 AS STRING)",
            "END_YEAR": "CAST(1996 + c_custkey % 5 AS STRING)",
            "PAYER": "concat('Y', n_regionkey)",
            "OWNERSHIP": "c_mktsegment",
        },
    )


def encounters(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").join(
        _homes(spark, folder), F.expr("o_custkey = c_custkey")
    )
    suppliers = table(spark, folder, "supplier").agg(F.count(F.lit(1))).scalar()
    start = "(o_orderdate + make_dt_interval(0, CAST(o_orderkey % 24 AS INT)))"
    stop = f"({start} + make_dt_interval(CAST(o_orderkey % 4 AS INT)))"
    iso = "\"yyyy-MM-dd'T'HH:mm:ss'Z'\""
    return _rows(
        rows.withColumn("suppliers", suppliers),
        "encounters",
        {
            "Id": "concat('E', o_orderkey)",
            "START": f"date_format({start}, {iso})",
            "STOP": f"if(o_orderkey % 19 = 0, '', date_format({stop}, {iso}))",
            "PATIENT": "concat('P', o_custkey)",
            "ORGANIZATION": "concat('O', c_nationkey)",
            "PROVIDER": "if(o_orderkey % 17 = 0, '  ', concat('V', o_orderkey % suppliers))",
            "PAYER": "concat('Y', n_regionkey)",
            "ENCOUNTERCLASS": """if(o_orderpriority = '1-URGENT', 'inpatient',
                lower(o_orderpriority))""",
            "CODE": "o_orderstatus",
            "DESCRIPTION": "concat('stay', char(9), o_orderpriority, char(10))",
            "BASE_ENCOUNTER_COST": f"if(o_orderkey % 13 = 0, '', {_money('o_totalprice')})",
            "TOTAL_CLAIM_COST": _money("o_totalprice"),
            "PAYER_COVERAGE": """if(o_orderkey % 11 = 0, 'n/a',
                CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.5 AS DECIMAL(2,1)) AS STRING))""",
            "REASONCODE": "if(o_orderkey % 3 = 0, concat('R', o_orderkey % 10), '')",
        },
    )


def medications(spark: SparkSession, folder: str) -> DataFrame:
    # The orders find their homes first, so that the far more numerous items move once.
    orders = (
        table(spark, folder, "orders")
        .join(_homes(spark, folder), F.expr("o_custkey = c_custkey"))
        .select("o_orderkey", "o_custkey", "n_regionkey")
    )
    rows = table(spark, folder, "lineitem").join(orders, F.expr("l_orderkey = o_orderkey"))
    return _rows(
        rows,
        "medications",
        {
            "START": "date_format(l_shipdate, 'yyyy-MM-dd')",
            "STOP": """if(l_returnflag = 'N', '', date_format(
                date_add(CAST(l_shipdate AS DATE), CAST(l_quantity AS INT)), 'yyyy-MM-dd'))""",
            "PATIENT": "concat('P', o_custkey)",
            "PAYER": "if(l_linenumber = 7, '', concat('Y', n_regionkey))",
            "ENCOUNTER": "concat('E', l_orderkey)",
            "CODE": "if(l_partkey % 53 = 0, '', concat('M', l_partkey % 50))",
            "DESCRIPTION": "concat(' part', char(9), l_partkey % 50)",
            "BASE_COST": _money("l_extendedprice"),
            "PAYER_COVERAGE": """CAST(CAST(l_extendedprice AS DECIMAL(18,2))
                * CAST(l_discount AS DECIMAL(4,2)) AS STRING)""",
            "DISPENSES": "if(l_linenumber = 5, '', CAST(l_linenumber AS STRING))",
            "TOTALCOST": _money("l_extendedprice"),
            "REASONCODE": "l_returnflag",
        },
    )


def conditions(spark: SparkSession, folder: str) -> DataFrame:
    stays = table(spark, folder, "orders").agg(F.count(F.lit(1))).scalar()
    return _rows(
        table(spark, folder, "events").withColumn("stays", stays),
        "conditions",
        {
            "START": "date_format(ts, 'yyyy-MM-dd')",
            "STOP": """if(event_type = 'error', '', date_format(
                date_add(CAST(ts AS DATE), CAST(floor(value) AS INT) % 20 - 2), 'yyyy-MM-dd'))""",
            "PATIENT": "concat('P', user_id)",
            "ENCOUNTER": "concat('E', event_id % stays)",
            "CODE": "event_type",
            "DESCRIPTION": "concat(event_type, char(9), 'finding ')",
        },
    )


SOURCES = {
    "patients": patients,
    "encounters": encounters,
    "conditions": conditions,
    "medications": medications,
    "organizations": organizations,
    "providers": providers,
    "payers": payers,
    "payer_transitions": payer_transitions,
}


def landing(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The first batch of an entity, as landed."""
    return stamped(SOURCES[name](spark, folder), *FIRST_BATCH)


# The second snapshot: per entity the modulus that picks changed members, the
# tracked change and the untracked change.
CHANGES = {
    "patients": (7, ("CITY", "MOVED"), ("FIRST", "OTHER")),
    "organizations": (7, ("NAME", "RENAMED"), ("PHONE", "555")),
    "providers": (7, ("SPECIALITY", "MOVED"), ("NAME", "OTHER")),
    "payers": (3, ("REVENUE", "1.00"), ("PHONE", "555")),
}
DROPPED = 11
NEW_MEMBERS = 10


def _number(identifier: Column) -> Column:
    return F.regexp_extract(identifier, "([0-9]+)", 1).cast("bigint")


def changed(first: DataFrame, name: str) -> DataFrame:
    """The members of a snapshot with one tracked or untracked change on some."""
    modulus, (tracked, new_value), (untracked, other_value) = CHANGES[name]
    number = _number(F.col("Id"))
    return first.withColumn(
        tracked, F.when(number % modulus == 1, new_value).otherwise(F.col(tracked))
    ).withColumn(
        untracked, F.when(number % modulus == 2, other_value).otherwise(F.col(untracked))
    )


def second_snapshot(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Changed members, without the dropped ones, plus new ones."""
    first = SOURCES[name](spark, folder)
    number = _number(F.col("Id"))
    kept = changed(first, name).where(number % DROPPED != 0)
    new = first.where(number < NEW_MEMBERS).withColumn(
        "Id", F.concat(F.substring(F.trim("Id"), 1, 1), F.lit("N"), number.cast("string"))
    )
    return kept.unionByName(new)


def second_landing(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return stamped(second_snapshot(spark, folder, name), *SECOND_BATCH)
