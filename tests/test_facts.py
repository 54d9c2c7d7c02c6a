import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carestar.operators.clean import clean
from carestar.operators.dimensions import apply_versions
from carestar.plans import dims, facts
from carestar.schemas import ENTITIES
from carestar.sources.landing import stamped

NOW = dt.datetime(2024, 1, 1)
FIRST, LAST = dt.date(2020, 1, 1), dt.date(2020, 12, 31)


def staged(spark, name, *rows):
    entity = ENTITIES[name]
    full = [{**dict.fromkeys(entity.column_names, ""), **row} for row in rows]
    raw = spark.createDataFrame(full, entity.source_schema)
    return clean(stamped(raw, "b", NOW), entity)


@pytest.fixture(scope="module")
def warehouse(spark):
    rows = {
        "patients": staged(spark, "patients", {"Id": "p1"}, {"Id": "p2"}),
        "organizations": staged(spark, "organizations", {"Id": "o1"}),
        "providers": staged(spark, "providers", {"Id": "v1"}),
        "payers": staged(spark, "payers", {"Id": "y1"}),
        "payer_transitions": staged(
            spark, "payer_transitions",
            {"PATIENT": "p1", "PAYER": "y1", "OWNERSHIP": "A"},
            {"PATIENT": "p2", "PAYER": "y1", "OWNERSHIP": "B"},
        ),
    }
    tables = {}
    for dim in dims.HISTORY_DIMS:
        options = dims.history_options(dim, FIRST, NOW, "initial")
        made = apply_versions(dims.unknown_row(spark, dim, NOW), dim.source(rows), **options)
        tables[dim.table] = made.persist()
    return tables


def with_codes(spark, warehouse, dim, staging):
    first = dims.unknown_code_row(spark, dim, NOW)
    return {**warehouse, dim.table: first.unionByName(dims.code_additions(dim, first, staging, NOW))}


def test_payer_takes_its_greatest_ownership(spark, warehouse):
    owners = {r.payer_id: r.ownership for r in warehouse["dim_payer"].collect()}
    assert owners == {"UNKNOWN": None, "y1": "B"}


def encounters(spark):
    common = {"ORGANIZATION": "o1", "PAYER": "y1", "PROVIDER": "v1", "ENCOUNTERCLASS": "inpatient"}
    return staged(
        spark, "encounters",
        {"Id": "e1", "START": "2020-01-01T00:00:00Z", "PATIENT": "p1", **common,
         "TOTAL_CLAIM_COST": "10", "PAYER_COVERAGE": "4"},
        {"Id": "e2", "START": "2020-12-31T23:59:59Z", "PATIENT": "p2", "TOTAL_CLAIM_COST": "5"},
        {"Id": "e3", "START": "2021-01-01T00:00:00Z", "PATIENT": "p1", **common},
        {"Id": "e4", "START": "2020-05-05T00:00:00Z", "PATIENT": "lost", **common},
        {"Id": "e5", "START": "", "PATIENT": "p1", **common},
    )


def test_encounters_of_the_range(spark, warehouse):
    inputs = {"encounters": encounters(spark)}
    rows = {
        r.encounter_id: r
        for r in facts.fact_encounter(inputs, warehouse, FIRST, LAST, NOW).collect()
    }
    assert set(rows) == {"e1", "e2"}
    assert rows["e1"].out_of_pocket == Decimal("6.00") and rows["e1"].encounter_date_key == 20200101
    assert rows["e2"].provider_key is None and rows["e2"].organization_key is None
    assert rows["e2"].payer_coverage == 0 and rows["e2"].base_cost == 0
    lost = facts.rows_without_patient(
        facts.encounter_source(inputs["encounters"], FIRST, LAST), warehouse["dim_patient"],
        "encounter_date",
    )
    assert [r.encounter_id for r in lost.collect()] == ["e4"]


def test_missing_members_rules(spark, warehouse):
    inputs = {"encounters": encounters(spark)}
    rows = {
        r.encounter_id: r
        for r in facts.fact_encounter(inputs, warehouse, FIRST, LAST, NOW, "unknown").collect()
    }
    assert set(rows) == {"e1", "e2", "e4"}
    assert rows["e4"].patient_key == -1 and rows["e2"].provider_key == -1
    with pytest.raises(Exception, match="no patient as of the fact date: lost"):
        facts.fact_encounter(inputs, warehouse, FIRST, LAST, NOW, "error").collect()
    with pytest.raises(ValueError):
        facts.fact_encounter(inputs, warehouse, FIRST, LAST, NOW, "other")


def test_condition_stop_days(spark, warehouse):
    stops = {
        "1899-12-31": None, "1900-01-01": 19000101, "2099-12-31": 20991231, "2100-01-01": None,
        "": None, "2020-03-01": 20200301,
    }
    rows = [
        {"START": "2020-02-02", "STOP": stop, "PATIENT": "p1", "ENCOUNTER": "e1", "CODE": f"c{n}"}
        for n, stop in enumerate(stops)
    ]
    rows.append({"START": "2020-02-02", "PATIENT": "p1", "CODE": ""})
    conditions = staged(spark, "conditions", *rows)
    tables = with_codes(spark, warehouse, dims.CONDITION_CODE, conditions)
    found = facts.fact_condition(
        {"conditions": conditions, "encounters": encounters(spark)}, tables, FIRST, LAST, NOW
    ).collect()
    keys = {r.condition_code: r.stop_date_key for r in found}
    assert keys == {f"c{n}": key for n, key in enumerate(stops.values())}
    assert all(r.is_active == int(r.stop_date_key is None) for r in found)
    assert all(r.provider_key is not None and r.organization_key is not None for r in found)


def test_medications_fold_to_their_grain(spark, warehouse):
    common = {"START": "2020-02-02", "PATIENT": "p1", "ENCOUNTER": "e1", "PAYER": "y1"}
    medications = staged(
        spark, "medications",
        {**common, "CODE": "m", "STOP": "2020-03-01", "BASE_COST": "10", "DISPENSES": "2"},
        {**common, "CODE": "m", "STOP": "2020-04-01", "BASE_COST": "5", "PAYER_COVERAGE": "1"},
        {**common, "CODE": "m", "STOP": "", "BASE_COST": "bad"},
        {**common, "CODE": ""},
        {**common, "CODE": "m", "PATIENT": "lost"},
    )
    tables = with_codes(spark, warehouse, dims.MEDICATION, medications)
    found = facts.fact_medications(
        {"medications": medications, "encounters": encounters(spark)}, tables, FIRST, LAST, NOW
    )
    names = tables["dim_medication"].select("medication_key", "medication_code")
    rows = {r.medication_code: r for r in found.join(names, "medication_key").collect()}
    assert set(rows) == {"m", "UNKNOWN"} and found.count() == 2
    assert rows["m"].dispense_count == 4 and rows["m"].base_cost == 15
    assert rows["m"].out_of_pocket == 14 and rows["m"].stop_date_key == 20200401
    assert rows["UNKNOWN"].is_active == 1 and rows["UNKNOWN"].dispense_count == 1


def test_medication_span(spark):
    rows = staged(
        spark, "medications",
        {"PATIENT": "p", "START": "2020-05-01", "STOP": "2020-08-01"},
        {"PATIENT": "p", "START": "2020-09-01"},
        {"PATIENT": "p", "START": "1999-09-01", "STOP": "2050-01-01"},
    )
    assert facts.medication_span(rows, FIRST, LAST) == (dt.date(2020, 5, 1), dt.date(2020, 9, 1))
    nothing = facts.medication_span(rows, dt.date(2000, 1, 1), dt.date(2000, 1, 2))
    assert nothing == (dt.date(2000, 1, 1), dt.date(2000, 1, 2))


def test_case_blind_keys_meet(spark, warehouse):
    """Under a case-blind collation a fact finds its member whatever the case."""
    blind = {"collation": "UTF8_LCASE_RTRIM"}
    entity = ENTITIES["encounters"]
    row = {**dict.fromkeys(entity.column_names, ""), "Id": "e", "START": "2020-02-02", "PATIENT": "P1"}
    raw = stamped(spark.createDataFrame([row], entity.source_schema), "b", NOW)
    source = facts.encounter_source(clean(raw, entity, **blind), FIRST, LAST)
    members = warehouse["dim_patient"].withColumn(
        "patient_id", F.collate("patient_id", blind["collation"])
    )
    assert facts.rows_without_patient(source, members, "encounter_date").count() == 0
