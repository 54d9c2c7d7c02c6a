import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carestar.functions import text
from carestar.operators.clean import clean
from carestar.schemas import ENTITIES, MONEY, WHOLE
from carestar.sources.landing import stamped

NOW = dt.datetime(2024, 1, 1)


def landed(spark, name, *rows):
    entity = ENTITIES[name]
    full = [{**dict.fromkeys(entity.column_names, ""), **row} for row in rows]
    return stamped(spark.createDataFrame(full, entity.source_schema), "b", NOW), entity


def values(spark, expression, *inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "n int, x string")
    return [row.y for row in df.selectExpr("n", f"{expression} AS y").orderBy("n").collect()]


def test_trim_clip_blank(spark):
    rule = text.blank_to_null(text.clipped("x", 3))
    assert values(spark, rule, "  abc ", "abcd", "", "   ", None, "\tab") == [
        "abc", "abc", None, None, None, "\tab",
    ]


def test_control_characters_become_spaces(spark):
    rule = text.flattened("x")
    assert values(spark, rule, "a\tb\r\nc ", "a\\rb") == ["a b  c", "a\\rb"]
    literal = text.flattened("x", "literal")
    assert values(spark, literal, "a\tb", "a\\rb\\n") == ["a\tb", "a b "]
    with pytest.raises(ValueError):
        text.flattened("x", "other")


def test_numbers(spark):
    inputs = ("", " ", "12.345", "-12.345", "1,000", "abc", "1e3", "9" * 20, "+5", ".5", "7.")
    assert values(spark, text.to_number("x", MONEY), *inputs) == [
        None, None, Decimal("12.35"), Decimal("-12.35"), None, None, None, None,
        Decimal("5.00"), Decimal("0.50"), Decimal("7.00"),
    ]
    assert values(spark, text.to_number("x", WHOLE), "12", " 7 ", "12.7", "-3", "x") == [
        12, 7, None, -3, None,
    ]


def test_dates_and_moments(spark):
    day, moment = ENTITIES["conditions"].columns[0].spec, ENTITIES["encounters"].columns[1].spec
    assert values(spark, text.to_when("x", day), "", "2020-01-05", "2020-1-5", "no") == [
        None, dt.date(2020, 1, 5), dt.date(2020, 1, 5), None,
    ]
    assert values(spark, text.to_when("x", moment), "2019-02-17T05:07:38Z") == [
        dt.datetime(2019, 2, 17, 5, 7, 38)
    ]
    assert values(spark, text.to_when("x", day, "epoch1900"), "", " ", "no", "2020-01-05") == [
        dt.date(1900, 1, 1), dt.date(1900, 1, 1), None, dt.date(2020, 1, 5),
    ]


def test_blank_keys_are_dropped(spark):
    raw, entity = landed(spark, "patients", {"Id": ""}, {"Id": "  "}, {"Id": None}, {"Id": " p "})
    assert [r.Id for r in clean(raw, entity).collect()] == ["p"]
    raw, entity = landed(spark, "conditions", {"PATIENT": " "}, {"PATIENT": "p", "CODE": ""})
    assert [(r.PATIENT, r.CODE) for r in clean(raw, entity).collect()] == [("p", None)]


@pytest.mark.parametrize("name", ENTITIES)
def test_every_entity_has_its_staging_schema(spark, name):
    entity = ENTITIES[name]
    raw, _ = landed(spark, name, {entity.filter_column: "k"})
    typed = {f.name: f.dataType for f in clean(raw, entity).schema}
    wanted = {f.name: f.dataType for f in entity.staging_schema if f.name != "create_at"}
    assert typed == wanted


def test_widths_are_clipped(spark):
    raw, entity = landed(spark, "patients", {"Id": "i" * 40, "SSN": "1" * 12, "ZIP": "0" * 11})
    row = clean(raw, entity).first()
    assert (len(row.Id), len(row.SSN), len(row.ZIP)) == (36, 11, 10)


def test_case_blind_collation(spark):
    rows = [{"Id": "1", "CITY": "Rome"}, {"Id": "2", "CITY": "ROME "}, {"Id": "3", "CITY": "Oslo"}]
    raw, entity = landed(spark, "patients", *rows)
    blind = clean(raw, entity, collation="UTF8_LCASE_RTRIM")
    counts = {r["count"] for r in blind.groupBy("CITY").count().collect()}
    assert counts == {1, 2}
    assert blind.where(F.col("CITY") == "rome").count() == 2
    assert clean(raw, entity).where(F.col("CITY") == "rome").count() == 0


def test_cleaning_needs_no_shuffle(spark):
    raw, entity = landed(spark, "encounters", {"Id": "e"})
    plan = clean(raw, entity)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
