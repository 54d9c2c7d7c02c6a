import datetime as dt

import pytest
from pyspark.sql import functions as F

from carestar.functions.dates import moment
from carestar.operators.dimensions import apply_versions, new_codes, unknown_version, with_unknown_member
from carestar.operators.surrogate import dense_ids, unique_ids
from carestar.plans import dims
from carestar.sources.literal import no_rows
from pyspark.sql import types as T

NOW = dt.datetime(2024, 1, 1)
OPEN, START = dt.date(9999, 12, 31), dt.date(1900, 1, 1)
SCHEMA = T.StructType(
    [
        T.StructField("key", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("valid_from", T.DateType()),
        T.StructField("valid_to", T.DateType()),
        T.StructField("is_current", T.BooleanType()),
        T.StructField("row_hash", T.StringType()),
        T.StructField("create_at", T.TimestampNTZType()),
        T.StructField("update_at", T.TimestampNTZType()),
    ]
)


def load(spark, dim, rows, as_of, valid_from="initial"):
    source = spark.createDataFrame(rows, "id string, city string, phone string")
    result = apply_versions(
        dim, source, natural_key="id", surrogate_key="key", tracked=["city"],
        as_of=as_of, now=moment(NOW), valid_from=valid_from,
    )
    return spark.createDataFrame(result.collect(), SCHEMA)


def facts_of(dim):
    rows = dim.collect()
    return {(r.id, r.city, r.phone, r.valid_from, r.valid_to, r.is_current) for r in rows}


@pytest.mark.parametrize("rule", ["initial", "as_of"])
def test_history_over_four_loads(spark, rule):
    d1, d2, d3 = (dt.date(2020, m, 1) for m in (1, 2, 3))
    later = (lambda day: START) if rule == "initial" else (lambda day: day)
    dim = load(spark, no_rows(spark, SCHEMA),
               [("a", "x", "1"), ("b", "x", "1"), ("c", "x", "1"), ("n", None, "1")], d1, rule)
    assert len({r.key for r in dim.collect()}) == 4
    # a: tracked change; b: untracked change only; c: missing; d: new; n: NULL stays NULL
    dim = load(spark, dim, [("a", "y", "1"), ("b", "x", "2"), ("d", "x", "1"), ("n", None, "1")], d2, rule)
    eve = d2 - dt.timedelta(days=1)
    assert facts_of(dim) == {
        ("a", "x", "1", START, eve, False),
        ("a", "y", "1", later(d2), OPEN, True),
        ("b", "x", "1", START, OPEN, True),
        ("c", "x", "1", START, OPEN, True),
        ("d", "x", "1", START, OPEN, True),
        ("n", None, "1", START, OPEN, True),
    }
    third = load(spark, dim, [("a", "z", "1"), ("n", "q", "1")], d3, rule)
    versions = [f for f in facts_of(third) if f[0] == "a"]
    assert [v[1] for v in sorted(versions, key=lambda v: v[4])] == ["x", "y", "z"]
    assert sum(f[5] for f in facts_of(third) if f[0] in "an") == 2
    again = load(spark, third, [("a", "z", "1"), ("n", "q", "1")], dt.date(2020, 4, 1), rule)
    assert facts_of(again) == facts_of(third)
    keys = [r.key for r in again.collect()]
    assert len(keys) == len(set(keys)) and min(keys) == 1 and max(keys) == len(keys)


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        load(spark, no_rows(spark, SCHEMA), [("a", "x", "1")], dt.date(2020, 1, 1), "other")


def test_codes_are_insert_only(spark):
    source = spark.createDataFrame(
        [("1", "b"), ("1", "c"), ("2", None), (None, "x"), ("3", "new")], "CODE string, D string"
    )
    held = spark.createDataFrame([("1", "kept")], "code string, description string")
    rows = new_codes(held, source, "CODE", "D", ("code", "description")).collect()
    assert sorted((r.code, r.description) for r in rows) == [("2", None), ("3", "new")]
    rows = new_codes(None, source, "CODE", "D", ("code", "description")).collect()
    assert ("1", "c") in {(r.code, r.description) for r in rows}


def test_unknown_member_once(spark):
    values = unknown_version("key", "id", {"city": "Unknown"}, NOW)
    dim = with_unknown_member(no_rows(spark, SCHEMA), "key", values)
    dim = with_unknown_member(dim, "key", values)
    assert [(r.key, r.id, r.row_hash) for r in dim.collect()] == [(-1, "UNKNOWN", "00")]
    for history in dims.HISTORY_DIMS:
        assert dims.unknown_row(spark, history, NOW).first()[history.surrogate_key] == -1
    for code in dims.CODE_DIMS:
        assert dims.unknown_code_row(spark, code, NOW).first()[code.code] == "UNKNOWN"


def test_dense_ids(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("name"))
    last = spark.range(1).select(F.max(F.lit(40))).scalar()
    first = {r.name: r.n for r in dense_ids(df, "n", ["name"], after=last).collect()}
    assert sorted(first.values()) == list(range(41, 5041))
    again = dense_ids(df.repartition(3), "n", ["name"], after=last)
    assert {r.name: r.n for r in again.collect()} == first


def test_unique_ids(spark):
    df = spark.range(1000).repartition(7).selectExpr("if(id < 3, id, NULL) AS n")
    ids = [r.n for r in unique_ids(df, "n", after=10).collect()]
    assert len(set(ids)) == 1000 and {0, 1, 2} < set(ids) and sorted(ids)[3] > 10
