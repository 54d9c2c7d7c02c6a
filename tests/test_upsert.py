import datetime as dt

from carestar.functions.dates import moment
from carestar.operators.upsert import insert_missing, newest_rows, upsert

T1, T2, T3 = (dt.datetime(2024, 1, day) for day in (1, 2, 3))
MADE, NOW = dt.datetime(2023, 1, 1), dt.datetime(2024, 2, 1)
TARGET = "k string, v string, update_at timestamp_ntz, create_at timestamp_ntz"
SOURCE = "k string, v string, update_at timestamp_ntz"


def apply(spark, target, source, **options):
    held = spark.createDataFrame(target, TARGET) if target is not None else None
    result = upsert(
        held, spark.createDataFrame(source, SOURCE), ["k"], now=moment(NOW), **options
    )
    return sorted(
        ((r.k, r.v, r.update_at, r.create_at) for r in result.collect()), key=lambda r: (r[0] or "", r[1])
    )


def test_newer_wins_equal_and_older_do_not(spark):
    target = [("a", "old", T2, MADE), ("b", "old", T2, MADE), ("c", "old", T2, MADE)]
    target.append(("stays", "old", T2, MADE))
    source = [("a", "new", T3), ("b", "new", T2), ("c", "new", T1), ("d", "new", T1)]
    assert apply(spark, target, source) == [
        ("a", "new", T3, MADE),
        ("b", "old", T2, MADE),
        ("c", "old", T2, MADE),
        ("d", "new", T1, NOW),
        ("stays", "old", T2, MADE),
    ]


def test_null_key_matches_null_key(spark):
    result = apply(spark, [(None, "old", T1, MADE)], [(None, "new", T2)])
    assert result == [(None, "new", T2, MADE)]


def test_one_row_per_key_takes_the_newest(spark):
    source = [("a", "1", T1), ("a", "2", T2), ("a", "2", T2), ("b", "1", T1)]
    assert apply(spark, None, source) == [("a", "2", T2, NOW), ("b", "1", T1, NOW)]


def test_all_rows_of_the_newest_batch(spark):
    source = [("a", "1", T1), ("a", "2", T2), ("a", "3", T2), (None, "n", T1), (None, "m", T1)]
    result = apply(spark, None, source, one_row_per_key=False)
    assert [(r[0], r[1]) for r in result] == [(None, "m"), (None, "n"), ("a", "2"), ("a", "3")]


def test_rerun_changes_nothing(spark):
    source = [("a", "1", T1), ("b", "1", T1)]
    first = apply(spark, None, source)
    again = apply(spark, first, source)
    assert again == first


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    source = spark.createDataFrame([("a", "1", T1)], SOURCE)
    plan = newest_rows(source, ["k"], "update_at", True)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_insert_missing(spark):
    held = spark.createDataFrame([("a",)], "k string")
    news = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    assert [tuple(r) for r in insert_missing(held, news, ["k"]).collect()] == [("b", 2)]
