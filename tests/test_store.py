import pytest
from pyspark.sql import functions as F

from carestar.sources.store import ConcurrentWrite, TableMissing, TableStore


def frame(spark, *keys, tag="a"):
    return spark.createDataFrame([(k, tag) for k in keys], "date_key int, tag string")


def content(store):
    return sorted((r.date_key, r.tag) for r in store.read("t").collect())


def load(store, df, low, high):
    return store.replace_keys("t", df, "date_key", low, high)


def test_missing_table(store):
    assert not store.exists("t") and store.read_or_none("t") is None
    with pytest.raises(TableMissing):
        store.read("t")


def test_replace_append_and_row_counts(spark, store):
    assert store.replace("t", frame(spark, 1, 2)) == 2
    assert store.append("t", frame(spark, 3)) == 1
    assert store.append("t", frame(spark).where("false")) == 0
    assert [k for k, _ in content(store)] == [1, 2, 3]
    assert store.replace("t", store.read("t").where("date_key > 1")) == 2
    assert [k for k, _ in content(store)] == [2, 3]


def test_a_plan_may_rewrite_what_it_reads(spark, store):
    store.replace("t", frame(spark, 1, 2))
    store.replace("t", store.read("t").withColumn("tag", F.lit("b")))
    assert content(store) == [(1, "b"), (2, "b")]


def test_range_reload(spark, store):
    days = [20200105, 20200120, 20200205, 20200220, 20200305, 20200320, 20210101]
    assert load(store, frame(spark, *days), 19000101, 20991231) == 7
    # A narrower range with fewer rows: edge months keep their rows outside it.
    assert load(store, frame(spark, 20200207, tag="b"), 20200115, 20200310) == 1
    assert content(store) == [
        (20200105, "a"), (20200207, "b"), (20200320, "a"), (20210101, "a"),
    ]
    # A range that receives no rows becomes empty.
    assert load(store, frame(spark).where("false"), 20200201, 20200331) == 0
    assert content(store) == [(20200105, "a"), (20210101, "a")]


def test_untouched_months_are_not_rewritten(spark, store):
    load(store, frame(spark, 20200105, 20200205, 20200305), 20200101, 20200331)
    before = set(store.snapshot("t").parts)
    load(store, frame(spark, 20200206, tag="b"), 20200201, 20200229)
    after = set(store.snapshot("t").parts)
    assert {p.split("/")[1] for p in before & after} == {"month_key=202001", "month_key=202003"}


def test_reading_opens_only_the_months_of_the_range(spark, store):
    load(store, frame(spark, 20200105, 20200205, 20200305), 20200101, 20200331)
    rows = store.read_months("t", 20200210, 20200331)
    assert sorted(r.date_key for r in rows.collect()) == [20200205, 20200305]
    assert all("202001" not in path for path in rows.inputFiles())
    assert store.read_months("t", 20300101, 20300131).count() == 0


def test_months_of_another_column_and_of_null(spark, store):
    df = spark.createDataFrame([("2020-01-05",), ("2020-02-05",), (None,)], "d string").selectExpr(
        "CAST(d AS date) AS d"
    )
    key = F.year("d") * 10000 + F.month("d") * 100 + F.dayofmonth("d")
    assert store.replace("t", df, month_of=key) == 3
    assert store.read("t").count() == 3
    assert store.read("t").schema == df.schema


def test_swap_keeps_other_partitions(spark, store):
    df = spark.createDataFrame([(1, True), (2, False)], "k int, is_current boolean")
    store.replace("t", df, "is_current")
    news = spark.createDataFrame([(1, False), (3, True)], "k int, is_current boolean")
    store.swap("t", news, "is_current", drop=lambda value: value == "true")
    assert sorted((r.k, r.is_current) for r in store.read("t").collect()) == [
        (1, False), (2, False), (3, True),
    ]


def test_failed_write_leaves_the_table(spark, store):
    store.replace("t", frame(spark, 1))
    bad = frame(spark, 2).withColumn("tag", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        store.replace("t", bad)
    assert content(store) == [(1, "a")]


def test_two_writers_of_one_version(spark, store):
    store.replace("t", frame(spark, 1))
    stale = store.snapshot("t")
    store.append("t", frame(spark, 2))
    with pytest.raises(ConcurrentWrite):
        store._publish("t", stale, [], stale.schema)
    assert [k for k, _ in content(store)] == [1, 2]


def test_collation_survives_storage(spark, store):
    df = spark.createDataFrame([("Rome",)], "city string").select(
        F.collate("city", "UTF8_LCASE_RTRIM").alias("city")
    )
    store.replace("t", df)
    again = TableStore(spark, store.root).read("t")
    assert again.where("city = 'ROME '").count() == 1
