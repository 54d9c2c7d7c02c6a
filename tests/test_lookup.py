import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from carestar.operators.lookup import as_of_lookup, timeline

BASE = dt.date(2020, 1, 1)
DIM = "key long, id string, valid_from date, valid_to date"


def day(n):
    return BASE + dt.timedelta(days=n)


def look(spark, dim, facts):
    rows = spark.createDataFrame(facts, "n int, id string, at date")
    members = spark.createDataFrame(dim, DIM)
    found = as_of_lookup(
        rows, members, fact_key="id", on=F.col("at"), natural_key="id", surrogate_key="key"
    )
    return {r.n: r.key for r in found.collect()}


def brute(dim, facts):
    result = {}
    for n, member, at in facts:
        hits = [(f, k) for k, m, f, t in dim if m == member and m is not None and f <= at <= t]
        result[n] = max(hits)[1] if hits else None
    return result


def test_boundaries(spark):
    dim = [(1, "a", day(0), day(9)), (2, "a", day(10), day(20)), (3, "b", day(5), day(5))]
    facts = [
        (0, "a", day(0)), (1, "a", day(9)), (2, "a", day(10)), (3, "a", day(20)),
        (4, "a", day(21)), (5, "a", day(-1)), (6, "b", day(5)), (7, "none", day(5)), (8, None, day(5)),
    ]
    assert look(spark, dim, facts) == {0: 1, 1: 1, 2: 2, 3: 2, 4: None, 5: None, 6: 3, 7: None, 8: None}


def test_overlap_takes_the_newest(spark):
    same = [(1, "a", day(0), day(50)), (2, "a", day(0), day(99)), (3, "a", day(0), day(10))]
    facts = [(n, "a", day(n)) for n in (0, 10, 11, 50, 51, 99, 100)]
    assert look(spark, same, facts) == brute(same, facts)


@pytest.mark.parametrize("seed", range(3))
def test_random_nested_versions(spark, seed):
    rng = random.Random(seed)
    dim = []
    for key in range(1, 150):
        start = rng.randrange(60)
        dim.append((key, f"m{rng.randrange(12)}", day(start), day(start + rng.randrange(-3, 40))))
    facts = [(n, f"m{rng.randrange(14)}", day(rng.randrange(-5, 110))) for n in range(1500)]
    assert look(spark, dim, facts) == brute(dim, facts)


def test_ranges_are_disjoint(spark):
    dim = [(1, "a", day(0), day(30)), (2, "a", day(10), day(20)), (3, "a", day(15), day(25))]
    ranges = sorted(
        (r._from, r._to, r._key) for r in timeline(spark.createDataFrame(dim, DIM), "id", "key").collect()
    )
    assert ranges == [
        (day(0), day(9), 1), (day(10), day(14), 2), (day(15), day(20), 3), (day(21), day(25), 3),
        (day(26), day(30), 1),
    ]


def test_hot_member_is_split(spark):
    """Half of the facts share one member; the shuffle join splits that partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        members = spark.range(2000).select(
            F.col("id").alias("key"), F.concat(F.lit("m"), "id").alias("id"),
            F.lit(day(0)).alias("valid_from"), F.lit(day(99)).alias("valid_to"),
        )
        number = F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 2000)
        facts = spark.range(0, 200000, 1, 16).select(
            F.concat(F.lit("m"), number.cast("string")).alias("member"),
            F.lit(day(5)).alias("at"), F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        found = as_of_lookup(
            facts, members, fact_key="member", on=F.col("at"), natural_key="id", surrogate_key="key"
        )
        # Bring the rows home through the plan that ran, to see its final form.
        out = found.groupBy().agg(F.count("key"), F.count_if(F.col("key") == 7))
        assert tuple(out.collect()[0]) == (200000, 100100)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
