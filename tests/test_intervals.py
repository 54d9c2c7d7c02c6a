import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from carestar.operators import intervals
from carestar.plans import daily

BASE = dt.date(2020, 1, 1)
NOW = dt.datetime(2024, 1, 1)
FIRST, LAST = BASE + dt.timedelta(days=20), BASE + dt.timedelta(days=60)


def day(n):
    return None if n is None else BASE + dt.timedelta(days=n)


def key(d):
    return None if d is None else d.year * 10000 + d.month * 100 + d.day


def span(first=FIRST, last=LAST):
    return [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]


def random_intervals(rng, n):
    for _ in range(n):
        start = rng.randrange(90)
        stop = rng.choice([None, start, start - 3, start + 1, start + rng.randrange(1, 60)])
        yield day(start), day(stop)


def conditions(spark, rows):
    return spark.createDataFrame(
        rows,
        "condition_code_key long, organization_key long, encounter_id string, "
        "start_date_key int, stop_date_key int",
    )


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("cumulative", ["range", "history"])
def test_condition_daily_equals_pairing(spark, seed, cumulative):
    rng = random.Random(seed)
    rows, truth = [], []
    for n, (start, stop) in enumerate(random_intervals(rng, 400)):
        code, org = rng.randrange(3), rng.choice([None, 1, 2])
        stay = rng.choice([None, "in", "out", "lost"])
        rows.append((code, org, stay, key(start), key(stop)))
        truth.append((code, org, stay == "in", start, stop))
    stays = spark.createDataFrame(
        [("in", "inpatient"), ("out", "wellness")], "encounter_id string, encounter_class string"
    )
    expected, total = {}, collections.Counter()
    if cumulative == "history":
        for code, org, _, start, _ in truth:
            total[code, org] += org is not None and start < FIRST
    for d in span():
        groups = collections.defaultdict(lambda: [0, 0, 0, 0])
        for code, org, inpatient, a, b in truth:
            if org is None or a > LAST:
                continue
            counts = groups[code, org]
            counts[0] += a == d
            counts[1] += a <= d and (b is None or b > d)
            counts[2] += b == d
            counts[3] += inpatient and a <= d and (b is None or b >= d)
        for group, (new, active, resolved, hospital) in groups.items():
            total[group] += new
            if new or active or resolved or hospital:
                expected[(key(d), *group)] = (new, active, resolved, total[group], hospital)
    result = daily.fact_condition_daily(
        conditions(spark, rows), stays, FIRST, LAST, NOW, cumulative
    ).collect()
    assert {
        (r.date_key, r.condition_code_key, r.organization_key): (
            r.new_cases, r.active_cases, r.resolved_cases, r.cumulative_cases, r.hospitalized_cases,
        )
        for r in result
    } == expected
    assert len(result) == len(expected)


@pytest.mark.parametrize("seed", range(3))
def test_medication_daily_equals_pairing(spark, seed):
    rng = random.Random(seed)
    rows, truth = [], []
    for start, stop in random_intervals(rng, 500):
        group = (rng.randrange(2), rng.choice([None, 1]), rng.choice([None, 5, 6]))
        patient, count = rng.randrange(6), rng.choice([None, 0, 3])
        cost, covered = rng.choice([None, 0, 10]), rng.choice([None, 4])
        rows.append((*group, patient, key(start), key(stop), count, cost, covered))
        truth.append((group, patient, start, stop, count or 0, cost or 0, covered or 0))
    frame = spark.createDataFrame(
        rows,
        "medication_key long, organization_key long, payer_key long, patient_key long, "
        "start_date_key int, stop_date_key int, dispense_count int, base_cost int, payer_coverage int",
    ).selectExpr(
        "* EXCEPT (base_cost, payer_coverage)",
        "CAST(base_cost AS decimal(18,2)) AS base_cost",
        "CAST(payer_coverage AS decimal(18,2)) AS payer_coverage",
    )
    expected = {}
    for d in span():
        groups = collections.defaultdict(lambda: [set(), 0, 0, 0, 0, 0])
        for group, patient, a, b, count, cost, covered in truth:
            if a > LAST:
                continue
            row = groups[group]
            if a <= d and (b is None or b > d):
                row[0].add(patient)
            row[1] += a == d
            row[2] += b == d
            if a == d:
                row[3] += count
                row[4] += cost
                row[5] += covered
        for group, (people, new, stopped, count, cost, covered) in groups.items():
            if people or new or stopped or count or cost:
                expected[(key(d), *group)] = (
                    len(people), new, stopped, count, cost, covered, cost - covered,
                )
    result = daily.fact_medication_daily(frame, FIRST, LAST, NOW).collect()
    assert {
        (r.date_key, r.medication_key, r.organization_key, r.payer_key): (
            r.active_patient_count, r.new_prescriptions, r.stopped_prescriptions,
            r.total_dispense_count, r.total_base_cost, r.total_payer_coverage, r.total_out_of_pocket,
        )
        for r in result
    } == expected
    assert len(result) == len(expected)


def test_islands_merge_touching_and_nested(spark):
    rows = [
        ("g", 1, day(0), day(5)), ("g", 1, day(5), day(8)),  # touching
        ("g", 1, day(10), day(20)), ("g", 1, day(12), day(15)),  # nested
        ("g", 1, day(30), day(30)), ("g", 1, day(31), day(29)),  # empty
        ("g", 1, day(40), None), ("g", 1, day(50), day(60)),  # open
        ("g", 2, day(0), day(1)), ("g", 2, day(0), day(3)),
    ]
    df = spark.createDataFrame(rows, "grp string, who int, a date, b date")
    found = intervals.islands(df, ["grp"], "who", F.col("a"), F.col("b")).collect()
    assert sorted((r.who, r.start, r.stop) for r in found) == [
        (1, day(0), day(8)), (1, day(10), day(20)), (1, day(40), None), (2, day(0), day(3)),
    ]


def test_daily_plans_pair_nothing_and_combine_before_the_shuffle(spark):
    cases = conditions(spark, [(1, 1, "e", 20200101, None)])
    stays = spark.createDataFrame([("e", "inpatient")], "encounter_id string, encounter_class string")
    plan = daily.fact_condition_daily(cases, stays, FIRST, LAST, NOW)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert "partial_sum" in text


def test_encounter_daily(spark):
    rows = [
        (1, 20200125, 1, 1, "inpatient", 10), (1, 20200125, 1, 1, "inpatient", 5),
        (2, 20200125, 1, 1, "inpatient", 1), (1, 20200125, 1, 1, "wellness", 2),
        (1, 20200125, None, 1, "inpatient", 9), (1, 20200125, 1, None, "inpatient", 9),
        (1, 20190101, 1, 1, "inpatient", 9),
    ]
    df = spark.createDataFrame(
        rows,
        "patient_key long, encounter_date_key int, organization_key long, payer_key long, "
        "encounter_class string, base_cost int",
    ).selectExpr(
        "*", "base_cost AS total_claim_cost", "0 AS payer_coverage", "base_cost AS out_of_pocket"
    )
    found = daily.fact_encounter_daily(df, FIRST, LAST, NOW).collect()
    assert sorted(
        (r.encounter_class, r.encounter_count, r.unique_patient_count, r.total_base_cost,
         r.hospitalized_count, r.total_los_days)
        for r in found
    ) == [("inpatient", 3, 2, 16, 3, 0), ("wellness", 1, 1, 2, 0, 0)]


def test_running_total(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 2, 3), ("b", 1, 5)], "g string, o int, m int")
    rows = intervals.running_total(df, ["g"], "o", "m", "t").collect()
    assert sorted((r.g, r.o, r.t) for r in rows) == [("a", 1, 2), ("a", 2, 5), ("b", 1, 5)]
