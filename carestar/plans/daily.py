"""Daily facts over a date range."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestar.functions.dates import date_key, day_of_key, key_of
from carestar.operators import intervals
from carestar.plans.facts import conform

HOSPITAL_CLASSES = ("inpatient",)


def _open_or_started(low: int) -> Column:
    """Facts that can show on or after ``low``: started since, still open, or closed since."""
    stop = F.col("stop_date_key")
    return stop.isNull() | (stop >= low) | (F.col("start_date_key") >= low)


def fact_encounter_daily(
    encounters: DataFrame, first: dt.date, last: dt.date, now: dt.datetime
) -> DataFrame:
    """Counts and sums per day, organization, payer and class."""
    rows = encounters.where(
        F.col("encounter_date_key").between(key_of(first), key_of(last))
        & F.col("organization_key").isNotNull()
        & F.col("payer_key").isNotNull()
    )
    hospital = F.col("encounter_class").isin(*HOSPITAL_CLASSES)
    # Rows move once, by group: left to itself, counting distinct patients moves nearly all of
    # them by group and patient, with sums that are wider than the rows, and then by group.
    group = ["date_key", "organization_key", "payer_key", "encounter_class"]
    rows = rows.withColumnRenamed("encounter_date_key", "date_key").repartition(*group)
    daily = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("encounter_count"),
        F.count_distinct("patient_key").alias("unique_patient_count"),
        F.sum("base_cost").alias("total_base_cost"),
        F.sum("total_claim_cost").alias("total_claim_cost"),
        F.sum("payer_coverage").alias("total_payer_coverage"),
        F.sum("out_of_pocket").alias("total_out_of_pocket"),
        F.sum(F.when(hospital, 1).otherwise(0)).alias("hospitalized_count"),
        F.lit(0).alias("total_los_days"),
    )
    return conform(daily, "fact_encounter_daily", now)


def fact_condition_daily(
    conditions: DataFrame,
    encounters: DataFrame,
    first: dt.date,
    last: dt.date,
    now: dt.datetime,
    cumulative: str = "range",
) -> DataFrame:
    """New, active, resolved and hospitalised cases per day, code and organization.

    The running total of new cases starts at the range; ``cumulative="history"``
    adds the cases that began before it, counted apart. Cases closed before the
    range are left out by the scan; so are stays of encounters without a case.
    """
    if cumulative not in ("range", "history"):
        raise ValueError(f"unknown cumulative rule {cumulative!r}")
    group = ["condition_code_key", "organization_key"]
    known = conditions.where(
        (F.col("start_date_key") <= key_of(last)) & F.col("organization_key").isNotNull()
    )
    cases = known.where(_open_or_started(key_of(first))).select(
        *group,
        "encounter_id",
        day_of_key(F.col("start_date_key")).alias("start"),
        day_of_key(F.col("stop_date_key")).alias("stop"),
    )
    wanted = cases.select(F.col("encounter_id").alias("_stay")).distinct()
    hospital = (
        encounters.where(F.col("encounter_class").isin(*HOSPITAL_CLASSES))
        .select(F.col("encounter_id").alias("_stay"))
        .join(wanted, "_stay", "left_semi")
    )
    cases = cases.join(hospital, cases["encounter_id"] == hospital["_stay"], "left")

    start, stop, one = F.col("start"), F.col("stop"), F.lit(1).cast("bigint")
    changes = [
        intervals.point_change(start, first, last, new_cases=one),
        intervals.point_change(stop, first, last, resolved_cases=one),
        *intervals.balance_changes(
            "active_cases", start, stop, first, last, stop_day_counts=False
        ),
        *intervals.balance_changes(
            "hospitalized_cases",
            start,
            stop,
            first,
            last,
            stop_day_counts=True,
            only=F.col("_stay").isNotNull(),
        ),
    ]
    totals = {"cumulative_cases": ["new_cases"]}
    measures = ["new_cases", "resolved_cases", "active_cases", "hospitalized_cases"]
    if cumulative == "history":
        measures.append("earlier_cases")
        totals["cumulative_cases"].append("earlier_cases")
    kinds = dict.fromkeys(measures, "bigint")
    dated = intervals.dated_changes(cases, group, changes, kinds)
    if cumulative == "history":
        before = known.where(F.col("start_date_key") < key_of(first)).select(*group)
        counted = [intervals.Change(F.lit(first), {"earlier_cases": one})]
        dated = dated.unionByName(intervals.dated_changes(before, group, counted, kinds))
    daily = intervals.daily_status(
        dated,
        group,
        last,
        balances=["active_cases", "hospitalized_cases"],
        points=["new_cases", "resolved_cases"],
        running=totals,
    )
    return conform(
        daily.withColumn("date_key", date_key(F.col("day"))), "fact_condition_daily", now
    )


def fact_medication_daily(
    medications: DataFrame, first: dt.date, last: dt.date, now: dt.datetime
) -> DataFrame:
    """Prescriptions, distinct active patients and start-day costs.

    Groups are day, medication, organization and payer; NULL organization and
    payer are groups of their own. The overlapping prescriptions of a patient
    are merged first, so a patient counts once a day. Prescriptions that stopped
    before the range are left out by the scan; they show on none of its days.
    """
    group = ["medication_key", "organization_key", "payer_key"]
    rows = medications.where(
        (F.col("start_date_key") <= key_of(last)) & _open_or_started(key_of(first))
    ).select(
        *group,
        "patient_key",
        day_of_key(F.col("start_date_key")).alias("start"),
        day_of_key(F.col("stop_date_key")).alias("stop"),
        "dispense_count",
        "base_cost",
        "payer_coverage",
    )
    money, count = "decimal(28,2)", "bigint"
    measures = {
        "active_patient_count": count,
        "new_prescriptions": count,
        "stopped_prescriptions": count,
        "total_dispense_count": count,
        "total_base_cost": money,
        "total_payer_coverage": money,
        "total_out_of_pocket": money,
    }
    zero = F.lit(0).cast("decimal(18,2)")
    cost, coverage = F.coalesce("base_cost", zero), F.coalesce("payer_coverage", zero)
    one = F.lit(1).cast("bigint")
    own = [
        intervals.point_change(
            F.col("start"),
            first,
            last,
            new_prescriptions=one,
            total_dispense_count=F.coalesce("dispense_count", F.lit(0)),
            total_base_cost=cost,
            total_payer_coverage=coverage,
            total_out_of_pocket=cost - coverage,
        ),
        intervals.point_change(F.col("stop"), first, last, stopped_prescriptions=one),
    ]
    under_treatment = intervals.islands(
        rows, group, "patient_key", F.col("start"), F.col("stop")
    )
    present = intervals.balance_changes(
        "active_patient_count", F.col("start"), F.col("stop"), first, last, stop_day_counts=False
    )
    changes = intervals.dated_changes(rows, group, own, measures).unionByName(
        intervals.dated_changes(under_treatment, group, present, measures)
    )
    daily = intervals.daily_status(
        changes,
        group,
        last,
        balances=["active_patient_count"],
        points=[name for name in measures if name != "active_patient_count"],
        shown_by=[
            "new_prescriptions",
            "stopped_prescriptions",
            "total_dispense_count",
            "total_base_cost",
        ],
    )
    return conform(
        daily.withColumn("date_key", date_key(F.col("day"))), "fact_medication_daily", now
    )
