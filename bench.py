"""Time the steps of a warehouse load; prints one JSON line.

BENCH_SF_DIR  folder of the given tables (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default 8)
BENCH_NAIVE   1 also times the pairing forms that the daily facts and the as-of
              lookup replace, over one month (default 0: they take minutes)
"""

from __future__ import annotations

import datetime as dt
import json
import os
import time
from pathlib import Path

from pyspark.sql import functions as F

from carestar.functions.dates import key_of
from carestar.operators.lookup import as_of_lookup
from carestar.plans import daily, dims, load, staging
from carestar.schemas import ENTITIES
from carestar.session import build_session, scratch_dir
from carestar.sources.landing import LandingZone
from carestar.sources.store import TableStore
from registry import entities
from registry.queries import AS_OF, CONDITION_DAYS, DATA_YEARS, LATER, NOW

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
NAIVE = os.environ.get("BENCH_NAIVE", "0") == "1"
FACT_DAYS = (dt.date(1995, 1, 1), dt.date(2024, 12, 31))
MONTH = (dt.date(2001, 6, 1), dt.date(2001, 6, 30))

times: dict[str, float] = {}


def timed(name, work):
    start = time.perf_counter()
    result = work()
    times[name] = round(time.perf_counter() - start, 3)
    return result


def run(df):
    df.write.format("noop").mode("overwrite").save()


def prepare_landing(spark, zone):
    for name, entity in ENTITIES.items():
        zone.append(entity, entities.landing(spark, FOLDER, name))


def load_steps(store):
    timed("calendar", lambda: (load.prepare(store, NOW), load.load_calendar(store, *FACT_DAYS)))
    timed("code_dims", lambda: [load.load_codes(store, dim, NOW) for dim in dims.CODE_DIMS])
    for dim in dims.HISTORY_DIMS:
        timed(dim.table, lambda: load.load_history(store, dim, AS_OF, NOW, "initial"))
    # The production path; its three facts are concurrent jobs.
    options = load.Options()
    timed("facts", lambda: load.load_facts(store, *FACT_DAYS, NOW, options))


def daily_steps(store):
    stays, cases = store.read("fact_encounter"), store.read("fact_condition")
    drugs = store.read("fact_medications")
    timed("fact_encounter_daily", lambda: run(daily.fact_encounter_daily(stays, *FACT_DAYS, NOW)))
    timed(
        "fact_condition_daily",
        lambda: run(daily.fact_condition_daily(cases, stays, *CONDITION_DAYS, NOW)),
    )
    timed("fact_medication_daily", lambda: run(daily.fact_medication_daily(drugs, *DATA_YEARS, NOW)))


def naive_steps(spark, store):
    """The pairing forms, against ours over the same range and inputs."""
    stays = store.read("fact_encounter")
    stays.createOrReplaceTempView("fact_encounter")
    store.read("fact_medications").createOrReplaceTempView("fact_medications")
    store.read("dim_date").createOrReplaceTempView("dim_date")
    store.read("dim_patient").createOrReplaceTempView("dim_patient")
    store.read(ENTITIES["encounters"].staging_table).createOrReplaceTempView("encounters")
    drugs = store.read("fact_medications")
    timed("daily_one_month_changes", lambda: run(daily.fact_medication_daily(drugs, *MONTH, NOW)))
    low, high = key_of(MONTH[0]), key_of(MONTH[1])
    paired = spark.sql(f"""
        SELECT d.date_key, f.medication_key, f.organization_key, f.payer_key,
               count(DISTINCT CASE WHEN f.start_date_key <= d.date_key AND (f.stop_date_key IS NULL
                     OR f.stop_date_key > d.date_key) THEN f.patient_key END) AS active,
               sum(if(f.start_date_key = d.date_key, 1, 0)) AS started,
               sum(if(f.stop_date_key = d.date_key, 1, 0)) AS stopped
        FROM fact_medications f CROSS JOIN dim_date d
        WHERE d.date_key BETWEEN {low} AND {high} AND f.start_date_key <= {high}
        GROUP BY 1, 2, 3, 4""")
    timed("daily_one_month_pairing", lambda: run(paired))

    visits = (
        spark.table("encounters")
        .select("Id", "PATIENT", F.to_date("START").alias("day"))
        .where(F.col("day").between(*MONTH))
    )
    visits.createOrReplaceTempView("visits")
    found = as_of_lookup(
        visits, store.read("dim_patient"), fact_key="PATIENT", on=F.col("day"),
        natural_key="patient_id", surrogate_key="patient_key",
    )
    timed("lookup_ranges", lambda: run(found))
    lateral = spark.sql("""
        SELECT e.Id, v.patient_key FROM visits e LEFT JOIN LATERAL (
            SELECT patient_key FROM dim_patient d WHERE d.patient_id = e.PATIENT
               AND e.day BETWEEN d.valid_from AND d.valid_to
            ORDER BY d.valid_from DESC LIMIT 1) v""")
    timed("lookup_lateral", lambda: run(lateral))


def main():
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_dir(spark, "bench")
    zone, store = LandingZone(spark, f"{root}/landing"), TableStore(spark, f"{root}/tables")
    prepare_landing(spark, zone)
    for name, entity in ENTITIES.items():
        timed(f"stage_{name}", lambda: staging.transform(zone, store, entity, now=NOW))
    load_steps(store)
    daily_steps(store)
    timed(
        "reload_one_month",
        lambda: load.load_warehouse(store, *MONTH, as_of=AS_OF, batch_id="month", now=LATER),
    )
    headline = dict(times)
    if NAIVE:
        naive_steps(spark, store)
    comparisons = {name: seconds for name, seconds in times.items() if name not in headline}
    print(
        json.dumps(
            {
                "metric": "warehouse_load_total",
                "value": round(sum(headline.values()), 3),
                "unit": "sec",
                "queries": headline,
                "sf": Path(FOLDER).name.removeprefix("sf"),
                "comparisons": comparisons,
            }
        )
    )


if __name__ == "__main__":
    main()
