import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from carestar.operators.calendar import InvalidRange
from carestar.plans import audit, control, facts, load, staging
from carestar.schemas import ENTITIES, WAREHOUSE
from carestar.sources.landing import LandingZone, stamped
from carestar.sources.store import TableMissing

FIRST, LAST = dt.date(2020, 1, 1), dt.date(2020, 3, 31)
AS_OF = dt.date(2020, 6, 1)
NOW, LATER = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
KEYS = {
    "fact_encounter": "fact_encounter_key",
    "fact_condition": "fact_condition_key",
    "fact_medications": "fact_medication_key",
    "fact_encounter_daily": "daily_key",
    "fact_condition_daily": "daily_condition_key",
    "fact_medication_daily": "medication_daily_key",
}


def rows(spark, name, *given):
    entity = ENTITIES[name]
    full = [{**dict.fromkeys(entity.column_names, ""), **row} for row in given]
    return spark.createDataFrame(full, entity.source_schema)


def first_batch(spark):
    stay = {"ORGANIZATION": "o1", "PROVIDER": "v1", "PAYER": "y1", "TOTAL_CLAIM_COST": "10"}
    days = ["2020-01-05", "2020-01-20", "2020-02-10", "2020-03-15"]
    return {
        "patients": rows(spark, "patients", {"Id": "p1", "CITY": "A"}, {"Id": "p2", "CITY": "A"}),
        "organizations": rows(spark, "organizations", {"Id": "o1", "NAME": "O"}),
        "providers": rows(spark, "providers", {"Id": "v1", "ORGANIZATION": "o1"}),
        "payers": rows(spark, "payers", {"Id": "y1", "NAME": "Y"}),
        "payer_transitions": rows(
            spark, "payer_transitions", {"PATIENT": "p1", "PAYER": "y1", "OWNERSHIP": "Self"}
        ),
        "encounters": rows(
            spark, "encounters",
            *[
                {"Id": f"e{n}", "START": f"{day}T08:00:00Z", "PATIENT": f"p{1 + n % 2}", **stay,
                 "ENCOUNTERCLASS": "inpatient" if n == 0 else "wellness"}
                for n, day in enumerate(days)
            ],
            {"Id": "lost", "START": "2020-01-05", "PATIENT": "nobody", **stay},
        ),
        "conditions": rows(
            spark, "conditions",
            *[
                {"START": day, "STOP": "" if n == 1 else "2020-03-20", "PATIENT": f"p{1 + n % 2}",
                 "ENCOUNTER": f"e{n}", "CODE": "c", "DESCRIPTION": "d"}
                for n, day in enumerate(days)
            ],
        ),
        "medications": rows(
            spark, "medications",
            *[
                {"START": day, "STOP": "" if n == 1 else "2020-03-20", "PATIENT": f"p{1 + n % 2}",
                 "ENCOUNTER": f"e{n}", "PAYER": "y1", "CODE": "m", "BASE_COST": "3"}
                for n, day in enumerate(days)
            ],
        ),
    }


def land(zone, batch, name, frames):
    for entity, df in frames.items():
        zone.append(ENTITIES[entity], stamped(df, batch, name))


@pytest.fixture
def zone(spark, folder):
    return LandingZone(spark, f"{folder}/landing")


@pytest.fixture
def staged(spark, zone, store, monkeypatch):
    monkeypatch.setattr(staging, "_buckets_for", lambda df: 32)
    land(zone, "b1", NOW, first_batch(spark))
    staging.transform_all(zone, store, now=NOW)
    return store


def run(store, batch, first=FIRST, last=LAST, **options):
    options.setdefault("now", NOW)
    return load.load_warehouse(store, first, last, as_of=AS_OF, batch_id=batch, **options)


def content(store, table):
    df = store.read(table)
    dropped = {KEYS.get(table), "load_dts", "create_at", "update_at"}
    return sorted(map(str, df.select(*[c for c in df.columns if c not in dropped]).collect()))


def everything(store):
    return {table: content(store, table) for table in WAREHOUSE}


def test_load_then_same_batch_then_new_batch(staged):
    counts = run(staged, "one")
    assert counts["fact_encounter"] == 4 and counts["fact_medications"] == 4
    assert counts["dim_patient"] == 3 and counts["dim_date"] == 91
    before = everything(staged)
    versions = {t: staged.snapshot(t).version for t in WAREHOUSE}
    assert run(staged, "one") is None
    assert {t: staged.snapshot(t).version for t in WAREHOUSE} == versions
    run(staged, "two", now=LATER)
    assert everything(staged) == before
    log = staged.read(control.RUN_LOG).where(F.col("proc_name") == load.LOAD)
    assert [(r.status, r.params) for r in log.collect()] == 2 * [
        ("SUCCESS", "FromDate=2020-01-01;ToDate=2020-03-31;AsOfDate=2020-06-01")
    ]


def test_contracts_hold_after_a_load(staged, zone):
    run(staged, "one")
    assert all(r.duplicated_keys == 0 for r in audit.keys(staged).collect())
    orphans = audit.references(staged).collect()
    assert len(orphans) == 24 and all(r.orphan_rows == 0 for r in orphans)
    assert all(r.too_long == 0 and r.missing == 0 for r in audit.landing_widths(zone).collect())
    assert [r.encounter_id for r in audit.dropped_encounters(staged).collect()] == ["lost"]


def test_rows_without_a_patient_are_counted_and_set_aside(staged, spark, zone):
    stray = rows(
        spark, "conditions",
        {"START": "2020-01-07", "PATIENT": "nobody", "ENCOUNTER": "lost", "CODE": "c"},
        {"START": "2020-03-07", "PATIENT": "nobody", "ENCOUNTER": "lost", "CODE": "c"},
    )
    land(zone, "b2", LATER, {"conditions": stray})
    staging.transform(zone, staged, ENTITIES["conditions"], now=LATER, batch_ids=["b2"])
    counts = run(staged, "one")
    assert counts["fact_encounter"] == counts["fact_condition"] == 4
    assert (counts["fact_encounter_dropped"], counts["fact_condition_dropped"]) == (1, 2)
    assert "fact_medications_dropped" not in counts and not staged.exists("fact_medications_dropped")
    lost = [("fact_condition", "2020-01-07"), ("fact_condition", "2020-03-07"), ("fact_encounter", "2020-01-05")]
    assert sorted((r.fact_table, str(r.fact_date)) for r in audit.dropped(staged).collect()) == lost
    log = staged.read(control.RUN_LOG).where(F.col("proc_name") == load.DROPPED).orderBy("params")
    assert [r.rows_affected for r in log.collect()] == [2, 1]
    # The patient comes, and January is loaded again: only March is still without.
    land(zone, "b3", LATER, {"patients": rows(spark, "patients", {"Id": "nobody"})})
    staging.transform(zone, staged, ENTITIES["patients"], now=LATER, batch_ids=["b3"])
    counts = run(staged, "two", FIRST, dt.date(2020, 1, 31), now=LATER)
    assert not any(name.endswith("_dropped") for name in counts)
    assert [(r.fact_table, str(r.fact_date)) for r in audit.dropped(staged).collect()] == lost[1:2]


def test_ranges_loaded_apart_equal_one_load(staged, spark, zone, folder):
    from carestar.sources.store import TableStore

    apart = TableStore(spark, f"{folder}/apart")
    staging.transform_all(zone, apart, now=NOW)
    run(staged, "one")
    for batch, (first, last) in enumerate(
        [(dt.date(2020, 1, 1), dt.date(2020, 1, 17)), (dt.date(2020, 1, 18), LAST)]
    ):
        run(apart, str(batch), first, last)
    whole, parts = everything(staged), everything(apart)
    running = whole.pop("fact_condition_daily"), parts.pop("fact_condition_daily")
    assert whole == parts
    for table, key in KEYS.items():
        rows = apart.read(table)
        assert rows.select(key).where(f"{key} IS NOT NULL").distinct().count() == rows.count()
    # Running totals start again with each range; all else is the same.
    assert len(running[0]) == len(running[1])


def test_second_batch_changes_history_and_facts(staged, spark, zone):
    run(staged, "one")
    moved = rows(spark, "patients", {"Id": "p1", "CITY": "B"}, {"Id": "p3", "CITY": "C"})
    dearer = rows(
        spark, "encounters",
        {"Id": "e0", "START": "2020-01-05T08:00:00Z", "PATIENT": "p1", "ORGANIZATION": "o1",
         "PAYER": "y1", "TOTAL_CLAIM_COST": "99", "ENCOUNTERCLASS": "inpatient"},
    )
    land(zone, "b2", LATER, {"patients": moved, "encounters": dearer})
    for name in ("patients", "encounters"):
        staging.transform(zone, staged, ENTITIES[name], now=LATER, batch_ids=["b2"])
    run(staged, "two", now=LATER)
    people = staged.read("dim_patient").where("patient_id <> 'UNKNOWN'").collect()
    assert sorted((r.patient_id, r.city, r.is_current) for r in people) == [
        ("p1", "A", False), ("p1", "B", True), ("p2", "A", True), ("p3", "C", True),
    ]
    closed = next(r for r in people if not r.is_current)
    assert closed.valid_to == dt.date(2020, 5, 31)
    encounters = {r.encounter_id: r for r in staged.read("fact_encounter").collect()}
    assert len(encounters) == 4 and encounters["e0"].total_claim_cost == 99
    current = next(r.patient_key for r in people if r.patient_id == "p1" and r.is_current)
    assert encounters["e0"].patient_key == current
    # History is only added to: its stored part is the same after another load.
    held = {p for p in staged.snapshot("dim_patient").parts if p.endswith("closed")}
    assert held
    run(staged, "three", now=LATER)
    assert held <= set(staged.snapshot("dim_patient").parts)


def test_failed_batch_can_be_retried(store, zone, spark):
    with pytest.raises(TableMissing):
        run(store, "one")
    with pytest.raises(InvalidRange):
        run(store, "one", LAST, FIRST)
    log = store.read(control.RUN_LOG).where(F.col("proc_name") == load.LOAD)
    log = log.orderBy("start_time").collect()
    assert [r.status for r in log] == ["FAILED", "FAILED"]
    assert "missing" in log[0].error_msg and "range" in log[1].error_msg
    with pytest.raises(TableMissing):
        staging.transform(zone, store, ENTITIES["patients"])
    land(zone, "b1", NOW, first_batch(spark))
    staging.transform_all(zone, store, now=NOW)
    assert run(store, "one")["fact_encounter"] == 4


def test_an_emptied_range_is_empty(staged):
    run(staged, "one")
    source = ENTITIES["encounters"].staging_table
    staged.replace(source, staged.read(source).where("START >= '2020-03-01'"))
    run(staged, "two")
    days = [r.encounter_date_key for r in staged.read("fact_encounter").collect()]
    assert days == [20200315]
    assert {r.date_key for r in staged.read("fact_encounter_daily").collect()} == {20200315}


def test_blank_stops_as_1900(spark, zone, store):
    land(zone, "b1", NOW, first_batch(spark))
    staging.transform_all(zone, store, now=NOW, blank_date="epoch1900")
    run(store, "one")
    stops = {r.stop_date_key for r in store.read("fact_condition").collect()}
    assert stops == {19000101, 20200320}
    last = store.read("fact_condition_daily").agg(F.max("date_key")).first()[0]
    assert last == 20200320


def test_the_two_documented_ranges():
    assert (load.FULL_RANGE[1] - load.FULL_RANGE[0]).days + 1 == 73049
    assert (load.PARTIAL_RANGE[1] - load.PARTIAL_RANGE[0]).days + 1 == 578


def parts(store, name):
    return set(store.snapshot(ENTITIES[name].staging_table).parts)


def test_a_small_batch_rewrites_only_its_months(spark, zone, staged):
    before = parts(staged, "encounters")
    moved = {"Id": "e2", "START": "2020-03-02T08:00:00Z", "PATIENT": "p1"}
    land(zone, "b2", LATER, {"encounters": rows(spark, "encounters", moved)})
    staging.transform(zone, staged, ENTITIES["encounters"], now=LATER, batch_ids=["b2"])
    after = parts(staged, "encounters")
    kept = {p for p in before if "202001" in p}
    assert kept and kept <= after
    assert not {p for p in before - kept} & after
    held = staged.read(ENTITIES["encounters"].staging_table)
    assert sorted((r.Id, str(r.START)[:7]) for r in held.collect()) == [
        ("e0", "2020-01"), ("e1", "2020-01"), ("e2", "2020-03"), ("e3", "2020-03"), ("lost", "2020-01"),
    ]
    assert staging.transform(zone, staged, ENTITIES["encounters"], now=LATER, batch_ids=["none"]) == 0
    assert parts(staged, "encounters") == after


def opened(monkeypatch):
    """The parts of staging tables and facts that are opened from here on."""
    seen, plain = [], load.TableStore._read_parts

    def read(self, table, snapshot, parts):
        seen.extend((table, part) for part in parts)
        return plain(self, table, snapshot, parts)

    monkeypatch.setattr(load.TableStore, "_read_parts", read)
    return seen


def test_a_small_batch_opens_only_its_months_and_buckets(spark, zone, staged, monkeypatch):
    seen = opened(monkeypatch)
    again = {"Id": "e3", "START": "2020-03-16T08:00:00Z", "PATIENT": "p1"}
    for n in range(2):  # the first batch makes the index
        seen.clear()
        land(zone, f"b2{n}", LATER + dt.timedelta(days=n), {"encounters": rows(spark, "encounters", again)})
        staging.transform(zone, staged, ENTITIES["encounters"], now=LATER, batch_ids=[f"b2{n}"])
    months = {p.split("month_key=")[1] for t, p in seen if t == "Staging_Encounters"}
    assert months == {"202003"}
    assert len({p for t, p in seen if t == "Staging_Encounters_keys"}) == 1
    before, total = parts(staged, "patients"), staged.read("Staging_Patients").count()
    news = rows(spark, "patients", {"Id": "p2", "CITY": "Z"})
    land(zone, "b3", LATER, {"patients": news})
    seen.clear()
    assert staging.transform(zone, staged, ENTITIES["patients"], now=LATER, batch_ids=["b3"]) == 1
    assert {t for t, _ in seen} == {"Staging_Patients"} and len({p for _, p in seen}) == 1
    assert len(before & parts(staged, "patients")) == len(before) - 1
    assert staged.read("Staging_Patients").count() == total == 2


def test_batches_in_any_order_equal_one_batch(spark, zone, store, folder):
    """Random upserts and moves, staged a batch at a time and all at once."""
    import random

    from carestar.sources.store import TableStore

    rng, whole = random.Random(4), TableStore(spark, f"{folder}/whole")
    for name in ("encounters", "conditions", "payers"):
        key = {"encounters": "Id", "conditions": "PATIENT", "payers": "Id"}[name]
        for batch in range(4):
            given = [
                {key: f"k{rng.randrange(12)}", **({} if name == "payers" else {
                    "START": f"2020-0{rng.randrange(1, 6)}-0{rng.randrange(1, 5)}" if rng.random() < 0.9 else ""}),
                 **({"CODE": f"c{rng.randrange(2)}"} if name == "conditions" else {})}
                for _ in range(6)
            ]
            unique = list({(r[key], r.get("START") if name == "conditions" else 0, r.get("CODE")): r for r in given}.values())
            moment = NOW + dt.timedelta(days=batch)
            land(zone, f"{name}{batch}", moment, {name: rows(spark, name, *unique)})
            staging.transform(zone, store, ENTITIES[name], now=NOW, batch_ids=[f"{name}{batch}"])
        staging.transform(zone, whole, ENTITIES[name], now=NOW)
        table = ENTITIES[name].staging_table
        drop = ("create_at",)
        got = [sorted(map(str, s.read(table).drop(*drop).collect())) for s in (store, whole)]
        assert got[0] == got[1]


def test_moves_are_known_unless_a_table_was_written_otherwise(spark, zone, staged):
    entity, none = ENTITIES["encounters"], {"PATIENT": "p1"}
    ids = spark.createDataFrame([("e2",), ("e3",)], "_id string")
    assert staging.months_left(staged, entity, ids, "_id") == set()
    for batch, day in enumerate(["2020-03-02", "2020-01-07"]):
        moved = rows(spark, "encounters", {"Id": "e2", "START": day, **none})
        land(zone, f"m{batch}", LATER + dt.timedelta(days=batch), {"encounters": moved})
        staging.transform(zone, staged, entity, now=LATER, batch_ids=[f"m{batch}"])
    assert staging.months_left(staged, entity, ids, "_id") == {"202002", "202003"}
    staged.replace(entity.staging_table, staged.read(entity.staging_table).where("Id <> 'e2'"))
    assert not staging.index_holds(staged, entity)
    assert staging.months_left(staged, entity, ids, "_id") is None
    land(zone, "m9", LATER + dt.timedelta(days=9), {"encounters": rows(spark, "encounters", {"Id": "e2", "START": "2020-02-02", **none})})
    staging.transform(zone, staged, entity, now=LATER, batch_ids=["m9"])
    assert staging.index_holds(staged, entity) and staging.months_left(staged, entity, ids, "_id") is None
    assert staged.read(entity.staging_table).where("Id = 'e2'").count() == 1


def test_a_failed_table_write_leaves_an_index_that_is_not_trusted(spark, zone, staged, monkeypatch):
    entity = ENTITIES["encounters"]
    land(zone, "b2", LATER, {"encounters": rows(spark, "encounters", {"Id": "new", "START": "2020-05-02", "PATIENT": "p1"})})
    def broken(*args, **named):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(load.TableStore, "swap_months", broken)
        with pytest.raises(RuntimeError):
            staging.transform(zone, staged, entity, now=LATER, batch_ids=["b2"])
    assert not staging.index_holds(staged, entity)
    staging.transform(zone, staged, entity, now=LATER, batch_ids=["b2"])
    assert staging.index_holds(staged, entity)
    assert staged.read(entity.staging_table).where("Id = 'new'").count() == 1


def test_an_unchanged_dimension_is_not_written(spark, staged):
    run(staged, "one")
    before = {d.table: staged.snapshot(d.table).version for d in load.dims.HISTORY_DIMS}
    written = run(staged, "two", now=LATER)
    assert all(written[table] == 0 for table in before)
    assert before == {table: staged.snapshot(table).version for table in before}


def test_only_buckets_with_changes_are_rewritten(spark, zone, staged):
    load.prepare(staged, NOW)
    many = rows(spark, "patients", *[{"Id": f"q{n}", "CITY": "A"} for n in range(40)])
    land(zone, "b2", NOW, {"patients": many})
    staging.transform(zone, staged, ENTITIES["patients"], now=NOW, batch_ids=["b2"])
    patient = load.dims.PATIENT
    assert load.load_history(staged, patient, AS_OF, NOW, "initial", bucket_rows=6) == 43
    before = set(staged.snapshot("dim_patient").parts)
    assert len(before) == 7
    land(zone, "b3", LATER, {"patients": rows(spark, "patients", {"Id": "q7", "CITY": "B"}, {"Id": "q8", "CITY": "A"})})
    staging.transform(zone, staged, ENTITIES["patients"], now=LATER, batch_ids=["b3"])
    load.load_history(staged, patient, AS_OF, LATER, "initial", bucket_rows=6)
    after = set(staged.snapshot("dim_patient").parts)
    assert len(before & after) == 6
    assert sorted(p.split("slot_key=")[1] == "closed" for p in after - before) == [False, True]
    held = staged.read("dim_patient")
    assert held.count() == 44 and held.where("is_current").count() == 43
    assert [r.city for r in held.where("patient_id = 'q7' AND is_current").collect()] == ["B"]
    assert held.select("patient_key").distinct().count() == 44
    assert load.load_history(staged, patient, AS_OF, LATER, "initial") == 0
    assert set(staged.snapshot("dim_patient").parts) == after


def test_a_reload_opens_no_facts_that_ended_before(spark, zone, staged, monkeypatch):
    """Facts of 2018 to 2020, some of them open or of later ends: the reload of one month
    equals the full computation and opens only what can show in it."""
    days = ["2018-02-03", "2018-03-05", "2019-01-10", "2019-12-20", "2020-01-15", "2020-02-02"]
    stops = ["2018-02-20", "", "2019-03-01", "2020-01-20", "2020-04-01", "2020-02-09"]
    given = [
        {"START": day, "STOP": stop, "PATIENT": f"p{1 + n % 2}", "ENCOUNTER": f"e{n % 4}", "CODE": f"x{n}",
         "PAYER": "y1", "BASE_COST": "2"}
        for n, (day, stop) in enumerate(zip(days, stops, strict=True))
    ]
    cases = [{k: r[k] for k in ("START", "STOP", "PATIENT", "ENCOUNTER", "CODE")} for r in given]
    land(zone, "b2", NOW, {"medications": rows(spark, "medications", *given), "conditions": rows(spark, "conditions", *cases)})
    for name in ("medications", "conditions"):
        staging.transform(zone, staged, ENTITIES[name], now=NOW, batch_ids=["b2"])
    run(staged, "all", dt.date(2018, 1, 1), dt.date(2020, 3, 31))
    february = dt.date(2020, 2, 1), dt.date(2020, 2, 29)
    whole = {t: content(staged, t) for t in ("fact_medication_daily",)}
    seen = opened(monkeypatch)
    run(staged, "february", *february, now=LATER)
    assert content(staged, "fact_medication_daily") == whole["fact_medication_daily"]
    for fact in ("fact_medications", "fact_condition"):
        parts = {p.split("month_key=")[1] for t, p in seen if t == fact}
        assert "201802/until_key=2018" not in parts and "201901/until_key=2019" not in parts
        assert {"201803/until_key=open", "201912/until_key=2020"} <= parts
    # The open cases are counted as the full computation counts them.
    daily = load.daily.fact_condition_daily(
        staged.read("fact_condition"), staged.read("fact_encounter"), *february, LATER
    )
    stored = staged.read_months("fact_condition_daily", 20200201, 20200229)
    names = [c for c in stored.columns if c not in ("daily_condition_key", "load_dts")]
    assert sorted(map(str, stored.select(names).collect())) == sorted(map(str, daily.select(names).collect()))
    assert stored.count() > 29


def test_timelines_are_built_after_a_write_only(spark, zone, staged):
    run(staged, "one")
    name = load.facts.ranges_of("dim_patient")
    version = staged.snapshot(name).version
    run(staged, "two", now=LATER)
    assert staged.snapshot(name).version == version
    land(zone, "b2", LATER, {"patients": rows(spark, "patients", {"Id": "p1", "CITY": "B"})})
    staging.transform(zone, staged, ENTITIES["patients"], now=LATER, batch_ids=["b2"])
    run(staged, "three", now=LATER)
    assert staged.snapshot(name).version == version + 1


def test_a_moved_encounter_is_one_fact(spark, zone, staged, monkeypatch):
    run(staged, "one")
    seen = opened(monkeypatch)
    moved = {
        "Id": "e2", "START": "2020-03-02T08:00:00Z", "PATIENT": "p1", "ORGANIZATION": "o1",
        "PROVIDER": "v1", "PAYER": "y1", "TOTAL_CLAIM_COST": "10", "ENCOUNTERCLASS": "wellness",
    }
    land(zone, "b2", LATER, {"encounters": rows(spark, "encounters", moved)})
    staging.transform(zone, staged, ENTITIES["encounters"], now=LATER, batch_ids=["b2"])
    load.load_facts(staged, dt.date(2020, 3, 1), dt.date(2020, 3, 31), LATER, load.Options())
    seen.clear()
    assert load.drop_moved_encounters(staged, dt.date(2020, 3, 1), dt.date(2020, 3, 31)) == [20200210]
    assert not [p for t, p in seen if t == "fact_encounter" and "202001" in p]
    staged.replace_keys("fact_encounter", staged.read("fact_encounter").where("false"), "encounter_date_key", 20200301, 20200331)
    run(staged, "march", dt.date(2020, 2, 1), dt.date(2020, 3, 31), now=LATER)
    facts = staged.read("fact_encounter").select("encounter_id", "encounter_date_key")
    assert sorted(map(tuple, facts.collect())) == [
        ("e0", 20200105), ("e1", 20200120), ("e2", 20200302), ("e3", 20200315),
    ]
    daily = staged.read("fact_encounter_daily").groupBy("date_key").agg(F.sum("encounter_count"))
    assert sorted(map(tuple, daily.collect())) == [
        (20200105, 1), (20200120, 1), (20200302, 1), (20200315, 1),
    ]


def test_a_load_leaves_no_prescriptions_aside(staged, spark, monkeypatch):
    made, real = [], facts.written

    def seen(df, purpose, paths):
        rows = real(df, purpose, paths)
        made.append((paths[-1], rows.count()))
        return rows

    monkeypatch.setattr(facts, "written", seen)
    counts = run(staged, "one")
    assert [n for _, n in made] == [counts["fact_medications"]] and counts["fact_medications"] > 0
    assert not Path(made[0][0].removeprefix("file:")).exists()
