"""How much the shared steps move and write: each source row once where once is enough."""

import datetime as dt
import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from carestar.operators import intervals
from carestar.operators.upsert import one_time
from carestar.plans import daily, dims, facts, staging
from carestar.schemas import ENTITIES
from carestar.session import tidied, written
from carestar.sources.landing import LandingZone, load_entity, stamped
from registry import entities, queries

NOW = dt.datetime(2024, 1, 1)
MEDICATIONS = ENTITIES["medications"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def landed(spark, rows, batch="b1", now=NOW):
    """Medications of (patient, encounter, dispenses), all of one day and code."""
    values = [
        {"START": "2020-01-01", "CODE": "M1", "PATIENT": p, "ENCOUNTER": e, "DISPENSES": n}
        for p, e, n in rows
    ]
    names = MEDICATIONS.column_names
    frame = spark.createDataFrame([tuple(v.get(n, "") for n in names) for v in values], ", ".join(f"{n} string" for n in names))
    return stamped(frame, batch, now)


@pytest.fixture
def given(spark, folder):
    """A handful of rows of the given tables."""
    day = "timestamp'1998-01-0{}'".format
    tables = {
        "region": "SELECT 0 AS r_regionkey, 'AFRICA' AS r_name",
        "nation": "SELECT 0 AS n_nationkey, 'KENYA' AS n_name, 0 AS n_regionkey",
        "supplier": "SELECT 0L AS s_suppkey, 'S' AS s_name, 0 AS s_nationkey, 1.0D AS s_acctbal",
        "customer": "SELECT id AS c_custkey, 'C' AS c_name, 0 AS c_nationkey, 1.0D AS c_acctbal, 'B' AS c_mktsegment FROM range(3)",
        "orders": f"SELECT id AS o_orderkey, id % 4 AS o_custkey, 'F' AS o_orderstatus, 2.0D AS o_totalprice, {day(1)} AS o_orderdate, '1-URGENT' AS o_orderpriority FROM range(8)",
        "lineitem": f"SELECT id % 10 AS l_orderkey, id AS l_partkey, 0L AS l_suppkey, 1 AS l_linenumber, 3.0D AS l_quantity, 5.0D AS l_extendedprice, 0.1D AS l_discount, if(id % 3 = 0, 'R', 'N') AS l_returnflag, {day(2)} AS l_shipdate FROM range(40)",
        "events": f"SELECT id AS event_id, {day(3)} AS ts, id % 3 AS user_id, 'error' AS event_type, 1.0D AS value FROM range(5)",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_items_meet_orders_that_know_their_home(spark, given):
    rows = entities.medications(spark, given)
    # Orders of customer 3 have no home, orders 8 and 9 no row.
    assert sorted({r.ENCOUNTER for r in rows.collect()}) == ["E0", "E1", "E2", "E4", "E5", "E6"]
    tree = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
    outermost = next(line for line in tree if "Join" in line)
    assert "l_orderkey" in outermost and "c_custkey" not in outermost


def test_a_first_load_of_one_time_moves_no_row(spark):
    rows = [("P1", "E1", "1"), ("P1", "E1", "1"), ("P2", "E2", "2")]
    first = staging.staged(landed(spark, rows), MEDICATIONS, None, NOW)
    assert "Exchange" not in plan(first) and first.count() == 3
    assert {r.create_at for r in first.select("create_at").collect()} == {NOW}


def test_a_first_load_of_two_times_keeps_the_newest_batch(spark):
    later = landed(spark, [("P1", "E1", "9")], "b2", dt.datetime(2024, 2, 1))
    both = landed(spark, [("P1", "E1", "1"), ("P2", "E2", "2")]).unionByName(later)
    assert not one_time(both)
    first = staging.staged(both, MEDICATIONS, None, NOW)
    assert sorted((r.PATIENT, r.DISPENSES) for r in first.collect()) == [("P1", 9), ("P2", 2)]


def test_rows_without_a_time_are_not_of_one_time(spark):
    times = spark.createDataFrame([(NOW,), (None,)], "update_at timestamp_ntz")
    assert not one_time(times) and not one_time(times.where("update_at IS NULL"))
    assert one_time(times.where("update_at IS NOT NULL"))


@pytest.mark.parametrize("entity", ["medications", "conditions"])
def test_a_range_of_all_days_works_its_rows_out_once(spark, given, entity):
    rows, stays = (queries.cleaned(spark, given, name) for name in (entity, "encounters"))
    source = facts.medication_source if entity == "medications" else facts.condition_source
    whole = source(rows, stays, *queries.WHOLE)
    narrow = source(rows, stays, dt.date(1990, 1, 1), dt.date(2000, 12, 31))
    semi = [df._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") for df in (whole, narrow)]
    assert semi == [0, 1]
    assert sorted(map(str, whole.collect())) == sorted(map(str, narrow.collect()))


def test_islands_aggregate_once(spark):
    rows = spark.createDataFrame(
        [("g", 1, dt.date(2020, 1, 1), dt.date(2020, 1, 5)), ("g", 1, dt.date(2020, 1, 2), None),
         ("g", 1, dt.date(2020, 2, 1), dt.date(2020, 2, 2)), (None, None, dt.date(2020, 1, 1), dt.date(2020, 1, 3)),
         (None, None, dt.date(2020, 1, 3), dt.date(2020, 1, 4)), (None, None, dt.date(2020, 1, 6), dt.date(2020, 1, 7))],
        "grp string, who int, a date, b date",
    )
    found = intervals.islands(rows, ["grp"], "who", F.col("a"), F.col("b"))
    assert sorted(((r.start, r.stop) for r in found.where("who IS NULL").collect())) == [
        (dt.date(2020, 1, 1), dt.date(2020, 1, 4)), (dt.date(2020, 1, 6), dt.date(2020, 1, 7))]
    assert [(r.start, r.stop) for r in found.where("who = 1").collect()] == [(dt.date(2020, 1, 1), None)]
    # One before the shuffle, one after it; each would hold a task's rows.
    assert plan(found).count("Aggregate(") == 2 and plan(found).count("Sort [") == 1


def test_encounters_move_once_to_their_daily_counts(spark):
    rows = spark.createDataFrame(
        [(i % 3, 20200125, i % 2, 1, "wellness", 1, 1, 0, 1) for i in range(12)],
        "patient_key long, encounter_date_key int, organization_key long, payer_key long, encounter_class string, "
        "base_cost int, total_claim_cost int, payer_coverage int, out_of_pocket int",
    )
    found = daily.fact_encounter_daily(rows, dt.date(2020, 1, 1), dt.date(2020, 1, 31), NOW)
    assert plan(found).count("Exchange hashpartitioning") == 1
    counted = found.select("organization_key", "encounter_count", "unique_patient_count", "total_base_cost").collect()
    assert sorted(map(tuple, counted)) == [(0, 6, 3, 6), (1, 6, 3, 6)]


def test_tables_are_landed_a_few_at_a_time(spark, given, monkeypatch):
    together = threading.Barrier(2, timeout=30)
    monkeypatch.setattr(LandingZone, "append", lambda *_: together.wait())
    monkeypatch.setattr(staging, "transform_all", lambda *_, **__: {})
    queries._staged_store(spark, given, "test")
    assert not together.broken


def names_below(spark, path):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return [r[0].rsplit("/", 1)[1] for r in files.select("path").collect()]


def test_tables_and_landed_rows_are_written_as_zstd(spark, folder, store):
    store.replace("numbers", spark.range(3).selectExpr("id", "202001 AS month"))
    zone = LandingZone(spark, f"{folder}/landing")
    zone.append(MEDICATIONS, landed(spark, [("P1", "E1", "1")]))
    written(spark.range(2).toDF("n"), "numbers")
    for path in (f"{store.root}/numbers/load=*", f"{folder}/landing"):
        data = [name for name in names_below(spark, path) if name.endswith(".parquet")]
        assert data and all(".zstd." in name for name in data)


def test_extracts_are_compressed_and_land_whole(spark, folder):
    source = landed(spark, [("P1", "E1", "1"), ("P, 2", 'E"2', "2"), ("P3\n", "E3", "")])
    rows = source.select(*MEDICATIONS.column_names)
    path = f"{folder}/{MEDICATIONS.csv}"
    queries._write_csv(rows, path)
    assert all(name.endswith(".csv.gz") for name in names_below(spark, path) if name.startswith("part-"))
    zone = LandingZone(spark, f"{folder}/landing")
    assert load_entity(zone, MEDICATIONS, path, "b1", now=NOW).rows_loaded == 3
    held = zone.read(MEDICATIONS).select(*MEDICATIONS.column_names)
    assert sorted(map(tuple, held.collect())) == sorted(map(tuple, rows.collect()))


@pytest.mark.parametrize("query", [queries.landing_change_detect, queries.upsert_composite])
def test_source_rows_that_are_read_again_are_kept(spark, given, query, monkeypatch):
    asked, real = [], entities.medications
    monkeypatch.setattr(entities, "medications", lambda *a: asked.append(1) or real(*a))
    monkeypatch.setitem(entities.SOURCES, "medications", entities.medications)
    kept, stored = [], queries.stored
    monkeypatch.setattr(queries, "stored", lambda df, purpose: kept.append(purpose) or stored(df, purpose))
    assert query(spark, given).count() > 0
    assert len(asked) == 1 and len(kept) in (1, len(ENTITIES))


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {path for folder in folders for path in Path(folder).rglob("shuffle_*")}


def test_a_write_leaves_no_shuffle_files(spark, folder, store):
    before = shuffle_files(spark)
    rows = spark.range(1000).selectExpr("id % 7 AS n", "202001 AS month").groupBy("n", "month").count()
    assert rows.collect() and shuffle_files(spark) - before
    for write in (
        lambda: written(rows, "numbers"),
        lambda: store.replace("numbers", rows),
        lambda: store.replace_keys("monthly", rows.selectExpr("n", "month * 100 + 1 AS d"), "d", 20200101, 20200131),
        lambda: LandingZone(spark, folder).append(MEDICATIONS, landed(spark, [("P1", "E1", "1")]).repartition(3)),
    ):
        held = shuffle_files(spark)
        write()
        until = time.monotonic() + 20
        while shuffle_files(spark) - held and time.monotonic() < until:
            time.sleep(0.1)
        assert not shuffle_files(spark) - held
    assert spark.conf.get(CLEANUP) == "false"


def test_the_last_writer_gives_the_setting_back(spark):
    inside, leave = threading.Event(), threading.Event()

    def stay():
        with tidied(spark):
            inside.set()
            leave.wait(30)

    other = threading.Thread(target=stay)
    with tidied(spark):
        other.start()
        assert inside.wait(30)
    assert spark.conf.get(CLEANUP) == "true"
    leave.set()
    other.join()
    assert spark.conf.get(CLEANUP) == "false"
    with pytest.raises(ZeroDivisionError), tidied(spark):
        1 / 0
    assert spark.conf.get(CLEANUP) == "false"


def test_prescriptions_are_off_the_shuffles_before_their_lookups(spark, given):
    _, found = queries._medication_fact(spark, given)
    tree = found._jdf.queryExecution().optimizedPlan().toString()
    # Of the sources nothing is left to do, and the sums are as narrow as the table's columns.
    assert "sum(" not in tree and "ENCOUNTER#" not in tree and "decimal(28,2)" not in tree
    rows = found.collect()
    source = facts.medication_source(
        queries.cleaned(spark, given, "medications"), queries.cleaned(spark, given, "encounters"), *queries.WHOLE
    ).collect()
    # Every order's customer but one is a patient; a prescription is a row of patient, day and code.
    assert len(rows) == len(source) > 0
    for name in ("base_cost", "payer_coverage", "dispense_count"):
        assert sum(r[name] for r in rows) == sum(r[name] for r in source)
    assert all(r.out_of_pocket == r.base_cost - r.payer_coverage for r in rows)


def test_patients_are_looked_up_last(spark, given, monkeypatch):
    asked, real = [], facts._with_dimension
    monkeypatch.setattr(facts, "_with_dimension", lambda rows, dim, *a: asked.append(dim.table) or real(rows, dim, *a))
    _, rows = queries._encounter_fact(spark, given)
    assert set(asked) == {dim.table for dim in queries._ALL_DIMS} and asked[-1] == dims.PATIENT.table
    # Orders of customer 3 have no patient.
    assert rows.count() == 6
