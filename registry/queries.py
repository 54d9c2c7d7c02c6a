"""One query per operator or operator group; each takes (spark, folder)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.functions import dates, hashing, text
from carestar.operators import calendar as calendars
from carestar.operators import dimensions, intervals, quality, ranges
from carestar.operators.clean import clean
from carestar.operators.lookup import as_of_lookup
from carestar.operators.surrogate import dense_ids
from carestar.operators.upsert import insert_missing, upsert
from carestar.plans import audit, control, daily, dims, facts, load, staging
from carestar.schemas import ENTITIES, FOREIGN_KEYS, UNIQUE, WAREHOUSE
from carestar.schemas import WHOLE as WHOLE_NUMBER
from carestar.session import scratch_dir, written
from carestar.sources.landing import (
    LandingZone,
    load_entity,
    results_frame,
    run_extract,
    same_content,
    stamped,
    summary,
)
from carestar.sources.store import TableStore
from carestar.streaming.files import stream_to_staging
from registry import entities
from registry.entities import landing, table

NOW = dt.datetime(2024, 2, 2, 3, 4, 5)
LATER = dt.datetime(2024, 3, 2, 3, 4, 5)
AS_OF = dt.date(2021, 6, 15)
SPLIT = dt.date(1998, 7, 1)
WHOLE = (dates.FIRST_DAY, dates.LAST_DAY)
DATA_YEARS = (dt.date(1995, 1, 1), dt.date(2001, 12, 31))
CONDITION_DAYS = (dt.date(2024, 1, 1), dt.date(2024, 12, 31))
# Every prescription starts by the end of this range, so every one takes part.
MEDICATION_DAYS = (dt.date(2001, 5, 1), dt.date(2001, 11, 30))


# -- shared inputs ------------------------------------------------------------


def cleaned(spark: SparkSession, folder: str, name: str, **rules) -> DataFrame:
    return clean(landing(spark, folder, name), ENTITIES[name], **rules)


def staged_all(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    return {name: cleaned(spark, folder, name) for name in names}


class Snapshot(Mapping):
    """Cleaned entities by name, planned when asked for."""

    def __init__(self, spark, folder, second: bool = False):
        self._spark, self._folder, self._second = spark, folder, second

    def __getitem__(self, name: str) -> DataFrame:
        again = self._second and name in entities.CHANGES
        raw = entities.second_landing if again else landing
        return clean(raw(self._spark, self._folder, name), ENTITIES[name])

    def __iter__(self):
        return iter(ENTITIES)

    def __len__(self) -> int:
        return len(ENTITIES)


def history_dim(spark, folder, dim: dims.HistoryDim, second: bool = False) -> DataFrame:
    """A type-2 dimension after its first load."""
    rows = dim.source(Snapshot(spark, folder, second))
    options = dims.history_options(dim, dt.date(2020, 1, 1), NOW, "initial")
    return dimensions.apply_versions(dims.unknown_row(spark, dim, NOW), rows, **options)


def code_dim(spark, folder, dim: dims.CodeDim) -> DataFrame:
    first = dims.unknown_code_row(spark, dim, NOW)
    return first.unionByName(
        dims.code_additions(dim, first, cleaned(spark, folder, dim.staging), NOW)
    )


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """A table on shared storage, as later steps of a load would read it."""
    return written(df, purpose)


def history_dims(spark, folder, *wanted: dims.HistoryDim) -> dict[str, DataFrame]:
    def build(dim: dims.HistoryDim) -> DataFrame:
        return stored(history_dim(spark, folder, dim), dim.table)

    with ThreadPoolExecutor(len(wanted)) as pool:
        return dict(zip((dim.table for dim in wanted), pool.map(build, wanted)))


def natural(rows: DataFrame, warehouse: dict[str, DataFrame], *wanted) -> DataFrame:
    """Put natural keys in place of surrogate keys, which differ between systems."""
    for dim in wanted:
        key, name = dim.surrogate_key, getattr(dim, "natural_key", None) or dim.code
        pairs = warehouse[dim.table].select(F.col(key).alias("_k"), F.col(name))
        rows = rows.join(pairs, rows[key] == pairs["_k"], "left").drop(key, "_k")
    return rows


# -- ingest -------------------------------------------------------------------


def _write_csv(rows: DataFrame, path: str) -> None:
    # Extracts are large text, so they come compressed; each part file is one task's.
    (
        rows.write.option("header", True)
        .option("compression", "gzip")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def landing_ingest(spark, folder):
    entity = ENTITIES["patients"]
    root = scratch_dir(spark, "ingest")
    _write_csv(entities.patients(spark, folder), f"{root}/csv/{entity.csv}")
    zone = LandingZone(spark, f"{root}/landing")
    batch, moment = entities.FIRST_BATCH
    result = load_entity(zone, entity, f"{root}/csv/{entity.csv}", batch, now=moment)
    if result.status != "SUCCESS":
        raise RuntimeError(result.error)
    return zone.read(entity)


def landing_contents(spark, folder):
    """All eight entities through files and an extract run: a digest of each landed row."""
    root = scratch_dir(spark, "contents")
    for name, source in entities.SOURCES.items():
        _write_csv(source(spark, folder), f"{root}/csv/{ENTITIES[name].csv}")
    zone = LandingZone(spark, f"{root}/landing")
    batch, moment = entities.FIRST_BATCH
    failed = [r.error for r in run_extract(zone, f"{root}/csv", batch, now=moment) if r.error]
    if failed:
        raise RuntimeError("; ".join(failed))
    parts = []
    for entity in ENTITIES.values():
        cells = [F.coalesce(F.col(name), F.lit("")) for name in entity.column_names]
        digest = F.md5(F.concat_ws("\u001f", *cells).cast("binary"))
        table_name = F.lit(entity.landing_table).alias("table_name")
        parts.append(zone.read(entity).select(table_name, digest.alias("digest"), "batch_id"))
    return reduce(DataFrame.unionByName, parts)


def landing_change_detect(spark, folder):
    """Per entity: would either policy skip the file? Patients changed in place."""
    zone = LandingZone(spark, scratch_dir(spark, "changes"))
    found = []
    for name, entity in ENTITIES.items():
        rows = stored(entities.SOURCES[name](spark, folder), "source")
        zone.append(entity, stamped(rows, *entities.FIRST_BATCH))
        source = entities.changed(rows, name) if name == "patients" else rows
        landed = zone.read(entity)
        # The fingerprint counts the rows of the source as it goes; they are read once.
        by_content, n_source = same_content(source, landed, entity, "fingerprint")
        by_count, _ = same_content(source, landed, entity, "rowcount", lambda n=n_source: n)
        found.append((entity.landing_table, n_source, landed.count(), by_count, by_content))
    return spark.createDataFrame(
        found,
        "table_name string, n_source bigint, n_landed bigint, skip_by_rowcount boolean, "
        "skip_by_fingerprint boolean",
    )


def extract_summary(spark, folder):
    """Land all files; one is missing (FAILED) and one was landed before (SKIP)."""
    root = scratch_dir(spark, "extract")
    for name, source in entities.SOURCES.items():
        if name != "payer_transitions":
            _write_csv(source(spark, folder), f"{root}/csv/{ENTITIES[name].csv}")
    zone = LandingZone(spark, f"{root}/landing")
    held = stamped(entities.providers(spark, folder), *entities.FIRST_BATCH)
    zone.append(ENTITIES["providers"], held)
    store = TableStore(spark, f"{root}/tables")
    results = load.extract(zone, store, f"{root}/csv", "batch-2")
    return summary(results_frame(spark, results))


def stream_landing_upsert(spark, folder):
    """Provider files arriving in two drops, staged by two runs of one stream."""
    entity = ENTITIES["providers"]
    root = scratch_dir(spark, "stream")
    store = TableStore(spark, f"{root}/tables")
    drops = (
        (entities.providers(spark, folder), NOW),
        (entities.second_snapshot(spark, folder, "providers"), LATER),
    )
    for number, (rows, moment) in enumerate(drops):
        _write_csv(rows, f"{root}/csv/drop={number}")
        query = stream_to_staging(
            store, entity, f"{root}/csv/*", f"{root}/checkpoint", now=moment
        )
        query.awaitTermination()
    return store.read(entity.staging_table).drop("batch_id")


def stream_other_header(spark, folder):
    """A stream whose second file has its columns in another order: the run fails, and
    staging holds what the first file brought."""
    entity = ENTITIES["providers"]
    root = scratch_dir(spark, "header")
    store = TableStore(spark, f"{root}/tables")
    rows = entities.providers(spark, folder)
    for number, columns in enumerate((entity.column_names, entity.column_names[::-1])):
        _write_csv(rows.select(*columns), f"{root}/csv/drop={number}")
        query = stream_to_staging(store, entity, f"{root}/csv/*", f"{root}/checkpoint", now=NOW)
        try:
            query.awaitTermination()
            failed = False
        except StreamingQueryException:
            failed = True
    return store.read(entity.staging_table).drop("batch_id").withColumn("second_failed", F.lit(failed))


# -- cleaning and upsert ------------------------------------------------------


def _clean_query(name):
    return lambda spark, folder: cleaned(spark, folder, name)


def clean_blank_dates(spark, folder):
    """Blank stop dates read as 1900-01-01, the parity rule."""
    rows = cleaned(spark, folder, "medications", blank_date="epoch1900")
    return rows.groupBy("STOP").agg(F.count(F.lit(1)).alias("n_rows"))


def clean_collated(spark, folder):
    """Case-blind text: groups that differ only in case fall together."""
    raw = landing(spark, folder, "encounters")
    mixed = raw.withColumn(
        "CODE", F.when(F.col("CODE") == "F", F.lit(" f ")).otherwise(F.lit("F"))
    )
    rows = clean(mixed, ENTITIES["encounters"], collation="UTF8_LCASE_RTRIM")
    return rows.groupBy("CODE").agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows")


def upsert_by_id(spark, folder):
    entity = ENTITIES["patients"]
    target = staging.staged(landing(spark, folder, "patients"), entity, None, NOW)
    newer = entities.second_landing(spark, folder, "patients")
    stale = stamped(
        entities.patients(spark, folder).withColumn("CITY", F.lit("STALE")),
        "batch-0",
        dt.datetime(2023, 1, 1),
    )
    return staging.staged(newer.unionByName(stale), entity, target, LATER)


def upsert_composite(spark, folder):
    """Medications keep all rows of a key's newest batch; NULL codes match."""
    entity = ENTITIES["medications"]
    # Both batches are read several times, as landed rows are.
    first = stored(landing(spark, folder, "medications"), "landed")
    target = staging.staged(first, entity, None, NOW)
    news = stamped(
        first.select(*entity.column_names)
        .where(F.col("REASONCODE") == "R")
        .withColumn("DISPENSES", F.lit("99")),
        *entities.SECOND_BATCH,
    )
    return staging.staged(news, entity, target, LATER)


def staging_incremental(spark, folder):
    """A stored staging table by month after a second batch that moves every seventh encounter
    to one day and brings some new ones; only the batch's months and keys are opened."""
    root = scratch_dir(spark, "incremental")
    zone, store = LandingZone(spark, f"{root}/landing"), TableStore(spark, f"{root}/tables")
    entity = ENTITIES["encounters"]
    first = entities.encounters(spark, folder)
    number = F.regexp_extract("Id", "[0-9]+", 0).cast("bigint")
    moved = first.where(number % 7 == 0).withColumn("START", F.lit("2001-02-03T04:05:06Z"))
    fresh = first.where(number % 97 == 0).withColumn("Id", F.concat(F.lit("N"), "Id"))
    zone.append(entity, landing(spark, folder, "encounters"))
    staging.transform(zone, store, entity, now=NOW)
    zone.append(entity, stamped(moved.unionByName(fresh), *entities.SECOND_BATCH))
    staging.transform(zone, store, entity, now=LATER, batch_ids=[entities.SECOND_BATCH[0]])
    return store.read(entity.staging_table)


def control_upsert(spark, folder):
    counts = reduce(
        DataFrame.unionByName,
        [
            source(spark, folder)
            .agg(F.count(F.lit(1)).alias("rows_loaded"))
            .withColumn("table_name", F.lit(ENTITIES[name].landing_table))
            for name, source in entities.SOURCES.items()
        ],
    )

    def news(batch, moment, rows):
        return rows.withColumn("last_batch_id", F.lit(batch)).withColumn(
            "last_loaded_at", dates.moment(moment)
        )

    held = control.seeded_watermarks(spark, None)
    counts = stored(counts, "counts")
    held = stored(control.updated_watermarks(held, news("batch-1", NOW, counts)), "control")
    big = counts.where(F.col("table_name").isin(*entities.IN_SECOND_BATCH))
    held = stored(control.updated_watermarks(held, news("batch-2", LATER, big)), "control")
    return control.updated_watermarks(held, news("batch-0", dt.datetime(2023, 1, 1), counts))


# -- calendar and dimensions --------------------------------------------------


def dim_date(spark, folder):
    """The calendar of all order days, completed to the span of all shipments."""
    ships = table(spark, folder, "lineitem").agg(
        F.min(F.col("l_shipdate").cast("date")), F.max(F.col("l_shipdate").cast("date"))
    )
    first, last = ships.first()
    held = calendars.calendar_of(table(spark, folder, "orders"), "o_orderdate")
    missing = calendars.missing_days(held, calendars.calendar(spark, first, last))
    return held.unionByName(missing).drop(
        "fiscal_year", "fiscal_quarter", "create_at", "update_at"
    )


def dim_condition_code(spark, folder):
    return code_dim(spark, folder, dims.CONDITION_CODE).select("code", "description")


def dim_medication(spark, folder):
    return code_dim(spark, folder, dims.MEDICATION).drop("medication_key")


def two_loads(spark, folder, dim, as_of=AS_OF, valid_from="initial") -> DataFrame:
    first = stored(history_dim(spark, folder, dim), dim.table)
    options = dims.history_options(dim, as_of, LATER, valid_from)
    rows = dim.source(Snapshot(spark, folder, second=True))
    return dimensions.apply_versions(first, rows, **options)


def _history_query(dim):
    return lambda spark, folder: two_loads(spark, folder, dim).drop(
        dim.surrogate_key, "create_at", "update_at"
    )


def dim_unknown_members(spark, folder):
    """The unknown members next to the counts of ordinary members."""
    parts = []
    for dim in dims.HISTORY_DIMS:
        rows = history_dim(spark, folder, dim)
        label = "first_name" if dim is dims.PATIENT else "name"
        parts.append(
            rows.groupBy((F.col(dim.surrogate_key) == dims.UNKNOWN_KEY).alias("is_unknown")).agg(
                F.lit(dim.table).alias("table_name"),
                F.count(F.lit(1)).alias("n_rows"),
                F.max(F.when(F.col(dim.surrogate_key) == dims.UNKNOWN_KEY, F.col(label))).alias(
                    "label"
                ),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def surrogate_keys(spark, folder):
    """Dense numbering of all orders after the highest customer key."""
    last = table(spark, folder, "customer").agg(F.max("c_custkey")).scalar()
    numbered = dense_ids(
        table(spark, folder, "orders").select("o_orderkey"), "key", ["o_orderkey"], after=last
    )
    return numbered.agg(
        F.min("key").alias("lowest"),
        F.max("key").alias("highest"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("key").alias("n_keys"),
    )


# -- lookups ------------------------------------------------------------------


def _lookup(spark, folder, valid_from):
    dim = stored(
        two_loads(spark, folder, dims.PATIENT, SPLIT, valid_from), "dim_patient"
    )
    visits = cleaned(spark, folder, "encounters").select(
        F.col("Id").alias("encounter_id"),
        F.col("PATIENT").alias("patient"),
        F.to_date("START").alias("day"),
    )
    found = as_of_lookup(
        visits, dim, fact_key="patient", on=F.col("day"),
        natural_key="patient_id", surrogate_key="patient_key",
    )
    versions = dim.select("patient_key", "city", "valid_from", "is_current")
    return found.join(versions, "patient_key", "left").drop("patient_key")


def asof_lookup(spark, folder):
    return _lookup(spark, folder, "as_of")


def asof_lookup_overlap(spark, folder):
    return _lookup(spark, folder, "initial")


def semi_anti(spark, folder):
    """Customers with (EXISTS) and without (NOT EXISTS) orders of a status."""
    done = table(spark, folder, "orders").where("o_orderstatus = 'F'")
    customers = table(spark, folder, "customer").select("c_custkey")
    with_orders = customers.join(done, customers["c_custkey"] == done["o_custkey"], "left_semi")
    without = insert_missing(with_orders, customers, ["c_custkey"])
    return with_orders.withColumn("has_order", F.lit(True)).unionByName(
        without.withColumn("has_order", F.lit(False))
    )


# -- facts --------------------------------------------------------------------

_ALL_DIMS = (dims.PATIENT, dims.PROVIDER, dims.ORGANIZATION, dims.PAYER)
_FACT_ONLY = ("load_dts",)


def _encounter_fact(spark, folder):
    warehouse = history_dims(spark, folder, *_ALL_DIMS)
    rows = facts.fact_encounter(staged_all(spark, folder, "encounters"), warehouse, *WHOLE, NOW)
    return warehouse, rows


def fact_encounter(spark, folder):
    warehouse, rows = _encounter_fact(spark, folder)
    return natural(rows, warehouse, *_ALL_DIMS).drop("fact_encounter_key", *_FACT_ONLY)


def fact_condition(spark, folder):
    wanted = (dims.PATIENT, dims.PROVIDER, dims.ORGANIZATION)
    warehouse = history_dims(spark, folder, *wanted)
    warehouse["dim_condition_code"] = code_dim(spark, folder, dims.CONDITION_CODE)
    rows = facts.fact_condition(
        staged_all(spark, folder, "conditions", "encounters"), warehouse, *WHOLE, NOW
    )
    return natural(rows, warehouse, *wanted, dims.CONDITION_CODE).drop(
        "fact_condition_key", *_FACT_ONLY
    )


def _medication_fact(spark, folder):
    warehouse = history_dims(spark, folder, *_ALL_DIMS)
    warehouse["dim_medication"] = stored(
        code_dim(spark, folder, dims.MEDICATION), "dim_medication"
    )
    rows = facts.fact_medications(
        staged_all(spark, folder, "medications", "encounters"), warehouse, *WHOLE, NOW
    )
    return warehouse, rows


def fact_medications(spark, folder):
    warehouse, rows = _medication_fact(spark, folder)
    return natural(rows, warehouse, *_ALL_DIMS, dims.MEDICATION).drop(
        "fact_medication_key", *_FACT_ONLY
    )


def medication_span(spark, folder):
    """The calendar span that the medication load asks for."""
    low, high = facts.medication_span(cleaned(spark, folder, "medications"), *WHOLE)
    return calendars.calendar(spark, low, high).agg(
        F.min("full_date").alias("low"),
        F.max("full_date").alias("high"),
        F.count(F.lit(1)).alias("n_days"),
    )


def missing_patients(spark, folder):
    """Encounters whose patient is not in the second snapshot."""
    dim = history_dim(spark, folder, dims.PATIENT, second=True)
    rows = facts.encounter_source(cleaned(spark, folder, "encounters"), *WHOLE)
    lost = facts.rows_without_patient(rows, dim, "encounter_date")
    return lost.select("encounter_id", "patient_id")


# -- daily facts --------------------------------------------------------------


def fact_encounter_daily(spark, folder):
    warehouse, rows = _encounter_fact(spark, folder)
    result = daily.fact_encounter_daily(rows, *WHOLE, NOW)
    return natural(result, warehouse, dims.ORGANIZATION, dims.PAYER).drop(
        "daily_key", *_FACT_ONLY
    )


def _condition_daily(spark, folder, first, last, cumulative="range"):
    wanted = (dims.PATIENT, dims.PROVIDER, dims.ORGANIZATION, dims.PAYER)
    warehouse = history_dims(spark, folder, *wanted)
    warehouse["dim_condition_code"] = stored(
        code_dim(spark, folder, dims.CONDITION_CODE), "dim_condition_code"
    )
    inputs = staged_all(spark, folder, "conditions", "encounters")
    cases = facts.fact_condition(inputs, warehouse, *WHOLE, NOW)
    stays = facts.fact_encounter(inputs, warehouse, *WHOLE, NOW)
    result = daily.fact_condition_daily(cases, stays, first, last, NOW, cumulative)
    return natural(result, warehouse, dims.ORGANIZATION, dims.CONDITION_CODE).drop(
        "daily_condition_key", *_FACT_ONLY
    )


def fact_condition_daily(spark, folder):
    return _condition_daily(spark, folder, *CONDITION_DAYS)


def fact_condition_daily_history(spark, folder):
    """A later range whose running total goes on from the cases before it."""
    return _condition_daily(
        spark, folder, dt.date(2024, 1, 16), dt.date(2024, 3, 31), "history"
    )


def fact_medication_daily(spark, folder):
    warehouse, rows = _medication_fact(spark, folder)
    result = daily.fact_medication_daily(rows, *MEDICATION_DAYS, NOW)
    return natural(
        result, warehouse, dims.ORGANIZATION, dims.PAYER, dims.MEDICATION
    ).drop("medication_daily_key", *_FACT_ONLY)


def fact_medication_daily_years(spark, folder):
    """All years of daily rows, rolled up per year and medication."""
    warehouse, rows = _medication_fact(spark, folder)
    result = daily.fact_medication_daily(rows, *DATA_YEARS, NOW)
    return natural(_per_year(result), warehouse, dims.MEDICATION)


def _per_year(daily_rows: DataFrame) -> DataFrame:
    return daily_rows.groupBy(
        F.floor(F.col("date_key") / 10000).cast("int").alias("year"), "medication_key"
    ).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[
            F.sum(name).alias(name)
            for name in (
                "active_patient_count",
                "new_prescriptions",
                "stopped_prescriptions",
                "total_dispense_count",
                "total_base_cost",
                "total_payer_coverage",
                "total_out_of_pocket",
            )
        ],
    )


def cumulative_cases(spark, folder):
    """Running number of events per type and day."""
    events = table(spark, folder, "events")
    per_day = events.groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("new_cases")
    )
    return intervals.running_total(
        per_day, ["event_type"], "day", "new_cases", "cumulative_cases"
    )


def treatment_islands(spark, folder):
    """Unbroken treatment periods per patient and medication."""
    rows = cleaned(spark, folder, "medications")
    return intervals.islands(rows, ["CODE"], "PATIENT", F.col("START"), F.col("STOP"))


def open_orders_daily(spark, folder):
    """Daily status straight on the given tables: shipped, and in use until a stop."""
    first, last = DATA_YEARS
    items = table(spark, folder, "lineitem").select(
        "l_linestatus",
        F.col("l_shipdate").cast("date").alias("start"),
        F.date_add(F.col("l_shipdate").cast("date"), F.col("l_quantity").cast("int")).alias("stop"),
    )
    start, stop, one = F.col("start"), F.col("stop"), F.lit(1).cast("bigint")
    changes = intervals.dated_changes(
        items,
        ["l_linestatus"],
        [
            intervals.point_change(start, first, last, started=one),
            intervals.point_change(stop, first, last, stopped=one),
            *intervals.balance_changes("in_use", start, stop, first, last, stop_day_counts=False),
            *intervals.balance_changes("seen", start, stop, first, last, stop_day_counts=True),
        ],
        dict.fromkeys(("started", "stopped", "in_use", "seen"), "bigint"),
    )
    return intervals.daily_status(
        changes, ["l_linestatus"], last, balances=["in_use", "seen"], points=["started", "stopped"]
    )


# -- storage and loads --------------------------------------------------------


def replace_range(spark, folder):
    """A table of all orders; one date range is reloaded, another is emptied."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", dates.date_key(F.col("o_orderdate")).alias("date_key"), "o_orderstatus"
    )
    store = TableStore(spark, scratch_dir(spark, "range"))
    store.replace_keys("orders", orders, "date_key", 19000101, 20991231)
    reloaded = orders.where(
        F.col("date_key").between(19970115, 19970610) & (F.col("o_orderkey") % 2 == 0)
    ).withColumn("o_orderstatus", F.lit("X"))
    store.replace_keys("orders", reloaded, "date_key", 19970115, 19970610)
    store.replace_keys("orders", orders.where("false"), "date_key", 19990301, 19990331)
    return store.read("orders")


def replace_range_frame(spark, folder):
    """The same reload as a plan over two DataFrames."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    low, high = dt.datetime(1997, 1, 15), dt.datetime(1997, 6, 10)
    reloaded = orders.where(
        F.col("o_orderdate").between(dates.moment(low), dates.moment(high))
        & (F.col("o_orderkey") % 2 == 0)
    ).withColumn("o_orderstatus", F.lit("X"))
    return ranges.replace_range(
        orders, reloaded, "o_orderdate", dates.moment(low), dates.moment(high)
    )


def _staged_store(spark, folder, purpose, **rules) -> TableStore:
    root = scratch_dir(spark, purpose)
    zone, store = LandingZone(spark, f"{root}/landing"), TableStore(spark, f"{root}/tables")
    # As in an extract run, a few at a time: the small tables fill the gaps of the large ones.
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda name: zone.append(ENTITIES[name], landing(spark, folder, name)), ENTITIES))
    staging.transform_all(zone, store, now=NOW, **rules)
    return store


def _row_counts(store: TableStore) -> DataFrame:
    parts = [
        store.read(name).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("table_name", F.lit(name))
        for name in WAREHOUSE
    ]
    return reduce(DataFrame.unionByName, parts)


def load_full(spark, folder):
    """The full range with blank stops as 1900-01-01; rows per table."""
    store = _staged_store(spark, folder, "full", blank_date="epoch1900")
    load.load_full(store, as_of=AS_OF, batch_id="full", now=NOW)
    return _row_counts(store)


def load_partial(spark, folder):
    """The data's own years, the same batch again (skipped), then the partial range."""
    store = _staged_store(spark, folder, "partial")
    load.load_warehouse(store, *DATA_YEARS, as_of=AS_OF, batch_id="first", now=NOW)
    load.load_warehouse(store, *DATA_YEARS, as_of=AS_OF, batch_id="first", now=NOW)
    load.load_partial(store, as_of=AS_OF, batch_id="second", now=LATER)
    return _row_counts(store)


_LOADED: dict[tuple[str, str], TableStore] = {}


def loaded_store(spark, folder) -> TableStore:
    """A warehouse loaded in three ranges, the last of them one month inside the first; the
    queries below read it, so a session loads it once for each folder."""
    known = (spark.sparkContext.applicationId, folder)
    if known not in _LOADED:
        store = _staged_store(spark, folder, "loaded")
        load.load_warehouse(store, *DATA_YEARS, as_of=AS_OF, batch_id="years", now=NOW)
        load.load_warehouse(store, *CONDITION_DAYS, as_of=AS_OF, batch_id="cases", now=NOW)
        month = (dt.date(1998, 6, 1), dt.date(1998, 6, 30))
        load.load_warehouse(store, *month, as_of=AS_OF, batch_id="month", now=LATER)
        _LOADED[known] = store
    return _LOADED[known]


def _loaded(fact, key, *wanted):
    def query(spark, folder):
        store = loaded_store(spark, folder)
        warehouse = {dim.table: store.read(dim.table) for dim in wanted}
        return natural(store.read(fact), warehouse, *wanted).drop(key, *_FACT_ONLY)

    return query


def loaded_fact_medication_daily(spark, folder):
    """The daily rows that the three loads stored, rolled up per year and medication."""
    store = loaded_store(spark, folder)
    warehouse = {dims.MEDICATION.table: store.read(dims.MEDICATION.table)}
    return natural(_per_year(store.read("fact_medication_daily")), warehouse, dims.MEDICATION)


def load_log(spark, folder):
    """The run log of the three loads: what ran, for which batch and range, and how it ended."""
    log = loaded_store(spark, folder).read("etl_run_log").where(F.col("proc_name") == load.LOAD)
    return log.select("proc_name", "batch_id", "status", "params")


# Rows planted into a loaded warehouse: fact, key column, and how many rows in a hundred.
_PLANTED = (
    ("fact_encounter", "patient_key", 7),
    ("fact_condition", "organization_key", 11),
    ("fact_medications", "medication_key", 13),
)


def audit_references(spark, folder):
    """Orphans per foreign key, after some fact rows got keys that no dimension has."""
    store = loaded_store(spark, folder)
    tables = {name: store.read(name) for name in WAREHOUSE}
    for fact, column, divisor in _PLANTED:
        number = F.regexp_extract("encounter_id", "[0-9]+", 0).cast("bigint")
        lost = F.when(number % divisor == 0, F.lit(10**15)).otherwise(F.col(column))
        tables[fact] = tables[fact].withColumn(column, lost)
    return quality.foreign_key_violations(tables, FOREIGN_KEYS)


def audit_keys(spark, folder):
    """Duplicated keys per uniqueness contract, after some encounters were repeated."""
    store = loaded_store(spark, folder)
    tables = {name: store.read(name) for name in UNIQUE}
    number = F.regexp_extract("encounter_id", "[0-9]+", 0).cast("bigint")
    stays = tables["fact_encounter"]
    tables["fact_encounter"] = stays.unionByName(stays.where(number % 7 == 0))
    return quality.unique_violations(tables, UNIQUE, ignore_null=["fact_medication_daily"])


def audit_dropped(spark, folder):
    """What the loads of a warehouse without every ninth patient could make no fact of: the
    tables they set aside, after the patients came and two of the years were loaded again."""
    store = _staged_store(spark, folder, "dropped")
    staged = ENTITIES["patients"].staging_table
    patients = stored(store.read(staged), "patients")
    number = F.regexp_extract("Id", "[0-9]+", 0).cast("bigint")
    store.replace(staged, patients.where(number % 9 != 0))
    warehouse = load.Options()
    load.prepare(store, NOW)
    for dim in dims.CODE_DIMS:
        load.load_codes(store, dim, NOW)
    for dim in dims.HISTORY_DIMS:
        load.load_history(store, dim, AS_OF, NOW, warehouse.valid_from)
    load.load_facts(store, *WHOLE, NOW, warehouse)
    store.replace(staged, patients)
    load.load_history(store, dims.PATIENT, AS_OF, LATER, warehouse.valid_from)
    load.load_facts(store, dt.date(1996, 1, 1), dt.date(1997, 12, 31), LATER, warehouse)
    return audit.dropped(store)


def batch_guard(spark, folder):
    """Which customer batches a log of order runs marks as done."""
    runs = table(spark, folder, "orders").select(
        F.concat(F.lit("B"), F.col("o_custkey").cast("string")).alias("batch_id"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), load.LOAD)
        .otherwise(load.EXTRACT)
        .alias("proc_name"),
        F.when(F.col("o_orderstatus") == "F", "SUCCESS").otherwise("FAILED").alias("status"),
    )
    batches = table(spark, folder, "customer").select(
        F.concat(F.lit("B"), F.col("c_custkey").cast("string")).alias("batch_id")
    )
    done = control.already_succeeded(runs, load.LOAD, batches)
    todo = insert_missing(done, batches, ["batch_id"])
    return done.withColumn("skip", F.lit(True)).unionByName(todo.withColumn("skip", F.lit(False)))


# -- quality ------------------------------------------------------------------


def dq_width(spark, folder):
    return reduce(
        DataFrame.unionByName,
        [
            quality.width_violations(landing(spark, folder, name), entity)
            for name, entity in ENTITIES.items()
        ],
    )


def dq_unique(spark, folder):
    tables = staged_all(spark, folder, "patients", "encounters", "conditions", "medications")
    contracts = {name: ENTITIES[name].keys for name in tables}
    return quality.unique_violations(tables, contracts, ["medications"])


def dq_foreign_keys(spark, folder):
    tables = staged_all(
        spark, folder, "encounters", "conditions", "medications", "organizations", "providers",
        "payers",
    )
    tables["patients"] = Snapshot(spark, folder, second=True)["patients"]
    contracts = {
        ("encounters", "PATIENT"): ("patients", "Id"),
        ("encounters", "ORGANIZATION"): ("organizations", "Id"),
        ("encounters", "PROVIDER"): ("providers", "Id"),
        ("encounters", "PAYER"): ("payers", "Id"),
        ("conditions", "PATIENT"): ("patients", "Id"),
        ("conditions", "ENCOUNTER"): ("encounters", "Id"),
        ("medications", "PATIENT"): ("patients", "Id"),
        ("medications", "ENCOUNTER"): ("encounters", "Id"),
    }
    return quality.foreign_key_violations(tables, contracts)


# -- column functions ---------------------------------------------------------


def text_functions(spark, folder):
    """The text rules on whole documents."""
    return table(spark, folder, "documents").selectExpr(
        "doc_id",
        "length(trim(text)) AS trimmed_length",
        f"md5({text.flattened('text')}) AS flat_md5",
        f"{text.clipped('text', 50)} AS clipped",
        f"{text.blank_to_null(text.clipped('source', 3))} AS source",
        f"{text.to_number(text.clipped('text', 4), WHOLE_NUMBER)} AS number",
    )


def date_functions(spark, folder):
    day = F.col("o_orderdate").cast("date")
    key = dates.date_key(day)
    return table(spark, folder, "orders").select(
        "o_orderkey",
        key.alias("date_key"),
        dates.day_of_key(key).alias("day"),
        F.date_add(day, 30).alias("plus_30"),
        F.date_sub(day, 1).alias("day_before"),
        F.datediff(day, F.lit(SPLIT)).alias("days_since"),
        dates.bounded_date_key(F.add_months(day, 1188)).alias("bounded_key"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.weekofyear(day).alias("week"),
        (F.weekday(day) + 1).alias("weekday"),
        F.date_format(day, "MMMM").alias("month_name"),
    )


def row_hash(spark, folder):
    rows = table(spark, folder, "customer").select(
        "c_custkey",
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("balance"),
        F.lit(None).cast("date").alias("closed"),
    )
    return rows.select(
        "c_custkey",
        hashing.row_fingerprint(["segment", "balance", "closed"]).alias("row_hash"),
    )


QUERIES = {
    "landing_ingest": landing_ingest,
    "landing_contents": landing_contents,
    "landing_change_detect": landing_change_detect,
    "extract_summary": extract_summary,
    "stream_landing_upsert": stream_landing_upsert,
    "stream_other_header": stream_other_header,
    **{f"clean_{name}": _clean_query(name) for name in ENTITIES},
    "clean_blank_dates": clean_blank_dates,
    "clean_collated": clean_collated,
    "upsert_by_id": upsert_by_id,
    "upsert_composite": upsert_composite,
    "staging_incremental": staging_incremental,
    "control_upsert": control_upsert,
    "dim_date": dim_date,
    "dim_condition_code": dim_condition_code,
    "dim_medication": dim_medication,
    **{f"{dim.table}_scd2": _history_query(dim) for dim in dims.HISTORY_DIMS},
    "dim_unknown_members": dim_unknown_members,
    "surrogate_keys": surrogate_keys,
    "asof_lookup": asof_lookup,
    "asof_lookup_overlap": asof_lookup_overlap,
    "semi_anti": semi_anti,
    "fact_encounter": fact_encounter,
    "fact_condition": fact_condition,
    "fact_medications": fact_medications,
    "medication_span": medication_span,
    "missing_patients": missing_patients,
    "fact_encounter_daily": fact_encounter_daily,
    "fact_condition_daily": fact_condition_daily,
    "fact_condition_daily_history": fact_condition_daily_history,
    "fact_medication_daily": fact_medication_daily,
    "fact_medication_daily_years": fact_medication_daily_years,
    "cumulative_cases": cumulative_cases,
    "treatment_islands": treatment_islands,
    "open_orders_daily": open_orders_daily,
    "replace_range": replace_range,
    "replace_range_frame": replace_range_frame,
    "load_full": load_full,
    "load_partial": load_partial,
    "loaded_fact_encounter": _loaded("fact_encounter", "fact_encounter_key", *_ALL_DIMS),
    "loaded_fact_condition": _loaded(
        "fact_condition", "fact_condition_key", dims.PATIENT, dims.PROVIDER, dims.ORGANIZATION,
        dims.CONDITION_CODE,
    ),
    "loaded_fact_medications": _loaded(
        "fact_medications", "fact_medication_key", *_ALL_DIMS, dims.MEDICATION
    ),
    "loaded_fact_condition_daily": _loaded(
        "fact_condition_daily", "daily_condition_key", dims.CONDITION_CODE, dims.ORGANIZATION
    ),
    "loaded_fact_encounter_daily": _loaded(
        "fact_encounter_daily", "daily_key", dims.ORGANIZATION, dims.PAYER
    ),
    "loaded_fact_medication_daily": loaded_fact_medication_daily,
    "load_log": load_log,
    "audit_references": audit_references,
    "audit_keys": audit_keys,
    "audit_dropped": audit_dropped,
    "batch_guard": batch_guard,
    "dq_width": dq_width,
    "dq_unique": dq_unique,
    "dq_foreign_keys": dq_foreign_keys,
    "text_functions": text_functions,
    "date_functions": date_functions,
    "row_hash": row_hash,
}
