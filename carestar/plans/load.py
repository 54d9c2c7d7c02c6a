"""The warehouse load: calendar, dimensions, facts, daily facts."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestar.functions.dates import FIRST_DAY, LAST_DAY, key_of, moment
from carestar.operators.calendar import calendar, check_range, missing_days
from carestar.operators.dimensions import closed_by
from carestar.operators.lookup import timeline
from carestar.plans import control, daily, dims, facts
from carestar.plans.staging import months_left
from carestar.schemas import ENTITIES, WAREHOUSE
from carestar.session import forgotten, written
from carestar.sources.landing import LandingZone, run_extract, utc_now
from carestar.sources.literal import no_rows
from carestar.sources.store import TableStore

LOAD = "warehouse_load"
CALENDAR = "calendar_load"
EXTRACT = "extract_run"
DROPPED = "dropped_facts"

# The two documented ranges.
FULL_RANGE = (FIRST_DAY, LAST_DAY)
PARTIAL_RANGE = (dt.date(2019, 1, 1), dt.date(2020, 7, 31))


@dataclass(frozen=True)
class Options:
    """Choices where a load can follow one of several rules."""

    valid_from: str = "initial"
    on_missing: str = "drop"
    cumulative: str = "range"
    parallel: int = 8


def extract(
    zone: LandingZone,
    store: TableStore,
    csv_dir: str,
    batch_id: str | None = None,
    **options,
):
    """Land all files, then record watermarks and the run."""
    batch_id = batch_id or str(uuid.uuid4())
    start = utc_now()
    results = run_extract(zone, csv_dir, batch_id, **options)
    control.record_loads(store, batch_id, results)
    counts = {s: sum(r.status == s for r in results) for s in ("SUCCESS", "SKIP", "FAILED")}
    failed = counts["FAILED"] > 0
    control.log_run(
        store,
        EXTRACT,
        batch_id,
        "FAILED" if failed else "SUCCESS",
        start=start,
        rows=sum(r.rows_loaded for r in results),
        error="Some tables failed" if failed else None,
        params=";".join(f"{name}={n}" for name, n in counts.items()),
    )
    return results


def prepare(store: TableStore, now: dt.datetime | None = None) -> None:
    """Create the dimensions that do not exist yet, with their unknown members."""
    now = now or utc_now()
    spark = store.spark
    first: dict[str, tuple] = {"dim_date": (no_rows(spark, WAREHOUSE["dim_date"]),)}
    for dim in dims.HISTORY_DIMS:
        first[dim.table] = (dims.unknown_row(spark, dim, now), None, None, (_SLOT, F.lit(_NEW)))
    for dim in dims.CODE_DIMS:
        first[dim.table] = (dims.unknown_code_row(spark, dim, now),)

    def create(table: str) -> int:
        return 0 if store.exists(table) else store.replace(table, *first[table])

    _together(create, first, len(first))


def load_calendar(
    store: TableStore, first: dt.date, last: dt.date, batch_id: str | None = None
) -> int:
    """Add the days of the range that are missing; logs success or failure."""
    batch_id, start = batch_id or str(uuid.uuid4()), utc_now()
    params = f"StartDate={first};EndDate={last}"
    try:
        check_range(first, last)
        wanted = calendar(store.spark, first, last, moment(start))
        rows = store.append("dim_date", missing_days(store.read("dim_date"), wanted))
    except Exception as error:
        control.log_run(
            store, CALENDAR, batch_id, "FAILED", start=start, error=str(error), params=params
        )
        raise
    control.log_run(store, CALENDAR, batch_id, "SUCCESS", start=start, rows=rows, params=params)
    return rows


def load_codes(store: TableStore, dim: dims.CodeDim, now: dt.datetime) -> int:
    staging = store.read(ENTITIES[dim.staging].staging_table)
    return store.append(dim.table, dims.code_additions(dim, store.read(dim.table), staging, now))


# A type-2 dimension is kept by slots: closed versions, and buckets of the current ones.
_SLOT, _NEW, _CLOSED = "slot_key", "new", "closed"


def _slot(dim: dims.HistoryDim, rows: DataFrame, buckets: int) -> Column:
    """Collated members that are equal may differ in bytes, so they have one bucket."""
    binary = rows.schema[dim.natural_key].dataType.simpleString() == "string"
    number = F.pmod(F.xxhash64(dim.natural_key), F.lit(buckets)) if binary else F.lit(0)
    bucket = F.concat_ws("-", F.lit(buckets), number.cast("string"))
    return F.when(F.col("is_current"), bucket).otherwise(F.lit(_CLOSED))


def load_history(
    store: TableStore,
    dim: dims.HistoryDim,
    as_of: dt.date,
    now: dt.datetime,
    valid_from: str,
    bucket_rows: int = 1_000_000,
) -> int:
    """One type-2 load. The versions it opens are worked out once and written aside; only the
    buckets of their members are opened again and rewritten, and only if there are any. Closed
    versions are a slot that only ever grows. The number of buckets is set by the first load,
    for ``bucket_rows`` members each."""
    slots = store.split_values(dim.table, _SLOT) - {_CLOSED}
    current = store.read_split(dim.table, _SLOT, slots)
    # A version is closed by a later one of a greater key, so current ones have the greatest.
    parts = dims.next_versions(
        current,
        dim.source(Staging(store)),
        last_key=current.agg(F.max(dim.surrogate_key)).scalar(),
        **dims.history_options(dim, as_of, now, valid_from),
    )
    fresh = written(parts.fresh, "versions")
    if fresh.isEmpty():
        return 0
    named = [int(slot.split("-")[0]) for slot in slots - {_NEW}]
    buckets = named[0] if named else -(-fresh.count() // bucket_rows)
    slot = _slot(dim, fresh, buckets)
    # No more names than the dimension has buckets.
    touched = {r[0] for r in fresh.select(slot).distinct().collect()} | (slots & {_NEW})
    held = store.read_split(dim.table, _SLOT, touched)
    carried = closed_by(held, fresh, natural_key=dim.natural_key, as_of=as_of, now=moment(now))
    return store.swap_split(dim.table, carried.unionByName(fresh), (_SLOT, slot), touched)


class Staging(Mapping):
    """The staging tables by entity name, opened when asked for.

    Of the tables named in ``by_month`` only the months of the range are opened.
    """

    def __init__(self, store: TableStore, by_month: tuple[str, ...] = (), low=None, high=None):
        self._store, self._by_month, self._range = store, by_month, (low, high)

    def __getitem__(self, name: str) -> DataFrame:
        table = ENTITIES[name].staging_table
        if name in self._by_month:
            return self._store.read_months(table, *self._range)
        return self._store.read(table)

    def __iter__(self):
        return iter(ENTITIES)

    def __len__(self) -> int:
        return len(ENTITIES)


def read_dims(store: TableStore) -> dict[str, DataFrame]:
    tables = [dim.table for dim in (*dims.HISTORY_DIMS, *dims.CODE_DIMS)]
    return {table: store.read(table) for table in tables}


def with_timelines(store: TableStore, warehouse: dict[str, DataFrame], parallel: int) -> dict:
    """``warehouse`` with the timeline of each history dimension, stored, so that the lookups of
    a load's facts all read it. It is built again only after the dimension was written."""
    by_table = {facts.ranges_of(dim.table): dim for dim in dims.HISTORY_DIMS}

    def build(name: str) -> int:
        dim = by_table[name]
        built, version = store.snapshot(name), store.snapshot(dim.table).version
        if built is not None and built.last_serial == version:
            return 0
        ranges = timeline(warehouse[dim.table], dim.natural_key, dim.surrogate_key)
        return store.replace(name, ranges, serial=version)

    _together(build, by_table, parallel)
    return warehouse | {name: store.read(name) for name in by_table}


def load_facts(store: TableStore, first, last, now, options: Options) -> dict[str, int]:
    warehouse = with_timelines(store, read_dims(store), options.parallel)
    low, high = key_of(first), key_of(last)
    scratch: list[str] = []
    # Conditions and medications look up encounters of any month by id.
    builders: dict[str, tuple[Callable[..., DataFrame], str, str]] = {
        "fact_encounter": (facts.fact_encounter, "encounters", "encounter_date_key"),
        "fact_condition": (facts.fact_condition, "conditions", "start_date_key"),
        "fact_medications": (
            partial(facts.fact_medications, aside=scratch), "medications", "start_date_key"
        ),
    }

    dropped: dict[str, int] = {}

    def load(table: str) -> int:
        build, source, key = builders[table]
        staging = Staging(store, (source,), low, high)
        drops = options.on_missing == "drop"
        rows = build(staging, warehouse, first, last, now, "null" if drops else options.on_missing)
        until = "stop_date_key" if "stop_date_key" in WAREHOUSE[table].names else None
        keep = F.col(dims.PATIENT.surrogate_key).isNotNull() if drops else None
        n, lost = store.replace_kept(table, rows, key, low, high, WAREHOUSE[table].names[0], until, keep)
        aside = facts.dropped_name(table)
        if lost or store.exists(aside):
            rows = no_rows(store.spark, facts.DROPPED)
            if lost:
                rows = facts.dropped(table, staging, warehouse, first, last)
            count = store.replace_keys(aside, rows, "date_key", low, high)
            if count:
                dropped[aside] = count
        return n

    loaded = _together(load, builders, options.parallel) | dropped
    forgotten(store.spark, scratch)
    return loaded


def drop_moved_encounters(store: TableStore, first: dt.date, last: dt.date) -> list[int]:
    """Remove the held facts, outside a range just loaded, of encounters that are in it now.

    An encounter whose start moved into the range has a new fact there; its old one is in a
    month that staging noted when the encounter left it, so no other month is opened. (Where
    staging tables were written past their key index, all months are.) Only the months that
    hold such facts are rewritten. Returns the days that lost facts, for their daily facts to
    be made again.
    """
    low, high = key_of(first), key_of(last)
    inside = F.col("encounter_date_key").between(low, high)
    loaded = store.read_months("fact_encounter", low, high).where(inside)
    ids = loaded.select(F.col("encounter_id").alias("_id"))
    left = months_left(store, ENTITIES["encounters"], ids, "_id")
    if left is not None and not left:
        return []
    held = store.read("fact_encounter") if left is None else store.read_month_set("fact_encounter", left)
    held = held.where(~inside)
    moved = held.join(ids, held["encounter_id"] == ids["_id"], "left_semi")
    days = sorted(r[0] for r in moved.select("encounter_date_key").distinct().collect())
    if days:
        months = {str(day // 100) for day in days}
        rows = store.read_month_set("fact_encounter", months)
        old, match = rows.where(~inside), F.col("encounter_id") == F.col("_id")
        kept = rows.where(inside).unionByName(old.join(ids, match, "left_anti"))
        store.swap_months("fact_encounter", kept, F.col("encounter_date_key"), months)
    return days


def reload_encounter_days(store: TableStore, days: list[int], now: dt.datetime) -> int:
    """Make the daily encounter facts of some days again, a month at a time."""
    rows = 0
    for month in sorted({day // 100 for day in days}):
        low, high = (pick(d for d in days if d // 100 == month) for pick in (min, max))
        first, last = (dt.datetime.strptime(str(key), "%Y%m%d").date() for key in (low, high))
        stays = store.read_months("fact_encounter", low, high)
        daily_rows = daily.fact_encounter_daily(stays, first, last, now)
        serial = WAREHOUSE["fact_encounter_daily"].names[0]
        rows += store.replace_keys("fact_encounter_daily", daily_rows, "date_key", low, high, serial)
    return rows


def load_daily_facts(store: TableStore, first, last, now, options: Options) -> dict[str, int]:
    low, high = key_of(first), key_of(last)
    stays = store.read("fact_encounter")

    def cases() -> DataFrame:
        # Running totals that go on from earlier cases count them all.
        if options.cumulative == "history":
            return store.read_months("fact_condition", None, high)
        return store.read_open("fact_condition", low, high)

    builders: dict[str, Callable[[], DataFrame]] = {
        "fact_encounter_daily": lambda: daily.fact_encounter_daily(
            store.read_months("fact_encounter", low, high), first, last, now
        ),
        "fact_condition_daily": lambda: daily.fact_condition_daily(
            cases(),
            stays,
            first,
            last,
            now,
            options.cumulative,
        ),
        "fact_medication_daily": lambda: daily.fact_medication_daily(
            store.read_open("fact_medications", low, high), first, last, now
        ),
    }

    def load(table: str) -> int:
        serial = WAREHOUSE[table].names[0]
        return store.replace_keys(table, builders[table](), "date_key", low, high, serial)

    return _together(load, builders, options.parallel)


def load_warehouse(
    store: TableStore,
    first: dt.date,
    last: dt.date,
    *,
    as_of: dt.date | None = None,
    batch_id: str | None = None,
    now: dt.datetime | None = None,
    options: Options = Options(),
) -> dict[str, int] | None:
    """Load a date range; rows written per table, or None for a finished batch.

    With ``on_missing="drop"``, source rows without a patient are counted as the facts are
    written; only where there are any, they are read again into ``<fact>_dropped``, which is
    replaced by range like the fact, and counted in the result and in the run log.

    Steps that do not depend on each other run as concurrent Spark jobs. Each
    table is published on its own, so a failed load can be run again; the error
    is logged and raised.
    """
    now = now or utc_now()
    as_of = as_of or now.date()
    batch_id = batch_id or str(uuid.uuid4())
    if control.is_done(store, LOAD, batch_id):
        return None
    start = utc_now()
    params = f"FromDate={first};ToDate={last};AsOfDate={as_of}"
    try:
        check_range(first, last)
        prepare(store, now)
        rows = {"dim_date": load_calendar(store, first, last, batch_id)}
        steps = {d.table: lambda d=d: load_codes(store, d, now) for d in dims.CODE_DIMS}
        steps |= {
            d.table: lambda d=d: load_history(store, d, as_of, now, options.valid_from)
            for d in dims.HISTORY_DIMS
        }
        rows |= _together(lambda table: steps[table](), steps, options.parallel)
        medications = Staging(store, ("medications",), key_of(first), key_of(last))["medications"]
        span = facts.medication_span(medications, first, last)
        rows["dim_date"] += load_calendar(store, *span, batch_id)
        loaded = load_facts(store, first, last, now, options)
        aside = {name: loaded.pop(name) for name in sorted(loaded) if name not in WAREHOUSE}
        rows |= loaded
        left = drop_moved_encounters(store, first, last)
        rows |= load_daily_facts(store, first, last, now, options)
        rows["fact_encounter_daily"] += reload_encounter_days(store, left, now)
    except Exception as error:
        control.log_run(
            store, LOAD, batch_id, "FAILED", start=start, error=str(error), params=params
        )
        raise
    for name, count in aside.items():
        of = f"Table={name};FromDate={first};ToDate={last}"
        control.log_run(store, DROPPED, batch_id, "SUCCESS", start=start, rows=count, params=of)
    total = sum(rows.values())
    control.log_run(store, LOAD, batch_id, "SUCCESS", start=start, rows=total, params=params)
    return rows | aside


def load_full(store: TableStore, **options):
    return load_warehouse(store, *FULL_RANGE, **options)


def load_partial(store: TableStore, **options):
    return load_warehouse(store, *PARTIAL_RANGE, **options)


def _together(load: Callable[[str], int], tables, parallel: int) -> dict[str, int]:
    with ThreadPoolExecutor(parallel) as pool:
        return dict(zip(tables, pool.map(load, tables)))
