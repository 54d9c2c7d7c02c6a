"""Landing to staging."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestar.functions.dates import date_key, moment
from carestar.operators.clean import clean
from carestar.operators.upsert import one_time, same_key, upsert
from carestar.schemas import ENTITIES, Entity
from carestar.session import written
from carestar.sources.landing import LandingZone, utc_now
from carestar.sources.store import TableMissing, TableStore

# Rows in a bucket of a staging table without months, or of the key index of one with months.
# The number of buckets is part of each one's name, so a table keeps the number it began with.
BUCKET_ROWS = 100_000
MOST_BUCKETS = 4096
_BUCKET = "bucket_key"
_MONTH_OF_KEY = "_month"


def staged(
    landing: DataFrame,
    entity: Entity,
    target: DataFrame | None,
    now: dt.datetime,
    **rules,
) -> DataFrame:
    """``target`` after cleaning and upserting landed rows; rules as ``clean``."""
    same_time = target is None and _one_batch(landing, entity)
    return merged(clean(landing, entity, **rules), entity, target, now, same_time)


def _one_batch(landing: DataFrame, entity: Entity) -> bool:
    """Whether a first load may keep all rows as they are, as they are of one time."""
    return not entity.one_row_per_key and one_time(landing)


def merged(
    cleaned: DataFrame,
    entity: Entity,
    target: DataFrame | None,
    now: dt.datetime,
    same_time: bool = False,
) -> DataFrame:
    columns = [*entity.column_names, "create_at", "update_at", "batch_id"]
    return upsert(
        target,
        cleaned,
        entity.keys,
        now=moment(now),
        one_row_per_key=entity.one_row_per_key,
        # The key filter of a single-key table leaves no NULL key.
        nullable_keys=len(entity.keys) > 1,
        same_time=same_time,
    ).select(*columns)


def key_index(entity: Entity) -> str:
    """The table that tells in which months a key has, or once had, rows."""
    return f"{entity.staging_table}_keys"


def key_moves(entity: Entity) -> str:
    """The table of keys that left a month, with that month; a NULL month stands for moves
    that nobody wrote down."""
    return f"{entity.staging_table}_moves"


def _bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> tuple[str, Column]:
    """Rows of equal keys share a bucket. Equal texts of a collation may differ in bytes, so
    collated keys have one bucket."""
    binary = all("collate" not in df.schema[k].dataType.simpleString() for k in keys)
    number = F.pmod(F.xxhash64(*keys), F.lit(buckets)) if binary else F.lit(0)
    return _BUCKET, F.concat_ws("-", F.lit(buckets), number.cast("string"))


def _buckets_for(df: DataFrame) -> int:
    return min(max(1, -(-df.count() // BUCKET_ROWS)), MOST_BUCKETS)


def _values(df: DataFrame, value: Column) -> set[str | None]:
    """The distinct values of a split: no more than a table has buckets or months."""
    return {r[0] for r in df.select(value.cast("string")).distinct().collect()}


def _buckets_held(store: TableStore, table: str) -> int | None:
    names = store.split_values(table, _BUCKET)
    return int(min(names).split("-")[0]) if names and store.is_split(table, _BUCKET) else None


def _state(store: TableStore, table: str) -> int | None:
    """A number that no two contents of a staging table share: the one its writer gave it, or
    for a table written past this module its version."""
    held = store.snapshot(table)
    return None if held is None else held.last_serial or -held.version


def index_holds(store: TableStore, entity: Entity) -> bool:
    """Whether the index describes the table as it is; a write that went past it shows."""
    index = store.snapshot(key_index(entity))
    return index is not None and index.last_serial == _state(store, entity.staging_table)


def _as_first_loaded(store: TableStore, entity: Entity) -> bool:
    """Whether a table is as its first load left it; no key has left a month then."""
    held = store.snapshot(entity.staging_table)
    return held is not None and held.version == 1 and held.last_serial > 0


def _month_of(entity: Entity) -> Column:
    return F.floor(date_key(F.col(entity.day_column)) / 100).cast("string").alias(_MONTH_OF_KEY)


def _write_index(store: TableStore, entity: Entity) -> None:
    entries = store.read(entity.staging_table).select(*entity.keys, _month_of(entity)).distinct()
    split = _bucket(entries, entity.keys, _buckets_for(store.read(entity.staging_table)))
    store.replace(key_index(entity), entries, split=split, serial=_state(store, entity.staging_table))


def _matching(rows: DataFrame, batch: DataFrame, entity: Entity, how: str, month: bool = False) -> DataFrame:
    """Rows whose key (and month) is, or is not, in the batch."""
    names = [*entity.keys, *([_MONTH_OF_KEY] if month else [])]
    keys = batch.select(*[F.col(k).alias(f"_b_{k}") for k in names]).distinct()
    return rows.join(keys, same_key(rows, keys, names, "_b_", month or len(entity.keys) > 1), how)


def stage(
    store: TableStore, entity: Entity, landing: DataFrame, now: dt.datetime, **rules
) -> int:
    """Apply landed rows to a stored staging table; returns the rows written.

    A table kept by month opens and gives up only the months that the batch brings rows for
    and those that hold rows of its keys, which the key index tells; of the index, only the
    buckets of the batch's keys are opened. The index is made by the first batch after the first
    load. A table without months is kept by buckets of its
    keys, and only those of the batch are opened. The index is published before the table it
    describes and may name months too many, never too few.
    """
    cleaned = clean(landing, entity, **rules)
    if entity.day_column is None:
        return _stage_by_bucket(store, entity, landing, cleaned, now)
    return _stage_by_month(store, entity, landing, cleaned, now)


def _stage_by_bucket(
    store: TableStore, entity: Entity, landing: DataFrame, cleaned: DataFrame, now: dt.datetime
) -> int:
    table = entity.staging_table
    buckets = _buckets_held(store, table) if store.exists(table) else None
    if buckets is None:
        rows = merged(cleaned, entity, store.read_or_none(table), now)
        return store.replace(table, rows, split=_bucket(cleaned, entity.keys, _buckets_for(landing)))
    split = _bucket(cleaned, entity.keys, buckets)
    cleaned = written(cleaned, "batch")
    touched = _values(cleaned, split[1])
    if not touched:
        return 0
    rows = merged(cleaned, entity, store.read_split(table, _BUCKET, touched), now)
    return store.swap_split(table, rows, split, touched)


def _stage_by_month(
    store: TableStore, entity: Entity, landing: DataFrame, cleaned: DataFrame, now: dt.datetime
) -> int:
    table, index = entity.staging_table, key_index(entity)
    month_of = date_key(F.col(entity.day_column))
    state = uuid.uuid4().int >> 65
    if not store.exists(table):
        rows = merged(cleaned, entity, None, now, _one_batch(landing, entity))
        return store.replace(table, rows, month_of=month_of, serial=state)
    may_move = entity.day_column not in entity.keys
    if not index_holds(store, entity):
        # The first batch after the first load, or after a write from elsewhere.
        known = _as_first_loaded(store, entity)
        if not store.is_split(table, "month_key"):
            store.replace(table, store.read(table), month_of=month_of)
        _write_index(store, entity)
        if may_move and not known:
            store.append(key_moves(entity), _unknown_moves(store.read(table), entity))
    cleaned = written(cleaned, "batch")
    news = cleaned.select(*entity.keys, _month_of(entity)).distinct()
    split = _bucket(news, entity.keys, _buckets_held(store, index) or 1)
    touched = _values(news, split[1])
    if not touched:
        return 0
    held = store.read_split(index, _BUCKET, touched)
    met = _matching(held, news, entity, "left_semi")
    months = _values(news.select(_MONTH_OF_KEY).unionAll(met.select(_MONTH_OF_KEY)), F.col(_MONTH_OF_KEY))
    if may_move:
        left = met.where(F.col(_MONTH_OF_KEY).isNotNull())
        store.append(key_moves(entity), _matching(left, news, entity, "left_anti", month=True))
    entries = held.unionByName(news).distinct()
    store.swap_split(index, entries, split, touched, state)
    rows = merged(cleaned, entity, store.read_month_set(table, months), now)
    return store.swap_months(table, rows, month_of, months, state)


def _unknown_moves(table: DataFrame, entity: Entity) -> DataFrame:
    nothing = [F.lit(None).cast(table.schema[k].dataType).alias(k) for k in entity.keys]
    return table.sparkSession.range(1).select(*nothing, F.lit(None).cast("string").alias(_MONTH_OF_KEY))


def months_left(store: TableStore, entity: Entity, ids: DataFrame, column: str) -> set[str] | None:
    """The months that some keys once had rows in and left; None if that is not known."""
    if _as_first_loaded(store, entity):
        return set()
    if not index_holds(store, entity):
        return None
    moves = store.read_or_none(key_moves(entity))
    if moves is None:
        return set()
    (key,) = entity.keys
    met = moves.join(ids, moves[key] == ids[column], "left_semi").select(_MONTH_OF_KEY)
    unknown = moves.where(F.col(_MONTH_OF_KEY).isNull()).select(_MONTH_OF_KEY)
    months = _values(met.unionAll(unknown), F.col(_MONTH_OF_KEY))
    return None if None in months else months


def transform(
    zone: LandingZone,
    store: TableStore,
    entity: Entity,
    *,
    now: dt.datetime | None = None,
    batch_ids: list[str] | None = None,
    **rules,
) -> int:
    """Bring one staging table up to date with landing.

    Without ``batch_ids`` all of landing is read; older rows lose against the
    staged ones. Naming the batches not staged yet reads only those.
    """
    if not zone.exists(entity):
        raise TableMissing(f"required table {entity.landing_table} is missing")
    return stage(store, entity, zone.read(entity, batch_ids), now or utc_now(), **rules)


def transform_all(
    zone: LandingZone, store: TableStore, *, parallel: int = 4, **options
) -> dict[str, int]:
    """All eight staging tables, as independent jobs; rows per table."""
    with ThreadPoolExecutor(parallel) as pool:
        rows = pool.map(lambda e: transform(zone, store, e, **options), ENTITIES.values())
        return dict(zip((e.staging_table for e in ENTITIES.values()), rows))
