"""Code dimensions, type-2 dimensions and unknown members."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestar.functions.dates import FIRST_DAY, OPEN_END
from carestar.functions.hashing import row_fingerprint
from carestar.operators.surrogate import dense_ids
from carestar.operators.upsert import insert_missing
from carestar.sources.literal import one_row

UNKNOWN_KEY = -1
UNKNOWN_CODE = "UNKNOWN"
UNKNOWN_HASH = "00"


def new_codes(
    existing: DataFrame | None, source: DataFrame, code: str, description: str, names: Sequence[str]
) -> DataFrame:
    """One row per unseen code, with its greatest description.

    Seen codes are removed before the aggregate, so a reload moves no row of
    theirs.
    """
    code_name, description_name = names
    candidates = source.where(F.col(code).isNotNull()).select(
        F.col(code).alias(code_name), F.col(description).alias(description_name)
    )
    unseen = insert_missing(existing, candidates, [code_name])
    return unseen.groupBy(code_name).agg(F.max(description_name).alias(description_name))


@dataclass(frozen=True)
class Versions:
    """The current versions after a type-2 load."""

    carried: DataFrame  # held before; those with a change are closed now
    fresh: DataFrame  # first and follow-up versions this load opens


def next_versions(
    current: DataFrame,
    source: DataFrame,
    *,
    natural_key: str,
    surrogate_key: str,
    tracked: Sequence[str],
    as_of: dt.date,
    now: Column,
    last_key: Column | None,
    valid_from: str = "initial",
) -> Versions:
    """Compare the current versions with a source snapshot.

    A member whose tracked columns changed is closed on the day before
    ``as_of`` and gets a new version; a new member gets a first version; a
    member missing from the source stays open. A first version starts on
    1900-01-01. A follow-up version does too with ``valid_from="initial"``, or
    starts on ``as_of`` with ``valid_from="as_of"``.

    Each side of each comparison carries only key and hash of the other, so the
    wide rows are shuffled once, or not at all when the other side is small.
    """
    if valid_from not in ("initial", "as_of"):
        raise ValueError(f"unknown valid_from rule {valid_from!r}")
    hashed = source.withColumn("row_hash", row_fingerprint(tracked))

    source_hash = hashed.select(
        F.col(natural_key).alias("_nk"), F.col("row_hash").alias("_source_hash")
    )
    compared = current.join(source_hash, current[natural_key] == F.col("_nk"), "left")
    changed = F.col("_source_hash").isNotNull() & (F.col("_source_hash") != F.col("row_hash"))
    carried = compared.withColumns(
        {name: F.when(changed, new).otherwise(F.col(name)) for name, new in _closed(as_of, now).items()}
    ).select(*current.columns)

    current_hash = current.select(
        F.col(natural_key).alias("_nk"), F.col("row_hash").alias("_current_hash")
    )
    opened = hashed.join(current_hash, hashed[natural_key] == F.col("_nk"), "left").where(
        F.col("_current_hash").isNull() | (F.col("_current_hash") != F.col("row_hash"))
    )
    first_day = F.lit(FIRST_DAY)
    if valid_from == "as_of":
        first_day = F.when(F.col("_current_hash").isNull(), first_day).otherwise(F.lit(as_of))
    opened = (
        opened.withColumn("valid_from", first_day)
        .withColumn("valid_to", F.lit(OPEN_END))
        .withColumn("is_current", F.lit(True))
        .withColumn("create_at", now)
        .withColumn("update_at", now)
        .drop("_nk", "_current_hash")
    )
    fresh = dense_ids(opened, surrogate_key, [natural_key], after=last_key)
    return Versions(carried, fresh.select(*current.columns))


def closed_by(
    current: DataFrame, fresh: DataFrame, *, natural_key: str, as_of: dt.date, now: Column
) -> DataFrame:
    """``current`` with the versions closed that versions of ``fresh`` follow."""
    followed = fresh.select(F.col(natural_key).alias("_nk")).distinct()
    joined = current.join(followed, current[natural_key] == F.col("_nk"), "left")
    closed = _closed(as_of, now)
    return joined.withColumns(
        {name: F.when(F.col("_nk").isNotNull(), new).otherwise(F.col(name)) for name, new in closed.items()}
    ).select(*current.columns)


def _closed(as_of: dt.date, now: Column) -> dict[str, Column]:
    return {
        "valid_to": F.date_sub(F.lit(as_of), 1),
        "is_current": F.lit(False),
        "update_at": now,
    }


def apply_versions(dim: DataFrame, source: DataFrame, **options) -> DataFrame:
    """The whole dimension after one type-2 load; options as ``next_versions``."""
    key = options["surrogate_key"]
    last_key = dim.agg(F.max(key)).scalar()
    parts = next_versions(dim.where("is_current"), source, last_key=last_key, **options)
    history = dim.where(~F.col("is_current"))
    return history.unionByName(parts.carried).unionByName(parts.fresh)


def with_unknown_member(dim: DataFrame, key: str, values: dict[str, object]) -> DataFrame:
    """Add the literal unknown row unless a row with its key is there."""
    literal = one_row(dim.sparkSession, values, dim.schema)
    return dim.unionByName(insert_missing(dim, literal, [key]))


def unknown_version(key: str, natural_key: str, names: dict[str, str], now) -> dict[str, object]:
    """Column values of the unknown member of a type-2 dimension."""
    return {
        key: UNKNOWN_KEY,
        natural_key: UNKNOWN_CODE,
        **names,
        "is_current": True,
        "valid_from": FIRST_DAY,
        "valid_to": OPEN_END,
        "row_hash": UNKNOWN_HASH,
        "create_at": now,
        "update_at": now,
    }
