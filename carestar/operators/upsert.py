"""Keyed upsert: the newest row of a key wins, nothing is deleted."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def same_key(
    left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str, nullable: bool = True
) -> Column:
    """Equality on all key columns; null-safe (NULL matches NULL) if ``nullable``."""

    def pair(key: str) -> Column:
        ours, theirs = left[key], right[prefix + key]
        return ours.eqNullSafe(theirs) if nullable else ours == theirs

    return reduce(lambda a, b: a & b, map(pair, keys))


def newest_rows(
    source: DataFrame, keys: Sequence[str], order: str, one_row_per_key: bool
) -> DataFrame:
    """Per key, one row of the newest batch, or all rows of the newest batch.

    The first form filters ``row_number() = 1``, which Spark also applies before
    the shuffle, so a key with very many rows reaches its task as at most one
    row per map task. The second form must keep all rows of a key; it finds the
    newest time with a map-side combined aggregate and joins on (key, time), a
    join AQE can split on a hot key, in place of a window that would put the
    whole key into one task.
    """
    if one_row_per_key:
        payload = [F.col(name).cast("string") for name in source.columns]
        newest_first = Window.partitionBy(*keys).orderBy(
            F.col(order).desc(), F.xxhash64(*payload).desc()
        )
        ranked = source.withColumn("_rank", F.row_number().over(newest_first))
        return ranked.where("_rank = 1").drop("_rank")
    newest = source.groupBy(*_prefixed(keys, "_n_")).agg(F.max(order).alias("_newest"))
    match = same_key(source, newest, keys, "_n_") & (source[order] == newest["_newest"])
    return source.join(newest, match, "left_semi")


def one_time(rows: DataFrame, order: str = "update_at") -> bool:
    """Whether all rows have the same time, so that each key's newest batch is all its rows."""
    time = F.col(order)
    low, high, without = rows.agg(F.min(time), F.max(time), F.count_if(time.isNull())).first()
    return low == high and not without


def upsert(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    *,
    now: Column,
    order: str = "update_at",
    one_row_per_key: bool = True,
    nullable_keys: bool = True,
    same_time: bool = False,
) -> DataFrame:
    """``target`` with the rows of ``source`` applied.

    A source row replaces the target row of its key only when its ``order`` is
    later; it then keeps the target's ``create_at``. A source row without a
    target row is inserted with ``create_at = now``. Every other target row
    stays.

    Which keys win is settled on keys and times alone, combined map-side; the
    wide rows of either side are read and moved once. When the batch is small
    its winners are broadcast and the target is scanned without a shuffle. Keys
    known not to be NULL join by plain equality, which reuses the partitioning
    of the ranking. ``same_time`` says that all of ``source`` has one time (``one_time``);
    where all rows of a key's newest batch are kept, a first load then compares nothing.
    """
    if target is None and same_time and not one_row_per_key:
        return source.withColumn("create_at", now)
    if target is None:
        return newest_rows(source, keys, order, one_row_per_key).withColumn("create_at", now)

    latest = source.groupBy(*_prefixed(keys, "_s_")).agg(F.max(order).alias("_latest"))
    held = (
        target.join(latest, same_key(target, latest, keys, "_s_", nullable_keys), "left_semi")
        .groupBy(*_prefixed(keys, "_t_"))
        .agg(F.max(order).alias("_held"), F.min("create_at").alias("_made"))
    )
    pairs = [(F.col(f"_s_{key}"), F.col(f"_t_{key}")) for key in keys]
    match = reduce(
        lambda a, b: a & b, (s.eqNullSafe(t) if nullable_keys else s == t for s, t in pairs)
    )
    winners = (
        latest.join(held, match, "left")
        .where(F.col("_held").isNull() | (F.col("_held") < F.col("_latest")))
        .select(
            *[F.col(f"_s_{key}").alias(f"_w_{key}") for key in keys],
            "_latest",
            F.coalesce("_made", now).alias("_made"),
        )
    )
    untouched = target.join(
        winners, same_key(target, winners, keys, "_w_", nullable_keys), "left_anti"
    )
    if one_row_per_key:
        ranked = newest_rows(source, keys, order, True)
        taken = ranked.join(winners, same_key(ranked, winners, keys, "_w_", nullable_keys))
    else:
        newest = same_key(source, winners, keys, "_w_", nullable_keys)
        taken = source.join(winners, newest & (source[order] == winners["_latest"]))
    return untouched.unionByName(taken.withColumn("create_at", F.col("_made")).select(*target.columns))


def _prefixed(keys: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(key).alias(prefix + key) for key in keys]


def insert_missing(target: DataFrame | None, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``source`` whose key is not in ``target``."""
    if target is None:
        return source
    held = target.select(*keys)
    return source.join(held, list(keys), "left_anti")
