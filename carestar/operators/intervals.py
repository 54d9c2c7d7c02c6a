"""Daily status of intervals, without pairing facts with days.

An interval with start ``a`` and end ``b`` becomes at most three dated changes.
Changes are summed per (group, day) with a map-side combine, so a window over a
group sees at most one row per calendar day however many facts the group has.
Running sums of the changes give the balance on each day, and constant stretches
are unfolded to days only at the end. Work is facts + output rows, where the
pairing form needs facts x days.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


@dataclass(frozen=True)
class Change:
    """A measure change of one row on one day; a NULL day means no change."""

    day: Column
    measures: dict[str, Column]


def balance_changes(
    name: str,
    start: Column,
    stop: Column,
    first: dt.date,
    last: dt.date,
    *,
    stop_day_counts: bool,
    only: Column | None = None,
) -> list[Change]:
    """+1 when the interval opens inside the range, -1 when it closes.

    With ``stop_day_counts`` the interval covers its stop day, otherwise it ends
    the day before; a NULL stop leaves it open to the end of the range.
    """
    end = F.date_add(stop, 1) if stop_day_counts else stop
    covers = stop.isNull() | ((end > start) & (end > F.lit(first)))
    covers = covers & (start <= F.lit(last))
    if only is not None:
        covers = covers & F.coalesce(only, F.lit(False))
    return [
        Change(F.when(covers, F.greatest(start, F.lit(first))), {name: F.lit(1).cast("bigint")}),
        Change(F.when(covers & (end <= F.lit(last)), end), {name: F.lit(-1).cast("bigint")}),
    ]


def point_change(day: Column, first: dt.date, last: dt.date, **measures: Column) -> Change:
    """Amounts that count on one day only, if the day is in the range."""
    return Change(F.when(day.between(F.lit(first), F.lit(last)), day), measures)


def dated_changes(
    df: DataFrame, group: Sequence[str], changes: Sequence[Change], measures: dict[str, str]
) -> DataFrame:
    """One row per change: the group, ``_day`` and every measure (0 if not its own)."""

    def row(change: Change) -> Column:
        values = [
            F.coalesce(change.measures.get(name, F.lit(0)), F.lit(0)).cast(kind).alias(name)
            for name, kind in measures.items()
        ]
        return F.struct(change.day.alias("_day"), *values)

    return df.select(*group, F.inline(F.array(*[row(c) for c in changes]))).where(
        F.col("_day").isNotNull()
    )


def daily_status(
    changes: DataFrame,
    group: Sequence[str],
    last: dt.date,
    *,
    balances: Sequence[str],
    points: Sequence[str],
    shown_by: Sequence[str] | None = None,
    running: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Days of each group on which a balance or a point measure is above zero.

    ``shown_by`` limits the point measures that make a day appear.

    ``balances`` are carried forward from change to change, ``points`` count on
    their own day only. ``running`` names running totals and the measures they
    add up; they hold still between changes.
    """
    running = running or {}
    added = [m for ms in running.values() for m in ms if m not in points]
    measures = list(dict.fromkeys([*balances, *points, *added]))
    per_day = changes.groupBy(*group, "_day").agg(*[F.sum(m).alias(m) for m in measures])

    by_day = Window.partitionBy(*group).orderBy("_day")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = per_day.select(
        *group,
        "_day",
        *points,
        *[F.sum(m).over(so_far).alias(m) for m in balances],
        *[
            sum((F.sum(m).over(so_far) for m in ms), F.lit(0)).alias(total)
            for total, ms in running.items()
        ],
        F.coalesce(F.lead("_day").over(by_day), F.date_add(F.lit(last), 1)).alias("_next"),
    )
    holds = F.lit(False)
    for name in balances:
        holds = holds | (F.col(name) > 0)
    happens = F.lit(False)
    for name in points if shown_by is None else shown_by:
        happens = happens | (F.col(name) > 0)

    # A stretch with an open balance unfolds to all its days; one without keeps
    # only its first day, and only if something happened on it.
    until = F.when(holds, F.date_sub("_next", 1)).otherwise(F.col("_day"))
    days = carried.where(holds | happens).select(
        *group,
        *balances,
        *running,
        *points,
        F.col("_day").alias("_first"),
        F.explode(F.sequence("_day", until)).alias("day"),
    )
    own_day = F.col("day") == F.col("_first")
    return days.select(
        *group,
        "day",
        *balances,
        *running,
        *[F.when(own_day, F.col(m)).otherwise(F.lit(0)).alias(m) for m in points],
    )


def islands(
    df: DataFrame, group: Sequence[str], entity: str, start: Column, stop: Column
) -> DataFrame:
    """Union of the half-open intervals [start, stop) of each (group, entity).

    A NULL stop is open-ended. Empty intervals are dropped, and intervals that
    begin on one day are folded into their longest with a map-side combine, so a
    window sees at most one row per calendar day. The rows that open an island are
    picked in the order of that window, with one sort and no aggregate after it.
    """
    keys = [*group, entity]
    far = F.lit(dt.date(9999, 12, 31))
    longest = (
        df.select(*keys, start.alias("_start"), F.coalesce(stop, far).alias("_stop"))
        .where(F.col("_stop") > F.col("_start"))
        .groupBy(*keys, "_start")
        .agg(F.max("_stop").alias("_stop"))
    )
    in_order = Window.partitionBy(*keys).orderBy("_start")
    reached = F.max("_stop").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    furthest = F.max("_stop").over(
        in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    opening = longest.select(
        *keys, "_start", reached.alias("_reached"), furthest.alias("_furthest")
    ).where(F.col("_reached").isNull() | (F.col("_start") > F.col("_reached")))
    # An island ends where the intervals before the next one reach.
    end = F.coalesce(F.lead("_reached").over(in_order), F.col("_furthest"))
    return opening.select(*keys, F.col("_start").alias("start"), end.alias("_stop")).select(
        *keys, "start", F.when(F.col("_stop") != far, F.col("_stop")).alias("stop")
    )


def running_total(
    df: DataFrame, group: Sequence[str], order: str, measure: str, name: str
) -> DataFrame:
    """Running sum of a measure inside each group, in ``order``."""
    window = (
        Window.partitionBy(*group)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(name, F.sum(measure).over(window))
