"""As-of lookup of a type-2 dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SEEN = """filter(all, v -> v.key = top.key
    OR v.valid_from < top.valid_from OR v.valid_to > top.valid_to)"""
_CUTS = """array_sort(array_distinct(concat(
    transform(seen, v -> v.valid_from), transform(seen, v -> date_add(v.valid_to, 1)))))"""
_PIECES = """if(size(seen) = 1,
    array(named_struct('_from', top.valid_from, '_to', top.valid_to, '_key', top.key)),
    transform(cuts, (cut, place) -> named_struct(
        '_from', cut,
        '_to', date_sub(get(cuts, place + 1), 1),
        '_key', array_max(filter(seen, v -> cut BETWEEN v.valid_from AND v.valid_to)).key)))"""


def timeline(dim: DataFrame, natural_key: str, surrogate_key: str) -> DataFrame:
    """Disjoint day ranges ``(_nk, _from, _to, _key)`` per member.

    On a day that several versions of a member cover, the one with the latest
    ``valid_from`` holds; on a tie, the newest one (the greatest surrogate key).
    The work is on the dimension side only, once. A load adds at most one
    version to a member, so the list of a member is no longer than the number
    of loads, and versions that the top one hides are dropped before they count.
    """
    version = F.expr(f"struct(valid_from, {surrogate_key} AS key, valid_to)")
    members = (
        dim.where("valid_from <= valid_to")
        .groupBy(F.col(natural_key).alias("_nk"))
        .agg(F.collect_list(version).alias("all"), F.max(version).alias("top"))
    )
    return (
        members.selectExpr("_nk", "top", f"{_SEEN} AS seen")
        .selectExpr("_nk", "top", "seen", f"{_CUTS} AS cuts")
        .selectExpr("_nk", f"inline({_PIECES})")
        .where("_key IS NOT NULL AND _to IS NOT NULL")
    )


def as_of_lookup(
    facts: DataFrame,
    dim: DataFrame,
    *,
    fact_key: str,
    on: Column,
    natural_key: str,
    surrogate_key: str,
    output: str | None = None,
    ranges: DataFrame | None = None,
) -> DataFrame:
    """Add the surrogate key of the version valid on day ``on``; NULL if none.

    ``ranges`` is the timeline of ``dim`` where the caller has it already.

    Ranges of a member are disjoint, so the join keeps the fact rows as they
    are: no row is multiplied and nothing is aggregated afterwards. A small
    dimension is broadcast from its measured size. A large one is shuffled; the
    second, redundant key makes both inputs of that join plain shuffles, the
    form in which AQE can split the partition of a hot member.
    """
    if ranges is None:
        ranges = timeline(dim, natural_key, surrogate_key)
    match = (facts[fact_key] == ranges["_nk"]) & on.between(ranges["_from"], ranges["_to"])
    if _binary_text(facts, fact_key):
        match = match & (F.xxhash64(facts[fact_key]) == F.xxhash64(ranges["_nk"]))
    joined = facts.join(ranges, match, "left")
    name = output or surrogate_key
    return joined.withColumnRenamed("_key", name).select(*facts.columns, name)


def _binary_text(df: DataFrame, name: str) -> bool:
    """Equal values have equal bytes (not so under a case-blind collation)."""
    return df.schema[name].dataType.simpleString() == "string"
