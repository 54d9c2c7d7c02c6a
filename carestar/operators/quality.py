"""Data contracts as counted violations."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.schemas import Entity


def width_violations(landing: DataFrame, entity: Entity) -> DataFrame:
    """``(table_name, column_name, too_long, missing)`` per column, in one scan."""
    counts = []
    for column in entity.columns:
        value = F.col(column.name)
        too_long = F.count_if(F.length(value) > column.width)
        missing = F.count_if(value.isNull()) if column.required else F.lit(0).cast("bigint")
        counts.append(
            F.struct(
                F.lit(column.name).alias("column_name"),
                too_long.alias("too_long"),
                missing.alias("missing"),
            )
        )
    return landing.agg(F.array(*counts).alias("checks")).select(
        F.lit(entity.landing_table).alias("table_name"), F.inline("checks")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], ignore_null: bool = False) -> DataFrame:
    """The key values that occur more than once, with their row count."""
    if ignore_null:
        df = df.where(reduce(lambda a, b: a & b, (F.col(key).isNotNull() for key in keys)))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def unique_violations(
    tables: dict[str, DataFrame], contracts: dict[str, Sequence[str]], ignore_null: Iterable[str]
) -> DataFrame:
    """``(table_name, key_columns, duplicated_keys)`` per contract."""
    parts = []
    for table, keys in contracts.items():
        repeated = duplicate_keys(tables[table], keys, table in set(ignore_null))
        parts.append(
            repeated.agg(F.count(F.lit(1)).alias("duplicated_keys")).select(
                F.lit(table).alias("table_name"),
                F.lit(",".join(keys)).alias("key_columns"),
                "duplicated_keys",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def orphans(fact: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose non-NULL key has no dimension row."""
    keyed = fact.where(F.col(column).isNotNull())
    return keyed.join(dim.select(F.col(key).alias("_key")), F.col(column) == F.col("_key"), "left_anti")


def foreign_key_violations(
    tables: dict[str, DataFrame], contracts: dict[tuple[str, str], tuple[str, str]]
) -> DataFrame:
    """``(fact_table, fact_column, dim_table, orphan_rows)`` per contract.

    Facts are first counted per key value, so what meets the dimension is one
    row per key, not one per fact: hot keys cost nothing.
    """
    parts = []
    for (fact, column), (dim, key) in contracts.items():
        per_key = tables[fact].groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
        lost = orphans(per_key, column, tables[dim], key)
        parts.append(
            lost.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_rows")).select(
                F.lit(fact).alias("fact_table"),
                F.lit(column).alias("fact_column"),
                F.lit(dim).alias("dim_table"),
                "orphan_rows",
            )
        )
    return reduce(DataFrame.unionByName, parts)
