"""Surrogate keys without a single-partition numbering step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

LEAST_BUCKETS = 1024


def dense_ids(
    df: DataFrame,
    name: str,
    by: Sequence[str],
    after: Column | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Number the rows ``after + 1 …`` without gaps, as a function of the data alone.

    Rows are spread over hash buckets of ``by``, numbered inside each bucket and
    moved up by the sizes of the buckets before. There are 1,024 buckets, or as many
    as the session has shuffle partitions if these are more, so that a large first
    load has work for all tasks; the offset table has a row for each and is
    broadcast. The numbers do not depend on where rows lie, so a recomputed task
    gives the same keys. ``by`` must be unique.
    """
    if buckets is None:
        buckets = max(LEAST_BUCKETS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    start = F.greatest(F.coalesce(after, F.lit(0)), F.lit(0)) if after is not None else F.lit(0)
    bucketed = df.withColumn("_bucket", F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int"))
    # ``_all`` is one group of at most ``buckets`` rows.
    before = Window.partitionBy("_all").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_all", F.lit(0))
        .select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_bucket").orderBy(*by)
    return (
        bucketed.withColumn("_place", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, (start + F.col("_before") + F.col("_place")).cast("bigint"))
        .drop("_bucket", "_place", "_before")
    )


def unique_ids(df: DataFrame, name: str, after: int = 0) -> DataFrame:
    """Fill a NULL key column with unique, not gap-free keys and no shuffle, for facts.

    Nothing refers to a fact's key. The numbers depend on the place of a row in
    its task, so they belong into the stage that writes: a repeated task then
    replaces all of its output.
    """
    fresh = F.monotonically_increasing_id() + F.lit(after + 1)
    return df.withColumn(name, F.coalesce(F.col(name), fresh))
