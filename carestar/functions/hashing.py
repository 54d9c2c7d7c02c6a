"""Fingerprints of rows and of whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_fingerprint(columns: Sequence[str]) -> Column:
    """SHA-256 over the columns as text, NULL counting as empty text."""
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def content_fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row ``(n_rows, checksum)`` that does not depend on row order.

    The checksum adds 64-bit row hashes in a wide decimal, so it neither
    overflows nor cancels equal rows, and it aggregates map-side.
    """
    row_hash = F.xxhash64(*[F.col(name) for name in columns]).cast("decimal(20,0)")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(row_hash), F.lit(0).cast("decimal(30,0)")).alias("checksum"),
    )
