"""Range replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replace_range(
    old: DataFrame, new: DataFrame, column: str, low: object, high: object
) -> DataFrame:
    """``old`` without its rows in the inclusive range, plus ``new``."""
    outside = old.where(~F.col(column).between(low, high) | F.col(column).isNull())
    return outside.unionByName(new)
