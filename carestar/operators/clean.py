"""Landing text to typed staging rows: one narrow projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame

from carestar.functions import text
from carestar.schemas import Column, Entity


def _typed(column: Column, blank_date: str, squash: str) -> str:
    raw, spec = column.name, column.spec
    if column.rule == "id":
        return text.clipped(raw, spec)
    if column.rule == "text":
        return text.blank_to_null(text.clipped(raw, spec))
    if column.rule == "flat":
        return text.blank_to_null(f"substring({text.flattened(raw, squash)}, 1, {spec})")
    if column.rule == "when":
        return text.to_when(raw, spec, blank_date)
    if column.rule == "number":
        return text.to_number(raw, spec)
    raise ValueError(f"unknown rule {column.rule!r}")


def clean(
    landing: DataFrame,
    entity: Entity,
    *,
    blank_date: str = "null",
    squash: str = "control",
    collation: str | None = None,
) -> DataFrame:
    """Drop rows without a key and apply the rule of every column.

    ``collation`` (for example ``UTF8_LCASE_RTRIM``) makes all text columns, and
    so every later join, group and maximum on them, use that collation.
    """
    projected = []
    for column in entity.columns:
        value = _typed(column, blank_date, squash)
        if collation and isinstance(column.spec, int):
            value = f"collate({value}, '{collation}')"
        projected.append(f"{value} AS {column.name}")
    kept = landing.where(f"trim({entity.filter_column}) <> ''")
    return kept.selectExpr(*projected, "batch_id", "update_at")
