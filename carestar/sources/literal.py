"""Small literal tables that the optimizer can see into."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table; joins and unions with it are planned away."""
    return one_row(spark, {}, schema).where("false")


def one_row(spark: SparkSession, values: dict[str, object], schema: T.StructType) -> DataFrame:
    """A single row; columns without a value are NULL."""
    return few_rows(spark, [values], schema)


def few_rows(
    spark: SparkSession, rows: Sequence[dict[str, object]], schema: T.StructType
) -> DataFrame:
    """A handful of rows known to the caller, such as one per entity.

    Values travel as statement parameters; times as text, which no session time
    zone can shift.
    """
    if not rows:
        return no_rows(spark, schema)
    selects, arguments = [], {}
    for number, values in enumerate(rows):
        columns = []
        for place, field in enumerate(schema):
            value = values.get(field.name)
            mark = "NULL"
            if value is not None:
                name = f"v{number}_{place}"
                text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value
                arguments[name], mark = text, f":{name}"
            columns.append(f"CAST({mark} AS {field.dataType.simpleString()}) AS {field.name}")
        selects.append("SELECT " + ", ".join(columns))
    return spark.sql(" UNION ALL ".join(selects), args=arguments)
