"""Entity extracts as text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from carestar.schemas import Entity
from carestar.sources.literal import no_rows


class UnexpectedColumns(ValueError):
    """The file has columns the landing table has not."""


@dataclass(frozen=True)
class CsvFile:
    path: str
    rows: int | None  # None where a cell holds a line break: lines are not rows then


@dataclass(frozen=True)
class Extract:
    """The rows of an extract, and their number as far as it is known without parsing them."""

    rows: DataFrame
    counted: int
    uncounted: DataFrame | None = None

    def count(self) -> int:
        return self.counted + (0 if self.uncounted is None else self.uncounted.count())


def look_through(spark: SparkSession, path: str | Sequence[str]) -> list[CsvFile]:
    """The files of a path with their row counts, from one pass over their lines.

    Quotes enclose a cell or are doubled inside one. So a cell goes on beyond the end of a line
    only if the quotes of some line are odd in number; in all other files lines are rows. The
    pass splits files of any size, parses nothing and brings one row a file to the driver.
    """
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    found = (
        lines.where(F.length(F.trim("value")) > 0)
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.count(F.lit(1)).alias("lines"), F.max(quotes % 2).alias("cut"))
        .orderBy("path")
        .collect()
    )
    # The first line of a file is its header.
    return [CsvFile(unquote(r["path"]), None if r["cut"] else r["lines"] - 1) for r in found]


def open_extract(
    spark: SparkSession, entity: Entity, path: str | Sequence[str], multiline: bool | None = None
) -> Extract:
    """A file, a folder of part files or several of them, as ``read_entity_csv`` reads them."""
    if multiline is not None:
        rows = _conformed(_read(spark, path, multiline), entity)
        return Extract(rows, 0, rows)
    files = look_through(spark, path)
    if not files:
        return Extract(no_rows(spark, entity.source_schema), 0)
    split = [f for f in files if f.rows is not None]
    whole = [f.path for f in files if f.rows is None]
    read = []
    if split:
        read.append(_conformed(_read(spark, [f.path for f in split], False), entity))
    if whole:
        read.append(_conformed(_read(spark, whole, True), entity))
    rows = read[0] if len(read) == 1 else read[0].unionByName(read[1])
    return Extract(rows, sum(f.rows for f in split), read[-1] if whole else None)


def read_entity_csv(
    spark: SparkSession, entity: Entity, path: str | Sequence[str], multiline: bool | None = None
) -> DataFrame:
    """All columns as text, matched by header name; blanks are ``''``, not NULL.

    ``path`` is a file or a folder of part files, which all have the same header. Quotes are
    doubled inside quoted cells; line breaks inside quotes are part of their cell. A file with
    such a cell is read as one piece. All others are split, so that a large file is many tasks.
    Which is which is found in a pass over the lines (``look_through``); ``multiline`` says it
    without one: True reads each file whole, False splits all, and the read fails on a row that
    does not have all cells, as a row cut at a line break has not. A column the files lack is
    NULL.
    """
    return open_extract(spark, entity, path, multiline).rows


def _reader(spark: SparkSession, multiline: bool) -> DataFrameReader:
    return spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)


def _read(spark: SparkSession, path: str | Sequence[str], multiline: bool) -> DataFrame:
    paths = path if isinstance(path, str) else list(path)
    schema = _reader(spark, multiline).csv(paths).schema
    strict = _reader(spark, multiline).option("enforceSchema", False)
    if not multiline:
        strict = strict.option("mode", "FAILFAST").option("columnPruning", False)
    return strict.schema(schema).csv(paths)


def _conformed(raw: DataFrame, entity: Entity) -> DataFrame:
    by_name = {name.lower(): name for name in raw.columns}
    known = {name.lower() for name in entity.column_names}
    extra = [name for lowered, name in by_name.items() if lowered not in known]
    if extra:
        raise UnexpectedColumns(f"{entity.csv}: {', '.join(extra)}")
    columns = []
    for name in entity.column_names:
        found = by_name.get(name.lower())
        value = F.lit(None).cast("string") if found is None else F.coalesce(F.col(f"`{found}`"), F.lit(""))
        columns.append(value.alias(name))
    return raw.select(*columns)
