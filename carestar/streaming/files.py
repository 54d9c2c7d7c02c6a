"""Incremental extract: new CSV files flow into a staging table.

The stream's checkpoint remembers which files were read, in place of comparing
row counts. Each micro-batch is one upsert; a replayed micro-batch carries the
same rows and leaves the table with the same content.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from carestar.plans.staging import stage
from carestar.schemas import Entity
from carestar.sources.csv import read_entity_csv
from carestar.sources.landing import stamped, utc_now
from carestar.sources.store import TableStore


def file_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The paths of a folder's new files; their content stays closed."""
    fields = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(fields)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).select("path")


class OtherHeader(ValueError):
    """A new file does not name the entity's columns in their order."""


def new_rows(spark: SparkSession, entity: Entity, paths: list[str], multiline: bool | None) -> DataFrame:
    """The rows of new files, each of which must have the entity's header.

    A file is split over tasks unless a cell of it holds a line break; see ``read_entity_csv``.
    """
    header = ",".join(entity.column_names)
    first = spark.read.text(paths).where(F.col("_metadata.file_block_start") == 0)
    first = first.select("value", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"))
    headers = first.groupBy("path").agg(F.min_by("value", "at").alias("header"))
    other = headers.where(F.lower(F.replace("header", F.lit('"'), F.lit(""))) != header.lower()).first()
    if other is not None:
        raise OtherHeader(f"{other['path']}: {other['header']}")
    return read_entity_csv(spark, entity, paths, multiline)


def stream_to_staging(
    store: TableStore,
    entity: Entity,
    folder: str,
    checkpoint: str,
    *,
    now: dt.datetime | None = None,
    multiline: bool | None = None,
    files_per_batch: int | None = None,
    **rules,
) -> StreamingQuery:
    """Start a run over all files not read yet; it ends when they are staged.

    The stream itself carries file names. Each micro-batch reads its files as a batch does, so
    a large file is many tasks. A file with another header fails the run and lands nothing.
    """

    def apply(batch: DataFrame, number: int) -> None:
        moment = now or utc_now()
        # One row a file; as many as a micro-batch takes in.
        paths = [r["path"] for r in batch.collect()]
        if paths:
            rows = new_rows(store.spark, entity, paths, multiline)
            stage(store, entity, stamped(rows, f"stream-{number}", moment), moment, **rules)

    return (
        file_stream(store.spark, folder, files_per_batch)
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(apply)
        .start()
    )
