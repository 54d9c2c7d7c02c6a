"""Run log, batch guard and watermarks."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.functions.dates import moment
from carestar.operators.upsert import insert_missing, upsert
from carestar.schemas import CONTROL, ENTITIES
from carestar.sources.landing import LoadResult, utc_now
from carestar.sources.literal import few_rows, one_row
from carestar.sources.store import TableStore

RUN_LOG = "etl_run_log"
WATERMARKS = "etl_control"
NEVER = dt.datetime(1900, 1, 1)


def already_succeeded(log: DataFrame, proc_name: str, batch_ids: DataFrame) -> DataFrame:
    """The batches that a procedure has finished successfully."""
    done = log.where((F.col("proc_name") == proc_name) & (F.col("status") == "SUCCESS"))
    return batch_ids.join(done.select("batch_id"), "batch_id", "left_semi")


def run_entry(
    spark: SparkSession,
    proc_name: str,
    batch_id: str,
    status: str,
    *,
    start: dt.datetime,
    end: dt.datetime | None = None,
    rows: int | None = None,
    error: str | None = None,
    params: str | None = None,
) -> DataFrame:
    end = end or utc_now()
    values = {
        "log_id": uuid.uuid4().hex,
        "proc_name": proc_name,
        "batch_id": batch_id,
        "start_time": start,
        "end_time": end,
        "status": status,
        "rows_affected": rows,
        "error_msg": error,
        "params": params,
        "created_at": end,
    }
    return one_row(spark, values, CONTROL[RUN_LOG])


def log_run(store: TableStore, proc_name: str, batch_id: str, status: str, **values) -> None:
    store.append(RUN_LOG, run_entry(store.spark, proc_name, batch_id, status, **values).coalesce(1))


def is_done(store: TableStore, proc_name: str, batch_id: str) -> bool:
    log = store.read_or_none(RUN_LOG)
    if log is None:
        return False
    batch = store.spark.sql("SELECT 1").select(F.lit(batch_id).alias("batch_id"))
    return not already_succeeded(log, proc_name, batch).isEmpty()


def seeded_watermarks(spark: SparkSession, existing: DataFrame | None) -> DataFrame:
    """One row per landing table; missing ones start at 1900-01-01 with no rows."""
    seeds = few_rows(
        spark,
        [
            {
                "table_name": entity.landing_table,
                "last_loaded_at": NEVER,
                "rows_loaded": 0,
                "status": "SUCCESS",
            }
            for entity in ENTITIES.values()
        ],
        CONTROL[WATERMARKS],
    )
    if existing is None:
        return seeds
    return existing.unionByName(insert_missing(existing, seeds, ["table_name"]))


def updated_watermarks(existing: DataFrame, loads: DataFrame) -> DataFrame:
    """Upsert ``(table_name, last_batch_id, last_loaded_at, rows_loaded)`` rows."""
    as_rows = existing.withColumn("create_at", F.col("last_loaded_at"))
    news = loads.select(
        "table_name", "last_batch_id", "last_loaded_at", "rows_loaded",
        F.lit("SUCCESS").alias("status"),
    )
    merged = upsert(
        as_rows, news, ["table_name"], now=moment(NEVER),
        order="last_loaded_at",
    )
    return merged.select(*existing.columns)


def record_loads(store: TableStore, batch_id: str, results: list[LoadResult]) -> None:
    """Watermarks of the tables that loaded or had nothing new."""
    spark = store.spark
    done = [
        {
            "table_name": r.table_name,
            "last_batch_id": batch_id,
            "last_loaded_at": r.end_time,
            "rows_loaded": r.rows_loaded,
            "status": "SUCCESS",
        }
        for r in results
        if r.status in ("SUCCESS", "SKIP")
    ]
    loads = few_rows(spark, done, CONTROL[WATERMARKS])
    held = seeded_watermarks(spark, store.read_or_none(WATERMARKS))
    store.replace(WATERMARKS, updated_watermarks(held, loads).coalesce(1))
