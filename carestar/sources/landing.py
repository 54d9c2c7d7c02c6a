"""Extract runs: CSV files to the append-only landing layer."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from carestar.functions.dates import moment
from carestar.functions.hashing import content_fingerprint
from carestar.schemas import ENTITIES, Entity
from carestar.session import COMPRESSION, tidied
from carestar.sources.csv import open_extract
from carestar.sources.literal import few_rows, no_rows

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("end_time", T.TimestampNTZType()),
    ]
)


@dataclass
class LoadResult:
    table_name: str
    status: str = "FAILED"
    rows_loaded: int = 0
    error: str | None = None
    start_time: dt.datetime | None = None
    end_time: dt.datetime | None = None


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def stamped(rows: DataFrame, batch_id: str, now: dt.datetime) -> DataFrame:
    """Add the batch columns; the time is one value per table and run."""
    return (
        rows.withColumn("create_at", moment(now))
        .withColumn("update_at", moment(now))
        .withColumn("batch_id", F.lit(batch_id))
    )


class LandingZone:
    """One folder per entity, one sub-folder per batch."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, entity: Entity) -> str:
        return f"{self.root}/{entity.landing_table}"

    def exists(self, entity: Entity) -> bool:
        try:
            self.spark.read.schema(entity.landing_schema).parquet(self.path(entity))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    def read(self, entity: Entity, batch_ids: list[str] | None = None) -> DataFrame:
        """All landed rows, or those of some batches (other folders stay closed)."""
        if not self.exists(entity):
            return no_rows(self.spark, entity.landing_schema)
        rows = self.spark.read.schema(entity.landing_schema).parquet(self.path(entity))
        return rows if batch_ids is None else rows.where(F.col("batch_id").isin(*batch_ids))

    def append(self, entity: Entity, rows: DataFrame) -> None:
        """Add a batch; running the same batch again replaces only that batch."""
        with tidied(rows.sparkSession):
            (
                rows.write.mode("overwrite")
                .options(**COMPRESSION)
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch_id")
                .parquet(self.path(entity))
            )


def same_content(
    source: DataFrame,
    landed: DataFrame,
    entity: Entity,
    policy: str = "rowcount",
    count: Callable[[], int] | None = None,
) -> tuple[bool, int]:
    """Whether landing already holds the file, and the file's row count.

    ``rowcount`` compares counts only; ``fingerprint`` also compares content and
    so notices a changed file of the same length. ``count`` gives the file's row
    count where it is known without reading ``source``.
    """
    if policy == "rowcount":
        rows = (count or source.count)()
        return rows == landed.count(), rows
    if policy == "fingerprint":
        names = entity.column_names
        ours = content_fingerprint(source, names).first()
        return ours == content_fingerprint(landed, names).first(), ours["n_rows"]
    raise ValueError(f"unknown policy {policy!r}")


def load_entity(
    zone: LandingZone,
    entity: Entity,
    csv_path: str,
    batch_id: str | None = None,
    *,
    now: dt.datetime | None = None,
    policy: str = "rowcount",
    multiline: bool | None = None,
) -> LoadResult:
    """Land one file, or folder of part files, unless its content is there; an error is a
    result, not raised."""
    result = LoadResult(entity.landing_table, start_time=utc_now())
    try:
        extract = open_extract(zone.spark, entity, csv_path, multiline)
        source = extract.rows
        same, rows = same_content(source, zone.read(entity), entity, policy, extract.count)
        if same:
            result.status = "SKIP"
        else:
            zone.append(entity, stamped(source, batch_id or str(uuid.uuid4()), now or utc_now()))
            result.status, result.rows_loaded = "SUCCESS", rows
    except Exception as error:  # one table's failure must not stop the others
        result.error = f"{type(error).__name__}: {error}"
    result.end_time = utc_now()
    return result


def run_extract(
    zone: LandingZone,
    csv_dir: str,
    batch_id: str | None = None,
    *,
    now: dt.datetime | None = None,
    policy: str = "rowcount",
    parallel: int = 4,
    multiline: bool | None = None,
) -> list[LoadResult]:
    """Land all entities as independent Spark jobs, under one batch id."""
    batch_id = batch_id or str(uuid.uuid4())

    def load(entity: Entity) -> LoadResult:
        path = f"{csv_dir.rstrip('/')}/{entity.csv}"
        return load_entity(zone, entity, path, batch_id, now=now, policy=policy, multiline=multiline)

    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(load, ENTITIES.values()))


def results_frame(spark: SparkSession, results: list[LoadResult]) -> DataFrame:
    return few_rows(spark, [asdict(result) for result in results], RESULT_SCHEMA)


def summary(results: DataFrame) -> DataFrame:
    """Tables and loaded rows per status."""
    return results.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_tables"), F.sum("rows_loaded").alias("total_rows")
    )
