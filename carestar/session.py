"""Session settings and the shared scratch location."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the library is tuned for. Joins pick broadcast or shuffle from the
# measured size of each side, so nothing is broadcast that the threshold has
# not seen; AQE splits skewed shuffle partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "carestar", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder on the storage every executor can reach.

    The cluster names that storage in ``spark.checkpoint.dir``. Where that is unset, a local
    session gets a folder of this machine; any other is refused, as its executors would each
    write to their own disk and later reads would miss rows.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "local")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name shared storage under master {master}")
        shared = tempfile.mkdtemp(prefix="carestar-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/carestar/{purpose}-{uuid.uuid4().hex}"


# Tables are written once and read often; zstd makes them a third smaller than the default.
COMPRESSION = {"compression": "zstd"}


# Spark deletes a query's shuffle files as the query ends, where this is set.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_inside: dict = {}
_turn = threading.Lock()


@contextmanager
def tidied(spark: SparkSession) -> Iterator[None]:
    """Queries that begin in here give up their shuffle files when they end.

    Otherwise the files of a finished write stay until the driver happens to collect garbage,
    so that those of a load's many writes add up. The session gets its own setting back with the
    last thread that leaves: a frame that its user collects twice keeps its files.
    """
    session = spark._jsparkSession
    with _turn:
        depth, before = _inside.get(session) or (0, spark.conf.get(_CLEANUP, "false"))
        spark.conf.set(_CLEANUP, "true")
        _inside[session] = (depth + 1, before)
    try:
        yield
    finally:
        with _turn:
            depth, before = _inside.pop(session)
            if depth > 1:
                _inside[session] = (depth - 1, before)
            else:
                spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, purpose: str, paths: list[str] | None = None) -> DataFrame:
    """The rows written to the scratch folder and read again: several later steps use them
    without computing them each. The folder is added to ``paths``, for ``forgotten``."""
    path = scratch_dir(df.sparkSession, purpose)
    if paths is not None:
        paths.append(path)
    with tidied(df.sparkSession):
        df.write.options(**COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forgotten(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables that no later step reads."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
