"""Versioned Parquet tables on shared storage.

A table is a folder of immutable part folders plus small version files that name
the live parts. A write adds parts and then publishes the next version in one
small file that only one writer can create, so readers never see half a load, a plan may read the table it rewrites,
and a failed or repeated attempt leaves the published version as it was. Parts
that a load does not touch are carried over by name and not rewritten.
"""

from __future__ import annotations

import calendar
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestar.operators.surrogate import unique_ids
from carestar.session import COMPRESSION, tidied
from carestar.sources.literal import no_rows

_LOAD = "load"
_MONTH = "month_key"
_UNTIL = "until_key"
_NULL = "__HIVE_DEFAULT_PARTITION__"


class TableMissing(LookupError):
    """A required table has never been written."""


class ConcurrentWrite(RuntimeError):
    """Another writer published the same version first."""


@dataclass(frozen=True)
class Snapshot:
    version: int
    parts: tuple[str, ...]
    schema: T.StructType
    last_serial: int = 0


def _value(part: str, name: str) -> str | None:
    for step in part.split("/"):
        label, _, value = step.partition("=")
        if label == name:
            return value
    return None


def _split_value(part: str, split: str) -> str | None:
    value = _value(part, split)
    return None if value == _NULL else value


def _month(key: Column) -> Column:
    return F.floor(key / 100).cast("int")


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._jvm = spark._jvm
        self._hadoop = spark._jsc.hadoopConfiguration()

    # -- reading ----------------------------------------------------------

    def snapshot(self, table: str) -> Snapshot | None:
        names = [n for n in self._list(f"{self._folder(table)}/_versions") if n.endswith(".json")]
        if not names:
            return None
        newest = max(names)
        body = self._version(f"{self._folder(table)}/_versions/{newest}")
        schema = T.StructType.fromJson(body["schema"])
        version = int(newest.split(".")[0])
        return Snapshot(version, tuple(body["parts"]), schema, body["last_serial"])

    def exists(self, table: str) -> bool:
        return self.snapshot(table) is not None

    def read(self, table: str) -> DataFrame:
        snapshot = self._required(table)
        return self._read_parts(table, snapshot, snapshot.parts)

    def read_or_none(self, table: str) -> DataFrame | None:
        return self.read(table) if self.exists(table) else None

    def read_months(self, table: str, low: int | None, high: int | None) -> DataFrame:
        """The months that a range of date keys meets; the others are not opened."""
        snapshot = self._required(table)
        parts = []
        for part in snapshot.parts:
            month = _value(part, _MONTH)
            if month is not None and month.isdigit():
                if low is not None and int(month) < low // 100:
                    continue
                if high is not None and int(month) > high // 100:
                    continue
            parts.append(part)
        return self._read_parts(table, snapshot, parts)

    def read_open(self, table: str, low: int, high: int) -> DataFrame:
        """The months of a range of date keys, and of earlier months the parts with rows that
        may last into it, by the year in which they end. Other parts are not opened."""
        snapshot = self._required(table)
        parts = []
        for part in snapshot.parts:
            month, until = _value(part, _MONTH), _value(part, _UNTIL)
            started = month is not None and month.isdigit() and int(month) >= low // 100
            lasting = until is None or not until.isdigit() or int(until) >= low // 10000
            if (started or lasting) and not (month is not None and month.isdigit() and int(month) > high // 100):
                parts.append(part)
        return self._read_parts(table, snapshot, parts)

    def read_split(self, table: str, split: str, values: set[str | None]) -> DataFrame:
        """The rows of some values of the split a table is kept by; None stands for NULL."""
        snapshot = self._required(table)
        parts = [p for p in snapshot.parts if _split_value(p, split) in values]
        return self._read_parts(table, snapshot, parts)

    def is_split(self, table: str, split: str) -> bool:
        return all(_value(part, split) is not None for part in self._required(table).parts)

    def split_values(self, table: str, split: str) -> set[str | None]:
        return {_split_value(part, split) for part in self._required(table).parts}

    def read_month_set(self, table: str, months: set[str | None]) -> DataFrame:
        """Some months, given as text; None is the month of rows without a day."""
        return self.read_split(table, _MONTH, months)

    # -- writing ----------------------------------------------------------

    def replace(
        self,
        table: str,
        df: DataFrame,
        partition: str | None = None,
        month_of: Column | None = None,
        split: tuple[str, Column] | None = None,
        serial: int = 0,
    ) -> int:
        """The whole table becomes ``df``; returns the number of rows written.

        ``month_of``, a date key, keeps the table by month instead; ``split`` by a value that
        is not one of its columns. ``serial`` is a number kept with the version.
        """
        split = split if month_of is None else (_MONTH, _month(month_of))
        rows = df if split is None else df.withColumn(*split)
        parts, rows = self._write(table, rows, partition if split is None else split[0])
        self._publish(table, self.snapshot(table), parts, df.schema, serial)
        return rows

    def append(self, table: str, df: DataFrame, partition: str | None = None) -> int:
        before = self.snapshot(table)
        parts, rows = self._write(table, df, partition)
        if before and not rows:
            return 0
        held = before.parts if before else ()
        self._publish(table, before, [*held, *parts], before.schema if before else df.schema)
        return rows

    def swap(self, table: str, df: DataFrame, partition: str, drop: Callable[[str], bool]) -> int:
        """Add the parts of ``df`` and drop the held parts whose value matches."""
        before = self._required(table)
        parts, rows = self._write(table, df, partition)
        held = [p for p in before.parts if not drop(_value(p, partition) or "")]
        self._publish(table, before, [*held, *parts], before.schema)
        return rows

    def swap_split(
        self, table: str, df: DataFrame, split: tuple[str, Column], values: set, serial: int = 0
    ) -> int:
        """Some values of the split become ``df``, which has rows of those values only."""
        before = self._required(table)
        parts, rows = self._write(table, df.withColumn(*split), split[0])
        held = [p for p in before.parts if _split_value(p, split[0]) not in values]
        self._publish(table, before, [*held, *parts], before.schema, serial)
        return rows

    def swap_months(
        self, table: str, df: DataFrame, month_of: Column, months: set, serial: int = 0
    ) -> int:
        """Some months become ``df``, which has rows of those months only."""
        return self.swap_split(table, df, (_MONTH, _month(month_of)), months, serial)

    def replace_keys(
        self,
        table: str,
        df: DataFrame,
        column: str,
        low: int,
        high: int,
        serial: str | None = None,
        until: str | None = None,
    ) -> int:
        """Rows with a date key in the inclusive range become ``df``.

        The table is kept by month. Months wholly inside the range are dropped by
        name, also when ``df`` brings them no rows; months on its edges are
        rewritten without their old rows of the range; others are not touched.
        NULLs in the ``serial`` column are filled with keys never used before.
        With ``until``, the date key of each row's end, a month is further kept by
        the year of the end (NULL: open), for ``read_open``.
        """
        return self.replace_kept(table, df, column, low, high, serial, until)[0]

    def replace_kept(
        self,
        table: str,
        df: DataFrame,
        column: str,
        low: int,
        high: int,
        serial: str | None = None,
        until: str | None = None,
        keep: Column | None = None,
    ) -> tuple[int, int]:
        """As ``replace_keys``, but of the rows of ``df`` only those that ``keep`` holds for are
        written; returns how many were, and how many were not, counted in the writing stage."""
        before = self.snapshot(table)
        held, edge, kept = [], [], None
        for part in before.parts if before else ():
            month = int(_value(part, _MONTH))
            if not low // 100 <= month <= high // 100:
                held.append(part)
                continue
            last_day = calendar.monthrange(month // 100, month % 100)[1]
            if low > month * 100 + 1 or high < month * 100 + last_day:
                edge.append(part)
        if edge:
            kept = self._read_parts(table, before, edge).where(
                (F.col(column) < low) | (F.col(column) > high)
            )
        monthly = df if kept is None else df.unionByName(kept)
        monthly = monthly.withColumn(_MONTH, _month(F.col(column)))
        partitions = (_MONTH,)
        if until is not None:
            year = F.floor(F.col(until) / 10000).cast("string")
            monthly = monthly.withColumn(_UNTIL, F.coalesce(year, F.lit("open")))
            partitions = (_MONTH, _UNTIL)
        counted = F.count_if(F.col(column).between(low, high))
        last = before.last_serial if before else 0
        parts, rows, last, refused = self._write_numbered(
            table, monthly, partitions, counted, serial, last, keep
        )
        schema = before.schema if before else df.schema
        self._publish(table, before, [*held, *parts], schema, last)
        return rows - refused, refused

    # -- inside -----------------------------------------------------------

    def _folder(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _required(self, table: str) -> Snapshot:
        snapshot = self.snapshot(table)
        if snapshot is None:
            raise TableMissing(f"required table {table} is missing")
        return snapshot

    def _read_parts(self, table: str, snapshot: Snapshot, parts) -> DataFrame:
        if not parts:
            return no_rows(self.spark, snapshot.schema)
        # Parts of one kind of split are one read; a table may have been written in several.
        kinds: dict[tuple, list[str]] = {}
        for part in parts:
            labels = tuple(step.partition("=")[0] for step in part.split("/"))
            kinds.setdefault(labels, []).append(part)
        return reduce(DataFrame.unionByName, [self._read_alike(table, snapshot, k) for k in kinds.values()])

    def _read_alike(self, table: str, snapshot: Snapshot, parts) -> DataFrame:
        folder = self._folder(table)
        schema = T.StructType(list(snapshot.schema))
        if _MONTH not in schema.names:
            schema = schema.add(_MONTH, T.IntegerType())
        rows = (
            self.spark.read.schema(schema.add(_LOAD, T.StringType()))
            .option("basePath", folder)
            .parquet(*[f"{folder}/{part}" for part in parts])
        )
        return rows.select(*snapshot.schema.names)

    def _write(self, table: str, df: DataFrame, partition: str | None) -> tuple[list[str], int]:
        count = F.count(F.lit(1))
        partitions = () if partition is None else (partition,)
        return self._write_numbered(table, df, partitions, count, None, 0)[:2]

    def _write_numbered(
        self,
        table: str,
        df: DataFrame,
        partitions: tuple[str, ...],
        count: Column,
        serial: str | None,
        last: int,
        keep: Column | None = None,
    ) -> tuple[list[str], int, int, int]:
        """Write one part folder per partition value; parts, row count, last serial, and how
        many of the rows counted ``keep`` left out.

        Rows are brought together by a hidden split (month, bucket) first, in shuffle
        partitions that AQE sizes and splits, so that not every task writes into every
        value. Rows are counted as they are written.
        """
        seen = Observation()
        load = f"{_LOAD}={uuid.uuid4().hex}"
        path = f"{self._folder(table)}/{load}"
        hidden = [name for name in partitions if name.endswith("_key")]
        sized = df.hint("rebalance", *hidden) if hidden else df
        if serial is not None:
            sized = unique_ids(sized, serial, last)
        top = F.max(F.lit(last) if serial is None else F.col(serial))
        # Above every exchange: a stage without rows is planned away with what it observed.
        refused = F.count_if(F.lit(False) if keep is None else ~keep)
        counted = sized.observe(seen, count.alias("rows"), top.alias("top"), refused.alias("refused"))
        writer = (counted if keep is None else counted.where(keep)).write.options(**COMPRESSION)
        with tidied(df.sparkSession):
            writer.partitionBy(*partitions).parquet(path) if partitions else writer.parquet(path)
        parts = [load]
        for _ in partitions:
            folders = [(part, self._list(f"{self._folder(table)}/{part}")) for part in parts]
            parts = [f"{part}/{name}" for part, names in folders for name in names if "=" in name]
        found = seen.get
        return parts, found["rows"], max(last, found["top"] or 0), found["refused"]

    def _publish(
        self, table: str, before: Snapshot | None, parts, schema: T.StructType, last: int = 0
    ) -> None:
        version = before.version + 1 if before else 1
        folder = f"{self._folder(table)}/_versions"
        body = json.dumps(
            {"parts": list(parts), "schema": schema.jsonValue(), "last_serial": last}
        )
        self._put(f"{folder}/{version:010d}.json", body)

    def _version(self, path: str, patience: float = 5.0) -> dict:
        """A version file; one that is just being written is waited for."""
        until = time.monotonic() + patience
        while True:
            try:
                return json.loads(self._get(path))
            except json.JSONDecodeError:
                if time.monotonic() > until:
                    raise
                time.sleep(0.1)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _list(self, path: str) -> list[str]:
        folder = self._path(path)
        fs = folder.getFileSystem(self._hadoop)
        if not fs.exists(folder):
            return []
        return [status.getPath().getName() for status in fs.listStatus(folder)]

    def _get(self, path: str) -> str:
        file = self._path(path)
        stream = file.getFileSystem(self._hadoop).open(file)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _put(self, path: str, body: str) -> None:
        target = self._path(path)
        fs = target.getFileSystem(self._hadoop)
        fs.mkdirs(target.getParent())
        # Created exclusively, so of two writers of a version one fails on any file system.
        try:
            stream = fs.create(target, False)
        except Py4JJavaError as error:
            if not fs.exists(target):
                raise
            raise ConcurrentWrite(f"{path} was published by another writer") from error
        try:
            stream.write(bytearray(body, "utf-8"))
        finally:
            stream.close()
