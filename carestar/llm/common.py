"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from carestar.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read again: later steps neither
    compute them anew nor depend on the executors that made them."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_and_any(df: DataFrame, purpose: str, condition: Column | None = None) -> tuple[DataFrame, bool]:
    """The rows as ``stored``, and whether there are any (for which the condition holds). That is
    seen as they are written, so asking for it costs the driver no further job."""
    seen = Observation()
    held = F.lit(True) if condition is None else condition
    rows = stored(df.observe(seen, F.coalesce(F.bool_or(held), F.lit(False)).alias("any")), purpose)
    return rows, bool(seen.get["any"])


def column_lists(batch: pa.RecordBatch, *names: str) -> tuple[list, ...]:
    return tuple(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names)


class Remembered(dict):
    """Key -> value, made when first asked for. Holds at most 2 ``most`` values: when it is full,
    those of the last ``most`` stay within reach, and those older that were not asked for go."""

    def __init__(self, make: Callable, most: int = 1 << 16):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        try:
            value = self.older[key]
        except KeyError:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def slices(batch: pa.RecordBatch, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``rows`` rows and ``size`` bytes of text, or of one row."""
    held = np.zeros(batch.num_rows + 1, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            held[1:] += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    held = np.cumsum(held)
    low = 0
    while low < batch.num_rows:
        high = int(np.searchsorted(held, held[low] + size, "right")) - 1
        high = min(max(high, low + 1), low + rows, batch.num_rows)
        yield batch.slice(low, high - low)
        low = high


def per_batch(
    df: DataFrame,
    start: Callable[[], Callable[[pa.RecordBatch], dict]],
    schema: str,
    rows: int = 2_000,
    size: int = 4 << 20,
) -> DataFrame:
    """Maps record batches of at most ``rows`` rows and ``size`` bytes of text, or of one longer
    row; ``start`` makes the function once a task.

    The function returns a column of values (list or array of any kind) for each field of ``schema``.
    """
    names = [part.split()[0] for part in schema.split(",")]
    kinds = [_ARROW[part.split()[1]] for part in schema.split(",")]
    out = pa.schema(list(zip(names, kinds, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for whole in batches:
            work = work or start()
            for part in slices(whole, rows, size):
                made = work(part)
                columns = [
                    made[n].cast(k) if isinstance(made[n], pa.Array) else pa.array(made[n], k)
                    for n, k in zip(names, kinds, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=out)
        # Workers are used again, by other stages too: what this task held goes back first.
        work = made = columns = whole = part = None
        give_back()

    return df.mapInArrow(run, schema)


def per_text(text: Column, work: Callable[[list], list], kind: str, rows: int = 2_000, size: int = 4 << 20) -> Column:
    """A column of ``kind`` that ``work`` makes of lists of at most ``rows`` texts and ``size``
    bytes, or of one longer text; a null text is None."""
    out = _ARROW[kind]

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for whole in batches:
            parts = slices(pa.RecordBatch.from_arrays([whole], names=["text"]), rows, size)
            yield pa.concat_arrays([pa.array([], out), *(pa.array(work(p.column(0).to_pylist()), out) for p in parts)])
        # As in ``per_batch``: the worker is used again.
        whole = parts = None
        give_back()

    return run(text)


def give_back() -> None:
    """Returns free memory of Arrow, and of the C library where it can, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "float": pa.float32(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()),
    "array<float>": pa.list_(pa.float32()),
    "array<binary>": pa.list_(pa.binary()),
    "array<string>": pa.list_(pa.string()),
}


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many more underscores as it takes to be none of the columns of ``df``."""
    taken, free = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        free.append(name)
    return free


def salted_rank(df: DataFrame, group: str, order: list[str], name: str, rows_per_cell: int) -> DataFrame:
    """Adds ``name``: numbers from 0 without gaps within each ``group``, of which there are few.

    A group is spread over cells of about ``rows_per_cell`` rows by a hash of ``order``. Rows
    are counted per cell first; each cell then numbers its own rows from the sum of the cells
    before it. Cells are narrow rows, one for that many rows of ``df``.
    """
    sizes = df.groupBy(F.col(group).alias("__of")).agg(F.count(F.lit(1)).alias("n"))
    salts = F.broadcast(sizes.select("__of", F.ceil(F.col("n") / rows_per_cell).alias("__salts")))
    salted = df.join(salts, F.col(group).eqNullSafe(F.col("__of"))).withColumn(
        "__salt", F.pmod(F.xxhash64(*order), F.col("__salts"))
    )
    cells = salted.groupBy(F.col(group).alias("__g"), F.col("__salt").alias("__s")).agg(
        F.count(F.lit(1)).alias("__n")
    )
    before = F.expr(
        "coalesce(sum(__n) over (partition by __g order by __s "
        "rows between unbounded preceding and 1 preceding), 0)"
    )
    offsets = cells.select("__g", "__s", before.alias("__before"))
    listed = ", ".join(f"`{c}`" for c in order)
    numbered = salted.withColumn(
        "__row", F.expr(f"row_number() over (partition by `{group}`, __salt order by {listed}) - 1")
    )
    same = F.col(group).eqNullSafe(F.col("__g")) & (F.col("__salt") == F.col("__s"))
    return (
        numbered.join(offsets, same)
        .withColumn(name, (F.col("__row") + F.col("__before")).cast("long"))
        .drop("__of", "__salts", "__g", "__s", "__salt", "__row", "__before")
    )


def flag_likely(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column, flag: str, bits: int = 1 << 24):
    """Adds ``flag``: false only if no row of ``wanted`` has that key.

    A Bloom filter of one hash: a table of at most bits / 64 numbers, whatever the input, which
    is broadcast. What it flags is looked up exactly afterwards; what it does not needs no
    shuffle. With very many wanted keys it flags all, and the exact look-up does the work.
    """
    places = wanted.select(F.pmod(F.xxhash64(wanted_key), F.lit(bits)).alias("h"))
    bit = "shiftleft(1L, cast(h % 64 as int))"
    h, at, word = free_names(df, "__h", "__at", "__word")
    words = places.groupBy(F.expr("h div 64").alias(at)).agg(F.expr(f"bit_or({bit})").alias(word))
    marked = df.withColumn(h, F.pmod(F.xxhash64(key), F.lit(bits)))
    found = marked.join(F.broadcast(words), F.expr(f"{h} div 64") == F.col(at), "left")
    hit = F.expr(f"coalesce(shiftright({word}, cast({h} % 64 as int)) & 1L, 0L) = 1L")
    return found.withColumn(flag, hit).drop(h, at, word)


def likely_in(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """``df`` without most rows whose key is not wanted, and with all whose key is."""
    (flag,) = free_names(df, "__likely")
    return flag_likely(df, key, wanted, wanted_key, flag).where(F.col(flag)).drop(flag)
