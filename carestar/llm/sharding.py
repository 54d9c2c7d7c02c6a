"""Shards of near equal bytes by longest-processing-time scheduling."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.llm.common import salted_rank, stored

# Size of a row besides its text, in bytes.
ROW_BYTES = 8


def longest_first(sizes: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """Each item, largest first (ties: by name), to the least loaded shard (ties: lowest number)."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for size, name in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        placed[name] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 24,
    bundles_per_shard: int = 512,
    rows_per_cell: int = 250,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Puts every document into a shard so that shards hold near equal bytes.

    Rows with equal texts form a group and stay together. Scheduling items are the groups
    that make up at least 1 / (shards * bundles_per_shard) of all bytes, of which there are at
    most that many, and bundles: all smaller groups, dealt by a hash of their text into that
    many bundles. Sorted by size, the items go to the least-loaded shard through a heap on the
    driver, which so sees at most 2 * shards * bundles_per_shard items, whatever the input.
    A group larger than a shard's share keeps its shard to itself as far as it can.

    Columns: id, size (UTF-8 bytes of the text and 8), text_crc32, shard, and slot, a gapless
    number from 0 in each shard that no single task counts out.

    A null text counts as empty and is grouped with empty texts. A null id is kept. Repeated
    rows have equal texts, so they share a shard and differ in slot. An empty table gives no
    rows. Other columns are not read, whatever their names.
    """
    items = shards * bundles_per_shard
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text, 256).alias("__text"),
    )
    rows = stored(rows.withColumn("__bundle", F.pmod(F.xxhash64("__text"), F.lit(items))), "shards")
    total = rows.agg(F.sum("size")).first()[0] or 0
    groups = rows.groupBy("__text", "__bundle").agg(F.sum("size").alias("bytes"))
    groups = groups.withColumn("large", F.col("bytes") * items >= F.lit(total))
    # One item for each large group and one for each bundle: both numbers are bounded.
    item = F.when(F.col("large"), F.col("__text")).otherwise(F.col("__bundle").cast("string"))
    sized = groups.groupBy(item.alias("item")).agg(F.sum("bytes").alias("bytes")).collect()
    placed = longest_first([(r["bytes"], r["item"]) for r in sized], shards)

    spark = docs.sparkSession
    schema = "__item string, shard int"
    where = F.broadcast(spark.createDataFrame(list(placed.items()) or [("", 0)], schema))
    own = where.select(F.col("__item").alias("__own"), F.col("shard").alias("__alone"))
    # A text that is an item by itself, else the bundle it was dealt to.
    put = (
        rows.join(own, F.col("__text") == F.col("__own"), "left")
        .join(where, F.col("__bundle").cast("string") == F.col("__item"), "left")
        .withColumn("shard", F.coalesce("__alone", "shard"))
        .select("id", "size", "text_crc32", "shard")
    )
    numbered = salted_rank(put, "shard", ["id", "size", "text_crc32"], "slot", rows_per_cell)
    return numbered.withColumnRenamed("id", id_column)
