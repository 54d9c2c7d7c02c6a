"""Packing token ids into windows by non-negative least squares over a length histogram."""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.llm.common import column_lists, give_back, per_batch, salted_rank, stored
from carestar.llm.wordbpe import Encoder, whole_tokens

STEP = 16


def length_class(length: int, exact: int = 128) -> int:
    """The largest length of the class: itself up to ``exact``, then the next multiple of 16."""
    return length if length <= exact else -(-length // STEP) * STEP


def combinations(lengths: list[int], window: int, parts: int) -> list[tuple[int, ...]]:
    """Non-increasing tuples of at most ``parts`` lengths that fill the window to the last step."""
    found = []

    def extend(chosen, left, start):
        if chosen and left < STEP:
            found.append(tuple(chosen))
            return
        if len(chosen) == parts:
            return
        for i in range(start, len(ordered)):
            if ordered[i] > left:
                continue
            if ordered[i] * (parts - len(chosen)) <= left - STEP:
                break  # the rest are shorter still and cannot fill it
            extend([*chosen, ordered[i]], left - ordered[i], i)

    ordered = sorted(lengths, reverse=True)
    extend([], window, 0)
    return found


def nnls(
    columns: list[tuple[int, ...]], b: np.ndarray, enough: float = 1e-7, rounds: int = 40_000
) -> np.ndarray:
    """x >= 0 that minimises |A x - b|, where a column of A counts the rows it lists, until no
    step would move an x by ``enough``.

    Each step moves the one x that lowers the sum of squares most, as far as it does and not
    below 0. A step is elementwise work over all columns, without threaded linear algebra, whose
    threads wait for each other on a busy machine.
    """
    most = max(map(len, columns))
    rows = np.array([[*c, *[len(b)] * (most - len(c))] for c in columns])
    square = np.array([sum(c.count(k) ** 2 for k in set(c)) for c in columns], float)
    left = np.append(b.astype(float), 0.0)
    x = np.zeros(len(columns))
    for _ in range(rounds):
        step = np.maximum(left[rows].sum(axis=1) / square, -x)
        best = int((step * step * square).argmax())
        if abs(step[best]) < enough:
            break
        x[best] += step[best]
        for k in columns[best]:
            left[k] -= step[best]
    return x


def plan_windows(histogram: dict[int, int], window: int, parts: int = 3) -> list[tuple[dict[int, int], int]]:
    """Patterns (length class -> pieces of it) with repeat counts that use every piece once.

    Combinations that fill a window get repeat counts by non-negative least squares against
    the histogram, rounded down and held within what is left of each class. Greedily, the
    largest class left then opens a pattern, the largest that still fit fill it, and it is
    repeated as often as its classes allow, until nothing is left.
    """
    left = {k: n for k, n in histogram.items() if n}
    plan = []

    def use(pattern, times):
        plan.append((pattern, times))
        for k, m in pattern.items():
            left[k] -= m * times

    full = combinations(list(left), window, parts)
    if full:
        order = {k: i for i, k in enumerate(left)}
        columns = [tuple(order[k] for k in combination) for combination in full]
        # Counts are rounded down, so smaller steps than these change little.
        enough = max(0.2, 1e-5 * max(left.values()))
        counts = nnls(columns, np.array([left[k] for k in left], float), enough)
        for j in np.argsort(-counts, kind="stable"):
            pattern = {k: full[j].count(k) for k in full[j]}
            times = min(int(counts[j] + 1e-6), *(left[k] // m for k, m in pattern.items()))
            if times > 0:
                use(pattern, times)
    while remaining := sorted((k for k in left if left[k]), reverse=True):
        pattern, room = {}, window
        for k in remaining:
            if m := min(room // k, left[k]):
                pattern[k] = m
                room -= m * k
        use(pattern, min(left[k] // m for k, m in pattern.items()))
    return plan


def tokenized_pieces(docs, vocabulary, end_id, window, id_column, text_column) -> DataFrame:
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(vocabulary))
    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long"

    def start():
        encoder = Encoder(vocabulary, whole.value)
        end = struct.pack("<I", end_id)

        def work(batch):
            rows = {name: [] for name in ("id", "start", "length", "ids_crc32", "doc_tokens")}
            for doc, text in zip(*column_lists(batch, "id", "text"), strict=True):
                ids = encoder.ids(text or "") + end
                view = memoryview(ids)
                for at in range(0, len(ids), 4 * window):
                    piece = view[at : at + 4 * window]
                    rows["id"].append(doc)
                    rows["start"].append(at // 4)
                    rows["length"].append(len(piece) // 4)
                    rows["ids_crc32"].append(zlib.crc32(piece))
                    rows["doc_tokens"].append(len(ids) // 4)
            return rows

        return work

    taken = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return per_batch(taken, start, schema)


def pack(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 2,
    window: int = 4096,
    rows_per_cell: int = 250,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Packs the ids of every document, each followed by ``end_id``, into windows.

    A document is cut at multiples of the window, so at most its last piece is shorter; each
    id is in one piece. Pieces are counted by length class (exact to 128, then steps of 16),
    a histogram of at most window / 16 + 120 numbers, which alone the driver sees. From it come
    window patterns with repeat counts (``plan_windows``). A piece's number within its class,
    counted out over many tasks, tells by arithmetic which repeat of which pattern takes it.

    One row for each piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (gapless from 0 in a sequence), n_pieces and used (tokens) of the sequence. The rest of a
    sequence up to the window is padding.

    A null text counts as empty: its one piece is the end id. A null id is kept. Repeated rows
    are packed each. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    pieces = tokenized_pieces(docs, vocabulary, end_id, window, id_column, text_column)
    stepped = F.when(F.col("length") <= 128, F.col("length")).otherwise(
        F.ceil(F.col("length") / STEP) * STEP
    )
    pieces = stored(pieces.withColumn("class", stepped.cast("long")), "pieces")
    histogram = {r["class"]: r["n"] for r in pieces.groupBy("class").agg(F.count("*").alias("n")).collect()}
    spans, taken, sequences = [], dict.fromkeys(histogram, 0), 0
    for pattern, times in plan_windows(histogram, window):
        slot = 0
        for k, m in pattern.items():
            spans.append((k, taken[k], taken[k] + m * times, sequences, m, slot))
            taken[k] += m * times
            slot += m
        sequences += times
    give_back()
    schema = "__class long, __low long, __high long, __first long, __each long, __slot long"
    spans = F.broadcast(spark.createDataFrame(spans, schema))
    ranked = salted_rank(
        pieces, "class", ["id", "start", "length", "ids_crc32"], "__rank", rows_per_cell
    )
    inside = (
        (F.col("class") == F.col("__class"))
        & (F.col("__rank") >= F.col("__low"))
        & (F.col("__rank") < F.col("__high"))
    )
    put = (
        ranked.join(spans, inside)
        .withColumn("__nth", F.col("__rank") - F.col("__low"))
        .withColumn("sequence_id", F.expr("__first + __nth div __each"))
        .withColumn("__at", F.expr("__slot + __nth % __each"))
    )
    # A sequence holds at most a window of pieces.
    return put.select(
        F.col("id").alias(id_column),
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        F.expr(
            "coalesce(sum(length) over (partition by sequence_id order by __at "
            "rows between unbounded preceding and 1 preceding), 0)"
        ).alias("offset"),
        F.expr("count(1) over (partition by sequence_id)").alias("n_pieces"),
        F.expr("sum(length) over (partition by sequence_id)").alias("used"),
    )
