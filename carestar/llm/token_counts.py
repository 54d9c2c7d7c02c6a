"""Token counts by the whole-token shortcut."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.llm.common import column_lists, per_batch
from carestar.llm.wordbpe import Encoder, whole_tokens


def count_tokens(
    docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row for each row of ``docs``: id, ``n_bytes`` (UTF-8) and ``n_tokens`` of its text.

    Before the job, each vocabulary string is encoded alone; those that come out as one token
    are the whole-token table, no larger than the vocabulary, which tasks get. In a text,
    pre-tokens in the table count one; only the rest are merged, once for each distinct word
    of a task while its cache holds (2^20 words).

    A null text counts as empty: 0 bytes, 0 tokens. A null id is kept. Repeated rows each
    give a row. An empty table gives no rows. Other columns are not read, whatever their names.
    Special strings inside a text are single tokens, as the library's default has them.
    """
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(vocabulary))

    def start():
        encoder = Encoder(vocabulary, whole.value)

        def work(batch):
            ids, texts = column_lists(batch, "id", "text")
            texts = [t or "" for t in texts]
            return {
                "id": ids,
                "n_bytes": [len(t.encode()) for t in texts],
                "n_tokens": [encoder.count(t) for t in texts],
            }

        return work

    taken = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    counted = per_batch(taken, start, "id long, n_bytes long, n_tokens long")
    return counted.withColumnRenamed("id", id_column)


def with_limit(counted: DataFrame, limit: int) -> DataFrame:
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
