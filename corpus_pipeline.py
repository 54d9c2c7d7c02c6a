"""From documents to packed windows: quality, near duplicates, benchmark leaks, secrets, packing."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.llm.common import free_names, stored, table
from carestar.llm.decontam import without_leaks
from carestar.llm.neardup import one_of_each
from carestar.llm.packing import pack
from carestar.llm.quality import fit_quality, kept_column
from carestar.llm.queries import VOCABULARY
from carestar.llm.secrets import redact_column

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage in a session that hands Python at most 4 MB at a time, which executors hold
    several times over, unless the session sets another size itself. The setting stays, as
    stages return plans that run later."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if BATCH_BYTES not in spark.conf.getAll:
            spark.conf.set(BATCH_BYTES, str(4 << 20))
        return stage(spark, docs, sf_dir)

    return run


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, learnt from the labels of documents in hand. A null
    text is an empty one, and too short to stay; ties, repeated rows and very long texts are
    judged each by its own text. An empty table stays empty."""
    rules = fit_quality(docs, table(spark, sf_dir, "labels"))
    return docs.where(kept_column(F.col("text"), rules))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates, the document with the smallest id. Texts without words
    are one class; a class without any id keeps one row, and so does a row that is repeated. An
    empty table stays empty."""
    return one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item; those without a text leak none. Rows that repeat an
    id with another text are judged each by its own; an empty table stays empty."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets in their texts are masked and n_chars, where there is one, follows.
    Null and empty texts, repeated rows and empty tables stay as they are."""
    (masked,) = free_names(docs, "__masked")
    rows = docs.withColumn(masked, redact_column(F.col("text")))
    length = F.when(F.col(masked).eqNullSafe(F.col("text")), F.col("n_chars")) if "n_chars" in docs.columns else None
    new = {"text": F.col(masked).alias("text")}
    if length is not None:
        new["n_chars"] = length.otherwise(F.length(masked)).alias("n_chars")
    return rows.select(*(new.get(c, F.col(f"`{c}`")) for c in docs.columns))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids in windows of 4096. A null or empty text is its end id alone;
    repeated rows are packed each; an empty table gives no windows."""
    return pack(docs, VOCABULARY)


STAGES = [
    ("quality_rules", in_small_batches(keep_good)),
    ("near_duplicates", in_small_batches(keep_one_of_each)),
    ("decontamination", in_small_batches(drop_leaks)),
    ("secret_scans", in_small_batches(mask_secrets)),
    ("packing", in_small_batches(pack_windows)),
]

# Models, alignments and packing have no SQL form; tests/llm/test_pipeline.py has the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
