"""The operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.llm.common import table
from carestar.llm.countjoin import count_join
from carestar.llm.decontam import find_leaks
from carestar.llm.lm import score_texts
from carestar.llm.neardup import near_duplicates
from carestar.llm.packing import pack
from carestar.llm.periodic import digests, find_runs, with_planted_runs
from carestar.llm.quality import fit_quality, judge_quality
from carestar.llm.quotes import LINK_SQL, link_quotes
from carestar.llm.secrets import scan_secrets
from carestar.llm.sharding import shard_by_bytes
from carestar.llm.token_counts import count_tokens, with_limit
from carestar.llm.toxicity import fit_toxicity, score_toxicity
from carestar.llm.whitening import whiten

VOCABULARY = tokenizer_path("word_bpe_49k.json")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_token_counts(spark, sf_dir):
    return with_limit(count_tokens(table(spark, sf_dir, "documents"), VOCABULARY), 2048)


@query
def op7_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op8_sharding(spark, sf_dir):
    put = shard_by_bytes(table(spark, sf_dir, "documents"), shards=24)
    return put.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op5_quality_rules(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judged = judge_quality(docs, fit_quality(docs, labels))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score",
    )


@query
def op10_secret_scans(spark, sf_dir):
    return scan_secrets(table(spark, sf_dir, "documents"))


def crc_remainder(column: str, divisor: int):
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(divisor))


@query
def op6_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_toxicity(docs, labels.where(crc_remainder("doc_id", 3) != 1))
    return score_toxicity(docs, model).select(
        "doc_id",
        F.coalesce(crc_remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op3_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_decontamination(spark, sf_dir):
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_lm_scores(spark, sf_dir):
    held_out = F.coalesce(crc_remainder("doc_id", 5) == 1, F.lit(False))
    scored = score_texts(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
        "score",
    )


@query
def op11_embedding_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_count_vector_join(spark, sf_dir):
    return count_join(table(spark, sf_dir, "documents"))


@query
def op13_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    planted = with_planted_runs(F.col("text"), F.col("doc_id"))
    return digests(find_runs(docs.select("doc_id", planted.alias("text"))))


@query
def op1_quotation_linking(spark, sf_dir):
    return link_quotes(table(spark, sf_dir, "conversations"))


ORACLE["op1_quotation_linking"] = LINK_SQL
