"""Language-model scores of whole documents: counts of all tokens, and a recurrent model."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestar.llm.common import column_lists, per_batch, slices, stored
from carestar.llm.gru import NAMES, Gru, Trainer, first_weights, make_lexicon, score_documents

CORE = 16_383
# All other words share so many tokens, by a hash; the last is the model's ``rest``.
BUCKETS = 1024
KNOWN = 1 << 18
CLASSES = 32
HIDDEN = 16
GROUP_TOKENS = 2_000_000
# Weights that move through the averaging as one row.
SLICE = 1024
# Words have no white space, so the empty word is free to stand for the end of a document.
END = b""


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Of all texts in a row, the words between ASCII white space with A-Z in lower case, each
    text's followed by the end; and how many of both each text has. A null text has the end."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "").cast(pa.string())))
    words, of = lists.flatten().cast(pa.binary()), pc.list_parent_indices(lists).to_numpy()
    # White space at either end is next to an empty piece.
    full = np.flatnonzero(pc.binary_length(words).to_numpy() > 0)
    sizes = np.bincount(of[full], minlength=len(texts)) + 1
    places = np.full(len(full) + len(texts), len(words), np.int64)
    places[np.arange(len(full)) + of[full]] = full
    return pa.concat_arrays([words, pa.array([END], pa.binary())]).take(pa.array(places)), sizes


def count_words(texts: DataFrame) -> DataFrame:
    """(word, c) over all rows of ``texts`` (text)."""

    def start():
        def work(batch):
            seen = pc.value_counts(words_in(batch.column(0))[0])
            return {"word": seen.field("values"), "n": seen.field("counts")}

        return work

    # In large batches a word comes less often to Spark, with a count for each.
    counted = per_batch(texts, start, "word binary, n long", rows=10_000, size=16 << 20)
    return counted.groupBy("word").agg(F.sum("n").alias("c"))


def most_frequent(counts: DataFrame, most: int) -> list:
    """At most ``most`` rows of ``counts``, by falling count. A histogram of sixteenths of powers
    of two tells from which count on; the bin that would be too much gives a share by a hash."""
    size = F.floor(16 * F.log2("c"))
    bins = counts.groupBy(size.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    taken, wanted = 0, F.lit(False)
    for b, n in sorted(map(tuple, bins), reverse=True):
        share = min(1.0, 0.95 * (most - taken) / n if n > most - taken else 1.0)
        wanted = (size > b) | ((size == b) & (F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20))))
        taken += n
        if share < 1:
            break
    return sorted(counts.where(wanted).collect(), key=lambda r: (-r["c"], bytes(r["word"])))[:most]


def bucket_masses(counts: DataFrame) -> list[float]:
    """The add-half counts of all words of a bucket; at most BUCKETS rows come to the driver."""
    bucket = F.pmod(F.crc32("word"), F.lit(BUCKETS)).alias("b")
    masses = [0.0] * BUCKETS
    for r in counts.groupBy(bucket).agg((F.sum("c") + 0.5 * F.count(F.lit(1))).alias("m")).collect():
        masses[r["b"]] = float(r["m"])
    return masses


class Vocabulary:
    """The most frequent words with their counts: those the model names, and more whose counts
    every task holds. No larger than KNOWN; rarer words are looked up by a join.

    The model's tokens are the core words and the buckets, by falling mass; a bucket's words are
    drawn by their add-half counts, of which half a count is left for words never met."""

    def __init__(self, words: list[bytes], counts: list[int], tokens: int, distinct: int, masses: list[float]):
        self.words = pa.array(words, pa.binary())
        self.core = min(CORE, len(words))
        self.log_count = np.log10(np.array(counts, float) + 0.5)
        self.total = tokens + 0.5 * (distinct + 1)
        core = np.array(counts[: self.core], float) + 0.5
        bucket = self.buckets(words)
        left = np.array(masses) - np.bincount(bucket[: self.core], core, BUCKETS)
        left = np.maximum(left, 0) + 0.5
        mass = np.concatenate([core, left[:-1]])
        order = np.argsort(-mass, kind="stable")
        number = np.empty(len(mass) + 1, np.int32)
        number[order], number[-1] = np.arange(len(mass)), len(mass)
        self.bucket_token = number[self.core :]
        self.log_left = np.log10(left)
        self.token = np.concatenate([number[: self.core], self.bucket_token[bucket[self.core :]]])
        # What a word adds to the model's score of its token.
        self.within = self.log_count - self.log_left[bucket]
        self.within[: self.core] = 0
        self.lexicon = make_lexicon(mass[order], left[-1], CLASSES)

    @staticmethod
    def buckets(words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % BUCKETS

    @cached_property
    def code(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words.to_pylist())}

    def codes(self, words: pa.Array | list[bytes]) -> np.ndarray:
        """Places in the table, -1 for rarer words."""
        found = pc.index_in(pa.array(words, pa.binary()) if isinstance(words, list) else words, self.words)
        return pc.fill_null(found, -1).to_numpy(zero_copy_only=False)

    def each(self, words: pa.Array, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Numbers that the model knows; what each word adds to its score, of words rarer than
        those in the table without their counts; and those rarer words."""
        held = codes >= 0
        rare = words.filter(pa.array(~held)).to_pylist()
        numbers, within = np.empty(len(codes), np.int32), np.empty(len(codes))
        numbers[held], within[held] = self.token[codes[held]], self.within[codes[held]]
        bucket = self.buckets(rare)
        numbers[~held], within[~held] = self.bucket_token[bucket], -self.log_left[bucket]
        return numbers, within, rare

    def tokens(self, words: list[bytes], codes: np.ndarray) -> tuple[np.ndarray, float]:
        """As ``each`` for one text: its numbers, and what all its words add."""
        numbers, within, _ = self.each(pa.array(words, pa.binary()), codes)
        return numbers, within.sum()


def in_groups(documents, size: int = GROUP_TOKENS):
    """Lists of positions of documents of near equal length, about ``size`` tokens each."""
    group, tokens = [], 0
    for i in sorted(range(len(documents)), key=lambda i: len(documents[i])):
        group.append(i)
        tokens += len(documents[i])
        if tokens >= size:
            yield group
            group, tokens = [], 0
    if group:
        yield group


def train(texts: DataFrame, words, lexicon, least_updates: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights averaged over tasks that each learn from all their rows, from the same start.

    A task with few rows goes over them again until it has made ``least_updates``. Its weights
    count by the tokens it read. The sums are made by Spark, a slice of the weights at a time;
    the driver gets one number for each weight, whatever the input."""
    size = sum(v.size for v in first_weights(lexicon, HIDDEN, seed).values())

    def run(batches):
        vocabulary = Vocabulary(*words.value)
        model = Gru(vocabulary.lexicon, first_weights(vocabulary.lexicon, HIDDEN, seed))
        trainer, read = Trainer(model), 0
        part, tokens = [], 0

        def mixed():
            order = np.random.default_rng(seed).permutation(len(part))
            return [part[i] for i in order]

        for batch in batches:
            for piece in slices(batch, 2_000, 4 << 20):
                listed, sizes = words_in(piece.column(0))
                numbers = vocabulary.each(listed, vocabulary.codes(listed))[0]
                part += np.split(numbers, np.cumsum(sizes)[:-1])
                tokens += len(numbers)
                if tokens >= GROUP_TOKENS:
                    read += trainer.learn(mixed())
                    part, tokens = [], 0
        if part:
            read += trainer.learn(mixed())
            while trainer.updates < least_updates:
                trainer.learn(mixed())
        if read:
            flat = np.concatenate([model.w[k].ravel() for k in NAMES]).astype(np.float32)
            cut = [flat[at : at + SLICE].tobytes() for at in range(0, size, SLICE)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(cut)), pa.int64()),
                    pa.array([float(read)] * len(cut), pa.float64()),
                    pa.array(cut, pa.binary()),
                ],
                names=["i", "weight", "w"],
            )

    def average(batches):
        totals, weights = {}, Counter()
        for batch in batches:
            for i, weight, w in zip(*column_lists(batch, "i", "weight", "w"), strict=True):
                totals[i] = totals.get(i, 0) + weight * np.frombuffer(w, np.float32).astype(np.float64)
                weights[i] += weight
        if totals:
            means = [(totals[i] / weights[i]).astype(np.float32).tobytes() for i in totals]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.int64()), pa.array(means, pa.binary())], names=["i", "w"]
            )

    sums = (
        texts.mapInArrow(run, "i long, weight double, w binary")
        .repartition("i")
        .mapInArrow(average, "i long, w binary")
        .collect()
    )
    weights = first_weights(lexicon, HIDDEN, seed)
    if sums:
        flat = np.zeros(size, np.float32)
        for r in sums:
            flat[r["i"] * SLICE : (r["i"] + 1) * SLICE] = np.frombuffer(r["w"], np.float32)
        at = 0
        for k in NAMES:
            n = weights[k].size
            weights[k] = flat[at : at + n].reshape(weights[k].shape)
            at += n
    return weights


def score_texts(
    docs: DataFrame,
    learn_from: Column,
    train_share: float = 1.0,
    least_updates: int = 300,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: id, n_tokens, n_known, train_tokens, base_score, score.

    Counts of tokens cover all rows for which ``learn_from`` is true. base_score is the add-half
    unigram log10 probability of the text under them. score is the model's: a gated recurrent
    network over the 16,383 most frequent words and 1,024 buckets of all others by a hash, whose
    words are then drawn by their add-half counts; so score, too, is a probability of the whole text with its rarest
    words. The network, too, learns from all of those rows; a ``train_share`` under 1 leaves it
    that share of them, chosen by a hash of the text.

    Words beyond the 262,144 most frequent are looked up by a join; that the driver and the
    tasks hold only so many does not change results. Counts and rare words move through shuffles
    that grow with the input; texts do not.

    A null text counts as empty and has one token, the end. A null id is kept. Repeated rows
    each give a row and each count. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    text = F.col(text_column)
    seen = docs.where(F.coalesce(learn_from, F.lit(True))).select(text.alias("text"))
    counts = stored(count_words(seen), "counts")
    tokens, distinct = counts.agg(F.sum("c"), F.count("*")).first()
    tokens = tokens or 0
    top = most_frequent(counts, KNOWN)
    parts = [bytes(r["word"]) for r in top], [r["c"] for r in top], tokens, distinct, bucket_masses(counts)
    words = spark.sparkContext.broadcast(parts)  # plain values: workers need no module for them
    if train_share < 1:
        seen = seen.where(F.pmod(F.xxhash64("text", F.lit("train")), F.lit(1000)) < int(1000 * train_share))
    learnt = train(seen, words, Vocabulary(*parts).lexicon, least_updates)
    weights = spark.sparkContext.broadcast(learnt)

    def start():
        vocabulary = Vocabulary(*words.value)
        model = Gru(vocabulary.lexicon, weights.value)
        natural = math.log(10)
        log_total = math.log10(vocabulary.total)

        def work(batch):
            listed, sizes = words_in(batch.column(1))
            codes = vocabulary.codes(listed)
            numbers, within, rare = vocabulary.each(listed, codes)
            ends = np.cumsum(sizes)
            starts = ends - sizes
            log_counts = np.where(codes >= 0, vocabulary.log_count[codes], 0) if len(vocabulary.words) else np.zeros(len(codes))
            known = np.add.reduceat(codes >= 0, starts, dtype=np.int64)
            rare_ends = np.cumsum(sizes - known)
            documents = np.split(numbers, ends[:-1])
            model_part = np.zeros(len(documents))
            for group in in_groups(documents):
                model_part[group] = score_documents(model, [documents[i] for i in group])
            return {
                "id": column_lists(batch, "id")[0],
                "n_tokens": sizes,
                "n_known": known,
                "base_score": np.add.reduceat(log_counts, starts) - sizes * log_total,
                "score": np.add.reduceat(within, starts) + model_part / natural,
                "rare": [rare[low:high] for low, high in zip(rare_ends - (sizes - known), rare_ends, strict=True)],
            }

        return work

    taken = docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"))
    schema = (
        "id long, n_tokens long, n_known long, base_score double, score double, rare array<binary>"
    )
    # Long documents share their steps with more lanes in large batches.
    scored = per_batch(taken, start, schema, rows=10_000, size=16 << 20).withColumn("row", F.monotonically_increasing_id())
    scored = stored(scored, "scored")
    # Words rarer than those each task holds: their counts, or none.
    rare = scored.select("row", F.explode("rare").alias("word"))
    found = rare.join(counts, "word", "left").groupBy("row")
    log_count = F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5))
    found = found.agg(F.sum(log_count).alias("more"), F.count("c").alias("met"))
    both = scored.drop("rare").join(found.withColumnRenamed("row", "__row"), F.col("row") == F.col("__row"), "left")
    more = F.coalesce("more", F.lit(0.0))
    return both.select(
        F.col("id").alias(id_column),
        "n_tokens",
        (F.col("n_known") + F.coalesce("met", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )

