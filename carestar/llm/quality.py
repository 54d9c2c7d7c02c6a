"""Quality rules: boosted trees over document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestar.llm.common import column_lists, per_batch, per_text
from carestar.llm.trees import Trees, fit_trees

WINDOW = 8
SPACES = np.frombuffer(b" \t\n\v\f\r", np.uint8)
SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct",
    "n_upper", "n_digits", "n_exclaim", "n_stops", "n_bars",
)
# Direction in which the score may move: fewer symbols, repeated words and repeated lines
# never lower it.
FEATURES = {
    "words": 0,
    "chars_per_word": 0,
    "symbols_per_word": -1,
    "repeated_lines": -1,
    "repeated_words": -1,
    "words_per_line": 0,
    "distinct_words": 0,
    "upper_share": 0,
    "digit_share": 0,
    "exclaims_per_word": -1,
    "stops_per_word": 0,
    "bars_per_word": -1,
}
MAX_LABELLED = 20_000


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of eight words that occur twice or more, each word counted once."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    coded = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + coded[k : k + n]
    ordered = np.sort(mixed)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0  # equal windows have equal sums
    number: dict[bytes, int] = {}
    rank = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    width = 1
    while width < WINDOW:  # ranks of windows twice as wide, from pairs of ranks
        m = len(rank) - width
        pairs = rank[:m] * np.int64(len(words) + 1) + rank[width:]
        rank = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        width *= 2
    twice = np.bincount(rank)[rank] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.add.at(edge, np.flatnonzero(twice) + WINDOW, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def statistics(text: str | None) -> list[int]:
    """The numbers of STATISTICS for a whole text. Words are runs of other characters than
    ASCII white space; a null text has none."""
    data = (text or "").encode()
    words = data.split()
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    lines = [line for line in data.split(b"\n") if line.strip()]
    return [
        len(words),
        int(seen.sum() - seen[128:192].sum() - seen[SPACES].sum()),
        int(seen[SYMBOLS].sum()),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(set(words)),
        int(seen[65:91].sum()),
        int(seen[48:58].sum()),
        int(seen[33]),
        int(seen[46]),
        int(seen[124]),
    ]


def features(table: np.ndarray) -> np.ndarray:
    """FEATURES from rows of STATISTICS."""
    s = dict(zip(STATISTICS, np.asarray(table, float).reshape(-1, len(STATISTICS)).T, strict=True))
    words, chars, lines = (np.maximum(s[k], 1) for k in ("n_words", "word_chars", "n_lines"))
    return np.stack(
        [
            s["n_words"],
            s["word_chars"] / words,
            s["n_symbols"] / words,
            s["n_dup_lines"] / lines,
            s["n_repeat_words"] / words,
            s["n_words"] / lines,
            s["n_distinct"] / words,
            s["n_upper"] / chars,
            s["n_digits"] / chars,
            s["n_exclaim"] / words,
            s["n_stops"] / words,
            s["n_bars"] / words,
        ],
        axis=1,
    )


@dataclass
class QualityRules:
    trees: Trees
    threshold: float

    def judge(self, table: np.ndarray):
        """(base rule failed, score, kept) for rows of STATISTICS."""
        words, repeated = table[:, 0], table[:, 4]
        failed = (words < 20) | (100 * repeated > 30 * words)
        score = self.trees.score(features(table))
        return failed, score, ~failed & (score >= self.threshold)


def _table(texts) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.int64).reshape(-1, len(STATISTICS))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.5,
    max_labelled: int = MAX_LABELLED,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> QualityRules:
    """Boosted trees that tell quality 1 from 0, learnt from at most ``max_labelled`` labelled
    documents: those whose ids hash lowest, so the driver's share does not grow with the input.
    An id with several labels takes the lowest; null labels are left out. Without both labels
    the score is constant, and the base rule alone decides."""
    chosen = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(max_labelled)
    )
    taken = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    # At most max_labelled ids are broadcast.
    taken = taken.join(F.broadcast(chosen), taken["id"] == chosen["label_id"])

    def start():
        def work(batch):
            ids, texts, quality = column_lists(batch, "id", "text", "quality")
            return {"id": ids, "quality": quality, "stats": [statistics(t) for t in texts]}

        return work

    narrow = per_batch(taken.select("id", "text", "quality"), start, "id long, quality int, stats array<long>")
    rows = narrow.orderBy(F.xxhash64("id"), "id", "stats").limit(max_labelled).collect()
    table = np.array([r["stats"] for r in rows], np.int64).reshape(-1, len(STATISTICS))
    y = np.array([r["quality"] for r in rows], float)
    if not 0 < y.sum() < len(y):
        return QualityRules(fit_trees(features(table[:0]), y[:0], list(FEATURES.values())), 0.0)
    return QualityRules(fit_trees(features(table), y, list(FEATURES.values())), threshold)


def judge_quality(
    docs: DataFrame, rules: QualityRules, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row for each row of ``docs``: id, STATISTICS, base_failed, score, kept.

    A document is kept if it passes the base rule (20 words or more, at most 30 % of them in
    repeated windows) and the trees score it at the threshold or above. One pass, no shuffle.

    A null or empty text has no words and fails the base rule. A null id is kept. Repeated rows
    each give a row. An empty table gives no rows. Other columns are not read.
    """

    def start():
        def work(batch):
            ids, texts = column_lists(batch, "id", "text")
            table = _table(texts)
            failed, score, kept = rules.judge(table)
            columns = dict(zip(STATISTICS, table.T, strict=True))
            return {"id": ids, **columns, "base_failed": failed, "score": score, "kept": kept}

        return work

    taken = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    numbers = ", ".join(f"{name} long" for name in STATISTICS)
    schema = f"id long, {numbers}, base_failed boolean, score double, kept boolean"
    return per_batch(taken, start, schema).withColumnRenamed("id", id_column)


def kept_column(text: Column, rules: QualityRules) -> Column:
    """Whether the rules keep a text."""
    return per_text(text, lambda texts: rules.judge(_table(texts))[2], "boolean")
