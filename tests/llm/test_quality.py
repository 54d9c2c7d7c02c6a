import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from carestar.llm.queries import op5_quality_rules
from carestar.llm.quality import STATISTICS, fit_quality, judge_quality, kept_column, repeated_words, statistics
from carestar.llm.trees import fit_trees
from tests.llm.cases import edge_rows, empty, frame, prose

SMALL = "/root/testdata/sf0.001"
SPACES = " \t\n\v\f\r"


def brute(text):
    text = text or ""
    words, word = [], ""
    for c in text + " ":
        if c in SPACES:
            words += [word] if word else []
            word = ""
        else:
            word += c
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            inside.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return [len(words), sum(map(len, words)), symbols, dup, len(inside)]


TEXTS = [t for _, t in edge_rows() if not t or len(t) < 5000] + [
    prose(1, 12) + " " + prose(1, 12), "a b c d e f g h " * 4, "x " * 30, "a\n\n a\na\n a\n \n \n",
    "one\x1ctwo three\x85four <|>&", "p q r s t u v w x p q r s t u v w y", prose(5, 30) + "\n" + prose(5, 30),
]


@pytest.mark.parametrize("text", TEXTS)
def test_statistics_against_brute_force(text):
    assert statistics(text)[:5] == brute(text)


def test_repeated_words_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(300):
        words = [f"{k}".encode() for k in rng.integers(0, 3, rng.integers(0, 40))]
        assert repeated_words(words) == brute(b" ".join(words).decode())[4]


def test_monotone_features_only_move_the_score_their_way():
    rng = np.random.default_rng(1)
    x = rng.random((800, 3))
    y = ((x[:, 0] - x[:, 1] + 0.3 * rng.standard_normal(800)) > 0).astype(float)
    trees = fit_trees(x, y, [1, -1, 0], trees=30)
    for f, sign in ((0, 1), (1, -1)):
        grid = np.repeat(x[:50, None, :], 21, axis=1)
        grid[:, :, f] = np.linspace(0, 1, 21)
        score = trees.score(grid.reshape(-1, 3)).reshape(50, 21)
        assert (sign * np.diff(score, axis=1) >= -1e-12).all()
        assert (np.ptp(score, axis=1) > 0).any()


def test_flat_trees_score_as_walking_them_does():
    rng = np.random.default_rng(2)
    x = rng.random((300, 2))
    trees = fit_trees(x, (x[:, 0] > 0.4).astype(float), [0, 0], trees=8, depth=3)

    def walk(row):
        total = trees.base
        for node in trees.roots:
            while trees.left[node] != node:
                below = row[trees.feature[node]] <= trees.threshold[node]
                node = trees.left[node] if below else trees.right[node]
            total += trees.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.score(x), [walk(r) for r in x])
    assert ((trees.score(x) > 0.5) == (x[:, 0] > 0.4)).mean() > 0.97


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(3)) == 0
    judged = judge_quality(docs, fit_quality(docs, labels.where(~held)))
    rows = judged.join(labels.where(held), "doc_id").where("not base_failed").collect()
    right = sum((r.score >= 0.5) == bool(r.quality) for r in rows)
    assert len(rows) > 80 and right / len(rows) > 0.93


def test_edge_rows_and_missing_labels(spark):
    docs, none = frame(spark), spark.createDataFrame([], "doc_id long, quality int")
    rules = fit_quality(docs, none)
    got = judge_quality(docs, rules).collect()
    want = [(i, *statistics(t), (s := brute(t))[0] < 20 or 100 * s[4] > 30 * s[0]) for i, t in edge_rows()]
    assert sorted(repr((r.doc_id, *(r[c] for c in STATISTICS), r.base_failed)) for r in got) == sorted(map(repr, want))
    assert all(r.kept != r.base_failed for r in got)
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0), (77, 1)], "doc_id long, quality int")
    assert judge_quality(docs, fit_quality(docs, odd)).count() == len(edge_rows())
    assert judge_quality(empty(spark), rules).collect() == []
    flags = docs.select("doc_id", kept_column(F.col("text"), rules).alias("kept")).collect()
    assert collections.Counter(map(tuple, flags)) == collections.Counter((r.doc_id, r.kept) for r in got)


def test_query(spark):
    got = op5_quality_rules(spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(got) == len(texts)
    for r in got:
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == brute(texts[r.doc_id])
        assert not (r.kept and r.base_failed)
