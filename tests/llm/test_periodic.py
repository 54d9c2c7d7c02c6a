import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from carestar.llm.periodic import digests, find_runs, runs_of, with_planted_runs
from tests.llm.cases import edge_rows, empty, frame


def brute(words, least=6, exponent=4):
    """All runs by comparing words of every distance."""
    n, smallest = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                smallest.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in smallest.items()), key=lambda r: (r[0], r[2]))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc, words):
    h = zlib.crc32(str(doc).encode())
    g, n = h // 10, len(words)
    if doc is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def wanted(doc, text):
    words = planted(doc, words_of(text))
    runs = brute(words)
    top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc, len(runs), *(top or (None, None, None)), 1000 * top[1] // top[2] if top else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        sha(" ".join(w for k, w in enumerate(words) if k not in gone)),
    )


def answered(docs):
    text = with_planted_runs(F.col("text"), F.col("doc_id"))
    found = digests(find_runs(docs.withColumn("text", text)))
    return sorted(map(tuple, found.collect()), key=str)


def test_random_words_against_all_distances():
    rng = random.Random(5)
    for _ in range(1500):
        words = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randrange(60))]
        if words and rng.random() < 0.5:
            a, p = rng.randrange(len(words)), 1 + rng.randrange(8)
            for i in range(a + p, len(words)):
                words[i] = words[i - p]
        for least, exponent in ((6, 4), (4, 2), (2, 2)):
            assert runs_of(np.array(words, np.int64), least, exponent) == brute(words, least, exponent)


def test_fibonacci_words():
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    assert runs_of(np.array(b, np.int64), 2, 2) == brute(b, 2, 2)


def test_long_periodic_text():
    assert runs_of(np.zeros(50_000, np.int64)) == [(0, 50_000, 1)]
    assert runs_of(np.arange(200_000) % 40_000) == [(0, 200_000, 40_000)]


def test_query_rows_and_edge_rows(spark):
    rng = random.Random(8)
    letters = ["ab  \n", "a b", "ab  c\x1cd \n"]
    rows = [(i, " ".join(rng.choice(letters[i % 3]) for _ in range(rng.randrange(120)))) for i in range(300)]
    rows += [(i, " ".join(f"w{rng.randrange(9)}" for _ in range(rng.randrange(90)))) for i in range(300, 500)]
    rows += [(i, t) for i, t in edge_rows() if i != 6] + [(600, "x " * 500), (601, "A a " * 9)]
    want = sorted((wanted(i, t) for i, t in rows), key=str)
    assert answered(frame(spark, rows)) == want
    assert sum(r[1] for r in want) > 60


def test_very_long_text_and_empty_table(spark):
    (long,) = (t for i, t in edge_rows() if i == 6)
    (plain,) = find_runs(frame(spark, [(6, long)])).collect()
    assert (plain.n_words, plain.starts, plain.collapsed) == (30_000, [], long)
    words = planted(6, words_of(long))
    period = 1 + (30_000 - zlib.crc32(b"6") // 10 % 30_000) // (3 + zlib.crc32(b"6") // 10 % 8)
    (row,) = answered(frame(spark, [(6, long)]))
    assert words != words_of(long) and row[4] == period and sum(words[-1 - k] == words[-1 - k - period] for k in range(period)) == period
    assert answered(empty(spark)) == []


def test_spans_and_collapsed_text(spark):
    docs = frame(spark, [(1, "keep a b a b a b a b end end")])
    (row,) = find_runs(docs).collect()
    assert (row.starts, row.lengths, row.periods) == ([1], [8], [2])
    assert row.collapsed == "keep a b end end"
