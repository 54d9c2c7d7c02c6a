import collections
import itertools
import random

import numpy as np
import pytest

from carestar.llm.components import components
from carestar.llm.dartminhash import DartSignature, WordHashes, shingles, weighted_jaccard
from carestar.llm.neardup import near_duplicates, one_of_each, words_of
from tests.llm.cases import WORDS, edge_rows, empty, frame, prose


def runs(text):
    words = (text or "").lower().split()
    if not words:
        return collections.Counter()
    n = max(1, len(words) - 4)
    return collections.Counter(tuple(words[i : i + 5]) for i in range(n))


def brute_classes(rows, similarity=0.8):
    """Class of each row, all pairs compared."""
    counted = [runs(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = counted[i], counted[j]
        least, most = (a & b).total(), (a | b).total()
        if (least / most if most else 1) >= similarity:
            parent[root(i)] = root(j)
    return [root(i) for i in range(len(rows))]


def want(rows):
    classes = collections.defaultdict(list)
    for (doc, _), c in zip(rows, brute_classes(rows), strict=True):
        classes[c].append(doc)
    return collections.Counter(
        (doc, min((d for d in listed if d is not None), default=None), len(listed))
        for listed in classes.values()
        for doc in listed
    )


def edited(text, seed, edits):
    rng = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(WORDS) + "x"
    return " ".join(words)


def copies(n_bases=6, each=14):
    rows = []
    for b in range(n_bases):
        base = prose(b, 150 + 20 * b)
        rows += [(1000 * b + k, edited(base, 100 * b + k, k)) for k in range(each)]
    random.Random(0).shuffle(rows)
    return rows


def test_classes_are_those_of_all_pairs(spark):
    rows = edge_rows()[:-3] + copies() + [(9000, "same line " * 30), (9001, "same line " * 29)]
    assert collections.Counter(map(tuple, near_duplicates(frame(spark, rows)).collect())) == want(rows)


def test_a_chain_is_one_class(spark):
    words = prose(7, 200).split()
    rows = []
    for k in range(12):  # each next one changes another word; the ends have little in common
        words[k * 12 : k * 12 + 3] = [f"new{k}", f"word{k}", f"here{k}"]
        rows.append((50 - k, " ".join(words)))
    got = {r.class_id for r in near_duplicates(frame(spark, rows)).collect()}
    assert weighted_jaccard(*(shingles(words_of(rows[i][1]), WordHashes()) for i in (0, -1))) < 0.8
    assert got == {39}


def test_a_large_group_of_edited_copies_against_all_pairs(spark, monkeypatch):
    from carestar.llm import neardup

    monkeypatch.setattr(neardup, "BLOCK", 16)
    base = prose(3, 120)
    rows = [(i, edited(base, i, i % 14)) for i in range(260)] + [(500 + i, prose(i, 90)) for i in range(20)]
    assert collections.Counter(map(tuple, near_duplicates(frame(spark, rows)).collect())) == want(rows)


def test_empty_table(spark):
    assert near_duplicates(empty(spark)).collect() == []
    assert one_of_each(empty(spark)).collect() == []


def test_one_row_of_each_class_stays(spark):
    rows = edge_rows() + copies(3, 8)
    docs = frame(spark, rows)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    classes = collections.defaultdict(list)
    for (doc, _), c in zip(rows, brute_classes(rows), strict=True):
        classes[c].append(doc)
    smallest = [min((d for d in ids if d is not None), default=None) for ids in classes.values()]
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(smallest)


def test_signatures_agree_as_often_as_sets_do():
    hashes, darts = WordHashes(), DartSignature()
    shares, alike = [], []
    for seed in range(40):
        base = prose(seed, 300) + " and so on it goes round" * (seed % 5)
        a, b = (shingles(words_of(t), hashes) for t in (base, edited(base, seed, 8)))
        left, right = darts.signatures([a, b])
        shares.append(weighted_jaccard(a, b))
        alike.append((left == right).mean())
    assert abs(np.mean(shares) - np.mean(alike)) < 0.02


def test_counts_weigh():
    hashes = WordHashes()
    for x, y in [("a b c d e " * 9, "a b c d e " * 6), ("p q", "p q"), ("p q", "p r"), ("", "")]:
        a, b = runs(x), runs(y)
        most = (a | b).total()
        assert weighted_jaccard(shingles(words_of(x), hashes), shingles(words_of(y), hashes)) == (
            pytest.approx((a & b).total() / most if most else 1)
        )


def test_a_document_signs_alone_as_among_others():
    hashes, darts = WordHashes(), DartSignature(8, 4)
    sets = [shingles(words_of(prose(i, 5 + 40 * i)), hashes) for i in range(12)]
    together = darts.band_keys(sets)
    assert all((darts.band_keys([s])[0] == row).all() for s, row in zip(sets, together, strict=True))


def test_components_against_union_find(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(60)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: root(x) for x in list(parent)}
    assert len(got) == len({r.node for r in got})
