import itertools
import random
import re

import numpy as np
import pytest

from carestar.llm import countjoin
from carestar.llm.countjoin import Classes, CountTree, Hashes, count_join, point_of, shingle_set
from tests.llm.cases import edge_rows, empty, frame, prose


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def set_of(text, length=3):
    words = words_of(text)
    if len(words) < length:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + length]) for i in range(len(words) - length + 1)}


def brute(rows, percent=90):
    sets = [set_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by_set, links = {}, 0
    for k, s in enumerate(sets):
        if s:
            root[find(k)] = find(by_set.setdefault(frozenset(s), k))
    for (s, i), (t, j) in itertools.combinations(by_set.items(), 2):
        if 100 * len(s & t) >= percent * len(s | t):
            links += 1
            root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted([(i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows)], key=str), links


def answered(docs, **options):
    return sorted(map(tuple, count_join(docs, **options).collect()), key=str)


def edited(text, rng, share):
    words = text.split()
    for _ in range(max(1, int(len(words) * share))):
        k, kind = rng.randrange(len(words)), rng.randrange(3)
        if kind == 0:
            words[k] = "new" + str(rng.randrange(99))
        elif kind == 1:
            words.insert(k, "more" + str(rng.randrange(99)))
        elif len(words) > 3:
            del words[k]
    return " ".join(words)


def test_edited_copies_against_all_pairs(spark):
    rng = random.Random(6)
    texts = []
    for k in range(60):
        base = prose(k, rng.choice([4, 9, 12, 20, 45, 90, 200, 700]))
        texts += [base] + [edited(base, rng, rng.choice([0.005, 0.01, 0.02, 0.03, 0.05])) for _ in range(rng.randrange(8))]
    chain = [prose(999, 150)]
    for _ in range(12):
        chain.append(edited(chain[-1], rng, 0.012))
    rows = list(enumerate(texts + chain + [t.upper() for t in texts[:20]]))
    rng.shuffle(rows)
    want, links = brute(rows)
    assert links > 60
    assert answered(frame(spark, rows)) == want


def test_lower_similarity(spark):
    rng = random.Random(9)
    rows = []
    for k in range(40):
        base = prose(k, rng.choice([5, 30, 80]))
        rows += [base] + [edited(base, rng, rng.choice([0.02, 0.05, 0.08])) for _ in range(4)]
    rows = list(enumerate(rows))
    want, links = brute(rows, 70)
    assert links > 30
    assert answered(frame(spark, rows), percent=70) == want


def test_a_template_without_links_and_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(countjoin, "CHUNK", 16)
    monkeypatch.setattr(countjoin, "QUERIES", 8)
    monkeypatch.setattr(countjoin, "POINTS", 20)
    rng = random.Random(3)
    header, base = prose(1, 84), prose(2, 120)
    rows = [(i, header + " " + prose(100 + i, 20)) for i in range(150)]
    rows += [(1000 + i, edited(base, rng, 0.012)) for i in range(150)]
    rows += [(2000 + i, edited(edited(base, rng, 0.012), rng, 0.02)) for i in range(60)]
    want, links = brute(rows)
    assert links > 1000
    assert answered(frame(spark, rows)) == want


def test_edge_rows(spark):
    rows = edge_rows() + [(20, "One TWO"), (21, "one two three"), (22, "one\x85two"), (None, prose(1, 80)), (23, "é ß 日本 \x1c <|endoftext|> Z")]
    got = answered(frame(spark, rows))
    assert got == brute(rows)[0]
    assert (4, 0, 4) in got and (20, 1, 7) in got
    assert answered(frame(spark, rows * 3)) == brute(rows * 3)[0]


def test_empty_table(spark):
    found = count_join(empty(spark))
    assert found.columns == ["doc_id", "n_shingles", "component_id"] and found.collect() == []


@pytest.mark.parametrize("percent", [50, 70, 80, 90, 95])
def test_every_pair_that_links_shares_a_band(percent):
    """Over all sizes of two sets that just link: a class in common, and a band left whole."""
    classes = Classes(percent)
    for a in list(range(1, 400)) + [5000, 70_001]:
        for b in {a, a + 1, 100 * a // percent}:
            if a == b or 100 * a < percent * b:
                continue
            common = set(classes.of(a)) & set(classes.of(b))
            assert common
            # With s shared of sets of a and b, a + b - 2 s differ; the least s that links:
            s = -(-percent * (a + b) // (100 + percent))
            assert all(a + b - 2 * s < classes.bands(k) for k in common)


def test_tree_finds_what_all_minima_find():
    rng = np.random.default_rng(2)
    counts = rng.poisson(2, size=(700, 48)).astype(np.uint16)
    for k in range(0, 700, 7):
        counts[k + 1 : k + 5] = counts[k]
        counts[k + 2 : k + 5, rng.integers(0, 48)] += 3
    sizes = counts.sum(axis=1).astype(np.int64)
    tree = CountTree(counts, sizes)
    met = 0
    for q in range(0, 700, 3):
        at, shared = tree.search(counts[q], int(sizes[q]), 90)
        least = np.minimum(counts, counts[q]).sum(axis=1)
        want = np.flatnonzero(100 * least >= 90 * (sizes + sizes[q] - least))
        assert sorted(at.tolist()) == want.tolist()
        assert (shared == least[at]).all()
        met += len(at)
    assert met > 800


def test_keys_tell_equal_bands():
    values = shingle_set([str(k).encode() for k in range(300)], Hashes(), 3)
    bands = 40
    counts, keys = point_of(values, 5, bands)
    assert counts.sum() == len(values) and len(keys) == bands
    fewer, others = point_of(values[:-1], 5, bands)
    gone = int(values[-1] % np.uint64(4 * bands))
    assert (keys != others).nonzero()[0].tolist() == [gone // 4]
    assert (counts != fewer).nonzero()[0].tolist() == [gone]


def test_wide_rows_do_not_come_together_by_node(spark, monkeypatch):
    """Copies are left out by their numbers: what is written by node is narrow."""
    written, store = {}, countjoin.stored
    monkeypatch.setattr(countjoin, "stored", lambda df, name: written.setdefault(name, df.columns) and store(df, name))
    rng = random.Random(4)
    base = [prose(k, 60) for k in range(30)]
    rows = [(i, base[i % 30] if i % 3 else edited(base[i % 30], rng, 0.01)) for i in range(300)]
    rows += [(None, base[0]), (None, base[1]), (7, base[2]), (7, base[3]), (7, base[3])]
    assert answered(frame(spark, rows)) == brute(rows)[0]
    assert not {"keys", "counts", "content"} & set(written["nodes"]) and "keys" in written["signs"]
