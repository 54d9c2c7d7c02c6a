import collections
import math
import random

import numpy as np

from carestar.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<float>, x int, id string, row string, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "a", "b", "c") for i, v in rows], SCHEMA)


def made(n, width, seed=3, rank=None):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(rank or width, width)) * np.geomspace(1, 0.05, rank or width)[:, None]
    values = (rng.normal(size=(n, rank or width)) @ mix).astype(np.float32)
    return [(i, [float(c) for c in v]) for i, v in enumerate(values)]


def check(rows, got, components=16):
    """Against whole-table arithmetic in exact integers and numpy."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fixed = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in good]
    fit = sorted(set(x for _, x in fixed))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums, strict=True)] for x in fit])
    covariance = centred.T @ centred / n
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1], directions[:, ::-1]
    k = min(components, int((values > 1e-10 * values[0]).sum()))
    deviation = collections.Counter()
    for i, x in fixed:
        total = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        deviation.update({(i, c + 1, n, total): 1 for c in range(k)})
    assert deviation == collections.Counter((r.vec_id, r.component, r.n, r.deviation) for r in got)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error <= 1e-4
    want = collections.defaultdict(list)
    for i, x in fixed:
        want[i].append([(n * c - s) / n for c, s in zip(x, sums, strict=True)] @ directions[:, :k] / np.sqrt(values[:k]))
    by_component = collections.defaultdict(list)
    for r in got:
        by_component[r.component].append(r)
        assert abs(r.explained - values[r.component - 1] / values.sum()) <= 1e-4 * r.explained
    for c, own in by_component.items():
        ours, theirs = collections.defaultdict(list), collections.defaultdict(list)
        for r in own:
            ours[r.vec_id].append(r.whitened)
        for i, vs in want.items():
            theirs[i] = [v[c - 1] for v in vs]
        keys = sorted(ours, key=str)
        a = np.array([v for i in keys for v in sorted(ours[i])])
        b = np.array([v for i in keys for v in sorted(theirs[i])])
        flipped = np.array([v for i in keys for v in sorted(-x for x in theirs[i])])
        assert min(np.abs(a - b).max(), np.abs(a - flipped).max()) < 1e-6


def test_against_exact_integers(spark):
    rows = made(700, 24)
    check(rows, whiten(frame(spark, rows), height=64).collect())


def test_blocks_of_several_columns_and_odd_heights(spark):
    rows = made(333, 11)
    check(rows, whiten(frame(spark, rows).repartition(7), components=5, height=10, columns=4).collect(), 5)


def test_odd_rows(spark):
    rows = made(60, 6)
    odd = [
        (100, None), (101, []), (102, [None] * 6), (103, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0]),
        (104, [float("inf")] + [0.0] * 5), (None, rows[0][1]), (None, None), (7, rows[8][1]), (7, rows[8][1]),
        (105, [-0.0] * 6),
    ]
    check(rows + odd, whiten(frame(spark, rows + odd), height=16).collect())
    other = [(200, [1.0, 2.0]), (201, [0.5])]
    check(rows, whiten(frame(spark, rows + other), height=16).collect())
    huge = [(300, [1e30] + [0.0] * 5)]
    check(rows, whiten(frame(spark, rows + huge), height=16).collect())


def test_a_vector_of_a_third_of_the_rows(spark):
    rows = made(200, 8) + [(1000 + i, [0.25] * 8) for i in range(100)]
    random.Random(1).shuffle(rows)
    check(rows, whiten(frame(spark, rows), height=32).collect())


def test_alike_vectors_span_fewer_components(spark):
    rows = [(i, [float(i % 5), float(i % 5), 1.0]) for i in range(40)]
    got = whiten(frame(spark, rows), height=8).collect()
    check(rows, got)
    assert {r.component for r in got} == {1}
    assert whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []


def test_empty_table_has_the_columns(spark):
    found = whiten(frame(spark, []))
    assert found.collect() == []
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
