import collections
import random

import pytest
from pyspark.sql import functions as F

from carestar.llm.common import flag_likely, likely_in, salted_rank


@pytest.mark.parametrize("cell", [1, 7, 10_000])
def test_numbers_have_no_gaps_in_any_group(spark, cell):
    rng = random.Random(cell)
    rows = [(rng.choice("aaaaaab"), rng.randrange(50)) for _ in range(400)] + [(None, 1), (None, None), ("c", None)]
    ranked = salted_rank(spark.createDataFrame(rows, "g string, k long"), "g", ["k"], "place", cell)
    assert ranked.columns == ["g", "k", "place"]
    places = collections.defaultdict(list)
    for r in ranked.collect():
        places[r.g].append(r.place)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert sum(map(len, places.values())) == len(rows)


@pytest.mark.parametrize("bits", [64, 1 << 10, 1 << 24])
def test_wanted_keys_are_always_flagged(spark, bits):
    df = spark.createDataFrame([(i,) for i in range(500)] + [(None,)], "k long")
    wanted = spark.createDataFrame([(i,) for i in range(0, 500, 9)] + [(None,), (10**12,)], "w long")
    flags = flag_likely(df, F.col("k"), wanted, F.col("w"), "f", bits).collect()
    assert len(flags) == 501
    assert all(r.f for r in flags if r.k is None or r.k % 9 == 0)
    if bits == 1 << 24:
        assert sum(r.f for r in flags) <= 60
    none = wanted.where("false")
    assert likely_in(df, F.col("k"), none, F.col("w")).count() == 0
