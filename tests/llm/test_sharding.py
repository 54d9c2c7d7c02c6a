import collections
import random
import zlib

from carestar.llm.sharding import longest_first, shard_by_bytes
from tests.llm.cases import edge_rows, empty, frame, prose


def check(rows, got, shards):
    sizes = lambda t: len((t or "").encode()) + 8
    want = collections.Counter((i, sizes(t), zlib.crc32((t or "").encode())) for i, t in rows)
    assert want == collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got)
    by_text, slots, loads = collections.defaultdict(set), collections.defaultdict(list), collections.Counter()
    for r in got:
        by_text[r.text_crc32].add(r.shard)
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(0 <= s < shards for s in slots)
    return loads


def test_edge_rows(spark):
    check(edge_rows(), shard_by_bytes(frame(spark), shards=3, rows_per_cell=2).collect(), 3)


def test_loads_are_those_of_plain_scheduling(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng.randrange(150), rng.randrange(5, 60))) for i in range(600)]
    got = shard_by_bytes(frame(spark, rows), shards=6, bundles_per_shard=512, rows_per_cell=50).collect()
    loads = check(rows, got, 6)
    groups = collections.Counter()
    for _, text in rows:
        groups[text] += len(text.encode()) + 8
    plain = collections.Counter()
    for text, shard in longest_first([(n, t) for t, n in groups.items()], 6).items():
        plain[shard] += groups[text]
    assert max(loads.values()) <= 1.02 * max(plain.values())


def test_a_group_of_a_third_stays_whole(spark):
    rows = [(i, prose(1, 30)) for i in range(100)] + [(1000 + i, prose(i, 30)) for i in range(200)]
    loads = check(rows, shard_by_bytes(frame(spark, rows), shards=6, rows_per_cell=10).collect(), 6)
    rest = sorted(loads.values())[:-1]
    assert max(rest) - min(rest) < 0.05 * sum(rest)


def test_longest_first_against_every_shard():
    rng = random.Random(1)
    items = [(rng.randrange(1, 100), str(i)) for i in range(60)]
    loads = [0] * 5
    want = {}
    for size, name in sorted(items, key=lambda x: (-x[0], x[1])):
        shard = min(range(5), key=lambda s: (loads[s], s))
        loads[shard] += size
        want[name] = shard
    assert longest_first(items, 5) == want


def test_empty_table(spark):
    assert shard_by_bytes(empty(spark)).collect() == []
