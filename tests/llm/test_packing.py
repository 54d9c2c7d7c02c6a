import collections
import itertools
import random
import struct
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from carestar.llm.packing import combinations, length_class, nnls, pack, plan_windows
from tests.llm.cases import edge_rows, empty, frame, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, got, window):
    library = Tokenizer.from_file(PATH)
    want = collections.Counter()
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        for at in range(0, len(ids), window):
            piece = ids[at : at + window]
            want[doc, at, len(piece), zlib.crc32(struct.pack(f"<{len(piece)}I", *piece)), len(ids)] += 1
    assert want == collections.Counter(
        (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got
    )
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length, r.used, r.n_pieces))
    for pieces in sequences.values():
        at = 0
        for offset, length, used, n in sorted(pieces):
            assert offset == at and n == len(pieces)
            at += length
        assert at == used <= window
    return len(sequences)


def test_every_id_is_packed_once_and_windows_hold(spark):
    rows = edge_rows() + [(100 + i, prose(i, random.Random(i).randrange(1, 300))) for i in range(300)]
    got = pack(frame(spark, rows), PATH, window=512, rows_per_cell=20).collect()
    sequences = check(rows, got, 512)
    assert sum(r.length for r in got) / (512 * sequences) > 0.93


def test_one_length_for_all(spark):
    rows = [(i, prose(5, 60)) for i in range(200)]
    got = pack(frame(spark, rows), PATH, window=512, rows_per_cell=7).collect()
    check(rows, got, 512)


def test_empty_table(spark):
    assert pack(empty(spark), PATH).collect() == []


def test_least_squares_against_a_grid():
    columns = [(0, 1), (1, 1, 2), (2,), (0, 0)]
    a = np.zeros((3, 4))
    for j, c in enumerate(columns):
        for k in c:
            a[k, j] += 1
    b = np.array([3.0, 5.0, 2.0])
    error = lambda x: ((a @ x - b) ** 2).sum()
    found = nnls(columns, b)
    assert (found >= 0).all()
    grid = np.arange(0, 6, 0.5)
    assert error(found) <= min(error(np.array(x)) for x in itertools.product(grid, repeat=4)) + 1e-6


def test_plans_use_each_piece_once():
    rng = random.Random(2)
    for scale in (1, 30, 10**9):
        histogram = collections.Counter()
        for _ in range(500):
            histogram[length_class(rng.randrange(1, 4097))] += rng.randrange(1, 1 + scale)
        used = collections.Counter()
        for pattern, times in plan_windows(dict(histogram), 4096):
            assert sum(k * m for k, m in pattern.items()) <= 4096
            for k, m in pattern.items():
                used[k] += m * times
        assert used == histogram


def test_combinations_fill_the_window():
    found = combinations([16, 32, 48, 64, 50], 64, 3)
    assert set(found) == {(64,), (50,), (48, 16), (32, 32), (32, 16, 16), (50,)}
    assert len(found) == len(set(found))
