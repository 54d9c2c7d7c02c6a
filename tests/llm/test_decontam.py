import random
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from carestar.llm import decontam
from carestar.llm.decontam import (
    GAP,
    MATCH,
    MISMATCH,
    Text,
    Words,
    find_leaks,
    item_pairs,
    item_words,
    needed_score,
    rare_seeds,
    smith_waterman,
    without_leaks,
)
from tests.llm.cases import edge_rows, empty, frame, prose

ITEMS = [(i, prose(500 + i, 20 + i)) for i in range(20)]


def brute_alignment(text, item):
    table = [[0] * (len(item) + 1) for _ in range(len(text) + 1)]
    for i, x in enumerate(text, 1):
        for j, y in enumerate(item, 1):
            table[i][j] = max(
                0, table[i - 1][j - 1] + (MATCH if x == y else MISMATCH),
                table[i - 1][j] + GAP, table[i][j - 1] + GAP,
            )
    return max(map(max, table))


def test_alignment_against_the_full_table():
    rng = random.Random(1)
    for _ in range(300):
        text = np.array([rng.randrange(6) for _ in range(rng.randrange(0, 30))], np.int64)
        item = np.array([rng.randrange(6) for _ in range(rng.randrange(1, 12))], np.int64)
        assert smith_waterman(text, item)[0] == brute_alignment(text, item)


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")


def rewritten(text, every):
    words = text.split()
    for k in range(every // 2, len(words), every):
        words[k] = "changed"
    return " ".join(words)


def leaking_rows():
    rows = edge_rows()
    for i, text in ITEMS:
        rows.append((100 + i, f"{prose(i, 60)} {text} {prose(i + 50, 40)}"))
        rows.append((200 + i, f"{prose(i, 60)} {rewritten(text, 8).upper()}. {prose(i + 50, 40)}"))
        dropped = " ".join(w for k, w in enumerate(text.split()) if k % 9 != 4)
        rows.append((300 + i, f"{prose(i, 60)}, {dropped}! {prose(i + 50, 40)}"))
        rows.append((400 + i, prose(700 + i, 300)))
    return rows


def test_copies_and_edited_copies_are_found_and_no_others(spark):
    got = find_leaks(frame(spark, leaking_rows()), benchmark(spark)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {
        (base + i, i) for base in (100, 200, 300) for i, _ in ITEMS
    }
    assert all(r.score == 1 for r in got if r.doc_id < 200)


def test_scores_are_those_of_aligning_every_document_with_every_item(spark):
    rows = leaking_rows()[11:51]
    got = {(r.doc_id, r.item_id): r.aligned for r in find_leaks(frame(spark, rows), benchmark(spark)).collect()}
    for doc, text in rows:
        for item, item_text in ITEMS:
            clean = lambda t: ["".join(c for c in w.lower() if c.isalnum()) for w in t.split()]
            best = brute_alignment(clean(text), clean(item_text))
            need = needed_score(len(item_text.split()), 0.5)
            assert got.get((doc, item)) == (best if best >= need else None)


def test_what_counts_as_common_changes_no_result(spark):
    docs = frame(spark, leaking_rows())
    found = [
        sorted(map(tuple, find_leaks(docs, benchmark(spark), common_share=share).collect())) for share in (0, 0.01, 1)
    ]
    assert found[0] == found[1] == found[2] and len(found[0]) == 60


def test_a_passage_that_most_documents_hold_is_still_found(spark):
    rows = [(i, f"{prose(i, 30)} {ITEMS[0][1]}") for i in range(50)] + [(99, prose(99, 80))]
    got = find_leaks(frame(spark, rows), benchmark(spark)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(i, 0) for i in range(50)}


def test_odd_items_and_tables(spark):
    docs = frame(spark, [(1, "alpha beta gamma delta"), (1, "alpha beta gamma delta"), (2, None)])
    items = [(1, None), (2, ""), (3, "alpha"), (4, "Alpha, beta gamma."), (4, "Alpha, beta gamma."), (None, "x y z w")]
    got = find_leaks(docs, benchmark(spark, items)).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(1, 4), (1, 4)]
    assert find_leaks(empty(spark), benchmark(spark)).collect() == []
    assert find_leaks(docs, benchmark(spark, [])).collect() == []


def test_seeds_are_the_rarest_pairs_and_as_many_as_must_be_found(spark):
    items = spark.createDataFrame([(prose(3, 50), b"a"), (prose(4, 3), b"b")], "text string, ikey binary")
    pairs = item_pairs(item_words(items), 0.5).cache()
    # A pair is held by as many documents as its place says: the last places are common, but
    # for the very last one, which has one pair where the others have two.
    counts = pairs.groupBy("code").agg(F.max("place").alias("rows"))
    kept = rare_seeds(pairs, counts, 0).where("ikey = X'61'").collect()
    need = needed_score(50, 0.5)
    left_out = (need - 3) // 2
    assert len({r.code for r in kept if r.weight == 2}) == 49 - left_out
    common = {r.code for r in pairs.where(f"ikey = X'61' and place between {48 - left_out} and 47").collect()}
    assert not common & {r.code for r in kept}
    assert {r.least for r in kept} == {need - 2 - 2 * left_out} and kept[0].least >= 1
    everything = rare_seeds(pairs, counts, 1000).where("ikey = X'61'")
    assert {r.least for r in everything.collect()} == {need - 2} and everything.count() == 49 + 48


def plain_words(text):
    return [w for t in text.lower().split() if (w := "".join(c for c in t if c.isalnum()))]


def test_words_are_letters_and_digits_between_spaces(monkeypatch):
    texts = [prose(1, 300), "", " \n\t ", "Don't—stop_it, É ÉTÉ été, ß x2\x1cy \u00a0z", "...", "a" * 400, "Ünï\U0001d400 İx"]
    for piece in (1 << 18, 40):
        monkeypatch.setattr(decontam, "PIECE", piece)
        rows, codes = map(np.concatenate, zip(*Words().blocks(texts), strict=True))
        words = [(r, w) for r, t in enumerate(texts) for w in plain_words(t)]
        assert rows.tolist() == [r for r, _ in words]
        # Equal words and no others have equal hashes.
        of = {w: c for (_, w), c in zip(words, codes.tolist(), strict=True)}
        assert codes.tolist() == [of[w] for _, w in words] and len(set(of.values())) == len(of)
    assert len(Words().row("日本語。テキスト abc漢")) == 9


def test_edited_copies_without_spaces_between_words(spark):
    rng = random.Random(2)
    item = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(60))
    copy = item[:20] + "一" + item[21:40] + item[42:]
    other = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(300))
    docs = frame(spark, [(1, item), (2, other[:99] + copy + other[99:]), (3, other)])
    got = find_leaks(docs, benchmark(spark, [(7, item)])).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 7), (2, 7)]


def test_a_very_long_text_against_many_items_needs_little_memory():
    rng = np.random.default_rng(5)
    weight = 1 / np.arange(1, 20_001)
    draw = lambda n: rng.choice(20_000, n, p=weight / weight.sum()).astype(np.uint64)
    text, items = draw(150_000), [draw(40) for _ in range(300)]
    text[70_000:70_040] = items[17]
    tracemalloc.start()
    held = Text(text)
    hits = [(i, *hit) for i, item in enumerate(items) if (hit := held.align(item, 0.5))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (17, 80, 70_040) in hits and peak < 100e6
    for i in range(0, 300, 30):  # the windows lose nothing
        score = smith_waterman(text, items[i])
        assert (score[0] >= needed_score(40, 0.5)) == any(h[0] == i and h[1:] == score for h in hits)


def test_rows_without_leaks_keep_all_their_columns(spark):
    names = ["row", "k1", "ikey", "a.b", "__h", "none", "l1"]
    docs = frame(spark, leaking_rows()).select("*", *(F.lit(n).alias(n) for n in names))
    got = without_leaks(docs, benchmark(spark))
    assert got.columns == docs.columns
    rows = got.collect()
    wanted = [r for r in docs.collect() if r.doc_id is None or r.doc_id < 100 or r.doc_id >= 400]
    assert sorted(map(repr, rows)) == sorted(map(repr, wanted))
    assert without_leaks(empty(spark), benchmark(spark)).collect() == []
    assert without_leaks(docs, benchmark(spark, [])).count() == docs.count()


def edited(rng, words, rate, kinds):
    out = []
    for w in words:
        kind = rng.choice(kinds) if rng.random() < rate else "keep"
        out += [] if kind == "drop" else [w] if kind == "keep" else [f"new{rng.randrange(99)}"]
        out += [w] if kind == "add" else []
    return out


def test_every_copy_that_scores_enough_is_found_however_edited(spark):
    """Edits of every word, every second and so on, and random ones, against aligning all pairs."""
    rng = random.Random(4)
    items = [*ITEMS, (90, " ".join(prose(9, 8).split() * 3)), (91, prose(8, 5))]
    passed, missed_by_runs, docs, best = 0, 0, [], {}
    for n in range(600):
        words = items_words = prose(500 + n % 20, 20 + n % 20).split()
        if n % 3 == 0:
            every, at = 2 + n % 5, rng.randrange(6)
            copy = ["new" if k % every == at % every else w for k, w in enumerate(words)]
        elif n % 3 == 1:
            copy = edited(rng, words, rng.choice((0.2, 0.25, 0.3)), ("change",))
        else:
            copy = edited(rng, words, rng.choice((0.3, 0.6, 1.0)), ("add", "drop", "change", "add"))
        if n % 50 == 2:
            copy = [x for w in words for x in (w, "and")]
        lead = prose(n, rng.randrange(40)).split()
        text = [*lead, *copy, *prose(n + 1, 20).split()]
        docs.append((n, " ".join(text)))
        best[n] = brute_alignment(text, items_words)
        if best[n] >= needed_score(len(words), 0.5):
            passed += 1
            runs = "".join("1" if w in words else "0" for w in copy).split("0")
            missed_by_runs += max(map(len, runs)) < 6
        else:
            best[n] = None
    for share in (0, 1e-3):
        found = find_leaks(frame(spark, docs), benchmark(spark, items), common_share=share).collect()
        got = {(r.doc_id, r.item_id): r.aligned for r in found}
        assert {n: got.get((n, n % 20)) for n in best} == best
    assert passed > 200 and missed_by_runs > 50
