import collections
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from carestar.llm import lm
from carestar.llm.gru import NAMES, Gru, Trainer, first_weights, inputs_of, lanes_of, make_lexicon, score_documents, sums_of_runs
from tests.llm.cases import edge_rows, empty, frame, prose


@pytest.fixture
def model():
    rng = np.random.default_rng(0)
    lexicon = make_lexicon(np.array([9.0, 7, 5, 3, 2, 1, 1, 1]), 4.0, 3)
    weights = {k: v + 0.3 * rng.standard_normal(v.shape) for k, v in first_weights(lexicon, 4).items()}
    return Gru(lexicon, weights)


def documents():
    rng = np.random.default_rng(1)
    return [rng.integers(0, 9, n) for n in (7, 5, 9, 3, 1, 40)]


def test_gradients_against_differences(model):
    docs = documents()
    targets, starts, _ = lanes_of(docs, 3)
    state = np.zeros((targets.shape[1], 4))
    loss, grads, _ = model.gradients(inputs_of(targets, starts, model.lexicon), starts, targets, state)
    n = sum(map(len, docs))
    assert loss * n == pytest.approx(-score_documents(model, docs).sum(), rel=1e-4)
    rng = np.random.default_rng(2)
    for name in NAMES:
        for _ in range(5):
            at = tuple(rng.integers(0, d) for d in model.w[name].shape)
            ends = []
            for step in (1e-4, -1e-4):
                model.w[name][at] += step
                ends.append(-score_documents(model, docs).sum() / n)
                model.w[name][at] -= step
            assert grads[name][at] == pytest.approx((ends[0] - ends[1]) / 2e-4, abs=2e-5)


def test_next_token_probabilities_sum_to_one(model):
    prefix = [3, 1, 8, 0]
    with_each = [score_documents(model, [np.array([*prefix, t])])[0] for t in range(9)]
    total = sum(math.exp(s - score_documents(model, [np.array(prefix)])[0]) for s in with_each)
    assert total == pytest.approx(1, abs=1e-5)


def test_a_document_scores_alone_as_among_others(model):
    docs = documents()
    for window, lanes in ((2, 1), (64, 2), (3, 6)):
        together = score_documents(model, docs, lanes, window)
        alone = [score_documents(model, [d])[0] for d in docs]
        assert together == pytest.approx(alone, rel=1e-5)


def test_training_learns_an_order():
    lexicon = make_lexicon(np.array([1.0, 1, 1, 1]), 0.5, 2)
    model = Gru(lexicon, first_weights(lexicon, 8))
    docs = [np.tile([0, 2, 1, 3], 30) for _ in range(20)]
    before = score_documents(model, docs).sum()
    trainer = Trainer(model)
    for _ in range(20):
        trainer.learn(docs)
    assert score_documents(model, docs).sum() > 0.2 * before


def words(text):
    listed, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\v\f\r":
            listed += [word] if word else []
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    return [*listed, ""]


@pytest.mark.parametrize("known", [1 << 18, 4])
def test_rows_against_brute_force(spark, monkeypatch, known):
    """The same rows result however few words a task holds."""
    monkeypatch.setattr(lm, "KNOWN", known)
    rows = [r for r in edge_rows() if not r[1] or len(r[1]) < 5000]
    rows += [(50 + i, prose(i, 30).upper() + " É") for i in range(40)]
    learn = F.pmod("doc_id", F.lit(3)) != 0
    got = lm.score_texts(frame(spark, rows), learn, train_share=1.0, least_updates=5).collect()
    counts = collections.Counter()
    for i, t in rows:
        if i is None or i % 3:
            counts.update(words(t))
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t in rows:
        listed = words(t)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in listed)
        want.append((i, len(listed), sum(counts[w] > 0 for w in listed), n, round(base, 6)))
    found = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    assert sorted(map(repr, found)) == sorted(map(repr, want))
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_empty_table(spark):
    assert lm.score_texts(empty(spark), F.lit(True), least_updates=1).collect() == []


def test_most_frequent_words(spark):
    counts = spark.createDataFrame([(f"w{i}".encode(), 1 + i % 50) for i in range(1000)], "word binary, c long")
    for most in (5, 30, 333, 5000):
        top = lm.most_frequent(counts, most)
        assert len(top) <= most and (most < 5000 or len(top) == 1000)
        assert [r["c"] for r in top] == sorted((r["c"] for r in top), reverse=True)


def test_held_out_texts_score_above_the_unigram_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    rows = lm.score_texts(docs, ~held).join(docs.where(held).select("doc_id"), "doc_id").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) * 0.97


def test_the_network_learns_from_every_row_that_is_not_held_out(spark, monkeypatch):
    rows = [(i, prose(i % 40, 12)) for i in range(120)] + [(200, None), (201, "")]
    given, train = [], lm.train

    def watched(texts, *more):
        given.extend(r.text for r in texts.collect())
        return train(texts, *more)

    monkeypatch.setattr(lm, "train", watched)
    lm.score_texts(frame(spark, rows), F.pmod("doc_id", F.lit(5)) != 1, least_updates=1).collect()
    assert sorted(map(str, given)) == sorted(str(t) for i, t in rows if i % 5 != 1)


def rare_words(n, at=0):
    return [f"w{at + i}" for i in range(n)]


def vocabulary(listed):
    counts = collections.Counter(listed)
    masses = np.zeros(lm.BUCKETS)
    for w, c in counts.items():
        masses[lm.Vocabulary.buckets([w])] += c + 0.5
    top = counts.most_common(lm.KNOWN)
    return lm.Vocabulary([w for w, _ in top], [c for _, c in top], len(listed), len(counts), list(masses))


def test_words_beyond_the_first_thousand_are_tokens_of_their_own():
    listed = [w.encode() for w in rare_words(20_000) + rare_words(9_000) + rare_words(3_000)]
    known = vocabulary(listed)
    met = [f"w{i}".encode() for i in range(9_000)]
    assert len(set(known.tokens(met, known.codes(met))[0].tolist())) == 9_000
    others = [f"w{i}".encode() for i in range(19_000, 24_000)]
    others = [w for w in others if not 0 <= known.code.get(w, -1) < known.core]
    assert len(set(known.tokens(others, known.codes(others))[0].tolist())) > 900


def test_probabilities_of_all_words_and_one_unknown_a_bucket_sum_to_one(monkeypatch):
    monkeypatch.setattr(lm, "CORE", 50)
    monkeypatch.setattr(lm, "BUCKETS", 8)
    monkeypatch.setattr(lm, "KNOWN", 90)
    listed = [w.encode() for w in rare_words(100) + rare_words(60) + rare_words(20)]
    counts, known = collections.Counter(listed), vocabulary(listed)
    model = Gru(known.lexicon, first_weights(known.lexicon, 4))
    total = 0.0
    for w in counts:
        codes = known.codes([w])
        numbers, within = known.tokens([w], codes)
        rare = math.log10(counts[w] + 0.5) if codes[0] < 0 else 0
        total += 10 ** (within + rare) * math.exp(score_documents(model, [numbers])[0])
    unmet = {int(b): w for w in (f"x{i}".encode() for i in range(200)) for b in lm.Vocabulary.buckets([w])}
    for w in unmet.values():
        numbers, within = known.tokens([w], known.codes([w]))
        total += 0.5 * 10**within * math.exp(score_documents(model, [numbers])[0])
    assert len(unmet) == 8 and total == pytest.approx(1, abs=1e-5)


def test_words_outside_the_core_are_seen_and_predicted(spark, monkeypatch):
    """Each word tells the next, and all are rarer than the words that the model names."""
    monkeypatch.setattr(lm, "CORE", 1)
    rng = np.random.default_rng(3)
    ordered = [" ".join(f"v{(a + k) % 40}" for k in range(30)) for a in rng.integers(0, 40, 200)]
    got = lm.score_texts(frame(spark, list(enumerate(ordered))), F.lit(True)).collect()
    assert sum(r.score for r in got) > 0.7 * sum(r.base_score for r in got)


def test_words_of_many_texts_at_once():
    rng = np.random.default_rng(5)
    texts = [t for _, t in edge_rows()] + [" A b\t\n", "x\x0b\x0cY\x1cz\x85 É q ", "\n\n"]
    texts += ["".join(rng.choice(list("aB \t\n\v\f\r\x1c\xa0é"), rng.integers(0, 30))) for _ in range(500)]
    found, sizes = lm.words_in(pa.array(texts, pa.string()).slice(2))
    want = [words(t) for t in texts[2:]]
    assert sizes.tolist() == list(map(len, want))
    assert [w.decode() for w in found.to_pylist()] == [w for listed in want for w in listed]


def test_a_long_document_does_not_make_small_windows(model, monkeypatch):
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 9, n) for n in [30_000] + [40] * 3_000]
    sizes, score = [], Gru.log_likelihood
    monkeypatch.setattr(Gru, "log_likelihood", lambda self, s, t: sizes.append(t.size) or score(self, s, t))
    found = score_documents(model, docs)
    assert min(sizes[:-1]) >= 8_000
    monkeypatch.undo()
    assert found[:3] == pytest.approx([score_documents(model, [d])[0] for d in docs[:3]], rel=1e-5)


def test_sums_of_runs_of_any_length():
    rng = np.random.default_rng(3)
    for sizes in ([1], [1, 2, 3], [40, 1, 8, 9, 2, 1, 7], [100]):
        rows = rng.standard_normal((sum(sizes), 5))
        first = np.cumsum([0, *sizes[:-1]])
        assert sums_of_runs(rows, first) == pytest.approx(np.add.reduceat(rows, first, axis=0))


@pytest.mark.parametrize("spread", [0, 12])
def test_biases_left_out_of_the_logits_change_nothing(model, monkeypatch, spread):
    docs = documents()
    targets, starts, _ = lanes_of(docs, 3)
    for k in ("bo", "bc"):
        model.w[k] += np.linspace(-spread, spread, len(model.w[k]))
    inputs, state = inputs_of(targets, starts, model.lexicon), np.zeros((targets.shape[1], 4))
    found = []
    for bound in (Gru.MILD, 0.0):
        monkeypatch.setattr(Gru, "MILD", bound)
        model.see_weights()
        assert model.mild == (bound > 0)
        loss, grads, _ = model.gradients(inputs, starts, targets, state)
        found.append((loss, score_documents(model, docs), [grads[k].copy() for k in NAMES]))
    (loss, scores, grads), (same_loss, same_scores, same_grads) = found
    assert loss == pytest.approx(same_loss, rel=1e-5) and scores == pytest.approx(same_scores, rel=1e-5)
    for ours, theirs in zip(grads, same_grads, strict=True):
        assert ours == pytest.approx(theirs, rel=1e-4, abs=1e-6)


def test_biases_that_no_exponential_can_be_divided_by_are_not_mild(model):
    model.w["bo"] -= 40.0
    model.see_weights()
    assert not model.mild


def test_large_logits_do_not_overflow(model):
    docs = documents()
    before = score_documents(model, docs)
    model.w["bo"] += 200  # the same of all tokens, so nothing changes
    model.w["bc"] += 200
    model.see_weights()
    assert not model.mild
    assert score_documents(model, docs) == pytest.approx(before, rel=1e-5)
