import itertools
import math

import numpy as np
import pytest

from carestar.llm.queries import op6_toxicity
from carestar.llm.toxicity import (
    SYMBOLS,
    Scorer,
    Transducer,
    aimed,
    clause_score,
    compose,
    fit_logistic,
    fit_toxicity,
    grammar,
    negation,
    score_toxicity,
)
from tests.llm.cases import edge_rows, empty, frame, prose


def best(text):
    return Scorer({}).features(text)[0]


def test_clauses_not_words_are_scored():
    plain = best("the clown walked in")
    assert plain > best("that is not a clown") > 0
    assert plain > best("he said it was a clown somewhere") > 0
    assert best("you clown") > plain
    assert best("they will kill you") > best("kill the lights") == 0
    assert best("a clown. not here") == best("a clown")
    assert best("") == best(None) == best("you said never") == 0


@pytest.mark.parametrize("text", ["you aren't a clown", "you aren’t a clown", "she isn't a clown", "tu n'es pas un clown"])
def test_contracted_negations_weaken_a_hit(text):
    assert 0 < best(text) < best("you are a clown") / 2


def test_apostrophes_hide_no_word_and_threats_take_endings():
    assert best("l'idiot arrive") == best("le idiot arrive") > 0
    assert best("the clown's hat") == best("the clown hat") > 0
    assert best("they are killing you") == best("they will kill you")
    assert best("stabbing them") > 0 and best("he shoots you") > 0
    assert best("killing the lights") == 0


def outputs(machine, symbols):
    """Every path of a transducer over symbols: outputs and weight."""
    paths = [(machine.start, (), 0.0)]
    for s in symbols:
        paths = [(to, (*out, o), w + u) for at, out, w in paths for to, o, u in machine.step(at, s)]
    return sorted((out, round(w, 9)) for _, out, w in paths)


def test_composition_is_one_after_the_other():
    first, second = negation(), aimed()
    both = compose(first, second, SYMBOLS)
    for symbols in itertools.product(["other", "insult", "target", "negation"], repeat=4):
        want = []
        for middle, w in outputs(first, symbols):
            want += [(out, round(w + u, 9)) for out, u in outputs(second, middle)]
        assert outputs(both, symbols) == sorted(want)


def test_the_best_path_against_all_paths():
    machine = grammar()
    weights = {"insult": 2.0}
    for symbols in itertools.product(["insult", "target", "negation", "report"], repeat=4):
        found = clause_score(machine, [(s, weights.get(s, 0.0)) for s in symbols])
        totals = []

        def walk(at, rest, score, totals=totals):
            if not rest:
                totals.append(score)
                return
            for to, out, w in machine.step(at, rest[0]):
                gain = weights["insult"] * math.exp(w) if out == "insult" else 3 * math.exp(w) if out == "threatened" else min(0.0, w)
                walk(to, rest[1:], score + gain)

        walk(machine.start, symbols, 0.0)
        assert found == pytest.approx(max(0.0, *totals))


def test_a_transducer_passes_what_it_does_not_name():
    assert Transducer(0).step(0, "other") == [(0, "other", 0.0)]


def test_weights_are_never_negative():
    rng = np.random.default_rng(0)
    x = rng.random((400, 4))
    y = (x[:, 0] - 0.8 * x[:, 1] + 0.1 * rng.standard_normal(400) > 0.1).astype(float)
    weights = fit_logistic(x, y)
    assert (weights[:-1] >= 0).all() and weights[0] > 1


def test_learnt_words_and_stems(spark):
    rows = [(i, prose(i, 40) + (f" grumblix{i % 7} quarzo " if i % 4 == 0 else "")) for i in range(200)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(0, 200)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = fit_toxicity(docs, labels)
    assert {"quarzo", "grum*", "grumb*"} <= set(model.lexicon)
    new = frame(spark, [(1, "a grumblix99 here"), (2, prose(777, 40)), (3, None), (4, "")])
    scores = {r.doc_id: r.score for r in score_toxicity(new, model).collect()}
    assert scores[1] > 0.5 > scores[2] >= scores[3] == scores[4]


def test_edge_rows_without_labels(spark):
    docs, none = frame(spark), spark.createDataFrame([], "doc_id long, toxic int")
    model = fit_toxicity(docs, none)
    got = score_toxicity(docs, model).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r.score <= 1 for r in got)
    assert score_toxicity(empty(spark), fit_toxicity(empty(spark), none)).collect() == []


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = op6_toxicity(spark, folder).where("held_out").join(labels, "doc_id").collect()
    hits = sum(r.predicted and r.toxic for r in rows)
    assert hits / sum(r.predicted for r in rows) > 0.95
    assert hits / sum(r.toxic for r in rows) > 0.8


def test_ids_decide_who_is_held_out(spark):
    import zlib

    rows = op6_toxicity(spark, "/root/testdata/sf0.001").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)
