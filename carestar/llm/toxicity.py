"""Toxicity by a weighted finite-state grammar over the words of a clause."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.llm.common import column_lists, per_batch

# Word classes that the grammar reads. Fixed values; insults also come from the labels.
WORDS = {
    "threat": "kill hurt destroy beat burn shoot stab punish töten schlagen tuer frapper matar golpear",
    "target": "you your yours u he him she her they them du dich ihr sie vous tu toi usted ustedes",
    "negation": "not no never isnt arent wasnt cannot dont nicht kein keine nie pas jamais non nunca ni",
    "report": "said says saying told called calls wrote quoted claimed sagte nannte schrieb disait "
    "appelait dijo llamaba",
    "insult": "idiot moron stupid scum trash loser worthless pathetic disgusting clown",
}
NEAR = 4
MAX_LABELLED = 20_000
MAX_LEXICON = 4096
MIN_TOXIC = 4
MIN_ODDS = math.log(20)
STEMS = (4, 5)
ENDINGS = ("ing", "s")  # of threat words, also after a doubled letter

# A word keeps an apostrophe after it and the t of a negation ("aren't", "n'" of "n'est").
_TOKEN = re.compile(r"\w+(?:['’](?:t\b)?)?|[.!?;:\n\"“”«»„]")
_BREAKS = frozenset(".!?;:\n")
_QUOTES = frozenset("\"“”«»„")


def plain(token: str) -> str:
    """The word without the apostrophe after it."""
    return token.split("'")[0].split("’")[0]


@dataclass
class Transducer:
    """States are any values; ``arcs[state, symbol]`` lists (next state, output, log weight).
    A symbol without arcs leaves the state and comes out as it is, with weight 0."""

    start: object
    arcs: dict = field(default_factory=dict)

    def step(self, state, symbol):
        return self.arcs.get((state, symbol)) or [(state, symbol, 0.0)]


def compose(first: Transducer, second: Transducer, symbols: list[str]) -> Transducer:
    """The transducer that feeds each output of ``first`` to ``second``, over reachable states."""
    made = Transducer((first.start, second.start))
    todo, seen = [made.start], {made.start}
    while todo:
        a, b = state = todo.pop()
        for symbol in symbols:
            arcs = [
                ((a2, b2), out, w1 + w2)
                for a2, middle, w1 in first.step(a, symbol)
                for b2, out, w2 in second.step(b, middle)
            ]
            made.arcs[state, symbol] = arcs
            for after, *_ in arcs:
                if after not in seen:
                    seen.add(after)
                    todo.append(after)
    return made


SYMBOLS = ["other", "insult", "threat", "target", "negation", "report", "quote"]
_HITS = ("insult", "threat")


def _window(opener: str, marked: str, weight: float, hits=_HITS) -> Transducer:
    """For NEAR words after ``opener``, hits come out with a mark and a log weight."""
    made = Transducer(0)
    for left in range(NEAR + 1):
        for symbol in SYMBOLS:
            if symbol == opener:
                made.arcs[left, symbol] = [(NEAR, symbol, 0.0)]
            elif left and symbol in hits:
                made.arcs[left, symbol] = [(left - 1, symbol + marked, weight)]
            elif left:
                made.arcs[left, symbol] = [(left - 1, symbol, 0.0)]
    return made


def negation() -> Transducer:
    """A negated insult or threat counts a tenth."""
    return _window("negation", "", math.log(0.1))


def reported() -> Transducer:
    """After a verb of speech, up to the end of the clause, hits may be another's words: they
    count three tenths, or fully on the path that takes the verb for something else at a cost."""
    made = Transducer("own")
    made.arcs["own", "report"] = [("told", "report", 0.0), ("own", "report", math.log(0.6))]
    for symbol in _HITS:
        made.arcs["told", symbol] = [("told", symbol, math.log(0.3))]
    return made


def aimed() -> Transducer:
    """Hits shortly after a target count half as much again."""
    return _window("target", "", math.log(1.5))


def threatened() -> Transducer:
    """A threat word is a hit only if a target follows soon; else it is dropped."""
    made = Transducer(0)
    for left in range(NEAR + 1):
        for symbol in SYMBOLS:
            after = max(left - 1, 0)
            if symbol == "threat":
                made.arcs[left, symbol] = [(NEAR, "other", 0.0)]
            elif left and symbol == "target":
                made.arcs[left, symbol] = [(0, "threatened", 0.0)]
            else:
                made.arcs[left, symbol] = [(after, symbol, 0.0)]
    return made


def grammar() -> Transducer:
    made = negation()
    for part in (reported(), aimed(), threatened()):
        made = compose(made, part, SYMBOLS)
    return made


def clause_score(machine: Transducer, clause: list[tuple[str, float]]) -> float:
    """The best path's sum of word weight x arc weights over its hits."""
    paths = {machine.start: 0.0}
    for symbol, weight in clause:
        after: dict = {}
        for state, score in paths.items():
            for to, out, log_weight in machine.step(state, symbol):
                gained = score
                if out == "insult":
                    gained += weight * math.exp(log_weight)
                elif out == "threatened":
                    gained += 3.0 * math.exp(log_weight)
                elif log_weight:
                    gained += min(0.0, log_weight)
                if gained > after.get(to, -math.inf):
                    after[to] = gained
        paths = after
    return max(0.0, max(paths.values()))


class Scorer:
    """Clause features of texts under a lexicon of insult words and stems with weights."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.fixed = {w: kind for kind, listed in WORDS.items() for w in listed.split()}
        self.machine = grammar()
        self.known: dict[str, tuple[str, float] | None] = {}

    def _class(self, token: str):
        word = plain(token)
        if token != word and (token[-1] == "t" and word[-1] == "n" or word == "n"):
            return "negation", 0.0
        weight = max(
            [self.lexicon.get(word, 0.0), *(self.lexicon.get(word[:n] + "*", 0.0) for n in STEMS)]
        )
        kind = self.fixed.get(word)
        if kind is None and any(
            word.endswith(e) and "threat" in map(self.fixed.get, (word[: -len(e)], word[: -len(e) - 1])) for e in ENDINGS
        ):
            kind = "threat"
        if kind == "insult" or weight and kind is None:
            return "insult", max(weight, 1.0)
        return (kind, 0.0) if kind else None

    def features(self, text: str | None) -> list[float]:
        """Best clause, sum over clauses, matched clauses (as logarithms) and hits per 100 words."""
        known, scores, clause, pending, words = self.known, [], [], False, 0
        if len(known) > 1 << 16:
            known.clear()
        for token in _TOKEN.findall((text or "").lower()):
            if token in _BREAKS:
                if pending:
                    scores.append(clause_score(self.machine, clause))
                clause, pending = [], False
                continue
            words += 1
            try:
                found = known[token]
            except KeyError:
                kind = ("quote", 0.0) if token in _QUOTES else self._class(token)
                found = known[token] = kind
            if found is None:
                if clause:
                    clause.append(("other", 0.0))
                continue
            clause.append(found)
            pending = pending or found[0] in _HITS
        if pending:
            scores.append(clause_score(self.machine, clause))
        matched = [s for s in scores if s > 0]
        total = sum(matched)
        return [
            math.log1p(max(matched, default=0.0)),
            math.log1p(total),
            math.log1p(len(matched)),
            math.log1p(100 * total / max(words, 1)),
        ]


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 0.01, rounds: int = 50) -> np.ndarray:
    """Weights with the intercept last, by Newton steps with a ridge. None of a weight may be
    negative: a matched clause never lowers a score."""
    free = list(range(x.shape[1]))
    while True:
        design = np.column_stack([x[:, free], np.ones(len(x))])
        w = np.zeros(design.shape[1])
        ridge = l2 * np.eye(len(w))
        ridge[-1, -1] = 1e-6
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            curve = design.T @ (design * np.maximum(p * (1 - p), 1e-6)[:, None]) + ridge
            step = np.linalg.solve(curve, design.T @ (y - p) - ridge @ w)
            w += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break
        if (w[:-1] >= 0).all():
            full = np.zeros(x.shape[1] + 1)
            full[[*free, x.shape[1]]] = w
            return full
        free = [f for f, weight in zip(free, w[:-1], strict=True) if weight >= 0]


# Used where there are no labels of both kinds.
DEFAULT_WEIGHTS = np.array([2.0, 1.0, 0.0, 0.0, -4.0])


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    weights: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.asarray(x, float).reshape(-1, 4) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _tokens(text: str) -> set[str]:
    words = set(re.findall(r"[^\W\d_]+", text.lower()))
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = MAX_LABELLED,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> ToxicityModel:
    """Learns insult words, and the weights of clause features, from labelled documents.

    At most ``max_labelled`` labels are used, those whose ids hash lowest; an id with several
    takes the highest, null labels are left out. Three quarters of them give the lexicon: words,
    and stems of four and five letters, that at least four toxic documents hold and that are
    twenty times likelier there, the 4,096 likeliest at most. The last quarter, which the lexicon
    has not seen, gives the weights. Which rows may be learnt from is the caller's choice of
    ``labels``. Without both labels, fixed words and fixed weights stand in.
    """
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(max_labelled)
        .withColumn("part", F.pmod(F.xxhash64("label_id", F.lit("part")), F.lit(4)).cast("int"))
    )
    taken = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    # At most max_labelled ids are broadcast.
    taken = taken.join(F.broadcast(chosen), taken["id"] == chosen["label_id"])
    taken = taken.select("id", "text", "toxic", "part")

    def start_counts():
        def work(batch):
            toxic_in, clean_in, size = Counter(), Counter(), Counter()
            for text, toxic in zip(*column_lists(batch, "text", "toxic"), strict=True):
                (toxic_in if toxic else clean_in).update(_tokens(text or ""))
                size[toxic] += 1
            words = list(toxic_in | clean_in)
            return {
                "word": ["", *words],
                "n_toxic": [size[1], *(toxic_in[w] for w in words)],
                "n_clean": [size[0], *(clean_in[w] for w in words)],
            }

        return work

    schema = "word string, n_toxic long, n_clean long"
    summed = (
        per_batch(taken.where("part > 0"), start_counts, schema, rows=10_000)
        .groupBy("word")
        .agg(F.sum("n_toxic").alias("t"), F.sum("n_clean").alias("c"))
        .where((F.col("t") >= MIN_TOXIC) | (F.col("word") == ""))
        .orderBy((F.col("word") == "").desc(), (F.col("t") / (F.col("c") + 0.5)).desc(), "word")
        .limit(MAX_LEXICON + 1)
        .collect()
    )
    lexicon = {}
    if summed:
        n_toxic, n_clean = summed[0]["t"], summed[0]["c"]
        for r in summed[1:]:
            odds = math.log((r["t"] + 0.5) / (n_toxic + 1)) - math.log((r["c"] + 0.5) / (n_clean + 1))
            if odds >= MIN_ODDS:
                lexicon[r["word"]] = min(odds / 2, 4.0)

    def start_features():
        scorer = Scorer(lexicon)

        def work(batch):
            ids, texts, toxic = column_lists(batch, "id", "text", "toxic")
            return {"id": ids, "toxic": toxic, "x": [scorer.features(t) for t in texts]}

        return work

    held = per_batch(taken.where("part = 0"), start_features, "id long, toxic int, x array<double>")
    rows = held.orderBy(F.xxhash64("id"), "id", "x").limit(max_labelled).collect()
    y = np.array([r["toxic"] for r in rows], float)
    if not 0 < y.sum() < len(y):
        return ToxicityModel(lexicon, DEFAULT_WEIGHTS)
    return ToxicityModel(lexicon, fit_logistic(np.array([r["x"] for r in rows]), y))


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row for each row of ``docs``: id and score, from 0 to 1, of its whole text.

    Only the text is read. Words become classes; in each clause that holds an insult or a threat
    the composed transducer finds the best path, where negation and reported speech weaken a hit
    and a target strengthens it. One pass, no shuffle.

    A null text counts as empty and gets the lowest score. A null id is kept. Repeated rows each
    give a row. An empty table gives no rows. Other columns are not read.
    """

    def start():
        scorer = Scorer(model.lexicon)

        def work(batch):
            ids, texts = column_lists(batch, "id", "text")
            return {"id": ids, "score": model.scores([scorer.features(t) for t in texts])}

        return work

    taken = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return per_batch(taken, start, "id long, score double").withColumnRenamed("id", id_column)
