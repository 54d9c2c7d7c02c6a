"""A gated recurrent language model in numpy, with a class-factored softmax."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np


@dataclass
class Lexicon:
    """Core tokens by falling frequency; class c has those from ``edges[c]`` to ``edges[c + 1]``.
    All other tokens are one more token, ``rest``, in a class of its own; ``start`` is read
    before a document's first token."""

    edges: np.ndarray
    class_of: np.ndarray
    log_class: np.ndarray
    log_word: np.ndarray

    @property
    def rest(self) -> int:
        return len(self.class_of) - 1

    @property
    def start(self) -> int:
        return len(self.class_of)


def make_lexicon(mass: np.ndarray, rest_mass: float, classes: int) -> Lexicon:
    """Classes over core tokens of falling ``mass``, of about equal sums of its root: a class of
    mass p and s tokens then costs about the same p * s as any other."""
    n = len(mass)
    share = np.cumsum(np.sqrt(mass)) / np.sqrt(mass).sum() if n else np.zeros(0)
    number = np.minimum((share * classes * (1 - 1e-9)).astype(int), classes - 1)
    first = np.flatnonzero(np.diff(number, prepend=-1)) if n else np.zeros(0, int)
    edges = np.append(first, n)
    class_of = np.append(np.repeat(np.arange(len(first)), np.diff(edges)), len(first))
    sums = np.append(np.add.reduceat(mass, first) if n else np.zeros(0), rest_mass)
    log_word = np.log(mass) - np.log(sums)[class_of[:-1]]
    return Lexicon(edges, class_of, np.log(sums / sums.sum()), log_word)


# Tokens of a document that a lane learns from in a row.
PART = 512
# Rows of a run from which on its sum is a product of its own.
LONG_RUN = 8
NAMES = ("table", "u", "wc", "bc", "wo", "bo")


def first_weights(lexicon: Lexicon, hidden: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Small random weights; the output biases make the untrained model the unigram model."""
    rng = np.random.default_rng(seed)
    small = lambda *shape: (0.1 * rng.standard_normal(shape)).astype(np.float32)
    table = small(lexicon.start + 1, 3 * hidden)
    return {
        "table": table,
        "u": small(hidden, 3 * hidden),
        "wc": small(hidden, len(lexicon.log_class)) * 0.1,
        "bc": lexicon.log_class.astype(np.float32),
        "wo": small(lexicon.rest, hidden) * 0.1,
        "bo": lexicon.log_word.astype(np.float32),
    }


def lanes_of(docs: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
    """Documents laid one after another into lanes of near equal length.

    Returns targets (steps x lanes, -1: none), whether a document starts at a place, and the
    documents of each lane. There are at most ``most`` lanes, and no more than the longest
    document fills a lane for."""
    sizes = [len(d) for d in docs]
    count = max(1, min(most, -(-sum(sizes) // max(sizes)), len(docs)))
    heap = [(0, lane) for lane in range(count)]
    members: list[list[int]] = [[] for _ in range(count)]
    for i in sorted(range(len(docs)), key=lambda i: -sizes[i]):
        load, lane = heapq.heappop(heap)
        members[lane].append(i)
        heapq.heappush(heap, (load + sizes[i], lane))
    steps = max(load for load, _ in heap)
    targets = np.full((steps, count), -1, np.int32)
    starts = np.zeros((steps, count), bool)
    for lane, listed in enumerate(members):
        at = 0
        for i in listed:
            targets[at : at + sizes[i], lane] = docs[i]
            starts[at, lane] = True
            at += sizes[i]
    return targets, starts, members


def inputs_of(targets: np.ndarray, starts: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    before = np.vstack([np.full((1, targets.shape[1]), lexicon.start, targets.dtype), targets[:-1]])
    return np.where(starts | (before < 0), lexicon.start, before)


def _gate(x: np.ndarray) -> np.ndarray:
    """The logistic function, in place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def sums_of_runs(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of each run of ``rows``; runs begin at the places ``first``. Short runs are summed
    together, one row of each at a time."""
    sizes = np.diff(first, append=len(rows))
    out, ones = rows.take(first, axis=0), np.ones(sizes.max(initial=0), rows.dtype)
    for run in np.flatnonzero(sizes > LONG_RUN).tolist():
        low, n = first[run], sizes[run]
        out[run] = ones[:n] @ rows[low : low + n]
    left = np.flatnonzero((sizes > 1) & (sizes <= LONG_RUN))
    for place in range(1, LONG_RUN):
        left = left[sizes[left] > place]
        out[left] += rows.take(first[left] + place, axis=0)
    return out


class Gru:
    # Below this bound no logit's exponential, nor a sum of them over a bias's, leaves the range of
    # a 32-bit float.
    MILD = 60.0

    def __init__(self, lexicon: Lexicon, weights: dict[str, np.ndarray]):
        self.lexicon, self.w = lexicon, weights
        self.hidden = weights["u"].shape[0]
        self.inputs_met = np.zeros(0, int)  # the rows of ``table`` whose gradients are not zero
        self.d_table = None
        self.room = np.empty(0, weights["u"].dtype)
        # Sorting numbers of 16 bits takes one pass over them.
        self.narrow = np.uint16 if lexicon.start < 1 << 16 else np.int64
        self.class_of = lexicon.class_of.astype(np.int32)
        self.see_weights()

    def see_weights(self) -> None:
        """Notes whether any state can give a large logit; states are within -1 and 1."""
        w = self.w
        most = [np.abs(w["wc"]).sum(axis=0).max(initial=0), np.abs(w["wo"]).sum(axis=1).max(initial=0)]
        most = max(most) + 2 * max(np.abs(w[k]).max(initial=0) for k in ("bc", "bo"))
        self.mild = bool(most < self.MILD)

    def run(self, inputs, starts, state, keep=False):
        """States (steps x lanes x hidden) after each step of a window, the last of them, and
        what the way back needs. Within, lanes are the last axis, so that every step is work on
        whole rows."""
        h, ut = self.hidden, np.ascontiguousarray(self.w["u"].T)
        x = np.ascontiguousarray(self.w["table"].take(inputs, axis=0).transpose(0, 2, 1))
        steps, lanes = inputs.shape
        states = np.empty((steps, h, lanes), x.dtype)
        ns, q = np.empty_like(states), np.empty((3 * h, lanes), x.dtype)
        befores, qns = (np.empty_like(states) if keep else None for _ in range(2))
        begins, state = starts.any(axis=1), np.ascontiguousarray(state.T)
        for t in range(steps):
            before = state * ~starts[t] if begins[t] else state
            np.matmul(ut, before, out=q)
            gates, n, state = x[t, : 2 * h], ns[t], states[t]
            gates += q[: 2 * h]
            _gate(gates)
            np.multiply(gates[:h], q[2 * h :], out=n)
            n += x[t, 2 * h :]
            np.tanh(n, out=n)
            np.subtract(before, n, out=state)
            state *= gates[h:]
            state += n
            if keep:
                befores[t], qns[t] = before, q[2 * h :]
        saved = (befores, x[:, :h], x[:, h : 2 * h], ns, qns) if keep else None
        return np.ascontiguousarray(states.transpose(0, 2, 1)), states[-1].T, saved

    def _in_order(self, targets):
        """Places of the targets by their token, and so by class, the tokens and their classes."""
        ys = targets.ravel()
        at = np.flatnonzero(ys >= 0)
        ys = ys[at]
        order = np.argsort(ys.astype(self.narrow), kind="stable")
        ys = ys[order]
        return at[order], ys, self.class_of[ys]

    def _exponentials(self, hs, wo, bo, picked):
        """The exponentials of each row's logits, without the biases' factor, which is given too;
        their sums with it, the picked logits, and the places of those. Where logits may be large,
        they have their biases and are less their maximum, and the factor is one. They are held in
        one place, until the next are asked for."""
        if len(self.room) < len(hs) * len(wo):
            self.room = np.empty(len(hs) * len(wo), self.room.dtype)
        logits = np.matmul(hs, wo.T, out=self.room[: len(hs) * len(wo)].reshape(len(hs), len(wo)))
        rows, width = logits.shape
        places = np.arange(0, rows * width, width)
        places += picked
        if self.mild:
            # One pass less over all logits.
            factor, own = np.exp(bo), logits.ravel().take(places) + bo.take(picked)
        else:
            logits += bo
            logits -= logits.max(axis=1, keepdims=True)
            factor, own = np.ones(width, logits.dtype), logits.ravel().take(places)
        np.exp(logits, out=logits)
        return logits, factor, logits @ factor, own, places

    def _softmaxes(self, cls, ys, w):
        """(rows, weights, biases, what is picked) of the softmax over classes, and of those within
        the classes that have rows and several tokens; ``w`` are weights or their gradients."""
        edges = self.lexicon.edges
        if not len(cls):
            return
        yield slice(0, len(cls)), w["wc"].T, w["bc"], cls
        ends = np.searchsorted(cls, np.arange(len(edges)))
        for c in np.flatnonzero((np.diff(ends) > 0) & (np.diff(edges) > 1)).tolist():
            rows, low, high = slice(ends[c], ends[c + 1]), edges[c], edges[c + 1]
            yield rows, w["wo"][low:high], w["bo"][low:high], ys[rows] - low

    def log_likelihood(self, states, targets):
        """Natural log probability of each target (0 where there is none)."""
        out = np.zeros(targets.size)
        at, ys, cls = self._in_order(targets)
        hs, value = states.reshape(-1, self.hidden).take(at, axis=0), np.zeros(len(at))
        for rows, wo, bo, picked in self._softmaxes(cls, ys, self.w):
            _, _, sums, own, _ = self._exponentials(hs[rows], wo, bo, picked)
            value[rows] += own - np.log(sums)
        out[at] = value
        return out.reshape(targets.shape)

    def gradients(self, inputs, starts, targets, state):
        """Mean loss of a window, its gradients by truncated backpropagation, the state after."""
        w, h = self.w, self.hidden
        states, after, saved = self.run(inputs, starts, state, keep=True)
        grads = {k: np.zeros_like(w[k]) for k in ("wc", "bc", "wo", "bo")}
        if self.d_table is None:
            self.d_table = np.zeros_like(w["table"])
        self.d_table[self.inputs_met] = 0
        grads["table"] = self.d_table
        at, ys, cls = self._in_order(targets)
        scale = states.dtype.type(1 / max(1, len(at)))
        hs = states.reshape(-1, h).take(at, axis=0)
        back, loss = np.zeros_like(hs), 0.0
        into = self._softmaxes(cls, ys, grads)
        for (rows, wo, bo, picked), (_, d_w, d_b, _) in zip(self._softmaxes(cls, ys, w), into, strict=True):
            inner = hs[rows]
            e, factor, sums, own, places = self._exponentials(inner, wo, bo, picked)
            loss += np.log(sums).sum() - own.sum()
            # Times its row's share and the factor, e is then what the loss gains by each logit.
            e.ravel()[places] -= sums / factor.take(picked)
            share = scale / sums
            np.matmul(e.T, inner * share[:, None], out=d_w)
            d_w *= factor[:, None]
            np.multiply(share @ e, factor, out=d_b)
            part = e @ (wo * factor[:, None])
            part *= share[:, None]
            back[rows] += part
        steps, lanes = inputs.shape
        d_states = np.zeros((steps * lanes, h), states.dtype)
        d_states[at] = back
        d_states = np.ascontiguousarray(d_states.reshape(steps, lanes, h).transpose(0, 2, 1))
        before, r, z, n, qn = saved
        of_n, of_z, of_r = (1 - z) * (1 - n * n), (before - n) * z * (1 - z), qn * r * (1 - r)
        dq, d_n = np.empty((steps, 3 * h, lanes), states.dtype), np.empty_like(d_states)
        ends = starts.any(axis=1)
        flow = np.zeros((h, lanes), states.dtype)
        for t in range(steps - 1, -1, -1):
            flow += d_states[t]
            np.multiply(flow, of_n[t], out=d_n[t])
            np.multiply(d_n[t], of_r[t], out=dq[t, :h])
            np.multiply(flow, of_z[t], out=dq[t, h : 2 * h])
            np.multiply(d_n[t], r[t], out=dq[t, 2 * h :])
            flow *= z[t]
            flow += w["u"] @ dq[t]
            if ends[t]:
                flow *= ~starts[t]
        grads["u"] = np.matmul(before, dq.transpose(0, 2, 1)).sum(axis=0)
        dq[:, 2 * h :] = d_n
        ids = inputs.ravel()
        order = np.argsort(ids.astype(self.narrow), kind="stable")
        first = np.flatnonzero(np.diff(ids[order], prepend=-1))
        self.inputs_met = ids[order][first]
        d_inputs = np.ascontiguousarray(dq.transpose(0, 2, 1)).reshape(-1, 3 * h)
        grads["table"][self.inputs_met] = sums_of_runs(d_inputs.take(order, axis=0), first)
        return loss * scale, grads, after


class Trainer:
    """Adam steps over windows of lanes; the state goes on from window to window. Of the input
    table, a step changes the rows of tokens that it read."""

    def __init__(self, model: Gru, rate: float = 0.02, window: int = 16, lanes: int = 512):
        self.model, self.rate, self.window, self.lanes = model, rate, window, lanes
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.w.items()}
        self.updates = 0

    def _update(self, grads):
        self.updates += 1
        met = self.model.inputs_met
        grads = {**grads, "table": grads["table"].take(met, axis=0)}
        norm = np.sqrt(sum(float(np.vdot(g, g)) for g in grads.values()))
        shrink = np.float32(min(1.0, 1.0 / max(norm, 1e-12)))
        fix = np.sqrt(1 - 0.99**self.updates) / (1 - 0.9**self.updates)
        rate = np.float32(self.rate * fix / (1 + self.updates / 400))
        for k, g in grads.items():
            rows = met if k == "table" else slice(None)
            m, v = (x.take(met, axis=0) if k == "table" else x for x in self.moments[k])
            # m += 0.1 (g - m), v += 0.01 (g g - v), w -= rate m / (sqrt(v) + 1e-6)
            g *= shrink * np.float32(0.1)
            m *= np.float32(0.9)
            m += g
            g *= g
            v *= np.float32(0.99)
            v += g
            np.sqrt(v, out=g)
            g += np.float32(1e-6)
            np.divide(m, g, out=g)
            g *= rate
            self.model.w[k][rows] -= g
            if k == "table":
                self.moments[k][0][rows], self.moments[k][1][rows] = m, v
        # A weight moves by little more than the rate, so the bound holds for some steps.
        if self.updates % 16 == 0:
            self.model.see_weights()

    def learn(self, docs: list[np.ndarray]) -> int:
        """One pass over documents (token numbers); returns the tokens read. A long document
        is learnt from in parts, each in a lane of its own."""
        docs = [d[i : i + PART] for d in docs for i in range(0, len(d), PART)]
        if not docs:
            return 0
        targets, starts, _ = lanes_of(docs, self.lanes)
        inputs = inputs_of(targets, starts, self.model.lexicon)
        state = np.zeros((targets.shape[1], self.model.hidden), np.float32)
        for at in range(0, len(targets), self.window):
            part = slice(at, at + self.window)
            _, grads, state = self.model.gradients(inputs[part], starts[part], targets[part], state)
            self._update(grads)
        return int(sum(len(d) for d in docs))


def score_documents(model: Gru, docs: list[np.ndarray], lanes: int = 512, window: int | None = None) -> np.ndarray:
    """Natural log probability of each whole document; the state is carried across windows, of
    some 8,192 tokens each unless ``window`` tells their steps."""
    out = np.zeros(len(docs))
    full = [i for i, d in enumerate(docs) if len(d)]
    if not full:
        return out
    targets, starts, members = lanes_of([docs[i] for i in full], lanes)
    inputs = inputs_of(targets, starts, model.lexicon)
    state = np.zeros((targets.shape[1], model.hidden), np.float32)
    window = window or -(-8192 // targets.shape[1])
    values = np.empty(targets.shape)
    for at in range(0, len(targets), window):
        part = slice(at, at + window)
        states, state, _ = model.run(inputs[part], starts[part], state)
        values[part] = model.log_likelihood(states, targets[part])
    for lane, listed in enumerate(members):
        at = 0
        for i in listed:
            n = len(docs[full[i]])
            out[full[i]] = values[at : at + n, lane].sum()
            at += n
    return out
