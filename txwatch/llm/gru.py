"""A small gated recurrent language model in numpy.

Words are factored into classes of equal size: P(word) = P(class) P(word | class),
so a token costs two small softmaxes. Documents run side by side in lanes; a
lane's state is carried from window to window and is zero at each document's
start, so a text of any length is scored whole. Training backpropagates through
one window at a time (truncated) and carries the state on.
"""

from __future__ import annotations

import heapq
import io
from dataclasses import dataclass

import numpy as np

F32 = np.float32
#: Logits up to this size need no shift before ``exp``.
LARGE = 60
Params = dict[str, np.ndarray]


def init(mass: np.ndarray, hidden: int, seed: int = 7) -> Params:
    """Parameters of a model over ``len(mass)`` words that starts as their unigram
    model; ``mass`` are counts, made up to whole classes with words of no mass."""
    k = len(mass)
    each = int(np.ceil(np.sqrt(k)))
    classes = -(-k // each)
    full = np.full(classes * each, 1e-9)
    full[:k] = mass + 0.1
    full = full.reshape(classes, each)
    rng = np.random.default_rng(seed)
    return {"inp": rng.normal(0, 0.1, (classes * each, 3 * hidden)).astype(F32),
            "rec": rng.normal(0, 1 / np.sqrt(hidden), (hidden, 2 * hidden)).astype(F32),
            "cand": rng.normal(0, 1 / np.sqrt(hidden), (hidden, hidden)).astype(F32),
            "cls": np.zeros((hidden, classes), F32), "cls_b": np.log(full.sum(1) / full.sum()).astype(F32),
            "word": np.zeros((classes, hidden, each), F32),
            "word_b": np.log(full / full.sum(1, keepdims=True)).astype(F32)}


def dumps(p: Params) -> bytes:
    out = io.BytesIO()
    np.savez(out, **p)
    return out.getvalue()


def loads(data: bytes) -> Params:
    with np.load(io.BytesIO(data)) as z:
        return {k: z[k] for k in z.files}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return F32(1) / (F32(1) + np.exp(-x))


@dataclass
class Lanes:
    """Documents laid end to end in lanes, the longest lane first."""

    token: np.ndarray  # (steps, lanes): the word to predict
    given: np.ndarray  # (steps, lanes): the word before it
    fresh: np.ndarray  # (steps, lanes): a document starts here
    doc: np.ndarray  # (steps, lanes): its number, -1 behind a lane's end
    active: np.ndarray  # (steps,): lanes that have a token


def lanes(docs: list[np.ndarray], width: int, start: int) -> Lanes:
    """``docs``: word numbers of each document; ``start``: the word before the first."""
    order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
    load = [(0, k) for k in range(min(width, len(docs)))]
    held: list[list[int]] = [[] for _ in load]
    for i in order:
        n, k = heapq.heappop(load)
        held[k].append(i)
        heapq.heappush(load, (n + len(docs[i]), k))
    held.sort(key=lambda ids: -sum(len(docs[i]) for i in ids))
    length = [sum(len(docs[i]) for i in ids) for ids in held]
    shape = (max(length, default=0), len(held))
    token, given = np.zeros(shape, np.int32), np.full(shape, start, np.int32)
    fresh, doc = np.zeros(shape, bool), np.full(shape, -1, np.int64)
    for k, ids in enumerate(held):
        at = 0
        for i in ids:
            n = len(docs[i])
            token[at:at + n, k], doc[at:at + n, k] = docs[i], i
            given[at + 1:at + n, k] = docs[i][:-1]
            fresh[at, k] = True
            at += n
    return Lanes(token, given, fresh, doc, (doc >= 0).sum(1))


def forward(p: Params, given: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: bool = False):
    """The states of a window (steps, lanes, hidden) from the state before it, and with
    ``keep`` each step's incoming state, gates and candidate."""
    steps, n = given.shape
    size = h.shape[1]
    x = p["inp"][given]
    states = np.empty((steps, n, size), F32)
    saved = (np.empty((steps, n, size), F32), np.empty((steps, n, 2 * size), F32), np.empty((steps, n, size), F32)) if keep else None
    carry = (~fresh)[:, :, None].astype(F32)
    starts = fresh.any(1)
    for t in range(steps):
        if starts[t]:
            h = h * carry[t]
        gates = _sigmoid(x[t, :, :2 * size] + h @ p["rec"])
        z, r = gates[:, :size], gates[:, size:]
        c = np.tanh(x[t, :, 2 * size:] + (r * h) @ p["cand"])
        if keep:
            saved[0][t], saved[1][t], saved[2][t] = h, gates, c
        states[t] = h = c + z * (h - c)
    return states, saved


def _exp_sum(x: np.ndarray, small: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """``exp(x - shift)``, its row sums, and ``shift``, which ``small`` values do not need."""
    shift = F32(0) if small else x.max(1, keepdims=True)
    e = np.exp(x) if small else np.exp(x - shift)
    return e, e.sum(1, keepdims=True), shift


def _small(weight: np.ndarray, bias: np.ndarray) -> bool:
    """Whether no state (its parts lie between -1 and 1) gives a large logit."""
    return bool((np.abs(weight).sum(-2) + np.abs(bias)).max(initial=0) < LARGE)


def output(p: Params, states: np.ndarray, token: np.ndarray, grads: Params | None = None):
    """Natural-log probabilities of ``token`` given ``states`` (rows); with
    ``grads``, also the gradient of minus their sum, added up there."""
    each = p["word_b"].shape[1]
    order = np.argsort(token, kind="stable")  # by class, then word
    states, token = states[order], token[order]
    cls, within = np.divmod(token, each)
    rows = np.arange(len(token))
    x = states @ p["cls"] + p["cls_b"]
    e, total, shift = _exp_sum(x, _small(p["cls"], p["cls_b"]))
    logp = (x[rows, cls][:, None] - shift - np.log(total))[:, 0]
    back = None
    if grads is not None:
        e /= total
        e[rows, cls] -= 1
        grads["cls"] += states.T @ e
        grads["cls_b"] += e.sum(0)
        back = e @ p["cls"].T
    at = np.searchsorted(cls, np.arange(len(p["word_b"]) + 1))
    low = np.empty((len(token), each), F32)
    for c in np.flatnonzero(np.diff(at)):
        a, b = at[c], at[c + 1]
        np.matmul(states[a:b], p["word"][c], out=low[a:b])
        low[a:b] += p["word_b"][c]
    e, total, shift = _exp_sum(low, _small(p["word"], p["word_b"]))
    logp += (low[rows, within][:, None] - shift - np.log(total))[:, 0]
    if grads is not None:
        e /= total
        e[rows, within] -= 1
        for c in np.flatnonzero(np.diff(at)):
            a, b = at[c], at[c + 1]
            grads["word"][c] += states[a:b].T @ e[a:b]
            grads["word_b"][c] += e[a:b].sum(0)
            back[a:b] += e[a:b] @ p["word"][c].T
        back = _unordered(back, order)
    return _unordered(logp, order), back


def _unordered(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    out = np.empty_like(values)
    out[order] = values
    return out


def window_gradient(p: Params, given, token, fresh, live, h) -> tuple[float, Params, np.ndarray]:
    """Loss (minus log probability) of a window, its gradient, and the state after it."""
    states, saved = forward(p, given, fresh, h, keep=True)
    grads = {k: np.zeros_like(v) for k, v in p.items()}
    logp, back = output(p, states[live], token[live], grads)
    d_states = np.zeros_like(states)
    d_states[live] = back
    size = h.shape[1]
    before, gates, c = saved
    z, r = gates[..., :size], gates[..., size:]
    # what the chain needs of each step, for the whole window at once
    by_c, by_z = (1 - z) * (1 - c * c), (before - c) * z * (1 - z)
    by_r = before * r * (1 - r)
    d_in = np.empty((*given.shape, 3 * size), F32)
    dg, dc = d_in[..., :2 * size], d_in[..., 2 * size:]
    rec, cand = np.ascontiguousarray(p["rec"].T), np.ascontiguousarray(p["cand"].T)
    carry, starts = (~fresh)[:, :, None].astype(F32), fresh.any(1)
    dh = np.zeros_like(h)
    for t in range(len(given) - 1, -1, -1):
        dh += d_states[t]
        np.multiply(dh, by_c[t], out=dc[t])
        drh = dc[t] @ cand
        np.multiply(dh, by_z[t], out=dg[t, :, :size])
        np.multiply(drh, by_r[t], out=dg[t, :, size:])
        dh *= z[t]
        drh *= r[t]
        dh += drh
        dh += dg[t] @ rec
        if starts[t]:
            dh *= carry[t]
    grads["cand"] += (r * before).reshape(-1, size).T @ dc.reshape(-1, size)
    grads["rec"] += before.reshape(-1, size).T @ dg.reshape(-1, 2 * size)
    flat = given.ravel()
    order = np.argsort(flat, kind="stable")
    rows, at = np.unique(flat[order], return_index=True)
    grads["inp"][rows] = np.add.reduceat(d_in.reshape(-1, 3 * size)[order], at, axis=0)
    return float(-logp.sum()), grads, states[-1]


class Adam:
    def __init__(self, p: Params, rate: float):
        self.rate, self.n = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, p: Params, g: Params) -> None:
        self.n += 1
        rate = F32(self.rate * np.sqrt(1 - 0.999 ** self.n) / (1 - 0.9 ** self.n))
        for k in p:
            self.m[k] += F32(0.1) * (g[k] - self.m[k])
            self.v[k] += F32(0.001) * (g[k] * g[k] - self.v[k])
            p[k] -= rate * self.m[k] / (np.sqrt(self.v[k]) + F32(1e-8))


def segments(docs: list[np.ndarray], longest: int) -> list[np.ndarray]:
    """The documents, long ones in pieces, so that lanes are of about one length."""
    return [d[at:at + longest] for d in docs for at in range(0, len(d), longest)]


def train(p: Params, docs: list[np.ndarray], start: int, adam: Adam, width: int = 512, window: int = 16, longest: int = 512) -> None:
    """One pass over the documents, in place. Long documents train as pieces of
    ``longest`` words, each from a zero state; as few lanes as they fill."""
    pieces = segments(docs, longest)
    w = lanes(pieces, max(16, min(width, sum(map(len, pieces)) // longest)), start)
    h = np.zeros((w.token.shape[1], p["cand"].shape[0]), F32)
    for a in range(0, len(w.token), window):
        n = w.active[a]
        cut = slice(a, a + window), slice(0, n)
        live = w.doc[cut] >= 0
        _, g, h = window_gradient(p, w.given[cut], w.token[cut], w.fresh[cut], live, h[:n])
        total = F32(1 / live.sum())
        adam.step(p, {k: v * total for k, v in g.items()})


def score(p: Params, docs: list[np.ndarray], start: int, width: int = 512, window: int = 32) -> np.ndarray:
    """The natural-log probability of each document, whole; as few lanes (from 64 on) as the longest one leaves full."""
    out = np.zeros(len(docs))
    most = max(map(len, docs), default=1)
    w = lanes(docs, min(width, max(64, sum(map(len, docs)) // max(1, most))), start)
    h = np.zeros((w.token.shape[1], p["cand"].shape[0]), F32)
    for a in range(0, len(w.token), window):
        n = w.active[a]
        cut = slice(a, a + window), slice(0, n)
        states, _ = forward(p, w.given[cut], w.fresh[cut], h[:n])
        live = w.doc[cut] >= 0
        logp, _ = output(p, states[live], w.token[cut][live])
        out += np.bincount(w.doc[cut][live], logp.astype(np.float64), len(docs))
        h = states[-1]
    return out
