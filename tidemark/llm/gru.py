"""A gated recurrent unit in numpy with a class-factored output: training by truncated backpropagation, and scoring.

The output has two factors: the class of the next word, from the state, and the word in its class. The most
frequent words (HEAD of them, in classes of HEAD_SIZE) are told apart by a softmax on the state; those of the middle classes
by their counts in the corpus. The last class stands for all rarer and unknown words; what a word has of it is the caller's.

Documents run in lanes, one after the other: a lane's state goes from window to window, and starts anew with a document. In
training a long document is cut into pieces of PIECE tokens, so that it doesn't hold up all lanes; a piece starts from the state in which
the weights at the start of the pass leave the document before it. Scores carry the state through whole documents.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

HEAD, HEAD_SIZE, MIDDLE = 2048, 64, 15
CLASSES = HEAD // HEAD_SIZE + MIDDLE + 1
#: Inputs: head words, other classes, the start of a document.
START = HEAD + MIDDLE + 1
INPUTS = START + 1
LN10 = np.log(10)
ONE = np.float32(1)
#: Lanes that are trained in step: so many that a pass has some 60 updates, within bounds.
LANES, UPDATES = (16, 512), 60
PIECE = 512  # tokens of a piece in training


@dataclass
class Vocabulary:
    """Words by rank: class, place in a head class (or -1), natural log of the share of a middle class."""

    hashes: np.ndarray  # sorted
    rank: np.ndarray  # of each of the sorted hashes
    counts: np.ndarray  # by rank
    total: int  # training tokens
    distinct: int

    def __post_init__(self) -> None:
        n = len(self.counts)
        mass = np.cumsum(self.counts[HEAD:], dtype=np.float64)
        self.classes = np.full(n + 1, CLASSES - 1, np.int64)
        self.classes[: min(n, HEAD)] = np.arange(min(n, HEAD)) // HEAD_SIZE
        if n > HEAD:
            self.classes[HEAD:n] = HEAD // HEAD_SIZE + np.minimum((mass - self.counts[HEAD:]) * MIDDLE // mass[-1], MIDDLE - 1).astype(np.int64)
        self.place = np.full(n + 1, -1, np.int64)
        self.place[: min(n, HEAD)] = np.arange(min(n, HEAD)) % HEAD_SIZE
        self.inputs = np.where(self.place >= 0, np.arange(n + 1), HEAD + self.classes - HEAD // HEAD_SIZE)
        sums = np.bincount(self.classes[:n], weights=self.counts, minlength=CLASSES)
        self.tail_total = int(self.total - self.counts.sum())
        self.tail_distinct = int(self.distinct - n)
        sums[-1] = self.tail_total + 1
        self.class_bias = np.log((sums + 1) / (sums.sum() + CLASSES))
        self.share = np.zeros(n + 1)
        middle = self.classes[HEAD:n]
        self.share[HEAD:n] = np.log(self.counts[HEAD:] / sums[middle])

        # where the hashes of each beginning start: few share one, so a word is found in a look or two
        self.shift = np.uint64(64 - max(1, n.bit_length()))
        self.starts = np.searchsorted(self.hashes >> self.shift, np.arange((1 << 64 - int(self.shift)) + 1, dtype=np.uint64)).astype(np.int32)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ranks of words; the number of words for any that isn't here."""
        out = np.full(len(hashes), len(self.counts))
        begin = hashes >> self.shift
        at, end = self.starts[begin], self.starts[begin + np.uint64(1)]
        left = np.flatnonzero(at < end)
        at, end, own = at[left], end[left], hashes[left]
        while len(left):
            hit = self.hashes[at] == own
            out[left[hit]] = self.rank[at[hit]]
            on = ~hit & (at + 1 < end)
            left, at, end, own = left[on], at[on] + 1, end[on], own[on]
        return out


SHAPES = lambda h: {"E": (INPUTS, 3 * h), "U": (h, 3 * h), "Wc": (h, CLASSES), "bc": (CLASSES,), "Wv": (HEAD // HEAD_SIZE, h, HEAD_SIZE), "bv": (HEAD // HEAD_SIZE, HEAD_SIZE)}


def start_weights(vocabulary: Vocabulary, hidden: int, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = {k: (rng.standard_normal(s) * (0.1 if k == "E" else 0.5 / np.sqrt(hidden))).astype(np.float32) for k, s in SHAPES(hidden).items()}
    w["Wc"] *= 0.1
    w["Wv"] *= 0.1
    w["bc"] = vocabulary.class_bias.astype(np.float32)
    head = np.full(HEAD, 0.5)
    head[: min(HEAD, len(vocabulary.counts))] = vocabulary.counts[:HEAD]
    head = head.reshape(-1, HEAD_SIZE)
    w["bv"] = np.log(head / head.sum(axis=1, keepdims=True)).astype(np.float32)
    return w


def pack(w: dict[str, np.ndarray]) -> bytes:
    return np.concatenate([x.reshape(-1) for x in w.values()]).astype("<f4").tobytes()


def unpack(data: bytes, hidden: int) -> dict[str, np.ndarray]:
    flat, out, at = np.frombuffer(data, "<f4"), {}, 0
    for k, s in SHAPES(hidden).items():
        n = int(np.prod(s))
        out[k] = flat[at : at + n].reshape(s).copy()
        at += n
    return out


def lanes(docs: list[np.ndarray], most: int, least: int = 256) -> list[list[int]]:
    """Documents (by number) for each lane, lanes of about equal length, longest lane first."""
    total, longest = sum(map(len, docs)), max(map(len, docs))
    n = max(1, min(most, total // max(longest, least)))
    heap = [(0, i) for i in range(n)]
    out: list[list[int]] = [[] for _ in range(n)]
    for d in sorted(range(len(docs)), key=lambda d: -len(docs[d])):
        size, i = heapq.heappop(heap)
        out[i].append(d)
        heapq.heappush(heap, (size + len(docs[d]), i))
    return sorted((x for x in out if x), key=lambda x: -sum(len(docs[d]) for d in x))


def grid(docs: list[np.ndarray], vocabulary: Vocabulary, most: int, before: list[int] | None = None) -> tuple[np.ndarray, ...]:
    """Inputs, target ids, document numbers and starts of documents as time x lane; the number of lanes that are live at each time.

    docs end with their end token; before has the id before a piece of a longer document, -1 at its start."""
    rows = lanes(docs, most)
    size = np.array([sum(len(docs[d]) for d in r) for r in rows])
    x, y, of, fresh = (np.zeros((size[0], len(rows)), t) for t in (np.int32, np.int32, np.int32, bool))
    for j, r in enumerate(rows):
        ids = np.concatenate([docs[d] for d in r])
        n = np.array([len(docs[d]) for d in r])
        first = np.cumsum(n) - n
        fed = vocabulary.inputs[np.roll(ids, 1)]
        last = np.array([before[d] for d in r]) if before else np.full(len(r), -1)
        fed[first] = np.where(last < 0, START, vocabulary.inputs[last])
        x[: len(ids), j], y[: len(ids), j], of[: len(ids), j] = fed, ids, np.repeat(r, n)
        fresh[first, j] = True
    live = np.searchsorted(-size, -np.arange(size[0]), side="left")
    return x, y, of, fresh, live


def pieces(docs: list[np.ndarray], size: int) -> tuple[list[np.ndarray], list[int]]:
    """Documents cut to size, and the id before each piece: a long document would hold up all lanes."""
    cut = [(d[k : k + size], int(d[k - 1]) if k else -1) for d in docs for k in range(0, len(d), size)]
    return [x for x, _ in cut], [k for _, k in cut]


def states_between(w: dict[str, np.ndarray], vocabulary: Vocabulary, docs: list[np.ndarray], size: int, most: int = 512) -> np.ndarray:
    """The state before each of the pieces() of docs: zero for a document's first."""
    count = [max(1, -(-len(d) // size)) for d in docs]
    first = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros((first[-1], w["U"].shape[0]), np.float32)
    long_ = [i for i, n in enumerate(count) if n > 1]
    if not long_:
        return out
    # up to where the last piece starts; no softmax is needed here
    x, _, of, fresh, live = grid([docs[i][: (count[i] - 1) * size] for i in long_], vocabulary, most)
    cell = Cell(w)
    h = np.zeros((out.shape[1], x.shape[1]), np.float32)
    place = np.arange(1, len(x) + 1)[:, None]
    place = place - np.maximum.accumulate(np.where(fresh, place - 1, 0), axis=0)  # tokens of the document so far
    cut = place % size == 0
    cuts = cut.any(axis=1)
    for t0, t1 in blocks(live):
        inputs, at = cell.inputs(x, live, t0, t1)
        keep = kept_states(fresh, t0, t1)
        for t in range(t0, t1):
            m = live[t]
            h = cell.step(inputs[:, at[t - t0] : at[t - t0] + m], started(h, m, keep[t - t0]))
            if cuts[t]:
                ends = np.flatnonzero(cut[t, :m])
                out[first[np.take(long_, of[t, ends])] + place[t, ends] // size] = h[:, ends].T
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def tanh(x: np.ndarray) -> np.ndarray:
    """In place; exp is several times as fast as numpy's own tanh."""
    x *= 2
    x = sigmoid(x)
    x *= 2
    x -= 1
    return x


def step(w: dict[str, np.ndarray], x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """Cell's step in its plain form, lane x state: what the tests hold it against."""
    n = h.shape[1]
    a, u = w["E"][x], h @ w["U"]
    zr = sigmoid(a[:, : 2 * n] + u[:, : 2 * n])
    uc = u[:, 2 * n :]
    c = tanh(a[:, 2 * n :] + zr[:, n:] * uc)
    return c + zr[:, :n] * (h - c), zr, c, uc


def softmax(x: np.ndarray) -> np.ndarray:
    """In place, of each column."""
    x -= x.max(axis=0)
    np.exp(x, out=x)
    x *= 1 / x.sum(axis=0)
    return x


class Cell:
    """The step of the unit, state x lane: numpy works along rows much faster than across short ones. The gates' weights have the sign that 1 / (1 + exp(-x)) needs."""

    def __init__(self, w: dict[str, np.ndarray]):
        self.hidden = n = w["U"].shape[0]
        by = np.repeat(np.array([-1, 1], np.float32), [2 * n, n])
        self.e, self.u = np.ascontiguousarray((w["E"] * by).T), np.ascontiguousarray((w["U"] * by).T)

    def inputs(self, x: np.ndarray, live: np.ndarray, t0: int, t1: int) -> tuple[np.ndarray, np.ndarray]:
        """What the tokens of some times add, one column for each, and the first column of each time."""
        return self.e[:, flat(x, live, t0, t1)], np.cumsum(live[t0:t1]) - live[t0:t1]

    def step(self, a: np.ndarray, h: np.ndarray, keep: tuple[np.ndarray, ...] = ()) -> np.ndarray:
        """The next state. keep: where the gates, the candidate and what the state gives it are put for training."""
        n = self.hidden
        u = self.u.dot(h)
        zr, uc = u[: 2 * n], u[2 * n :]
        zr += a[: 2 * n]
        np.exp(zr, out=zr)
        zr += ONE
        np.reciprocal(zr, out=zr)
        c = zr[n:] * uc
        c += a[2 * n :]
        np.tanh(c, out=c)
        if keep:
            keep[0][:], keep[1][:], keep[2][:] = zr, c, uc
        out = h - c
        out *= zr[:n]
        out += c
        return out


def flat(x: np.ndarray, live: np.ndarray, t0: int, t1: int) -> np.ndarray:
    """The cells of live lanes from time t0 to t1, time by time."""
    return x[t0:t1][np.arange(x.shape[1]) < live[t0:t1, None]]


def blocks(live: np.ndarray, least: int = 1, tokens: int = 1 << 14) -> list[tuple[int, int]]:
    """Spans of times of about `tokens` tokens, and of `least` times."""
    upto, out, t = np.cumsum(live), [], 0
    while t < len(live):
        t1 = int(np.searchsorted(upto, (upto[t - 1] if t else 0) + tokens, side="right"))
        out.append((t, min(len(live), max(t + least, t1))))
        t = out[-1][1]
    return out


def kept_states(fresh: np.ndarray, t0: int, t1: int) -> list[np.ndarray | None]:
    """For each time what the states are multiplied by, None where no document starts."""
    return [np.where(f, np.float32(0), np.float32(1)) if some else None for f, some in zip(fresh[t0:t1], fresh[t0:t1].any(axis=1).tolist(), strict=True)]


def started(h: np.ndarray, m: int, keep: np.ndarray | None) -> np.ndarray:
    """States of the first m lanes, zero where a document starts."""
    if keep is not None:
        return h[:, :m] * keep[:m]
    return h if m == h.shape[1] else np.ascontiguousarray(h[:, :m])


def log_share(logits: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural logs of the softmax of each column at its target. Changes logits."""
    logits -= logits.max(axis=0)
    of_target = logits[target, np.arange(len(target))]
    np.exp(logits, out=logits)
    return of_target - np.log(logits.sum(axis=0))


def score(w: dict[str, np.ndarray], vocabulary: Vocabulary, docs: list[np.ndarray], most: int = 512, window: int = 1) -> np.ndarray:
    """Natural log probability of each document; of a word of the last class only the class counts. window: times of a softmax at least."""
    out = np.zeros(len(docs))
    if not docs:
        return out
    x, y, of, fresh, live = grid(docs, vocabulary, most)
    cell, wc = Cell(w), np.ascontiguousarray(w["Wc"].T)
    h = np.zeros((cell.hidden, x.shape[1]), np.float32)
    for t0, t1 in blocks(live, window):
        inputs, first = cell.inputs(x, live, t0, t1)
        keep, s = kept_states(fresh, t0, t1), np.empty((cell.hidden, inputs.shape[1]), np.float32)
        for t, at, m in zip(range(t1 - t0), first.tolist(), live[t0:t1].tolist(), strict=True):
            h = cell.step(inputs[:, at : at + m], started(h, m, keep[t]))
            s[:, at : at + m] = h
        ids = flat(y, live, t0, t1)
        c = vocabulary.classes[ids]
        logits = wc @ s
        logits += w["bc"][:, None]
        p = log_share(logits, c) + vocabulary.share[ids]
        order, edge = by_head_class(c)
        s, places = s[:, order], vocabulary.place[ids[order]]
        for k in range(HEAD // HEAD_SIZE):
            a, b = edge[k], edge[k + 1]
            if a < b:
                own = w["Wv"][k].T @ s[:, a:b]
                own += w["bv"][k][:, None]
                p[order[a:b]] += log_share(own, places[a:b])
        out += np.bincount(flat(of, live, t0, t1), weights=p, minlength=len(docs))
    return out


def by_head_class(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens in the order of their classes, and where each of the head classes starts."""
    c = c.astype(np.uint8)  # few bits: numpy sorts them by counting
    order = np.argsort(c, kind="stable")
    return order, np.searchsorted(c[order], np.arange(HEAD // HEAD_SIZE + 1, dtype=np.uint8))


@dataclass
class Moments:
    """What Adam knows of earlier steps."""

    first: dict[str, np.ndarray]
    second: dict[str, np.ndarray]
    steps: int = 0

    @classmethod
    def none(cls, w: dict[str, np.ndarray]) -> Moments:
        return cls({k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()})


def train(w: dict[str, np.ndarray], vocabulary: Vocabulary, docs: list[np.ndarray], most: int | None = None, window: int = 16, rate: float = 4e-3, moments: Moments | None = None) -> tuple[dict[str, np.ndarray], int]:
    """One pass over docs by Adam, backpropagating through windows; returns the weights and the number of tokens seen. moments: of the passes before, which go on in place."""
    w = {k: v.copy() for k, v in w.items()}
    moments = moments or Moments.none(w)
    if not docs:
        return w, 0
    most = most or int(np.clip(sum(map(len, docs)) // (window * UPDATES), *LANES))
    left = states_between(w, vocabulary, docs, PIECE)
    docs, before = pieces(docs, PIECE)
    x, y, of, starts, live = grid(docs, vocabulary, most, before)
    n = w["U"].shape[0]
    h = np.zeros((n, x.shape[1]), np.float32)
    m1, m2 = moments.first, moments.second
    for t0 in range(0, len(x), window):
        t1 = min(t0 + window, len(x))
        cell = Cell(w)
        inputs, first = cell.inputs(x, live, t0, t1)
        count = inputs.shape[1]
        zr, c, uc, old, s = (np.empty((k * n, count), np.float32) for k in (2, 1, 1, 1, 1))
        spans = [(at, at + m) for at, m in zip(first.tolist(), live[t0:t1].tolist(), strict=True)]
        fresh = [np.flatnonzero(starts[t, : live[t]]) for t in range(t0, t1)]
        for t, (i, j) in enumerate(spans):
            h = started(h, j - i, None)
            if len(fresh[t]):
                h[:, fresh[t]] = left[of[t0 + t, fresh[t]]].T
            old[:, i:j] = h
            h = cell.step(inputs[:, i:j], h, (zr[:, i:j], c[:, i:j], uc[:, i:j]))
            s[:, i:j] = h
        ids = flat(y, live, t0, t1)
        cls = vocabulary.classes[ids]
        g = {k: np.zeros_like(v) for k, v in w.items()}
        d = w["Wc"].T @ s
        d += w["bc"][:, None]
        d = softmax(d)
        d[cls, np.arange(count)] -= 1
        g["Wc"], g["bc"] = s @ d.T, d.sum(axis=1)
        ds = w["Wc"] @ d
        order, edge = by_head_class(cls)
        sorted_s, places, sorted_ds = s[:, order[: edge[-1]]], vocabulary.place[ids[order]], np.empty((n, edge[-1]), np.float32)
        for k in range(HEAD // HEAD_SIZE):
            a, b = edge[k], edge[k + 1]
            if a < b:
                own = sorted_s[:, a:b]
                d = w["Wv"][k].T @ own
                d += w["bv"][k][:, None]
                d = softmax(d)
                d[places[a:b], np.arange(b - a)] -= 1
                g["Wv"][k], g["bv"][k] = own @ d.T, d.sum(axis=1)
                sorted_ds[:, a:b] = w["Wv"][k] @ d
        ds[:, order[: edge[-1]]] += sorted_ds
        # by what the gradient of a state is multiplied for the candidate and the gates
        z, r = zr[:n], zr[n:]
        by_c = (1 - z) * (1 - c * c)
        by_all = np.stack([(old - c) * z * (1 - z), by_c * uc * r * (1 - r), by_c * r])
        flat_all = by_all.reshape(3 * n, count)
        back = None
        for t in range(len(spans) - 1, -1, -1):
            i, j = spans[t]
            dh = ds[:, i:j]
            if back is not None:
                dh[:, : back.shape[1]] += back
            by_all[:, :, i:j] *= dh  # it becomes the gradient of what the state gives
            back = w["U"] @ flat_all[:, i:j]
            back += dh * z[:, i:j]
            if len(fresh[t]):
                back[:, fresh[t]] = 0
        g["U"] = old @ flat_all.T
        by_all[2] = ds * by_c  # of what the tokens give
        fed = flat(x, live, t0, t1)
        g["E"] = np.stack([np.bincount(fed, row, INPUTS) for row in flat_all], axis=1).astype(np.float32)
        moments.steps = steps = moments.steps + 1
        decay = min(1.0, steps / 20)
        for k in w:
            gk = np.clip(g[k] / count, -1, 1) if k == "U" else g[k] / count
            m1[k] += 0.1 * (gk - m1[k])
            m2[k] += 0.01 * (gk * gk - m2[k])
            w[k] -= (rate * decay / (1 - 0.9**steps)) * m1[k] / (np.sqrt(m2[k] / (1 - 0.99**steps)) + 1e-6)
    return w, sum(map(len, docs))
