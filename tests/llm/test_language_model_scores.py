"""The recurrent model against a plain one: scores of whole texts in a table, states between the pieces of training, passes that go on."""

import math
import re
from collections import Counter

import numpy as np
import xxhash

from tests.llm.test_llm import ROWS, docs, small_vocabulary  # noqa: F401
from tidemark.llm import gru, lm


def plain_score(w, words, counts, tokens):
    """log10 probability of a text, token by token, in Python's floats. counts: of all training tokens by hash."""
    n = w["U"].shape[0]
    e, u, wc, bc, wv, bv = (w[k].astype(np.float64) for k in ("E", "U", "Wc", "bc", "Wv", "bv"))
    sig = lambda x: 1 / (1 + np.exp(-x))
    h, fed, out = np.zeros(n), gru.START, 0.0
    for token in tokens:
        a, b = e[fed], h @ u
        z, r = sig(a[:n] + b[:n]), sig(a[n : 2 * n] + b[n : 2 * n])
        c = np.tanh(a[2 * n :] + r * b[2 * n :])
        h = c + z * (h - c)
        i = int(words.ids(np.array([token], np.uint64))[0])
        k = int(words.classes[i])
        p = np.exp(h @ wc + bc)
        prob = p[k] / p.sum()
        if words.place[i] >= 0:
            q = np.exp(h @ wv[k] + bv[k])
            prob *= q[words.place[i]] / q.sum()
        elif i < len(words.counts):
            members = [j for j in range(len(words.counts)) if words.classes[j] == k]
            prob *= words.counts[i] / sum(int(words.counts[j]) for j in members)
        else:
            prob *= (counts.get(token, 0) + 1) / (words.tail_total + words.tail_distinct + 1)
        out += math.log10(prob)
        fed = int(words.inputs[i])
    return out


def test_scores_of_a_table(docs, monkeypatch):  # noqa: F811
    """score is the probability by the trained weights, whatever the rows share, and equal rows have a score each."""
    kept = {}
    real = lm.train

    def train(learning, words, seed=7):
        kept["words"], kept["weights"] = words, real(learning, words, seed)
        return kept["weights"]

    monkeypatch.setattr(lm, "train", train)
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_tokens, round(r.score, 3)) for r in lm.score_documents(docs).collect()))
    w = gru.unpack(kept["weights"], lm.HIDDEN)
    hashed = lambda t: [xxhash.xxh3_64_intdigest(x) for x in re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower())] + [lm.END]
    import zlib

    counts = Counter(x for i, t in ROWS if i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for x in hashed(t))
    want = {}
    for i, t in ROWS:
        if t not in want:
            want[t] = plain_score(w, kept["words"], counts, hashed(t))
    theirs = sorted((i is None, i or 0, len(hashed(t)), want[t]) for i, t in ROWS)
    assert len(got) == len(theirs)
    for a, b in zip(sorted(got), theirs, strict=True):
        assert a[:3] == b[:3] and math.isclose(a[3], b[3], rel_tol=2e-4, abs_tol=2e-3)


def test_states_between_pieces():
    words, r = small_vocabulary()
    w = gru.start_weights(words, 6)
    texts = [r.integers(0, 701, k) for k in (1, 10, 11, 20, 21, 57, 30)]
    got = gru.states_between(w, words, texts, 10, most=3)
    want = []
    for ids in texts:
        h = np.zeros((1, 6), np.float32)
        fed = np.concatenate([[gru.START], words.inputs[ids[:-1]]])
        for t, x in enumerate(fed):
            if t % 10 == 0:
                want.append(h[0].copy())
            h = gru.step(w, np.array([x]), h)[0]
    assert got.shape == (len(want), 6) and np.allclose(got, want, atol=1e-6) and len(gru.pieces(texts, 10)[0]) == len(want)


def test_a_piece_starts_from_the_document_before_it():
    """Training on a long document sees its earlier words: another beginning gives other weights, also where the pieces after it are the same."""
    words, r = small_vocabulary()
    w = gru.start_weights(words, 6)
    gru_piece = gru.PIECE
    try:
        gru.PIECE = 20
        tail = r.integers(0, 701, 20)
        a, b = (gru.states_between(w, words, [np.concatenate([x, tail])], 20)[1] for x in (np.full(20, 3), np.full(20, 9)))
        assert np.abs(a - b).max() > 1e-3
        _, n = gru.train(w, words, [np.concatenate([np.full(20, 3), tail])], most=4)
        assert n == 40
    finally:
        gru.PIECE = gru_piece


def test_passes_go_on_with_their_moments():
    words, r = small_vocabulary()
    w = gru.start_weights(words, 6)
    texts = [r.integers(0, 701, 40) for _ in range(6)]
    moments = gru.Moments.none(w)
    half, _ = gru.train(w, words, texts[:3], most=2, moments=moments)
    steps = moments.steps
    gru.train(half, words, texts[3:], most=2, moments=moments)
    assert 0 < steps < moments.steps and any(np.abs(v).max() > 0 for v in moments.first.values())


def test_softmaxes_by_tokens_not_by_times():
    """A long document among short ones leaves few lanes for thousands of times: they are taken together."""
    live = np.concatenate([np.full(100, 400), np.full(9900, 5)])
    spans = gru.blocks(live)
    assert spans[0][0] == 0 and spans[-1][1] == len(live) and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert len(spans) <= 2 + live.sum() // (1 << 14) * 2 and max(live[a:b].sum() for a, b in spans) <= 1 << 14


def test_cell_is_the_plain_step():
    words, r = small_vocabulary()
    w = gru.start_weights(words, 6)
    cell = gru.Cell(w)
    x, h = r.integers(0, gru.INPUTS, 9), r.standard_normal((9, 6)).astype(np.float32)
    got = [np.empty((k, 9), np.float32) for k in (12, 6, 6)]
    out = cell.step(cell.e[:, x], np.ascontiguousarray(h.T), tuple(got))
    for a, b in zip((out, *got), gru.step(w, x, h), strict=True):
        assert np.allclose(a.T, b, atol=1e-5)


def test_ids_of_words_by_their_beginnings():
    r = np.random.default_rng(3)
    for n in (0, 1, 2, 500):
        some = np.unique(np.concatenate([r.integers(0, 1 << 64, n, np.uint64), np.arange(min(n, 40), dtype=np.uint64)])) if n else np.zeros(0, np.uint64)
        words = gru.Vocabulary(some, r.permutation(len(some)), np.full(len(some), 3), 5000, 1000)
        at = {int(h): int(k) for h, k in zip(words.hashes, words.rank, strict=True)}
        asked = np.concatenate([some, r.integers(0, 1 << 64, 300, np.uint64), np.arange(60, dtype=np.uint64), np.array([(1 << 64) - 1], np.uint64)])
        assert words.ids(asked).tolist() == [at.get(int(h), len(some)) for h in asked]
