"""Decontamination beyond small texts: recall at the edge of the similarity, documents that hold hundreds of items, long texts against brute force."""

import random
import time
from collections import Counter

import numpy as np

from tidemark.llm import decontam

WORDS = [f"w{i}" for i in range(5000)]


def items_of(r, n, size):
    return [(i, " ".join(r.choice(WORDS) for _ in range(size))) for i in range(n)]


def index(items):
    return decontam.Items([(i, decontam.word_hashes(t)) for i, t in items])


def similarity(a, b, k=5):
    x, y = (Counter(decontam.shingle_hashes(decontam.word_hashes(t), k).tolist()) for t in (a, b))
    both = sum((x & y).values())
    return both / (x.total() + y.total() - both)


def test_recall_at_the_edge():
    """Windows of just 0.8 to 0.85: of the pairs that the definition takes, at least 97 in 100 are found, and nothing else."""
    r = random.Random(3)
    items = items_of(r, 300, 120)
    own = index(items)
    texts, want = [], set()
    while len(want) < 600:
        i, t = r.choice(items)
        words = t.split()
        for at in r.sample(range(len(words)), r.choice([2, 3])):
            words[at] = r.choice(WORDS)
        edited = " ".join(words)
        if 0.8 <= similarity(t, edited) <= 0.85:
            want.add((len(texts), i))
            texts.append(" ".join(r.choice(WORDS) for _ in range(40)) + " " + edited + " " + " ".join(r.choice(WORDS) for _ in range(30)))
    found = {(x[0], x[1]) for x in decontam.leaks(texts, own, 0.8)}
    assert len(found & want) >= 0.97 * len(want)
    assert all(max(similarity(items[i][1], " ".join(texts[t].split()[s : s + 120])) for s in range(len(texts[t].split()) - 119)) >= 0.8 for t, i in found - want)


def test_a_document_that_holds_hundreds_of_items():
    r = random.Random(4)
    items = items_of(r, 3000, 60)
    own = index(items)
    began = time.time()
    found = decontam.leaks([" ".join(t for _, t in items[:400])], own, 0.8)
    assert {x[1] for x in found} == set(range(400)) and all(x[5] == 1.0 and x[2] == 60 * x[1] for x in found) and time.time() - began < 20


def test_candidates_are_all_pairs_within_the_radius(monkeypatch):
    r = np.random.default_rng(5)
    own = index(items_of(random.Random(5), 200, 30))
    near = own.fps[r.integers(0, 200, 500)].copy()
    for k in range(len(near)):
        for bit in r.choice(64, int(r.integers(0, 24)), replace=False):
            near[k] ^= np.uint64(1) << np.uint64(bit)
    want = {(w, i) for w in range(len(near)) for i in range(200) if int(near[w] ^ own.fps[i]).bit_count() <= decontam.RADIUS}
    for most in (1, 300, 1 << 20):
        monkeypatch.setattr(decontam, "LOOKED_UP", most)
        assert {(int(w), int(i)) for found in own.candidates(near) for w, i in zip(*found[:2], strict=True)} == want


def test_long_texts_against_all_windows():
    r = random.Random(6)
    items = items_of(r, 12, 40)
    own = index(items)
    parts = []
    for i, t in items[:8]:
        words = t.split()
        words[r.randrange(40)] = "other"
        parts += [" ".join(r.choice(WORDS) for _ in range(700)), " ".join(words) if i % 2 else t]
    text = " ".join(parts)
    words = text.split()
    assert len(text) > 20_000
    best = {i: max(similarity(t, " ".join(words[s : s + 40])) for s in range(len(words) - 39)) for i, t in items}
    got = {x[1]: x[5] for x in decontam.leaks([text], own, 0.8)}
    assert set(got) == {i for i, j in best.items() if j >= 0.8} and all(abs(got[i] - best[i]) < 1e-9 for i in got)
