"""Operators 11 to 13 against plain versions, on awkward rows: nulls, ties, repeats, empty tables, clashing columns."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_llm import ROWS, TEXTS, docs, empty  # noqa: F401
from tidemark.llm import licenses, trie, whiten

DATA = "/root/testdata/sf0.001"


def nodes(rows):
    """The trie by dictionaries of whole prefixes."""
    by, members, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        if conv is not None:
            by[conv].append(((turn is not None, turn or 0), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32], role, text))
    own = {c: [x[2:] for x in sorted(v)] for c, v in by.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(int(c / 100) * 100, [])[:h] + v[h:])
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
            if d:
                children[v[: d - 1]].add(v[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for v in sorted(members, key=len, reverse=True):
        leaves[v] += not children[v]
        saved[v] += (len(members[v]) - 1) * (len(v[-1][1]) if v else 0)
        if v:
            leaves[v[:-1]] += leaves[v]
            saved[v[:-1]] += saved[v]
    ended = lambda v: ",".join(map(str, sorted(c for c in members[v] if len(built[c]) == len(v))))
    return [(min(m), len(v), min(members[v[:-1]]) if v else None, len(m), len(children[v]), leaves[v], saved[v], hashlib.sha256(ended(v).encode()).hexdigest()) for v, m in members.items()]


def awkward_conversations():
    r = random.Random(3)
    said = ["hi", "Hi", "é日", "", None, "long " * 900, "a,b"]
    rows = [(c, t, r.choice(["user", "assistant", None]), r.choice(said)) for c in [*range(0, 60), *range(100, 130), 705, 9, -3] for t in range(r.randrange(9))]
    rows += [(c, t, "user", "same") for c in range(200, 260) for t in range(7)]  # copies of one conversation
    rows += [(c, 0, "user", "same") for c in range(300, 360)] + [(c, 1, "user", str(c)) for c in range(300, 360)]  # a common first turn
    rows += [(5, None, "user", "no turn"), (5, None, None, None), (7, 1, "user", "tie"), (7, 1, "user", "tie"), (7, 1, "assistant", "tie"), (None, 0, "user", "x"), (800, 0, None, None)]
    return rows


@pytest.mark.parametrize("most", [1000, 4, 0])
def test_prefix_trie(spark, most):
    rows = awkward_conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    df = df.select("*", *[F.lit(None).cast("int").alias(c) for c in "pos key size x y n sha top rest first keys sizes block ids opener depth".split()])
    assert sorted(map(repr, map(tuple, trie.prefix_trie(df, most).collect()))) == sorted(map(repr, nodes(rows)))


def test_prefix_trie_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie.prefix_trie(df).count() == 0


def test_prefix_trie_ids_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 7)
    rows = [(c, t, "user", f"t{t}") for c in range(1000, 1250) for t in range(8)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(repr, map(tuple, trie.prefix_trie(df, 10).collect()))) == sorted(map(repr, nodes(rows)))


def test_double_array_against_dictionaries():
    r = random.Random(4)
    paths = [np.array([r.randrange(3), *(r.randrange(40) for _ in range(r.randrange(12)))]) for _ in range(600)]
    built, levels = trie.packed(paths, 40)
    seen = {}
    for i, p in enumerate(paths):
        node = 1
        for d, s in enumerate(p):
            node = int(built.child(np.array([node]), np.array([s]))[0])
            assert node > 1 and levels[d][i] == node
            assert seen.setdefault(tuple(p[: d + 1]), node) == node
    assert len(set(seen.values())) == len(seen)
    inner = [p for p in seen if p + (39,) not in seen]
    assert all(built.child(np.array([seen[p]]), np.array([39]))[0] == 0 for p in inner)


def whitened_plainly(vectors):
    x = np.floor(256 * np.array(vectors, dtype=np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    c = fit - sums / n
    values, q = np.linalg.eigh(c.T @ c / n)
    values, q = values[::-1], q[:, ::-1]
    k = min(4, int((values > 1e-13 * values[0]).sum()))
    return n, ((n * x - sums) ** 2).sum(axis=1), (x - sums / n) @ q[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


@pytest.mark.parametrize("dims", [1, 3, 24, 64])
def test_whitening(spark, dims):
    r = np.random.default_rng(dims)
    vectors = (r.standard_normal((300, dims)) * np.linspace(2, 0.5, dims)).astype(np.float32)
    vectors[50:120] = vectors[0]  # repeats count once
    bad = [None, [], [None] * dims, [float("nan")] * dims, [float("inf")] * dims, [1e30] * dims, [1.0] * (dims + 1)]
    rows = [(i if i else None, v.tolist()) for i, v in enumerate(vectors)] + [(1000 + i, b) for i, b in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3).withColumns({c: F.lit("z") for c in ("x", "n", "component", "i", "scaled vector")})
    got = whiten.whiten(df).toPandas()
    n, deviation, want, explained = whitened_plainly(vectors)
    assert set(got.component) == set(range(1, want.shape[1] + 1)) and len(got) == 300 * want.shape[1] and set(got.n) == {n}
    assert got.identity_error.max() <= 1e-9
    got["vec_id"] = got.vec_id.fillna(0)
    for k in range(want.shape[1]):
        mine = got[got.component == k + 1].sort_values("vec_id")
        values = mine.whitened.to_numpy()
        values = values * np.sign(values @ want[:, k])
        assert np.abs(values - want[:, k]).max() < 1e-8 and np.abs(mine.explained.to_numpy() / explained[k] - 1).max() < 1e-9
        assert mine.deviation.tolist() == deviation.tolist()


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        assert whiten.whiten(spark.createDataFrame(rows, schema)).count() == 0
    flat = whiten.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 2.0])], schema)).collect()
    assert sorted((r.vec_id, r.component, round(abs(r.whitened), 9)) for r in flat) == [(1, 1, 1.0), (2, 1, 1.0)]


def test_deviation_beyond_a_long():
    x = np.array([[1 << 40, 0], [3, 4]])
    sums = np.array([(1 << 40) + 3, 4], dtype=object)
    assert whiten.deviations(x, 2, sums) == [None, None] and whiten.deviations(x[1:], 2, np.array([6, 6], dtype=object)) == [4]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def license_rows(text):
    """Base columns word by word; labels by comparing all pairs of matches."""
    words = WORD.findall((text or "").translate(LOWER))
    base = sorted((i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split())
    line, found = " " + " ".join(words) + " ", []
    for no, rule in enumerate(licenses.standard_rules()):
        if all(any(k.decode() in words for k in group) for group in rule.keywords):
            for m in re.finditer(rule.pattern, line.encode()):
                found.append((rule.priority, m.end() - m.start(), m.start(), m.end(), no, rule.label))
    kept = []
    for f in sorted(found, key=lambda f: (-f[0], -f[1], f[2], f[4])):
        if not any((k[2] <= f[2] and f[3] <= k[3]) or (k[0] > f[0] and f[2] <= k[2] and k[3] <= f[3]) for k in kept):
            kept.append(f)
    best = defaultdict(int)
    for label, p in [(label, 50) for _, label in base] + [(k[5], k[0]) for k in kept]:
        best[label] = max(best[label], p)
    score = 1 - np.prod([1 - p / 100 for p in best.values()])
    starts = [i for i, _ in base]
    return len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in base})), ",".join(sorted(best)), round(float(score), 9)


LICENSES = [
    "This work is licensed under the GNU General Public License, version 2.", "CC BY CC BY-NC 4.0 cc by", "Released under the MIT License. MIT licence mit license", "Licensed under the Apache License, Version 2.0; all\nrights\treserved ALL RIGHTS reserved.",
    "SPDX-License-Identifier: GPL-2.0-or-later", "under the terms of the GNU Lesser General Public License as published, version 2.1", "permission is hereby granted, free of charge, to any person obtaining a copy", "© 2020 copyright 2020 2021 by Ann. tous droits réservés",
    "ALL RIGHTS RESERVEDÉ all rights reserved", "see the LICENSE file for details " * 40, "gpl " * 3000 + "v3", "all rights reserved " * 2000, "creative commons attribution non commercial share alike 4.0, Creative Commons",
]


def test_licenses(docs, spark):  # noqa: F811
    assert 200 <= len(licenses.standard_rules()) <= 400 and len({r.name for r in licenses.standard_rules()}) == len(licenses.standard_rules())
    rows = ROWS + [(5000 + i, t) for i, t in enumerate(LICENSES)] + [(5001, LICENSES[0])]
    df = docs.unionByName(spark.createDataFrame([(5000 + i, t) for i, t in enumerate(LICENSES)] + [(5001, LICENSES[0])], "doc_id long, text string"), allowMissingColumns=True)
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in licenses.digests(licenses.scan(df)).collect()]
    assert sorted(map(repr, got)) == sorted(repr((i, *license_rows(t))) for i, t in rows)


def test_licenses_suppression(spark):
    found = {r.doc_id: [(m.first, m.stop, m.label) for m in r.matches] for r in licenses.scan(spark.createDataFrame(list(enumerate(LICENSES)), "doc_id long, text string")).collect()}
    assert found[0] == [(5, 10, "gpl"), (6, 12, "gpl-2.0")]
    assert found[4] == [(0, 8, "gpl-2.0")]
    assert {x[2] for x in found[12]} == {"cc-by-nc-sa", "cc"}


def test_licenses_settled_against_pairs():
    r = random.Random(8)
    for _ in range(200):
        found = [(s := r.randrange(30), s + r.randrange(1, 9), r.choice([40, 60, 90]), i) for i in range(r.randrange(25))]
        kept = []
        for f in sorted(found, key=lambda f: (-f[2], f[0], -f[1], f[3])):
            if not any((k[0] <= f[0] and f[1] <= k[1]) or (k[2] > f[2] and f[0] <= k[0] and k[1] <= f[1]) for k in kept):
                kept.append(f)
        assert licenses.settled(found) == sorted(kept)


def test_licenses_of_nothing(empty):  # noqa: F811
    assert licenses.digests(licenses.scan(empty)).count() == 0


def test_licenses_leave_prose_alone(spark):
    prose = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    assert licenses.digests(licenses.scan(prose)).filter("score > 0 or n_base > 0 or labels <> ''").count() == 0
