"""Redaction by models: windows over a text, tags of tokens or scores of characters, votes where windows overlap, placeholders.

A head scores windows: CharHead gives each character a score, TokenHead tags words as the beginning (B) or the inside (I) of a name or neither (O). All windows of a text are
voted on in the task that holds it.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.blocks import matching_blocks

#: Tags, in the order of a model's scores.
O, B, I = 0, 1, 2  # noqa: E741
#: Windows that are scored at a time.
TOGETHER = 256
TOKEN = re.compile(r"\w+|[^\w\s]")


#: A token and the blanks before it; such pieces follow one another without a gap.
PIECE = re.compile(r"\s*(?:\w+|[^\w\s])")


def tokens(text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words and single other characters that aren't blank, where they start and where they end."""
    pieces = PIECE.findall(text.rstrip())  # blanks without a token after them would be looked through again from each of them
    words = [p.lstrip() for p in pieces]
    ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
    return words, ends - np.fromiter(map(len, words), np.int64, len(words)), ends


def legal_tags(scores: np.ndarray) -> np.ndarray:
    """The tags with the greatest sum of scores (tokens x O, B, I) in which no I comes first or after O; of equals the lower tags."""
    best = scores.argmax(axis=1)
    if not ((best == I) & (np.concatenate([[O], best[:-1]]) == O)).any():
        return best  # the greatest of each token, and legal
    total, back = [scores[0][O], scores[0][B], -np.inf], np.zeros((len(scores), 3), np.int8)
    for t, (o, b, i) in enumerate(scores[1:].tolist(), 1):
        any_tag = max(range(3), key=lambda k: (total[k], -k))
        inside = B if total[B] >= total[I] else I
        back[t] = any_tag, any_tag, inside
        total = [total[any_tag] + o, total[any_tag] + b, total[inside] + i]
    tag = max(range(3), key=lambda k: (total[k], -k))
    out = np.empty(len(scores), np.int64)
    for t in range(len(scores) - 1, -1, -1):
        out[t] = tag
        tag = back[t][tag]
    return out


class Votes:
    """Averages the scores of windows that come by rising start, and keeps the runs of characters whose average reaches the threshold; holds what later windows can reach only."""

    def __init__(self, threshold: float):
        self.threshold, self.base, self.open = threshold, 0, None
        self.sums, self.seen = np.zeros(0), np.zeros(0, np.int32)
        self.spans: list[tuple[int, int]] = []

    def add(self, at: int, scores: np.ndarray) -> None:
        self.settle(at)
        more = at + len(scores) - self.base - len(self.sums)
        if more > 0:
            self.sums, self.seen = np.concatenate([self.sums, np.zeros(more)]), np.concatenate([self.seen, np.zeros(more, np.int32)])
        self.sums[at - self.base : at - self.base + len(scores)] += scores
        self.seen[at - self.base : at - self.base + len(scores)] += 1

    def settle(self, upto: int) -> None:
        n = min(max(0, upto - self.base), len(self.sums))
        yes = (self.seen[:n] > 0) & (self.sums[:n] >= self.threshold * self.seen[:n])
        edges = np.flatnonzero(np.diff(np.concatenate([[self.open is not None], yes]).astype(np.int8)))
        for e in (edges + self.base).tolist():
            if self.open is None:
                self.open = e
            else:
                self.spans.append((self.open, e))
                self.open = None
        self.sums, self.seen = self.sums[n:], self.seen[n:]
        if upto > self.base + n and self.open is not None:  # characters that no window has seen
            self.spans.append((self.open, self.base + n))
            self.open = None
        self.base = max(self.base + n, upto)

    def done(self) -> list[tuple[int, int]]:
        self.settle(self.base + len(self.sums) + 1)
        return self.spans


def vote_windows(windows: DataFrame, threshold: float = 0.5) -> DataFrame:
    """W11. doc, start, stop: runs of characters whose scores, averaged over the windows that hold them, reach the threshold. windows: doc, at, scores.

    A window is one row of the shuffle; a document's windows come to one task by rising start, which holds what they overlap in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, votes = None, None
        for b in batches:
            out: list[tuple] = []
            for d, at, scores in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if votes is None or d != doc:
                    out += [(doc, s, e) for s, e in votes.done()] if votes else []
                    doc, votes = d, Votes(threshold)
                votes.add(at, np.array(scores or [], np.float64))
                out += [(doc, s, e) for s, e in votes.spans]
                votes.spans = []
            yield spans_of(out)
        if votes:
            yield spans_of([(doc, s, e) for s, e in votes.done()])

    def spans_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), *[pa.array([r[i] for r in rows], pa.int32()) for i in (1, 2)]], names=["doc", "start", "stop"])

    sent = windows.select(F.col("doc").cast("long").alias("doc"), F.col("at").cast("int").alias("at"), F.col("scores").cast("array<double>").alias("scores"))
    return sent.repartition("doc").sortWithinPartitions("doc", "at").mapInArrow(run, "doc long, start int, stop int")


def filled(text: str, spans: list[tuple[int, int]]) -> str:
    """[NAME] for each span."""
    out, at = [], 0
    for s, e in spans:
        out += [text[at:s], "[NAME]"]
        at = e
    return "".join(out) + text[at:]


@dataclass
class CharHead:
    """D2. A plug-in that scores the characters of each text; windows of `size` characters, one every `stride`."""

    scorer: Callable[[list[str]], list[list[float]]]
    size: int = 512
    stride: int = 256

    def windows(self, text: str) -> Iterator[tuple[int, str]]:
        for at in range(0, max(1, len(text)), self.stride):
            yield at, text[at : at + self.size]

    def scores(self, windows: list[str]) -> list[np.ndarray]:
        return [np.array(s, np.float64) for s in self.scorer(windows)]


#: Lines of a step of training.
LINES = 16
#: Numbers of a token's features: of the word itself, the one before and the one after.
WIDTH = 1 << 16


#: What a feature's number begins with, at each of the three places.
PLACES = tuple(zlib.crc32(f"{place} ".encode()) for place in (-1, 0, 1))
#: Words whose features a task holds, and tokens that it scores at a time.
KNOWN, SCORED = 200_000, 8192


def shape(word: str) -> str:
    """Kinds of a word's characters without repeats: Xx for Ann, d for 1980."""
    if word.isalpha() and word[1:].islower() and (word[0].islower() or word[0].isupper()):
        return "x" if word[0].islower() else "Xx"
    if word.isdigit():
        return "d"
    return re.sub(r"(.)\1+", r"\1", "".join("X" if c.isupper() else "x" if c.isalpha() else "d" if c.isdigit() else c for c in word))


@dataclass
class TokenHead:
    """F9. Words tagged B, I or O by a linear model over hashed features; windows of `size` tokens, `overlap` of which the next has again."""

    weights: np.ndarray
    size: int = 512
    overlap: int = 64
    known: dict = field(default_factory=dict, repr=False)
    rows: array = field(default_factory=lambda: array("H"), repr=False)
    shared: dict = field(default_factory=dict, repr=False)

    def forget(self) -> None:
        self.known, self.rows, self.shared = {}, array("H"), {}

    def numbers(self, name: str) -> list[int]:
        """Of a feature that many words share, at the three places."""
        got = self.shared.get(name)
        if got is None:
            got = self.shared[name] = [zlib.crc32(name.encode(), p) % WIDTH for p in PLACES]
        return got

    def row(self, word: str) -> int:
        """Where rows has the features of a word at the three places in which it can stand to a token."""
        at = self.known.get(word)
        if at is None:
            at = self.known[word] = len(self.known)
            low = word.lower()
            own = f"w {low}".encode()
            (a, b, c), (d, e, f), (g, h, i), (j, k, l) = (self.numbers(n) for n in (f"s {shape(word)}", f"e {low[-3:]}", f"b {low[:2]}", f"n {min(len(word), 8)} {word[:1].isupper()}"))  # noqa: E741
            x, y, z = PLACES
            self.rows.extend((zlib.crc32(own, x) % WIDTH, a, d, g, j, zlib.crc32(own, y) % WIDTH, b, e, h, k, zlib.crc32(own, z) % WIDTH, c, f, i, l))
        return at

    def features(self, words: list[str]) -> np.ndarray:
        return self.features_of([words])

    def features_of(self, parts: list[list[str]]) -> np.ndarray:
        """Of the tokens of several parts, of which none sees another."""
        if len(self.known) + sum(map(len, parts)) > KNOWN or len(self.shared) > KNOWN:
            self.forget()
        known, row, at = self.known, self.row, [self.row("")]
        for words in parts:
            at += [k if (k := known.get(w)) is not None else row(w) for w in words]
            at.append(at[0])
        every, size = np.frombuffer(self.rows, np.uint16).reshape(-1, 3, 5)[at], np.array([len(p) for p in parts])
        token = np.arange(1, 1 + size.sum()) + np.repeat(np.arange(len(parts)), size)
        return np.concatenate([every[token - 1, 0], every[token, 1], every[token + 1, 2]], axis=1)

    def windows(self, text: str) -> Iterator[tuple[int, tuple[list[str], np.ndarray, np.ndarray]]]:
        words, starts, ends = tokens(text)
        for k in range(0, len(words), self.size - self.overlap):
            yield int(starts[k]), (words[k : k + self.size], starts[k : k + self.size], ends[k : k + self.size])
            if k + self.size >= len(words):
                break

    def scores(self, windows: list[tuple[list[str], np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        out, held, size = [], [], 0
        weights = np.zeros((WIDTH, 4))  # four numbers of a row are taken faster than three
        weights[:, :3] = self.weights
        for k, part in enumerate(windows, 1):
            held.append(part)
            size += len(part[0])
            if size >= SCORED or k == len(windows):
                features = self.features_of([words for words, _, _ in held])
                total = weights.take(features[:, 0], axis=0)
                for f in range(1, features.shape[1]):
                    total += weights.take(features[:, f], axis=0)
                every = log_softmax(total[:, :3])
                for (words, starts, ends), own in zip(held, np.split(every, np.cumsum([len(p[0]) for p in held])[:-1]), strict=True):
                    marks = np.zeros(ends[-1] - starts[0])
                    for t in np.flatnonzero(legal_tags(own) != O).tolist():
                        marks[starts[t] - starts[0] : ends[t] - starts[0]] = 1.0
                    out.append(marks)
                held, size = [], 0
        return out


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = np.ascontiguousarray(x.T)  # numpy works along rows much faster than across short ones
    x -= x.max(axis=0)
    x -= np.log(np.exp(x).sum(axis=0))
    return np.ascontiguousarray(x.T)


def tags_of(text: str, label: str) -> tuple[list[str], np.ndarray]:
    """Words of a text and their tags: names are what the label, with [NAME] in their place, has not; words of one run go on with I."""
    words, tags = TOKEN.findall(text), np.full(len(TOKEN.findall(text)), B, np.int64)
    for x, _, size in matching_blocks(words, TOKEN.findall(label)):
        tags[x : x + size] = O
    tags[1:][(tags[1:] == B) & (tags[:-1] == B)] = I
    return words, tags


def train(labelled: DataFrame, most: int = 4000, rounds: int = 6, rate: float = 0.2) -> TokenHead:
    """A TokenHead from lines (text, label; see redaction.augment), of which the `most` with the least hashes come to the driver. Softmax regression by adaptive gradients, in an order that
    depends on nothing but these lines."""
    sample = labelled.filter("text is not null and label is not null").select("text", "label").orderBy(F.xxhash64("text", "label"), "text", "label").limit(most).collect()
    head = TokenHead(np.zeros((WIDTH, 3)))
    lines = [(head.features(words), tags) for words, tags in (tags_of(r.text, r.label) for r in sample) if words]
    squares = np.full((WIDTH, 3), 1e-2)
    order = np.random.default_rng(1)
    for _ in range(rounds):
        turn = order.permutation(len(lines))
        for k in range(0, len(turn), LINES):
            part = [lines[i] for i in turn[k : k + LINES]]
            x, y = np.concatenate([p[0] for p in part]), np.concatenate([p[1] for p in part])
            wrong = np.exp(log_softmax(head.weights[x].sum(axis=1)))
            wrong[np.arange(len(y)), y] -= 1
            at, inverse = np.unique(x, return_inverse=True)
            step = np.stack([np.bincount(inverse.ravel(), np.repeat(wrong[:, c], x.shape[1]), len(at)) for c in range(3)], axis=1)
            squares[at] += step * step
            head.weights[at] -= rate * step / np.sqrt(squares[at])
    head.forget()
    return head


def redact_with_model(df: DataFrame, head: CharHead | TokenHead, threshold: float = 0.5) -> DataFrame:
    """F9, D2. doc, text, redacted: a text's windows are scored, votes averaged, runs replaced. A null text stays null, one without tokens as it is."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = f["text"].tolist()
            votes = [Votes(threshold) if t is not None else None for t in texts]
            held: list[tuple[int, int, object]] = []

            def score(held: list = held, votes: list = votes) -> None:
                for (i, at, _), s in zip(held, head.scores([w for _, _, w in held]), strict=True):
                    votes[i].add(at, s)
                held.clear()

            for i, t in enumerate(texts):
                for at, window in head.windows(t) if t is not None else ():
                    held.append((i, at, window))
                    if len(held) >= TOGETHER:
                        score()
            score()
            yield f.assign(redacted=[None if v is None else filled(t, v.done()) for t, v in zip(texts, votes, strict=True)])

    kinds = dict(df.dtypes)
    return df.select("doc", "text").mapInPandas(run, f"doc {kinds['doc']}, text string, redacted string")
