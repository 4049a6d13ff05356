"""Quality classifier: a linear-chain conditional random field labels every line good or bad.

The features of a line describe its bytes and words (shares of character kinds, repeated words, lengths), and stand
beside those of the line before and after it. Forward-backward gives each line's marginal probability of being good;
the document's score is the mean of the marginals, weighted by the lines' lengths.

Training takes labelled documents in the order of a hash of their id, whole, until there are `most` of them (4000) or `most_lines`
lines in all (200,000): a classifier's bounded sample. Their lines carry the document's label. The weights are fitted on the
driver by gradient steps in numpy from the features that Spark has computed; scoring runs over all documents, whole texts.

Defined results: a null text counts as the empty text, one empty line, and has a score as any other. Documents without
a label are scored, too. Rows with a null id are scored and not learnt from. Of several labels of a document the
smallest holds, and of several texts of an id the smallest is learnt from. Without labelled documents, or with one kind only, every score is that kind's share (0.5 for none).
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.work import bounded_batches, words_source

MOST, MOST_LINES = 4000, 200_000
UPPER = bytes(range(65, 91))
LETTERS = bytes([*range(65, 91), *range(97, 123)])
DIGITS = b"0123456789"
SYMBOLS = b"#$%&*@^~+=<>_{}[]\\/"
STOPS = b".,;:?'\"()-"
HIGH = bytes(range(128, 256))
NAMES = ["upper", "letters", "digits", "symbols", "stops", "high", "bang", "bar", "blank", "same_word", "distinct_words", "word_length", "log_words", "log_bytes", "ends_stop"]


def line_features(line: bytes) -> list[float]:
    n = len(line)
    if not n:
        return [0.0] * len(NAMES)
    words = line.split()
    k = len(words)

    def share(kinds: bytes) -> float:
        return (n - len(line.translate(None, kinds))) / n

    same = sum(map(eq, words, words[1:])) / k if k else 0.0
    distinct = len(set(words)) / k if k else 0.0
    return [
        share(UPPER), share(LETTERS), share(DIGITS), share(SYMBOLS), share(STOPS), share(HIGH), line.count(b"!") / n, line.count(b"|") / n,
        line.count(b" ") / n, same, distinct * min(1.0, k / 20), min(n / k, 40) / 10 if k else 0.0, np.log1p(k), np.log1p(n), float(line.rstrip()[-1:] in STOPS),
    ]


def document_lines(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Features (lines x NAMES) and lengths of all lines."""
    lines = text.split(b"\n")
    return np.array([line_features(x) for x in lines], np.float32), np.array([len(x) + 1 for x in lines], np.float64)


def stacked(features: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each line's features, those of the line before and after it in its document (zeros at the ends), and 1."""
    ends = np.cumsum(sizes)
    before, after = np.roll(features, 1, axis=0), np.roll(features, -1, axis=0)
    before[ends - sizes] = 0
    after[ends - 1] = 0
    return np.concatenate([features, before, after, np.ones((len(features), 1), features.dtype)], axis=1)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the stacked features, for good against bad
    stay: np.ndarray  # score of a good line after a good one, of a bad one after a bad one
    constant: float | None = None

    def potentials(self, features: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return stacked((features - self.mean) / self.scale, sizes) @ self.weights



def forward_backward(score: np.ndarray, sizes: np.ndarray, stay: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Marginal of good, of good after good, of bad after bad (for each line), and the sum of the log partition functions.

    score: of good for each line, documents one after the other, bad has 0. Documents advance in step, longest first.
    """
    gg, bb = stay
    order = np.argsort(-sizes, kind="stable")
    start = (np.cumsum(sizes) - sizes)[order]
    size = sizes[order]
    n = len(score)
    fg, fb, bg, bbk = (np.zeros(n) for _ in range(4))  # log messages
    live = [int(np.searchsorted(-size, -t, side="left")) for t in range(int(size.max()) if len(size) else 0)]
    for t, m in enumerate(live):
        at = start[:m] + t
        if t == 0:
            fg[at], fb[at] = score[at], 0
        else:
            fg[at] = score[at] + np.logaddexp(fg[at - 1] + gg, fb[at - 1])
            fb[at] = np.logaddexp(fg[at - 1], fb[at - 1] + bb)
    for t in range(len(live) - 1, 0, -1):
        at = start[: live[t]] + t
        bg[at - 1] = np.logaddexp(gg + score[at] + bg[at], bbk[at])
        bbk[at - 1] = np.logaddexp(score[at] + bg[at], bb + bbk[at])
    ends = np.cumsum(sizes) - 1
    total = np.logaddexp(fg[ends], fb[ends])
    each = np.repeat(total, sizes)
    good = np.exp(fg + bg - each)
    pair_g, pair_b = np.zeros(n), np.zeros(n)
    first = np.zeros(n, bool)
    first[np.cumsum(sizes) - sizes] = True
    at = np.flatnonzero(~first)
    pair_g[at] = np.exp(fg[at - 1] + gg + score[at] + bg[at] - each[at])
    pair_b[at] = np.exp(fb[at - 1] + bb + bbk[at] - each[at])
    return good, pair_g, pair_b, float(total.sum())


def fit(docs: list[tuple[np.ndarray, int]], steps: int = 150, rate: float = 0.1, shrink: float = 1e-3) -> Model:
    """Maximise the likelihood of the line labels (each the document's), by Adam, every document of the same weight for its kind."""
    labels = np.array([y for _, y in docs])
    width = len(NAMES)
    if not len(docs) or labels.min() == labels.max():
        return Model(np.zeros(width), np.ones(width), np.zeros(3 * width + 1), np.zeros(2), float(labels.mean()) if len(docs) else 0.5)
    sizes = np.array([len(x) for x, _ in docs])
    features = np.concatenate([x for x, _ in docs]).astype(np.float64)
    model = Model(features.mean(axis=0), features.std(axis=0) + 1e-6, np.zeros(3 * width + 1), np.zeros(2))
    x = stacked((features - model.mean) / model.scale, sizes)
    y = np.repeat(labels, sizes).astype(np.float64)
    first = np.zeros(len(y), bool)
    first[np.cumsum(sizes) - sizes] = True
    same = ~first  # labels don't change inside a document
    weight = np.repeat(1 / sizes, sizes)  # a document counts once, however long
    theta = np.zeros(len(model.weights) + 2)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        good, pair_g, pair_b, _ = forward_backward(x @ theta[:-2], sizes, theta[-2:])
        g = np.empty_like(theta)
        g[:-2] = x.T @ ((y - good) * weight) / len(docs) - shrink * theta[:-2]
        g[-2] = (((y == 1) & same) - pair_g) @ weight / len(docs) - 0.1 * theta[-2]
        g[-1] = (((y == 0) & same) - pair_b) @ weight / len(docs) - 0.1 * theta[-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model.weights, model.stay = theta[:-2].copy(), theta[-2:].copy()
    return model


def scores(texts: list[bytes], model: Model) -> tuple[list[float], list[int], list[int]]:
    """Score, number of lines and number of good lines of each text."""
    if model.constant is not None:
        n = [x.count(b"\n") + 1 for x in texts]
        return [model.constant] * len(texts), n, n if model.constant >= 0.5 else [0] * len(texts)
    rows = [document_lines(x) for x in texts]
    sizes = np.array([len(f) for f, _ in rows])
    good, *_ = forward_backward(model.potentials(np.concatenate([f for f, _ in rows]).astype(np.float64), sizes), sizes, model.stay)
    length = np.concatenate([n for _, n in rows])
    start = np.cumsum(sizes) - sizes
    score = np.add.reduceat(good * length, start) / np.add.reduceat(length, start)
    fine = np.add.reduceat((good >= 0.5).astype(np.int64), start)
    return np.clip(score, 0, 1).tolist(), sizes.tolist(), fine.tolist()


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MOST, most_lines: int = MOST_LINES) -> list[tuple[np.ndarray, int]]:
    """Line features and label of the sampled documents; the sample's ids are few enough to send to every executor."""
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.filter(~held_out(F.col("doc_id")))
    order = F.xxhash64("doc_id"), F.col("doc_id")
    chosen = dict(known.orderBy(*order).limit(most).select("doc_id", "quality").toArrow().to_pandas().itertuples(index=False, name=None))
    ids = pa.array(list(chosen), pa.int64())

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for b in batches:
            yield b.filter(pc.is_in(b.column(0), ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed = pa.array([document_lines(x)[0].tobytes() for x in b.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), packed], names=["doc_id", "lines"])

    picked = docs.filter(F.col("doc_id").isNotNull()).mapInArrow(pick, "doc_id long, text binary").groupBy("doc_id").agg(F.min("text").alias("text"))
    out: list[tuple[np.ndarray, int]] = []
    lines = 0
    for i, packed in picked.mapInArrow(run, "doc_id long, lines binary").orderBy(*order).toLocalIterator():
        if lines >= most_lines:
            break
        out.append((np.frombuffer(packed, np.float32).reshape(-1, len(NAMES)), int(chosen[i])))
        lines += len(out[-1][0])
    return out


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, most: int = MOST) -> Model:
    bounded_batches(docs.sparkSession)
    return fit(training_rows(words_source(docs), labels, most))


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1, higher is better), n_lines, n_good_lines."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            score, n, fine = scores(b.column(1).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score, pa.float64()), pa.array(n, pa.int64()), pa.array(fine, pa.int64())], names=["doc_id", "score", "n_lines", "n_good_lines"])

    return words_source(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double, n_lines long, n_good_lines long")


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose text scores threshold or more."""
    bounded_batches(docs.sparkSession)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                score, _, _ = scores(b.column(b.num_columns - 1).to_pylist(), model)
                kept = b.take(pa.array([i for i, x in enumerate(score) if x >= threshold], pa.int64()))
                yield pa.RecordBatch.from_arrays(kept.columns[:-1], names=names)

    return docs.select("*", F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("scored_text")).mapInArrow(run, docs.schema)
