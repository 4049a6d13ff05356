"""Language-model scores of whole documents: corpus counts and a gated recurrent model.

Tokens are the words of a text (runs of bytes other than blanks, A-Z lower-cased), then one end token. Counts come from all
training documents. The recurrent model (gru.py) gives the class of each token from the state, which runs through the
whole document; head classes give their words from the state too, middle classes by the corpus counts, and the last
class gives a word (c + 1) / (tokens + words + 1) of that class, with c its count (0: unknown words share one place).

Scale: counts are summed on the executors before and after a shuffle. The vocabulary of the head and middle classes goes
to all executors: at most KNOWN words, seen at least SEEN times. Other words of a document meet their counts by a
join; none of them is frequent, so no key of it is hot. The model learns from all training documents, once each: in each of ROUNDS rounds,
tasks of about TRAINER_TOKENS tokens (TRAINERS of them at least) pass over their parts, and their weights are averaged, in tasks as long as
there are more than FAN_IN of them.

Defined results: a null text counts as the empty text, with one token, the end. A null id has no fold: its row is scored and not learnt
from, and held_out is null. Repeated rows are scored each. Without training documents all tokens are unknown and base_score is 0
a token. Other columns are not looked at. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import gru
from tidemark.llm.work import apart, bounded_batches, text_or_empty, written

KNOWN, SEEN = 200_000, 3
HIDDEN, ROUNDS, TRAINERS, FAN_IN = 16, 4, 6, 64
TRAINER_TOKENS, PASS_TOKENS = 4_000_000, 500_000
GATHER = 8 << 20
END = xxhash.xxh3_64_intdigest(b"\n")  # no word has a line end


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 7


def token_hashes(text: bytes) -> np.ndarray:
    words = text.lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8")
    out[-1] = END
    return out


def gathered(batches: Iterator[pa.RecordBatch], most: int = GATHER) -> Iterator[tuple[list[pa.RecordBatch], list[np.ndarray]]]:
    held, hashed, size = [], [], 0
    for b in batches:
        if not len(b):
            continue
        texts = b.column(b.num_columns - 1).to_pylist()
        held.append(b)
        hashed += [token_hashes(x) for x in texts]
        size += sum(map(len, texts))
        if size > most:
            yield held, hashed
            held, hashed, size = [], [], 0
    if held:
        yield held, hashed


def ids_of(words: gru.Vocabulary, hashed: list[np.ndarray]) -> list[np.ndarray]:
    return np.split(words.ids(np.concatenate(hashed)), np.cumsum([len(h) for h in hashed])[:-1])


def count_words(docs: DataFrame) -> DataFrame:
    """word (hash), n: over all rows (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, hashed in gathered(batches):
            word, n = np.unique(np.concatenate(hashed), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], names=["word", "n"])

    return docs.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> gru.Vocabulary:
    """The most frequent words, at most KNOWN of them, and the totals over all."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.filter(F.col("n") >= SEEN).orderBy(F.desc("n"), "word").limit(KNOWN).select("word", "n").toArrow()
    word, n = top.column(0).to_numpy().view(np.uint64), top.column(1).to_numpy()
    order = np.argsort(word)
    return gru.Vocabulary(word[order], order.astype(np.int64), n, int(total), int(distinct))


def train(docs: DataFrame, words: gru.Vocabulary, seed: int = 7) -> bytes:
    """Weights after ROUNDS of averaging. docs: (doc_id, text) of the training documents."""
    weights = gru.pack(gru.start_weights(words, HIDDEN, seed))
    if not words.total:
        return weights
    trainers = int(max(TRAINERS, words.total / ROUNDS / TRAINER_TOKENS))

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, hashed in gathered(batches):
            ids_ = pa.array([x.astype("<i4").tobytes() for x in ids_of(words, hashed)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([b.column(0) for b in held]), ids_], names=["doc_id", "ids"])

    learnt = docs.mapInArrow(ids, "doc_id long, ids binary")
    mixed = F.xxhash64(F.col("doc_id"), F.lit(seed + 1))
    learnt = written(learnt.withColumn("round", F.pmod(mixed, F.lit(ROUNDS)).cast("int")).withColumn("trainer", F.pmod(F.shiftright(mixed, 8), F.lit(trainers)).cast("int")), "gru-learnt")
    for r in range(ROUNDS):
        now = gru.unpack(weights, HIDDEN)

        def run(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            w, trainer, seen, docs_, size = now, None, 0, [], 0
            moments = gru.Moments.none(now)

            def out() -> pa.RecordBatch:
                v, n = gru.train(w, words, docs_, moments=moments)
                return weight_rows([(trainer, gru.pack(v), seen + n)] if seen + n else [])

            for b in batches:
                for t, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    if t != trainer:
                        if trainer is not None:
                            yield out()
                        w, trainer, seen, docs_, size, moments = now, t, 0, [], 0, gru.Moments.none(now)
                    docs_.append(np.frombuffer(x, "<i4").astype(np.int64))
                    size += len(docs_[-1])
                    if size > PASS_TOKENS:
                        w, n = gru.train(w, words, docs_, moments=moments)
                        seen, docs_, size = seen + n, [], 0
            if trainer is not None:
                yield out()

        mine = learnt.filter(F.col("round") == r).repartitionById(trainers, "trainer").sortWithinPartitions("trainer", "doc_id", "ids").select("trainer", "ids")
        done, parts = mine.mapInArrow(run, WEIGHTS), trainers
        while parts > FAN_IN:
            parts = -(-parts // FAN_IN)
            done = done.withColumn("trainer", (F.col("trainer") / FAN_IN).cast("int")).repartitionById(parts, "trainer").sortWithinPartitions("trainer", "n", "weights").mapInArrow(merged, WEIGHTS)
        # at most FAN_IN rows, put in order here: a sort in Spark would run the trainers once more to sample them
        for last in merged(done.toArrow().sort_by("trainer").to_batches()):
            weights = last.column(1)[0].as_py() if len(last) else weights
    return weights


WEIGHTS = "trainer int, weights binary, n long"


def weight_rows(rows: list[tuple[int, bytes, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.int64()))], names=["trainer", "weights", "n"])


def merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row: the mean of all weights, each counted by its tokens."""
    total, n, first = 0.0, 0, None
    for b in batches:
        for t, x, k in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            total, n, first = total + k * np.frombuffer(x, "<f4").astype(np.float64), n + k, t if first is None else first
    yield weight_rows([(first, (total / n).astype("<f4").tobytes(), n)] if n else [])


ROW = "struct<doc_id:bigint,n_tokens:bigint,n_known:bigint,n_tail:bigint,known_log:double,model_log:double>"


def partial_rows(docs: DataFrame, words: gru.Vocabulary, weights: bytes) -> DataFrame:
    """row, word, n (of rarer words in a row), head: a row's own sums, beside the first of its words."""
    kinds = pa.struct([("doc_id", pa.int64()), *((k, pa.int64()) for k in ("n_tokens", "n_known", "n_tail")), ("known_log", pa.float64()), ("model_log", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = gru.unpack(weights, HIDDEN)
        logs = np.append(np.log10(words.counts + 1.0), 0)
        for held, hashed in gathered(batches):
            row = np.concatenate([b.column(0).to_numpy() for b in held])
            doc = pa.concat_arrays([b.column(1) for b in held])
            ids = ids_of(words, hashed)
            model = gru.score(w, words, ids) / gru.LN10
            size = np.array([len(h) for h in hashed])
            owner = np.repeat(np.arange(len(row)), size)
            flat, all_ids = np.concatenate(hashed), np.concatenate(ids)
            known = np.bincount(owner, weights=all_ids < len(words.counts), minlength=len(row)).astype(np.int64)
            known_log = np.bincount(owner, weights=logs[all_ids], minlength=len(row))
            rare = all_ids == len(words.counts)
            # a row without rarer words has one that is none, under a hash of its own
            own, hash_ = np.concatenate([np.arange(len(row)), owner[rare]]), np.concatenate([np.zeros(len(row), np.uint64), flat[rare]])
            (at, word), n = pairs(own, hash_)
            first = np.concatenate(([True], at[1:] != at[:-1]))
            count = np.where(first, 0, n)
            key = np.where(first, row[at].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15), word)
            cols = [doc, pa.array(size), pa.array(known), pa.array(size - known), pa.array(known_log), pa.array(model)]
            heads = pa.StructArray.from_arrays(cols, fields=list(kinds))
            take = np.where(first, at, -1)
            head = heads.take(pa.array(take, pa.int64(), mask=take < 0))
            yield pa.RecordBatch.from_arrays([pa.array(row[at]), pa.array(key.view(np.int64)), pa.array(count), head], names=["row", "word", "n", "head"])

    return docs.mapInArrow(run, f"row long, word long, n long, head {ROW}")


def pairs(owner: np.ndarray, word: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Different (owner, word) in order, and how often each comes. The first of each owner is its word 0."""
    order = np.lexsort((word, owner))
    o, w = owner[order], word[order]
    edge = np.flatnonzero(np.concatenate(([True], (o[1:] != o[:-1]) | (w[1:] != w[:-1]))))
    return (o[edge], w[edge]), np.diff(np.append(edge, len(o)))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities of whole texts)."""
    bounded_batches(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("text"))
    learning = own.filter(fold(F.col("doc_id")) != 2)
    # a row's name depends on nothing but the row, so that a task that is tried again gives the same
    named, _ = apart(own.withColumn("own id", F.col("doc_id")))
    named = named.select(F.coalesce("doc_id", F.xxhash64("text")).alias("row"), F.col("own id").alias("doc_id"), "text")
    counts = written(count_words(learning), "word-counts")
    words = vocabulary(counts)
    weights = train(learning, words)
    rows = partial_rows(named, words, weights)
    rare = counts.select("word", F.col("n").alias("c"))
    if len(words.counts):
        last = int(words.counts[-1])
        rare = rare.filter(F.col("c") <= last)  # the others are in the vocabulary
    met = rows.join(rare, "word", "left")
    log_c = F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)
    sums = met.groupBy("row").agg(F.max("head").alias("h"), F.count("head").alias("copies"), F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("seen"), F.sum(log_c).alias("rare_log"))
    # equal rows have one name: each has the same share of the sums, and gets a row of its own
    sums = sums.select("h", (F.col("seen") / F.col("copies")).cast("long").alias("seen"), (F.col("rare_log") / F.col("copies")).alias("rare_log"), F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"))
    n = F.col("h.n_tokens")
    base = F.col("h.known_log") + F.col("rare_log") - n * F.lit(float(np.log10(words.total + words.distinct + 1)))
    model = F.col("h.model_log") + F.col("rare_log") - F.col("h.n_tail") * F.lit(float(np.log10(words.tail_total + words.tail_distinct + 1)))
    return sums.select(
        F.col("h.doc_id").alias("doc_id"), (fold(F.col("h.doc_id")) == 2).alias("held_out"), n.alias("n_tokens"), (F.col("h.n_known") + F.col("seen")).alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"), base.alias("base_score"), model.alias("score"),
    )
