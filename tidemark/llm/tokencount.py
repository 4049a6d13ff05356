"""Token counts of a unigram segmentation, by dynamic programming over a trie of pre-tokens.

The pieces are those of a local rank file; piece r of n has the unigram probability (1 / (r + 1)) / H(n), Zipf's law over the
ranks. A pre-token (a match of the pre-splitting pattern, as UTF-8 bytes) is cut into the pieces whose probabilities
have the largest product; among equal ones into the fewest pieces. Its number of pieces is its count.

The distinct pre-tokens of a batch are walked in byte order, which is a depth-first walk of their trie: the forward
scores of a prefix stay on the stack while pre-tokens that share it follow, so that each node of the trie is scored
once. Counts are stored at the ends of pre-tokens, and kept for later batches of the same task (about MEMO of them).

A blank after another character starts a match, so texts are first cut at single blanks, and only the distinct parts
are split by the pattern.

Defined results: a null text counts as the empty text, of no pre-tokens and no tokens. A null or repeated id is
returned as it is, one row for each row. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.work import bounded_batches, text_or_empty

MEMO = 300_000
#: Where cutting at every blank would cut inside a match: two blanks in one run of white space, or one after other white space that more of it, or the end, follows.
RUNS = re.compile(r" \s* |\s \s|\s \Z")


@lru_cache(maxsize=2)
def pieces(ranks_path: str) -> tuple[dict[bytes, float], frozenset[bytes]]:
    """Log probabilities of the pieces, and all their ends (where to stop looking for longer pieces)."""
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(p): int(r) for p, r in map(bytes.split, f)}
    total = math.log(sum(1 / (r + 1) for r in ranks.values()))
    return {p: -math.log(r + 1) - total for p, r in ranks.items()}, frozenset(p[i:] for p in ranks for i in range(len(p)))


def trie_counts(tokens: Iterable[bytes], logp: dict[bytes, float], ends: frozenset[bytes]) -> Iterator[tuple[bytes, int]]:
    """Each token with its number of pieces; one forward score for each node of the tokens' trie."""
    best, count, before = [0.0], [0], b""
    for token in sorted(tokens):
        shared = len(commonprefix((before, token)))
        del best[shared + 1 :], count[shared + 1 :]
        for i in range(shared + 1, len(token) + 1):
            top, fewest, j = -math.inf, 0, i - 1
            while j >= 0 and (piece := token[j:i]) in ends:
                if (p := logp.get(piece)) is not None:
                    score = best[j] + p
                    if score > top or (score == top and count[j] + 1 < fewest):
                        top, fewest = score, count[j] + 1
                j -= 1
            best.append(top)
            count.append(fewest)
        yield token, count[-1]
        before = token


def count_tokens(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pretokens, n_tokens."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split = regex.compile(pattern).findall
        logp, ends = pieces(ranks_path)
        counts: dict[str, int] = {}  # of pre-tokens
        parts: dict[str, tuple[int, int]] = {}  # of " " + part: pre-tokens and tokens
        for b in batches:
            if len(parts) + len(counts) > MEMO:
                parts.clear()
                counts.clear()
            first, rest = [], []  # pre-tokens of the first part or of the whole text; occurrences of the other parts
            for text in b.column(1).to_pylist():
                words = [text] if RUNS.search(text) else text.split(" ")
                first.append(Counter(split(words[0])))
                rest.append(Counter(words[1:]))
            new = {w: split(" " + w) for c in rest for w in c if w not in parts}
            tokens = {t.encode() for c in (*first, *new.values()) for t in c if t not in counts}
            counts.update((t.decode(), n) for t, n in trie_counts(tokens, logp, ends))
            parts.update((w, (len(found), sum(counts[t] for t in found))) for w, found in new.items())
            pre, n = [], []
            for head, tail in zip(first, rest, strict=True):
                pre.append(head.total() + sum(parts[w][0] * k for w, k in tail.items()))
                n.append(sum(counts[t] * k for t, k in head.items()) + sum(parts[w][1] * k for w, k in tail.items()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pre, pa.int64()), pa.array(n, pa.int64())], names=["doc_id", "n_pretokens", "n_tokens"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
