"""Benchmark decontamination: item-sized windows, SimHash, Hamming blocks, exact weighted similarity.

A document leaks a benchmark item if a window of it, as many words long as the item (the whole document, if it is
shorter), has a weighted Jaccard similarity of `similarity` or more with it over word shingles, repeats counted. Words are
runs of letters, digits and underscores, lower-cased; shingles are five words (fewer in a shorter item).

A window that is similar enough holds so many places of the item's shingles that only windows with that many are looked at.
Each gets a SimHash fingerprint, from running sums over the shingles' bits. The items' fingerprints are indexed by
BLOCKS blocks: of two fingerprints that differ in RADIUS bits or fewer, some block differs in RADIUS // BLOCKS or fewer, so
that looking up all such values of each block finds them all. Candidates within RADIUS are then compared exactly. Two bags that are just
0.8 similar are 9.7 bits apart on average (deviation 2.9), so that 99.4 % of them lie within the radius, and nearly all of 0.85.

Scale: documents are not shuffled. The benchmark goes to the executors in blocks of at most BLOCK_WORDS words, one pass
over the documents for each, one block at a time on the driver; so any size of benchmark is whole, and what is sent at once is bounded.

Defined results: null and blank texts have no words, leak nothing and, as items, are leaked by nothing. Rows with a null
id come out with a null id. Repeated rows each come out. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.work import bounded_batches, text_or_empty, written

SHINGLE, SIMILARITY = 5, 0.8
RADIUS, BLOCKS = 17, 6
EDGES = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
#: Words of the benchmark at a time; items that the windows looked up at a time find in a block.
BLOCK_WORDS, LOOKED_UP = 2_000_000, 1_000_000
WORD = re.compile(r"\w+")
SCHEMA = "doc_id long, item_id long, start_word long, n_words long, hamming int, similarity double"
MIX = np.uint64(0x9E3779B97F4A7C15)
U = np.uint64


def word_hashes(text: str) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, WORD.findall(text.lower())), np.uint64)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k words in a row."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = (out ^ words[j : j + n]) * MIX
        out ^= out >> U(32)
    return out


def bit_votes(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits of each hash."""
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1


def packed(votes: np.ndarray) -> np.ndarray:
    return np.packbits(votes > 0, axis=1).view(">u8").reshape(-1).astype(np.uint64)


class Items:
    """An index of one block of the benchmark."""

    def __init__(self, rows: list[tuple[int, np.ndarray]]):
        self.ids = np.array([i for i, _ in rows], np.int64)
        self.size = np.array([len(w) for _, w in rows], np.int64)
        self.k = np.minimum(SHINGLE, self.size)
        shingles = [shingle_hashes(w, int(k)) for (_, w), k in zip(rows, self.k, strict=True)]
        self.bags = [Counter(s.tolist()) for s in shingles]
        self.fps = np.concatenate([packed(bit_votes(s).sum(axis=0, keepdims=True)) for s in shingles])
        self.by_k = {}
        for k in np.unique(self.k):
            mine = np.flatnonzero(self.k == k)
            flat = np.concatenate([np.unique(shingles[i]) for i in mine])
            owner = np.repeat(mine, [len(np.unique(shingles[i])) for i in mine])
            order = np.argsort(flat, kind="stable")
            keys, first, count = np.unique(flat[order], return_index=True, return_counts=True)
            seen = np.zeros(1 << 20, bool)
            seen[(keys >> U(44)).astype(np.int64)] = True
            self.by_k[int(k)] = (keys, first, count, owner[order], seen)
        self.blocks = []  # of each: its shift and mask, the values in RADIUS // BLOCKS bits, where each value's items start, items by value
        for lo, hi in zip(EDGES, EDGES[1:], strict=False):
            value = ((self.fps >> U(lo)) & U((1 << (hi - lo)) - 1)).astype(np.int64)
            order = np.argsort(value, kind="stable")
            near = [sum(1 << x for x in c) for n in range(RADIUS // BLOCKS + 1) for c in combinations(range(hi - lo), n)]
            self.blocks.append((U(lo), U((1 << (hi - lo)) - 1), np.array(near), np.searchsorted(value[order], np.arange((1 << (hi - lo)) + 1)), order))

    def candidates(self, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Window, item and distance of all pairs within RADIUS bits; so many windows at a time that a block's look-ups find about LOOKED_UP items."""
        step = max(1, LOOKED_UP // max(1, max(len(near) * len(self.ids) >> bits for (_, _, near, _, _), bits in zip(self.blocks, np.diff(EDGES).tolist(), strict=True))))
        for at in range(0, len(fps), step):
            part = fps[at : at + step]
            met = []
            for shift, mask, near, start, order in self.blocks:
                value = (((part >> shift) & mask).astype(np.int64)[:, None] ^ near).reshape(-1)
                size = start[value + 1] - start[value]
                window = np.repeat(np.arange(len(part)), size.reshape(len(part), -1).sum(axis=1))
                item = order[ranges(start[value], size)]
                close = np.bitwise_count(part[window] ^ self.fps[item]) <= RADIUS  # what one block finds is told apart before the blocks are put together
                met.append(window[close] * len(self.ids) + item[close])
            window, item = np.divmod(np.unique(np.concatenate(met)), len(self.ids))
            yield window + at, item, np.bitwise_count(part[window] ^ self.fps[item])


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (length of them), one after the other."""
    total = int(length.sum())
    return np.arange(total) - np.repeat(np.cumsum(length) - length, length) + np.repeat(start, length)


def leaks(texts: list[str], items: Items, similarity: float) -> list[tuple]:
    """(text number, item id, start word, words, distance, similarity) of the best window of each text and item."""
    hashed = [word_hashes(x) for x in texts]
    sizes = np.array([len(w) for w in hashed], np.int64)
    ends = np.cumsum(sizes)
    words = np.concatenate([*hashed, np.empty(0, np.uint64)])
    doc_of = np.repeat(np.arange(len(texts)), sizes)
    out: dict[tuple[int, int], tuple] = {}
    for k, (keys, first, count, owner, seen) in items.by_k.items():
        sh = shingle_hashes(words, k)
        at = np.flatnonzero(seen[(sh >> U(44)).astype(np.int64)])
        at = at[doc_of[at] == doc_of[at + k - 1]]  # shingles don't cross texts
        place = np.minimum(np.searchsorted(keys, sh[at]), len(keys) - 1)
        hit = keys[place] == sh[at]
        at, place = at[hit], place[hit]
        if not len(at):
            continue
        item = owner[ranges(first[place], count[place])]
        at = np.repeat(at, count[place])
        doc = doc_of[at]
        begin = ends[doc] - sizes[doc]
        length = np.minimum(items.size[item], sizes[doc])
        inside = length - k + 1  # shingles of a window
        least = np.ceil(similarity * (inside + items.size[item] - k + 1) / (1 + similarity) - 1e-9).astype(np.int64)
        order = np.lexsort((at, item, doc))
        at, item, doc, begin, length, inside, least = (x[order] for x in (at, item, doc, begin, length, inside, least))
        other = np.arange(len(at)) + least - 1  # the place that makes it enough places from here on
        ok = other < len(at)
        ok[ok] &= (doc[other[ok]] == doc[ok]) & (item[other[ok]] == item[ok]) & (at[other[ok]] - at[ok] < inside[ok])
        if not ok.any():
            continue
        low = np.maximum(at[other[ok]] - inside[ok] + 1, begin[ok])
        length, high = length[ok], np.minimum(at, ends[doc] - length)[ok]
        fits = high >= low
        low, high, length = low[fits], high[fits], length[fits]
        windows = np.unique(np.stack([ranges(low, high - low + 1), np.repeat(length, high - low + 1)], axis=1), axis=0)
        start, length = windows[:, 0], windows[:, 1]
        need = np.zeros(len(sh) + 1, bool)
        delta = np.zeros(len(sh) + 2, np.int64)
        np.add.at(delta, start, 1)
        np.add.at(delta, start + length - k + 1, -1)
        need = np.cumsum(delta)[: len(sh)] > 0
        where = np.cumsum(need) - need
        spots = np.flatnonzero(need)
        fps = np.empty(len(start), np.uint64)
        order = np.argsort(start, kind="stable")
        for lo in range(0, len(order), 20_000):  # running sums over the stretch that these windows cover
            mine = order[lo : lo + 20_000]
            a, b = where[start[mine].min()], where[(start[mine] + length[mine] - k).max()] + 1
            sums = np.zeros((b - a + 1, 64), np.int32)
            np.cumsum(bit_votes(sh[spots[a:b]]), axis=0, out=sums[1:])
            left = where[start[mine]] - a
            fps[mine] = packed(sums[left + length[mine] - k + 1] - sums[left])
        for w, i, d in (y for found in items.candidates(fps) for y in zip(*(x.tolist() for x in found), strict=True)):
            if items.k[i] != k or length[w] != min(items.size[i], sizes[doc_of[start[w]]]):
                continue
            s, n = int(start[w]), int(length[w])
            own, bag = Counter(sh[s : s + n - k + 1].tolist()), items.bags[i]
            both = sum(min(c, bag[x]) for x, c in own.items() if x in bag)
            j = both / (own.total() + bag.total() - both)
            t = int(doc_of[s])
            key = (t, int(items.ids[i]))
            if j >= similarity and (key not in out or (-j, s) < (-out[key][5], out[key][2])):
                out[key] = (t, key[1], s, n, d, j)
    return [(t, i, s - int(ends[t] - sizes[t]), n, d, j) for t, i, s, n, d, j in out.values()]


def blocks(bench: DataFrame, most: int = BLOCK_WORDS) -> Iterator[list[tuple[int, np.ndarray]]]:
    """The items with words, in blocks of bounded size: one partition at a time comes to the driver."""
    block, words = [], 0
    for item_id, text in bench.toLocalIterator():
        hashed = word_hashes(text)
        if not len(hashed) or item_id is None:
            continue
        if block and words + len(hashed) > most:
            yield block
            block, words = [], 0
        block.append((item_id, hashed))
        words += len(hashed)
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id, start_word, n_words, hamming, similarity: the best window of each leaked item in each document."""
    spark = docs.sparkSession
    bounded_batches(spark)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    bench = benchmark.select(F.col(item_col).cast("long").alias("item_id"), text_or_empty(text_col).alias("text"))

    def over(items: Items) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = leaks(b.column(1).to_pylist(), items, similarity)
                ids = b.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
                cols = [pa.array([r[i] for r in rows], t) for i, t in ((1, pa.int64()), (2, pa.int64()), (3, pa.int64()), (4, pa.int32()), (5, pa.float64()))]
                yield pa.RecordBatch.from_arrays([ids, *cols], names=["doc_id", "item_id", "start_word", "n_words", "hamming", "similarity"])

        return narrow.mapInArrow(run, SCHEMA)

    found: list[DataFrame] = []
    index = None
    for block in blocks(bench, block_words):
        if index is not None:  # one pass for each block, so that the driver has one index at a time
            found.append(written(over(index), "leaks"))
        index = Items(block)
    if index is None:
        return spark.createDataFrame([], SCHEMA)
    return reduce(DataFrame.unionByName, [*found, over(index)])
