"""SimHash near-duplicates with a Gray-order hierarchical index.

A fingerprint has 64 bits: bit i is 1 if more than half of the XXH64 hashes (seed 42) of a text's word shingles,
repeats included, have it set. Two different fingerprints link if they differ in `radius` bits or fewer; components are
those of the graph of all links. Nothing is approximate: every link between fingerprints is found.

Scale: equal fingerprints become one row first (so copies cost nothing), then fingerprints are dealt by blocks of their
bits. With radius r and b blocks, b - r blocks of a linked pair agree, so each fingerprint goes to every choice of b - r
blocks; b grows with the number of fingerprints, so that a bucket has about TARGET of them at any size (for radius 4, 5 to 70
rows of 24 bytes a fingerprint up to 10^11 of them). A bucket of more than LIMIT rows is cut into parts, and each pair of parts is a bucket of its own.
The buckets of a task are one hierarchical index: fingerprints by bucket and Gray rank, FANOUT of them to a node, upper nodes
holding the bits that all their members share. Pairs of nodes are compared from the top: a pair without a bucket in common, or
whose shared bits already differ in more than r places, is dropped as a whole, one whose members can't differ in more is linked as
a whole, and one whose members all are in one component is dropped, too. A bucket sends out at most one link for each of its
members, not the pairs.

Defined results: null and blank texts have the fingerprint zero, linked like any other. Rows with the same id share a
component; a null id has a fingerprint and a null component. An empty table gives an empty table. Other columns are
not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.graph import components
from tidemark.llm.work import bounded_batches, discard, words_source, written

SEED = 42
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Fingerprints in a bucket, about; members of a node of the index; pairs compared at a time.
TARGET, FANOUT, PAIRS = 256, 8, 1 << 18
#: Rows that a bucket may have, and that a task indexes together.
LIMIT, HELD = 1 << 16, 1 << 18
#: More documents than this, or this share of all keys, make a shingle a common one.
COMMON, COMMON_SHARE = 1000, 1e-6
#: Bytes of text in a group that one task settles.
TASK_BYTES = 16 << 20


def fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()  # bytes: lowers A-Z only, splits at 0x20 and 0x09-0x0D
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        digest = xxhash.xxh64_intdigest
        hashes = [digest(b" ".join(x), SEED) for x in zip(*(words[i:] for i in range(shingle)))]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long)."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.array([fingerprint(x, shingle) for x in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out.view(np.int64))], names=["doc_id", "fp"])

    return words_source(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def block_count(n: int, radius: int) -> int:
    """The fewest blocks for which a bucket of the b - radius agreeing blocks has about TARGET of n fingerprints."""
    for b in range(radius + 1, 2 * radius + 9):
        if n / 2 ** (64 * (b - radius) // b) <= TARGET:
            return b
    return 2 * radius + 8


def block_masks(b: int, radius: int) -> list[int]:
    edges = [64 * i // b for i in range(b + 1)]
    parts = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(parts, b - radius)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray sequence: the exclusive or of all its right shifts."""
    out = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(s)
    return out


class Sets:
    """Union-find with the smallest member as the root."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        while not np.array_equal(nxt := self.up[self.up], self.up):
            self.up = nxt
        return self.up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Link all a[i] with b[i], in rounds: each root takes the smallest root that it is linked to."""
        while len(a):
            up = self.roots()
            ra, rb = up[a], up[b]
            open_ = ra != rb
            a, b = a[open_], b[open_]
            lo, hi = np.minimum(ra[open_], rb[open_]), np.maximum(ra[open_], rb[open_])
            np.minimum.at(self.up, hi, lo)


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (length of them), one after the other."""
    return np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length) + np.repeat(start, length)


@dataclass
class Level:
    """Nodes of one level, in order: the bits that all members share, the first and last bucket, the smallest and largest size, the first member."""

    pattern: np.ndarray
    mask: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least: np.ndarray
    most: np.ndarray
    start: np.ndarray

    def above(self) -> Level:
        heads = np.arange(0, len(self.pattern), FANOUT)
        ones = np.bitwise_and.reduceat(self.pattern & self.mask, heads)
        zeros = np.bitwise_and.reduceat(~self.pattern & self.mask, heads)
        high = self.high[np.minimum(heads + FANOUT, len(self.high)) - 1]
        return Level(ones, ones | zeros, self.low[heads], high, np.minimum.reduceat(self.least, heads), np.maximum.reduceat(self.most, heads), self.start[heads])


def index_links(bucket: np.ndarray, codes: np.ndarray, radius: int, size: np.ndarray, ratio: float) -> np.ndarray:
    """The root of each row's component, linking rows of one bucket that differ in radius bits or fewer, the smaller of size ratio times the larger or more.

    Rows come by bucket number and Gray rank."""
    n = len(codes)
    sets = Sets(n)
    for step in (1, 2):  # neighbours in Gray order: most of a dense group is one component after this
        near = (np.bitwise_count(codes[step:] ^ codes[:-step]) <= radius) & (bucket[step:] == bucket[:-step])
        near &= np.minimum(size[step:], size[:-step]) >= ratio * np.maximum(size[step:], size[:-step])
        at = np.flatnonzero(near)
        sets.join(at, at + step)
    levels = [Level(codes, np.full(n, 0xFFFFFFFFFFFFFFFF, np.uint64), bucket, bucket, size, size, np.arange(n))]
    while len(levels[-1].pattern) > 1:
        levels.append(levels[-1].above())
    stack = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        depth, a, b = stack.pop()
        level = levels[depth]
        both = level.mask[a] & level.mask[b]
        apart = np.bitwise_count((level.pattern[a] ^ level.pattern[b]) & both)  # accumulated differences of the shared bits
        keep = (apart <= radius) & (level.high[a] >= level.low[b])
        keep &= (level.most[a] >= ratio * level.least[b]) & (level.most[b] >= ratio * level.least[a])
        if depth == 0:
            keep &= a != b
            sets.join(a[keep], b[keep])
            continue
        width = np.diff(np.append(level.start, n))
        whole = keep & (level.low[a] == level.high[b]) & (apart + np.bitwise_count(~both) <= radius)
        whole &= np.minimum(level.least[a], level.least[b]) >= ratio * np.maximum(level.most[a], level.most[b])
        if whole.any():  # one bucket, and all members of both nodes are near each other
            x = np.unique(np.concatenate([a[whole], b[whole]]))
            sets.join(ranges(level.start[x], width[x]), np.repeat(level.start[x], width[x]))
            sets.join(level.start[a[whole]], level.start[b[whole]])
        root = sets.roots()
        least, most = np.minimum.reduceat(root, level.start), np.maximum.reduceat(root, level.start)
        keep &= ~whole & ~((least[a] == most[a]) & (least[b] == most[b]) & (least[a] == least[b]))
        a, b = a[keep], b[keep]
        below = len(levels[depth - 1].pattern)
        for lo in range(0, len(a), PAIRS // FANOUT**2):
            part_a, part_b = a[lo : lo + PAIRS // FANOUT**2], b[lo : lo + PAIRS // FANOUT**2]
            ca = (part_a[:, None] * FANOUT + np.arange(FANOUT)).repeat(FANOUT, axis=1).reshape(-1)
            cb = np.tile(part_b[:, None] * FANOUT + np.arange(FANOUT), (1, FANOUT)).reshape(-1)
            ok = (ca <= cb) & (cb < below)
            stack.append((depth - 1, ca[ok], cb[ok]))
    return sets.roots()


def bucket_links(keys: np.ndarray, codes: np.ndarray, nodes: np.ndarray, radius: int, sizes: np.ndarray | None = None, ratio: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smaller node of its component in its bucket) of rows in any order: each key is a bucket."""
    order = np.lexsort((gray_rank(codes), keys))
    sizes = np.ones(len(codes), np.int64) if sizes is None else sizes[order]
    keys, codes, nodes = keys[order], codes[order], nodes[order]
    new = np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)]
    alone = new & np.append(new[1:], True)[: len(keys)]
    codes, nodes, sizes = codes[~alone], nodes[~alone], sizes[~alone]
    if not len(codes):
        return nodes, nodes
    a = nodes[index_links(np.cumsum(new[~alone]), codes, radius, sizes, ratio)]
    lo, hi = np.minimum(a, nodes), np.maximum(a, nodes)
    return hi[lo != hi], lo[lo != hi]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One link for each node but the smallest of every component that links (a, b) make."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    sets = Sets(len(nodes))
    sets.join(place[: len(a)], place[len(a) :])
    root = nodes[sets.roots()] if len(nodes) else nodes
    return nodes[nodes != root], root[nodes != root]


def dealt(rows: DataFrame, limit: int) -> DataFrame:
    """rows (bucket, fp, node, size) with every bucket of more than limit rows cut into parts by a hash of the node: a row goes to the pairs of its part and each part."""
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > limit)
    large = written(sizes.select("bucket", F.ceil(F.col("n") / limit).cast("int").alias("parts")), "simhash-large-buckets")
    if large.isEmpty():
        return rows
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.xxhash64("bucket", F.least(own, j), F.greatest(own, j)))
    met = rows.join(large, "bucket", "left")
    return met.select(F.explode(F.when(F.col("parts").isNull(), F.array("bucket")).otherwise(tiles)).alias("bucket"), "fp", "node", "size")


def linked(rows: DataFrame, radius: int, ratio: float = 0.0, limit: int | None = None) -> DataFrame:
    """Links (a, b), a > b, between rows (bucket, fp, node, size) of one bucket: enough of them to connect all that differ in radius bits or fewer and in size by ratio at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows_ = 0

        def out() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            key, fp, node, size = (t.column(i).to_numpy() for i in range(4))
            a, b = forest(*bucket_links(key, fp.view(np.uint64), node, radius, size, ratio))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:  # sorted by bucket: hand over what is complete
            if not len(batch):
                continue
            if rows_ + len(batch) > HELD and held:
                last = batch.column(0)[len(batch) - 1].as_py()
                cut = int(np.searchsorted(batch.column(0).to_numpy(), last))
                if cut > 0 or held[-1].column(0)[len(held[-1]) - 1].as_py() != last:
                    held.append(batch.slice(0, cut))
                    yield out()
                    held, rows_ = [], 0
                    batch = batch.slice(cut)
            held.append(batch)
            rows_ += len(batch)
        if held:
            yield out()

    return dealt(rows, limit or LIMIT).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "a long, b long")


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links (a, b), a > b, between rows (fp, node) of distinct fingerprints: enough of them to connect all components."""
    masks = block_masks(block_count(distinct.count(), radius), radius)
    choice = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("part")) for i, m in enumerate(masks)]))
    return linked(distinct.select("fp", "node", choice.alias("c")).select(F.xxhash64("c.i", "c.part").alias("bucket"), "fp", "node", F.lit(1).alias("size")), radius)


def hex16(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def near_duplicates(docs: DataFrame, radius: int = 4, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest id that links reach, its own included)."""
    fps = written(fingerprints(docs, shingle, id_col, text_col), "simhash")
    distinct = written(fps.filter(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash-distinct")
    # the same id on rows with other fingerprints: one document, so one component
    same = fps.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).filter("lo < hi")
    shared = fps.join(same.select("doc_id"), "doc_id", "left_semi").join(distinct, "fp").select(F.col("node").alias("a"), F.col("doc_id").alias("b")).filter("a <> b")
    found = links(distinct, radius).unionByName(shared).distinct()
    comp = components(found)
    by_fp = distinct.join(comp, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return fps.join(by_fp, "fp", "left").select("doc_id", hex16().alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def shingles(text: bytes, shingle: int) -> np.ndarray:
    """The 64-bit hashes of a text's different shingles, ascending; a text of fewer words is one shingle."""
    return np.unique(shingle_hashes(word_hashes(text), shingle))


def word_hashes(text: bytes) -> np.ndarray:
    words = text.lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    k = min(k, len(words)) or 1
    out = np.full(max(len(words) - k + 1, 1), k, np.uint64)
    for j in range(k if len(words) else 0):
        out = (out ^ words[j : j + len(out)]) * MIX
        out ^= out >> np.uint64(29)
    return out


def similarity_of(x: np.ndarray, y: np.ndarray) -> float:
    """Jaccard similarity of two sets of shingles."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def similar(a: bytes, b: bytes, shingle: int) -> float:
    return similarity_of(shingles(a, shingle), shingles(b, shingle))


def prefix_of(hashes: np.ndarray, similarity: float, last: np.ndarray | None = None) -> np.ndarray:
    """The first shingles in the order of their hashes, those of `last` (ascending) after all others, so many that two texts with that similarity always share one."""
    if last is not None and len(last):
        late = last[np.minimum(np.searchsorted(last, hashes), len(last) - 1)] == hashes
        hashes = np.concatenate([hashes[~late], hashes[late]])
    return hashes[: len(hashes) - math.ceil(similarity * len(hashes) - 1e-6) + 1]


def prefix_keys(text: bytes, shingle: int, similarity: float) -> list[int]:
    return prefix_of(shingles(text, shingle), similarity).tolist()


def settle(ids: list[int], texts: list[bytes], shingle: int, similarity: float) -> list[bool]:
    """Which rows of one group (sorted by id) go: those near a row of a smaller id that stays. Rows that share an id go together."""
    sets = [shingles(x, shingle) for x in texts]
    known, flat = np.unique(np.concatenate(sets), return_inverse=True)
    size = np.array([len(x) for x in sets])
    places = np.split(flat, np.cumsum(size)[:-1])  # each row's shingles by their number in the group, in the order of hashes
    marked = np.zeros(len(known), bool)
    kept: dict[int, list[int]] = {}  # key: rows that stay
    out = [False] * len(ids)

    def near(k: int) -> bool:
        met = np.array(sorted({h for x in prefix_of(places[k], similarity).tolist() for h in kept.get(x, ())}), np.int64)
        met = met[np.minimum(size[met], size[k]) >= similarity * np.maximum(size[met], size[k])]
        if not len(met):
            return False
        marked[places[k]] = True
        both = np.add.reduceat(marked[np.concatenate([places[h] for h in met])], np.cumsum(size[met]) - size[met], dtype=np.int64)
        marked[places[k]] = False
        return bool((both / (size[met] + size[k] - both) >= similarity).any())

    at = 0
    while at < len(ids):
        stop = next((k for k in range(at, len(ids)) if ids[k] != ids[at]), len(ids))
        if any(near(k) for k in range(at, stop)):
            out[at:stop] = [True] * (stop - at)
        else:
            for k in range(at, stop):
                for x in prefix_of(places[k], similarity).tolist():
                    kept.setdefault(x, []).append(k)
        at = stop
    return out


def settled(rows: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """doc_id, component_id, near (whether it goes) of rows (doc_id, component_id, text) in groups that fit a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        texts: list[bytes] = []
        group = None

        def out() -> pa.RecordBatch:
            near = settle(ids, texts, shingle, similarity)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([group] * len(ids), pa.int64()), pa.array(near, pa.bool_())], names=["doc_id", "component_id", "near"])

        for b in batches:
            for i, c, text in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if c != group and ids:
                    yield out()
                    ids, texts = [], []
                group = c
                ids.append(i)
                texts.append(text)
        if ids:
            yield out()

    placed = rows.select("doc_id", "component_id", "text").repartition("component_id").sortWithinPartitions("component_id", "doc_id")
    return placed.mapInArrow(run, "doc_id long, component_id long, near boolean")


def keyed(rows: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """doc_id, component_id, key: the prefix keys of rows (doc_id, component_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [np.array(prefix_keys(x, shingle, similarity), np.uint64).view(np.int64) for x in b.column(2).to_pylist()]
            take = pa.array(np.repeat(np.arange(len(keys)), [len(x) for x in keys]))
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(np.concatenate(keys) if keys else [], pa.int64())], names=["doc_id", "component_id", "key"])

    return rows.select("doc_id", "component_id", "text").mapInArrow(run, "doc_id long, component_id long, key long")


def prints(texts: DataFrame, shingle: int, similarity: float, print_words: int, last: np.ndarray | None = None) -> DataFrame:
    """doc_id, digest (128 bits of the text), fp (a SimHash of shingles of print_words words), size (different shingles), keys (prefix keys), in one pass over rows (doc_id, text). last: shingles that come
    last in the order of keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for text in b.column(1).to_pylist():
                words = word_hashes(text)
                own = np.unique(shingle_hashes(words, shingle))
                made.append((xxhash.xxh3_128_digest(text), majority(shingle_hashes(words, print_words)), prefix_of(own, similarity, last).view(np.int64), len(own)))
            fp = np.array([m[1] for m in made], np.uint64).view(np.int64)
            ends = np.cumsum([0, *(len(m[2]) for m in made)])
            keys = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([m[2] for m in made]) if made else [], pa.int64()))
            columns = [b.column(0), pa.array([m[0] for m in made], pa.binary()), pa.array(fp), pa.array([m[3] for m in made], pa.int32()), keys]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "digest", "fp", "size", "keys"])

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id long, digest binary, fp long, size int, keys array<long>")


def copies(rows: DataFrame) -> DataFrame:
    """The ids of rows (doc_id, digest) whose text a smaller id has, too. Ids with several texts are left alone."""
    several = rows.groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).filter("lo < hi").select("doc_id")
    single = rows.join(several, "doc_id", "left_anti")
    # written, so that both sides of the join are plain shuffles, which Spark can split at a text that very many have
    first = written(single.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").select("digest", "first"), "simhash-copied")
    return single.join(first, "digest").filter("doc_id > first").select("doc_id").distinct()


def common_keys(rows: DataFrame) -> np.ndarray:
    """Prefix keys that very many documents have (stock phrases), ascending: at most 1 / COMMON_SHARE. rows: keys."""
    counts = written(rows.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > COMMON), "simhash-key-counts")
    total = rows.agg(F.sum(F.size("keys"))).first()[0] or 0
    common = counts.filter(F.col("n") > total * COMMON_SHARE).select("key").toArrow().column(0).to_numpy()
    discard(counts)
    return np.sort(common.view(np.uint64))


def candidate_groups(rows: DataFrame, radius: int, similarity: float) -> DataFrame:
    """doc_id, component_id of rows (doc_id, fp, size, keys) in groups of more than one: those linked by a prefix key, fingerprints at most radius bits apart and sizes that allow the similarity."""
    found = linked(rows.select(F.explode("keys").alias("bucket"), "fp", F.col("doc_id").alias("node"), "size"), radius, similarity)
    return components(found).select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, radius: int = 12, shingle: int = 5, similarity: float = 0.8, print_words: int = 3, id_col: str = "doc_id", text_col: str = "text", task_rows: int = 8192) -> DataFrame:
    """The ids (doc_id) of documents that go: those near a document of a smaller id, of the same group, that stays.

    Equal texts go first, all but the smallest id. The others are dealt by prefix keys: two texts whose sets of five-word shingles are 0.8
    similar share one of the first fifth of their shingles in the order of hashes, so a document goes to so many buckets, whatever the
    number of documents. Keys that more than COMMON documents have (and a share of COMMON_SHARE of all keys) come last in that order, and all choose their keys anew. In a bucket the Gray-order index links fingerprints (of three-word shingles, which an edit changes less) at most `radius` bits
    apart, where the numbers of shingles allow the similarity; two texts of just 0.8 are 8 to 10 bits apart on average, most pairs are nearer (README has the measured recall).
    Links make groups, and exact comparison settles them. A group of at most task_rows rows is settled in one task, in the order of ids. Of a larger one the
    first task_rows / 2 ids are, and the others are compared with those of them that stay and share a prefix key, which every
    pair that is similar enough does. What is left is split into groups that are linked by prefix keys, and goes through the same, until nothing is left.

    Rows that share an id go together, as soon as one of their texts goes. Rows without an id are not looked at.
    """
    bounded_batches(docs.sparkSession)
    texts = words_source(docs, id_col, text_col).filter("doc_id is not null")
    rows = written(prints(texts, shingle, similarity, print_words), "simhash-prints")
    same = written(copies(rows.select("doc_id", "digest")), "simhash-copies")
    gone = same
    different = written(rows.drop("digest").join(same, "doc_id", "left_anti"), "simhash-different")
    discard(rows)
    last = common_keys(different)
    if len(last):  # one more pass over the texts costs less than to send those that have such a key, which in a large corpus are most
        before, different = different, written(prints(texts, shingle, similarity, print_words, last).drop("digest").join(same, "doc_id", "left_anti"), "simhash-different")
        discard(before)
    open_ = written(candidate_groups(different, radius, similarity), "simhash-open")
    discard(different)
    left = written(texts.join(open_, "doc_id").select("doc_id", "component_id", "text"), "simhash-groups")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = [similar(x, y, shingle) >= similarity for x, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(near, pa.bool_())], names=["doc_id", "near"])

    while True:
        sizes = left.groupBy("component_id").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("bytes"))
        sizes = written(sizes.select("component_id", ((F.col("n") <= task_rows) & (F.col("bytes") <= TASK_BYTES)).alias("small")), "simhash-sizes")
        whole = left.join(sizes.filter("small"), "component_id", "left_semi")
        gone = gone.unionByName(written(settled(whole, shingle, similarity).filter("near").select("doc_id"), "simhash-near"))
        if sizes.filter("not small").isEmpty():
            return gone.distinct()
        large = written(left.join(sizes.filter("not small"), "component_id", "left_semi"), "simhash-large")
        # Spark keeps only the first rows of each task before this shuffle
        place = F.row_number().over(Window.partitionBy("component_id").orderBy("doc_id"))
        front = written(large.select("doc_id", "component_id").distinct().withColumn("place", place).filter(F.col("place") <= max(1, task_rows // 2)).select("doc_id"), "simhash-front")
        judged = written(settled(large.join(front, "doc_id", "left_semi"), shingle, similarity), "simhash-judged")
        gone = gone.unionByName(judged.filter("near").select("doc_id"))
        keys = written(keyed(large, shingle, similarity), "simhash-keys")
        heads = judged.filter("not near").select(F.col("doc_id").alias("head_id")).distinct()
        head_keys = written(keys.withColumnRenamed("doc_id", "head_id").join(heads, "head_id", "left_semi"), "simhash-head-keys")
        rest_keys = written(keys.join(front, "doc_id", "left_anti"), "simhash-rest-keys")
        met = written(rest_keys.join(head_keys, ["component_id", "key"]).select("doc_id", "head_id").distinct(), "simhash-met")
        texts = large.select("doc_id", "text")
        pairs = met.join(texts.select(F.col("doc_id").alias("head_id"), F.col("text").alias("head")), "head_id").join(texts, "doc_id")
        near = written(pairs.select("doc_id", "text", "head").mapInArrow(run, "doc_id long, near boolean").filter("near").select("doc_id").distinct(), "simhash-near")
        gone = gone.unionByName(near)
        rest_keys = written(rest_keys.join(near, "doc_id", "left_anti"), "simhash-rest-keys")
        lowest = written(rest_keys.groupBy("component_id", "key").agg(F.min("doc_id").alias("low")), "simhash-lowest")
        together = rest_keys.join(lowest, ["component_id", "key"]).filter("low < doc_id").select(F.col("doc_id").alias("a"), F.col("low").alias("b")).distinct()
        parts = components(together).select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))
        before, left = left, written(texts.join(parts, "doc_id").select("doc_id", "component_id", "text"), "simhash-groups")  # one with no link stays
        discard(before, large, keys, head_keys, rest_keys, met)
