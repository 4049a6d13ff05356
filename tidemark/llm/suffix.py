"""Substring dedup: repeated word sequences, found in prefix-partitioned suffix trees.

A window is `least` words in a row of one document (words: runs of bytes other than blanks, unchanged). A word goes if it lies in
a window whose words also start earlier: in a document with a smaller id, or earlier in the same one.

1. Anchors. Of the `least // 2 + 1` hashes of `least // 2` words that lie in a window, the smallest (the last among equals) is
   its anchor. Equal windows have equal anchors, so a window whose anchor occurs once in all texts is unique. Anchors are
   about a sixth as many as windows. A whole text is one more anchor, which tells exact copies.
2. Pieces. Windows in a row with one anchor travel as one piece of text, filed under the anchor, so that
   the network carries four to five words for each suffix instead of `least`.
3. Prefixes. All suffixes of an anchor's pieces, cut after `least` words, meet in one task. They are split by
   their first word, groups that are still too large by their second, and so on: variable-length prefixes, until a group has
   GROUP suffixes or fewer or the prefix is `least` words long.
4. Subtrees. One walk over a group's sorted suffixes goes through its suffix tree: the common prefix of neighbours gives the
   depth of the inner nodes, and a node `least` words deep or more is a repeat, whose leaves are all its places.
   All leaves but the first in (document, start) order are repeats of earlier ones; consecutive ones
   merge to maximal repeats when they meet their document again.

Scale: each task sends one anchor row for each value and one piece for each text of a piece, however often it saw it; what it
saw twice is known to repeat. So a passage that a third of all documents share crosses the network once for each task.
Texts are shuffled once. Exact copies are settled by step 1.

Defined results: a null or blank text has no words. A row with a null id is neither compared nor changed. Rows that share
an id and a text are one document; different texts of one id are documents of their own, one after the other by a hash of the text. Windows are compared by their words, anchors and whole copies by 64-bit hashes. Other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.work import apart, bounded_batches, words_source, written

U = np.uint64
MIX = U(0xC2B2AE3D27D4EB4F)
#: Bytes of text whose anchors or suffixes a task gathers before it hands them on.
GATHER = 24 << 20
GROUP = 5000


def sequence_hashes(words: np.ndarray, k: int) -> np.ndarray:
    n = len(words) - k + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(k if n > 0 else 0):
        out = (out ^ words[j : j + n]) * MIX
        out ^= out >> U(31)
    return out


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def anchors(hashes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every least // 2 words, and for each window the place of its anchor among these."""
    k = max(1, least // 2)
    grams = sequence_hashes(hashes, k)
    wide = least - k + 1
    if len(grams) < wide:
        return grams, np.empty(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, wide)
    return grams, np.arange(len(view)) + wide - 1 - view[:, ::-1].argmin(axis=1)


def by_key(key: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the different rows by (key, doc, at), and where each key's first one is."""
    order = np.lexsort((at, doc, key))
    k, d, a = key[order], doc[order], at[order]
    order = order[np.concatenate(([True], (k[1:] != k[:-1]) | (d[1:] != d[:-1]) | (a[1:] != a[:-1])))]
    k = key[order]
    return order, np.concatenate(([True], k[1:] != k[:-1]))


WHOLE = -1  # the place of a whole text


def anchor_rows(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """key, doc_id, at, known (the key has several places here), pass (this isn't the first of them, and needn't be met by key)."""
    names = ["key", "doc_id", "at", "known", "pass"]
    key, doc, at, size = [], [], [], 0

    def out() -> pa.RecordBatch:
        k, d, a = np.concatenate(key), np.concatenate(doc), np.concatenate(at)
        order, head = by_key(k, d, a)
        k, d, a = k[order], d[order], a[order]
        group = np.cumsum(head) - 1
        many = np.bincount(group)[group] > 1
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (k.view(np.int64), d, a, many, ~head)], names=names)

    for b in batches:
        for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            words = text.split()
            if len(words) < least:
                continue
            grams, chosen = anchors(word_hashes(words), least)
            chosen = np.unique(chosen)
            key.append(np.append(grams[chosen], U(xxhash.xxh3_64_intdigest(text, seed=7))))
            doc.append(np.full(len(chosen) + 1, i, np.int64))
            at.append(np.append(chosen, WHOLE).astype(np.int32))
            size += len(text)
        if size > GATHER:
            yield out()
            key, doc, at, size = [], [], [], 0
    if key:
        yield out()


def repeated_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, at: anchors with several places, and WHOLE for texts that an earlier document has, too. Rows come sorted by key, first places first."""
    held = None  # the open key's rows

    def done(k: np.ndarray, d: np.ndarray, a: np.ndarray, known: np.ndarray, passed: np.ndarray) -> pa.RecordBatch:
        head = np.concatenate(([True], k[1:] != k[:-1]))
        group = np.cumsum(head) - 1
        first = np.flatnonzero(head)[group]
        other = (d != d[first]) | (a != a[first])
        many = np.bincount(group, weights=known | other) > 0
        keep = passed | np.where(a == WHOLE, d != d[first], many[group])
        return pa.RecordBatch.from_arrays([pa.array(d[keep]), pa.array(a[keep])], names=["doc_id", "at"])

    for b in batches:
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        if held is not None:
            cols = [np.concatenate([x, y]) for x, y in zip(held, cols, strict=True)]
        if not len(cols[0]):
            continue
        cut = int(np.searchsorted(cols[0], cols[0][-1]))
        if cut:
            yield done(*(x[:cut] for x in cols))
        held = [x[cut:] for x in cols]
    if held is not None and len(held[0]):
        yield done(*held)


def piece_rows(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """key (the anchor), doc_id, start, stop (starts of the windows), piece; without a piece, windows known to repeat earlier ones."""
    names = ["key", "doc_id", "start", "stop", "piece"]
    held: list[tuple[int, bytes, list[int]]] = []
    size = 0

    def out() -> pa.RecordBatch:
        seen: dict[bytes, tuple[int, int]] = {}
        made = []
        for i, text, places in sorted(held, key=lambda x: x[0]):
            words = text.split()
            hashes = word_hashes(words)
            grams, chosen = anchors(hashes, least)
            again = np.zeros(len(hashes), bool)
            again[places] = True
            starts = np.flatnonzero(again[chosen])
            if not len(starts):
                continue
            own = chosen[starts]
            edge = np.flatnonzero(np.concatenate(([True], (starts[1:] != starts[:-1] + 1) | (own[1:] != own[:-1]))))
            plain = b" ".join(words)
            at = np.concatenate(([0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)))
            a, z = starts[edge], starts[np.append(edge[1:], len(starts)) - 1] + 1
            for key, s, e, lo, hi in zip(grams[own[edge]].view(np.int64).tolist(), a.tolist(), z.tolist(), at[a].tolist(), (at[z + least - 1] - 1).tolist(), strict=True):
                piece = plain[lo:hi]
                if piece in seen:
                    if seen[piece] != (i, s):
                        made.append((xxhash.xxh3_64_intdigest(piece, seed=s) >> 1, i, s, e, None))
                else:
                    seen[piece] = (i, s)
                    made.append((key, i, s, e, piece))
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], t) for k, t in enumerate(types)], names=names)

    for b in batches:
        for i, text, places in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            if places[0] != WHOLE:
                held.append((i, text, places))
                size += len(text)
            if size > GATHER:
                yield out()
                held.clear()
                size = 0
    if held:
        yield out()


Suffix = tuple[bytes, int, int]


def prefix_groups(suffixes: list[Suffix], least: int, depth: int = 0) -> Iterator[list[Suffix]]:
    """Split by the first word, the second and so on, until groups are small or the prefix is least words long."""
    if len(suffixes) <= GROUP or depth == least:
        yield suffixes
        return
    groups: dict[bytes, list[Suffix]] = {}
    for x in suffixes:
        groups.setdefault(x[0].split(b" ", depth + 1)[depth], []).append(x)
    for g in groups.values():
        yield from prefix_groups(g, least, depth + 1)


def common_words(a: bytes, b: bytes) -> int:
    """Words that two suffixes share at the start: the depth of the tree's node between them."""
    if a == b:
        return a.count(b" ") + 1
    n = 0
    for x, y in zip(a.split(b" "), b.split(b" "), strict=False):
        if x != y:
            break
        n += 1
    return n


def later_leaves(suffixes: list[Suffix], least: int) -> list[tuple[int, int]]:
    """(document, start) of all leaves but the first below each node of least words or more."""
    out = []
    for group in prefix_groups(suffixes, least):
        group.sort()
        before, first = None, None
        for s, doc, start in group:
            # suffixes end after least words: only equal ones have a node that deep above them
            if before is not None and s == before and common_words(s, before) >= least:
                if (doc, start) != first:
                    out.append((doc, start))
            else:
                before, first = s, (doc, start)
    return out


def walked(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """doc_id, start, stop of windows that repeat earlier ones. Rows come sorted by key."""
    names = ["doc_id", "start", "stop"]
    key, pieces = None, []

    def close(pieces: list[tuple[int, int, bytes]]) -> list[tuple[int, int, int]]:
        if len(pieces) < 2 and (not pieces or pieces[0][2].count(b" ") < least):
            return []
        suffixes = []
        for doc, start, piece in pieces:
            words = piece.split(b" ")
            at = 0
            ends = []
            for w in words:
                at += len(w) + 1
                ends.append(at)
            lo = 0
            for k in range(len(words) - least + 1):
                suffixes.append((piece[lo : ends[k + least - 1] - 1], doc, start + k))
                lo = ends[k]
        runs: list[list[int]] = []
        for doc, start in sorted(later_leaves(suffixes, least)):
            if runs and runs[-1][0] == doc and runs[-1][2] >= start:
                runs[-1][2] = start + 1
            else:
                runs.append([doc, start, start + 1])
        return runs

    def batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int32()))], names=names)

    for b in batches:
        rows = []
        for k, doc, start, stop, piece in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
            if piece is None:
                rows.append((doc, start, stop))
                continue
            if k != key:
                rows += close(pieces)
                key, pieces = k, []
            pieces.append((doc, start, piece))
        yield batch(rows)
    yield batch(close(pieces))


def removed(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """doc_id, n_words, n_removed, kept, repeats (maximal runs [first word, end) that go)."""
    names = ["doc_id", "n_words", "n_removed", "kept", "repeats"]
    for b in batches:
        made = []
        for text, copy, runs in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
            words = text.split()
            n = len(words)
            if copy:
                made.append((n, n, b"", [{"start": 0, "stop": n}]))
                continue
            if not runs:
                made.append((n, 0, b" ".join(words), []))
                continue
            merged: list[list[int]] = []
            for start, stop in sorted((r["start"], r["stop"] + least - 1) for r in runs):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], stop)
                else:
                    merged.append([start, stop])
            kept, at = [], 0
            for start, stop in merged:
                kept += words[at:start]
                at = stop
            kept += words[at:]
            made.append((n, n - len(kept), b" ".join(kept), [{"start": s, "stop": e} for s, e in merged]))
        types = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))]
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([m[i] for m in made], t) for i, t in enumerate(types))], names=names)


def dedup_substrings(docs: DataFrame, least: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept (bytes of the words left, joined by blanks), repeats."""
    bounded_batches(docs.sparkSession)
    own, back = apart(words_source(docs, id_col, text_col))
    named = own.filter("doc_id is not null")
    found = named.mapInArrow(lambda x: anchor_rows(x, least), "key long, doc_id long, at int, known boolean, pass boolean")
    found = found.withColumn("meet", F.when(F.col("pass"), F.xxhash64("doc_id", "at")).otherwise(F.col("key")))
    met = found.select("meet", "doc_id", "at", "known", "pass").repartition("meet").sortWithinPartitions("meet", "pass", "doc_id", "at")
    places = met.mapInArrow(repeated_places, "doc_id long, at int").groupBy("doc_id").agg(F.sort_array(F.collect_set("at")).alias("places"))
    places = written(places, "anchors")
    doubtful = named.join(places, "doc_id")
    pieces = doubtful.select("doc_id", "text", "places").mapInArrow(lambda x: piece_rows(x, least), "key long, doc_id long, start int, stop int, piece binary")
    repeats = pieces.repartition("key").sortWithinPartitions("key").mapInArrow(lambda x: walked(x, least), "doc_id long, start int, stop int")
    runs = repeats.groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    # the same rows and columns as above, so that Spark shuffles the texts once for both joins
    last = named.join(places.select("doc_id", (F.col("places")[0] == WHOLE).alias("copy")), "doc_id", "left").join(runs, "doc_id", "left").select("doc_id", "text", "copy", "runs")
    nameless = own.filter("doc_id is null").select("doc_id", "text", F.lit(False).alias("copy"), F.lit(None).cast("array<struct<start:int,stop:int>>").alias("runs"))
    return back(last.unionByName(nameless).mapInArrow(lambda x: removed(x, least), "doc_id long, n_words long, n_removed long, kept binary, repeats array<struct<start:int,stop:int>>"))


#: The same result by comparing all windows of 20 words, for DuckDB.
ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS a FROM d),
r AS (SELECT doc_id, a, row_number() OVER (PARTITION BY array_to_string(w[a : a + 19], ' ') ORDER BY doc_id, a) AS n FROM s),
gone AS (SELECT DISTINCT doc_id, a + j AS p FROM r, (SELECT unnest(range(0, 20)) AS j) WHERE n > 1),
g AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
e AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
k AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS kept FROM e ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(g.n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id) LEFT JOIN k USING (doc_id)
"""
