"""Prefix trie of conversations as double arrays.

Every conversation is rebuilt: the first h turns of the conversation that opens its hundred, then its own turns after its first h (h from its id). A node is a distinct
sequence of first turns, and its members are the rebuilt conversations that start with it.

A turn's key is 16 bytes of the SHA-256 of role and text; a node is told apart by its depth and two 64-bit sums (XOR) of hashes of (place, key) of its turns, which one window adds up.
Equal conversations become one row first. Nodes that more than `most` different conversations go through are upper nodes; upper nodes' ancestors are upper ones, too. What is left of a
conversation after its last upper node goes to the shard of (that node, next turn), which has at most `most` conversations. A task packs its shards one after the other into double arrays:
the upper node and the turns have dense numbers as symbols, the child of a node by a symbol stands at BASE[node] + symbol, and CHECK there names the node. Walking all conversations through
the arrays gives each node's members, and a pass from the deepest level up the sums of subtrees. Nodes below upper ones are then done; what hangs below an upper node is
added up over its shards, and over the tree of upper nodes, by Spark.

Scale: texts become keys in the scan and are never shuffled; shuffles carry some 50 bytes a turn. Copies cost one row. A hot first turn is an upper node whose continuations are dealt
by the next turn. Ids of the conversations that end in a node are joined in blocks of 4096 ids first; one task then hashes a node's blocks in order without holding them, which
SHA-256 asks for. Everything that a conversation has (16 bytes and 8 for each turn, not its texts) lies in one row.

Defined results: turns are ordered by turn (null first), then by their key. Null roles and texts are empty. A negative id's hundred is the one towards zero, as % has it in SQL. Rows without conv_id belong to no conversation. An empty table has no
conversations, so it gives an empty table. Repeated rows are turns of their own. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.work import bounded_batches, discard, text_or_empty, written

#: Different conversations through a node that make it an upper one; ids joined at a time; turns packed into one pair of arrays.
MOST, BLOCK, PACKED = 1000, 4096, 1 << 17
NOTHING = hashlib.sha256(b"").hexdigest()
#: Free places that are tried for a node's children before they go behind the last one.
TRIES = 64


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), key, size (code points)."""
    role, text = text_or_empty("role"), text_or_empty("text")
    key = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)), 1, 16)
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", key.alias("key"), F.length(text).cast("long").alias("size"))
    return rows.select("conv_id", F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "key")).alias("pos"), "key", "size")


def head_turns(conv_id: Column) -> Column:
    """h: how many first turns come from the conversation that opens the hundred."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 6).cast("int")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """conv_id, pos, key, size of the rebuilt conversations; and conv_id, n (their turns; 0 for those without)."""
    own = rows.groupBy("conv_id").agg(F.count("*").alias("own"))
    first = own.select(F.col("conv_id").alias("opener"), F.col("own").alias("there"))
    plan = own.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % 100).alias("opener"), head_turns(F.col("conv_id")).alias("h")).join(first.filter("opener % 100 = 0"), "opener", "left")
    plan = plan.withColumn("taken", F.least("h", F.coalesce("there", F.lit(0)))).select("conv_id", "opener", "h", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n"))
    plan = written(plan, "trie-plan")
    heads = rows.filter("conv_id % 100 = 0 and pos <= 5").select(F.col("conv_id").alias("opener"), "pos", "key", "size")
    taken = plan.filter("taken > 0").select("conv_id", "opener", "h").join(heads, "opener").filter("pos <= h").select("conv_id", "pos", "key", "size")
    rest = rows.join(plan.select("conv_id", "h", "taken"), "conv_id").filter("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "key", "size")
    return taken.unionByName(rest), plan.select("conv_id", "n")


def nodes_of(rows: DataFrame) -> DataFrame:
    """Adds x, y: with pos, the name of the node that a conversation reaches with this turn."""
    so_far = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("conv_id", "pos", "key", "size", F.bit_xor(F.xxhash64("pos", "key")).over(so_far).alias("x"), F.bit_xor(F.xxhash64("key", "pos", F.lit(1))).over(so_far).alias("y"))


def ends(paths: DataFrame, plan: DataFrame) -> DataFrame:
    """pos, x, y, conv_id, n, sha: each node in which conversations end, the smallest of them, their number and the hash of their ids."""
    last = paths.join(plan.filter("n > 0").select("conv_id", F.col("n").cast("int").alias("pos")), ["conv_id", "pos"]).select("pos", "x", "y", "conv_id")
    none = plan.filter("n = 0").select(F.lit(0).alias("pos"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), "conv_id")
    block = F.floor(F.col("conv_id") / BLOCK)
    pieces = last.unionByName(none).groupBy("pos", "x", "y", block.alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    pieces = pieces.select("pos", "x", "y", F.get("ids", F.lit(0)).alias("first"), F.size("ids").cast("long").alias("n"), F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, n, sha = None, 0, 0, None
        for b in batches:
            out = []
            for pos, x, y, conv, k, ids in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (pos, x, y) != node:
                    if node:
                        out.append((*node, first, n, sha.hexdigest()))
                    node, first, n, sha = (pos, x, y), conv, 0, hashlib.sha256()
                sha.update((b"," if n else b"") + ids.encode())
                n += k
            yield ended(out)
        if node:
            yield ended([(*node, first, n, sha.hexdigest())])

    def ended(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int32(), *[pa.int64()] * 4, pa.string()))], names=["pos", "x", "y", "conv_id", "n", "sha"])

    return pieces.repartition("x", "y", "pos").sortWithinPartitions("x", "y", "pos", "first").mapInArrow(run, "pos int, x long, y long, conv_id long, n long, sha string")


class DoubleArray:
    """A trie of sequences of dense numbers (from 0). The root is node 1; place 0 is not used."""

    def __init__(self, symbols: int):
        self.symbols = symbols
        self.base, self.check = np.zeros(4 * symbols + 64, np.int64), np.zeros(4 * symbols + 64, np.int64)
        self.check[1] = -1
        self.end = 2  # behind the last place in use
        self.free = 2  # no place below is free

    def room(self, places: int) -> None:
        if places >= len(self.base):
            more = np.zeros(max(len(self.base), places), np.int64)
            self.base, self.check = np.concatenate([self.base, more]), np.concatenate([self.check, more])

    def put(self, node: int, children: np.ndarray) -> None:
        """Places for a node's children, given by rising symbols: the first that fit them all, or behind the last."""
        low, high = int(children[0]), int(children[-1])
        while self.check[self.free]:
            self.free += 1
            self.room(self.free + 1)
        at, base = self.free, None
        for _ in range(TRIES):
            if at >= self.end:
                break
            self.room(at - low + high)
            if not self.check[at - low + children].any():
                base = at - low
                break
            at += 1
            while at < self.end and self.check[at]:
                at += 1
        if base is None:
            base = self.end - low
        self.room(base + high + 1)
        self.base[node] = base
        self.check[base + children] = node
        self.end = max(self.end, base + high + 1)

    def child(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The children by these symbols, 0 where there are none."""
        at = self.base[nodes] + symbols
        fits = (at > 1) & (at < len(self.check))
        return np.where(fits & (self.check[np.where(fits, at, 0)] == nodes), at, 0)


def packed(paths: list[np.ndarray], symbols: int) -> tuple[DoubleArray, list[np.ndarray]]:
    """The double array of the paths, built level by level, and each level's nodes of the paths that reach it (0 for those that don't)."""
    trie, n = DoubleArray(symbols), len(paths)
    depth = max(map(len, paths), default=0)
    table = np.full((depth, n), -1, np.int64)
    for i, p in enumerate(paths):
        table[: len(p), i] = p
    at, levels = np.ones(n, np.int64), []
    for symbol in table:
        on = symbol >= 0
        pairs = np.unique(np.stack([at[on], symbol[on]]), axis=1)
        cuts = np.flatnonzero(np.diff(pairs[0])) + 1
        for node, children in zip(pairs[0][np.r_[0, cuts]], np.split(pairs[1], cuts), strict=True):
            trie.put(node, children)
        at = np.where(on, trie.child(at, np.where(on, symbol, 0)), 0)
        levels.append(at)
    return trie, levels


NODE = [("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string())]
#: With these, a row that isn't done: what hangs below the upper node (pos, x, y) in one shard.
BELOW = [("pos", pa.int32()), ("x", pa.int64()), ("y", pa.int64())]
SCHEMA = ", ".join(f"{n} {'string' if t == pa.string() else 'int' if t == pa.int32() else 'long'}" for n, t in NODE + BELOW)


def shard(tops: list[tuple], paths: list[list[bytes]], sizes: list[list[int]], convs: list[int], counts: list[int], shas: list[str]) -> pa.RecordBatch:
    """Nodes of the shards of a task. tops: (pos, x, y, smallest member) of the upper node of each path."""
    top_no: dict = {}
    symbol: dict = {}
    roots = [top_no.setdefault(t, len(top_no)) for t in tops]
    numbered = [np.array([r, *(len(top_no) + symbol.setdefault(k, len(symbol)) for k in p)]) for r, p in zip(roots, paths, strict=True)]
    trie, levels = packed(numbered, len(top_no) + len(symbol))
    places, n = trie.end, len(paths)
    conv, count = np.array(convs), np.array(counts)
    least, members, leaves, saved = np.full(places, np.iinfo(np.int64).max), np.zeros(places, np.int64), np.zeros(places, np.int64), np.zeros(places, np.int64)
    children = np.bincount(trie.check[2:places][trie.check[2:places] > 0], minlength=places)
    size, top_of, sha = np.zeros(places, np.int64), np.zeros(places, np.int64), {}
    for d, at in enumerate(levels):
        on = at > 0
        np.minimum.at(least, at[on], conv[on])
        np.add.at(members, at[on], count[on])
        if d:
            size[at[on]] = [s[d - 1] for s, o in zip(sizes, on, strict=True) if o]
        top_of[at[on]] = np.array(roots)[on]
    for i in range(n):
        sha[int(levels[len(paths[i])][i])] = shas[i]
    by_level = [np.unique(at[at > 0]) for at in levels]
    for d in range(len(by_level) - 1, -1, -1):
        at = by_level[d]
        if d:
            leaves[at] += children[at] == 0
            saved[at] += (members[at] - 1) * size[at]
            np.add.at(leaves, trie.check[at], leaves[at])
            np.add.at(saved, trie.check[at], saved[at])
    out = []
    names = list(top_no)
    for d, level in enumerate(by_level):
        for at in level.tolist():
            pos, x, y, top_conv = names[top_of[at]]
            if not d:
                out.append((None, None, None, None, int(children[at]), int(leaves[at]), int(saved[at]), None, pos, x, y))
            else:
                parent = top_conv if d == 1 else int(least[trie.check[at]])
                out.append((int(least[at]), pos + d, parent, int(members[at]), int(children[at]), int(leaves[at]), int(saved[at]), sha.get(at, NOTHING), None, None, None))
    return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, (_, t) in enumerate(NODE + BELOW)], names=[name for name, _ in NODE + BELOW])


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths come shard by shard; whole shards are packed together as far as PACKED turns. Columns: pos, x, y, top_conv, first, conv_id, n, sha, keys, sizes."""
    held: list[list] = []
    turns_held, last = 0, None
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if turns_held >= PACKED and row[:5] != last:
                yield of_rows(held)
                held, turns_held = [], 0
            held.append(row)
            turns_held += len(row[8])
            last = row[:5]
    if held:
        yield of_rows(held)


def of_rows(held: list) -> pa.RecordBatch:
    return shard([r[:4] for r in held], [r[8] for r in held], [r[9] for r in held], [r[5] for r in held], [r[6] for r in held], [r[7] for r in held])


def prefix_trie(conversations: DataFrame, most: int = MOST) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of each node."""
    bounded_batches(conversations.sparkSession)
    single = written(turns(conversations), "trie-turns")
    rows, plan = rebuilt(single)
    paths = written(nodes_of(rows), "trie-paths")
    distinct = written(ends(paths, plan), "trie-ends")
    own = paths.join(distinct.select("conv_id", "n"), "conv_id")  # each distinct conversation, by its smallest id
    through = own.groupBy("pos", "x", "y").agg(F.count("*").alias("different"), F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.first("size").alias("size"))
    upper = written(through.filter(F.col("different") > most).drop("different"), "trie-upper")

    at = ["pos", "x", "y"]
    marked = own.select("conv_id", *at, "key", "size").join(upper.select(*at, F.col("conv_id").alias("top_conv")), at, "left")
    below = F.when(F.col("top_conv").isNull(), F.struct("pos", "key", "size"))
    deepest = F.max(F.when(F.col("top_conv").isNotNull(), F.struct("pos", "x", "y", "top_conv")))
    rest = marked.groupBy("conv_id").agg(deepest.alias("top"), F.sort_array(F.collect_list(below)).alias("rest"))
    whole = distinct.agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"))
    root = written(whole.filter("n_convs is not null").select(F.lit(0).alias("pos"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), "conv_id", "n_convs", F.lit(0).cast("long").alias("size")), "trie-root")
    smallest = root.first()
    start = F.struct(F.lit(0).alias("pos"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), F.lit(smallest.conv_id if smallest else 0).cast("long").alias("top_conv"))
    segments = distinct.select("conv_id", "n", "sha").join(rest.filter(F.size("rest") > 0), "conv_id").withColumn("top", F.coalesce("top", start))
    sent = segments.select("top.*", F.col("rest")[0]["key"].alias("first"), "conv_id", "n", "sha", F.col("rest.key").alias("keys"), F.col("rest.size").alias("sizes"))
    sent = sent.repartition("x", "y", "first").sortWithinPartitions("x", "y", "pos", "first", "conv_id")
    made = written(sent.mapInArrow(shards, SCHEMA), "trie-nodes")

    out = made.filter("conv_id is not null").select([n for n, _ in NODE]).unionByName(upper_nodes(upper, root, paths, made, distinct))
    discard(single, plan, paths, distinct, upper, root)  # what is left to do reads the tables of nodes alone
    return out


def upper_nodes(upper: DataFrame, root: DataFrame, paths: DataFrame, made: DataFrame, distinct: DataFrame) -> DataFrame:
    """The upper nodes, root included: what their shards have below them, then the sums over their own tree."""
    at = ["pos", "x", "y"]
    tops = upper.unionByName(root)
    # each upper node with its ancestors and itself, along the path of its smallest member
    along = paths.join(upper.select("conv_id", F.col("pos").alias("depth"), F.col("x").alias("tx"), F.col("y").alias("ty")), "conv_id").filter("pos <= depth").select(*at, "depth", "tx", "ty")
    to_root = upper.select(F.lit(0).alias("pos"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), F.col("pos").alias("depth"), F.col("x").alias("tx"), F.col("y").alias("ty"))
    same = root.select(*at, F.lit(0).alias("depth"), F.lit(0).cast("long").alias("tx"), F.lit(0).cast("long").alias("ty"))
    lines = written(along.unionByName(to_root).unionByName(same), "trie-lines")
    below = made.filter("conv_id is null").groupBy(*at).agg(*[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])
    over = lines.filter("depth = pos + 1").groupBy(*at).agg(F.count("*").alias("upper_children"))
    own = tops.join(below, at, "left").join(over, at, "left").join(distinct.select(*at, "sha"), at, "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    children = zero(F.col("n_children")) + zero(F.col("upper_children"))
    own = written(
        own.select(*at, "conv_id", "n_convs", children.alias("n_children"), (zero(F.col("n_leaves")) + (children == 0).cast("long")).alias("leaves"), (zero(F.col("saved_tokens")) + (F.col("n_convs") - 1) * F.col("size")).alias("saved"), "sha"), "trie-tops"
    )
    named = own.select(F.col("pos").alias("depth"), F.col("x").alias("tx"), F.col("y").alias("ty"), "leaves", "saved")
    sums = lines.join(named, ["depth", "tx", "ty"]).groupBy(*at).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    parents = lines.filter("depth = pos + 1").select(*at, F.col("depth").alias("pos2"), "tx", "ty").join(own.select(*at, F.col("conv_id").alias("parent_conv_id")), at)
    parents = parents.select(F.col("pos2").alias("pos"), F.col("tx").alias("x"), F.col("ty").alias("y"), "parent_conv_id")
    met = own.join(sums, at).join(parents, at, "left")
    return met.select("conv_id", F.col("pos").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(NOTHING)).alias("ends_sha256"))


#: The same by joins of whole prefixes, for DuckDB.
ORACLE = """
WITH RECURSIVE t0 AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(sha256(length(role)::varchar || ':' || role || text), 1, 32)) AS pos FROM t0),
c AS (SELECT conv_id, count(*) AS own, list_reduce(list_prepend(4294967295::bigint, list_transform(range(8 * strlen(conv_id::varchar)), lambda k: (CASE WHEN k % 8 = 0 THEN ascii(substr(conv_id::varchar, (k // 8 + 1)::int, 1)) ELSE 0 END)::bigint)),
  lambda a, b: xor(xor(a, b) >> 1, 3988292384::bigint * (xor(a, b) & 1))) AS crc FROM t GROUP BY conv_id),
h AS (SELECT conv_id, own, xor(crc, 4294967295) % 6 AS h, conv_id - conv_id % 100 AS opener FROM c),
p AS (SELECT h.*, least(h.h, coalesce(o.own, 0)) AS taken FROM h LEFT JOIN c o ON o.conv_id = h.opener),
r AS (SELECT p.conv_id, t.pos, t.role, t.text FROM p JOIN t ON t.conv_id = p.opener AND t.pos <= p.h UNION ALL SELECT p.conv_id, t.pos - p.h + p.taken, t.role, t.text FROM p JOIN t USING (conv_id) WHERE t.pos > p.h),
l AS (SELECT p.conv_id, count(r.pos) AS n FROM p LEFT JOIN r USING (conv_id) GROUP BY ALL),
w AS (SELECT conv_id, pos AS d, list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY pos) AS prefix, length(text) AS size FROM r UNION ALL SELECT conv_id, 0, [], 0 FROM l),
n AS (SELECT d, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size, sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256 FROM w JOIN l USING (conv_id) GROUP BY ALL),
k AS (SELECT n.*, u.conv_id AS parent FROM n LEFT JOIN n u ON u.d = n.d - 1 AND u.prefix = n.prefix[:n.d - 1]),
m AS (SELECT a.d, a.conv_id, count(*) AS n_children FROM n a JOIN k b ON b.d = a.d + 1 AND b.parent = a.conv_id GROUP BY ALL),
s AS (SELECT a.d, a.conv_id, sum((b.n_convs - 1) * b.size) AS saved, sum((x.n_children IS NULL)::int) AS leaves FROM n b LEFT JOIN m x ON x.d = b.d AND x.conv_id = b.conv_id JOIN w ON w.conv_id = b.conv_id AND w.d <= b.d JOIN n a ON a.d = w.d AND a.prefix = w.prefix GROUP BY ALL)
SELECT k.conv_id, k.d AS depth, k.parent AS parent_conv_id, k.n_convs, coalesce(m.n_children, 0) AS n_children, s.leaves::bigint AS n_leaves, s.saved::bigint AS saved_tokens, k.ends_sha256
FROM k LEFT JOIN m ON m.d = k.d AND m.conv_id = k.conv_id JOIN s ON s.d = k.d AND s.conv_id = k.conv_id
"""
