"""Line dedup by winnowing over line hashes, with DataFrame functions only.

A document is the sequence of its lines that aren't blank (compared without blanks at either end). A line goes if it
lies in a run of `run` lines whose sequence also starts earlier: in a document with a smaller id, or higher up in the
same one. A line of `long_line` or more characters (240: some 40 words) is a run by itself. Blank lines stay.

Winnowing: in every window of `run` line hashes the smallest is a fingerprint (the last one among equals). A repeated
run has the same hashes wherever it stands, so both places select the same fingerprint; a long line selects itself. Fingerprints that occur once
are done with. From the others, joined by value, the match is extended both ways: to every run of `run` lines around
the position, told apart by a hash of its lines; overlapping runs make up the longer ones. All but the first place of
a run are deleted.

Scale: a line that a third of all documents share is one row of the partial sums before a shuffle, and the joins back
to its places are on keys whose rows Spark may split among tasks. Texts are shuffled once, to meet their deletions.

Defined results: a null text counts as the empty text, and comes back empty. A null id is neither matched nor changed. Rows that share an id and a
text are one document; different texts of one id are documents of their own, one after the other by a hash of the text. A table without lines comes back as it is. Lines are compared by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.work import apart, text_or_empty, written

RUN, LONG_LINE = 2, 240


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def sequence_or_none(lo: Column, hi: Column) -> Column:
    return F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))


def solid_lines(lines: Column) -> Column:
    """struct(at, h, size) of the lines that aren't blank: place among all lines (from 0), hash, characters."""
    trimmed = F.transform(lines, lambda x: F.trim(x))
    marked = F.transform(trimmed, lambda x, i: F.struct(i.alias("at"), F.xxhash64(x).alias("h"), F.length(x).alias("size")))
    return F.filter(marked, lambda x: x["size"] > 0)


def fingerprints(docs: DataFrame, run: int, long_line: int) -> DataFrame:
    """doc_id, q (place among solid lines, from 0), h, long (whether it is a run by itself), from_q and around (hashes of the lines up to run - 1 away)."""
    solid = docs.filter("doc_id is not null").select("doc_id", solid_lines(lines_of(F.col("text"))).alias("solid"))
    hashes = solid.select("doc_id", F.transform("solid", lambda x: x["h"]).alias("hs"), F.transform("solid", lambda x: x["size"] >= long_line).alias("longs"))
    minima = F.transform(
        sequence_or_none(F.lit(0), F.size("hs") - run),
        lambda s: -F.array_min(F.transform(F.slice("hs", s + 1, F.lit(run)), lambda h, j: F.struct(h.alias("h"), (-(s + j)).alias("q"))))["q"],
    )
    own = F.filter(sequence_or_none(F.lit(0), F.size("hs") - 1), lambda q: F.get("longs", q))
    place = hashes.select("doc_id", "hs", "longs", F.explode(F.array_distinct(F.concat(minima, own))).alias("q"))
    start = F.greatest(F.col("q") - (run - 1), F.lit(0))
    return place.select("doc_id", "q", F.expr("hs[q]").alias("h"), F.expr("longs[q]").alias("long"), start.alias("from_q"), F.slice("hs", start + 1, F.col("q") - start + run).alias("around"))


def repeated_runs(docs: DataFrame, run: int = RUN, long_line: int = LONG_LINE) -> DataFrame:
    """doc_id, q, n: the start and number of lines of every run that also starts earlier."""
    places = written(fingerprints(docs, run, long_line), "line-places")
    # written, so that both sides of the joins below are plain shuffles, which Spark can split at a hot line
    again = written(places.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"), "line-repeats")
    joined = places.join(again, "h", "left_semi")
    runs = F.transform(
        sequence_or_none(F.lit(0), F.size("around") - run),
        lambda i: F.struct((F.col("from_q") + i).alias("q"), F.xxhash64(F.slice("around", i + 1, F.lit(run))).alias("r"), F.lit(run).alias("n")),
    )
    alone = F.filter(F.array(F.struct(F.col("q"), F.xxhash64(F.array("h")).alias("r"), F.lit(1).alias("n"))), lambda x: F.col("long"))
    extended = joined.select("doc_id", F.explode(F.concat(runs, alone)).alias("x")).select("doc_id", "x.q", "x.r", "x.n").distinct()
    extended = written(extended, "line-runs")
    first = written(extended.groupBy("r").agg(F.min(F.struct("doc_id", "q")).alias("first"), F.count("*").alias("times")).filter("times > 1").select("r", "first"), "line-first")
    return extended.join(first, "r").filter(F.struct("doc_id", "q") > F.col("first")).select("doc_id", "q", "n")


def dedup_lines(docs: DataFrame, run: int = RUN, long_line: int = LONG_LINE, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_lines, n_removed, text (what is left, lines joined by newlines), carried (a struct of the columns named by carry, if any)."""
    kept_columns = [F.struct(*carry).alias("carried")] if carry else []
    own, back = apart(docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"), *kept_columns))
    starts = repeated_runs(own.select("doc_id", "text"), run, long_line).groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("q", "n"))).alias("starts"))
    met = own.join(starts, "doc_id", "left").withColumn("lines", lines_of(F.col("text")))
    covered = F.flatten(F.transform("starts", lambda s: F.sequence(s["q"], s["q"] + s["n"] - 1)))
    at = F.transform(solid_lines(F.col("lines")), lambda x: x["at"])
    met = met.withColumn("at", F.when(F.col("starts").isNotNull(), at))
    gone = F.when(F.col("starts").isNotNull(), F.transform(F.array_distinct(covered), lambda q: F.get("at", q))).otherwise(F.array().cast("array<int>"))
    met = met.withColumn("gone", F.array_compact(gone))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone"), lambda i: F.get("lines", i))
    text = F.when(F.size("gone") > 0, F.concat_ws("\n", kept)).otherwise(F.col("text"))
    return back(met.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_removed"), text.alias("text"), *(["carried"] if carry else [])))


#: The same result by comparing all runs of two lines and all long lines, for DuckDB.
ORACLE = """
WITH e AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
s AS (SELECT doc_id, pos, trim(line) AS t, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS q FROM e WHERE length(trim(line)) > 0),
w AS (SELECT doc_id, q, t || chr(10) || lead(t) OVER (PARTITION BY doc_id ORDER BY q) AS run FROM s),
r AS (SELECT doc_id, q, row_number() OVER (PARTITION BY run ORDER BY doc_id, q) AS n FROM w WHERE run IS NOT NULL),
l AS (SELECT doc_id, q, row_number() OVER (PARTITION BY t ORDER BY doc_id, q) AS n FROM s WHERE length(t) >= 240),
gone AS (SELECT DISTINCT doc_id, q FROM (SELECT doc_id, q FROM r WHERE n > 1 UNION ALL SELECT doc_id, q + 1 FROM r WHERE n > 1 UNION ALL SELECT doc_id, q FROM l WHERE n > 1)),
marked AS (SELECT e.doc_id, e.pos, e.line, gone.q IS NOT NULL AS removed FROM e LEFT JOIN s USING (doc_id, pos) LEFT JOIN gone ON gone.doc_id = s.doc_id AND gone.q = s.q)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT removed), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
