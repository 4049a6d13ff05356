"""Different texts with one id: each is a document of its own, in the ops that compare documents and in the pipeline's stages."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.test_llm import DATA, brute_windows
from tidemark.llm import linededup, simhash, suffix
from tidemark.llm.work import apart

WIDE = 1 << 62


def mixed(shift=0):
    r = random.Random(11)
    words = [f"w{i}" for i in range(60)]
    line = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, block = line(45), "\n".join(line(6) for _ in range(4))
    rows = [(1, passage), (2, line(50) + " " + passage), (2, line(25)), (2, passage + " " + line(30)), (2, passage), (3, block), (3, line(8) + "\n" + block), (3, "m1 m2\nm3\nm4\nm5"), (4, block + "\nend"), (4, None), (4, ""), (5, line(90)), (5, line(90)), (6, passage), (6, passage), (None, passage), (None, block)]
    return [(None if i is None else i + shift, t) for i, t in rows]


def ordered(spark, rows):
    """The rows with ranks of (id, hash of the text) in place of ids, and the ids."""
    df = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", F.xxhash64(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("h")).collect()
    keys = sorted({(r.doc_id, r.h) for r in df if r.doc_id is not None})
    return [(None if r.doc_id is None else keys.index((r.doc_id, r.h)), r.text) for r in df], [r.doc_id for r in df]


@pytest.mark.parametrize("shift", [0, -3, WIDE])
def test_apart(spark, shift):
    rows = mixed(shift)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("more", F.lit(1)).repartition(3)
    own, back = apart(df)
    ranks, ids = ordered(spark, rows)
    got = own.select("doc_id", "text").collect()
    by_new = sorted({(r.doc_id, r.text or "") for r in got if r.doc_id is not None})
    assert len({i for i, _ in by_new}) == len(by_new) == len({(i, t or "") for i, t in ranks if i is not None})
    assert [t for _, t in by_new] == [t for _, t in sorted({(i, t or "") for i, t in ranks if i is not None})]
    assert sorted(map(repr, map(tuple, back(own).select("doc_id", "text").collect()))) == sorted(map(repr, rows)) and back(own).columns == df.columns


def test_apart_leaves_plain_tables_alone(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "a"), (None, "b")], "doc_id long, text string")
    assert apart(df)[0] is df and apart(df.limit(0))[0].count() == 0


@pytest.mark.parametrize("shift", [0, WIDE])
def test_substrings(spark, shift):
    rows = mixed(shift)
    units = lambda t: re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode())
    ranks, ids = ordered(spark, rows)
    for least in (20, 5):
        want = [(old, len(u), b" ".join(w for k, w in enumerate(u) if k not in gone)) for old, (_, u, gone) in zip(ids, brute_windows(ranks, units, least), strict=True)]
        got = [(r.doc_id, r.n_words, bytes(r.kept)) for r in suffix.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), least).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_lines(spark):
    rows = mixed()
    units = lambda t: [x.strip(" ") for x in (t or "").split("\n") if x.strip(" ")]
    ranks, ids = ordered(spark, rows)
    want = []
    for old, (_, t), (_, _, gone) in zip(ids, ranks, brute_windows(ranks, units, 3), strict=True):
        kept, q = [], 0
        for x in (t or "").split("\n"):
            solid = bool(x.strip(" "))
            if not (solid and q in gone):
                kept.append(x)
            q += solid
        want.append((old, "\n".join(kept)))
    got = [(r.doc_id, r.text) for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), run=3, long_line=1 << 20).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_lines_at_the_place_of_another_row(spark):
    rows = [(1, "aaa\nbbb\nccc"), (2, "x\ny\naaa\nbbb"), (2, "m1\nm2\nm3\nm4")]
    got = {r.text for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {"aaa\nbbb\nccc", "x\ny", "m1\nm2\nm3\nm4"}


def test_stages(spark):
    import corpus_pipeline

    r = random.Random(2)
    text = lambda n: " ".join(f"v{r.randrange(400)}" for _ in range(n))
    first, other = text(200), text(200)
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").first().text
    rows = [(1, first), (2, first + " more"), (2, other), (3, text(30) + " " + item), (3, text(80)), (4, other)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    near = sorted((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, DATA).collect())
    assert near == sorted([rows[0], rows[2], rows[3], rows[4]])
    clean = sorted((r.doc_id, r.text) for r in corpus_pipeline.decontamination(spark, docs, DATA).collect())
    assert clean == sorted([x for x in rows if item not in x[1]])
    lines = corpus_pipeline.line_dedup(spark, docs, DATA)  # of the line that ids 2 and 4 have, the first stays
    assert lines.columns == docs.columns and sorted((r.doc_id, r.text) for r in lines.collect()) == sorted(rows[:-1])
    assert simhash.drop_near_duplicates(docs.filter("doc_id <> 2")).count() == 0
