"""Joins of manifests, listings and tables of people."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def status_outer(a: DataFrame, b: DataFrame, keys: list[str], only_a: str, only_b: str, both: str) -> DataFrame:
    """J1, J10. Distinct keys of both sides and where they are."""
    x, y = a.select(*keys).distinct().withColumn("in_a", F.lit(True)), b.select(*keys).distinct().withColumn("in_b", F.lit(True))
    return x.join(y, keys, "full_outer").select(*keys, F.when(F.col("in_a") & F.col("in_b"), both).when(F.col("in_a"), only_a).otherwise(only_b).alias("status"))


def size_classes(a: DataFrame, b: DataFrame) -> DataFrame:
    """J2. side, path, length, members (files of the own side with this length), partners (of the other side) for each file that has a partner: the length is the class, so that n and m files
    of a length take n + m rows and stand for n * m pairs."""
    both = a.select(F.lit("a").alias("side"), "path", "length").unionByName(b.select(F.lit("b").alias("side"), "path", "length")).filter("length is not null")
    sizes = both.groupBy("length").agg(F.count_if(F.col("side") == "a").alias("a"), F.count_if(F.col("side") == "b").alias("b")).filter("a > 0 and b > 0")
    own = lambda x, y: F.when(F.col("side") == "a", F.col(x)).otherwise(F.col(y))
    return both.join(sizes, "length").select("side", "path", "length", own("a", "b").alias("members"), own("b", "a").alias("partners"))


def match_by_size(a: DataFrame, b: DataFrame, parts: int = 16) -> DataFrame:
    """J2. The classes' pairs, for those who want each: files of equal size, n * m rows for a size. Each file of a goes to one of `parts` parts of its size, b's to all."""
    left = a.select(F.col("path").alias("path_a"), "length", F.pmod(F.xxhash64("path"), F.lit(parts)).cast("int").alias("part"))
    right = b.select(F.col("path").alias("path_b"), "length", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    return left.join(right, ["length", "part"]).select("length", "path_a", "path_b")


def compare_steps(done: DataFrame, raw: DataFrame, markers: DataFrame) -> DataFrame:
    """J3. Recordings of both steps with the same size, start and duration: compliant with a pass marker, else a missing marker."""
    met = done.join(raw.withColumnRenamed("path", "raw_path"), ["length", "start", "milli"])
    mark = markers.select(F.col("path").alias("raw_path"), F.lit(True).alias("marked")).distinct()
    return met.join(mark, "raw_path", "left").select("path", "raw_path", F.when(F.col("marked"), "compliant").otherwise("missing marker").alias("state"))


def merge_participants(subjects: DataFrame, demo: DataFrame, policy: str = "first") -> DataFrame:
    """J6. All subjects with the age, sex and group of the first (or last) row of their id; a missing group is patient."""
    order = F.col("idx").asc() if policy == "first" else F.col("idx").desc()
    one = demo.withColumn("place", F.row_number().over(Window.partitionBy("id").orderBy(order))).filter("place = 1")
    return subjects.join(one.select("id", "age", "sex", "grp"), "id", "left").select("id", "age", "sex", F.coalesce(F.nullif("grp", F.lit("")), F.lit("patient")).alias("grp"))


def archive_metadata(archives: DataFrame, rows: DataFrame) -> DataFrame:
    """J7. The first row, in source order, whose path is the archive's or whose name is; without one it needs a hand."""
    name = F.element_at(F.split("path", "/"), -1)
    a = archives.select("path").distinct().withColumn("name", name)
    r = rows.select(F.col("path").alias("row_path"), "acq_time", "idx").withColumn("row_name", F.element_at(F.split("row_path", "/"), -1))
    by_path = r.groupBy("row_path").agg(F.min(F.struct("idx", "acq_time")).alias("p"))
    by_name = r.groupBy("row_name").agg(F.min(F.struct("idx", "acq_time")).alias("n"))
    met = a.join(by_path, a.path == by_path.row_path, "left").join(by_name, a.name == by_name.row_name, "left")
    best = F.when(F.col("p").isNull() | (F.col("n.idx") < F.col("p.idx")), F.col("n")).otherwise(F.col("p"))
    return met.select("path", best["acq_time"].alias("acq_time"), F.when(best.isNull(), "manual_required").otherwise("found").alias("state"))


def session_plan(src: DataFrame, dst: DataFrame) -> DataFrame:
    """J8. What to do with each source session: COPY a new one, MERGE one that is there; empty ones are not selected."""
    s = src.groupBy("sub", "ses").agg(F.sum(F.when(F.col("length") > 0, 1).otherwise(0)).alias("n"))
    d = dst.select("sub", "ses", F.lit(True).alias("there")).distinct()
    return s.join(d, ["sub", "ses"], "left").select("sub", "ses", F.when(F.col("there"), "MERGE").otherwise("COPY").alias("action"), (F.col("n") == 0).alias("empty"), (F.col("there").isNull() & (F.col("n") > 0)).alias("selected"))


def set_compare(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """J9. How many different rows are only in one of the tables; equal if none."""
    x, y = (t.select(*[F.trim(F.col(k).cast("string")).alias(k) for k in keys]).distinct() for t in (a, b))
    met = x.withColumn("in_a", F.lit(1)).join(y.withColumn("in_b", F.lit(1)), [x[k].eqNullSafe(y[k]) for k in keys], "full_outer")
    return met.agg(F.expr("count_if(in_b is null)").alias("only_left"), F.expr("count_if(in_a is null)").alias("only_right")).selectExpr("*", "only_left = 0 and only_right = 0 as equal")


def chunk_diff(a: DataFrame, b: DataFrame, width: int = 70) -> DataFrame:
    """J11. Lines of = and X for the equal and different chunks of file pairs, width chunks to a line. a, b: pair, chunk, md5."""
    met = a.join(b.withColumnRenamed("md5", "other"), ["pair", "chunk"]).withColumn("mark", F.when(F.col("md5") == F.col("other"), "=").otherwise("X"))
    line = F.floor(F.col("chunk") / width)
    return met.groupBy("pair", line.alias("line")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "mark"))), lambda x: x["mark"]), "").alias("map"))


def signal_equality(a: DataFrame, b: DataFrame) -> DataFrame:
    """J12. Of each channel: samples compared, how many differ, mean and largest difference, exact or within 1e-10."""
    met = a.join(b.withColumnRenamed("v", "w"), ["rec", "channel", "idx"]).withColumn("d", F.abs(F.col("v") - F.col("w")))
    out = met.groupBy("rec", "channel").agg(F.count("*").alias("n"), F.expr("count_if(d > 1e-10)").alias("differ"), F.round(F.avg("d"), 6).alias("mean"), F.round(F.max("d"), 6).alias("largest"), F.expr("count_if(d <> 0) = 0").alias("exact"))
    return out.withColumn("percent", F.round(100 * F.col("differ") / F.col("n"), 6))


def label_compare(ref: DataFrame, target: DataFrame) -> DataFrame:
    """J13. Labels of two recordings by position, annotation channels left out: how many agree and which differ."""
    def placed(t: DataFrame, name: str) -> DataFrame:
        return t.filter(~F.col("label").contains("Annotations")).selectExpr("rec", f"label as {name}", "row_number() over (partition by rec order by idx) as place")

    met = placed(ref, "a").join(placed(target, "b"), ["rec", "place"], "full_outer")
    return met.groupBy("rec").agg(F.expr("count_if(a <=> b)").alias("same"), F.expr("count_if(not (a <=> b))").alias("different"))


def valid_pulses(events: DataFrame, valid: DataFrame) -> DataFrame:
    """J16. Samples listed for their pair; a pair without a list keeps all of its own."""
    listed = events.join(valid, ["pair", "sample"], "left_semi")
    free = events.join(valid.select("pair").distinct(), "pair", "left_anti")
    return listed.unionByName(free)


def cleanup_plan(matches: DataFrame, files: DataFrame) -> DataFrame:
    """J17. Raw files with a unique match: to be deleted if the pass marker of their stem is there, other files of the stem move."""
    stem = F.regexp_extract("name", r"^([^.]*)", 1)
    unique = matches.filter("status = 'unique match'").select("stem", "target").distinct()
    marked = files.filter("ext = '.md5'").select(stem.alias("stem")).distinct().withColumn("marked", F.lit(True))
    met = files.filter("ext <> '.md5'").withColumn("stem", stem).join(unique, "stem").join(marked, "stem", "left")
    return met.select("file_id", "target", F.when((F.col("ext") == ".edf") & F.col("marked"), "delete").when(F.col("ext") == ".edf", "keep").otherwise("move").alias("action"))
