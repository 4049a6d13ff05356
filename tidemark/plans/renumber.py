"""Plans for merging and renumbering sessions: rows that say what should move where; nothing is moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ses(n: Column | str) -> Column:
    return F.concat(F.lit("ses-"), F.lpad((F.col(n) if isinstance(n, str) else n).cast("string"), 3, "0"))


def merge_tsv(a: DataFrame, b: DataFrame) -> DataFrame:
    """U1. All rows of both, columns by name, missing ones null, repeats kept."""
    return a.unionByName(b, allowMissingColumns=True)


def list_compare(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """U2. key, place (both, left, right) of the distinct keys."""
    a, b = left.select(key).distinct().withColumn("in_left", F.lit(True)), right.select(key).distinct().withColumn("in_right", F.lit(True))
    return a.join(b, key, "full_outer").select(key, F.when(F.col("in_left") & F.col("in_right"), "both").when(F.col("in_left"), "left").otherwise("right").alias("place"))


def shift_sessions(scans: DataFrame, start: int, end: int, delta: int) -> DataFrame:
    """U3. Sessions from start to end get delta more, everywhere in the path; collision tells a target that another row has as well."""
    new = F.when(F.col("ses").between(start, end), F.col("ses") + delta).otherwise(F.col("ses"))
    moved = scans.select("sub", "ses", new.alias("new_ses"), F.replace("filename", ses("ses"), ses(new)).alias("new_filename"))
    return moved.selectExpr("sub", "ses", "new_ses", "new_filename", "count(*) over (partition by sub, new_filename) > 1 as collision")


def edit_sessions(scans: DataFrame, action: str, one: int, other: int = 0) -> DataFrame:
    """U4. swap sessions one and other, increment or decrement one (not below 1), or delete it."""
    if action == "delete":
        return scans.filter(F.col("ses") != one).select("sub", "ses", F.col("ses").alias("new_ses"), "filename")
    n = F.col("ses")
    new = {
        "swap": F.when(n == one, other).when(n == other, one).otherwise(n), "increment": F.when(n == one, n + 1).otherwise(n), "decrement": F.when(n == one, F.greatest(n - 1, F.lit(1))).otherwise(n),
    }[action]
    return scans.select("sub", "ses", new.cast("long").alias("new_ses"), F.replace("filename", ses("ses"), ses(new.cast("long"))).alias("filename"))


def import_mapping(source: DataFrame, existing: DataFrame, start: int = 1) -> DataFrame:
    """U5. sub, ses, new_ses: a subject's source sessions, in order, get its next free numbers from start on."""
    wanted = source.select("sub", "ses").distinct().selectExpr("sub", "ses", "row_number() over (partition by sub order by ses) as place")
    size = wanted.groupBy("sub").agg(F.max("place").alias("n")).join(existing.groupBy("sub").agg(F.max("ses").alias("top")), "sub", "left")
    numbers = size.select("sub", F.explode(F.sequence(F.lit(start).cast("long"), F.greatest(F.coalesce("top", F.lit(0)), F.lit(start - 1)) + F.col("n"))).alias("new_ses"))
    free = numbers.join(existing.select("sub", F.col("ses").alias("new_ses")).distinct(), ["sub", "new_ses"], "left_anti")
    free = free.selectExpr("sub", "new_ses", "row_number() over (partition by sub order by new_ses) as place")
    return wanted.join(free, ["sub", "place"]).select("sub", "ses", "new_ses")


def rename_plan(files: DataFrame) -> DataFrame:
    """U6. path, target, clash: every file under the name of its folder, task and run; clash where two files want one target."""
    stem = F.concat(F.lit("sub-"), F.lpad(F.col("sub").cast("string"), 3, "0"), F.lit("_"), ses("ses"))
    folder = F.concat(F.lit("sub-"), F.lpad(F.col("sub").cast("string"), 3, "0"), F.lit("/"), ses("ses"), F.lit("/ieeg/"))
    suffix = F.regexp_extract("name", r"_(task-[^_]+_run-\d+_.*)$", 1)
    plan = files.select("path", F.concat(folder, stem, F.lit("_"), suffix).alias("target"))
    return plan.selectExpr("path", "target", "count(*) over (partition by target) > 1 as clash")


def insert_new_sessions(existing: DataFrame, new: DataFrame) -> DataFrame:
    """U7. sub, acq_time, origin, new_ses: new recordings whose time isn't there yet go between the others; numbers follow the time."""
    fresh = new.select("sub", "acq_time").distinct().join(existing.select("sub", "acq_time").distinct(), ["sub", "acq_time"], "left_anti").withColumn("origin", F.lit("new"))
    both = existing.select("sub", "acq_time").distinct().withColumn("origin", F.lit("existing")).unionByName(fresh)
    return both.selectExpr("sub", "acq_time", "origin", "cast(row_number() over (partition by sub order by acq_time) as bigint) as new_ses")


def copy_plan(wanted: DataFrame, files: DataFrame, excluded: list[str]) -> DataFrame:
    """U8. path, dest, state: where each wanted file should go; files of excluded kinds are left out, others may be missing."""
    kept = wanted.filter(~F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).isin([x.lower() for x in excluded]))
    there = files.select("path").distinct().withColumn("there", F.lit(True))
    return kept.join(there, "path", "left").select("path", F.concat(F.lit("copy/"), F.regexp_extract("path", r"^([^/]*/[^/]*)/", 1)).alias("dest"), F.when(F.col("there"), "copy").otherwise("missing").alias("state"))


def changed_sessions(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """U9. Old and new session of rows that changed, by row key."""
    met = old.select(*key, F.col("ses").alias("old_ses")).join(new.select(*key, F.col("new_ses")), key)
    return met.filter("old_ses <> new_ses").select("sub", "old_ses", "new_ses").distinct()
