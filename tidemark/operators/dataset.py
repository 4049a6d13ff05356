"""Files of a dataset: statistics, duplicates, completeness checks, archive gates, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ("sub", "ses", "run")


def folder_stats(files: DataFrame) -> DataFrame:
    """A1. Of each folder: files, bytes, latest time, whether it has native recordings, the most frequent day of its files (the earliest among equals) with its count and share."""
    day = F.floor(F.col("mtime") / 86400)
    per_day = files.groupBy("sub", "ses", day.alias("day")).agg(F.count("*").alias("n"), F.sum("length").alias("bytes"), F.max("mtime").alias("latest"), F.expr("count_if(ext = '.edf')").alias("native"))
    out = per_day.groupBy("sub", "ses").agg(
        F.sum("n").alias("n_files"), F.sum("bytes").alias("bytes"), F.max("latest").alias("latest"), (F.sum("native") > 0).alias("has_native"), F.max(F.struct("n", (-F.col("day")).alias("d"))).alias("top")
    )
    return out.select("sub", "ses", "n_files", "bytes", "latest", "has_native", (-F.col("top.d")).alias("dominant_day"), F.col("top.n").alias("dominant_n"), F.round(F.col("top.n") / F.col("n_files"), 6).alias("share"))


def duplicate_content(files: DataFrame) -> DataFrame:
    """A5. For each subject and extension over its sessions: missing (in some sessions), match (all sizes above 0 and contents equal) or differ; content is told apart by the sets of (size, hash) of a session."""
    size = files.groupBy("sub").agg(F.countDistinct("ses").alias("sessions"))
    each = files.groupBy("sub", "ext", "ses").agg(F.array_sort(F.collect_list(F.struct("length", F.coalesce("md5", F.lit("")).alias("md5")))).alias("content"), F.min("length").alias("least"))
    groups = each.groupBy("sub", "ext").agg(F.count("*").alias("n"), F.countDistinct("content").alias("kinds"), F.min("least").alias("least")).join(size, "sub")
    state = F.when(F.col("n") < F.col("sessions"), "missing").when((F.col("kinds") == 1) & (F.col("least") > 0), "match").otherwise("differ")
    return groups.select("sub", "ext", state.alias("state"))


def duplicate_runs(files: DataFrame) -> DataFrame:
    """A6. Runs with the same sorted list of (extension, checksum) form a group: its primary has the most files, then comes first; the others skip. Runs with a file of unknown checksum are alone."""
    known = files.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("ext", "md5"))).alias("content"), F.count("*").alias("n"), F.expr("bool_or(md5 is null)").alias("unknown"))
    key = F.when(F.col("unknown"), F.concat_ws("/", *KEY)).otherwise(F.sha2(F.to_json("content"), 256))
    w = Window.partitionBy("key").orderBy(F.desc("n"), *KEY)
    return known.withColumn("key", key).select(*KEY, "n", F.when(F.row_number().over(w) == 1, "primary").otherwise("skip").alias("role"), F.count("*").over(Window.partitionBy("key")).alias("copies"))


def duplicate_sessions(rows: DataFrame) -> DataFrame:
    """A7. Rows of one size and checksum: the first stays, the others skip; a row without either is never a duplicate."""
    w = Window.partitionBy("length", "md5").orderBy("file_id")
    known = F.col("length").isNotNull() & F.col("md5").isNotNull()
    return rows.select("file_id", F.when(known & (F.row_number().over(w) > 1), "skip").otherwise("keep").alias("action"), F.when(known, F.min("file_id").over(Window.partitionBy("length", "md5"))).otherwise(F.col("file_id")).alias("first_id"))


def dedupe_keep_largest(rows: DataFrame) -> DataFrame:
    """A8. One row of each base name (text before the last ` (`): the largest; empty files go, unknown sizes stay."""
    base = F.regexp_replace("name", r" \([^(]*$", "")
    w = Window.partitionBy("base").orderBy(F.desc_nulls_last("length"), "name")
    return rows.filter("length is null or length > 0").withColumn("base", base).withColumn("place", F.row_number().over(w)).filter("place = 1").select("base", "name", "length")


# D5: checks that can be switched on and off by name; each is an expression over the files of a session.
RULES = {
    "no container": "not bool_or(ext in ('.edf', '.edf.gz'))", "several archives": "count_if(ext = '.edf.gz') > 1", "no events": "not bool_or(ext = '.tsv')",
    "no json": "not bool_or(ext = '.json')", "no checksum": "bool_or(ext in ('.edf', '.edf.gz')) and not bool_or(ext = '.md5')", "raw and archive": "bool_or(ext = '.edf') and bool_or(ext = '.edf.gz')",
}


def validate_session(files: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """A9, D5. Issues of each session, joined by semicolons, of the rules that are on."""
    on = RULES if rules is None else rules
    checked = files.groupBy("sub", "ses").agg(*[F.expr(c).alias(f"r{i}") for i, c in enumerate(on.values())], F.count("*").alias("n_files"))
    issues = F.array_compact(F.array(*[F.when(F.col(f"r{i}"), F.lit(name)) for i, name in enumerate(on)]))
    return checked.select("sub", "ses", "n_files", F.array_join(issues, "; ").alias("issues"), (F.size(issues) == 0).alias("ok"))


def dataset_summary(scans: DataFrame, files: DataFrame) -> DataFrame:
    """A10. Scans with the size of their session folder in GB (half up, 3 digits) and what is wrong."""
    size = files.groupBy("sub", "ses").agg(F.sum("length").alias("bytes"))
    gb = F.round(F.col("bytes").cast("decimal(38,0)") / F.lit(1073741824), 3).cast("double")
    return scans.join(size, ["sub", "ses"], "left").select("sub", "ses", "filename", "day", "hours", gb.alias("gb"), F.when(F.col("bytes").isNull(), "folder missing").otherwise("").alias("error"))


def compression_ratio(files: DataFrame) -> DataFrame:
    """A11. Bytes of each subject as stored and unpacked, and their ratio. Archives have their own size in `unpacked` (S11); where that is null, they count as stored bytes alone."""
    archive = F.col("ext").rlike(r"\.(gz|rar|7z)$")
    sums = files.groupBy("sub").agg(F.sum("length").alias("stored"), F.coalesce(F.sum(F.when(archive, F.col("unpacked")).otherwise(F.col("length"))), F.lit(0)).alias("unpacked"))
    return sums.withColumn("ratio", F.round(F.col("stored") / F.nullif("unpacked", F.lit(0)), 6))


def checksum(files: DataFrame, content: str = "text") -> DataFrame:
    """A19. The sidecar's checksum if there is one, else the content's; whether both agree where both are there."""
    own = F.md5(F.col(content).cast("binary"))
    return files.select("file_id", F.coalesce("md5", own).alias("md5"), F.sha2(F.col(content).cast("binary"), 256).alias("sha256"), F.when(F.col("md5").isNull(), "computed").when(F.col("md5") == own, "equal").otherwise("diff").alias("state"))


def empty_sessions(sessions: DataFrame, files: DataFrame) -> DataFrame:
    """A21. Session folders without recordings, tables or archives, and how many other files they have."""
    counts = files.groupBy("sub", "ses").agg(F.expr("count_if(ext in ('.edf', '.tsv', '.edf.gz'))").alias("useful"), F.count("*").alias("n"))
    return sessions.join(counts, ["sub", "ses"], "left").filter("coalesce(useful, 0) = 0").select("sub", "ses", F.coalesce("n", F.lit(0)).alias("others"))


def base_of(name: Column) -> Column:
    return F.regexp_extract(name, r"^(sub-\d+_ses-\d+_task-[^_]+_run-\d+)", 1)


def orphan_sidecars(files: DataFrame) -> DataFrame:
    """A22. Sidecars (json, tsv, md5) whose recording isn't there."""
    recordings = files.filter("ext in ('.edf', '.edf.gz')").select(base_of(F.col("name")).alias("base")).distinct()
    return files.filter("ext in ('.json', '.tsv', '.md5')").withColumn("base", base_of(F.col("name"))).join(recordings, "base", "left_anti").select("file_id", "name")


def archive_gate(files: DataFrame, needed: list[str]) -> DataFrame:
    """A24. Which recordings may go: those whose base name has all needed extensions. A plan, nothing is deleted."""
    base = base_of(F.col("name"))
    return files.groupBy(base.alias("base")).agg(*[F.expr(f"bool_or(ext = '{e}')").alias(f"has{i}") for i, e in enumerate(needed)], F.count("*").alias("n")).select(
        "base", "n", F.expr(" and ".join(f"has{i}" for i in range(len(needed)))).alias("may_go")
    )


def session_info(files: DataFrame) -> DataFrame:
    """A26. Files of each kind, all files and MB of each session."""
    return files.groupBy("sub", "ses").agg(
        F.expr("count_if(ext = '.edf')").alias("edf"), F.expr("count_if(ext = '.json')").alias("json"), F.expr("count_if(ext = '.tsv')").alias("tsv"),
        F.expr("count_if(ext not in ('.edf', '.json', '.tsv'))").alias("other"), F.count("*").alias("total"), F.round(F.sum("length") / 1048576, 6).alias("mb"),
    )


def audit_log(files: DataFrame, reason: str) -> DataFrame:
    """K7. One row for each folder that an action touches: reason, bytes, files, first and last time, extensions."""
    return files.groupBy("sub", "ses").agg(
        F.lit(reason).alias("reason"), F.sum("length").alias("bytes"), F.count("*").alias("n"), F.min("mtime").alias("first"), F.max("mtime").alias("last"), F.array_join(F.array_sort(F.collect_set("ext")), ";").alias("exts")
    )


def processing_index(old: DataFrame, new: DataFrame, columns: list[str]) -> DataFrame:
    """K8. The ledger with new rows in place of old ones of the same path; paths that are only in the old one are missing."""
    a, b = old.select("path", *[F.col(c).alias(f"old_{c}") for c in columns], F.lit(True).alias("was")), new.select("path", *columns, F.lit(True).alias("is_new"))
    met = a.join(b, "path", "full_outer")
    return met.select("path", *[F.coalesce(c, f"old_{c}").alias(c) for c in columns], F.when(F.col("is_new").isNull(), "missing").when(F.col("was").isNull(), "processed").otherwise("updated").alias("status"))


def check_status() -> Column:
    """ERROR where a check is unknown, PASS if both hold, else FAIL."""
    return F.when(F.col("header_ok").isNull() | F.col("notes_ok").isNull(), "ERROR").when(F.col("header_ok") & F.col("notes_ok"), "PASS").otherwise("FAIL")


def anonymisation_report(checks: DataFrame) -> DataFrame:
    """A16. Files by status: ERROR where a check is unknown, PASS if both hold, else FAIL."""
    return checks.groupBy(check_status().alias("status")).agg(F.count("*").alias("n"))


def anonymisation_issues(checks: DataFrame) -> DataFrame:
    """A16. path, status, place, issue: a row for each issue of the files that did not pass. checks: path, header_ok, notes_ok, findings (of F14: parted by semicolons, or null).

    A check that fails without a finding of its own, and one that could not be made, are issues, too; they come before the findings."""
    state = lambda c, name: F.when(F.col(c).isNull(), f"{name} not checked").when(~F.col(c), f"{name} not anonymised")
    findings = F.coalesce(F.filter(F.split("findings", "; "), lambda x: x != ""), F.array().cast("array<string>"))
    issues = F.concat(F.array_compact(F.array(state("header_ok", "header"), state("notes_ok", "annotations"))), findings)
    failed = checks.withColumn("status", check_status()).filter("status <> 'PASS'")
    return failed.select("path", "status", F.posexplode(issues).alias("place", "issue"))


def session_contents(files: DataFrame) -> DataFrame:
    """sub, ses, content (what its files are, by extension, size and checksum; null where a checksum is unknown)."""
    each = F.struct("ext", "length", "md5")
    return files.groupBy("sub", "ses").agg(F.array_sort(F.collect_list(each)).alias("all"), F.expr("bool_or(md5 is null)").alias("unknown")).select("sub", "ses", F.when(~F.col("unknown"), F.sha2(F.to_json("all"), 256)).alias("content"))


def copies_of_recordings(scans: DataFrame, files: DataFrame) -> DataFrame:
    """A23. sub, day, key, n, full: recordings of a subject with one date and duration, and whether the folders of all their sessions hold the same files."""
    from tidemark.operators.manifest import duration_key, find_duplicates

    groups = find_duplicates(scans).select("sub", "day", "key", "n")
    members = scans.select("sub", "day", duration_key().alias("key"), "ses").join(groups, ["sub", "day", "key"]).join(session_contents(files), ["sub", "ses"], "left")
    return members.groupBy("sub", "day", "key").agg(F.first("n").alias("n"), ((F.count_distinct("content") == 1) & (F.count("content") == F.count("*"))).alias("full"))


def validation_issues(files: DataFrame, sessions: DataFrame, scans: DataFrame) -> DataFrame:
    """A23. check, sub, item: a row for each finding of all checks. sessions: folders (sub, ses); scans: the manifest's rows."""
    from tidemark.operators.joins import status_outer
    from tidemark.operators.manifest import session_discrepancy

    folders = status_outer(scans, sessions, ["sub", "ses"], "missing_folder", "extra_folder", "ok").filter("status <> 'ok'")
    ses = F.concat(F.lit("ses-"), F.lpad(F.col("ses").cast("string"), 3, "0")).alias("item")
    copies = copies_of_recordings(scans, files)
    rows = lambda df, name, sub, item: df.select(F.lit(name).alias("check"), sub, item)
    named = lambda df, name: rows(df.join(files.select("path", "sub").distinct(), "path"), name, F.col("sub"), F.col("path").alias("item"))
    parts = [
        folders.select(F.col("status").alias("check"), "sub", ses),
        named(session_discrepancy(files), "session_discrepancy"),
        rows(empty_sessions(sessions, files), "empty_session", F.col("sub"), ses),
        rows(orphan_sidecars(files).join(files.select("file_id", "sub"), "file_id"), "orphan_sidecar", F.col("sub"), F.col("name").alias("item")),
        rows(duplicate_runs(files).filter("role = 'skip'"), "duplicate_run", F.col("sub"), F.concat_ws("/", "ses", "run").alias("item")),
        rows(validate_session(files).filter("not ok"), "invalid_session", F.col("sub"), ses),
        copies.select(F.when(F.col("full"), "full_copy").otherwise("partial_copy").alias("check"), "sub", F.concat_ws(" ", "day", "key").alias("item")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


CHECKS = ["missing_folder", "extra_folder", "session_discrepancy", "empty_session", "orphan_sidecar", "duplicate_run", "invalid_session", "full_copy", "partial_copy"]


def validate_all(files: DataFrame, sessions: DataFrame, scans: DataFrame) -> DataFrame:
    """A23. check, n, subjects: how many findings each check has and in how many subjects; 0 where there is none."""
    spark = files.sparkSession
    counts = validation_issues(files, sessions, scans).groupBy("check").agg(F.count("*").alias("n"), F.count_distinct("sub").alias("subjects"))
    return spark.createDataFrame([(c,) for c in CHECKS], "check string").join(counts, "check", "left").select("check", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("subjects", F.lit(0)).alias("subjects"))


def quality_rules(headers: DataFrame) -> DataFrame:
    """P11. Issues of a recording's size against its header, as a list; ok if there are none."""
    implied = F.floor((F.col("size") - F.col("header_bytes")) / F.nullif("record_bytes", F.lit(0)))
    issues = F.array_compact(F.array(
        F.when(F.col("record_bytes") <= 0, "no record size"), F.when(F.col("size") <= F.col("header_bytes"), "no data"), F.when(F.col("records") == -1, "records unknown"),
        F.when((F.col("records") != -1) & (F.abs(implied - F.col("records")) > 1), "size differs"), F.when(implied < 100, "short"),
    ))
    return headers.select("*", F.array_join(issues, "; ").alias("issues"), (F.size(issues) == 0).alias("ok"))


def partial_name_match(names: DataFrame, key: str) -> DataFrame:
    """P10. Names that hold any part of key (parts of two or more characters between _ and -), whatever the case."""
    parts = [p.lower() for p in key.replace("-", "_").split("_") if len(p) >= 2]
    return names.filter(F.exists(F.array(*map(F.lit, parts)), lambda t: F.contains(F.lower("name"), t)))


def first_k_issues(issues: DataFrame, key: str, order: list[str], k: int = 10) -> DataFrame:
    """T5. At most k issues of each file, in their order (the report's own limit)."""
    return issues.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("place") <= k)


def first_failing(texts: DataFrame, key: str, allowed: list[str]) -> DataFrame:
    """T5. key, records (with texts outside the allowed ones), unknown_chars, first_failing, sample (all texts of that record in order). texts: key, record, seq, text; empty texts are no finding."""
    bad = (F.length("text") > 0) & ~F.col("text").isin(allowed)
    each = texts.groupBy(key, "record").agg(F.sum(F.when(bad, F.length("text"))).alias("chars"), F.array_sort(F.collect_list(F.struct("seq", "text"))).alias("texts"))
    first = F.min(F.when(F.col("chars").isNotNull(), F.struct("record", "texts"))).alias("first")
    files = each.groupBy(key).agg(F.count("chars").alias("records"), F.coalesce(F.sum("chars"), F.lit(0)).alias("unknown_chars"), first)
    return files.select(key, "records", "unknown_chars", F.col("first.record").alias("first_failing"), F.col("first.texts.text").alias("sample"))


def best_file(files: DataFrame, key: str) -> DataFrame:
    """T4. The largest file of each key, the newest among equals, then the last name."""
    return files.groupBy(key).agg(F.max_by("path", F.struct("length", "mtime", "path")).alias("path"))
