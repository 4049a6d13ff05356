"""Scan manifests: names, recording kinds, days, duplicates, numbering and ordering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAME = r"^(?:.*/)?(sub-\d+)_(ses-\d+)(?:_task-([A-Za-z0-9]+))?(?:_run-(\d+))?_([A-Za-z0-9]+)(\.[A-Za-z0-9.]+)$"


def parse_bids_name(df: DataFrame, name: str = "filename") -> DataFrame:
    """S3. subject, session, task, run, suffix, ext; null where the name has none, valid tells whether it fits at all."""
    part = [F.nullif(F.regexp_extract(name, NAME, i), F.lit("")).alias(c) for i, c in enumerate(["subject", "session", "task", "run", "suffix", "ext"], 1)]
    return df.select(name, *part, F.col(name).rlike(NAME).alias("valid"))


def validate_scans_columns(df: DataFrame) -> DataFrame:
    """P2. filename, acq_time, duration, format of rows below ieeg/; names fit case-insensitively and trimmed, a missing format is n/a."""
    at = {c.strip().lower(): c for c in df.columns}
    missing = [c for c in ("filename", "acq_time", "duration") if c not in at]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    kind = F.coalesce(F.nullif(F.trim(F.col(f"`{at['format']}`")), F.lit("")), F.lit("n/a")) if "format" in at else F.lit("n/a")
    return df.select(*[F.col(f"`{at[c]}`").alias(c) for c in ("filename", "acq_time", "duration")], kind.alias("format")).filter(F.col("filename").contains("ieeg/"))


def recording_type(df: DataFrame, signals: str, hours: str, reserved: str, least: int = 60, clip_h: float = 5.0) -> DataFrame:
    """P5. Adds kind (iEEG from `least` signals), task (clip below clip_h hours), container (EDF+C, EDF+D, BDF, EDF)."""
    container = F.when(F.col(reserved).startswith("EDF+C"), "EDF+C").when(F.col(reserved).startswith("EDF+D"), "EDF+D").when(F.col(reserved).contains("24BIT"), "BDF").otherwise("EDF")
    return df.withColumns({"kind": F.when(F.col(signals) >= least, "iEEG").otherwise("Scalp"), "task": F.when(F.col(hours) < clip_h, "clip").otherwise("full"), "container": container})


def bids_class(df: DataFrame, path: str = "path") -> DataFrame:
    """P6. Class of a file by its place and name."""
    name = F.element_at(F.split(F.col(path), "/"), -1)
    edf = F.lower(name).rlike(r"\.edf$")
    kind = F.when(edf & name.rlike(r"^sub-\d+_ses-\d+_"), "bids").when(edf & ~F.col(path).contains("/"), "root_edf").when(edf, "unexpected_edf").when(F.lower(name).rlike(r"\.(eeg|ent|stc|vtc)$"), "native").otherwise("other")
    return df.select(path, kind.alias("class"))


def session_of(text: Column) -> Column:
    return F.regexp_extract(text, r"ses-(\d+)", 1)


def bids_roots(files: DataFrame) -> DataFrame:
    """P12. folder, subjects (folders sub-<id> with a file), sessions (of those, with a file), is_root (one subject or more) of each top folder. files: path, below the top folder."""
    at = F.split("path", "/")
    subject = F.when(F.get(at, F.lit(1)).rlike("^sub-[A-Za-z0-9]+$") & (F.size(at) > 2), F.get(at, F.lit(1)))
    session = F.when(subject.isNotNull() & F.get(at, F.lit(2)).rlike("^ses-[A-Za-z0-9]+$") & (F.size(at) > 3), F.concat_ws("/", subject, F.get(at, F.lit(2))))
    seen = files.groupBy(F.get(at, F.lit(0)).alias("folder")).agg(F.count_distinct(subject).alias("subjects"), F.count_distinct(session).alias("sessions"))
    return seen.withColumn("is_root", F.col("subjects") > 0)


def session_discrepancy(df: DataFrame, path: str = "path") -> DataFrame:
    """P7. Files whose folder has another session number than their name; where either has none there is no discrepancy."""
    folder, name = session_of(F.regexp_extract(path, r"^(.*)/", 1)), session_of(F.element_at(F.split(F.col(path), "/"), -1))
    return df.select(path, folder.alias("folder_session"), name.alias("name_session")).filter("folder_session <> name_session and folder_session <> '' and name_session <> ''")


def recent(df: DataFrame, dominant: str, latest: str, now_s: int, days: int | None) -> DataFrame:
    """P8. Adds recent: either date lies within `days` of now; null where days is not given."""
    near = lambda c: F.col(c) >= now_s - (days or 0) * 86400
    return df.withColumn("recent", F.lit(None).cast("boolean") if days is None else F.coalesce(near(dominant), F.lit(False)) | F.coalesce(near(latest), F.lit(False)))


def duration_by_day(scans: DataFrame, good_h: float = 23.0) -> DataFrame:
    """A2. sub, day, n, hours, state: missing days between a subject's first and last one count too; the first and last only warn."""
    sums = scans.groupBy("sub", "day").agg(F.count("*").alias("n"), F.round(F.sum("hours"), 6).alias("hours"))
    calendar = sums.groupBy("sub").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    days = calendar.select("sub", "first", "last", F.explode(F.expr("transform(sequence(to_date(first), to_date(last)), x -> cast(x as string))")).alias("day")).join(sums, ["sub", "day"], "left")
    edge = (F.col("day") == F.col("first")) | (F.col("day") == F.col("last"))
    state = F.when(F.col("n").isNull(), "missing").when(F.col("hours") >= good_h, "good").when(edge, "warn").otherwise("err")
    return days.select("sub", "day", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("hours", F.lit(0.0)).alias("hours"), state.alias("state"))


def duration_key(text: str = "duration") -> Column:
    """Thousandths of a numeric duration by integers, so that all engines round alike; other text trimmed."""
    number = F.expr(f"try_cast(trim({text}) as double)")
    milli = F.floor((F.round(number * 1e6).cast("long") + 500) / 1000).cast("long")
    return F.when(number.isNotNull(), milli.cast("string")).otherwise(F.trim(text))


def find_duplicates(scans: DataFrame) -> DataFrame:
    """A4. sub, day, key, n, sessions: recordings of a subject with the same date and duration."""
    groups = scans.groupBy("sub", "day", duration_key().alias("key")).agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list("ses")), lambda x: x.cast("string")), ",").alias("sessions"))
    return groups.filter("n > 1")


def subject_session_counts(files: DataFrame) -> DataFrame:
    """A18. Sessions of each subject; subject null is the total."""
    pairs = files.filter("sub is not null").select("sub", "ses").distinct()
    return pairs.rollup("sub").agg(F.count("*").alias("n_sessions"))


def global_sessions(runs: DataFrame) -> DataFrame:
    """W2. Sessions of a subject numbered by their first acquisition, as 001, 002 and so on."""
    first = runs.groupBy("sub", "ses").agg(F.min("acq_time").alias("first"))
    return first.selectExpr("sub", "ses", "first", "lpad(cast(dense_rank() over (partition by sub order by first, ses) as string), 3, '0') as global_ses")


def normalize_sessions(scans: DataFrame) -> DataFrame:
    """W3. Renumber a subject's sessions to 1..N in their order; the number is replaced everywhere in the path."""
    ranked = scans.selectExpr("sub", "ses", "filename", "dense_rank() over (partition by sub order by ses) as new_ses")
    return ranked.selectExpr("sub", "ses", "cast(new_ses as bigint) as new_ses", "replace(filename, concat('ses-', lpad(cast(ses as string), 3, '0')), concat('ses-', lpad(cast(new_ses as string), 3, '0'))) as filename")


def sessions_by_study_date(scans: DataFrame) -> DataFrame:
    """W4. Recordings of one date share a session number; runs count by time."""
    return scans.selectExpr(
        "sub", "filename", "day", "cast(dense_rank() over (partition by sub order by day) as bigint) as study_session", "cast(row_number() over (partition by sub, day order by acq_time, filename) as bigint) as study_run"
    )


def first_appearance(df: DataFrame, key: str, order: str, keep: str = "first") -> DataFrame:
    """W9. One row for each key: the first or last in source order; 'error' raises if a key comes twice."""
    if keep == "error":
        if df.groupBy(key).count().filter("count > 1").limit(1).count():
            raise ValueError(f"{key} repeats")
        return df
    by = F.col(order).asc() if keep == "first" else F.col(order).desc()
    from pyspark.sql import Window

    return df.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(by))).filter("place = 1").drop("place")


def coverage_rows(scans: DataFrame, sort_by: str = "start", most: int | None = None) -> DataFrame:
    """T1. label, start, stop of recordings; times in epoch seconds or as yyyy-MM-ddTHH:mm:ss, decimal commas allowed; rows without a time or with a length below 0 go.

    most: the first so many in order (a screen's limit); without it all rows, in no order."""
    hours = F.expr("try_cast(replace(trim(duration), ',', '.') as double)")
    start = F.coalesce(F.expr("cast(floor(try_cast(trim(acq_time) as double)) as bigint)"), F.expr("unix_timestamp(try_to_timestamp(trim(acq_time), \"yyyy-MM-dd'T'HH:mm:ss\"))"))
    rows = scans.select(F.coalesce(F.nullif(F.trim("filename"), F.lit("")), F.lit("row")).alias("label"), start.alias("start"), F.round(hours * 3600).cast("long").alias("length"))
    rows = rows.filter("start is not null and length >= 0").selectExpr("label", "start", "start + length as stop")
    order = ["start", "stop", "label"] if sort_by == "start" else ["label", "start", "stop"]
    return rows.orderBy(*order).limit(most) if most is not None else rows


def coverage_checked(scans: DataFrame, numeric_share: float = 0.8) -> DataFrame:
    """T1. row, label, start, stop, reason: every row of a manifest as an interval in epoch seconds, or why it is none. scans: row (its number), filename, acq_time, duration.

    Where numeric_share or more of all times are numbers, times are epoch seconds, else texts (a T or a blank before the clock). Marks of byte order go, decimal commas count; an
    empty label is row_<number>. Reasons: bad start, bad duration, end before start."""
    clean = lambda c: F.trim(F.replace(F.coalesce(c, F.lit("")), F.lit("\ufeff"), F.lit("")))
    rows = scans.select("row", clean("filename").alias("name"), clean("acq_time").alias("t"), F.replace(clean("duration"), F.lit(","), F.lit(".")).try_cast("double").alias("hours"))
    seconds = F.col("t").try_cast("double")
    share = rows.agg(F.avg(seconds.isNotNull().cast("int"))).first()[0] or 0.0
    texts = F.unix_timestamp(F.coalesce(*[F.try_to_timestamp("t", F.lit(p)) for p in ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss")]))
    start = F.floor(seconds).cast("long") if share >= numeric_share else texts
    reason = F.when(F.col("start").isNull(), "bad start").when(F.col("hours").isNull() | F.isnan("hours"), "bad duration").when(F.col("hours") < 0, "end before start")
    rows = rows.withColumn("start", start).withColumn("reason", reason)
    label = F.when(F.col("name") == "", F.concat(F.lit("row_"), F.col("row").cast("string"))).otherwise(F.col("name"))
    return rows.select("row", label.alias("label"), "start", F.when(F.col("reason").isNull(), F.col("start") + F.round(F.col("hours") * 3600).cast("long")).alias("stop"), "reason")


def time_axis(rows: DataFrame, key: str, hours: float = 48.0) -> DataFrame:
    """T2. key, label, unit, offset, length: bars of each key on an axis from its first start, in hours where it spans `hours` or fewer, else in days. rows: key, label, start, stop in seconds."""
    ends = rows.groupBy(key).agg(F.min("start").alias("first"), F.max("stop").alias("last"))
    unit = F.when(F.col("last") - F.col("first") <= hours * 3600, "hours").otherwise("days")
    scale = F.when(F.col("unit") == "hours", 3600.0).otherwise(86400.0)
    met = rows.join(ends, key).withColumn("unit", unit)
    # rounded in doubles, as SQL does: a second may lie on a tie of the sixth place of a day, where the decimal text rounds apart
    places = lambda x: F.round(x / scale * 1e6) / 1e6
    return met.select(key, "label", "unit", places(F.col("start") - F.col("first")).alias("offset"), places(F.col("stop") - F.col("start")).alias("length"))


def strip_common_prefix(df: DataFrame, key: str, label: str) -> DataFrame:
    """T2. Labels of each key without their longest common directory: that of the smallest and the largest label."""
    ends = df.groupBy(key).agg(F.min(label).alias("lo"), F.max(label).alias("hi"))
    same = F.expr("aggregate(sequence(1, greatest(length(lo), 1)), 0, (n, i) -> if(n = i - 1 and substring(lo, i, 1) = substring(hi, i, 1) and i <= length(hi), i, n))")
    cut = F.length(F.regexp_extract(F.expr("substring(lo, 1, same)"), r"^(.*/)", 1))
    prefix = ends.withColumn("same", same).select(key, cut.alias("cut"))
    return df.join(prefix, key).select(key, label, F.expr(f"substring({label}, cut + 1)").alias("short"))


def natural_key(name: str) -> Column:
    """Digit runs padded to 20 places."""
    return F.concat_ws("", F.transform(F.regexp_extract_all(F.col(name), F.lit(r"(\d+|\D+)"), F.lit(1)), lambda t: F.when(t.rlike("^[0-9]+$"), F.lpad(t, 20, "0")).otherwise(t)))


def natural_sort(df: DataFrame, key: str, name: str) -> DataFrame:
    """T3. key, name, place: names of each key in natural order."""
    return df.withColumn("nk", natural_key(name)).selectExpr(key, name, f"cast(row_number() over (partition by {key} order by nk, {name}) as bigint) as place")


def next_session(existing: DataFrame) -> DataFrame:
    """T6. The number after a subject's highest, as three digits; 001 without any."""
    return existing.groupBy("sub").agg(F.lpad((F.coalesce(F.max("ses"), F.lit(0)) + 1).cast("string"), 3, "0").alias("next_ses"))


def sort_list(df: DataFrame, key: str, mode: str = "size_desc") -> DataFrame:
    """T7. Places of a key's names by name or size; an unknown size counts as -1."""
    order = {"name": "name", "name_desc": "name desc", "size": "coalesce(length, -1), name", "size_desc": "coalesce(length, -1) desc, name"}[mode]
    return df.selectExpr(key, "name", "length", f"cast(row_number() over (partition by {key} order by {order}) as bigint) as place")
