"""Tab-separated manifests: reading as text, typing afterwards, and the writers of a dataset's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_tsv(spark: SparkSession, path: str, comment: str | None = None, sep: str = "\t", encoding: str = "UTF-8") -> DataFrame:
    """S1. All columns as text; `n/a` and empty stay as they are, lines that start with comment go."""
    options = {"sep": sep, "header": True, "encoding": encoding, "quote": "", "escape": "", "emptyValue": "", "nullValue": "\x00"}
    df = spark.read.options(**options, **({"comment": comment} if comment else {})).csv(path)
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def typed_scans(df: DataFrame) -> DataFrame:
    """S1. Adds acq_s (epoch seconds) and duration_h; text that is neither is null."""
    return df.withColumns({"acq_s": F.expr("unix_timestamp(try_to_timestamp(replace(acq_time, ' ', 'T'), \"yyyy-MM-dd'T'HH:mm:ss\"))"), "duration_h": F.expr("try_cast(trim(duration) as double)")})


def write_tsv(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Nulls become n/a; one folder for each value of `by`."""
    text = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("n/a")).alias(c) for c in df.columns])
    writer = text.write.options(sep="\t", header=True, quote="", escape="", emptyValue="")
    (writer.partitionBy(*by) if by else writer).csv(path)


def list_files(spark: SparkSession, root: str, ext: str | None = None, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """S2. path, name, ext, length, modified of all files below root; glob lists hold for names. The contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length", F.col("modificationTime").alias("modified"))
    name = F.element_at(F.split("path", "/"), -1)
    out = files.withColumns({"name": name, "ext": F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1))})
    like = lambda g: F.col("name").rlike("^" + "".join(".*" if c == "*" else "." if c == "?" else "\\" + c if not c.isalnum() else c for c in g) + "$")
    if ext:
        out = out.filter(F.col("ext") == "." + ext.lower().lstrip("."))
    for g in exclude or []:
        out = out.filter(~like(g))
    if include:
        any_ = like(include[0])
        for g in include[1:]:
            any_ |= like(g)
        out = out.filter(any_)
    return out


def participants(new: DataFrame, existing: DataFrame) -> DataFrame:
    """K1. One row for each participant: those there, and new ones by id; age 89+ from 89 on, sex X if unknown."""
    age = F.when(F.col("age").isNull(), "n/a").when(F.col("age") >= 89, "89+").otherwise(F.col("age").cast("string"))
    rows = new.select("participant_id", age.alias("age"), F.coalesce("sex", F.lit("X")).alias("sex"), F.coalesce("group", F.lit("n/a")).alias("group"))
    rows = rows.groupBy("participant_id").agg(F.min(F.struct("age", "sex", "group")).alias("r")).select("participant_id", "r.*")
    return existing.unionByName(rows.join(existing.select("participant_id"), "participant_id", "left_anti"))


def scans_rows(new: DataFrame, existing: DataFrame, shift_days: int = 0) -> DataFrame:
    """K2. Rows of recordings that aren't there yet after the others; missing values n/a, days shifted back if asked."""
    day = F.concat(F.date_sub(F.to_date(F.substring("acq_time", 1, 10)), shift_days).cast("string"), F.substring("acq_time", 11, 20))
    rows = new.select("filename", F.coalesce(day, F.lit("n/a")).alias("acq_time"), F.when(F.col("hours").isNotNull(), F.format_string("%.4f", "hours")).otherwise("n/a").alias("duration"), F.coalesce("edf_type", F.lit("n/a")).alias("edf_type"))
    return existing.unionByName(rows.join(existing.select("filename"), "filename", "left_anti"))


def channel_type(label: Column) -> Column:
    t = F.upper(F.trim(label))
    return F.when(t.rlike("^(EKG|ECG)"), "ECG").when(t.rlike("^EMG"), "EMG").when(t.rlike("^(EOG|LOC|ROC)"), "EOG").when(t.rlike(r"^(DC\d+|TRIG)"), "TRIG").when(t.rlike("ANNOTATIONS"), "MISC").otherwise("SEEG")


def channels(signals: DataFrame) -> DataFrame:
    """K3. One row for each channel: type by label, μV for uV, cutoffs from the prefilter text, group before the first digit."""
    cut = lambda kind: F.coalesce(F.nullif(F.regexp_extract("prefilter", rf"(?i){kind}[:\s]*([0-9]+\.?[0-9]*)", 1), F.lit("")), F.lit("n/a"))
    return signals.select(
        "rec", F.trim("label").alias("name"), channel_type(F.col("label")).alias("type"), F.replace("unit", F.lit("uV"), F.lit("μV")).alias("units"), cut("HP").alias("low_cutoff"), cut("LP").alias("high_cutoff"),
        F.col("rate").cast("string").alias("sampling_frequency"), F.regexp_extract(F.trim("label"), r"^([^0-9]*)", 1).alias("group"),
    )


def electrodes(channel_rows: DataFrame, kind: str = "SEEG", **fixed: str) -> DataFrame:
    """K4. Channels of the main kind without coordinates; size, material and the like come from the caller."""
    return channel_rows.filter(F.col("type") == kind).select("rec", "name", *[F.lit("n/a").alias(c) for c in "xyz"], *[F.lit(v).alias(k) for k, v in fixed.items()])


def events_rows(events: DataFrame) -> DataFrame:
    """K5. onset, duration, time_abs, time_rel, trial_type as text in the order of the onsets: three decimals, n/a for what is missing (also a column that the table hasn't)."""
    ordered = events.repartition("rec").sortWithinPartitions("rec", "onset", "seq")
    text = lambda c: F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), F.lit("n/a")) if c in events.columns else F.lit("n/a")
    return ordered.select("rec", F.coalesce(F.format_string("%.3f", F.col("onset")), F.lit("n/a")).alias("onset"), *[text(c).alias(c) for c in ("duration", "time_abs", "time_rel")], text("text").alias("trial_type"))


def sidecar(channel_rows: DataFrame, kinds: list[str]) -> DataFrame:
    """K6. rec, json: how many channels of each kind a recording has, 0 for none."""
    counts = channel_rows.groupBy("rec").pivot("type", kinds).count().na.fill(0)
    return counts.select("rec", F.to_json(F.struct(*[F.col(k).alias(f"{k}ChannelCount") for k in kinds])).alias("json"))


#: The standard's names of counts, by type of channel.
COUNTS = {"EEG": "EEGChannelCount", "SEEG": "SEEGChannelCount", "EOG": "EOGChannelCount", "ECG": "ECGChannelCount", "EMG": "EMGChannelCount", "ECOG": "ECOGChannelCount", "MISC": "MiscChannelCount", "TRIG": "TriggerChannelCount"}


def sidecar_json(channel_rows: DataFrame, recordings: DataFrame, equipment: dict[str, str], main: str = "SEEG") -> DataFrame:
    """K6. rec, json of each recording: task, what `equipment` says, sampling rate and hardware filters of its first channel of the main kind by name (n/a without one), duration in seconds to
    three places, counts of channels by kind. recordings: rec, task, hours; a recording without channels counts none."""
    counts = [F.count_if(F.col("type") == kind).alias(name) for kind, name in COUNTS.items()]
    first = F.min(F.when(F.col("type") == main, F.struct("name", "low_cutoff", "high_cutoff", "sampling_frequency"))).alias("first")
    met = recordings.join(channel_rows.groupBy("rec").agg(*counts, first), "rec", "left")
    known = lambda c: F.coalesce(F.col(f"first.{c}"), F.lit("n/a"))
    cutoff = lambda c: F.struct(known(c).alias("Cutoff (Hz)"))
    before = [
        F.col("task").alias("TaskName"), *[F.lit(v).alias(k) for k, v in equipment.items()], known("sampling_frequency").alias("SamplingFrequency"),
        F.struct(cutoff("low_cutoff").alias("HighpassFilter"), cutoff("high_cutoff").alias("LowpassFilter")).alias("HardwareFilters"), F.lit("n/a").alias("SoftwareFilters"),
    ]
    after = [F.lit("continuous").alias("RecordingType"), *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS.values()]]
    # as a plain number: to_json writes 1.0E7 seconds and more with an exponent
    plain = F.regexp_replace(F.round(F.col("hours") * 3600, 3).try_cast("decimal(30,3)").cast("string"), r"(\.\d+?)0+$", "$1")
    duration = F.coalesce(F.concat(F.lit(',"RecordingDuration":'), plain), F.lit(""))
    head, tail = F.to_json(F.struct(*before)), F.to_json(F.struct(*after))
    return met.select("rec", head.alias("h"), duration.alias("d"), tail.alias("t")).selectExpr("rec", "concat(left(h, length(h) - 1), d, ',', substring(t, 2)) as json")


def split_manifest(scans: DataFrame, archives: DataFrame, existing: DataFrame) -> DataFrame:
    """K9. Rows of sessions that hold archives and have no manifest of their own yet."""
    return scans.join(archives.select("sub", "ses").distinct(), ["sub", "ses"], "left_semi").join(existing.select("sub", "ses").distinct(), ["sub", "ses"], "left_anti")
