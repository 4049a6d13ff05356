"""Recordings and the vendor's note files: what is made of the data source's rows (edf_files), and the same over tables with a binary column.

Bytes in a column may come from Spark's binaryFile reader or any table; large files are better read by the data source, which seeks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources import edf_files


def header(files: DataFrame, key: str = "path", content: str = "content") -> DataFrame:
    """S4. path (the key), patient, recording, start, kind, n_records (as many whole records as there are, and no more than the header says), record_s, signals, reason."""
    return edf_files.from_column(files, key, content, edf_files.Wanted("headers"))


def samples(files: DataFrame, key: str = "path", channels: list[int] | None = None, first: int = 0, stop: int | None = None, content: str = "content") -> DataFrame:
    """S5, N5. path (the key), channel, record, values (physical), reason: int16 or int24 samples of records [first, stop); other channels aren't decoded."""
    wanted = edf_files.Wanted("samples", None if channels is None else frozenset(channels), first, edf_files.MOST if stop is None else stop)
    return edf_files.from_column(files, key, content, wanted)


def events_of(found: DataFrame) -> DataFrame:
    """S6, W10. path, record, place, onset, duration, text of the data source's annotations; exact repeats in a file count where they come first, rows with a reason go."""
    first = F.min(F.struct("record", "place")).alias("first")
    return found.filter("text is not null").groupBy("path", "onset", "duration", "text").agg(first).select("path", "first.record", "first.place", "onset", "duration", "text")


TAL = r"([+-]\d+(?:\.\d*)?)(?:\x15(\d+(?:\.\d*)?))?\x14([^\x00]*?)\x14?\x00"


def annotations(files: DataFrame, key: str, content: str = "content") -> DataFrame:
    """S6, W10, of bytes that are annotation lists and nothing else. key, seq, onset, text of all lists: the first list's empty text sets the file's offset; control characters and blank texts go, exact repeats too."""
    text = F.decode(F.col(content), "ISO-8859-1")
    found = files.select(key, *[F.regexp_extract_all(text, F.lit(TAL), F.lit(i)).alias(f"g{i}") for i in (1, 2, 3)])
    rows = found.select(key, F.posexplode(F.arrays_zip("g1", "g2", "g3"))).select(key, "pos", F.col("col.g1").cast("double").alias("onset"), F.col("col.g2").try_cast("double").alias("duration"), F.col("col.g3").alias("texts"))
    offset = F.when((F.col("pos") == 0) & (F.col("texts") == ""), -F.col("onset"))
    rows = rows.withColumn("offset", F.coalesce(F.first(offset).over(Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(0.0)))
    each = rows.select(key, "pos", F.round(F.col("onset") + F.col("offset"), 6).alias("onset"), "duration", F.posexplode(F.split("texts", "\x14")).alias("part", "text"))
    clean = each.withColumn("text", F.trim(F.regexp_replace("text", r"[\x00-\x1f\x7f-\x9f]", ""))).filter("text <> ''")
    return clean.groupBy(key, "onset", "duration", "text").agg(F.min(F.struct("pos", "part")).alias("first")).select(key, F.col("first.pos").alias("seq"), "onset", "duration", "text")


def encode_tal(events: DataFrame) -> DataFrame:
    """rec, content: a recording's events as one annotation list, after the list that tells the time."""
    item = F.concat(F.lit("+"), F.format_string("%.6f", "onset"), F.lit("\x14"), "text", F.lit("\x14\x00"))
    lists = events.groupBy("rec").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", item.alias("t")))), lambda x: x["t"]), "").alias("t"))
    return lists.select("rec", F.encode(F.concat(F.lit("+0\x14\x14\x00"), "t"), "ISO-8859-1").alias("content"))


def blank_tal(content: Column) -> Column:
    """F13. The same bytes with blanks for the texts; onsets, separators and length stay. Bytes stand as characters here."""
    text = F.decode(content, "ISO-8859-1")
    parts = F.transform(F.split(text, "\x00"), lambda tal: F.concat(F.regexp_extract(tal, r"^([^\x14]*)", 1), F.regexp_replace(F.regexp_replace(tal, r"^[^\x14]*", ""), r"[^\x14]", " ")))
    return F.encode(F.array_join(parts, "\x00"), "ISO-8859-1")


def ent_events(files: DataFrame, key: str, content: str = "content") -> DataFrame:
    """S7. key, serial, stamp, text of the notes in a note file, by time."""
    text = F.decode(F.col(content), "ISO-8859-1")
    find = lambda p: F.regexp_extract_all(text, F.lit(p), F.lit(1))
    zipped = F.arrays_zip(find(r'"CreationTime", ([0-9.]+)\)').alias("a"), find(r'"Stamp", ([0-9]+)\)').alias("b"), find(r'(?s)"Text", "(.*?)"\)').alias("c"))
    return files.select(key, F.explode(zipped).alias("x")).select(key, F.col("x.a").cast("double").alias("serial"), F.col("x.b").cast("long").alias("stamp"), F.col("x.c").alias("text"))


NOTE_TOKEN = re.compile(r'\(|\)|\.(?=")|"((?:[^"\\]|\\.)*)"|([^\s(),"]+)')


def note_leaves(text: str) -> Iterator[tuple[str, str]]:
    """Path and value of each leaf of a note file's tree; list members are numbered."""
    stack: list[list] = [["", 0]]  # path, members so far
    name = None
    dotted = False
    for m in NOTE_TOKEN.finditer(text):
        t = m.group(0)
        if t == "(":
            stack.append([f"{stack[-1][0]}/{name if name is not None else stack[-1][1]}" if len(stack) > 1 or name is not None else "", 0])
            if name is None:
                stack[-2][1] += 1
            name = None
        elif t == ")":
            if len(stack) > 1:
                stack.pop()
            name = None
        elif t == ".":
            dotted = True
        else:
            value = m.group(1) if m.group(1) is not None else m.group(2)
            if dotted:
                name, dotted = value, False
            else:
                yield f"{stack[-1][0]}/{name if name is not None else stack[-1][1]}", value
                stack[-1][1] += name is None
                name = None


#: Leaves of an Arrow batch.
LEAVES = 16_384


def leaf_batches(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """key, path, value of the leaves of note files (key, content): one file's bytes and at most LEAVES leaves are held beside the batch that came."""
    held: list[tuple[str, str, str]] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], pa.string()) for i in range(3)], names=[key, "path", "value"])

    for b in batches:
        for k, c in zip(b.column(0), b.column(1), strict=True):
            name = k.as_py()
            for path, value in note_leaves((c.as_py() or b"").decode("latin-1")):
                held.append((name, path, value))
                if len(held) >= LEAVES:
                    yield batch()
                    held = []
    if held:
        yield batch()


def key_values(files: DataFrame, key: str, content: str = "content") -> DataFrame:
    """S8. key, path, value: a note file's tree, one row for each leaf."""
    spark = files.sparkSession
    # a batch of whole files would be as large as its files
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return files.select(F.col(key).cast("string").alias(key), content).mapInArrow(lambda batches: leaf_batches(batches, key), f"{key} string, path string, value string")


def quick_metadata(files: DataFrame, key: str, content: str = "content", prefix: int = 361) -> DataFrame:
    """S9. study, eeg_no, machine, start serial from the text after a prefix; the first label that is there wins."""
    text = F.decode(F.substring(F.col(content), F.lit(prefix + 1), F.length(content)), "ISO-8859-1")
    of = lambda *labels: F.coalesce(*[F.nullif(F.regexp_extract(text, rf'"{x}", "?([^")]*)', 1), F.lit("")) for x in labels])
    return files.select(key, of("StudyName", "Study").alias("study"), of("EegNo", "EEGNo").alias("eeg_no"), of("Machine").alias("machine"), of("RecordingStartTime", "CreationTime").alias("start"))


def log_mappings(lines: DataFrame) -> DataFrame:
    """S10. log, source, target: each output line with the last input line before it, which no other output has had yet."""
    w = Window.partitionBy("log").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    source = F.nullif(F.regexp_extract("line", r"anonymization of: (.*\.EDF)", 1), F.lit(""))
    target = F.nullif(F.regexp_extract("line", r"Output will be saved to: .*(sub-\S*\.edf)", 1), F.lit(""))
    marked = lines.select("log", "n", source.alias("source"), target.alias("target")).filter("source is not null or target is not null")
    before = marked.withColumn("last", F.last(F.struct("n", "source", "target")).over(w))
    return before.filter("target is not null and last.source is not null").select("log", F.col("last.source").alias("source"), "target")


def gzip_size(content: Column) -> Column:
    """S11. The unpacked size that a gzip file's last four bytes tell (modulo 4 GiB)."""
    h = F.hex(F.substring(content, -4, 4))
    return F.conv(F.concat(*[F.substring(h, i, 2) for i in (7, 5, 3, 1)]), 16, 10).cast("long")


def chunk_hashes(files: DataFrame, key: str, content: str = "content", head: int = 256, size: int = 102400) -> DataFrame:
    """A20. key, chunk (-1 is the header), sha256 of each part of a file, hashed in the task that has its bytes."""
    rows = edf_files.from_column(files, key, content, edf_files.Wanted("chunks", head=head, piece=size))
    return rows.filter("chunk is not null").select(F.col("path").cast(files.schema[key].dataType).alias(key), "chunk", "sha256")


def verify_chunks(known: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """A20. What differs: a header or a chunk of other content, or one that is missing."""
    met = known.join(now.withColumnRenamed("sha256", "other"), [key, "chunk"], "left")
    state = F.when(F.col("other").isNull(), "missing").when((F.col("other") != F.col("sha256")) & (F.col("chunk") < 0), "header mismatch").when(F.col("other") != F.col("sha256"), "chunk mismatch")
    return met.select(key, "chunk", state.alias("state")).filter("state is not null")


def verify_anonymized(headers: DataFrame, events: DataFrame, allowed: list[str]) -> DataFrame:
    """F14. path, findings: a patient field that isn't blotted out, a recording field without the neutral start, texts outside the allowed ones, and why a file can't be read."""
    checks = F.array(F.when(F.col("patient") != "X X X X", "patient"), F.when(~F.col("recording").startswith("Startdate X X X X"), "recording"), F.when(F.col("reason").isNotNull(), F.concat(F.lit("unread: "), "reason")))
    of_heads = headers.select("path", F.explode(F.array_compact(checks)).alias("finding"))
    of_texts = events.filter("text is not null").filter(~F.col("text").isin(allowed)).select("path", F.concat(F.lit("text: "), "text").alias("finding"))
    return of_heads.unionByName(of_texts).groupBy("path").agg(F.array_join(F.array_sort(F.collect_set("finding")), "; ").alias("findings"))


def recording_summary(headers: DataFrame, events: DataFrame, attempts: DataFrame) -> DataFrame:
    """A27. path, status, tries, seconds, n_signals, labels, n_annotations, patient_blank, recording_blank, day_neutral, note of each file.

    attempts: path, tries, error (of the last try, or null). status: skipped where a file was never tried, failed where its last try has an error or its header can't be read, else
    done. The flags tell whether the header is free of personal data: only X in the patient field, the recording field's neutral start, a day of 1985-01-01."""
    texts = events.filter("text is not null").groupBy("path").agg(F.count("*").alias("n_annotations"))
    met = headers.join(attempts.select("path", "tries", "error"), "path", "full").join(texts, "path", "left")
    tries = F.coalesce("tries", F.lit(0)).cast("int")
    unread = F.coalesce("error", F.when(F.col("signals").isNull(), F.coalesce("reason", F.lit("no such file"))))
    status = F.when(tries == 0, "skipped").when(unread.isNotNull(), "failed").otherwise("done")
    return met.select(
        "path", status.alias("status"), tries.alias("tries"), (F.col("n_records") * F.col("record_s")).alias("seconds"), F.size("signals").alias("n_signals"), F.array_join("signals.label", ",").alias("labels"),
        F.coalesce("n_annotations", F.lit(0)).alias("n_annotations"), F.col("patient").rlike("^[X ]+$").alias("patient_blank"), F.col("recording").startswith("Startdate X X X X").alias("recording_blank"),
        (F.col("day") == "01.01.85").alias("day_neutral"), F.coalesce(unread, F.col("reason")).alias("note"),
    )


def status_totals(summary: DataFrame) -> DataFrame:
    """A27. status, files, tries, seconds."""
    return summary.groupBy("status").agg(F.count("*").alias("files"), F.sum("tries").alias("tries"), F.sum("seconds").alias("seconds"))
