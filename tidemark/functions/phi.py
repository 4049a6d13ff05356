"""Personal data in text: patterns, redaction, header checks. Column expressions only."""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Redaction patterns in their order, and what each becomes.
REDACTIONS = [
    (r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}", "[REDACTED_EMAIL]"),
    (r"\b(\+?\d{1,2}[\s\-]?)?(\(?\d{3}\)?[\s\-]?)\d{3}[\s\-]?\d{4}\b", "[REDACTED_PHONE]"),
    (r"\b\d{4}-\d{2}-\d{2}\b", "[REDACTED_DATE]"),
    (r"\b\d{1,2}/\d{1,2}/\d{2,4}\b", "[REDACTED_DATE]"),
    (r"\b\d{7,}\b", "[REDACTED_ID]"),
]
# What a text must hold for a pattern to match: told apart by one cheap look before the pattern is tried at every place.
NEEDED = {p: "@" if "@" in p else r"\d" if r"\d{" in p else None for p, _ in REDACTIONS}
# Patterns that are looked for, the group that is reported, and their labels.
FINDINGS = [
    (r"\b[A-Z][a-z]+\s+[A-Z][a-z]+\b", 0, "possible name"),
    (r"\b[A-Z0-9]{6,}\b", 0, "possible ID"),
    (r"\b\d{1,2}[-/\.]\d{1,2}[-/\.]\d{2,4}\b", 0, "possible date"),
    (r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", 0, "email address"),
    (r"\b\d{3}[-.)]\d{3}[-.)]\d{4}\b", 0, "phone number"),
    (r"\b\d{3}-\d{2}-\d{4}\b", 0, "possible SSN"),
    (r"\b(patient|name|doctor|physician|nurse|hospital)\s*:\s*([A-Za-z]+)", 1, "labeled identifier"),
]
# Words that are no finding.
STOP_WORDS = ["patient", "doctor", "name", "test", "hospital", "record", "eeg", "ecg", "emg", "anonymous", "anonymized"]
# Patient fields that are anonymous, and patterns of those that aren't, in order.
ANONYMOUS = ["", "X", "X X X X", "Anonymized", "XXXX"]
SUSPICIOUS = [r"[A-Za-z]+\s+[A-Za-z]+", r"[A-Z0-9]{6,}", r"\d{1,2}[-/\.]\d{1,2}[-/\.]\d{2,4}", r"\d{4}[-/\.]\d{1,2}[-/\.]\d{1,2}"]


def redact(text: Column, patterns: list[tuple[str, str]] = REDACTIONS) -> Column:
    """F1 (and D1 with a caller's pattern table). Every pattern in turn, then control characters go; null becomes empty."""
    out = F.coalesce(text, F.lit(""))
    known = NEEDED if patterns is REDACTIONS else {}
    for needed, run in groupby(patterns, lambda p: known.get(p[0])):
        changed = out
        for pattern, becomes in run:
            changed = F.regexp_replace(changed, pattern, becomes)
        # no pattern puts in what one of these needs, so the text itself tells; a branch is all that is evaluated
        out = changed if needed is None else F.when(text.contains(needed) if needed == "@" else text.rlike(needed), changed).otherwise(out)
    return F.regexp_replace(out, r"[\p{Cc}\p{Cf}\p{Zl}\p{Zp}]|[\p{Zs}&&[^ ]]", "")


def find(df: DataFrame, key: str, text: str) -> DataFrame:
    """F2. key, label, match, n: what each pattern finds in the printable parts of more than two characters."""
    parts = F.explode(F.expr(f"filter(split({text}, '[^\\\\x20-\\\\x7e]+'), x -> length(x) > 2)")).alias("part")
    part, none = F.col("part"), F.array().cast("array<string>")
    digit = part.rlike(r"\d")
    needed = {"possible date": digit, "email address": part.contains("@"), "phone number": digit, "possible SSN": digit, "labeled identifier": part.contains(":")}
    found = lambda p, g: F.regexp_extract_all("part", F.lit(p), F.lit(g))
    each = [F.struct(F.lit(label).alias("label"), (F.when(needed[label], found(p, g)).otherwise(none) if label in needed else found(p, g)).alias("found")) for p, g, label in FINDINGS]
    hits = F.array(*each)
    each = df.select(key, parts).select(key, F.explode(hits).alias("h")).select(key, "h.label", F.explode("h.found").alias("match"))
    return each.filter((F.length("match") > 3) & ~F.lower("match").isin(STOP_WORDS)).groupBy(key, "label", "match").agg(F.count("*").alias("n"))


def header_check(df: DataFrame, patient: str) -> DataFrame:
    """P9. Adds anonymized and reason: allowed values, then suspicious patterns in order, then X and blanks only."""
    p = F.trim(F.coalesce(F.col(patient), F.lit("")))
    reason = F.when(p.isin(ANONYMOUS), None)
    for pattern in SUSPICIOUS:
        reason = reason.when(p.rlike(pattern), F.concat(F.lit("possible identifier: "), F.regexp_extract(p, f"({pattern})", 1)))
    reason = reason.when(p.rlike(r"^[X\s]+$"), None).otherwise(F.concat(F.lit("non-standard: "), p))
    return df.withColumn("reason", reason).withColumn("anonymized", F.col("reason").isNull())


def normalize(text: Column) -> Column:
    """F15. Written and real line ends become one; blanks collapse; only printable ASCII and line ends stay."""
    out = F.replace(F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\r\\n"), F.lit("\n")), F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\n"))
    out = F.regexp_replace(F.regexp_replace(out, "\r\n?", "\n"), r"[^\x20-\x7e\n]", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(out, " +", " "), r" ?\n ?", "\n"))


def scrub_header(patient: Column, recording: Column, edf_plus: Column) -> tuple[Column, Column]:
    """F12. Fixed-width header fields without personal data: EDF+ keeps the form, others lose the whole text."""
    patient_out = F.rpad(F.when(edf_plus, "X X X X").otherwise(""), 80, " ")
    recording_out = F.rpad(F.when(edf_plus | recording.startswith("Startdate"), "Startdate X X X X").otherwise(""), 80, " ")
    return patient_out, recording_out


#: An EDF+ file's subfields, in order.
PATIENT_PARTS, RECORDING_PARTS = ["code", "sex", "birthdate", "name"], ["Startdate", "startdate", "administration", "technician", "equipment"]


def scrub_subfields(patient: Column, recording: Column, keep: set[str]) -> tuple[Column, Column]:
    """F12. An EDF+ file's patient and recording fields with X for each subfield that isn't in keep; additional ones go unless keep has `additional`. Fields that haven't the form lose all, and
    80 characters are kept."""

    def scrubbed(text: Column, parts: list[str], fixed: int) -> Column:
        words = F.filter(F.split(F.trim(F.coalesce(text, F.lit(""))), " +"), lambda w: w != "")
        shown = [F.lit(p) if i < fixed else F.get(words, i) if p in keep else F.lit("X") for i, p in enumerate(parts)]
        more = F.slice(words, len(parts) + 1, F.greatest(F.size(words) - len(parts), F.lit(0))) if "additional" in keep else F.array().cast("array<string>")
        formed = (F.size(words) >= len(parts)) & (F.get(words, 0) == parts[0] if fixed else F.lit(True))
        blank = " ".join([p if i < fixed else "X" for i, p in enumerate(parts)])
        return F.rpad(F.when(formed, F.array_join(F.concat(F.array(*shown), more), " ")).otherwise(blank), 80, " ")

    return scrubbed(patient, PATIENT_PARTS, 0), scrubbed(recording, RECORDING_PARTS, 1)


def name_variants(people: DataFrame, separators: list[str]) -> DataFrame:
    """S14. name: the spellings of each person: single names, full and reversed with each separator, initials."""
    first, last = F.nullif(F.trim("firstname"), F.lit("")), F.nullif(F.trim("lastname"), F.lit(""))
    seps = F.explode(F.array(*map(F.lit, separators))).alias("sep")
    named = people.select(first.alias("f"), last.alias("l")).distinct().select("f", "l", seps)
    made = [F.col("f"), F.col("l"), F.concat("f", "sep", "l"), F.concat("l", "sep", "f"), F.concat(F.substring("f", 1, 1), "sep", "l"), F.concat("f", "sep", F.substring("l", 1, 1))]
    return named.select(F.explode(F.array(*made)).alias("name")).filter("name is not null").distinct()


# What may stand between the parts of a name, before it and after it.
NAME_SEPARATORS = r"[ \t_.,|;-]+"
NAME_START = r"(?:^|(?<=[\s:(\[{]))"
NAME_END = r"(?=$|[\s.,;|\-\])}])"


def name_pattern(name: Column) -> Column:
    """F5. A pattern, whatever the case, for a person's name. `First Last` may have an initial between; `Last, F` and `Last, First` fit any first name with that
    initial; in other names each run of separators fits any other."""
    n = F.trim(name)
    quote = lambda c: F.regexp_replace(c, r"([\\.+*?\[\](){}|^$])", r"\\$1")
    comma, pair = r"^([A-Za-z'`-]+)\s*,\s*([A-Za-z])(?:\.|[A-Za-z]*)$", r"^([A-Za-z]+)\s+([A-Za-z'`-]+)$"
    one, two = lambda p: F.regexp_extract(n, p, 1), lambda p: F.regexp_extract(n, p, 2)
    reverse = F.concat(one(comma), F.lit(r"\s*,\s*"), two(comma), F.lit(r"[A-Za-z]*\.?"))
    both = F.concat(one(pair), F.lit(rf"(?:{NAME_SEPARATORS}[A-Za-z]\.?)?{NAME_SEPARATORS}"), two(pair))
    other = F.array_join(F.transform(F.split(n, NAME_SEPARATORS), quote), NAME_SEPARATORS)
    return F.concat(F.lit("(?i)" + NAME_START), F.when(n.rlike(comma), reverse).when(n.rlike(pair), both).otherwise(other), F.lit(NAME_END))


def overwrite(df: DataFrame, text: str, patterns: list[tuple[str, str, str]]) -> DataFrame:
    """F21. Adds new_text by (pattern, action, value), first fit: exact blots the match out by as many X, match replaces the whole text, remove leaves none. Case doesn't matter."""
    out = None
    for pattern, action, value in patterns:
        fit = F.col(text).rlike(f"(?i){pattern}")
        found = F.regexp_extract(text, f"(?i)({pattern})", 1)
        new = {"exact": F.replace(F.col(text), found, F.repeat(F.lit("X"), F.length(found))), "match": F.lit(value), "remove": F.lit("")}[action]
        out = F.when(fit, new) if out is None else out.when(fit, new)
    return df.withColumn("new_text", out.otherwise(F.col(text)) if out is not None else F.col(text))


def partition_label(label: Column) -> tuple[Column, Column]:
    """F16. Alphabetic group and number of a channel label; of several letter-number runs the first is the group."""
    return F.regexp_extract(label, r"^([A-Za-z]+)", 1), F.nullif(F.regexp_extract(label, r"^[A-Za-z]+(\d+)", 1), F.lit("")).cast("int")


def uuid_from_name(name: Column) -> Column:
    """F18. The UUID in a name, else the name without a copy mark like (2)."""
    uuid = F.regexp_extract(F.lower(name), r"([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})", 1)
    return F.coalesce(F.nullif(uuid, F.lit("")), F.regexp_replace(name, r" ?\(\d+\)(?=\.|$)", ""))
