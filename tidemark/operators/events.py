"""Annotation events of recordings: cleaning, stimulation labels, summaries."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.operators.scans import SIZE, beside, running


def in_order() -> WindowSpec:
    """A recording's events in their order."""
    return Window.partitionBy("rec").orderBy("seq")


def prune_events(lines: DataFrame, columns: int, key: str = "rec") -> DataFrame:
    """P1. key, reason, n: comments and whole rows with a printable ASCII character in their LAST column are kept, the others dropped by reason."""
    parts = F.split("line", "\t", -1)
    last = F.trim(F.regexp_replace(F.element_at(parts, -1), r"[^\x20-\x7e]", ""))
    reason = F.when(F.col("line").startswith("#"), "comment").when(F.trim("line") == "", "blank").when(F.size(parts) != columns, "columns").when(last == "", "empty").otherwise("kept")
    return lines.groupBy(key, reason.alias("reason")).agg(F.count("*").alias("n"))


# Prefixes of auxiliary channels.
AUXILIARY = ["osat", "trig", "pr", "pleth", "patient", "event", "spo", "photic"]


def channel_kind(label: Column) -> Column:
    """P3. Whether a channel can't show an evoked answer: blank, C and DC numbers, or a known auxiliary prefix."""
    t = F.trim(F.coalesce(label, F.lit("")))
    return (t == "") | t.rlike(r"(?i)^(c|dc)\d+$") | t.rlike(f"(?i)^({'|'.join(AUXILIARY)})")


def evoked_channels(channels: DataFrame, key: str, label: str) -> DataFrame:
    """P4. Distinct trimmed names of the channels that can."""
    return channels.filter(~channel_kind(F.col(label))).select(key, F.trim(label).alias("channel")).distinct()


def stim_labels(text: Column) -> Column:
    """F17. struct(decoder, pair, current) of a stimulation label of two dialects, or null."""
    t = F.trim(text)
    new = r"Stim\s+(?:Start|Stop)\s+([A-Za-z0-9]+-[A-Za-z0-9]+)\s+([\d.]+)"
    old = r"^Start Stimulation from (\S+) to (\S+)"
    current = F.coalesce(F.nullif(F.regexp_extract(t, r"(?i)current[=\s]+(\d+)", 1), F.lit("")), F.lit("unknown"))
    make = lambda d, p, c: F.struct(F.lit(d).alias("decoder"), p.alias("pair"), c.alias("current"))
    system = t.rlike(r"^(RESET|Segment|\+|A1|A2)")
    return F.when(~system & t.rlike(new), make("rev3", F.regexp_extract(t, new, 1), F.regexp_extract(t, new, 2))).when(
        t.rlike(old), make("rev2", F.concat_ws("-", F.regexp_extract(t, old, 1), F.regexp_extract(t, old, 2)), current)
    )


def labelled(events: DataFrame) -> DataFrame:
    """rec, seq, onset, decoder, pair, current of the events that stim_labels knows."""
    return events.withColumn("x", stim_labels(F.col("text"))).filter("x is not null").select("rec", "seq", "onset", "x.decoder", "x.pair", "x.current")


def relay_state(events: DataFrame, size: int = SIZE) -> DataFrame:
    """W6. Events between `Closed relay to A and B` and the next opening whose text is all digits: the pair and the current."""
    t = F.trim(F.col("text"))
    closed = r"^Closed relay to (\S+) and (\S+)"
    # a change is the pair, or an empty text where the relay opens
    change = F.when(t.rlike(closed), F.concat_ws("-", F.regexp_extract(t, closed, 1), F.regexp_extract(t, closed, 2))).when(t.contains("Opened relay") | t.contains("De-block"), "")
    on = running(events.select("rec", "seq", "onset", "text"), ["rec"], "seq", {"pair": ("last", change)}, size).filter(t.rlike(r"^\d+$") & (F.col("pair") != ""))
    return on.select("rec", "seq", "onset", F.lit("rev1").alias("decoder"), "pair", F.trim("text").alias("current"))


def manual_stims(events: DataFrame, gap_s: float = 20.0, size: int = SIZE) -> DataFrame:
    """W5. Stimulation commands that no high-frequency line is or comes before, with the next event less than gap_s later; numbers of the lines up to the next command are their currents. seq counts a
    recording's events without gaps."""
    t = F.trim(F.coalesce("text", F.lit("")))
    pattern = r"^(?:Closed relay to|Start Stimulation from) (\S+) (?:and|to) (\S+)"
    rows = events.select("rec", "seq", "onset", t.alias("t"), t.rlike(pattern).alias("command"), F.lower(t).contains("high freq").alias("high"))
    rows = beside(rows, ["rec"], "seq", {"high_before": (F.col("high"), -1), "next": (F.col("onset"), 1)}, size)
    rows = running(rows, ["rec"], "seq", {"block": ("sum", F.col("command").cast("int"))}, size)
    good = F.col("command") & ~F.col("high") & ~F.coalesce("high_before", F.lit(False)) & (F.col("next") - F.col("onset") < gap_s)
    pair = F.concat_ws("-", F.regexp_extract("t", pattern, 1), F.regexp_extract("t", pattern, 2))
    number = F.when(~F.col("command") & ~F.col("t").rlike(r"[A-Za-z]+\d+"), F.nullif(F.regexp_extract("t", r"(\d+(?:\.\d+)?)", 1), F.lit("")))
    return rows.groupBy("rec", "block").agg(
        F.max(F.when(good, F.struct("seq", pair.alias("pair")))).alias("stim"), F.array_join(F.array_sort(F.collect_set(number)), ",").alias("currents")
    ).filter("block > 0 and stim is not null").select("rec", F.col("stim.seq").alias("seq"), F.col("stim.pair").alias("pair"), "currents")


def ccep_summary(events: DataFrame) -> DataFrame:
    """A12. rec, electrode, decoder, partners, currents: the first decoder of rev3, rev2, rev1 that finds anything in a recording counts."""
    found = labelled(events).unionByName(relay_state(events))
    rank = F.when(F.col("decoder") == "rev3", 1).when(F.col("decoder") == "rev2", 2).otherwise(3)
    ranked = found.withColumn("rank", rank)
    best = ranked.groupBy("rec").agg(F.min("rank").alias("rank"))
    kept = ranked.join(best, ["rec", "rank"]).withColumn("ends", F.split("pair", "-"))
    ends = F.explode(F.array(F.struct(F.col("ends")[0].alias("a"), F.col("ends")[1].alias("b")), F.struct(F.col("ends")[1].alias("a"), F.col("ends")[0].alias("b"))))
    both = kept.select("rec", "decoder", "current", ends.alias("x"))
    return both.groupBy("rec", "decoder", F.col("x.a").alias("electrode")).agg(F.array_join(F.array_sort(F.collect_set("x.b")), ",").alias("partners"), F.array_join(F.array_sort(F.collect_set("current")), ",").alias("currents"))


def stim_matrix(summary: DataFrame, order: list[str]) -> DataFrame:
    """A13. A row for each current and a column for each electrode of the order, ✓ where the electrode was stimulated with it."""
    cells = summary.select("electrode", F.explode(F.split("currents", ",")).alias("current"))
    return cells.groupBy("current").pivot("electrode", order).agg(F.max(F.lit("✓"))).na.fill("")


def recording_bounds(events: DataFrame) -> DataFrame:
    """A25. First and last onset by row order, as seconds; empty recordings have none."""
    return events.filter("onset is not null").groupBy("rec").agg(F.min_by("onset", "seq").alias("first_onset"), F.max_by("onset", "seq").alias("last_onset"), F.count("*").alias("n"))


def bounds_report(events: DataFrame) -> DataFrame:
    """A25. rec, first, last, row: the first and last time by row order, else the first and last onset in seconds, else N/A; row is date, start and end on a
    12-hour clock, parted by tabs, or N/A without times. events: rec, seq, onset, time."""
    by = F.when(F.col("time").isNotNull(), F.col("seq"))
    ends = events.groupBy("rec").agg(F.min_by("time", by).alias("t0"), F.max_by("time", by).alias("t1"), F.min_by("onset", "seq").alias("o0"), F.max_by("onset", "seq").alias("o1"))
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    seconds = lambda c: F.concat(F.regexp_replace(F.regexp_replace(F.col(c).cast("decimal(20,6)").cast("string"), "0+$", ""), r"\.$", ".0"), F.lit(" s"))
    clock = lambda c: F.regexp_replace(F.date_format(c, "hh:mm:ss a"), "^0", "")
    row = F.coalesce(F.concat_ws("\t", F.date_format("t0", "yyyy-MM-dd"), clock("t0"), clock("t1")), F.lit("N/A"))
    return ends.select(
        "rec", F.coalesce(stamp("t0"), seconds("o0"), F.lit("N/A")).alias("first"), F.coalesce(stamp("t1"), seconds("o1"), F.lit("N/A")).alias("last"), F.when(F.col("t0").isNull(), "N/A").otherwise(row).alias("row")
    )


def estimate_rate(events: DataFrame, stamp: str) -> DataFrame:
    """A17. Median of stamp steps by seconds between neighbours, of steps above 0 within 0.5 to 60 s; null below 30 of them."""
    rows = events.select("rec", (F.col(stamp) - F.lag(stamp).over(in_order())).alias("ds"), (F.col("onset") - F.lag("onset").over(in_order())).alias("dt"))
    fit = rows.withColumn("ratio", F.when((F.col("ds") > 0) & F.col("dt").between(0.5, 60), F.col("ds") / F.col("dt")))
    return fit.groupBy("rec").agg(F.count("ratio").alias("n"), F.round(F.when(F.count("ratio") >= 30, F.percentile("ratio", 0.5)), 6).alias("rate"))


def event_sessions(events: DataFrame, gap_s: float = 20.0) -> DataFrame:
    """R7 in batch. rec, start, stop, n of bursts of events that pauses of gap_s or more part."""
    new = F.coalesce(F.col("onset") - F.lag("onset").over(in_order()) >= gap_s, F.lit(True)).cast("int")
    rows = events.withColumn("new", new)
    rows = rows.withColumn("burst", F.sum("new").over(in_order().rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("rec", "burst").agg(F.min("onset").alias("start"), F.max("onset").alias("stop"), F.count("*").alias("n")).drop("burst")


def best_shift(short: np.ndarray, notes: np.ndarray) -> int:
    """Where in `notes` the slice as long as `short` starts whose times from its first fit best: the least sum of squared differences, rounded to six places, then the first.

    The sums of all shifts come from prefix sums and one convolution; those that its rounding can't tell from the least are summed again."""
    n, m = len(short), len(notes)
    if n == m:
        return 0
    d, x = short - short[0], notes - notes[0]
    sums, squares = np.concatenate([[0], np.cumsum(x)]), np.concatenate([[0], np.cumsum(x * x)])
    size = 1 << (n + m - 1).bit_length()
    cross = np.fft.irfft(np.fft.rfft(x, size) * np.conj(np.fft.rfft(d, size)), size)[: m - n + 1]  # sum of d[i] * x[i + shift]
    first, within, squared = x[: m - n + 1], sums[n:] - sums[: m - n + 1], squares[n:] - squares[: m - n + 1]
    about = (d * d).sum() + squared + n * first**2 - 2 * cross + 2 * first * d.sum() - 2 * first * within
    slack = 1e-12 * size.bit_length() * ((d * d).sum() + squares[-1] + n * (x * x).max()) + 1e-6
    best, place = np.inf, 0
    for s in np.flatnonzero(about <= about.min() + 2 * slack).tolist():
        score = round(float(((d - (x[s : s + n] - x[s])) ** 2).sum()), 6)
        if score < best:
            best, place = score, s
        if best == 0:
            break
    return place


def complete_truncated(events: DataFrame, notes: DataFrame, k: int = 4) -> DataFrame:
    """J5. Truncated event texts and longer notes of the same recording that start with them, matched in order where both are as many; more notes than events give the slice of neighbours whose relative times fit best (least sum of squares, then the first). Fewer notes give none."""
    a = events.filter("text is not null and onset is not null").groupBy("rec", F.col("text").alias("short")).agg(F.array_sort(F.collect_list(F.struct("seq", "onset"))).alias("events"))
    b = notes.filter("onset is not null").select("rec", "seq", "onset", F.col("text").alias("full"))
    keys = a.select("rec", "short").withColumn("p", F.substring("short", 1, k))
    cand = keys.join(b.withColumn("p", F.substring("full", 1, k)), ["rec", "p"]).filter(F.col("full").startswith(F.col("short")) & (F.length("full") > F.length("short")))
    lists = cand.groupBy("rec", "short").agg(F.array_sort(F.collect_list(F.struct("seq", "onset", "full"))).alias("notes"))
    met = a.join(lists, ["rec", "short"]).filter(F.size("notes") >= F.size("events"))
    times = lambda c: F.transform(c, lambda x: x["onset"].cast("double"))

    @F.pandas_udf("int")
    def shift(short: pd.Series, there: pd.Series) -> pd.Series:
        return pd.Series([best_shift(np.asarray(x, np.float64), np.asarray(y, np.float64)) for x, y in zip(short, there, strict=True)], dtype="int32")

    placed = met.withColumn("s", shift(times("events"), times("notes")))
    pairs = F.explode(F.arrays_zip(F.col("events").alias("a"), F.slice("notes", F.col("s") + 1, F.size("events")).alias("b")))
    return placed.select("rec", "short", pairs.alias("x")).select("rec", F.col("x.a.seq").alias("seq"), "short", F.col("x.b.seq").alias("note_seq"), F.col("x.b.full").alias("full"))
