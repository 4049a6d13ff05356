"""Recording sessions as intervals: coverage of days, overlaps, unions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.scans import running
from tidemark.views import DAY


def by_day(sessions: DataFrame) -> DataFrame:
    """subject, name, day (number since 1970), s, e: each session clipped to each day it touches; reversed ends are swapped."""
    ordered = sessions.selectExpr("subject", "name", "least(s, e) as s", "greatest(s, e) as e").filter("s < e")
    days = ordered.selectExpr("*", f"explode(sequence(cast(floor(s / {DAY}) as bigint), cast(floor((e - 1) / {DAY}) as bigint))) as day")
    return days.selectExpr("subject", "name", "day", f"greatest(s, day * {DAY}) as s", f"least(e, (day + 1) * {DAY}) as e")


def islands(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Merge touching and overlapping intervals [s, e) of each key: keys, s, e, n, overlap (some two share time)."""
    k = ", ".join(keys)
    before = rows.selectExpr("*", f"max(e) over (partition by {k} order by s, e rows between unbounded preceding and 1 preceding) as reach")
    flagged = before.selectExpr("*", f"sum(if(s <= reach, 0, 1)) over (partition by {k} order by s, e rows between unbounded preceding and current row) as island")
    return flagged.groupBy(*keys, "island").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.count("*").alias("n"), F.expr("coalesce(bool_or(s < reach), false)").alias("overlap")).drop("island")


def coverage_union_by_day(sessions: DataFrame, threshold_s: int = 23 * 3600) -> DataFrame:
    """W1. subject, day, n_sessions, union_s, multiple, overlap, below: the first and last day of a subject are never below."""
    merged = islands(by_day(sessions), ["subject", "day"])
    days = merged.groupBy("subject", "day").agg(F.sum("n").alias("n_sessions"), F.sum(F.col("e") - F.col("s")).alias("union_s"), F.expr("bool_or(overlap)").alias("overlap"))
    return days.selectExpr(
        "subject", "day", "n_sessions", "union_s", "n_sessions > 1 as multiple", "overlap",
        f"union_s < {threshold_s} and day > min(day) over (partition by subject) and day < max(day) over (partition by subject) as below",
    )


def coverage_simple(sessions: DataFrame, threshold_s: int = 23 * 3600) -> DataFrame:
    """A3. Seconds of each day summed over sessions (time in two sessions counts twice); days without any are missing."""
    sums = by_day(sessions).groupBy("subject", "day").agg(F.count("*").alias("n_sessions"), F.sum(F.col("e") - F.col("s")).alias("seconds"))
    calendar = sums.groupBy("subject").agg(F.explode(F.sequence(F.min("day"), F.max("day"))).alias("day"))
    return calendar.join(sums, ["subject", "day"], "left").selectExpr(
        "subject", "day", "coalesce(n_sessions, 0) as n_sessions", "coalesce(seconds, 0) as seconds", "n_sessions is null as missing", f"coalesce(seconds, 0) < {threshold_s} as below", "coalesce(n_sessions, 0) > 1 as multiple"
    )


def coverage_overlaps(sessions: DataFrame) -> DataFrame:
    """J4. subject, day, names: sessions that strictly overlap another one that day."""
    days = by_day(sessions)
    a, b = days.alias("a"), days.alias("b")
    meet = (F.col("a.subject") == F.col("b.subject")) & (F.col("a.day") == F.col("b.day")) & (F.col("a.name") != F.col("b.name"))
    pairs = a.join(b, meet & (F.col("b.s") < F.col("a.e")) & (F.col("a.s") < F.col("b.e")), "left_semi")
    return pairs.groupBy("subject", "day").agg(F.array_join(F.array_sort(F.collect_set("name")), ",").alias("names"))


def interval_union(sessions: DataFrame, keys: list[str] = ["subject"], bucket_s: int = DAY) -> DataFrame:  # noqa: B006
    """D4. keys, n_intervals, total_s of the union of all sessions; ends may be reversed, empty and null ones count for nothing.

    Sessions are dealt by buckets of their start. A bucket's greatest end, carried to the later buckets, tells what of each session is new; the rest are sums, so
    that no task or row holds a subject's sessions."""
    ordered = sessions.select(*keys, F.least("s", "e").alias("s"), F.greatest("s", "e").alias("e")).filter("s < e")
    rows = running(ordered, keys, "s", {"reach": ("max", F.col("e"))}, before=True, span=F.floor(F.col("s") / bucket_s), ties=["e"])
    fresh = F.col("reach").isNull() | (F.col("s") > F.col("reach"))
    new = F.greatest(F.col("e") - F.greatest("s", "reach"), F.lit(0))
    return rows.groupBy(*keys).agg(F.sum(fresh.cast("long")).alias("n_intervals"), F.sum(new).alias("total_s"))


BY_DAY = """o AS (SELECT subject, name, least(s, e) AS s, greatest(s, e) AS e FROM sessions WHERE s <> e),
d0 AS (SELECT *, unnest(range(s // 86400, (e - 1) // 86400 + 1)) AS day FROM o),
d AS (SELECT subject, name, day, greatest(s, day * 86400) AS s, least(e, (day + 1) * 86400) AS e FROM d0)"""
ISLANDS = """r AS (SELECT *, max(e) OVER (PARTITION BY subject, day ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM d),
f AS (SELECT *, sum(CASE WHEN s <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY subject, day ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM r),
i AS (SELECT subject, day, island, min(s) AS s, max(e) AS e, count(*) AS n, coalesce(bool_or(s < reach), false) AS overlap FROM f GROUP BY ALL)"""
W1_SQL = f"""{BY_DAY}, {ISLANDS},
u AS (SELECT subject, day, sum(n)::bigint AS n_sessions, sum(e - s)::bigint AS union_s, bool_or(overlap) AS overlap FROM i GROUP BY ALL)
SELECT subject, day, n_sessions, union_s, n_sessions > 1 AS multiple, overlap, union_s < 82800 AND day > min(day) OVER (PARTITION BY subject) AND day < max(day) OVER (PARTITION BY subject) AS below FROM u"""
A3_SQL = f"""{BY_DAY}, s1 AS (SELECT subject, day, count(*) AS n_sessions, sum(e - s)::bigint AS seconds FROM d GROUP BY ALL),
c AS (SELECT subject, unnest(range(min(day), max(day) + 1)) AS day FROM s1 GROUP BY subject)
SELECT subject, day, coalesce(n_sessions, 0) AS n_sessions, coalesce(seconds, 0) AS seconds, n_sessions IS NULL AS missing, coalesce(seconds, 0) < 82800 AS below, coalesce(n_sessions, 0) > 1 AS multiple FROM c LEFT JOIN s1 USING (subject, day)"""
J4_SQL = f"""{BY_DAY} SELECT subject, day, string_agg(DISTINCT name, ',' ORDER BY name) AS names FROM d a
WHERE EXISTS (SELECT 1 FROM d b WHERE a.subject = b.subject AND a.day = b.day AND a.name <> b.name AND b.s < a.e AND a.s < b.e) GROUP BY ALL"""
D4_SQL = """o AS (SELECT subject, least(s, e) AS s, greatest(s, e) AS e FROM sessions WHERE s <> e),
r AS (SELECT *, max(e) OVER (PARTITION BY subject ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM o),
f AS (SELECT *, sum(CASE WHEN s <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY subject ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM r),
i AS (SELECT subject, island, min(s) AS s, max(e) AS e FROM f GROUP BY ALL)
SELECT subject, count(*) AS n_intervals, sum(e - s)::bigint AS total_s FROM i GROUP BY subject"""
