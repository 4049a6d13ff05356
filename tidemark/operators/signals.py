"""Samples of channels: statistics, smoothing and event-locked averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.filters import located, spans, turns


def signal_stats(samples: DataFrame) -> DataFrame:
    """A14. n, mean, population deviation, least and largest value of each channel."""
    return samples.groupBy("rec", "channel").agg(F.count("v").alias("n"), F.round(F.avg("v"), 6).alias("mean"), F.round(F.stddev_pop("v"), 6).alias("std"), F.min("v").alias("low"), F.max("v").alias("high"))


def moving_average(samples: DataFrame, window: int) -> DataFrame:
    """W7. Centred mean over window samples (an even number takes one more), shorter at the ends; NaN doesn't count."""
    half = window // 2
    v = F.when(~F.isnan("v"), F.col("v"))
    around = Window.partitionBy("rec", "channel", "span").orderBy("idx").rowsBetween(-half, half)
    return spans(samples, half).withColumn("smooth", F.round(F.avg(v).over(around), 6)).filter("home = span").select("rec", "channel", "idx", "smooth")


def epoch_events(samples: DataFrame, events: DataFrame, before: int, after: int) -> DataFrame:
    """J14. rec, channel, event, offset, v: samples from event - before up to event + after; events whose span isn't whole go. The windows, a row for each sample."""
    rows = epoch_windows(samples, events, before, after).select("rec", "channel", "event", F.posexplode("values").alias("place", "v"))
    return rows.select("rec", "channel", "event", (F.col("place") - before).cast("long").alias("offset"), "v")


def epoch_windows(samples: DataFrame, events: DataFrame, before: int, after: int, block: int = 1024) -> DataFrame:
    """J14 with a row for each epoch. rec, channel, event, values: samples from event - before up to event + after; events whose span isn't whole go.

    Samples become arrays of `block` and what an epoch may reach beyond; an event meets its block of each channel by key and takes its slice."""
    met = located(samples, events.select("rec", "event"), before, after, block)
    return met.filter(whole(before, after)).select("rec", "channel", "event", span(before, after))


def whole(before: int, after: int) -> Column:
    return (F.col("at") >= before) & (F.col("at") + after <= F.size("x"))


def span(before: int, after: int) -> Column:
    # Spark may look at a row's epoch before it knows that it is whole
    return F.slice("x", F.greatest(F.col("at") - before + 1, F.lit(1)), before + after).alias("values")


def average_epochs(epochs: DataFrame) -> DataFrame:
    """N13. Mean answer of each channel at each offset."""
    return epochs.groupBy("rec", "channel", "offset").agg(F.count("*").alias("n"), F.round(F.avg("v"), 6).alias("mean"))


def baseline_zscore(epochs: DataFrame) -> DataFrame:
    """N9. (v - mean) / deviation of the epoch's own samples before the event; null without any, or if they don't vary."""
    base = epochs.filter("offset < 0").groupBy("rec", "channel", "event").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("sd"))
    return epochs.join(base, ["rec", "channel", "event"], "left").select("rec", "channel", "event", "offset", F.round((F.col("v") - F.col("m")) / F.nullif("sd", F.lit(0.0)), 6).alias("z"))


def zscore_windows(windows: DataFrame, before: int) -> DataFrame:
    """N9 of epochs with a row each (epoch_windows): rec, channel, event, offset, z as in baseline_zscore, without a join. Deviations are taken from the first sample, so that equal ones have none."""
    base = "filter(slice(values, 1, {0}), v -> v is not null)".format(before) if before else "cast(array() as array<double>)"
    rows = windows.withColumn("base", F.expr(base)).withColumn("m", F.expr("base[0] + aggregate(base, 0D, (a, v) -> a + (v - base[0])) / size(base)") if before else F.lit(None).cast("double"))
    sd = "sqrt(aggregate(base, 0D, (a, v) -> a + (v - m) * (v - m)) / size(base))"
    each = rows.selectExpr("rec", "channel", "event", "m", f"nullif({sd}, 0D) as sd" if before else "cast(null as double) as sd", "posexplode(values) as (place, v)")
    return each.select("rec", "channel", "event", (F.col("place") - before).cast("long").alias("offset"), F.round((F.col("v") - F.col("m")) / F.col("sd"), 6).alias("z"))


def detrend_linear(samples: DataFrame) -> DataFrame:
    """N10. What is left of the least-squares line of each channel."""
    line = samples.groupBy("rec", "channel").agg(F.expr("regr_slope(v, idx)").alias("slope"), F.expr("regr_intercept(v, idx)").alias("level"))
    return samples.join(line, ["rec", "channel"]).select("rec", "channel", "idx", (F.col("v") - (F.col("slope") * F.col("idx") + F.col("level"))).alias("rest"))


def flips(samples: DataFrame, events: DataFrame, stim: int, before: int, after: int, lag: int, window: int) -> DataFrame:
    """The rows of flip_decisions with values, the epoch's samples, where it is whole.

    The stimulated channel's turns are found first and go with the events, so that a channel's decision and epoch come from the one row that holds its samples."""
    reach = (max(window, before), max(lag + 1, window, after))
    sides = lambda side: [c.alias(f"{side}_{n}") for c, n in zip(turns(lag, window), ("orientation", "pre", "post"), strict=True)]
    events = events.select("rec", "event").distinct()
    own = located(samples.filter(F.col("channel") == stim), events, *reach).select("rec", "event", *sides("stim"))
    met = located(samples.filter(F.col("channel") != stim), events.join(own, ["rec", "event"], "left"), *reach)
    found = met.select("rec", "channel", "event", "stim_orientation", "stim_pre", "stim_post", *sides("evoked"), whole(before, after).alias("whole"), F.when(whole(before, after), span(before, after)).alias("values"))
    unclear = F.col("stim_orientation").isNull() | F.col("evoked_orientation").isNull()
    opposite = F.col("stim_orientation") != F.col("evoked_orientation")
    flip = F.when(F.col("whole"), F.coalesce(opposite, F.lit(False)))
    reason = F.when(~F.col("whole"), "out of bounds").when(unclear, "ambiguous").when(opposite, "opposite").otherwise("same")
    return found.select("rec", "channel", "event", flip.alias("flip"), reason.alias("reason"), *[f"{side}_{c}" for c in ("orientation",) for side in ("stim", "evoked")], *[f"{side}_{c}" for side in ("stim", "evoked") for c in ("pre", "post")], "values")


def flip_decisions(samples: DataFrame, events: DataFrame, stim: int, before: int, after: int, lag: int, window: int) -> DataFrame:
    """N13. rec, channel, event, flip, reason, stim_orientation, evoked_orientation, stim_pre, stim_post, evoked_pre, evoked_post: whether a channel's answer to an event is turned over, as its orientation (W8)
    isn't that of channel `stim` of its recording. Not where either has none; flip is null for events whose epoch isn't whole. Channel stim itself has no rows."""
    return flips(samples, events, stim, before, after, lag, window).drop("values")


def average_flipped(epochs: DataFrame, decisions: DataFrame) -> DataFrame:
    """N13. rec, channel, offset, n, flipped, mean: the mean answer over a channel's epochs (v), those with a flip turned over; n counts values that aren't null."""
    met = epochs.join(decisions.filter("flip is not null").select("rec", "channel", "event", "flip"), ["rec", "channel", "event"])
    v = F.when(F.col("flip"), -F.col("v")).otherwise(F.col("v"))
    return met.groupBy("rec", "channel", "offset").agg(F.count("v").alias("n"), F.count_if(F.col("flip") & F.col("v").isNotNull()).alias("flipped"), F.round(F.avg(v), 6).alias("mean"))


def average_flips(flipped: DataFrame, before: int) -> DataFrame:
    """The same of the rows of flips, whose epochs lie beside their decisions; `before` as there."""
    each = flipped.filter("flip is not null").select("rec", "channel", "event", "flip", F.posexplode("values").alias("place", "v"))
    v = F.when(F.col("flip"), -F.col("v")).otherwise(F.col("v"))
    return each.groupBy("rec", "channel", (F.col("place") - before).cast("long").alias("offset")).agg(F.count("v").alias("n"), F.count_if(F.col("flip") & F.col("v").isNotNull()).alias("flipped"), F.round(F.avg(v), 6).alias("mean"))
