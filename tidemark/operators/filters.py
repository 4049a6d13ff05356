"""Trends, medians and peaks of channels: sums and windows over spans, and peaks of short windows in Arrow batches. idx counts a channel's samples from 0."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.scans import SIZE, beside, halo, running

CHANNEL = ("rec", "channel")
EPOCH = ("rec", "channel", "event")


def spans(samples: DataFrame, reach: int, size: int = SIZE) -> DataFrame:
    """Adds home and span to samples: see scans.halo."""
    return halo(samples, "idx", reach, size)


def median_filter(samples: DataFrame, kernel: int) -> DataFrame:
    """N10. Median of the `kernel` (odd) samples around each; zeros stand beyond a channel's ends and for nulls."""
    if kernel % 2 != 1:
        raise ValueError("kernel is odd")
    half = kernel // 2
    around = F.collect_list("v").over(Window.partitionBy(*CHANNEL, "span").orderBy("idx").rowsBetween(-half, half))
    values = spans(samples, half).withColumn("around", around).filter("home = span")
    padded = F.array_sort(F.concat("around", F.array_repeat(F.lit(0.0), F.lit(kernel) - F.size("around"))))
    return values.select(*CHANNEL, "idx", F.get(padded, F.lit(half)).alias("median"))


def detrend_cubic(samples: DataFrame, most: float = 1e-3) -> DataFrame:
    """N10. What is left of each channel's least-squares cubic; its coefficient of idx^3 is clamped to `most` either way, the others stay. Null below four samples.

    The polynomials are orthogonal over 0 .. n - 1, so that each coefficient is one sum."""
    sizes = samples.groupBy(*CHANNEL).agg((F.max("idx") + 1).cast("double").alias("n"))
    n, t = F.col("n"), F.col("idx") - (F.col("n") - 1) / 2
    rows = samples.join(sizes, [*CHANNEL]).withColumns({"p1": t, "p2": t * t - (n * n - 1) / 12, "p3": t * t * t - t * (3 * n * n - 7) / 20})
    s1 = n * (n * n - 1) / 12
    s2 = s1 * (n * n - 4) / 15
    s3 = s2 * (n * n - 9) * 9 / 140
    sums = rows.groupBy(*CHANNEL).agg(F.first("n").alias("n"), F.avg("v").alias("c0"), *[F.sum(F.col("v") * F.col(f"p{i}")).alias(f"w{i}") for i in (1, 2, 3)])
    fits = sums.select(*CHANNEL, "c0", *[(F.col(f"w{i}") / F.nullif(s, F.lit(0.0))).alias(f"c{i}") for i, s in ((1, s1), (2, s2), (3, s3))])
    over = F.col("c3") - F.greatest(F.lit(-most), F.least(F.lit(most), F.col("c3")))
    fit = F.col("c0") + F.col("c1") * F.col("p1") + F.col("c2") * F.col("p2") + F.col("c3") * F.col("p3")
    x = F.col("idx").cast("double")
    return rows.join(fits, [*CHANNEL]).select(*CHANNEL, "idx", (F.col("v") - fit + over * x * x * x).alias("rest"))


def located(samples: DataFrame, events: DataFrame, before: int, after: int, block: int = 1024) -> DataFrame:
    """Events (rec, event and what else they have) by channel with at, the place of their sample in x: the samples of their block of `block` indexes, and of `before` less and `after` - 1 more where
    the channel has them. Events without a sample go. Only samples and events are shuffled, by block; what is made of a row's x needs no key."""
    blocks = F.sequence(F.floor((F.col("idx") - after + 1) / block), F.floor((F.col("idx") + before) / block))
    held = samples.withColumn("block", F.explode(blocks)).groupBy(*CHANNEL, "block").agg(F.array_sort(F.collect_list(F.struct("idx", "v"))).alias("x"))
    held = held.select(*CHANNEL, "block", F.expr("x[0].idx").alias("start"), F.expr("transform(x, r -> r.v)").alias("x"))
    met = events.withColumn("block", F.floor(F.col("event") / block)).join(held, ["rec", "block"])
    at = (F.col("event") - F.col("start")).cast("int")
    return met.filter((at >= 0) & (at < F.size("x"))).select("rec", "channel", *[c for c in events.columns if c != "rec"], at.alias("at"), "x")


def turns(lag: int, window: int) -> list[Column]:
    """orientation, pre and post (W8) of located events; what is held reaches `window` and `lag` samples."""
    value = lambda i: F.get("x", i)
    first, at = F.col("event") == 0, F.col("at")
    total = F.nanvl(value(at), F.lit(0.0)) + F.nanvl(value(at + lag), F.lit(0.0))
    ends = {"pre": (F.greatest(at - window, F.lit(0)), at - 1), "post": (at, F.least(at + window - 1, F.size("x") - 1))}
    slopes = [F.when(~first & (b > a), (value(b) - value(a)) / (b - a)).otherwise(0.0).alias(name) for name, (a, b) in ends.items()]
    return [F.when(first | total.isNull(), None).when(total < 0, -1).otherwise(1).alias("orientation"), *slopes]


def orientation(samples: DataFrame, events: DataFrame, lag: int, window: int) -> DataFrame:
    """W8. orientation: -1 where the sample at an event and the one `lag` later sum up to less than 0 (NaN counts as 0), else 1; null at a channel's
    first sample and where the later one is out of range. pre, post: mean of the first differences of the `window` samples before the event and of
    those from it on; 0 with fewer than two samples, and both at a channel's first sample.

    A mean of differences is that of the two ends."""
    return located(samples, events.select("rec", "event").distinct(), window, max(lag + 1, window)).select(*EPOCH, *turns(lag, window))


def find_peaks(samples: DataFrame, sel: float | None = None, thresh: float | None = None, extrema: int = 1, endpoints: bool = True, least: int | None = None, most: int | None = None, size: int = SIZE) -> DataFrame:
    """N11. rec, channel, idx, place, v: samples after which the slope's sign falls, above thresh, and above the least sample so far by more than sel
    (both: a quarter of the channel's range, unless given).

    extrema -1 looks for minima. endpoints: a falling start and a rising end count too. least, most: limits of the width, from where the rise begins
    to where the fall ends. place: the top of the parabola through the sample and its neighbours; an end's own place. size: samples of a span that one task takes."""
    keys = [*CHANNEL]
    x = samples.select(*CHANNEL, "idx", (F.col("v") * extrema).alias("x"))
    limits = x.groupBy(*CHANNEL).agg(((F.max("x") - F.min("x")) / 4).alias("quarter"), F.max("idx").alias("last"))
    rows = beside(x, keys, "idx", {"a": (F.col("x"), -1), "b": (F.col("x"), 1)}, size)
    rows = rows.withColumns({"before": F.signum(F.col("x") - F.col("a")), "next": F.signum(F.col("b") - F.col("x"))})
    wide = least is not None or most is not None
    # a rise begins where the slope before isn't up any more, or at the channel's start
    starts = {"rise": ("last", F.when(F.col("before") <= 0, F.col("idx")))} if wide else {}
    rows = running(rows, keys, "idx", {"low": ("min", F.col("x")), **starts}, size)
    if wide:
        rows = running(rows, keys, "idx", {"fall": ("min", F.when(F.col("next") >= 0, F.col("idx")))}, size, backwards=True)
    falls: Column = F.col("next") < F.col("before")
    if endpoints:
        falls = falls | (F.col("before").isNull() & (F.col("next") < 0)) | (F.col("next").isNull() & (F.col("before") > 0))
    peaks = rows.filter(falls).join(limits, keys)
    peaks = peaks.filter((F.col("x") > (F.col("quarter") if thresh is None else thresh)) & (F.col("x") - F.col("low") > (F.col("quarter") if sel is None else sel)))
    if wide:
        width = F.coalesce("fall", "last") - F.coalesce("rise", F.lit(0))
        peaks = peaks.filter(width >= (0 if least is None else least)).filter(F.lit(True) if most is None else width <= most)
    top = F.col("idx") + 0.5 * (F.col("a") - F.col("b")) / (F.col("a") - 2 * F.col("x") + F.col("b"))
    return peaks.select(*CHANNEL, "idx", F.coalesce(top, F.col("idx").cast("double")).alias("place"), (F.col("x") * extrema).alias("v"))


def lows_before(x: np.ndarray) -> np.ndarray:
    """For each value of each row the least one from behind the last greater value up to it: a stack of falling values for each row, all rows at once."""
    rows, n = x.shape
    values, lows, height = np.empty((rows, n)), np.empty((rows, n)), np.zeros(rows, np.int64)
    out = np.empty((rows, n))
    for i in range(n):
        low = x[:, i].copy()
        open_rows = np.flatnonzero(height)
        while len(open_rows):
            top = height[open_rows] - 1
            open_rows = open_rows[values[open_rows, top] <= x[open_rows, i]]
            top = height[open_rows] - 1
            low[open_rows] = np.minimum(low[open_rows], lows[open_rows, top])
            height[open_rows] = top
            open_rows = open_rows[top > 0]
        at = np.arange(rows)
        values[at, height], lows[at, height] = x[:, i], low
        height += 1
        out[:, i] = low
    return out


def prominent(x: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value of each row is a peak that stands `least` over the lows on both sides, up to the next greater value or the end; and the next place with another
    value. Flat tops count at their first place, a row's ends never."""
    rows, n = x.shape
    other = np.full((rows, n), n)
    for i in range(n - 2, -1, -1):
        other[:, i] = np.where(x[:, i + 1] != x[:, i], i + 1, other[:, i + 1])
    rises, falls = np.zeros((rows, n), bool), np.zeros((rows, n), bool)
    rises[:, 1:] = x[:, :-1] < x[:, 1:]
    falls[:, :-1] = np.take_along_axis(x, np.minimum(other[:, :-1], n - 1), 1) < x[:, :-1]
    high = x - np.maximum(lows_before(x), lows_before(x[:, ::-1])[:, ::-1]) >= least
    return rises & falls & (other < n) & high, other


def peaks_of(x: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Of each row: the place of its first prominent peak (a flat top's middle), -1 where there is none; 1, -1 or 0 (neither) as the highest peak is over 1.2 times the deepest trough or the
    reverse."""
    if x.shape[1] < 3:
        return np.full(len(x), -1), np.zeros(len(x), np.int64)
    ups, other = prominent(x, least)
    downs, _ = prominent(-x, least)
    first = ups.argmax(axis=1)
    place = np.where(ups.any(axis=1), (first + np.take_along_axis(other, first[:, None], 1)[:, 0] - 1) // 2, -1)
    best = lambda on, v: np.where(on.any(axis=1), np.where(on, v, -np.inf).max(axis=1), 0.0)
    high, deep = best(ups, x), best(downs, -x)
    found = ups.any(axis=1) | downs.any(axis=1)
    return place, np.where(found & (high > deep * 1.2), 1, np.where(found & (deep > high * 1.2), -1, 0))


def first_peaks(windows: DataFrame, first: int, prominence: float) -> DataFrame:
    """N12. rec, channel, event, peak, polarity of windows (rec, channel, event, values: samples at offsets from `first` on): the offset of the first prominent peak (a flat top's middle);
    1 or -1 where the highest prominent peak is over 1.2 times the deepest trough or the reverse (0 where there is none), else null. A window with a null or NaN has neither.

    Windows of a batch that are equally long are one matrix, walked once in each direction with a stack for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b.column(3)
            sizes = np.array([-1 if n is None else n for n in pa.compute.list_value_length(values).to_pylist()], np.int64)
            peak, sign = np.full(b.num_rows, -1, np.int64), np.zeros(b.num_rows, np.int64)
            for n in np.unique(sizes[sizes > 0]):
                at = np.flatnonzero(sizes == n)
                x = values.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, n)
                fine = ~np.isnan(x).any(axis=1)
                place, polarity = peaks_of(x[fine], prominence)
                peak[at[fine]], sign[at[fine]] = place, polarity
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(peak + first, mask=peak < 0), pa.array(sign, mask=sign == 0)], names=[*EPOCH, "peak", "polarity"])

    kinds = dict(windows.dtypes)
    return windows.select(*EPOCH, F.col("values").cast("array<double>")).mapInArrow(run, ", ".join(f"{k} {kinds[k]}" for k in EPOCH) + ", peak long, polarity long")


def first_peak(epochs: DataFrame, first: int, last: int, prominence: float) -> DataFrame:
    """N12 over epochs with a row for each sample (offset, v), of offsets first to last."""
    part = F.array_sort(F.collect_list(F.when(F.col("offset").between(first, last), F.struct("offset", "v"))))
    return first_peaks(epochs.groupBy(*EPOCH).agg(F.transform(part, lambda r: r["v"]).alias("values")), first, prominence)
