"""Running values of long sequences, span by span: a sequence is cut into spans of its order, spans go to many tasks, and what comes before a span reaches it as one row.

    running(samples, ["rec", "channel"], "idx", {"low": ("min", F.col("v"))})

Each span has an aggregate of its own, a scan over a sequence's few aggregates gives every span its carry-in, and a window within the span does the rest.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Indices of a span.
SIZE = 65_536


def halo(rows: DataFrame, order: str, reach: int, size: int = SIZE) -> DataFrame:
    """Adds home and span: rows are dealt by spans of `size` of the order; those within `reach` of a span's end go to the neighbour as well, where home and span
    differ. reach is at most size."""
    home = F.floor(F.col(order) / size)
    near = F.array_distinct(F.array(F.floor((F.col(order) - reach) / size), home, F.floor((F.col(order) + reach) / size)))
    return rows.withColumn("home", home).withColumn("span", F.explode(near))


def beside(rows: DataFrame, keys: list[str], order: str, columns: dict[str, tuple[Column, int]], size: int = SIZE) -> DataFrame:
    """Adds columns of the row `by` places later (earlier: below 0) in the order, which counts the rows of a key without gaps; null beyond the ends."""
    reach = max(abs(by) for _, by in columns.values())
    w = Window.partitionBy(*keys, "span").orderBy(order)
    return halo(rows, order, reach, size).withColumns({n: F.lead(c, by).over(w) if by > 0 else F.lag(c, -by).over(w) for n, (c, by) in columns.items()}).filter("home = span").drop("home", "span")


@dataclass(frozen=True)
class Kind:
    """How values of a span are put together: over a window, as one aggregate, and what came before with what the span has."""

    window: Callable[[Column], Column]
    total: Callable[[Column, Column], Column]
    join: Callable[[Column, Column], Column]


KINDS = {
    "min": Kind(F.min, lambda c, _: F.min(c), F.least),
    "max": Kind(F.max, lambda c, _: F.max(c), F.greatest),
    "sum": Kind(F.sum, lambda c, _: F.sum(c), lambda before, own: F.coalesce(before, F.lit(0)) + F.coalesce(own, F.lit(0))),
    "last": Kind(lambda c: F.last(c, ignorenulls=True), lambda c, at: F.max_by(c, F.when(c.isNotNull(), at)), lambda before, own: F.coalesce(own, before)),
}


def running(rows: DataFrame, keys: list[str], order: str, columns: dict[str, tuple[str, Column]], size: int = SIZE, backwards: bool = False, before: bool = False, span: Column | None = None, ties: list[str] = []) -> DataFrame:  # noqa: B006
    """Adds running values from a key's first row on: name -> (min, max, sum or last: the last that isn't null; what is taken).

    backwards: from its last row on. before: of the rows before alone (behind, backwards). span: a number that rises with the order, in place of floor(order / size). ties:
    further columns of the order."""
    place = F.floor(F.col(order) / size) if span is None else span
    sign = -1 if backwards else 1
    rows = rows.withColumn("scan span", place)
    by = [F.desc(c) if backwards else F.asc(c) for c in (order, *ties)]
    within = Window.partitionBy(*keys, "scan span").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    last = F.struct(*[F.col(c) for c in (order, *ties)]) if not backwards else -F.col(order)
    totals = rows.groupBy(*keys, "scan span").agg(*[KINDS[kind].total(c, last).alias(n) for n, (kind, c) in columns.items()])
    earlier = Window.partitionBy(*keys).orderBy(F.col("scan span") * sign).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, "scan span", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("scan span") * sign)).alias("scan place"), *[KINDS[kind].window(F.col(n)).over(earlier).alias(f"carried {n}") for n, (kind, _) in columns.items()])
    carried = carried.filter("`scan place` > 1").drop("scan place")  # a sequence of one span needs none
    met = rows.withColumns({f"own {n}": KINDS[kind].window(c).over(within) for n, (kind, c) in columns.items()}).join(carried, [*keys, "scan span"], "left")
    done = {n: KINDS[kind].join(F.col(f"carried {n}"), F.col(f"own {n}")) for n, (kind, _) in columns.items()}
    return met.withColumns(done).drop("scan span", *[f"{k} {n}" for n in columns for k in ("own", "carried")])
