"""Dates, durations, sizes and header numbers. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OFFSET_DAYS = 5856  # fixed value: the shift of all dates


def excel_serial(x: Column) -> Column:
    """N1. Text of the moment x days after 1899-12-30; outside 0 to 80000 the number itself as text."""
    us = F.round((x - 25569) * 86400e6).cast("long")
    return F.when(x.between(0, 80000), F.date_format(F.timestamp_micros(us), "yyyy-MM-dd HH:mm:ss.SSSSSS")).otherwise(x.cast("string"))


def edf_datetime(d: Column, t: Column) -> Column:
    """N2. dd.mm.yy and hh.mm.ss as yyyy-MM-ddTHH:mm:ss; years below 85 are of this century. Null where a part is no number."""
    part = lambda c, i: F.get(F.split(c, r"\."), i - 1).try_cast("int")
    year = part(d, 3)
    full = F.when(year < 85, year + 2000).otherwise(year + 1900)
    return F.format_string("%04d-%02d-%02dT%02d:%02d:%02d", full, part(d, 2), part(d, 1), part(t, 1), part(t, 2), part(t, 3))


def sec2time(us: Column) -> Column:
    """N3. [-][D days, ]HH:MM:SS.ffffff of microseconds."""
    n = F.abs(us)
    days, rest = F.floor(n / 86_400_000_000), n % 86_400_000_000
    clock = F.format_string("%02d:%02d:%02d.%06d", F.floor(rest / 3_600_000_000), F.floor(rest / 60_000_000) % 60, F.floor(rest / 1_000_000) % 60, rest % 1_000_000)
    return F.concat(F.when(us < 0, "-").otherwise(""), F.when(days > 0, F.concat(days.cast("string"), F.lit(" days, "))).otherwise(""), clock)


def record_range(n: Column, record_s: Column, start_s: Column, from_s: Column, to_s: Column, before_min: int, after_min: int) -> tuple[Column, Column, Column]:
    """N4. First and end record, and why there are none: clock seconds with the asked minutes before and after, clipped to the recording."""
    a = F.greatest(F.floor((from_s - before_min * 60 - start_s) / record_s), F.lit(0)).cast("long")
    b = F.least(F.ceil((to_s + after_min * 60 - start_s) / record_s), n).cast("long")
    why = F.when(to_s <= from_s, "end before start").when(b <= a, "outside the recording")
    return F.when(why.isNull(), a), F.when(why.isNull(), b), why


def date_offset(d: Column, days: int = OFFSET_DAYS) -> Column:
    """N6. The same shift for all dates, so that intervals stay."""
    return F.date_sub(d, days)


def age_years(birth: Column, study: Column) -> Column:
    """N7. Whole 365-day years as text; X if unknown, 89+ from 89 on."""
    age = F.floor(F.datediff(study, birth) / 365)
    return F.when(age.isNull(), "X").when(age >= 89, "89+").otherwise(age.cast("string"))


def prefilter_cutoffs(text: Column) -> tuple[Column, Column]:
    """N8. High-pass and low-pass numbers of a prefilter text."""
    number = lambda kind: F.nullif(F.regexp_extract(text, rf"(?i){kind}[:\s]*([0-9]+\.?[0-9]*)", 1), F.lit("")).cast("double")
    return number("HP"), number("LP")


def ticks_to_seconds(ticks: Column) -> Column:
    """N14. 100 ns ticks as seconds."""
    return ticks / 1e7


def parse_size(text: Column) -> Column:
    """S12. Bytes of `751.9 kb` and the like: 1024 to a step, an unknown unit counts 1, a blank comes before the unit."""
    parts = F.split(F.trim(text), " ")
    unit = F.lower(F.substring(F.coalesce(F.get(parts, 1), F.lit("")), 1, 1))
    power = F.when(unit == "k", 1).when(unit == "m", 2).when(unit == "g", 3).when(unit == "t", 4).otherwise(0)
    return F.round(parts[0].try_cast("double") * F.pow(F.lit(1024.0), power)).cast("long")


def format_size(n: Column) -> Column:
    """S12. Bytes, or KB, MB, GB with one decimal."""
    return (
        F.when(n < 1024, F.format_string("%d B", n)).when(n < 1024**2, F.format_string("%.1f KB", F.floor(n * 10 / 1024 + 0.5) / 10))
        .when(n < 1024**3, F.format_string("%.1f MB", F.floor(n * 10 / 1024**2 + 0.5) / 10)).otherwise(F.format_string("%.1f GB", F.floor(n * 10 / 1024**3 + 0.5) / 10))
    )


def normal_age(text: Column) -> Column:
    """S13. A whole number of years, or null."""
    return F.when(F.trim(text).rlike(r"^\d+$"), F.trim(text).cast("int"))


def normal_sex(text: Column) -> Column:
    """S13. m or f for the usual spellings, other text in lower case."""
    t = F.lower(F.trim(text))
    return F.when(t.isin("m", "male", "man", "1"), "m").when(t.isin("f", "female", "woman", "0"), "f").otherwise(t)
