"""Dates, times of day beyond 24 hours and bulletin time stamps as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of months.
MONTHS = {m: i for i, names in enumerate((("january", "jan"), ("february", "feb"), ("march", "mar"), ("april", "apr"), ("may",), ("june", "jun"), ("july", "jul"), ("august", "aug"), ("september", "sep", "sept"), ("october", "oct"), ("november", "nov"), ("december", "dec")), 1) for m in names}
DATE_FORMATS = ("yyyy-MM-dd", "M/d/yyyy", "d/M/yyyy")


def iso_date(c: Column) -> Column:
    """Milliseconds or text as an ISO date in UTC; null where invalid."""
    ms = c.cast("string").try_cast("long")
    return F.when(ms.isNotNull(), F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd")).otherwise(F.date_format(F.try_to_date(F.substring(F.trim(c.cast("string")), 1, 10), "yyyy-MM-dd"), "yyyy-MM-dd"))


def parse_date(c: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """The first format that fits, as ISO text; else the text as it is."""
    t = F.trim(c)
    return F.coalesce(*(F.date_format(F.try_to_date(t, f), "yyyy-MM-dd") for f in formats), t)


def clock_seconds(c: Column) -> Column:
    """Seconds of H:MM:SS, whose hours may pass 24; null where malformed."""
    p = F.split(F.trim(c), ":")
    n = lambda i: F.get(p, F.lit(i)).try_cast("int")
    return F.when((F.size(p) == 3) & (n(1) < 60) & (n(2) < 60), n(0) * 3600 + n(1) * 60 + n(2))


def month_number(c: Column) -> Column:
    low = F.lower(F.regexp_replace(F.trim(c), r"\.$", ""))
    return F.element_at(F.create_map(*(F.lit(v) for kv in MONTHS.items() for v in kv)), low)


def _stamp(c: Column, pattern: str, order: str) -> Column:
    """A local time stamp of a pattern; order names what its groups are: y, m (number), n (name of a month), d, t (hour), u (minute), p (half of the day)."""
    g = {k: F.regexp_extract(c, pattern, i) for i, k in enumerate(order, 1)}
    month = F.lpad(month_number(g["n"]).cast("string"), 2, "0") if "n" in g else F.lpad(g["m"], 2, "0")
    hour = g["t"].try_cast("int") if "t" in g else F.lit(0)
    if "p" in g:
        hour = hour % 12 + F.when(F.lower(g["p"]).startswith("p"), 12).otherwise(0)
    minute = g["u"].try_cast("int") if "u" in g else F.lit(0)
    return F.when(F.regexp_like(c, F.lit(pattern)), F.try_to_timestamp(F.concat_ws(" ", F.concat_ws("-", g["y"], month, F.lpad(g["d"], 2, "0")), F.format_string("%02d:%02d", F.coalesce(hour, F.lit(0)), F.coalesce(minute, F.lit(0)))), F.lit("yyyy-MM-dd HH:mm")))


# Fixed patterns: forms of bulletin times, in the order tried; 24-hour times stay as they are.
TEXT_STAMPS = [
    (r"(?i)([0-9]{1,2}):([0-9]{2}) *([ap])\.?m\.?[^0-9a-z]+(?:[a-z]+day,? +)?([a-z]{3,9})\.? +([0-9]{1,2}),? +([0-9]{4})", "tupndy"),
    (r"(?i)([a-z]{3,9})\.? +([0-9]{1,2}),? +([0-9]{4})[^0-9]{1,12}([0-9]{1,2}):([0-9]{2}) *([ap])\.?m", "ndytup"),
    (r"(?i)([a-z]{3,9})\.? +([0-9]{1,2}),? +([0-9]{4})[^0-9]{1,12}([0-9]{1,2}):?([0-9]{2})", "ndytu"),
    (r"([0-9]{4})-([0-9]{2})-([0-9]{2})[T ]([0-9]{2}):([0-9]{2})", "ymdtu"),
    (r"(?i)([a-z]{3,9})\.? +([0-9]{1,2}),? +([0-9]{4})", "ndy"),
    (r"([0-9]{4})-([0-9]{2})-([0-9]{2})", "ymd"),
]
NAME_STAMPS = [(r"([0-9]{4})([0-9]{2})([0-9]{2})[-_]?([0-9]{2})([0-9]{2})", "ymdtu"), (r"([0-9]{4})[-_]([0-9]{2})[-_]([0-9]{2})", "ymd"), (r"([0-9]{4})([0-9]{2})([0-9]{2})", "ymd")]


def bulletin_time(text: Column, name: Column, zone: str = "America/Vancouver") -> Column:
    """struct(local, utc, year) of the first form found in the text, else in the file's name. The zone is named, never the machine's."""
    local = F.coalesce(*(_stamp(text, p, o) for p, o in TEXT_STAMPS), *(_stamp(name, p, o) for p, o in NAME_STAMPS))
    return F.struct(F.date_format(local, "yyyy-MM-dd HH:mm").alias("local"), F.date_format(F.to_utc_timestamp(local, zone), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utc"), F.year(local).alias("year"))


def years(first: int, last: int) -> Column:
    return F.sequence(F.lit(first), F.lit(last))


def generated_at() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def severity_rank(levels: Column, ranks: dict[str, int]) -> Column:
    """The greatest rank among an array of levels; unknown ones count 0."""
    of = F.create_map(*(F.lit(v) for kv in ranks.items() for v in kv))
    return F.coalesce(F.array_max(F.transform(levels, lambda x: F.coalesce(F.element_at(of, x), F.lit(0)))), F.lit(0))


def timeline(ts: Column) -> list[Column]:
    """precision and the buckets by year, month and day."""
    return [F.when(ts.isNull(), "undated").otherwise("instant").alias("precision"), *(F.date_format(ts, f).alias(f"bucket_{n}") for n, f in (("year", "yyyy"), ("month", "yyyy-MM"), ("day", "yyyy-MM-dd")))]


def date_range(*columns: Column) -> list[Column]:
    """Aggregates: the least and greatest over several columns, nulls aside."""
    low, high = [F.min(c) for c in columns], [F.max(c) for c in columns]
    return [(reduce(lambda a, b: F.least(a, b), low)).alias("date_min"), (reduce(lambda a, b: F.greatest(a, b), high)).alias("date_max")]
