"""Tolerant parsing of numbers and sentinels as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts that stand for a missing exposure value, and for a suppressed census value.
SENTINELS = ("", "NULL", "-9999", "-9999.0", "-9999.00")
SUPPRESSED = ("", "x", "F")


def finite(c: Column) -> Column:
    """c, or null where it is NaN or infinite."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def to_double(c: Column) -> Column:
    return finite(c.cast("string").try_cast("double"))


def js_number(c: Column) -> Column:
    """A blank text is 0, an absent (null) one stays null, anything unparsable is null."""
    return F.when(F.trim(c) == "", F.lit(0.0)).otherwise(to_double(F.trim(c)))


def comma_number(c: Column) -> Column:
    """The leading number of a text after its thousands commas are dropped."""
    return to_double(F.nullif(F.regexp_extract(F.regexp_replace(c, ",", ""), r"^\s*([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?)", 1), F.lit("")))


def sentinel_number(c: Column) -> Column:
    """Null for sentinels and all that is not finite."""
    t = F.trim(c)
    return F.when(~t.isin(*SENTINELS), to_double(t))


def money_int(c: Column) -> Column:
    """A whole number after `$` and commas are dropped; a fraction is cut off."""
    return to_double(F.regexp_replace(F.trim(c), r"[$,]", "")).cast("long")


def census_value(c: Column) -> Column:
    """Null where suppressed; commas dropped; two decimals, ties to even."""
    t = F.trim(c)
    return F.when(~t.isin(*SUPPRESSED), round_even(to_double(F.regexp_replace(t, ",", "")), 2))


def clamp_ratio(c: Column) -> Column:
    """Percentages (over 1) become ratios; the result lies within 0 and 1."""
    return F.when(c.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.when(c > 1, c / 100).otherwise(c))))


def first_level(c: Column) -> Column:
    """The first digit from 0 to 5 in a text: '10' gives 1."""
    return F.nullif(F.regexp_extract(c, "[0-5]", 0), F.lit("")).cast("int")


def level_colour(level: Column, colours: dict[int, str], default: str) -> Column:
    return F.coalesce(*(F.when(level == k, F.lit(v)) for k, v in colours.items()), F.lit(default))


def full_year(yy: Column) -> Column:
    """Two-digit years from 80 on are of the last century."""
    return F.when(yy >= 80, yy + 1900).otherwise(yy + 2000)


def round_up(c: Column, digits: int = 0) -> Column:
    """Ties go up, also below zero."""
    k = 10.0**digits
    return F.floor(c * k + 0.5) / k


def round_even(c: Column, digits: int = 0) -> Column:
    """Ties go to the even digit."""
    return F.bround(c, digits)


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def null_to_blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit(""))


def first_present(*columns: Column) -> Column:
    """The first that is neither null nor blank."""
    return F.coalesce(*(blank_to_null(c) for c in columns))


def first_number(*columns: Column, dialect=js_number) -> Column:
    return F.coalesce(*(dialect(c) for c in columns))


def find_column(df: DataFrame, *names: str) -> Column | None:
    """The first of the names that df has, whatever its case."""
    by_lower = {c.lower(): c for c in reversed(df.columns)}
    return next((F.col(f"`{by_lower[n.lower()]}`") for n in names if n.lower() in by_lower), None)


def numeric_columns(df: DataFrame, sample: int = 5001) -> list[str]:
    """Columns that hold a number in any of the first rows."""
    head = df.limit(sample)
    found = head.agg(*(F.max(sentinel_number(F.col(f"`{c}`").cast("string")).isNotNull()).alias(c) for c in df.columns)).first()
    return [c for c in df.columns if found[c]]
