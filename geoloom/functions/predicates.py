"""Filters of the sources as boolean Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parse import null_to_blank


def in_town(c: Column, exact: tuple[str, ...], prefixes: tuple[str, ...]) -> Column:
    """Whether a town's name, as capitals and digits only, is one of the exact ones or begins with one of the prefixes (common misspellings among them)."""
    name = F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), "[^A-Z0-9]+", "")
    return reduce(lambda a, b: a | b, (name.startswith(p) for p in prefixes), name.isin(*exact))


def in_province(province: Column, postal: Column, code: str, prefix: str) -> Column:
    """Whether a row is of a province by its code, or else by its postal code."""
    return F.coalesce(province == code, F.lit(False)) | F.coalesce(postal.startswith(prefix), F.lit(False))


def in_box(x: Column, y: Column, west: float, south: float, east: float, north: float) -> Column:
    """Within a box, its edges included. As plain comparisons, which reach the scan."""
    return x.between(west, east) & y.between(south, north)


def finite(*columns: Column) -> Column:
    return reduce(lambda a, b: a & b, (c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")) for c in columns))


def where_text(columns: dict[str, Column], where: str) -> Column:
    """A condition `Field = 'value'` in text, whatever the case; the value 'active' stands for 'act' too, and what is not of this form is true. A field that is absent is blank."""
    import re

    found = re.search(r"([A-Za-z0-9_]+)\s*=\s*'([^']+)'", where)
    if not found:
        return F.lit(True)
    actual, expected = F.lower(null_to_blank(columns.get(found[1], F.lit(None).cast("string")).cast("string"))), found[2].lower()
    return actual.isin("active", "act") if expected == "active" else actual == expected


def field_among(c: Column, values: list[str]) -> Column:
    """Whether a field has one of the values as a part, whatever the case; no values are no condition."""
    actual = F.lower(null_to_blank(c.cast("string")))
    return reduce(lambda a, b: a | b, (F.contains(actual, F.lit(v.lower())) for v in values)) if values else F.lit(True)


def long_enough(ax: Column, ay: Column, bx: Column, by: Column, least: float = 2.0) -> Column:
    """Whether a segment is no shorter than so many units."""
    return F.hypot(bx - ax, by - ay) >= least


def accepted_geocode(status: Column, score: Column, locality: Column, town: str, least: float = 75) -> Column:
    return (status == "matched") & (score >= least) & (F.lower(locality) == town.lower())


#: Categories that count as useful whatever the flags say.
USEFUL = ("healthy_food_outlet", "retail_service", "retail_service_candidate", "food_or_household_retail")


def useful_business(healthy_food: Column, retail_services: Column, category: Column) -> Column:
    """Whether a classified business is kept: flagged as either, or of a useful class. Nulls are no reason to keep it."""
    return F.coalesce(healthy_food, F.lit(False)) | F.coalesce(retail_services, F.lit(False)) | F.coalesce(category.isin(*USEFUL), F.lit(False))
