"""Text normalisers, classifiers and key builders as Column expressions."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .parse import blank_to_null

# Word substitutions of addresses and of road names; words dropped from business names.
ADDRESS_WORDS = [("avenue", "ave"), ("street", "st"), ("road", "rd"), ("boulevard", "blvd"), ("highway", "hwy"), ("drive", "dr"), ("place", "pl"), ("crescent", "cres"), ("north", "n"), ("south", "s"), ("east", "e"), ("west", "w")]
ROAD_WORDS = [("HIGHWAY", "HWY"), ("ROAD", "RD"), ("AVENUE", "AVE"), ("STREET", "ST"), ("BOULEVARD", "BLVD"), ("DRIVE", "DR"), ("CRESCENT", "CRES"), ("PLACE", "PL"), ("COURT", "CRT"), ("LANE", "LN"), ("FRONTAGE", "FRTG")]
LEGAL_FORMS = ("ltd", "limited", "inc", "corp", "corporation", "co", "company", "the", "canada", "bc", "b-c")
# Entities of HTML, in the order they are decoded; all other decimal ones follow.
ENTITIES = [("&nbsp;", " "), ("&amp;", "&"), ("&ndash;", "-"), ("&#8211;", "-"), ("&mdash;", "-"), ("&#8212;", "-"), ("&rsquo;", "'"), ("&#8217;", "'"), ("&ldquo;", '"'), ("&rdquo;", '"'), ("&#8220;", '"'), ("&#8221;", '"')]
# Dataset prefixes of the exposure families, in order; labels of datasets by prefix.
FAMILIES = [
    ("air-quality", ("aq", "pm25", "no2", "o3", "so2")),
    ("weather-biometeorology", ("wtwbm_",)),
    ("weather-thermal", ("wtutv_", "wthnrc", "wbnrc", "wtfsi", "wtlst", "dtr_", "dtw_")),
    ("greenness", ("grlan_", "grmod_", "gravh_", "grtcc_", "grump_")),
    ("built-environment", ("ale_", "cmg_", "indmsd_", "lcz_", "gen_", "nae_")),
    ("neighborhood", ("nh",)),
]
DATASET_LABELS = [
    ("aqfpm", "Fine particulate matter"), ("pm25dal", "PM2.5 DAL"), ("no2lur", "NO2 land-use regression"), ("o3chg", "Ozone change"), ("wtutv", "Universal thermal climate index"),
    ("wtwbm", "Weather biometeorology"), ("grlan", "Land greenness"), ("grmod", "Modeled greenness"), ("nh", "Neighborhood context"),
]
# Parcel classes by words in their description, in order.
PARCEL_CLASSES = [
    ("vacant", ("vacant",)),
    ("multi-family", ("strata", "multiple residence", "apartment", "4-plex", "triplex")),
    ("residential", ("house", "duplex", "mh -", "mobile home", "modular", "single family", "residential", "dwelling", "cottage", "townhouse")),
    ("commercial", ("office", "retail", "restaurant", "hotel", "motel", "store", "shopping", "bank", "commercial", "theatre", "cinema", "gas station", "car wash", "service station", "food", "medical", "dental", "veterinary", "pharmacy")),
    ("industrial", ("warehouse", "industrial", "manufacturing", "mill", "service repair", "shop", "plant", "yard", "storage", "truck", "freight", "lumber", "gravel", "concrete")),
    ("institutional", ("church", "school", "hospital", "government", "fire hall", "community", "library", "arena", "recreation", "civic", "daycare", "care facility", "lodge", "seniors")),
    ("farm", ("farm", "ranch", "forest", "agricultural", "crop")),
]
# Business classes in order: class, {column: pattern} of which any decides (`text` is name, description and category), healthy food, retail services, confidence.
BUSINESS_CLASSES = [
    ("excluded_non_access_poi", {"category": r"\bout of town\b|home business"}, False, False, "low"),
    ("healthy_food_outlet", {"text": r"\b(grocery|supermarket|farmers? market|produce|greengrocer|health food|food market)\b"}, True, True, "medium"),
    ("retail_service", {"text": r"\b(convenience store|pharmacy|retail|restaurant|coffee|cafe|deli|bank|financial|salon|barber|laund|library|medical|dental|travel agency|hotel|motel)\b"}, False, True, "medium"),
    ("retail_service_candidate", {"category": "commercial retail|commercial service|banks and other financial|restaurant"}, False, True, "low"),
    ("excluded_industrial_business", {"description": "warehouse|wholesale|manufacturing|contractor|transportation depot|truck|rail terminal|industrial|storage", "category": "warehousing|wholesale|manufacturing|contractor"}, False, False, "medium"),
]
# Classes of map points in order: class, {tag: values} of which any decides (None: any value), healthy food, retail services, confidence.
POINT_CLASSES = [
    ("healthy_food_outlet", {"shop": ("supermarket", "greengrocer", "health_food"), "amenity": ("marketplace",)}, True, True, "high"),
    ("food_or_household_retail", {"shop": ("convenience", "bakery", "butcher", "seafood", "deli", "department_store")}, False, True, "high"),
    ("retail_service", {"shop": None, "craft": None, "office": None, "amenity": ("restaurant", "cafe", "fast_food", "bank", "pharmacy", "post_office", "library", "fuel", "clinic", "dentist", "doctors", "pub", "bar")}, False, True, "high"),
]


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def postal(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, r"\s+", ""))


def header(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "^﻿", ""))


def slug(c: Column, sep: str = "-", ampersand: str = " ") -> Column:
    """Lower case; all runs that are not ASCII letters and digits become one separator, none at the ends."""
    words = F.regexp_replace(F.lower(F.replace(c, F.lit("&"), F.lit(ampersand))), "[^a-z0-9]+", sep)
    return F.regexp_replace(words, f"^{sep}+|{sep}+$", "")


@F.pandas_udf(T.StringType())
def decomposed(c: pd.Series) -> pd.Series:
    """Compatibility decomposition, which no built-in offers."""
    return c.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x))


def slug_decomposed(c: Column, sep: str = "-") -> Column:
    return slug(decomposed(c), sep)


def safe_name(c: Column) -> Column:
    return F.regexp_replace(c, "[^A-Za-z0-9_-]", "")


def business_name(c: Column) -> Column:
    """A slug without legal forms and other words that do not tell names apart."""
    bare = F.regexp_replace(slug(c), rf"\b({'|'.join(LEGAL_FORMS)})\b", "")
    return F.regexp_replace(F.regexp_replace(bare, "-+", "-"), "^-|-$", "")


def _replaced(c: Column, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda x, p: F.regexp_replace(x, rf"\b{p[0]}\b", p[1]), pairs, c)


def address(c: Column) -> Column:
    return F.trim(F.regexp_replace(_replaced(F.lower(c), ADDRESS_WORDS), "[^a-z0-9]+", " "))


def intersection_parts(c: Column) -> Column:
    """Sorted road names of an intersection's name; ranges of addresses and turning lanes are no roads."""
    name = F.regexp_replace(_replaced(F.regexp_replace(F.upper(c), "[.#]", ""), ROAD_WORDS), r"\bTURNING LN\b", "TURNING LANE")
    parts = F.transform(F.split(name, "&"), collapse)
    return F.array_sort(F.filter(parts, lambda p: ~p.isin("", "TURNING LANE") & ~p.rlike(r"[0-9]{4,}\s+TO\s+[0-9]{4,}")))


def html_text(c: Column) -> Column:
    """The text of a page: no scripts, styles or tags, entities decoded, white space collapsed."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"(?is)<script.*?</script>", " "), r"(?is)<style.*?</style>", " "), r"(?s)<[^>]+>", " ")
    named = reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), ENTITIES, bare)
    return collapse(numeric_entities(named))


def numeric_entities(c: Column) -> Column:
    """Decimal character references decoded, by parts of the text; numbers count modulo 65536, as UTF-16 units do, and halves of pairs stay out."""
    parts = F.split(c, "&#")
    number = lambda p: F.regexp_extract(p, "^([0-9]+);", 1)

    def decoded(p: Column) -> Column:
        code = F.substring(number(p), -15, 15).try_cast("long") % 65536
        unit = F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")
        return F.when(p.rlike("^[0-9]+;"), F.concat(F.when(code.between(0xD800, 0xDFFF), "").otherwise(unit), F.regexp_replace(p, "^[0-9]+;", ""))).otherwise(F.concat(F.lit("&#"), p))

    rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), decoded)
    return F.when(c.contains("&#"), F.concat(F.element_at(parts, 1), F.array_join(rest, ""))).otherwise(c)


def absolute_url(c: Column, base: str) -> Column:
    """Relative addresses under base, http as https, no default port."""
    c = F.trim(c)
    full = F.when(c.rlike("(?i)^https?://"), c).when(c.startswith("//"), F.concat(F.lit("https:"), c)).when(c.startswith("/"), F.concat(F.lit(re.match(r"https?://[^/]+", base)[0]), c)).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), c))
    return F.regexp_replace(F.regexp_replace(full, "(?i)^http://", "https://"), r"^(https://[^/:]+):(80|443)(/|$)", "$1$3")


def url_stem(c: Column) -> Column:
    """The last part of an address without its extension, as letters, digits and `_`."""
    last = F.regexp_extract(F.regexp_replace(c, r"[?#].*$", ""), r"([^/]*)/?$", 1)
    return F.regexp_replace(F.regexp_replace(last, r"\.[^.]*$", ""), "[^A-Za-z0-9]+", "_")


def short_hash(c: Column) -> Column:
    return F.substring(F.sha1(c.cast("binary")), 1, 12)


def section(c: Column, label: str, ends: tuple[str, ...] = ()) -> Column:
    """The text after `label:` up to the next label or the end."""
    stop = "|".join([*(rf"{re.escape(e)}:" for e in ends), r"\z"])
    return blank_to_null(collapse(F.regexp_extract(c, rf"(?is){re.escape(label)}:\s*(.*?)\s*(?:{stop})", 1)))


def all_matches(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def contexts(c: Column, pattern: str, width: int = 300) -> Column:
    """For each match: the match with so many characters on either side (fewer at the ends)."""
    return F.regexp_extract_all(c, F.lit(rf"(?s).{{0,{width}}}(?:{pattern}).{{0,{width}}}"), F.lit(0))


def named_areas(c: Column, stop_words: tuple[str, ...]) -> Column:
    """Names in a list written as prose, without stop words and shorter ones than three letters."""
    bare = F.regexp_replace(F.lower(c), rf"\b({'|'.join(stop_words)})\b", " ")
    return F.array_distinct(F.filter(F.transform(F.split(bare, r"[,;:.()]|\band\b|\bincluding\b"), collapse), lambda x: F.length(x) >= 3))


def title(hint: Column, text: Column, marker: str = "ISSUED", limit: int = 500) -> Column:
    """The hint, else what stands before the marker, else the first characters."""
    return F.coalesce(blank_to_null(hint), blank_to_null(F.when(F.contains(text, F.lit(marker)), F.substring_index(text, marker, 1))), blank_to_null(F.substring(text, 1, limit)))


def keyword_class(c: Column, rules: list[tuple[str, tuple[str, ...]]], default: str = "other") -> Column:
    """The first class one of whose words is part of the lower-cased text."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return F.coalesce(*(F.when(reduce(lambda a, b: a | b, (F.contains(low, F.lit(w)) for w in words)), F.lit(k)) for k, words in rules), F.lit(default))


def _classed(rules: list[tuple[Column, str, bool, bool, str]], default: str) -> Column:
    told = lambda k, h, r, s: F.struct(F.lit(k).alias("category"), F.lit(h).alias("healthy_food"), F.lit(r).alias("retail_services"), F.lit(s).alias("confidence"))
    return F.coalesce(*(F.when(c, told(k, h, r, s)) for c, k, h, r, s in rules), told(default, False, False, "low"))


def business_class(name: Column, description: Column, category: Column) -> Column:
    """struct(category, healthy_food, retail_services, confidence) of the first of BUSINESS_CLASSES that matches."""
    blank = lambda c: F.coalesce(c, F.lit(""))
    of = {"text": F.lower(F.concat_ws(" ", blank(name), blank(description), blank(category))), "category": F.lower(blank(category)), "description": F.lower(blank(description))}
    return _classed([(reduce(lambda a, b: a | b, (of[c].rlike(p) for c, p in patterns.items())), k, h, r, s) for k, patterns, h, r, s in BUSINESS_CLASSES], "unclassified_business")


def point_class(tags: Column) -> Column:
    """The same struct of the first of POINT_CLASSES that a map of tags fits."""
    tag = lambda t: F.coalesce(F.try_element_at(tags, F.lit(t)), F.lit(""))
    fits = lambda t, values: tag(t) != "" if values is None else tag(t).isin(*values)
    return _classed([(reduce(lambda a, b: a | b, (fits(t, v) for t, v in wanted.items())), k, h, r, s) for k, wanted, h, r, s in POINT_CLASSES], "unclassified_osm_poi")


def prefix_family(c: Column, families: list[tuple[str, tuple[str, ...]]] = FAMILIES, default: str = "other") -> Column:
    return F.coalesce(*(F.when(c.rlike(f"^({'|'.join(p)})"), F.lit(k)) for k, p in families), F.lit(default))


def dataset_label(c: Column) -> Column:
    """The label of the first known prefix with what follows it; else the name in capitals, `_` as spaces."""
    known = (F.when(c.startswith(p), F.trim(F.concat_ws(" ", F.lit(label), F.regexp_replace(F.substring(c, len(p) + 1, 1000), "^_+|_+$", "")))) for p, label in DATASET_LABELS)
    return F.coalesce(*known, F.upper(F.replace(c, F.lit("_"), F.lit(" "))))


def address_candidates(raw: Column, city: str, region: str, country: str) -> Column:
    """Queries to try in order: as given, with the region, with the city, without a unit, without a postal code."""
    t = collapse(raw)
    unitless = F.regexp_replace(t, r"(?i)^(?:unit|suite|#)\s*[0-9a-z]+[,\s-]+|^[0-9]+\s*-\s*(?=[0-9])", "")
    no_postal = F.trim(F.regexp_replace(t, r"(?i)[, ]*[a-z][0-9][a-z] ?[0-9][a-z][0-9]", ""))
    found = F.array(t, F.concat_ws(", ", t, F.lit(region), F.lit(country)), F.concat_ws(", ", t, F.lit(city), F.lit(region)), unitless, no_postal)
    return F.array_distinct(F.filter(found, lambda x: x.isNotNull() & (x != "")))


def joined(sep: str, *columns: Column) -> Column:
    """Those that are not blank, joined."""
    return F.concat_ws(sep, *(blank_to_null(c) for c in columns))


def archive_name(path: Column, otherwise: str = "annual") -> Column:
    """struct(dataset, cadence) from a file name: the time stamp with a cadence at its end is no part of the dataset; names without a cadence get the given one."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    dataset = F.regexp_replace(F.regexp_replace(name, r"\.zip$", ""), "(?i)_[0-9]{4}-[0-9]{2}-[0-9]{2}_[0-9]{2}-[0-9]{2}-[0-9]{2}_(annual|monthly)$", "")
    cadence = F.nullif(F.lower(F.regexp_extract(name, r"(?i)_(annual|monthly)\.zip$", 1)), F.lit(""))
    return F.struct(dataset.alias("dataset"), F.coalesce(cadence, F.lit(otherwise)).alias("cadence"))


def glob_regex(pattern: str) -> str:
    """`*` stands for anything; the rest for itself."""
    return "^" + ".*".join(re.escape(p) for p in pattern.split("*")) + "$"


def key(sep: str, *columns: Column, upper: bool = False) -> Column:
    out = F.concat_ws(sep, *(F.coalesce(c.cast("string"), F.lit("")) for c in columns))
    return F.upper(out) if upper else out


def byte_size(c: Column) -> Column:
    """Sizes as people read them: kilobytes and megabytes with one decimal, larger ones with two."""
    rungs = [(4, "TB", 2), (3, "GB", 2), (2, "MB", 1), (1, "KB", 1)]
    told = reduce(lambda when, r: when.when(c >= 1024 ** r[0], F.format_string(f"%.{r[2]}f {r[1]}", c / float(1024 ** r[0]))), rungs, F)
    return told.otherwise(F.format_string("%d B", c.cast("long")))


def variable_prefix(c: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(c, "_"), 1), "[0-9]", "")


def violation_kind(label: Column) -> Column:
    """Non-critical is told first, since its name contains the other's."""
    low = F.lower(label)
    return F.when(low.contains("non-critical violations"), "non_critical").when(low.contains("critical violations"), "critical")
