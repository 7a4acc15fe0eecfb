"""Order-aware dedupe, keyed merges, matching cascades and set operations on DataFrames.

Rows have no order of their own in Spark: where first or last matters, callers pass the ordering columns.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def first_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key by order, in which nulls come last: an aggregation, so that a crowded key is reduced before the shuffle."""
    ordering = F.struct(*(x for o in order for x in (o.isNull(), o)), *[F.col(c) for c in df.columns if c not in keys and _comparable(df, c)])
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), ordering).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def _comparable(df: DataFrame, c: str) -> bool:
    return "map<" not in df.schema[c].dataType.simpleString()


def last_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the greatest value of a numeric order column in each key; a row without one only where the key has no other."""
    return first_per_key(df, keys, F.negative(F.col(order)))


def distinct_lists(*groups: Column) -> Column:
    """Array union that keeps the order of first occurrence."""
    return F.array_distinct(F.concat(*(F.coalesce(g, F.array().cast("array<string>")) for g in groups)))


def left_with_counts(left: DataFrame, right: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """(left join, how many rows of left had a match and how many had none)."""
    marked = left.join(right.withColumn("_match", F.lit(True)), on, "left").withColumn("matched", F.col("_match").isNotNull()).drop("_match")
    return marked, marked.groupBy("matched").count()


def scored_assets(geometry: DataFrame, scores: DataFrame, key: str, *optional: DataFrame) -> DataFrame:
    """Geometry with its scores, inner, and further tables where they have the key."""
    return reduce(lambda a, b: a.join(b, key, "left"), optional, geometry.join(scores, key))


def residual(total: DataFrame, parts: list[DataFrame], keys: list[str], value: str) -> DataFrame:
    """What of the totals the parts leave, where that is above zero."""
    taken = reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.sum(value).alias("_taken"))
    left = F.greatest(F.lit(0), F.col(value) - F.coalesce("_taken", F.lit(0)))
    return total.join(taken, keys, "left").withColumn(value, left).drop("_taken").where(F.col(value) > 0)


def override(df: DataFrame, overrides: DataFrame, on: str, optional: str, order: str, fields: list[str]) -> DataFrame:
    """df with the fields of the first override, by its order, of the same name and, where the override gives one, the same further field."""
    o = overrides.select(F.col(on), F.col(optional).alias("_optional"), F.col(order).alias("_order"), *(F.col(f).alias(f"_o_{f}") for f in fields))
    rows = df.withColumn("_id", F.monotonically_increasing_id())
    fits = rows.join(o, on).where(F.col("_optional").isNull() | (F.col("_optional") == F.col(optional)))
    best = fits.groupBy("_id").agg(F.min_by(F.struct(*(f"_o_{f}" for f in fields)), "_order").alias("_best"))
    joined = rows.join(best, "_id", "left")
    return joined.select(*(F.coalesce(F.col(f"_best._o_{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in df.columns))


def preserve_missing(new: DataFrame, old: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """new, with the fields it lacks taken from old."""
    before = old.select(key, *(F.col(f).alias(f"_old_{f}") for f in fields))
    return new.join(before, key, "left").select(*(F.coalesce(F.col(c), F.col(f"_old_{c}")).alias(c) if c in fields else F.col(c) for c in new.columns))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new by key, and those of old whose key new has not. Keys are unique in either."""
    return new.unionByName(old.join(new.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def pending(wanted: DataFrame, done: DataFrame, keys: list[str], failed: str | None = None) -> DataFrame:
    """What of wanted is not done yet; failures are to be tried again."""
    finished = done.where(F.col(failed).isNull()) if failed else done
    return wanted.join(finished.select(*keys), keys, "left_anti")


def merge_discoveries(df: DataFrame, key: str, methods: str, hint: str, order: str) -> DataFrame:
    """A row a key: the distinct methods that found it, sorted, and the first hint by order that is not null."""
    return df.groupBy(key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(methods)))).alias(methods), F.min_by(hint, F.when(F.col(hint).isNotNull(), F.col(order))).alias(hint))


def dedupe_listing_duplicates(df: DataFrame, key: Column, row_id: str, order: Column, methods: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(the first row of each key, with the sorted union of all rows' methods; a row (kept, duplicate) for each other row of a key). However many rows share a key, none gathers them: duplicates are rows, and methods are distinct before they meet."""
    keyed = df.withColumn("_key", key)
    rest = [c for c in df.columns if c != methods]
    first = keyed.groupBy("_key").agg(F.min_by(F.struct(*rest), F.struct(order, row_id)).alias("_first"))
    out = first.select("_key", "_first.*")
    if methods:
        united = keyed.select("_key", F.explode(methods).alias("_m")).distinct().groupBy("_key").agg(F.array_sort(F.collect_list("_m")).alias(methods))
        out = out.join(united, "_key", "left")
    duplicates = keyed.select("_key", F.col(row_id).alias("duplicate")).join(first.select("_key", F.col(f"_first.{row_id}").alias("kept")), "_key").where("duplicate != kept").select("kept", "duplicate")
    return out.drop("_key"), duplicates


def cascade(source: DataFrame, source_id: str, tiers: list[DataFrame], target_id: str) -> DataFrame:
    """(source_id, tier, target_id): for each source the matches of its first tier that has any; sources without any keep a null."""
    numbered = reduce(DataFrame.unionByName, (t.select(source_id, F.lit(i).alias("tier"), target_id) for i, t in enumerate(tiers, 1)))
    best = numbered.groupBy(source_id).agg(F.min("tier").alias("tier"))
    return source.select(source_id).join(best, source_id, "left").join(numbered, [source_id, "tier"], "left")


def spread_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, copies: int = 16) -> DataFrame:
    """The rows of left and right with equal keys, where few keys hold most rows: left is dealt by chance over so many copies of right, so that a crowded key is the work of many tasks, however few bytes it is."""
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = left.withColumn("_deal", F.pmod(F.xxhash64(*left.columns), F.lit(copies))).repartition(parts, left_key, "_deal")
    copied = right.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long")))).repartition(parts, right_key, "_copy")
    return dealt.join(copied, (F.col(left_key) == F.col(right_key)) & (F.col("_deal") == F.col("_copy"))).drop("_deal", "_copy")


#: Rows of a key that come as one array (files of columns code 504 values together), and pairs of a key that are worth a task of their own.
BLOCK, PAIRS = 168, 1 << 22


def block_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, copies: int = 64) -> DataFrame:
    """The rows of left and right with equal keys, where results are many more than rows; neither side has nulls as keys.

    A key's rows of right are joined as arrays of some hundred, each to all rows of left before the next one. Written as
    columns, such a result repeats short runs, which takes a fifth of a byte a row; a run of all rows of a crowded key
    doesn't fit what files compress at once and takes one byte or two. Left is dealt over so many copies of right, for
    keys of many pairs only.
    """
    parts, c = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col
    many = right.groupBy(c(right_key).alias("_k")).agg(F.count("*").alias("_many"))
    pairs = many.join(left.groupBy(c(left_key).alias("_k")).agg(F.count("*").alias("_rows")), "_k")
    crowded = pairs.where(c("_rows").cast("double") * c("_many") > PAIRS).select("_k", F.least(F.lit(copies).cast("long"), "_rows", F.ceil(c("_rows").cast("double") * c("_many") / PAIRS)).alias("_copies"))
    rest = [x for x in right.columns if x != right_key]
    lists = right.withColumn("_hash", F.xxhash64(*right.columns)).join(many, c(right_key) == c("_k")).groupBy(right_key, F.pmod("_hash", F.ceil(c("_many") / (16 * BLOCK))).alias("_list")).agg(F.collect_list(F.struct(*rest)).alias("_all"))
    blocks = lists.select(right_key, F.explode(F.transform(F.sequence(F.lit(1), F.size("_all"), F.lit(BLOCK)), lambda i: F.slice("_all", i, BLOCK))).alias("_rows"))
    times = F.coalesce("_copies", F.lit(1).cast("long"))
    copied = blocks.join(crowded, c(right_key) == c("_k"), "left").select(right_key, "_rows", F.explode(F.sequence(F.lit(0).cast("long"), times - 1)).alias("_copy")).repartition(parts, right_key, "_copy")
    dealt = left.join(crowded, c(left_key) == c("_k"), "left").select(*left.columns, F.pmod(F.xxhash64(*left.columns), times).alias("_deal")).repartition(parts, left_key, "_deal")
    # A merge join passes once over its left side, here the arrays.
    return copied.hint("merge").join(dealt, (c(left_key) == c(right_key)) & (c("_deal") == c("_copy"))).select(*left.columns, right_key, F.inline("_rows"))


def key_cascade(source: DataFrame, source_id: str, known: DataFrame, target_id: str, keys: list[tuple[str, str]]) -> DataFrame:
    """(source_id, tier, target_id) as by cascade, of tiers that are equal keys: a column of source and one of known each."""
    there = lambda theirs: known.select(F.col(theirs).alias("_key"), F.col(target_id).alias("_target"))
    return keyed_tiers(source, source_id, [(mine, lambda _, t=theirs: (there(t), there(t))) for mine, theirs in keys], target_id, known.schema[target_id].dataType)


def keyed_tiers(source: DataFrame, source_id: str, tiers: list[tuple[str, Callable[[DataFrame], tuple[DataFrame, DataFrame]]]], target_id: str, kind: DataType) -> DataFrame:
    """(source_id, tier, target_id) as by cascade. A tier is a column of source and a function of the rows of source that have no match yet; it returns the keys (`_key`) that have matches, and those with their matches (`_key`, `_target`).

    Whether an id has a match in a tier is told from the keys alone, so a tier's pairs are made only for the ids that
    end there, and are results as they leave the join. Rows that repeat an id share their matches. A null id has none.
    """
    ids = source.where(F.col(source_id).isNotNull())
    copies = ids.groupBy(source_id).agg(F.count("*").alias("_n")).where("_n > 1")
    rest = ids.join(copies, source_id, "left").withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("_n", F.lit(1).cast("long"))))).drop("_n")
    without, out = source, []
    for i, (mine, tier) in enumerate(tiers, 1):
        keys, there = (df.where("_key is not null") for df in tier(rest))
        matched = ids.join(keys.select("_key").distinct(), F.col(mine) == F.col("_key"), "left_semi").select(source_id).distinct()
        here = rest.join(matched, source_id, "left_semi").where(F.col(mine).isNotNull()).select(F.col(source_id), F.col(mine).alias("_mine"))
        out.append(block_join(here, there, "_mine", "_key").select(source_id, F.lit(i).alias("tier"), F.col("_target").alias(target_id)))
        rest, without = (df.join(matched, source_id, "left_anti") for df in (rest, without))
    none = without.select(source_id, F.lit(None).cast("int").alias("tier"), F.lit(None).cast(kind).alias(target_id))
    return reduce(DataFrame.unionByName, [*out, none])


def token_matches(left: DataFrame, right: DataFrame, left_id: str, right_id: str, name: str = "name", sep: str = "-", most: int = 5) -> DataFrame:
    """(left_id, right_id, exact, overlap): equal names, else names that share at least min(2, all) tokens of three letters and more; the first few by id where there is no equal one."""
    exact = left.join(right, name).select(left_id, right_id)
    open_ = left.join(exact.select(left_id).distinct(), left_id, "left_anti")
    tokens = F.array_distinct(F.filter(F.split(name, sep), lambda t: F.length(t) > 2))
    wanted = open_.select(left_id, F.explode(tokens).alias("token"), F.least(F.lit(2), F.size(tokens)).alias("need"))
    have = right.select(right_id, F.explode(F.array_distinct(F.split(name, sep))).alias("token"))
    near = wanted.join(have, "token").groupBy(left_id, right_id).agg(F.count("*").alias("overlap"), F.first("need").alias("need")).where("overlap >= need")
    ranked = near.withColumn("_n", F.row_number().over(Window.partitionBy(left_id).orderBy(right_id))).where(F.col("_n") <= most)
    return exact.select(left_id, right_id, F.lit(True).alias("exact"), F.lit(None).cast("long").alias("overlap")).unionByName(ranked.select(left_id, right_id, F.lit(False).alias("exact"), "overlap"))


def scored_matches(by_name: DataFrame, by_address: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """(left_id, right_id, score): a name alone counts 75, an address alone 85, both 100; each left row's best, and each right row once."""
    pairs = by_name.select(left_id, right_id, F.lit(1).alias("n"), F.lit(0).alias("a")).unionByName(by_address.select(left_id, right_id, F.lit(0).alias("n"), F.lit(1).alias("a")))
    flags = pairs.where(F.col(left_id).isNotNull() & F.col(right_id).isNotNull()).groupBy(left_id, right_id).agg(F.max("n").alias("n"), F.max("a").alias("a"))
    scored = flags.select(left_id, right_id, F.when((F.col("n") == 1) & (F.col("a") == 1), 100).when(F.col("a") == 1, 85).otherwise(75).alias("score"))
    best = scored.groupBy(left_id).agg(F.min_by(F.struct(right_id, "score"), F.struct(-F.col("score"), right_id)).alias("m")).select(left_id, "m.*")
    return best.groupBy(right_id).agg(F.min_by(F.struct(left_id, "score"), F.struct(-F.col("score"), left_id)).alias("m")).select(f"m.{left_id}", right_id, "m.score")


def scored_by_keys(left: DataFrame, right: DataFrame, left_id: str, right_id: str, name: list[str], address: list[str]) -> DataFrame:
    """scored_matches of rows that agree in all columns of a name or of an address, which both sides have. A row that repeats an id has the same keys or keys that follow from the ids.

    A left row's best match is the least right row of both keys, else of the address, else of the name: three least
    rows by key, looked up, whatever the number of pairs that agree.
    """
    found, best = left.where(F.col(left_id).isNotNull()), []
    for keys, score in ((list(dict.fromkeys(name + address)), 100), (address, 85), (name, 75)):
        least = right.where(F.col(right_id).isNotNull()).groupBy(*keys).agg(F.min(right_id).alias(f"_r{score}"))
        found = found.join(least, keys, "left")
        best.append(F.when(F.col(f"_r{score}").isNotNull(), F.struct(F.lit(-score).alias("s"), F.col(f"_r{score}").alias("r"))))
    one = found.select(left_id, F.coalesce(*best).alias("m")).where("m is not null").groupBy(left_id).agg(F.min("m").alias("m"))
    return one.groupBy(F.col("m.r").alias(right_id)).agg(F.min(F.struct("m.s", left_id)).alias("b")).select(f"b.{left_id}", right_id, F.negative("b.s").alias("score"))


def part_set_matches(left: DataFrame, right: DataFrame, left_id: str, right_id: str, parts: str = "parts") -> DataFrame:
    """(left_id, right_id, exact): the last right row with the same set of parts, else the one that shares most, at least two and all of one side; of these the one with fewer parts, then the first."""
    # Sets are matched once each, however many rows have them.
    sets = left.select(F.array_sort(parts).alias("_set")).where("_set is not null").distinct().withColumn("_key", F.array_compact("_set"))
    known = right.withColumn("_key", F.array_compact(F.array_sort(parts))).groupBy("_key").agg(F.max(right_id).alias(right_id))
    equal = sets.join(known, "_key").select("_set", right_id, F.lit(True).alias("exact"))
    open_ = sets.join(equal, "_set", "left_anti").select("_set", F.size("_set").alias("_n"), F.explode("_set").alias("_part"))
    have = right.select(right_id, F.size(parts).alias("_m"), F.explode(parts).alias("_part"))
    near = open_.join(have, "_part").groupBy("_set", right_id).agg(F.count("*").alias("_k"), F.first("_n").alias("_n"), F.first("_m").alias("_m")).where("_k >= 2 and (_k = _n or _k = _m)")
    best = near.groupBy("_set").agg(F.min_by(right_id, F.struct(-F.col("_k"), "_m", right_id)).alias(right_id)).select("_set", right_id, F.lit(False).alias("exact"))
    rows = left.select(left_id, F.array_sort(parts).alias("_mine"))
    return spread_join(rows, equal.unionByName(best), "_mine", "_set").select(left_id, right_id, "exact")


def contained_names(texts: DataFrame, names: DataFrame, text_id: str, text: str, name_id: str, name: str, least: int = 4) -> DataFrame:
    """(text_id, name_id): names of so many letters that occur in the lower-cased text. Texts and names meet by runs of `least` letters of a text and the first letters of a name; only ids go through that join, texts come back for the pairs that met."""
    low = texts.select(text_id, F.lower(text).alias("_text"))
    known = names.where(F.length(name) >= least).select(name_id, F.lower(name).alias("_name")).dropDuplicates([name_id, "_name"])
    starts = known.select(F.substring("_name", 1, least).alias("_gram")).distinct()
    places = F.sequence(F.lit(1), F.greatest(F.length("_text") - least + 1, F.lit(1)))
    grams = low.select(text_id, F.explode(F.array_distinct(F.transform(places, lambda i: F.substring("_text", i, F.lit(least))))).alias("_gram")).join(starts, "_gram", "left_semi")
    pairs = grams.join(known.withColumn("_gram", F.substring("_name", 1, least)), "_gram").select(text_id, name_id, "_name")
    return pairs.join(low, text_id).where(F.contains("_text", "_name")).select(text_id, name_id).distinct()


def wide_merge(batches: list[DataFrame], key: str, base: list[str]) -> DataFrame:
    """One row a key of batches with the same key, unique in each: base columns of the first batch that has a value, all others of the last. Types stay as they are."""
    renamed = [b.select(key, *(F.col(f"`{c}`").alias(f"_{i}_{c}") for c in b.columns if c != key)) for i, b in enumerate(batches)]
    wide = reduce(lambda a, b: a.join(b, key, "full_outer"), renamed)
    names = list(dict.fromkeys(c for b in batches for c in b.columns if c != key))
    have = {c: [f"_{i}_{c}" for i, b in enumerate(batches) if c in b.columns] for c in names}
    return wide.select(key, *(F.coalesce(*(F.col(f"`{x}`") for x in (have[c] if c in base else reversed(have[c])))).alias(c) for c in names))


def geocoded(candidates: DataFrame, cache: DataFrame, locality: str, least: float = 75, high: float = 95) -> DataFrame:
    """Of (id, rank, query): the first query by rank with a matched answer of that locality and score, with its confidence."""
    good = cache.where((F.col("status") == "matched") & (F.col("score") >= least) & (F.lower("locality") == locality.lower()))
    hit = candidates.join(good, "query").groupBy("id").agg(F.min_by(F.struct("query", "score", "lon", "lat"), "rank").alias("g")).select("id", "g.*")
    return hit.withColumn("confidence", F.when(F.col("score") >= high, "high").otherwise("medium"))


def bridged(sources: list[tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """Tables of several eras under one schema: each with {new name: old name}; absent fields are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.select(*(F.col(f"`{old}`").alias(new) for new, old in names.items())) for df, names in sources))


def unpivoted(df: DataFrame, ids: list[str], values: list[str], name: str = "variable", value: str = "value") -> DataFrame:
    return df.unpivot(ids, values, name, value)


def summarised(df: DataFrame, groups: DataFrame, key: str, value: Callable[[], Column], name: str = "total") -> DataFrame:
    """Every group with the aggregate of its rows, 0 where it has none."""
    totals = df.groupBy(key).agg(value().alias(name))
    return groups.join(totals, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def count_by(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """Rows by key; null and blank keys count as unknown. Most first, ties by key."""
    return df.groupBy(F.coalesce(F.nullif(key.cast("string"), F.lit("")), F.lit("unknown")).alias(name)).count().orderBy(F.desc("count"), name)


def missing_keys(have: DataFrame, want: DataFrame, keys: list[str]) -> DataFrame:
    return want.select(*keys).distinct().join(have.select(*keys), keys, "left_anti")


def validated(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, failures) for conditions that every row should fulfil; null counts as a failure."""
    row = df.agg(*(F.count_if(~F.coalesce(c, F.lit(False))).alias(k) for k, c in rules.items()))
    return row.unpivot([], list(rules), "rule", "failures")
