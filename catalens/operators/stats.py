"""Statistics of observations: totals, by observer, ranks, countries, and groups of related items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalens.operators.numbering import numbered


def _summary() -> list[Column]:
    place = F.struct("ms", "obs_key")
    return [
        F.count("*").alias("n"), F.min("ms").alias("first_ms"), F.min_by("item", place).alias("first_item"), F.max("ms").alias("last_ms"),
        # strict comparison: of equal last times the first key counts
        F.max_by("item", F.struct(F.col("ms"), (-F.col("obs_key")).alias("k"))).alias("last_item"),
    ]


def observation_public_stats(observations: DataFrame) -> DataFrame:
    """One row: n, first and last time and item, distinct observers and items, the most observed item and its count.

    Observations are (obs_key, observer, item, ms, country). Ties go to the smallest key; of items with one count to the
    first in the alphabet. Items are counted first, so the most observed one comes from a row for each item.
    """
    whole = observations.agg(*_summary(), F.count_distinct("observer").alias("observers"), F.count_distinct("item").alias("items"))
    most = observations.groupBy("item").agg(F.count("*").alias("k")).orderBy(F.desc("k"), "item").limit(1).select(F.col("item").alias("most_item"), F.col("k").alias("most_n"))
    return whole.crossJoin(F.broadcast(most))  # one row each


def observation_countries(observations: DataFrame) -> DataFrame:
    """Observations per country; those without one don't count."""
    return observations.filter("country is not null").groupBy("country").agg(F.count("*").alias("n"))


def observer_rank(observations: DataFrame) -> DataFrame:
    """(observer, n, rank): 1 for most observations; of equal counts the one whose first key is smaller.

    A row for each observer is numbered in that order, by ranges of it: observers of one count don't share a task.
    """
    counts = observations.groupBy("observer").agg(F.count("*").alias("n"), F.min("obs_key").alias("first_key"))
    return numbered(counts, F.desc("n"), "first_key", "observer", to="rank", base=1).select("observer", "n", "rank")


def observation_user_stats(observations: DataFrame, ranks: DataFrame) -> DataFrame:
    """The same summary for each observer, with rank (0 for one without)."""
    own = observations.groupBy("observer").agg(*_summary(), F.count_distinct("item").alias("items"), F.count_distinct("country").alias("countries"))
    return own.join(ranks.select("observer", "rank"), "observer", "left").withColumn("rank", F.coalesce("rank", F.lit(0)).cast("long"))


def forward_fill(rows: DataFrame, key: str, order: list[str], value: Column, to: str) -> DataFrame:
    """``rows`` with the last non-null ``value`` so far within ``key``."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(to, F.last(value, ignorenulls=True).over(w))


def fill_country(observations: DataFrame, boxes: DataFrame, cell: float = 10.0) -> DataFrame:
    """Missing countries filled from the smallest bounding box (country, lat0, lat1, lon0, lon1) around the place.

    Boxes are cut into cells of ``cell`` degrees, so that the range join is an equality join on the cell.
    """
    step = lambda a, b: F.sequence(F.floor(F.col(a) / cell).cast("int"), F.floor(F.col(b) / cell).cast("int"))
    grid = boxes.withColumn("cy", F.explode(step("lat0", "lat1"))).withColumn("cx", F.explode(step("lon0", "lon1"))).withColumnRenamed("country", "box")
    open_ = observations.filter("country is null").withColumn("cy", F.floor(F.col("lat") / cell).cast("int")).withColumn("cx", F.floor(F.col("lon") / cell).cast("int"))
    hit = open_.join(grid, ["cy", "cx"]).filter("lat between lat0 and lat1 and lon between lon0 and lon1")
    best = hit.groupBy("obs_key").agg(F.min_by("box", F.struct((F.col("lat1") - F.col("lat0")) * (F.col("lon1") - F.col("lon0")), "box")).alias("box"))
    return observations.join(best, "obs_key", "left").withColumn("country", F.coalesce("country", "box")).drop("box")


def review_queue(observations: DataFrame) -> DataFrame:
    """The observations that wait for a review."""
    return observations.filter(F.col("status") == "review")


def review_decisions(observations: DataFrame, decisions: DataFrame) -> DataFrame:
    """Observations (obs_key, status, photos, note) after decisions (obs_key, decision, reason).

    ``ok`` makes them public, with photos as .webp; ``reject`` marks them and adds the reason to the note on a new line;
    others leave them as they are. ``in_public`` tells which are listed afterwards.
    """
    rows = observations.join(decisions, "obs_key", "left")
    ok, no = F.col("decision").eqNullSafe("ok"), F.col("decision").eqNullSafe("reject")
    photos = F.when(ok, F.transform("photos", lambda p: F.regexp_replace(p, r"\.[^./]+$", ".webp"))).otherwise(F.col("photos"))
    note = F.when(no, F.concat_ws("\n", F.nullif(F.col("note"), F.lit("")), F.col("reason"))).otherwise(F.col("note"))
    status = F.when(ok, "public").when(no, "rejected").otherwise(F.col("status"))
    return rows.select("obs_key", status.alias("status"), photos.alias("photos"), note.alias("note"), (status == "public").alias("in_public"))


def majority_codes(lists: DataFrame, key: str, codes: str) -> DataFrame:
    """(key, codes): codes in more than half of a group's non-empty lists, else those in most of them; ascending."""
    full = lists.filter(F.size(codes) > 0)
    n = full.groupBy(key).agg(F.count("*").alias("__n"))
    counts = full.select(key, F.explode(F.array_distinct(codes)).alias("__code")).groupBy(key, "__code").agg(F.count("*").alias("__k")).join(n, key)
    most = F.max("__k").over(Window.partitionBy(key))
    strict = F.col("__k") * 2 > F.col("__n")
    any_strict = F.max(strict.cast("int")).over(Window.partitionBy(key)) == 1
    kept = counts.withColumn("__keep", F.when(any_strict, strict).otherwise(F.col("__k") == most)).filter("__keep")
    return kept.groupBy(key).agg(F.sort_array(F.collect_list("__code")).alias("codes"))


def group_median_int(value: str) -> Column:
    """The median as a whole number, halves to even."""
    return F.bround(F.median(value)).cast("int")


def sister_items(items: DataFrame, limit: int = 5) -> DataFrame:
    """(item_id, sister_id, n): for each item (item_id, name) the first ``limit`` others, by id, with the same first word and another name.

    Only the first ``limit`` + most-repeated-name rows of a group can be anyone's sisters: each item looks at its group's
    first ``limit`` rows with each of the two smallest-id names, not at the whole group.
    """
    rows = items.withColumn("genus", F.substring_index("name", " ", 1))
    in_name = F.row_number().over(Window.partitionBy("genus", "name").orderBy("item_id"))
    few = rows.withColumn("r", in_name).filter(F.col("r") <= limit)
    # leaving out any one name, the first limit rows are among the first 2 x limit
    w = Window.partitionBy("genus").orderBy("item_id")
    few = few.withColumn("place", F.row_number().over(w))
    heads = few.filter(F.col("place") <= limit).select("genus", F.col("name").alias("head")).distinct()
    pool = few.filter(F.col("place") <= 2 * limit).select("genus", F.col("name").alias("sister"), F.col("item_id").alias("sister_id"), "place")
    # names that stand among a group's first rows get their own list; all other names share the group's first rows
    special = heads.join(pool, "genus").filter("sister <> head").withColumn("n", F.row_number().over(Window.partitionBy("genus", "head").orderBy("sister_id"))).filter(F.col("n") <= limit)
    common = pool.filter(F.col("place") <= limit).withColumn("n", F.col("place"))
    named = rows.join(heads.select("genus", F.col("head").alias("name"), F.lit(1).alias("h")), ["genus", "name"], "left")
    a = named.filter("h is not null").join(special.select("genus", F.col("head").alias("name"), "sister_id", "n"), ["genus", "name"]).select("item_id", "sister_id", "n")
    b = named.filter("h is null").join(common.select("genus", "sister_id", "n"), "genus").select("item_id", "sister_id", "n")
    return a.unionByName(b).select("item_id", "sister_id", F.col("n").cast("int").alias("n"))


def fill_from_group(items: DataFrame, sisters: DataFrame, traits: DataFrame) -> DataFrame:
    """Traits (item_id, name, codes, low, high) with gaps filled from sisters: codes by majority, bounds by medians.

    ``sisters`` is (item_id, sister_id, n). Codes fill where they are empty; the bounds where low is missing and some
    sister has either. ``note`` names the first four sisters where anything was filled.
    """
    s = sisters.join(traits.select(F.col("item_id").alias("sister_id"), F.col("name").alias("sister"), "codes", "low", "high"), "sister_id")
    codes = majority_codes(s, "item_id", "codes").withColumnRenamed("codes", "group_codes")
    bounds = s.groupBy("item_id").agg(group_median_int("low").alias("group_low"), group_median_int("high").alias("group_high"), F.array_join(F.slice(F.transform(F.sort_array(F.collect_list(F.struct("n", "sister"))), lambda x: x["sister"]), 1, 4), ", ").alias("names"))
    out = traits.join(bounds, "item_id", "left").join(codes, "item_id", "left")
    no_codes = (F.size(F.coalesce("codes", F.array().cast("array<int>"))) == 0) & F.col("group_codes").isNotNull()
    no_bounds = F.col("low").isNull() & F.col("group_low").isNotNull() & F.col("group_high").isNotNull()
    return out.select(
        "item_id", "name", F.when(no_codes, F.col("group_codes")).otherwise(F.col("codes")).alias("codes"),
        F.when(no_bounds, F.col("group_low")).otherwise(F.col("low")).alias("low"), F.when(no_bounds, F.col("group_high")).otherwise(F.col("high")).alias("high"),
        F.when(no_codes | no_bounds, F.concat(F.lit("median/majority of "), F.col("names"))).alias("note"),
    )
