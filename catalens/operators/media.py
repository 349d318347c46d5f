"""Media candidates: licences, filters, roles, scores and the choice of a gallery."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalens.functions.strings import normalize_latin

# ---- fixed values

ALLOWED_LICENSES = ("cc by", "cc-by", "cc0", "public domain", "pd", "pdm", "no restrictions")
DENIED_LICENSES = ("nc", "nd", "fair use", "nonfree", "non-free")
ALLOWED_MIMES = ("image/jpeg", "image/png", "image/webp", "image/tiff")
REJECTED = (
    "herbarium", "specimen", "range map", "distribution map", "microscopic", "stomata", "epidermis", "pollen", "chromosome", "illustration", "engraving", "woodcut",
    "lithograph", "drawing of", "diagram", "logo", "coat of arms", "svg", "map of", "cultivar", "low quality",
)
SKIPPED_CATEGORIES = (
    "cultivar", "herbarium", "specimen", "range map", "maps", "illustration", "in art", "microscopic", "pollen", "low quality", "diseases", "animals with", "people with",
    "by country", "by month", "(text)", "quality images", "places named", "seedling", "non-native",
)
CATEGORY_ROLES = (("trunk", ("bark", "trunk", "bole")), ("flower", ("flower", "inflorescence", "blossom")), ("leaf", ("leaf", "leaves", "foliage")), ("fruit", ("fruit", "seed")), ("habit", ("habitat", "(habit)")))
ROLES = ("flower", "leaf", "fruit", "habit", "trunk", "flower_detail")
ROLE_WORDS = (
    ("flower_detail", ("detail", "throat", "labellum", "close-up", "closeup", "macro", "dissect", "floret")),
    ("flower", ("flower", "flowers", "blossom", "bloom", "inflorescence", "capitulum", "raceme", "spike", "umbel", "cyme", "panicle", "head")),
    ("fruit", ("fruit", "fruits", "berry", "berries", "capsule", "achene", "pod", "seed")), ("leaf", ("leaf", "leaves", "foliage", "frond")),
    ("trunk", ("trunk", "bark", "bole", "stem bark")), ("habit", ("habit", "whole plant", "in situ", "growth habit")),
)
PLATE_BOOKS = ("curtis", "engl. bot", "fl. dan", "flora dan", "engl bot", "sv. bot", "fl. bat", "kerner")
MIN_SIDE, MIN_PHOTOS, MAX_PHOTOS = 400, 3, 5


def _any(x: Column, tokens) -> Column:
    """Whether ``x`` holds any token: one pattern, as a test for each would work out ``x`` as often when it is pushed below what makes it."""
    return x.rlike("|".join(map(re.escape, tokens)))


def _low(name: str) -> Column:
    return F.lower(F.coalesce(F.col(name), F.lit("")))


def license_ok(name: Column) -> Column:
    """Free for any use by its short name. Denied tokens count wherever they stand, even inside words."""
    t = F.translate(F.lower(F.trim(F.coalesce(name, F.lit("")))), "_", " ")
    return (t != "") & ~_any(t, DENIED_LICENSES) & _any(t, ALLOWED_LICENSES)


def license_ok_url(url: Column) -> Column:
    t = F.lower(F.coalesce(url, F.lit("")))
    denied = t.contains("by-nc") | t.contains("by-nd") | t.contains("/nc/")
    return ~denied & (t.contains("publicdomain") | t.contains("/zero/") | t.contains("cc0") | t.contains("creativecommons.org/licenses/by"))


def rejected_title(title: Column, description: Column) -> Column:
    """A title with a quote, or words for what is no photo in title or description."""
    t = F.coalesce(title, F.lit(""))
    blob = F.lower(F.concat(t, F.lit(" "), F.coalesce(description, F.lit(""))))
    return t.contains("'") | blob.contains("‘") | _any(blob, REJECTED)


def media_usable() -> Column:
    """Over (license, mime, url, width, height, title, description)."""
    side = F.least(F.coalesce("width", F.lit(0)), F.coalesce("height", F.lit(0)))
    return license_ok(F.col("license")) & F.coalesce(F.col("mime").isin(*ALLOWED_MIMES), F.lit(False)) & (F.coalesce("url", F.lit("")) != "") & (side >= MIN_SIDE) & ~rejected_title(F.col("title"), F.col("description"))


def species_gate(latin: Column) -> Column:
    """The scientific name, letters only, stands in title, categories, object name and description."""
    wanted = normalize_latin(latin)
    return (wanted != "") & normalize_latin(F.concat_ws(" ", "title", "categories", "object_name", "description")).contains(wanted)


def category_role(title: Column) -> Column:
    """The first role whose hints a category's title holds; none for categories to skip."""
    t = F.lower(title)
    role = F.when(_any(t, SKIPPED_CATEGORIES), F.lit(None).cast("string"))
    for name, hints in CATEGORY_ROLES:
        role = role.when(_any(t, hints), name)
    return role


def media_score(latin: Column) -> Column:
    """5 for the name in the title, up to 3 for width, 1 for JPEG, 2 for a role."""
    w = F.coalesce("width", F.lit(0))
    wide = F.when(w >= 2000, 3).when(w >= 1000, 2).when(w >= 600, 1).otherwise(0)
    return F.when(_low("title").contains(F.lower(latin)), 5).otherwise(0) + wide + F.when(_low("mime").contains("jpeg"), 1).otherwise(0) + F.when(F.coalesce("role_hint", F.lit("")) != "", 2).otherwise(0)


def media_collect(candidates: DataFrame, latin: str = "latin") -> DataFrame:
    """Usable candidates of the right species, one per (item_id, title): the first by (step, pos) of those usable; scored.

    Steps are the role categories (0), the main category (1), searches for one role (2) and for the name (3). A search for
    a role counts only if no category gave that role, one for the name only if nothing else was found. An item's
    candidates are dealt to one task once and judged there by windows, so they are read and tested once.
    """
    ok = candidates.filter((F.coalesce("title", F.lit("")) != "") & media_usable() & species_gate(F.col(latin))).withColumn("score", media_score(F.col(latin)))
    titled = Window.partitionBy("item_id", "title")
    rows = ok.repartition("item_id").withColumn("__first", F.row_number().over(titled.orderBy("step", "pos")) == 1)
    given = F.max(F.col("__first") & (F.col("step") < 2)).over(Window.partitionBy("item_id", "role_hint"))
    rows = rows.withColumn("__given", given)
    of_category = F.col("__first") & (F.col("step") < 2)
    may = of_category | ((F.col("step") == 2) & (F.col("role_hint").isNull() | ~F.col("__given")))
    rows = rows.withColumn("__may", may)
    best = F.row_number().over(titled.orderBy(F.desc("__may"), F.desc(F.col("step") == 3), "step", "pos")) == 1
    rows = rows.withColumn("__best", best).withColumn("__found", F.max("__may").over(Window.partitionBy("item_id")))
    kept = F.col("__best") & F.when(F.col("__found"), F.col("__may")).otherwise(F.col("step") == 3)
    return rows.filter(kept).select(*ok.columns)


def classify() -> Column:
    """A file's role: its hint, else its numbered file name, else the first role whose words stand in its texts."""
    name = F.substring_index(F.coalesce(F.nullif(F.col("path"), F.lit("")), "title", F.lit("")), "/", -1)
    numbered = F.lower(F.regexp_extract(name, r"(?i)^\d+-(flower_detail|flower|leaf|fruit|habit|trunk)\b", 1))
    blob = F.lower(F.concat_ws(" ", "title", "description", "object_name", "categories", "path"))
    role = F.when(F.coalesce(F.col("role_hint").isin(*ROLES), F.lit(False)), F.col("role_hint")).when(numbered != "", numbered)
    for r, words in ROLE_WORDS:
        role = role.when(blob.rlike(r"\b(" + "|".join(map(re.escape, words)) + r")\b"), r)
    return role


def media_pack(files: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, photos, status, reason): 3 to 5 files in fixed order of roles from files (item_id, pos, file, ...) and items (item_id, lifeform, codes).

    The best flower (or detail) comes first; without one the item is to be reviewed. Then leaf, fruit and habit, a trunk
    of woody items, a detail, and a second flower to reach three.
    """
    rows = files.select("item_id", "pos", "file", "score", classify().alias("role"))
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("item_id", "role").orderBy(F.desc(F.coalesce("score", F.lit(0))), "pos"))).filter("r <= 2 and role is not null")
    top = lambda role, r=1: F.max(F.when((F.col("role") == role) & (F.col("r") == r), F.col("file")))
    best = ranked.groupBy("item_id").agg(*[top(r).alias(r) for r in ROLES], top("flower", 2).alias("second"))
    woody = _low("lifeform").rlike("tree|shrub|woody") | F.array_contains(F.coalesce("codes", F.array().cast("array<int>")), 6)
    b = items.withColumn("woody", woody).select("item_id", "woody").join(best, "item_id", "left")
    first = F.coalesce("flower", "flower_detail")
    some = lambda *cs: F.array_compact(F.array(*cs))
    slot = lambda role, c: F.when(c.isNotNull(), F.concat(F.lit(role + "="), c))
    four = some(slot("flower", first), *[slot(r, F.col(r)) for r in ("leaf", "fruit", "habit")])
    four = F.concat(four, some(F.when(F.col("woody"), slot("trunk", F.col("trunk")))))
    detail = F.when((F.size(four) < MAX_PHOTOS) & F.col("flower").isNotNull(), slot("flower_detail", F.col("flower_detail")))
    five = F.concat(four, some(detail))
    six = F.concat(five, some(F.when(F.size(five) < MIN_PHOTOS, slot("flower", F.col("second")))))
    n = F.size(six)
    photos = F.when(first.isNull(), F.array().cast("array<string>")).otherwise(F.slice(six, 1, MAX_PHOTOS))
    reason = F.when(first.isNull(), "no flower or inflorescence photo").when(n < MIN_PHOTOS, f"fewer than {MIN_PHOTOS} usable photos").otherwise("")
    return b.select("item_id", photos.alias("photos"), F.when(reason == "", "ok").otherwise("needs_review").alias("status"), reason.alias("reason"))


def media_fallback_union(first: DataFrame, second: DataFrame, packed: DataFrame, latin: str = "latin") -> DataFrame:
    """``first``, and for items whose pack isn't ok the files of ``second`` with another URL and of the right species."""
    short = packed.filter("status <> 'ok'").select("item_id")
    more = second.join(short, "item_id", "left_semi").filter(species_gate(F.col(latin))).dropDuplicates(["item_id", "url"]).join(first.select("item_id", "url"), ["item_id", "url"], "left_anti")
    return first.unionByName(more.select(*first.columns))


def plate_score(title: Column) -> Column:
    """How likely a plate is a clean colour plate, by words of its title."""
    t, raw = F.lower(F.coalesce(title, F.lit(""))), F.coalesce(title, F.lit(""))
    points = lambda c, n: F.when(c, n).otherwise(0)
    books = reduce(Column.__add__, [points(t.contains(b), 4) for b in PLATE_BOOKS])
    return points(_any(t, ("color", "colour", "hand-col", "painted")), 3) + books + points(_any(t, ("woodblock", "woodcut", "fig.", "t. ")), 1) - points(raw.contains("[") & raw.contains("]"), 2) - points(_any(t, ("outline", "analytic", "fruct. sem")), 2)


def plate_author(title: Column) -> Column:
    """Behind the first `` / ``, up to a comma."""
    rest = F.element_at(F.split(F.concat(F.coalesce(title, F.lit("")), F.lit(" / ")), " / ", 3), 2)
    return F.trim(F.substring_index(F.trim(rest), ",", 1))


def plate_rank(plates: DataFrame) -> DataFrame:
    """Plates (item_id, plate_id, title) with author, score and place: best first, then by id."""
    p = plates.withColumn("author", plate_author(F.col("title"))).withColumn("score", plate_score(F.col("title")))
    return p.withColumn("n", F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "plate_id")))


def pick_first(rows: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """One row of each key, the first in order."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("__n = 1").drop("__n")


def taxon_hit_pick(hits: DataFrame) -> DataFrame:
    """Of (query, pos, label, description) hits one: exact labels if there are any, of those the first described as a species, plant or taxon, else the first."""
    exact = F.lower(F.trim("label")) == F.lower(F.trim("query"))
    return pick_first(hits, "query", F.desc(exact.cast("int")), F.desc(_low("description").rlike("species|plant|taxon").cast("int")), "pos")


def id_hit_pick(hits: DataFrame) -> DataFrame:
    """Of (query, pos, name, in_powo) hits one: exact names if there are any, of those the first flagged, else the first."""
    exact = F.lower(F.trim("name")) == F.lower(F.trim("query"))
    return pick_first(hits, "query", F.desc(exact.cast("int")), F.desc(F.coalesce("in_powo", F.lit(False)).cast("int")), "pos")


def exact_hit_pick(hits: DataFrame) -> DataFrame:
    """Of (query, pos, name, kind, scientific, code, preferred) hits the first exact plant name with a code, preferred ones before others; none without."""
    ok = (F.lower("kind") == "plant") & ~F.col("scientific").eqNullSafe(F.lit(False)) & (F.coalesce("code", F.lit("")) != "") & (F.lower(F.trim("name")) == F.lower(F.trim("query")))
    return pick_first(hits.filter(ok), "query", F.desc(F.coalesce("preferred", F.lit(False)).cast("int")), "pos")


def species_hit_rank(hits: DataFrame) -> DataFrame:
    """Of (query, species_id, label, plates) hits the one with most plates, then the smallest id."""
    return pick_first(hits, "query", F.desc("plates"), "species_id")
