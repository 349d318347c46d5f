"""Name search indexes: by language, by scientific name, by taxon and picture."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.functions.strings import illegal_key

#: Ranks of taxa that the picture search knows (fixed values).
PHOTO_RANKS = ("Ordo", "Genus", "Familia", "Subfamilia", "Subgenus", "Tribus", "Subtribus", "Sectio", "Subsectio", "Serie", "Subserie")


def name_hits(translations: DataFrame) -> DataFrame:
    """(lang, pos, hit_pos, item_id, name, is_label) from (lang, pos, item_id, label, names); the label comes first, empty names don't count."""
    label = F.when(F.coalesce("label", F.lit("")) != "", F.array(F.struct(F.lit(0).alias("hit_pos"), F.col("label").alias("name"), F.lit(True).alias("is_label"))))
    names = F.transform(F.coalesce("names", F.array().cast("array<string>")), lambda n, i: F.struct((i + 1).alias("hit_pos"), n.alias("name"), F.lit(False).alias("is_label")))
    none = F.array().cast("array<struct<hit_pos:int,name:string,is_label:boolean>>")
    hits = translations.select("lang", "pos", "item_id", F.explode(F.concat(F.coalesce(label, none), names)).alias("h")).select("lang", "pos", "item_id", "h.*")
    return hits.filter(F.coalesce("name", F.lit("")) != "")


def search_index(hits: DataFrame) -> DataFrame:
    """(lang, name, is_label, ids): per lower-case name the distinct items; is_label as the first hit in order had it. Illegal keys are left out."""
    keyed = hits.withColumn("name", F.lower("name")).filter(~illegal_key(F.col("name")))
    return keyed.groupBy("lang", "name").agg(F.min_by("is_label", F.struct("pos", "hit_pos")).alias("is_label"), F.sort_array(F.collect_set("item_id")).alias("ids"))


def search_warnings(hits: DataFrame) -> DataFrame:
    """(lang, item_id, name): hits whose key is illegal."""
    return hits.withColumn("name", F.lower("name")).filter(illegal_key(F.col("name"))).select("lang", "item_id", "name")


def catalog_translations(translations: DataFrame, catalog: DataFrame) -> DataFrame:
    """Translations (keyed by name) of items in ``catalog`` (item_id, name), with their id; of items with one name the last id counts."""
    ids = catalog.groupBy("name").agg(F.max("item_id").alias("item_id"))
    return translations.join(ids, "name")


def latin_hits(catalog: DataFrame, details: DataFrame) -> DataFrame:
    """Hits of scientific names: the detail's own name before the catalog's, then synonyms in order; those with a dot are skipped.

    An empty synonym stays in, to be warned of: it is no key.
    """
    rows = catalog.join(details.select("name", F.col("detail_name"), "synonyms"), "name", "left")
    label = F.struct(F.lit(0).alias("hit_pos"), F.coalesce(F.nullif(F.col("detail_name"), F.lit("")), F.col("name")).alias("name"), F.lit(True).alias("is_label"))
    others = F.filter(F.transform(F.coalesce("synonyms", F.array().cast("array<string>")), lambda s, i: F.struct((i + 1).alias("hit_pos"), s.alias("name"), F.lit(False).alias("is_label"))), lambda h: h["name"].isNotNull() & ~h["name"].contains("."))
    return rows.select(F.lit("la").alias("lang"), F.col("item_id").alias("pos"), "item_id", F.explode(F.concat(F.array(label), others)).alias("h")).select("lang", "pos", "item_id", "h.*")


def photo_index(items: DataFrame, taxa: DataFrame, synonyms: DataFrame) -> DataFrame:
    """(key, count, path). An item's name beats a taxon's, a taxon's beats a synonym's.

    items (item_id, name): the last id of a name counts. taxa (name, rank, count, path, seq): of kept ranks, the last by
    ``seq``, the order in which a tree walk leaves them, so an ancestor after its descendants. synonyms (item_id, pos,
    synonym, name): the first counts. Counts are whole, halves to even.
    """
    a = items.select(F.lower("name").alias("key"), F.lit(3).alias("prio"), F.col("item_id").cast("long").alias("seq"), F.lit(0).cast("long").alias("seq2"), F.lit(1).cast("long").alias("count"), F.col("name").alias("path"))
    b = taxa.filter(F.col("rank").isin(*PHOTO_RANKS)).select(F.lower("name").alias("key"), F.lit(2).alias("prio"), F.col("seq").cast("long").alias("seq"), F.lit(0).cast("long").alias("seq2"), F.bround("count").cast("long").alias("count"), "path")
    c = synonyms.filter(F.coalesce("synonym", F.lit("")) != "").select(F.lower("synonym").alias("key"), F.lit(1).alias("prio"), (-F.col("item_id")).cast("long").alias("seq"), (-F.col("pos")).cast("long").alias("seq2"), F.lit(1).cast("long").alias("count"), F.col("name").alias("path"))
    return a.unionByName(b).unionByName(c).groupBy("key").agg(F.max_by(F.struct("count", "path"), F.struct("prio", "seq", "seq2")).alias("e")).select("key", "e.count", "e.path")


def tokens(value):
    """External ids of a comma list: the text behind the last slash."""
    return F.transform(F.filter(F.split(F.coalesce(value, F.lit("")), ","), lambda t: t != ""), lambda t: F.substring_index(F.trim(t), "/", -1))


def photo_token_index(items: DataFrame, taxa: DataFrame) -> DataFrame:
    """(token, count, path) of external ids: later writers win, items (item_id, name, external) after taxa (seq, rank, count, path, external)."""
    a = taxa.filter(F.col("rank").isin(*PHOTO_RANKS)).select(F.explode(tokens(F.col("external"))).alias("token"), F.lit(0).alias("prio"), F.col("seq").cast("long").alias("seq"), F.bround("count").cast("long").alias("count"), "path")
    b = items.select(F.explode(tokens(F.col("external"))).alias("token"), F.lit(1).alias("prio"), F.col("item_id").cast("long").alias("seq"), F.lit(1).cast("long").alias("count"), F.col("name").alias("path"))
    return a.unionByName(b).groupBy("token").agg(F.max_by(F.struct("count", "path"), F.struct("prio", "seq")).alias("e")).select("token", "e.count", "e.path")


def search_name_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(lang, item_id, name, change) between two states of translations: lower-case names to add and to remove."""
    keys = lambda t, side: name_hits(t).select("lang", "item_id", F.lower("name").alias("name")).distinct().withColumn(side, F.lit(1))
    both = keys(old, "was").join(keys(new, "now"), ["lang", "item_id", "name"], "full")
    return both.filter(F.col("was").isNull() | F.col("now").isNull()).select("lang", "item_id", "name", F.when(F.col("was").isNull(), "add").otherwise("remove").alias("change"))
