"""Checklist lookup, resolution over several sources, and collection of vernacular names."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalens.functions.strings import NAME_LINES, display_name, first_given, given, is_latinish, labelled_line, normalize_name, normalize_vernacular, spaced, split_cited_names, url_language, url_title
from catalens.operators.numbering import numbered

STRINGS = "array<string>"


def best_name_row(names: DataFrame, key: str = "norm") -> DataFrame:
    """Of the checklist rows with one normalised name the best: accepted before synonym before others, then species, then the smallest id."""
    status, rank = F.lower("status"), F.lower("rank")
    score = F.when(status == "accepted", 2).when(status == "synonym", 1).otherwise(0)
    w = Window.partitionBy(key).orderBy(score.desc(), (rank == "species").cast("int").desc(), "name_id")
    return names.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def resolve_accepted_name(queries: DataFrame, names: DataFrame) -> DataFrame:
    """(query, hit_id, name_id): each query's best row by normalised name, and the accepted row one hop on.

    ``names`` is (name_id, name, status, rank, accepted_id). A row that is accepted, has no accepted id or its own, or
    one that isn't in the list, stands for itself. Queries without a hit give no row.
    """
    keyed = names.withColumn("norm", normalize_name(F.col("name")))
    asked = queries.select("query", normalize_name(F.col("query")).alias("norm"))
    hits = asked.join(best_name_row(keyed.join(asked.select("norm").distinct(), "norm", "left_semi")), "norm")
    own = (F.lower("status") == "accepted") | F.col("accepted_id").isNull() | (F.col("accepted_id") == F.col("name_id"))
    hits = hits.select("query", F.col("name_id").alias("hit_id"), F.when(F.coalesce(own, F.lit(False)), F.col("name_id")).otherwise(F.col("accepted_id")).alias("want"))
    known = names.select(F.col("name_id").alias("want"), F.lit(True).alias("known")).distinct()
    return hits.join(known, "want", "left").select("query", "hit_id", F.when(F.col("known"), F.col("want")).otherwise(F.col("hit_id")).alias("name_id"))


def synonym_list(names: DataFrame) -> DataFrame:
    """(name_id, synonyms): names that are synonyms of an accepted one, ordered by id."""
    rows = names.filter((F.lower("status") == "synonym") & (F.col("accepted_id") != F.col("name_id")))
    return rows.groupBy(F.col("accepted_id").alias("name_id")).agg(F.transform(F.sort_array(F.collect_list(F.struct(F.col("name_id").alias("id"), "name"))), lambda s: s["name"]).alias("synonyms"))


def distribution_sets(distribution: DataFrame, include_introduced: bool = True) -> DataFrame:
    """(name_id, l2, l3, native_l2, introduced_l2): without extinct and doubtful areas; l2 distinct and ascending, l3 in order of ``pos``, native first."""
    rows = distribution.filter("not extinct and not doubtful")
    l2 = lambda when: F.sort_array(F.collect_set(F.when(when, F.col("l2"))))
    l3 = lambda when: F.transform(F.sort_array(F.collect_list(F.when(when & (F.coalesce("l3", F.lit("")) != ""), F.struct("pos", "l3")))), lambda s: s["l3"])
    native, introduced = ~F.col("introduced"), F.col("introduced")
    out = rows.groupBy("name_id").agg(l2(native).alias("native_l2"), l2(introduced).alias("introduced_l2"), l3(native).alias("native_l3"), l3(introduced).alias("introduced_l3"))
    if include_introduced:
        return out.select("name_id", region_union("native_l2", "introduced_l2").alias("l2"), F.concat("native_l3", "introduced_l3").alias("l3"), "native_l2", "introduced_l2")
    return out.select("name_id", F.col("native_l2").alias("l2"), F.col("native_l3").alias("l3"), "native_l2", "introduced_l2")


def region_union(a: str, b: str):
    return F.sort_array(F.array_union(a, b))


def checklist_lookup(queries: DataFrame, names: DataFrame, distribution: DataFrame, include_introduced: bool = True) -> DataFrame:
    """Resolved queries with the accepted row's name, distribution sets (empty without) and synonyms."""
    found = resolve_accepted_name(queries, names).join(names.select("name_id", F.col("name").alias("accepted_name")).dropDuplicates(["name_id"]), "name_id")
    out = found.join(distribution_sets(distribution, include_introduced), "name_id", "left").join(synonym_list(names), "name_id", "left")
    none = F.array().cast("array<int>")
    return out.select("query", "hit_id", "name_id", "accepted_name", *[F.coalesce(c, none).alias(c) for c in ("l2", "native_l2", "introduced_l2")], F.coalesce("l3", F.array().cast(STRINGS)).alias("l3"), F.coalesce("synonyms", F.array().cast(STRINGS)).alias("synonyms"))


def region_rollup(values: DataFrame, regions: DataFrame) -> DataFrame:
    """(item_id, l2): codes or names of small regions mapped to distinct ascending larger ones.

    ``values`` is (item_id, value), ``regions`` (code, name, l2), a fixed list of some hundred rows. A value is tried as a
    code in upper case, then by its first 20 characters, then by those in lower case; unknown ones are skipped.
    """
    key = F.trim("value")
    code = regions.select(F.upper("code").alias("k1"), F.col("l2").alias("by_code")).dropDuplicates(["k1"])
    name = regions.select(F.substring("name", 1, 20).alias("k2"), F.col("l2").alias("by_name")).dropDuplicates(["k2"])
    low = regions.select(F.lower(F.substring("name", 1, 20)).alias("k3"), F.col("l2").alias("by_low")).dropDuplicates(["k3"])
    rows = values.withColumn("k1", F.upper(key)).withColumn("k2", F.substring(key, 1, 20)).withColumn("k3", F.lower(F.substring(key, 1, 20)))
    rows = rows.join(F.broadcast(code), "k1", "left").join(F.broadcast(name), "k2", "left").join(F.broadcast(low), "k3", "left")
    return rows.groupBy("item_id").agg(F.sort_array(F.collect_set(F.coalesce("by_code", "by_name", "by_low"))).alias("l2"))


def id_override(rows: DataFrame, overrides: DataFrame, column: str) -> DataFrame:
    """``column`` replaced where ``overrides`` (old_id, new_id) has it; null stays."""
    return rows.join(overrides.select(F.col("old_id").alias(column), "new_id"), column, "left").withColumn(column, F.coalesce("new_id", column)).drop("new_id")


def resolve_entities(queries: DataFrame, checklist: DataFrame, entity: DataFrame, match: DataFrame, index: DataFrame) -> DataFrame:
    """One row per name from four sources keyed by name, each field from the first source that gives it.

    checklist (name, family, genus, author, ipni_id, l2), entity (name, ipni_id, gbif_id, qid), match (name, family,
    genus, ord, usage_key), index (name, author, ipni_id). Empty strings count as missing. Warnings name sources without
    a row, an empty distribution, no id and no order.
    """
    side = lambda t, p: t.select("name", F.lit(True).alias(f"{p}_ok"), *[F.col(c).alias(f"{p}_{c}") for c in t.columns if c != "name"])
    r = queries.select("name").join(side(checklist, "c"), "name", "left").join(side(entity, "e"), "name", "left").join(side(match, "m"), "name", "left").join(side(index, "i"), "name", "left")
    c = lambda n: F.col(n)
    order = F.coalesce(given(c("m_ord")), F.lit(""))
    warnings = F.array_compact(
        F.array(
            F.when(c("c_ok").isNull(), "checklist: name not found").when(F.size(F.coalesce("c_l2", F.array().cast("array<int>"))) == 0, "checklist: empty distribution"),
            F.when(c("e_ok").isNull(), "entity: none"),
            F.when(c("m_ok").isNull(), "match: none"),
            F.when(c("i_ok").isNull() & given(c("c_ipni_id")).isNull(), "index: no id"),
            F.when(order == "", "order unknown"),
        )
    )
    return r.select(
        "name", F.coalesce(first_given(c("c_family"), c("m_family")), F.lit("")).alias("family"), order.alias("ord"),
        first_given(c("c_genus"), c("m_genus"), F.substring_index("name", " ", 1)).alias("genus"), F.coalesce(first_given(c("c_author"), c("i_author")), F.lit("")).alias("author"),
        F.coalesce(first_given(c("c_ipni_id"), c("i_ipni_id"), c("e_ipni_id")), F.lit("")).alias("ipni_id"), first_given(c("e_gbif_id"), c("m_usage_key").cast("string")).alias("gbif_id"), given(c("e_qid")).alias("qid"),
        F.array_join(warnings, "; ").alias("warnings"),
    )


def taxon_spine(rows: DataFrame, spines: DataFrame) -> DataFrame:
    """``rows`` (…, ord, family, genus) with ``path``: (step, rank, taxon) from genus upwards.

    ``spines`` is (ord, ranks, taxa), the ranks and taxa of an order from the root down, joined by slashes: a fixed table
    of some dozen orders. An order that isn't in it adds itself alone.
    """
    s = rows.join(F.broadcast(spines), "ord", "left")
    up = lambda c: F.reverse(F.split(F.col(c), "/"))
    pair = lambda r, t: F.struct(r.cast("string").alias("rank"), t.cast("string").alias("taxon"))
    none = F.array().cast("array<struct<rank:string,taxon:string>>")
    spine = F.when(F.col("ranks").isNotNull(), F.zip_with(up("ranks"), up("taxa"), pair)).when(F.coalesce("ord", F.lit("")) != "", F.array(pair(F.lit("Ordo"), F.col("ord")))).otherwise(none)
    low = F.concat(F.array(pair(F.lit("Genus"), F.col("genus"))), F.when(F.coalesce("family", F.lit("")) != "", F.array(pair(F.lit("Familia"), F.col("family")))).otherwise(none))
    steps = F.transform(F.concat(low, spine), lambda x, i: F.concat(F.lpad(i.cast("string"), 2, "0"), F.lit("_"), x["rank"], F.lit("="), x["taxon"]))
    return s.withColumn("path", steps).drop("ranks", "taxa")


def already_in_catalog(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """``rows`` (name) with item_id and known: the first id of a known name, else the next ids behind the catalog's count, in order of name.

    New names are numbered by ranges of names of like size, whatever prefix they share.
    """
    first = catalog.groupBy("name").agg(F.min("item_id").alias("item_id"))
    joined = rows.join(first, "name", "left")
    fresh = numbered(joined.filter("item_id is null").select("name").distinct(), "name", to="new_id", base=catalog.count())
    return joined.join(fresh, "name", "left").select("name", F.coalesce("item_id", "new_id").cast("long").alias("item_id"), F.col("item_id").isNotNull().alias("known"))


# ---- vernacular names


def entity_names(entities: DataFrame) -> DataFrame:
    """Name rows (item_id, src, pos, lang, name, source) of entities: labels, then aliases, then page titles of URLs, in order of language.

    Items are dealt to as many tasks as a shuffle has before they become rows, and stay there for all that groups by item.
    """
    entities = entities.repartition(int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions")), "item_id")
    none = F.array().cast("array<struct<lang:string,name:string,source:string>>")
    rows = lambda m, f: F.coalesce(F.flatten(F.transform(F.sort_array(F.map_entries(m)), f)), none)
    one = lambda lang, name, source: F.struct(lang.alias("lang"), name.alias("name"), F.lit(source).alias("source"))
    labels = rows("labels", lambda e: F.array(one(e["key"], e["value"], "entity")))
    aliases = rows("aliases", lambda e: F.transform(e["value"], lambda v: one(e["key"], v, "entity")))
    titles = rows("wikipedia", lambda e: F.array(one(url_language(e["value"]), url_title(e["value"]), "title")))
    return entities.select("item_id", "latin", "synonyms", F.lit(1).alias("src"), F.posexplode(F.concat(labels, aliases, titles)).alias("pos", "n")).select("item_id", "latin", "synonyms", "src", "pos", "n.*")


def page_names(pages: DataFrame) -> DataFrame:
    """Name rows of page texts (item_id, latin, synonyms, text): lines that a marker opens list names of its language."""
    named = lambda lang: lambda n: F.struct(F.lit(lang).alias("lang"), n.alias("name"), F.lit("page").alias("source"))
    parts = [F.transform(split_cited_names(labelled_line(F.col("text"), marker)), named(lang)) for marker, lang in NAME_LINES]
    return pages.select("item_id", "latin", "synonyms", F.lit(2).alias("src"), F.posexplode(F.concat(*parts)).alias("pos", "n")).select("item_id", "latin", "synonyms", "src", "pos", "n.*")


def name_collection(rows: DataFrame) -> DataFrame:
    """(item_id, lang, n, name, source): of each language's names the first by source order for a normalised one; scientific names are dropped."""
    clean = rows.filter(F.col("lang").isNotNull() & (F.col("lang") != "") & ~is_latinish(F.col("name"), F.col("latin"), F.col("synonyms"))).withColumn("name", spaced(F.col("name"))).withColumn("norm", normalize_vernacular(F.col("name")))
    firsts = clean.groupBy("item_id", "lang", "norm").agg(F.min(F.struct("src", "pos", "name", "source")).alias("f"))
    return firsts.select("item_id", "lang", "f.*").withColumn("n", F.row_number().over(Window.partitionBy("item_id", "lang").orderBy("src", "pos"))).select("item_id", "lang", "n", "name", "source")


def translations_from_names(collected: DataFrame) -> DataFrame:
    """(item_id, lang, label, names): names as displayed, distinct in order; the first is the label."""
    shown = collected.select("item_id", "lang", "n", display_name(F.col("name"), F.col("lang")).alias("name"))
    every = shown.groupBy("item_id", "lang").agg(F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct("n", "name"))), lambda s: s["name"])).alias("all"))
    return every.select("item_id", "lang", F.element_at("all", 1).alias("label"), F.slice("all", F.lit(2), F.size("all")).alias("names"))


def merge_names_into_translations(translations: DataFrame, found: DataFrame) -> DataFrame:
    """Translations (item_id, lang, latin, label, names) with found names (item_id, lang, label, names) merged in.

    A label stays unless it is empty or the scientific name; names not yet there, compared normalised, are added.
    """
    f = found.select("item_id", "lang", F.concat(F.array("label"), "names").alias("found"))
    both = translations.join(f, ["item_id", "lang"], "full")
    none = F.array().cast(STRINGS)
    keep = (F.coalesce("label", F.lit("")) != "") & ~is_latinish(F.col("label"), F.col("latin"), none)
    label = F.when(keep | F.col("found").isNull(), F.col("label")).otherwise(F.element_at("found", 1))
    old = F.coalesce("names", none)
    both = both.withColumn("label", label).withColumn("have", F.concat(F.array(normalize_vernacular(F.col("label"))), F.transform(old, normalize_vernacular)))
    more = F.filter(F.coalesce("found", none), lambda n: ~F.array_contains(F.col("have"), normalize_vernacular(n)))
    return both.select("item_id", "lang", "label", F.concat(old, more).alias("names"))


def unsourced_names(translations: DataFrame, sourced: DataFrame) -> DataFrame:
    """(item_id, lang, value): labels and names that no source of that language gave and that aren't the scientific name; machine languages (-GT) are skipped."""
    values = translations.filter("not endswith(lang, '-GT')").select("item_id", "lang", "latin", F.explode(F.concat(F.array("label"), F.coalesce("names", F.array().cast(STRINGS)))).alias("value")).filter(F.coalesce("value", F.lit("")) != "")
    values = values.withColumn("norm", normalize_vernacular(F.col("value"))).filter(F.col("norm") != normalize_vernacular(F.col("latin")))
    return values.join(sourced.select("item_id", "lang", normalize_vernacular(F.col("name")).alias("norm")).distinct(), ["item_id", "lang", "norm"], "left_anti").select("item_id", "lang", "value")


def append_to_named_list(lists: DataFrame, name: str, item_id: int) -> tuple[DataFrame, DataFrame]:
    """Lists (lang, name, ids) with an id added to those of a name, trimmed and in any case; and the languages without one."""
    hit = F.lower(F.trim("name")) == name.strip().lower()
    out = lists.withColumn("ids", F.when(hit, F.array_union("ids", F.array(F.lit(item_id).cast("long")))).otherwise(F.col("ids")))
    return out, lists.groupBy("lang").agg(F.max(hit.cast("int")).alias("h")).filter("h = 0").select("lang")
