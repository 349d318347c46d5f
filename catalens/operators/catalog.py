"""Catalog tables: headers, slim web entries, labels, coverage, records and their changes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalens.functions.strings import derived_url, first_given, given, illegal_key
from catalens.operators.records import family_key

#: Languages of the name search, and those that only the web interface has (fixed values).
SEARCH_LANGUAGES = ("bg", "cs", "da", "de", "en", "es", "et", "fi", "fr", "hr", "hu", "it", "ja", "ko", "lt", "lv", "nl", "no", "pl", "pt", "ro", "ru", "sk", "sl", "sr", "sv", "uk", "zh")
WEB_LANGUAGES = ("ar", "fa", "he", "hi", "pa")


def catalog_header_join(catalog: DataFrame, headers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items with a header, and warnings (item_id, name) for those without."""
    return catalog.join(headers, "item_id"), catalog.join(headers.select("item_id"), "item_id", "left_anti")


def slim_projection(details: DataFrame) -> DataFrame:
    return details.select("name", "id", F.coalesce("illustration_url", F.lit("")).alias("illustration_url"))


def web_catalog(catalog: DataFrame, headers: DataFrame, details: DataFrame) -> DataFrame:
    """(item_id, name, family, url, illustration_url, warning) for each list position with a header or a detail.

    catalog (item_id, name); headers (item_id, name, family, url); details (name, id, illustration_url). The list position
    is the id even where the detail says another, with a warning. Items without either source are left out.
    """
    h = headers.select("item_id", F.lit(True).alias("h"), F.col("name").alias("h_name"), "family", "url")
    d = slim_projection(details).select("name", F.lit(True).alias("d"), "id", "illustration_url")
    rows = catalog.join(h, "item_id", "left").join(d, "name", "left").filter("h or d")
    return rows.select(
        "item_id", first_given(F.col("h_name"), F.col("name")).alias("name"), F.coalesce("family", F.lit("")).alias("family"), F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce(given(F.col("illustration_url")), derived_url(F.col("url"))).alias("illustration_url"),
        F.when(F.col("id") != F.col("item_id"), F.concat(F.lit("id "), F.col("id").cast("string"), F.lit(" is not position "), F.col("item_id").cast("string"))).alias("warning"),
    )


def skip_label_language(lang: Column) -> Column:
    return F.coalesce((lang == "la") | lang.endswith("-GT") | illegal_key(lang), F.lit(True))


def web_labels(labels: DataFrame) -> DataFrame:
    """(lang, item_id, label): trimmed labels that aren't empty, of languages that are shown."""
    return labels.filter(~skip_label_language(F.col("lang"))).select("lang", "item_id", F.trim("label").alias("label")).filter(F.coalesce("label", F.lit("")) != "")


def catalog_coverage(catalog: DataFrame, labels: DataFrame, expected: int) -> DataFrame:
    """One row: entries, expected, covers_expected, languages, english labels, and how many entries lack name, family or picture."""
    lacks = lambda c: F.count_if(F.coalesce(c, F.lit("")) == "")
    a = catalog.agg(F.count("*").alias("entries"), lacks("name").alias("missing_name"), lacks("family").alias("missing_family"), lacks("illustration_url").alias("missing_illustration"))
    b = labels.agg(F.array_join(F.sort_array(F.collect_set("lang")), ",").alias("languages"), F.count_if(F.col("lang") == "en").alias("english"))
    return a.crossJoin(F.broadcast(b)).select("*", F.lit(expected).cast("long").alias("expected"), (F.col("entries") >= expected).alias("covers_expected"))  # one row each


def missing_fields(catalog: DataFrame, fields: list[str]) -> DataFrame:
    """(item_id, field) for each empty field: the id lists of the coverage report, as rows."""
    empty = F.filter(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("v")) for f in fields]), lambda x: F.coalesce(x["v"], F.lit("")) == "")
    return catalog.select("item_id", F.explode(empty).alias("x")).select("item_id", "x.field")


# ---- data quality


def findings(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, finding) for each rule that a row breaks; a rule without an answer isn't broken."""
    each = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
    return rows.select(key, F.explode(each).alias("finding"))


def dq_observations(observations: DataFrame, users: DataFrame) -> DataFrame:
    """Users without observations, and observations without time or at zero latitude or longitude (each a finding of its own)."""
    none = users.join(observations.select("observer").distinct(), "observer", "left_anti").select(F.col("observer").alias("subject"), F.lit("no list").alias("finding"))
    rules = {"no date": F.col("ms").isNull(), "latitude 0": F.col("lat") == 0, "longitude 0": F.col("lon") == 0}
    return none.unionByName(findings(observations.withColumn("subject", F.col("obs_key").cast("string")), "subject", rules))


def refresh_summary(**stages: DataFrame) -> DataFrame:
    """(stage, keys, languages) of written tables: rows, and the languages of those that have some."""
    parts = []
    for name, df in stages.items():
        langs = F.array_join(F.sort_array(F.collect_set("lang")), ",") if "lang" in df.columns else F.lit("")
        parts.append(df.agg(F.count("*").alias("keys"), langs.alias("languages")).withColumn("stage", F.lit(name)))
    return reduce(DataFrame.unionByName, parts).select("stage", "keys", "languages")


def snapshot_manifest(tables: dict[str, DataFrame | None], excluded: list[str]) -> DataFrame:
    """(node, children, bytes, missing, excluded): rows and bytes (as JSON) of each table; a None is a missing node."""
    spark = next(df.sparkSession for df in tables.values() if df is not None)
    rows = [df.agg(F.count("*").alias("children"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).cast("long").alias("bytes")).select(F.lit(n).alias("node"), "children", "bytes", F.lit(False).alias("missing"), F.lit(False).alias("excluded")) for n, df in tables.items() if df is not None]
    flat = [(n, 0, 0, True, False) for n, df in tables.items() if df is None] + [(n, 0, 0, False, True) for n in excluded]
    if flat:
        rows.append(spark.createDataFrame(flat, "node string, children long, bytes long, missing boolean, excluded boolean"))
    return reduce(DataFrame.unionByName, rows)


# ---- changes


def overlay(base: DataFrame, patch: DataFrame, keys: list[str]) -> DataFrame:
    """``base`` with the fields that ``patch`` gives put over it, and its new keys added; a null field of the patch keeps the old one."""
    fields = [c for c in base.columns if c not in keys]
    p = patch.select(*keys, *[F.col(c).alias(f"__{c}") for c in fields if c in patch.columns], F.lit(True).alias("__p"))
    both = base.join(p, keys, "full")
    return both.select(*keys, *[F.coalesce(f"__{c}", c).alias(c) if c in patch.columns else F.col(c) for c in fields])


def apply_patch(members: DataFrame, added: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """Posting rows (key, item_id) with rows added, and others removed: the same rows however often the patch is applied."""
    out = members.select("key", "item_id").unionByName(added.select("key", "item_id")).distinct()
    return out if removed is None else out.join(removed.select("key", "item_id"), ["key", "item_id"], "left_anti")


def counts_of(members: DataFrame, keys: DataFrame) -> DataFrame:
    """Counts derived from posting rows, zeros kept for the keys of the domain: so no count can drift from its list."""
    n = members.groupBy("key").agg(F.count("*").alias("n"))
    return keys.join(n, "key", "left").select("key", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def merge_search(base: DataFrame, patch: DataFrame) -> DataFrame:
    """Search rows (lang, name, is_label, ids) of base and patch: postings united, the base's is_label kept."""
    both = base.withColumn("o", F.lit(0)).unionByName(patch.withColumn("o", F.lit(1)))
    return both.groupBy("lang", "name").agg(F.min_by("is_label", "o").alias("is_label"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids"))


def apply_correction(counts: DataFrame, diff: DataFrame) -> DataFrame:
    """Counts (key, n) after a diff (key, change): one up for add, one down for remove, never below zero."""
    delta = diff.groupBy("key").agg(F.count_if(F.col("change") == "add").alias("a"), F.count_if(F.col("change") == "remove").alias("r"))
    return counts.join(delta, "key", "full").select("key", F.greatest(F.coalesce("n", F.lit(0)) + F.coalesce("a", F.lit(0)) - F.coalesce("r", F.lit(0)), F.lit(0)).cast("long").alias("n"))


def merge_translation_draft(live: DataFrame, draft: DataFrame, body: list[str], optional: list[str]) -> DataFrame:
    """Live translations (item_id, label, names, ...) with drafts merged in.

    Label, names and body fields of a draft replace the live ones. An optional field (the draft has ``has_<field>`` too)
    is set where the draft has it, removed where the draft has it empty, and kept where the draft lacks it.
    """
    d = draft.select("item_id", F.lit(True).alias("__d"), *[F.col(c).alias(f"__{c}") for c in draft.columns if c != "item_id"])
    both = live.join(d, "item_id", "full")
    new = lambda c: F.when(F.col("__d"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c)
    opt = lambda c: F.when(F.col("__d") & F.coalesce(f"__has_{c}", F.lit(False)), given(F.col(f"__{c}"))).otherwise(F.col(c)).alias(c)
    return both.select("item_id", *[new(c) for c in ("label", "names", *body)], *[opt(c) for c in optional])


def rename_key(table: DataFrame, key: str, old: str, new: str) -> DataFrame:
    """``table`` with the rows of one key copied to another; the old ones stay."""
    return table.unionByName(table.filter(F.col(key) == old).withColumn(key, F.lit(new)))


def validate_packets(packets: DataFrame, files: DataFrame, rules: dict[str, Column], warnings: dict[str, Column], map_file: str) -> DataFrame:
    """``packets`` with errors, warnings and ok. A packet whose file ``map_file`` isn't in ``files`` (path) has that error too."""
    have = files.select(F.col("path").alias(map_file), F.lit(True).alias("__have")).distinct()
    rows = packets.join(have, map_file, "left")
    every = rules | {"no map file": F.col("__have").isNull()}
    listed = lambda rs: F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rs.items()]))
    out = rows.withColumn("errors", listed(every)).withColumn("warnings", listed(warnings)).drop("__have")
    return out.withColumn("ok", F.size("errors") == 0)


#: Codes that a packet's axes may hold, roles that its first photo may have, and texts that it needs in English (fixed values).
AXES = {"color": (1, 5), "habitat": (1, 6), "petal": (1, 4)}
FIRST_ROLES = ("flower", "inflorescence")
ENGLISH_TEXTS = ("description", "flower", "inflorescence", "fruit", "leaf", "stem", "habitat")


def validate_job_packets(packets: DataFrame, files: DataFrame, regions: DataFrame, photos: int = 3) -> DataFrame:
    """(item_id, errors, warnings, ok) of packets by the catalog's own rules.

    packets: item_id, name, id, color, habitat, petal, region (codes), roles and photo_status, illustration_ok, folder and
    map_file (asked for in ``files`` (path) where there is a folder), ipni_id, english (field -> text), traits (axis ->
    struct of ok, confidence), unsourced (names), notes (warnings it has already), known. Regions not in ``regions``
    (code) are an error each, in the packet's order; both look-ups are joins. Nulls count as missing.
    """
    have = files.select(F.col("path").alias("map_file"), F.lit(True).alias("__have")).distinct()
    code = packets.select("item_id", F.posexplode("region").alias("pos", "code"))
    odd = code.join(regions.select("code").distinct(), "code", "left_anti").groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("pos", "code"))).alias("__odd"))
    rows = packets.join(have, "map_file", "left").join(odd, "item_id", "left")
    none = F.array().cast("array<string>")
    empty = lambda c: F.coalesce(F.size(F.col(c)), F.lit(0)) <= 0
    out_of = lambda c, lo, hi: empty(c) | F.exists(c, lambda x: x.isNull() | ~x.between(lo, hi))
    few = (F.coalesce("photo_status", F.lit("")) != "ok") | empty("roles") | (F.size("roles") < photos)
    errors = [
        F.when(given(F.col("name")).isNull(), "no accepted name"),
        F.when(F.col("id").isNull(), "no id"),
        *[F.when(out_of(c, lo, hi), f"{c} codes missing or not in {lo}-{hi}") for c, (lo, hi) in AXES.items()],
        F.when(empty("region"), "no regions"),
    ]
    late = [
        F.when(few, f"fewer than {photos} photos").when(~F.coalesce(F.try_element_at("roles", F.lit(1)).isin(*FIRST_ROLES), F.lit(False)), "first photo shows no flower"),
        F.when(~F.coalesce("illustration_ok", F.lit(False)), "no illustration"),
        F.when(F.col("folder").isNotNull() & F.col("__have").isNull(), "no distribution map"),
    ]
    unknown = F.transform(F.coalesce("__odd", F.array().cast("array<struct<pos:int,code:int>>")), lambda x: F.concat(F.lit("unknown region "), x["code"].cast("string")))
    trait = lambda a: F.try_element_at("traits", F.lit(a))
    lacking = F.array_join(F.array_compact(F.array(*[F.when(given(F.try_element_at("english", F.lit(f))).isNull(), f) for f in ENGLISH_TEXTS])), ", ")
    warnings = [
        *[F.when(trait(a).isNotNull() & ~F.coalesce(trait(a)["ok"], F.lit(False)), F.format_string(f"{a}: confidence %.2f is too low", F.coalesce(trait(a)["confidence"], F.lit(0.0)))) for a in AXES],
        F.when(given(F.col("ipni_id")).isNull(), "no ipni id"),
        F.when(lacking != "", F.concat(F.lit("english lacks "), lacking)),
        F.when(~empty("unsourced"), F.concat(F.lit("names without a source: "), F.array_join("unsourced", ", "))),
        F.when(F.col("known"), "already in the catalog"),
    ]
    listed = lambda cs: F.array_compact(F.array(*cs))
    out = rows.select("item_id", F.concat(listed(errors), unknown, listed(late)).alias("errors"), F.concat(F.coalesce("notes", none), listed(warnings)).alias("warnings"))
    return out.withColumn("ok", F.size("errors") == 0)


def apply_media_to_records(records: DataFrame, photos: DataFrame) -> DataFrame:
    """Records (item_id, folder, source_urls) with photo URLs by slot from (item_id, slot, file, source): the first is the header's, sources go in front, distinct."""
    p = photos.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("slot", "file", "source"))).alias("p"))
    rows = records.join(p, "item_id", "left").withColumn("p", F.coalesce("p", F.array().cast("array<struct<slot:int,file:string,source:string>>")))
    urls = F.transform("p", lambda x: F.concat(F.col("folder"), F.lit("/"), x["file"]))
    return rows.select("item_id", urls.alias("photo_urls"), F.try_element_at(urls, F.lit(1)).alias("url"), F.array_distinct(F.concat(F.filter(F.transform("p", lambda x: x["source"]), lambda s: s.isNotNull()), F.coalesce("source_urls", F.array().cast("array<string>")))).alias("source_urls"), F.when(F.size("p") == 0, "photos").otherwise("").alias("needs"))


def official_media_files(expected: DataFrame, files: DataFrame) -> DataFrame:
    """Expected files (item_id, names), each also as thumbnail, that are in the listing (path)."""
    each = expected.select("item_id", F.explode("names").alias("name")).select("item_id", F.explode(F.array("name", F.concat(F.lit("thumb/"), "name"))).alias("path"))
    return each.join(files.select("path").distinct(), "path", "left_semi").distinct()


def localized_messages(jobs: DataFrame, languages: DataFrame, copy: DataFrame, topics: DataFrame, app: str = "Catalog") -> DataFrame:
    """(job_id, lang, topic, title, body, uri): jobs (job_id, latin, uri) in each of a few languages (lang).

    Prepared copy (job_id, lang, label, title, body) wins over the template, a missing label falls back to the latin
    name; the app's name stands behind the title unless it is there; topics (lang, topic) multiply rows, and the URI
    tells the language unless it has one.
    """
    rows = jobs.crossJoin(F.broadcast(languages)).join(copy, ["job_id", "lang"], "left").join(F.broadcast(topics), "lang", "left")
    title = F.coalesce(given(F.col("title")), F.concat(F.lit("New: "), F.coalesce(given(F.col("label")), F.col("latin"))))
    uri = F.when(F.col("uri").rlike("[?&]lang="), F.col("uri")).otherwise(F.concat("uri", F.when(F.col("uri").contains("?"), "&").otherwise("?"), F.lit("lang="), "lang"))
    return rows.select("job_id", "lang", F.coalesce("topic", "lang").alias("topic"), F.when(title.endswith(app), title).otherwise(F.concat(title, F.lit(f" - {app}"))).alias("title"), F.coalesce(given(F.col("body")), F.col("latin")).alias("body"), uri.alias("uri"))


def missing_copy(jobs: DataFrame, languages: DataFrame, copy: DataFrame) -> DataFrame:
    """(job_id, lang) without prepared copy."""
    return jobs.select("job_id").crossJoin(F.broadcast(languages)).join(copy.select("job_id", "lang"), ["job_id", "lang"], "left_anti")


def source_applicability(items: DataFrame, sources: DataFrame) -> DataFrame:
    """(item_id, source) by any of the source's conditions: always, genera, families, lifeforms (contained), l2, l3.

    Families are compared by their current names. Conditions are exploded to values, so all but ``lifeforms`` are equality joins; those compare each item's lifeform
    with the sources' few tokens, of which distinct lifeforms are joined first.
    """
    parts = [items.select("item_id").crossJoin(F.broadcast(sources.filter("always").select("source")))]
    for item, column, norm in (("genus", "genera", F.lower), ("family", "families", family_key)):
        parts.append(items.select("item_id", norm(F.col(item)).alias("v")).join(sources.select("source", F.explode(F.transform(column, norm)).alias("v")), "v").select("item_id", "source"))
    for column in ("l2", "l3"):
        parts.append(items.select("item_id", F.explode(column).alias("v")).join(sources.select("source", F.explode(column).alias("v")), "v").select("item_id", "source"))
    forms = items.select(F.lower("lifeform").alias("v")).distinct()
    tokens = sources.select("source", F.explode(F.transform("lifeforms", F.lower)).alias("token"))
    hit = forms.join(F.broadcast(tokens), F.col("v").contains(F.col("token"))).select("v", "source").distinct()
    parts.append(items.select("item_id", F.lower("lifeform").alias("v")).join(hit, "v").select("item_id", "source"))
    return reduce(DataFrame.unionByName, parts).distinct()
