"""Records of a new item with all their parts, and the page that an editor reviews: both are projections of one nested row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalens.functions.strings import family_alias, given, photo_prefix, slug, storage_folder, url_template

# ---- fixed values: current names of families with older ones, the link of a name's id, and the order of needs

FAMILY_ALIASES = {
    "labiatae": "lamiaceae", "cruciferae": "brassicaceae", "umbelliferae": "apiaceae", "compositae": "asteraceae", "gramineae": "poaceae",
    "leguminosae": "fabaceae", "palmae": "arecaceae", "aceraceae": "sapindaceae", "hippocastanaceae": "sapindaceae", "agavaceae": "asparagaceae",
}
NAME_LINK = "/taxon/urn:lsid:ipni.org:names:"
AXES = ("color", "habitat", "petal")
COVER_SIGNS = "[–—,;/()]+"

_CODES = "array<int>"


def _listed(*cs: Column) -> Column:
    return F.array_compact(F.array(*cs)).cast("array<string>")


def build_records(resolved: DataFrame) -> DataFrame:
    """(item_id, job, detail, header, synonyms) of resolved items, before their traits are known.

    resolved: item_id, query, name, author, family, ord, l2 (codes), ipni_id, usda_id, freebase_id, gbif_id, wiki_name,
    wikilinks (map), spine (map), synonyms (array of name, authors, ipni_id), warnings, lifeform, qid, known, date. Blank
    ids are null, missing lists empty; the distribution is needed where there are no codes, and the three axes always.
    """
    r = F.col
    text = lambda c: F.coalesce(r(c), F.lit(""))
    folder, prefix = storage_folder(r("ord"), r("family"), r("name")), photo_prefix(r("name"))
    l2 = F.coalesce("l2", F.array().cast(_CODES))
    none = F.array().cast("array<string>")
    needs = F.concat(_listed(F.when(F.size(l2) == 0, "distribution")), F.array(*map(F.lit, AXES)), _listed(F.when(r("known"), "already_in_catalog")))
    job = F.struct(
        r("query").alias("query"), r("name").alias("accepted_name"), r("item_id").alias("id"), F.coalesce("known", F.lit(False)).alias("already_in_catalog"), F.lit("needs_review").alias("status"), needs.alias("needs"),
        F.coalesce("warnings", none).alias("warnings"), r("date").alias("date"), folder.alias("folder"), prefix.alias("photo_prefix"), text("lifeform").alias("lifeform"), r("qid").alias("qid"),
    )
    detail = F.struct(
        r("item_id").alias("id"), r("name").alias("name"), F.coalesce(given(r("wiki_name")), "name").alias("wikiName"), F.concat(folder, F.lit("/"), slug(r("name")), F.lit(".webp")).alias("illustrationUrl"),
        none.alias("photoUrls"), none.alias("sourceUrls"), F.coalesce("wikilinks", F.create_map().cast("map<string,string>")).alias("wikilinks"), F.coalesce("spine", F.create_map().cast("map<string,string>")).alias("APGIV"),
        *[given(r(c)).alias(to) for c, to in (("author", "author"), ("ipni_id", "ipniId"), ("gbif_id", "gbifId"), ("usda_id", "usdaId"), ("freebase_id", "freebaseId"))],
        *[F.lit(None).cast("int").alias(c) for c in ("heightFrom", "heightTo", "floweringFrom", "floweringTo", "toxicityClass")],
    )
    header = F.struct(text("family").alias("family"), r("name").alias("name"), F.concat(folder, F.lit("/"), prefix, F.lit("1.webp")).alias("url"), *[F.array().cast(_CODES).alias(f"filter{a.capitalize()}") for a in AXES], l2.alias("filterDistribution"))
    link = lambda s: F.when(given(s["ipni_id"]).isNotNull(), F.concat(F.lit(NAME_LINK), s["ipni_id"])).otherwise("")
    synonyms = F.transform("synonyms", lambda s: F.struct(s["name"].alias("name"), F.coalesce(s["authors"], F.lit("")).alias("author"), F.lit("").alias("suffix"), link(s).alias("href")))
    none_yet = F.array().cast("array<struct<name:string,author:string,suffix:string,href:string>>")
    return resolved.select("item_id", job.alias("job"), detail.alias("detail"), header.alias("header"), F.coalesce(synonyms, none_yet).alias("synonyms"))


def apply_inference(records: DataFrame, traits: DataFrame) -> DataFrame:
    """``records`` with traits (item_id, color, habitat, petal, height_from, ..., toxicity, missing) put in; column ``traits`` keeps them.

    Needs are then what is still empty: the axes, height and flowering. ``missing`` lists the English texts that couldn't
    be drafted, for a warning. A record without a row of traits needs all.
    """
    t = traits.select("item_id", F.struct(*AXES, "height_from", "height_to", "flowering_from", "flowering_to", "toxicity", "missing").alias("traits"))
    rows = records.join(t, "item_id", "left")
    got = lambda c: F.col(f"traits.{c}")
    codes = {a: F.coalesce(got(f"{a}.values"), F.array().cast(_CODES)) for a in AXES}
    open_ = [F.when(F.size(codes[a]) == 0, a) for a in AXES] + [F.when(got("height_from").isNull(), "height"), F.when(got("flowering_from").isNull(), "flowering")]
    needs = F.concat(F.array_except(F.col("job.needs"), F.array(*map(F.lit, AXES))), _listed(*open_))
    lacking = F.coalesce(F.size(got("missing")) > 0, F.lit(False))
    warnings = F.concat(F.col("job.warnings"), F.when(lacking, F.array(F.concat(F.lit("english incomplete: "), F.array_join(got("missing"), ", ")))).otherwise(F.array().cast("array<string>")))
    job = F.col("job").withField("needs", needs).withField("status", F.when(F.size(needs) > 0, "needs_review").otherwise("draft")).withField("warnings", warnings)
    header, detail = F.col("header"), F.col("detail")
    for a in AXES:
        header = header.withField(f"filter{a.capitalize()}", codes[a])
    for to, c in (("heightFrom", "height_from"), ("heightTo", "height_to"), ("floweringFrom", "flowering_from"), ("floweringTo", "flowering_to"), ("toxicityClass", "toxicity")):
        detail = detail.withField(to, F.coalesce(got(c), detail[to]))
    return rows.select("item_id", job.alias("job"), detail.alias("detail"), header.alias("header"), "synonyms", "traits")


def review_report(records: DataFrame, photos: DataFrame, names: DataFrame, hints: DataFrame) -> DataFrame:
    """(item_id, report): a Markdown page of each record of ``apply_inference``, by its facts, photos, traits, needs, warnings, names and sources.

    photos: (item_id, slot, role, title, license, source_url); names: (item_id, lang, n, name, source); hints: (item_id, n,
    name, reliable, fetch, url, notes). Each is gathered by item first, as an item has few of them.
    """
    gathered = lambda df, order, *cs: df.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct(*order, *cs))).alias("x"))
    p = gathered(photos, ["slot"], "role", "title", "license", "source_url").withColumnRenamed("x", "__p")
    spoken = names.groupBy("item_id", "lang").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "name", "source"))), lambda x: F.concat(x["name"], F.lit(" ("), x["source"], F.lit(")"))), "; ").alias("line"))
    n = gathered(spoken, ["lang"], "line").withColumnRenamed("x", "__n")
    h = gathered(hints, ["n"], "name", "reliable", "fetch", "url", "notes").withColumnRenamed("x", "__h")
    rows = records.join(p, "item_id", "left").join(n, "item_id", "left").join(h, "item_id", "left")
    c, none = F.col, F.array().cast("array<string>")
    shown = lambda x: F.coalesce(given(x.cast("string")), F.lit("none"))
    codes = lambda x: shown(F.array_join(x.cast("array<string>"), ", "))
    span = lambda a, b: F.concat(shown(a), F.lit("–"), shown(b))
    line = lambda label, value: F.concat(F.lit(f"- {label}: "), value)
    j, d, head = (lambda x: c(f"job.{x}")), (lambda x: c(f"detail.{x}")), (lambda x: c(f"header.{x}"))
    facts = F.array(
        F.concat(F.lit("# "), j("accepted_name")), F.lit(""), line("status", j("status")), line("id", shown(j("id"))), line("already in catalog", j("already_in_catalog").cast("string")), line("family", shown(head("family"))),
        line("IPNI", shown(d("ipniId"))), line("GBIF", shown(d("gbifId"))), line("Wikidata", shown(j("qid"))), line("distribution L2", codes(head("filterDistribution"))), *[line(a, codes(head(f"filter{a.capitalize()}"))) for a in AXES],
        line("height", F.concat(span(d("heightFrom"), d("heightTo")), F.lit(" cm"))), line("flowering", span(d("floweringFrom"), d("floweringTo"))), line("toxicity class", shown(d("toxicityClass"))), line("illustration", d("illustrationUrl")),
        line("photos", F.coalesce(F.size("__p"), F.lit(0)).cast("string")),
    )
    section = lambda title, lines, empty: F.concat(F.array(F.lit(""), F.lit(f"## {title}")), F.when(F.coalesce(F.size(lines), F.lit(0)) > 0, lines).otherwise(F.array(F.lit(empty)) if empty else none))
    photo = F.transform("__p", lambda x: F.concat(F.lit("- "), F.coalesce(x["role"], F.lit("none")), F.lit(": "), F.coalesce(x["title"], F.lit("")), F.lit(" ("), F.coalesce(x["license"], F.lit("license?")), F.lit(") "), F.coalesce(x["source_url"], F.lit(""))))
    axis = lambda a: F.when(c(f"traits.{a}").isNotNull(), F.concat(F.lit(f"- {a}: "), codes(c(f"traits.{a}.values")), F.format_string(" (confidence %.2f) ", c(f"traits.{a}.confidence")), F.array_join(c(f"traits.{a}.evidence"), "; ")))
    bullets = lambda xs: F.transform(xs, lambda x: F.concat(F.lit("- "), x))
    name = F.transform("__n", lambda x: F.concat(F.lit("- "), x["lang"], F.lit(": "), x["line"]))
    mark = lambda x: F.when(x["reliable"], "reliable").otherwise(F.coalesce(given(x["fetch"]), F.lit("manual")))
    hint = F.transform("__h", lambda x: F.concat(F.lit("- ["), mark(x), F.lit("] "), x["name"], F.lit(": "), F.coalesce(x["url"], F.lit("")), F.lit(" — "), F.coalesce(x["notes"], F.lit(""))))
    page = F.concat(
        facts, section("Photos", photo, "- none yet"), F.when(c("traits").isNotNull(), section("Traits", _listed(*map(axis, AXES)), "")).otherwise(none), section("Needs", bullets(j("needs")), "- none"), section("Warnings", bullets(j("warnings")), "- none"),
        section("Common names", name, "- none yet"), F.when(F.coalesce(F.size("__h"), F.lit(0)) > 0, section("Botanical sources", hint, "")).otherwise(none),
    )
    return rows.select("item_id", F.array_join(page, "\n").alias("report"))


def family_key(x: Column) -> Column:
    return family_alias(x, FAMILY_ALIASES)


def volume_for(volumes: Column, family: Column) -> Column:
    """The first volume on vascular plants that lists the family, or has it among the words of ``covers``; null without one."""
    want = family_key(family)
    lists = lambda v: F.exists(F.coalesce(v["families"], F.array().cast("array<string>")), lambda f: family_key(f) == want)
    covers = lambda v: F.exists(F.split(F.coalesce(v["covers"], F.lit("")), COVER_SIGNS), lambda f: family_key(f) == want)
    return F.when(want != "", F.try_element_at(F.filter(volumes, lambda v: F.coalesce(v["vascular"], F.lit(True)) & (lists(v) | covers(v))), F.lit(1)))


def source_hints(applicable: DataFrame, items: DataFrame, sources: DataFrame) -> DataFrame:
    """(item_id, n, source, name, reliable, fetch, url, volume, notes): the sources to open for each item, reliable ones first, then by name.

    Sources of the pipeline's own and libraries are left out. sources: source (id), name, kind, fetch, reliable, url (a
    template), home, cite, notes, volumes (array of vol, families, covers, vascular, record, bibdigital_id). A volume's
    own number goes into ``cite``; else its record, the template with the item's name, or the source's home is the URL.
    """
    own = F.coalesce(F.col("fetch") == "pipeline", F.lit(False)) | F.coalesce(F.col("kind") == "library", F.lit(False))
    listed = sources.filter(~own).select("source", F.col("name").alias("title"), "fetch", F.coalesce("reliable", F.lit(False)).alias("reliable"), F.col("url").alias("template"), "home", "cite", F.coalesce("notes", F.lit("")).alias("about"), "volumes")
    rows = applicable.join(listed, "source").join(items.select("item_id", "name", "family"), "item_id").withColumn("v", volume_for(F.col("volumes"), F.col("family")))
    v, hole = (lambda c: F.col(f"v.{c}")), "{bibdigital_id}"
    cited = F.when((given(v("bibdigital_id")).isNotNull()) & F.coalesce(F.col("cite").contains(hole), F.lit(False)), F.replace("cite", F.lit(hole), v("bibdigital_id")))
    filled = url_template(F.col("template"), F.col("name"))
    named = F.when(given(F.col("template")).isNotNull() & (~F.col("template").contains("{") | ~filled.contains("{")), filled)
    url = F.coalesce(cited, given(v("record")), named, F.col("home"))
    title = F.trim(F.when(F.col("v").isNotNull(), F.concat("title", F.lit(" "), F.coalesce(v("vol"), F.lit("")))).otherwise(F.col("title")))
    out = rows.select("item_id", "source", title.alias("name"), "reliable", "fetch", url.alias("url"), v("vol").alias("volume"), F.coalesce(given(v("covers")), "about").alias("notes"))
    return out.withColumn("n", F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("reliable"), "name", "source")))
