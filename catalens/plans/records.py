"""Record queries: parts as resolved items, nations as sources, order lines as photos."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalens.operators import catalog
from catalens.operators import records as ops
from catalens.plans.registry import query

FAMILIES = ("Aceraceae", "Sapindaceae", "Labiatae", "Rosaceae", "")
COVERS = "Mosses; Labiatae / Rosaceae – others"


def t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def part_columns():
    return F.col("p_partkey"), F.col("p_size"), F.col("p_name")


def family():
    return F.element_at(F.array(*map(F.lit, FAMILIES)), (F.col("p_size") % 5 + 1).cast("int"))


def resolved(spark, d):
    """Parts with some ids, codes, links and synonyms each."""
    k, size, name = part_columns()
    one = lambda name, authors, i: F.struct(name.alias("name"), F.lit(authors).cast("string").alias("authors"), F.lit(i).alias("ipni_id"))
    return t(spark, d, "part").select(
        k.alias("item_id"), F.upper(name).alias("query"), name.alias("name"), F.col("p_brand").alias("author"), family().alias("family"), F.when(k % 4 != 0, F.col("p_type")).otherwise("").alias("ord"), F.when(k % 7 != 0, F.array(size)).alias("l2"),
        F.when(k % 5 != 0, text("i", k)).otherwise("").alias("ipni_id"), F.lit(None).cast("string").alias("usda_id"), F.when(k % 9 == 0, text("/m/", k)).alias("freebase_id"), F.when(k % 2 == 0, k.cast("string")).alias("gbif_id"), F.when(k % 6 == 0, text("W ", name)).alias("wiki_name"),
        F.when(k % 3 == 0, F.create_map(F.lit("en"), text("http://x/", k))).alias("wikilinks"), F.create_map(F.lit("00_Genus"), F.substring_index(name, " ", 1)).alias("spine"),
        F.when(k % 3 == 0, F.array(one(text(name, " s"), "Auth", "i7"), one(text(name, " t"), None, ""))).alias("synonyms"), F.when(k % 13 == 0, F.array(F.lit("w"))).alias("warnings"), F.when(size % 4 == 0, "Tree").alias("lifeform"), F.when(k % 2 == 1, text("Q", k)).alias("qid"), (k % 11 == 0).alias("known"), F.lit("2026-01-01").alias("date"),
    )


def traits(spark, d):
    """Traits of all parts but every 17th, with gaps."""
    k, size, name = part_columns()
    axis = lambda some, codes: F.struct(F.when(some, codes).otherwise(F.array().cast("array<int>")).alias("values"), F.lit(0.7).alias("confidence"), F.array(F.lit("word x"), F.lit("word y")).alias("evidence"), some.alias("ok"))
    return t(spark, d, "part").filter(k % 17 != 0).select(
        k.alias("item_id"), axis(size % 3 != 0, F.array(1 + size % 5)).alias("color"), axis(k % 4 != 0, F.array(F.lit(2), F.lit(4))).alias("habitat"), axis(k % 3 != 0, F.array(F.lit(1))).alias("petal"), F.when(k % 5 != 0, size).alias("height_from"), F.when(k % 5 != 0, size + 9).alias("height_to"),
        F.when(k % 2 == 0, 1 + size % 12).alias("flowering_from"), F.when(k % 2 == 0, 2 + size % 12).alias("flowering_to"), (k % 3).cast("int").alias("toxicity"), F.when(k % 14 == 0, F.array(F.lit("leaf"), F.lit("stem"))).alias("missing"),
    )


FOLDER = f"(CASE WHEN k % 4 <> 0 THEN p_type ELSE 'Unknown' END || '/' || CASE WHEN fam = '' THEN 'Unknown' ELSE fam END || '/' || replace(p_name, ' ', '_'))"
ITEMS = f"(SELECT *, p_partkey AS k, {list(FAMILIES)}[p_size % 5 + 1] AS fam, p_name[1] || split_part(p_name, ' ', 2)[1] AS prefix FROM part)"
FIRST_NEEDS = "list_filter([CASE WHEN k % 7 = 0 THEN 'distribution' END, 'color', 'habitat', 'petal', CASE WHEN k % 11 = 0 THEN 'already_in_catalog' END], lambda x: x IS NOT NULL)"
NEEDS = """list_filter([CASE WHEN k % 7 = 0 THEN 'distribution' END, CASE WHEN k % 11 = 0 THEN 'already_in_catalog' END, CASE WHEN k % 17 = 0 OR p_size % 3 = 0 THEN 'color' END, CASE WHEN k % 17 = 0 OR k % 4 = 0 THEN 'habitat' END, CASE WHEN k % 17 = 0 OR k % 3 = 0 THEN 'petal' END,
  CASE WHEN k % 17 = 0 OR k % 5 = 0 THEN 'height' END, CASE WHEN k % 17 = 0 OR k % 2 = 1 THEN 'flowering' END], lambda x: x IS NOT NULL)"""
WARNINGS = "list_filter([CASE WHEN k % 13 = 0 THEN 'w' END, CASE WHEN k % 14 = 0 AND k % 17 <> 0 THEN 'english incomplete: leaf, stem' END], lambda x: x IS NOT NULL)"


@query(
    "build_records",
    f"""SELECT k AS item_id, upper(p_name) AS query, 'needs_review' AS status, array_to_string({FIRST_NEEDS}, ',') AS needs, CASE WHEN k % 13 = 0 THEN 'w' ELSE '' END AS warnings, {FOLDER} AS folder, prefix, CASE WHEN p_size % 4 = 0 THEN 'Tree' ELSE '' END AS lifeform, CASE WHEN k % 2 = 1 THEN 'Q' || k END AS qid, k % 11 = 0 AS known,
      CASE WHEN k % 6 = 0 THEN 'W ' ELSE '' END || p_name AS wiki_name, {FOLDER} || '/' || replace(p_name, ' ', '_') || '.webp' AS illustration, CASE WHEN k % 3 = 0 THEN 'http://x/' || k END AS link, split_part(p_name, ' ', 1) AS genus, p_brand AS author, CASE WHEN k % 5 <> 0 THEN 'i' || k END AS ipni_id, CASE WHEN k % 2 = 0 THEN '' || k END AS gbif_id, CASE WHEN k % 9 = 0 THEN '/m/' || k END AS freebase_id,
      fam AS family, {FOLDER} || '/' || prefix || '1.webp' AS url, CASE WHEN k % 7 <> 0 THEN [p_size] ELSE [] END AS distribution, CASE WHEN k % 3 = 0 THEN p_name || ' s|Auth|/taxon/urn:lsid:ipni.org:names:i7,' || p_name || ' t||' ELSE '' END AS synonyms FROM {ITEMS}""",
)
def build_records(spark, d):
    """All parts of the records: job, detail, header and synonyms."""
    r = ops.build_records(resolved(spark, d))
    synonyms = F.array_join(F.transform("synonyms", lambda s: F.concat_ws("|", s["name"], s["author"], s["href"])), ",")
    return r.select(
        "item_id", "job.query", "job.status", F.array_join("job.needs", ",").alias("needs"), F.array_join("job.warnings", ",").alias("warnings"), "job.folder", F.col("job.photo_prefix").alias("prefix"), "job.lifeform", "job.qid", F.col("job.already_in_catalog").alias("known"),
        F.col("detail.wikiName").alias("wiki_name"), F.col("detail.illustrationUrl").alias("illustration"), F.try_element_at("detail.wikilinks", F.lit("en")).alias("link"), F.try_element_at("detail.APGIV", F.lit("00_Genus")).alias("genus"), "detail.author", F.col("detail.ipniId").alias("ipni_id"), F.col("detail.gbifId").alias("gbif_id"), F.col("detail.freebaseId").alias("freebase_id"),
        "header.family", "header.url", F.col("header.filterDistribution").alias("distribution"), synonyms.alias("synonyms"),
    )


@query(
    "apply_inference",
    f"""SELECT k AS item_id, CASE WHEN len(needs) > 0 THEN 'needs_review' ELSE 'draft' END AS status, array_to_string(needs, ',') AS needs, array_to_string({WARNINGS}, ',') AS warnings, CASE WHEN has AND p_size % 3 <> 0 THEN [1 + p_size % 5] ELSE [] END AS color, CASE WHEN has AND k % 4 <> 0 THEN [2, 4] ELSE [] END AS habitat, CASE WHEN has AND k % 3 <> 0 THEN [1] ELSE [] END AS petal,
      CASE WHEN has AND k % 5 <> 0 THEN p_size END AS height_from, CASE WHEN has AND k % 5 <> 0 THEN p_size + 9 END AS height_to, CASE WHEN has AND k % 2 = 0 THEN 1 + p_size % 12 END AS flowering_from, CASE WHEN has AND k % 2 = 0 THEN 2 + p_size % 12 END AS flowering_to, CASE WHEN has THEN (k % 3)::INT END AS toxicity
    FROM (SELECT *, {NEEDS} AS needs, k % 17 <> 0 AS has FROM {ITEMS})""",
)
def apply_inference(spark, d):
    r = ops.apply_inference(ops.build_records(resolved(spark, d)), traits(spark, d))
    return r.select(
        "item_id", "job.status", F.array_join("job.needs", ",").alias("needs"), F.array_join("job.warnings", ",").alias("warnings"), *[F.col(f"header.filter{a.capitalize()}").alias(a) for a in ops.AXES],
        F.col("detail.heightFrom").alias("height_from"), F.col("detail.heightTo").alias("height_to"), F.col("detail.floweringFrom").alias("flowering_from"), F.col("detail.floweringTo").alias("flowering_to"), F.col("detail.toxicityClass").alias("toxicity"),
    )


# ---- sources


def hint_sources(spark, d):
    """Nations as sources with conditions and three volumes each, the first of them on mosses."""
    k, none = F.col("n_nationkey"), F.array().cast("array<string>")
    volume = lambda vol, families, covers, vascular, record, bib: F.struct(F.lit(vol).alias("vol"), F.array(*map(F.lit, families)).cast("array<string>").alias("families"), *[F.lit(v).cast("string").alias(c) for c, v in (("covers", covers), ("record", record), ("bibdigital_id", bib))], F.lit(vascular).cast("boolean").alias("vascular"))
    return t(spark, d, "nation").select(
        F.col("n_name").alias("source"), text("Src ", F.col("n_name")).alias("name"), F.coalesce(k == 0, F.lit(False)).alias("always"), F.when(k % 4 == 0, F.array(F.lit("Small"), F.lit("red"))).otherwise(none).alias("genera"), F.when(k % 4 == 1, F.array(F.element_at(F.array(*map(F.lit, ("Aceraceae", "Labiatae", "Rosaceae"))), (k % 3 + 1).cast("int")))).otherwise(none).alias("families"),
        F.when(k % 4 == 2, F.array(F.lit("prom"), F.lit("X"))).otherwise(none).alias("lifeforms"), F.when(k % 4 == 3, F.array(k)).otherwise(F.array().cast("array<int>")).alias("l2"), none.alias("l3"), F.when(k % 8 == 4, "library").otherwise("web").alias("kind"), F.when(k % 6 == 3, "pipeline").when(k % 5 != 0, "hand").alias("fetch"), (k % 2 == 0).alias("reliable"),
        F.when(k % 3 == 0, text("http://x/{genus}/{name_}?n=", k)).when(k % 3 == 1, text("http://plain/", k)).otherwise("http://x/{unknown}").alias("url"), text("http://home/", k).alias("home"), F.when(k % 4 == 1, "http://cite/{bibdigital_id}").alias("cite"), text("about ", k).alias("notes"),
        F.array(volume("0", ["Rosaceae"], None, False, "http://rec/0", None), volume("1", ["Acer-aceae"], None, True, "http://rec/1", None), volume("2", [], COVERS, None, None, "b2")).alias("volumes"),
    )


def hint_items(spark, d):
    k, size, name = part_columns()
    return t(spark, d, "part").select(k.alias("item_id"), name.alias("name"), F.substring_index(name, " ", 1).alias("genus"), family().alias("family"), F.col("p_type").alias("lifeform"), F.array(size, size + 4).alias("l2"), F.array().cast("array<string>").alias("l3"))


APPLIES = f"""(SELECT p.*, n.*, ['sapindaceae', 'sapindaceae', 'lamiaceae', 'rosaceae', ''][p_size % 5 + 1] AS now FROM {ITEMS} p JOIN nation n ON n_nationkey = 0 OR (n_nationkey % 4 = 0 AND (p_name LIKE 'small %' OR p_name LIKE 'red %'))
  OR (n_nationkey % 4 = 1 AND ['sapindaceae', 'lamiaceae', 'rosaceae'][n_nationkey % 3 + 1] = ['sapindaceae', 'sapindaceae', 'lamiaceae', 'rosaceae', ''][p_size % 5 + 1])
  OR (n_nationkey % 4 = 2 AND (p_type LIKE '%PROM%' OR p_type LIKE '%X%')) OR (n_nationkey % 4 = 3 AND (p_size = n_nationkey OR p_size + 4 = n_nationkey)))"""
HINTS = f"""(SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY reliable DESC, name, source)::INT AS n FROM (SELECT k AS item_id, n_name AS source, 'Src ' || n_name || CASE now WHEN 'sapindaceae' THEN ' 1' WHEN '' THEN '' ELSE ' 2' END AS name, n_nationkey % 2 = 0 AS reliable, CASE WHEN n_nationkey % 5 <> 0 THEN 'hand' END AS fetch,
  CASE WHEN now IN ('lamiaceae', 'rosaceae') AND n_nationkey % 4 = 1 THEN 'http://cite/b2' WHEN now = 'sapindaceae' THEN 'http://rec/1' WHEN n_nationkey % 3 = 0 THEN 'http://x/' || split_part(p_name, ' ', 1) || '/' || replace(p_name, ' ', '_') || '?n=' || n_nationkey WHEN n_nationkey % 3 = 1 THEN 'http://plain/' || n_nationkey ELSE 'http://home/' || n_nationkey END AS url,
  CASE now WHEN 'sapindaceae' THEN '1' WHEN '' THEN NULL ELSE '2' END AS volume, CASE WHEN now IN ('lamiaceae', 'rosaceae') THEN '{COVERS}' ELSE 'about ' || n_nationkey END AS notes FROM {APPLIES} WHERE n_nationkey % 8 <> 4 AND n_nationkey % 6 <> 3))"""


@query("source_applicability", f"SELECT k AS item_id, n_name AS source FROM {APPLIES}")
def source_applicability(spark, d):
    return catalog.source_applicability(hint_items(spark, d), hint_sources(spark, d))


@query("source_hints", f"SELECT * FROM {HINTS}")
def source_hints(spark, d):
    """Hints with volumes by family and by what they cover, current names for older ones."""
    items, sources = hint_items(spark, d), hint_sources(spark, d)
    return ops.source_hints(catalog.source_applicability(items, sources), items, sources)


# ---- the page


def photos(spark, d):
    k, q = F.col("l_orderkey"), F.col("l_quantity").cast("int")
    slot = ((k * 10 + F.col("l_linenumber")) * 1000 + F.col("l_suppkey") % 1000) * 100 + q
    return t(spark, d, "lineitem").select(F.col("l_partkey").alias("item_id"), slot.alias("slot"), F.when(q % 4 != 0, "leaf").alias("role"), text("t", F.col("l_suppkey")).alias("title"), F.when(k % 3 == 0, "CC0").alias("license"), F.when(k % 2 == 0, text("s", k)).alias("source_url"))


def names(spark, d):
    k, _, name = part_columns()
    row = lambda lang, n, name, source: F.struct(F.lit(lang).alias("lang"), F.lit(n).alias("n"), name.alias("name"), F.lit(source).alias("source"))
    each = F.when(k % 6 == 0, F.array().cast("array<struct<lang:string,n:int,name:string,source:string>>")).when(k % 2 == 0, F.array(row("en", 2, F.col("p_brand"), "page"), row("en", 1, F.col("p_type"), "entity"), row("de", 1, F.upper(name), "table"))).otherwise(F.array(row("en", 1, F.col("p_type"), "entity")))
    return t(spark, d, "part").select(k.alias("item_id"), F.explode(each).alias("x")).select("item_id", "x.*")


_LIST = "coalesce(nullif(array_to_string({}, ', '), ''), 'none')"
PAGE = f"""(WITH p AS (SELECT l_partkey AS k, count(*) AS photos, list('- ' || coalesce(CASE WHEN l_quantity::INT % 4 <> 0 THEN 'leaf' END, 'none') || ': t' || l_suppkey || ' (' || CASE WHEN l_orderkey % 3 = 0 THEN 'CC0' ELSE 'license?' END || ') ' || CASE WHEN l_orderkey % 2 = 0 THEN 's' || l_orderkey ELSE '' END
      ORDER BY ((l_orderkey * 10 + l_linenumber) * 1000 + l_suppkey % 1000) * 100 + l_quantity::INT, CASE WHEN l_quantity::INT % 4 <> 0 THEN 'leaf' END NULLS FIRST, 't' || l_suppkey) AS lines FROM lineitem GROUP BY l_partkey),
    h AS (SELECT item_id AS k, list('- [' || CASE WHEN reliable THEN 'reliable' ELSE coalesce("fetch", 'manual') END || '] ' || name || ': ' || url || ' — ' || notes ORDER BY n) AS lines FROM {HINTS} GROUP BY item_id),
    r AS (SELECT *, {NEEDS} AS needs, {WARNINGS} AS warnings, k % 17 <> 0 AS has FROM {ITEMS}),
    a AS (SELECT *, {_LIST.format("CASE WHEN has AND p_size % 3 <> 0 THEN [1 + p_size % 5] ELSE [] END")} AS color, {_LIST.format("CASE WHEN has AND k % 4 <> 0 THEN [2, 4] ELSE [] END")} AS habitat, {_LIST.format("CASE WHEN has AND k % 3 <> 0 THEN [1] ELSE [] END")} AS petal FROM r)
  SELECT k AS item_id, array_to_string(list_concat(['# ' || p_name, '', '- status: ' || CASE WHEN len(needs) > 0 THEN 'needs_review' ELSE 'draft' END, '- id: ' || k, '- already in catalog: ' || (k % 11 = 0), '- family: ' || CASE WHEN fam = '' THEN 'none' ELSE fam END, '- IPNI: ' || CASE WHEN k % 5 <> 0 THEN 'i' || k ELSE 'none' END, '- GBIF: ' || CASE WHEN k % 2 = 0 THEN '' || k ELSE 'none' END,
    '- Wikidata: ' || CASE WHEN k % 2 = 1 THEN 'Q' || k ELSE 'none' END, '- distribution L2: ' || CASE WHEN k % 7 <> 0 THEN '' || p_size ELSE 'none' END, '- color: ' || color, '- habitat: ' || habitat, '- petal: ' || petal, '- height: ' || CASE WHEN has AND k % 5 <> 0 THEN p_size || '–' || (p_size + 9) ELSE 'none–none' END || ' cm',
    '- flowering: ' || CASE WHEN has AND k % 2 = 0 THEN (1 + p_size % 12) || '–' || (2 + p_size % 12) ELSE 'none–none' END, '- toxicity class: ' || CASE WHEN has THEN '' || k % 3 ELSE 'none' END, '- illustration: ' || {FOLDER} || '/' || replace(p_name, ' ', '_') || '.webp', '- photos: ' || coalesce(photos, 0), '', '## Photos'],
    coalesce(p.lines, ['- none yet']), CASE WHEN has THEN ['', '## Traits', '- color: ' || color || ' (confidence 0.70) word x; word y', '- habitat: ' || habitat || ' (confidence 0.70) word x; word y', '- petal: ' || petal || ' (confidence 0.70) word x; word y'] ELSE [] END,
    ['', '## Needs'], CASE WHEN len(needs) > 0 THEN list_transform(needs, lambda x: '- ' || x) ELSE ['- none'] END, ['', '## Warnings'], CASE WHEN len(warnings) > 0 THEN list_transform(warnings, lambda x: '- ' || x) ELSE ['- none'] END,
    ['', '## Common names'], CASE WHEN k % 6 = 0 THEN ['- none yet'] WHEN k % 2 = 0 THEN ['- de: ' || upper(p_name) || ' (table)', '- en: ' || p_type || ' (entity); ' || p_brand || ' (page)'] ELSE ['- en: ' || p_type || ' (entity)'] END,
    CASE WHEN h.lines IS NOT NULL THEN list_concat(['', '## Botanical sources'], h.lines) ELSE [] END), chr(10)) AS report FROM a LEFT JOIN p USING (k) LEFT JOIN h USING (k))"""


@query("review_report", f"SELECT * FROM {PAGE}")
def review_report(spark, d):
    """The whole page of each part."""
    records = ops.apply_inference(ops.build_records(resolved(spark, d)), traits(spark, d))
    return ops.review_report(records, photos(spark, d), names(spark, d), source_hints(spark, d))
