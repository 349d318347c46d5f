"""Catalog, quality and change queries: customers as items, orders and parts as changed records, events as increments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalens.operators import catalog as ops
from catalens.operators import facets, records, search
from catalens.plans.facets import DOMAINS, KEYS_SQL, PAIRS_SQL, order_items
from catalens.plans.records import ITEMS, NEEDS, resolved, traits
from catalens.plans.registry import query
from catalens.plans.search import HITS, part_translations


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def items(spark, d):
    return t(spark, d, "customer").select(F.col("c_custkey").alias("item_id"), F.col("c_name").alias("name"))


def headers(spark, d):
    """Headers of all customers but every 6th; every 5th has no name of its own; URLs of one to four segments."""
    k = F.col("c_custkey")
    return t(spark, d, "customer").filter(k % 6 != 0).select(k.alias("item_id"), F.when(k % 5 != 0, F.concat(F.lit("H "), "c_name")).otherwise("").alias("name"), F.when(k % 7 != 0, F.col("c_mktsegment")).alias("family"), F.array_join(F.slice(F.array(F.lit("a"), F.col("c_mktsegment"), k.cast("string"), F.lit("p.webp")), F.lit(1), k % 4 + 1), "/").alias("url"))


def details(spark, d):
    """Details of every 4th customer, half of them with a picture, some with another id."""
    k = F.col("c_custkey")
    return t(spark, d, "customer").filter(k % 4 == 0).select(F.col("c_name").alias("name"), (k + F.when(k % 9 == 0, 1).otherwise(0)).alias("id"), F.when(k % 8 == 0, F.concat(F.lit("pic/"), k)).alias("illustration_url"))


WEB = """(SELECT k AS item_id, CASE WHEN k % 6 <> 0 AND k % 5 <> 0 THEN 'H ' || c_name ELSE c_name END AS name, CASE WHEN k % 6 <> 0 AND k % 7 <> 0 THEN c_mktsegment ELSE '' END AS family,
  CASE WHEN k % 6 <> 0 THEN url ELSE '' END AS url, CASE WHEN k % 8 = 0 THEN 'pic/' || k WHEN k % 6 = 0 THEN '' WHEN k % 4 >= 2 THEN array_to_string(['a', c_mktsegment, '' || k], '/') || '/' || k || '.webp' ELSE url END AS illustration_url,
  CASE WHEN k % 36 = 0 THEN 'id ' || (k + 1) || ' is not position ' || k END AS warning
  FROM (SELECT c_custkey AS k, *, array_to_string((['a', c_mktsegment, '' || c_custkey, 'p.webp'])[1:c_custkey % 4 + 1], '/') AS url FROM customer) WHERE k % 6 <> 0 OR k % 4 = 0)"""


@query("web_catalog", f"SELECT * FROM {WEB}")
def web_catalog(spark, d):
    return ops.web_catalog(items(spark, d), headers(spark, d), details(spark, d))


@query("catalog_header_join", "SELECT c_custkey AS item_id, c_name AS name FROM customer WHERE c_custkey % 6 = 0")
def catalog_header_join(spark, d):
    """The warnings: items without a header."""
    return ops.catalog_header_join(items(spark, d), headers(spark, d).drop("name"))[1]


@query("slim_projection", "SELECT c_name AS name, c_custkey + CASE WHEN c_custkey % 9 = 0 THEN 1 ELSE 0 END AS id, CASE WHEN c_custkey % 8 = 0 THEN 'pic/' || c_custkey ELSE '' END AS illustration_url FROM customer WHERE c_custkey % 4 = 0")
def slim_projection(spark, d):
    return ops.slim_projection(details(spark, d))


def labels(spark, d):
    k = F.col("c_custkey")
    return t(spark, d, "customer").select(F.explode(F.array(F.lit("en"), F.lit("la"), F.lit("de-GT"), F.lit("a.b"), F.lit("fr"))).alias("lang"), k.alias("item_id"), F.when(k % 3 == 0, F.concat(F.lit(" "), "c_mktsegment", F.lit(" "))).when(k % 3 == 1, "  ").alias("label"))


LABELS = "(SELECT unnest(['en', 'fr']) AS lang, c_custkey AS item_id, c_mktsegment AS label FROM customer WHERE c_custkey % 3 = 0)"


@query("web_labels", f"SELECT * FROM {LABELS}")
def web_labels(spark, d):
    return ops.web_labels(labels(spark, d))


@query("catalog_coverage", f"SELECT a.*, (SELECT string_agg(DISTINCT lang, ',' ORDER BY lang) FROM {LABELS}) AS languages, (SELECT count(*) FROM {LABELS} WHERE lang = 'en') AS english, 1000::BIGINT AS expected, entries >= 1000 AS covers_expected FROM (SELECT count(*) AS entries, count(*) FILTER (name = '') AS missing_name, count(*) FILTER (family = '') AS missing_family, count(*) FILTER (illustration_url = '') AS missing_illustration FROM {WEB}) a")
def catalog_coverage(spark, d):
    return ops.catalog_coverage(web_catalog(spark, d), ops.web_labels(labels(spark, d)), 1000)


@query("replace_web_catalog", f"SELECT item_id, f AS field FROM (SELECT item_id, unnest([CASE WHEN name = '' THEN 'name' END, CASE WHEN family = '' THEN 'family' END, CASE WHEN illustration_url = '' THEN 'illustration_url' END]) AS f FROM {WEB}) WHERE f IS NOT NULL")
def replace_web_catalog(spark, d):
    """What the gate before a replacement looks at: each entry's missing fields."""
    return ops.missing_fields(web_catalog(spark, d), ["name", "family", "illustration_url"])


@query("dq_observations", "SELECT '' || user_id AS subject, 'no list' AS finding FROM (SELECT c_custkey AS user_id FROM customer EXCEPT SELECT user_id FROM events) UNION ALL SELECT '' || event_id, unnest(list_filter([CASE WHEN event_id % 50 = 0 THEN 'no date' END, CASE WHEN (props->>'$.k')::INT = 45 THEN 'latitude 0' END, CASE WHEN user_id % 90 = 30 THEN 'longitude 0' END], lambda x: x IS NOT NULL)) FROM events")
def dq_observations(spark, d):
    """Customers as users; events as observations."""
    k = F.get_json_object("props", "$.k").cast("int")
    obs = t(spark, d, "events").select(F.col("event_id").alias("obs_key"), F.col("user_id").cast("string").alias("observer"), F.when(F.col("event_id") % 50 != 0, F.lit(1)).alias("ms"), (k - 45).alias("lat"), (F.col("user_id") % 90 - 30).alias("lon"))
    return ops.dq_observations(obs, t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("observer")))


@query("dq_translations_complete", "SELECT doc_id, unnest(list_filter([CASE WHEN lang IS NULL OR doc_id % 4 = 0 THEN 'label' END, CASE WHEN length(text) < 200 THEN 'description' END, CASE WHEN strpos(text, '|') > 0 THEN 'leaf' END, CASE WHEN strpos(text, '!') > 0 THEN 'fruit' END], lambda x: x IS NOT NULL)) AS finding FROM documents")
def dq_translations_complete(spark, d):
    """Documents as translations with mandatory fields."""
    n = F.col("text")
    return ops.findings(t(spark, d, "documents"), "doc_id", {"label": F.col("lang").isNull() | (F.col("doc_id") % 4 == 0), "description": F.length(n) < 200, "leaf": n.contains("|"), "fruit": n.contains("!")})


@query("dq_taxonomy_names", "SELECT doc_id AS taxon, coalesce(lang, '') AS lang FROM documents WHERE length(trim(regexp_extract(text, '^[A-Za-z ]*'))) < 3")
def dq_taxonomy_names(spark, d):
    """(language, taxon) without a name: documents that begin with no word of 3 letters."""
    name = F.trim(F.regexp_extract("text", "^[A-Za-z ]*", 0))
    return t(spark, d, "documents").filter(F.length(name) < 3).select(F.col("doc_id").alias("taxon"), F.coalesce("lang", F.lit("")).alias("lang"))


@query("refresh_summary", f"SELECT 'facets' AS stage, count(*) AS keys, '' AS languages FROM ({PAIRS_SQL}) UNION ALL SELECT 'search', count(*), string_agg(DISTINCT lang, ',' ORDER BY lang) FROM (SELECT DISTINCT lang, name FROM {HITS} WHERE NOT regexp_matches(name, '[./#$\\[\\]]'))")
def refresh_summary(spark, d):
    return ops.refresh_summary(facets=facets.facet_members(order_items(spark, d), "o_orderkey", DOMAINS), search=search.search_index(search.name_hits(part_translations(spark, d))))


@query("snapshot_manifest", "SELECT 'nation' AS node, count(*) AS children, sum(strlen('{\"n_nationkey\":' || n_nationkey || ',\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '}'))::BIGINT AS bytes, false AS missing, false AS excluded FROM nation UNION ALL SELECT 'region', count(*), sum(strlen('{\"r_regionkey\":' || r_regionkey || ',\"r_name\":\"' || r_name || '\"}'))::BIGINT, false, false FROM region UNION ALL SELECT 'labels', count(*), sum(strlen('{\"doc_id\":' || doc_id || ',\"quality\":' || quality || ',\"toxic\":' || toxic || '}'))::BIGINT, false, false FROM labels UNION ALL SELECT 'drafts', 0, 0, true, false UNION ALL SELECT 'tokens', 0, 0, false, true")
def snapshot_manifest(spark, d):
    return ops.snapshot_manifest({"nation": t(spark, d, "nation"), "region": t(spark, d, "region"), "labels": t(spark, d, "labels"), "drafts": None}, ["tokens"])


@query("upsert_records", "SELECT k AS c_custkey, CASE WHEN k % 5 = 0 AND k % 10 <> 0 THEN 'n' || k WHEN k < (SELECT count(*) FROM customer) THEN c_name END AS c_name, CASE WHEN k % 5 = 0 THEN 'NEW' ELSE c_mktsegment END AS c_mktsegment, c_acctbal FROM (SELECT c_custkey AS k, * FROM customer UNION ALL SELECT c_custkey + (SELECT count(*) FROM customer), NULL, NULL, NULL, NULL, NULL FROM customer WHERE c_custkey % 5 = 0) x(k, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment)")
def upsert_records(spark, d):
    """Every 5th customer, and as many new ones, get a name (but for every other) and a segment."""
    base = t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    n = base.agg(F.count("*").alias("n"))
    fifth = base.filter("c_custkey % 5 = 0").select("c_custkey")
    patch = fifth.unionByName(fifth.join(F.broadcast(n)).select((F.col("c_custkey") + F.col("n")).alias("c_custkey")))
    patch = patch.select("c_custkey", F.when(F.col("c_custkey") % 10 != 0, F.concat(F.lit("n"), "c_custkey")).alias("c_name"), F.lit("NEW").alias("c_mktsegment"))
    return ops.overlay(base, patch, ["c_custkey"])


@query("promote_staging", "SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'S-' || p_name ELSE p_name END AS p_name, CASE WHEN p_partkey % 14 = 0 THEN 0 ELSE p_size END AS p_size FROM part")
def promote_staging(spark, d):
    """Staged parts over live ones: an update, not a replacement."""
    live = t(spark, d, "part").select("p_partkey", "p_name", "p_size")
    staged = live.filter("p_partkey % 7 = 0").select("p_partkey", F.concat(F.lit("S-"), "p_name").alias("p_name"), F.when(F.col("p_partkey") % 14 == 0, 0).alias("p_size"))
    return ops.overlay(live, staged, ["p_partkey"])


NEW = "(o_orderdate >= '1999-12-01')"


@query("build_patch", f"SELECT * FROM (SELECT key, o_orderkey AS item_id FROM ({PAIRS_SQL})) WHERE item_id IN (SELECT o_orderkey FROM orders WHERE {NEW})")
def build_patch(spark, d):
    """The postings that the last month's orders add."""
    return facets.facet_members(order_items(spark, d).filter(NEW), "o_orderkey", DOMAINS).withColumnRenamed("o_orderkey", "item_id")


@query("apply_patch", f"SELECT k.key, count(p.o_orderkey) AS n FROM ({KEYS_SQL}) k LEFT JOIN ({PAIRS_SQL}) p USING (key) GROUP BY k.key")
def apply_patch(spark, d):
    """Posting lists of the older orders, and the patch of the newer ones merged in twice: the counts of a full rebuild."""
    lists = lambda some: facets.facet_lists(order_items(spark, d).filter(some), "o_orderkey", DOMAINS)
    old, patch = lists(f"{NEW} is not true"), lists(NEW)
    return facets.list_counts(facets.merge_lists(facets.merge_lists(old, patch), patch), facets.facet_keys(spark, DOMAINS))


@query("apply_correction", "WITH b AS (SELECT p_brand AS key, count(*) AS n FROM part WHERE p_size < 5 GROUP BY 1), x AS (SELECT p_brand AS key, count(*) FILTER (p_partkey % 7 = 0) AS a, count(*) FILTER (p_partkey % 7 IN (1, 2)) AS r FROM part GROUP BY 1) SELECT key, greatest(coalesce(n, 0) + a - r, 0) AS n FROM b FULL JOIN x USING (key)")
def apply_correction(spark, d):
    """Counts by brand; the corrections remove more than there is of some."""
    p = t(spark, d, "part").withColumnRenamed("p_brand", "key")
    diff = p.filter("p_partkey % 7 < 3").select("key", F.when(F.col("p_partkey") % 7 == 0, "add").otherwise("remove").alias("change"))
    return ops.apply_correction(p.filter("p_size < 5").groupBy("key").agg(F.count("*").alias("n")), diff)


@query("merge_search", f"WITH h AS (SELECT * FROM {HITS} WHERE NOT regexp_matches(name, '[./#$\\[\\]]')) SELECT lang, name, coalesce(arg_min(is_label, pos * 10 + hit_pos) FILTER (pos % 3 <> 0), arg_min(is_label, pos * 10 + hit_pos)) AS is_label, list_sort(list(DISTINCT item_id)) AS ids FROM h GROUP BY lang, name")
def merge_search(spark, d):
    """Two thirds of the parts indexed, and the rest merged in."""
    tr = part_translations(spark, d)
    index = lambda rows: search.search_index(search.name_hits(rows))
    return ops.merge_search(index(tr.filter("pos % 3 <> 0")), index(tr.filter("pos % 3 = 0")))


@query("merge_translation_draft", "SELECT p_partkey AS item_id, CASE WHEN p_partkey % 4 = 0 THEN upper(p_name) ELSE p_name END AS label, CASE WHEN p_partkey % 4 = 0 THEN [p_type] ELSE [p_brand] END AS names, CASE WHEN p_partkey % 4 = 0 THEN 'd' ELSE 'l' END AS flower, CASE WHEN p_partkey % 4 = 0 AND p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 4 = 0 AND p_partkey % 3 = 1 THEN 'set' ELSE 'live' END AS toxicity FROM part")
def merge_translation_draft(spark, d):
    p, k = t(spark, d, "part"), F.col("p_partkey")
    live = p.select(k.alias("item_id"), F.col("p_name").alias("label"), F.array("p_brand").alias("names"), F.lit("l").alias("flower"), F.lit("live").alias("toxicity"))
    draft = p.filter(k % 4 == 0).select(k.alias("item_id"), F.upper("p_name").alias("label"), F.array("p_type").alias("names"), F.lit("d").alias("flower"), F.when(k % 3 == 1, "set").otherwise("").alias("toxicity"), (k % 3 != 2).alias("has_toxicity"))
    return ops.merge_translation_draft(live, draft, ["flower"], ["toxicity"])


@query("rename_key", "SELECT p_partkey, p_brand FROM part UNION ALL SELECT p_partkey, 'Brand#new' FROM part WHERE p_brand = 'Brand#7'")
def rename_key(spark, d):
    return ops.rename_key(t(spark, d, "part").select("p_partkey", "p_brand"), "p_brand", "Brand#7", "Brand#new")


@query(
    "validate_packets",
    f"""SELECT k AS item_id, array_to_string(list_filter([CASE WHEN fam = '' THEN 'no family' END, CASE WHEN k % 2 = 1 THEN 'no id' END, CASE WHEN k % 3 = 1 THEN 'no map file' END], lambda x: x IS NOT NULL), ',') AS errors,
      CASE WHEN len(needs) > 0 THEN 'needs review' ELSE '' END AS warnings, fam <> '' AND k % 6 IN (0, 2) AS ok FROM (SELECT *, {NEEDS} AS needs FROM {ITEMS})""",
)
def validate_packets(spark, d):
    """Built records with their traits put in, and rules; of every third part there is no map file."""
    rows = records.apply_inference(records.build_records(resolved(spark, d)), traits(spark, d)).withColumn("map", F.concat(F.lit("m"), "item_id"))
    files = t(spark, d, "part").filter("p_partkey % 3 <> 1").select(F.concat(F.lit("m"), "p_partkey").alias("path"))
    out = ops.validate_packets(rows, files, {"no family": F.col("header.family") == "", "no id": F.col("detail.gbifId").isNull()}, {"needs review": F.size("job.needs") > 0}, "map")
    return out.select("item_id", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"), "ok")


PACKET_ERRORS = """[CASE WHEN k % 17 = 0 THEN 'no accepted name' END, CASE WHEN k % 19 = 0 THEN 'no id' END, CASE WHEN k % 6 = 0 OR p_size % 7 NOT BETWEEN 1 AND 5 THEN 'color codes missing or not in 1-5' END,
  CASE WHEN p_size % 8 NOT BETWEEN 1 AND 6 THEN 'habitat codes missing or not in 1-6' END, CASE WHEN k % 9 = 0 THEN 'petal codes missing or not in 1-4' END, CASE WHEN k % 8 = 0 THEN 'no regions' END,
  CASE WHEN k % 8 <> 0 AND k % 12 > 9 THEN 'unknown region ' || k % 12 END, CASE WHEN k % 8 <> 0 AND p_size % 13 > 9 THEN 'unknown region ' || p_size % 13 END,
  CASE WHEN k % 10 = 0 OR p_size % 5 < 3 THEN 'fewer than 3 photos' WHEN k % 4 = 0 THEN 'first photo shows no flower' END, CASE WHEN k % 7 = 0 THEN 'no illustration' END, CASE WHEN k % 5 <> 0 AND k % 3 = 1 THEN 'no distribution map' END]"""
PACKET_WARNINGS = """[CASE WHEN k % 13 = 0 THEN 'w' END, CASE WHEN k % 4 <> 3 AND p_size % 2 = 0 THEN 'color: confidence ' || printf('%.2f', p_size / 50.0) || ' is too low' END, CASE WHEN k % 5 = 0 THEN 'no ipni id' END,
  CASE WHEN k % 3 = 0 THEN 'english lacks leaf' END, CASE WHEN k % 14 = 0 THEN 'names without a source: en=' || p_brand || ', de=x' END, CASE WHEN k % 11 = 0 THEN 'already in the catalog' END]"""


@query("validate_job_packets", f"SELECT k AS item_id, list_filter({PACKET_ERRORS}, lambda x: x IS NOT NULL) AS errors, list_filter({PACKET_WARNINGS}, lambda x: x IS NOT NULL) AS warnings, len(errors) = 0 AS ok FROM (SELECT *, p_partkey AS k FROM part)")
def validate_job_packets(spark, d):
    """Parts as packets, each rule broken by some; of every third part there is no map, and only ten nations are regions."""
    k, size, none = F.col("p_partkey"), F.col("p_size"), F.array().cast("array<int>")
    texts = F.map_from_arrays(F.array(*map(F.lit, ops.ENGLISH_TEXTS)), F.array(*[F.when(k % 3 == 0, "").otherwise("t") if f == "leaf" else F.lit("t") for f in ops.ENGLISH_TEXTS]))
    trait = F.struct((size % 2 == 1).alias("ok"), (size / 50).alias("confidence"))
    packets = t(spark, d, "part").select(
        k.alias("item_id"), F.when(k % 17 != 0, F.col("p_name")).otherwise("").alias("name"), F.when(k % 19 != 0, k).alias("id"), F.when(k % 6 != 0, F.array((size % 7).cast("int"))).otherwise(none).alias("color"), F.array(F.lit(1), (size % 8).cast("int")).alias("habitat"),
        F.when(k % 9 != 0, F.array((1 + size % 4).cast("int"), F.lit(2))).alias("petal"), F.when(k % 8 != 0, F.array((k % 12).cast("int"), (size % 13).cast("int"))).otherwise(none).alias("region"), F.slice(F.array(F.when(k % 4 == 0, "leaf").otherwise("flower"), F.lit("leaf"), F.lit("fruit"), F.lit("habit")), F.lit(1), (size % 5).cast("int")).alias("roles"),
        F.when(k % 10 != 0, "ok").alias("photo_status"), (k % 7 != 0).alias("illustration_ok"), F.when(k % 5 != 0, "d").alias("folder"), F.concat(F.lit("m"), k).alias("map_file"), F.when(k % 5 != 0, "i").otherwise("").alias("ipni_id"), texts.alias("english"), F.when(k % 4 != 3, F.create_map(F.lit("color"), trait)).alias("traits"),
        F.when(k % 14 == 0, F.array(F.concat(F.lit("en="), "p_brand"), F.lit("de=x"))).alias("unsourced"), F.when(k % 13 == 0, F.array(F.lit("w"))).alias("notes"), (k % 11 == 0).alias("known"),
    )
    files = t(spark, d, "part").filter("p_partkey % 3 <> 1").select(F.concat(F.lit("m"), "p_partkey").alias("path"))
    regions = t(spark, d, "nation").filter("n_nationkey < 10").select(F.col("n_nationkey").cast("int").alias("code"))
    return ops.validate_job_packets(packets, files, regions)


PHOTOS = "(SELECT l_orderkey AS item_id, l_linenumber AS slot, 'f' || l_partkey || '.webp' AS file, 's' || l_suppkey % 5 AS source, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, 'f' || l_partkey || '.webp', l_suppkey % 5) AS n FROM lineitem)"


@query("apply_media_to_records", f"WITH p AS (SELECT item_id, list(file ORDER BY n) AS f, list(source ORDER BY n) AS s FROM {PHOTOS} GROUP BY item_id) SELECT o_orderkey AS item_id, coalesce(list_transform(f, lambda x: o_orderstatus || '/' || x), []) AS photo_urls, o_orderstatus || '/' || f[1] AS url, list_transform(list_filter(list_zip(list_append(coalesce(s, []), 's1'), range(1, len(coalesce(s, [])) + 2)), lambda x: list_position(list_append(coalesce(s, []), 's1'), x[1]) = x[2]), lambda x: x[1]) AS source_urls, CASE WHEN f IS NULL THEN 'photos' ELSE '' END AS needs FROM orders LEFT JOIN p ON item_id = o_orderkey")
def apply_media_to_records(spark, d):
    """Order lines as photos of orders."""
    photos = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("item_id"), F.col("l_linenumber").alias("slot"), F.concat(F.lit("f"), "l_partkey", F.lit(".webp")).alias("file"), F.concat(F.lit("s"), (F.col("l_suppkey") % 5).cast("string")).alias("source"))
    records = t(spark, d, "orders").select(F.col("o_orderkey").alias("item_id"), F.col("o_orderstatus").alias("folder"), F.array(F.lit("s1")).alias("source_urls"))
    return ops.apply_media_to_records(records, photos)


@query("official_media_files", "SELECT p_partkey AS item_id, p FROM part, unnest([p_name || '.webp', p_name || '@400.webp', 'thumb/' || p_name || '.webp', 'thumb/' || p_name || '@400.webp']) AS x(p) WHERE (p NOT LIKE 'thumb/%' AND p NOT LIKE '%@%') OR (p LIKE 'thumb/%' AND p LIKE '%@400%' AND p_name LIKE 'r%')".replace("AS item_id, p FROM", "AS item_id, p AS path FROM"))
def official_media_files(spark, d):
    """Of each part's files the plates, and of red ones small thumbnails, are in the listing."""
    p = t(spark, d, "part")
    files = p.select(F.concat("p_name", F.lit(".webp")).alias("path")).unionByName(p.filter("p_name like 'r%'").select(F.concat(F.lit("thumb/"), "p_name", F.lit("@400.webp")).alias("path")))
    return ops.official_media_files(p.select(F.col("p_partkey").alias("item_id"), F.array(F.concat("p_name", F.lit(".webp")), F.concat("p_name", F.lit("@400.webp"))).alias("names")), files)


def jobs(spark, d):
    k = F.col("s_suppkey")
    return t(spark, d, "supplier").select(k.alias("job_id"), F.col("s_name").alias("latin"), F.concat(F.lit("app://x/"), k, F.when(k % 3 == 0, "?a=1").when(k % 3 == 1, "?lang=en").otherwise("")).alias("uri"))


def copy(spark, d):
    k = F.col("s_suppkey")
    return t(spark, d, "supplier").select(k.alias("job_id"), F.explode(F.array(F.lit("en"), F.lit("no"))).alias("lang"), F.when(k % 2 == 0, F.concat(F.lit("L"), k)).alias("label"), F.when(k % 5 == 0, "Look: Catalog").when(k % 5 == 1, "Look").alias("title"), F.when(k % 4 == 0, "B").otherwise("").alias("body"))


LANGS = "(SELECT DISTINCT CASE n_nationkey % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'no' ELSE 'sk' END AS lang FROM nation)"


def languages(spark, d):
    k = F.col("n_nationkey") % 3
    return t(spark, d, "nation").select(F.when(k == 0, "en").when(k == 1, "no").otherwise("sk").alias("lang")).distinct()


@query(
    "localized_messages",
    f"""SELECT job_id, lang, topic, CASE WHEN title LIKE '%Catalog' THEN title ELSE title || ' - Catalog' END AS title, CASE WHEN has AND job_id % 4 = 0 THEN 'B' ELSE s_name END AS body,
      CASE job_id % 3 WHEN 1 THEN 'app://x/' || job_id || '?lang=en' WHEN 0 THEN 'app://x/' || job_id || '?a=1&lang=' || lang ELSE 'app://x/' || job_id || '?lang=' || lang END AS uri
    FROM (SELECT s_suppkey AS job_id, s_name, lang, lang <> 'sk' AS has, unnest(CASE lang WHEN 'no' THEN ['no', 'nb'] ELSE [lang] END) AS topic,
      CASE WHEN lang <> 'sk' AND s_suppkey % 5 = 0 THEN 'Look: Catalog' WHEN lang <> 'sk' AND s_suppkey % 5 = 1 THEN 'Look' ELSE 'New: ' || CASE WHEN lang <> 'sk' AND s_suppkey % 2 = 0 THEN 'L' || s_suppkey ELSE s_name END END AS title FROM supplier, {LANGS})""",
)
def localized_messages(spark, d):
    topics = languages(spark, d).filter("lang = 'no'").select("lang", F.explode(F.array(F.lit("no"), F.lit("nb"))).alias("topic"))
    return ops.localized_messages(jobs(spark, d), languages(spark, d), copy(spark, d), topics)


@query("missing_copy", "SELECT s_suppkey AS job_id, 'sk' AS lang FROM supplier")
def missing_copy(spark, d):
    return ops.missing_copy(jobs(spark, d), languages(spark, d), copy(spark, d))
