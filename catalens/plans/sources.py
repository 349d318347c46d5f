"""Source queries: raw rows, payloads and dumps that Spark puts together from the tables, read by the parsers; and a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalens.operators.catalog import counts_of
from catalens.plans.registry import query
from catalens.sources import catalog_dump, checklist, dumps, payloads
from catalens.sources.shared import listed_together, scratch, write_files
from catalens.streaming import patches


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


@query("scan_checklist_names", "SELECT p_partkey AS name_id, upper(p_name) AS name, p_name AS norm, coalesce(CASE WHEN p_size % 3 <> 0 THEN p_partkey // 2 END, p_partkey) AS accepted_id, CASE WHEN p_size % 2 = 0 THEN p_type ELSE '' END AS family FROM part WHERE p_partkey % 10 <> 0")
def scan_checklist_names(spark, d):
    """Parts as raw rows, every tenth without a name and some twice."""
    k = F.col("p_partkey")
    raw = t(spark, d, "part").withColumn("copy", F.explode(F.when(k % 5 == 0, F.array(F.lit("a"), F.lit(""))).otherwise(F.array(F.lit("a")))))
    raw = raw.select(k.cast("string").alias("plant_name_id"), F.when(k % 10 != 0, F.upper("p_name")).otherwise("").alias("taxon_name"), F.when(F.col("p_size") % 3 != 0, F.floor(k / 2).cast("string")).otherwise("").alias("accepted_plant_name_id"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).alias("family"), *[F.col("copy").alias(c) for c in checklist.NAME_COLUMNS if c != "family"])
    return checklist.checklist_names(raw).select("name_id", "name", "norm", "accepted_id", "family")


@query("scan_checklist_distribution", "SELECT c_custkey AS name_id, c_nationkey AS l2, c_custkey % 4 NOT IN (0, 1) AS introduced, c_custkey % 3 = 0 AS extinct, false AS doubtful FROM customer WHERE c_custkey % 6 > 1 AND c_custkey % 7 <> 0")
def scan_checklist_distribution(spark, d):
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    raw = t(spark, d, "customer").select(F.when(k % 7 != 0, k.cast("string")).alias("plant_name_id"), F.when(k % 6 == 0, "").when(k % 6 == 1, "x1").otherwise(n).alias("region_code_l2"), F.lit("A").alias("area_code_l3"), F.lit(None).cast("string").alias("area"), F.when(k % 4 == 0, "0").when(k % 4 == 1, " False").when(k % 4 == 2, "1").otherwise("yes").alias("introduced"), F.when(k % 3 == 0, "true").alias("extinct"), F.lit("").alias("location_doubtful"))
    return checklist.checklist_distribution(raw).select("name_id", "l2", "introduced", "extinct", "doubtful")


@query("scan_region_hierarchy", "WITH l AS (SELECT s_nationkey AS g, s_suppkey AS line, CASE WHEN s_suppkey % 3 = 0 THEN 'L2' WHEN s_suppkey % 3 = 1 THEN 'L3' ELSE 'L4' END AS level FROM supplier UNION ALL SELECT c_nationkey, c_custkey + 1000000, CASE WHEN c_custkey % 5 = 0 THEN 'L2' ELSE 'L3' END FROM customer), f AS (SELECT *, last_value(CASE WHEN level = 'L2' THEN line % 1000 END IGNORE NULLS) OVER (PARTITION BY g ORDER BY line ROWS UNBOUNDED PRECEDING)::INT AS l2 FROM l) SELECT 'C' || line % 50 AS code, arg_max('n' || line, line) AS name, arg_max(l2, line) AS l2 FROM f WHERE level = 'L3' AND l2 IS NOT NULL GROUP BY 1")
def scan_region_hierarchy(spark, d):
    """Suppliers and customers as lines of region files, one for each nation."""
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    a = t(spark, d, "supplier").select(F.col("s_nationkey").alias("g"), s.alias("line"), F.when(s % 3 == 0, "L2").when(s % 3 == 1, "L3").otherwise("L4").alias("level"))
    b = t(spark, d, "customer").select(F.col("c_nationkey").alias("g"), (c + 1_000_000).alias("line"), F.when(c % 5 == 0, "L2").otherwise("L3").alias("level"))
    n = F.col("line")
    lines = a.unionByName(b).withColumn("code", F.when(F.col("level") == "L2", (n % 1000).cast("string")).otherwise(text("c", n % 50))).withColumn("name", text("n", n))
    return checklist.region_hierarchy(lines, "g")


@query("normalize_plant_list", "SELECT l_orderkey AS o_orderkey, n - 1 AS item_id, 'p' || l_partkey AS name FROM (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS n FROM lineitem)")
def normalize_plant_list(spark, d):
    """Order lines as lists in three forms, by order."""
    names = F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: text("p", x["l_partkey"]))
    lists = t(spark, d, "lineitem").groupBy("l_orderkey").agg(names.alias("n"))
    array = F.to_json("n")
    keyed = F.to_json(F.map_concat(F.create_map(F.lit("count"), F.size("n").cast("string")), F.map_from_entries(F.transform("n", lambda x, i: F.struct(i.cast("string"), x)))))
    k = F.col("l_orderkey") % 3
    body = F.when(k == 0, array).when(k == 1, text('{"count":', F.size("n"), ',"list":', array, "}")).otherwise(keyed)
    return lists.select(F.col("l_orderkey").alias("o_orderkey"), F.explode(dumps.normalize_plant_list(body)).alias("e")).select("o_orderkey", "e.item_id", "e.name")


@query("scan_translations", "SELECT p_type AS lang, p_partkey AS pos, 'L' || p_partkey AS latin, p_name AS label, [p_brand] AS names FROM part")
def scan_translations(spark, d):
    """JSON objects keyed by name, in their own order."""
    rows = t(spark, d, "part").select("p_type", "p_partkey", text('{"L', F.col("p_partkey"), '":{"label":"', F.col("p_name"), '","names":["', F.col("p_brand"), '"]}}').alias("body"))
    e = rows.select(F.col("p_type").alias("lang"), F.col("p_partkey").alias("pos"), F.explode(dumps.json_entries(F.col("body"), "struct<label:string,names:array<string>>")).alias("e"))
    return e.select("lang", "pos", F.col("e.key").alias("latin"), "e.value.label", "e.value.names")


@query("scan_upload_list", "SELECT 500 + row_number() OVER (ORDER BY p_partkey) - 1 AS item_id, p_name AS name, [p_size, p_size + 1] AS codes FROM part WHERE p_partkey % 9 <> 0")
def scan_upload_list(spark, d):
    k = F.col("p_partkey")
    lines = t(spark, d, "part").select(k.alias("line"), F.when(k % 9 != 0, text(F.col("p_name"), " ; ", F.col("p_size"), " ,,", F.col("p_size") + 1)).otherwise("  ").alias("value"))
    return dumps.upload_list(lines, 500, ["name", "codes"], ["codes"])


@query("scan_message_copy", "SELECT s_suppkey, unnest(['en', 'sk']) AS lang, s_name AS title, unnest(['b', NULL]) AS body FROM supplier")
def scan_message_copy(spark, d):
    rows = t(spark, d, "supplier").select("s_suppkey", text('{"en":{"title":"', F.col("s_name"), '","body":"b"},"sk":{"title":"', F.col("s_name"), '"}}').alias("body"))
    return rows.select("s_suppkey", F.explode(dumps.message_copy(F.col("body"))).alias("e")).select("s_suppkey", "e.*")


@query("scan_media_listing", "SELECT url || CASE page_id % 5 WHEN 0 THEN '/a.JPG' WHEN 1 THEN '/a.webp' WHEN 2 THEN '/b-Illustration.png' WHEN 3 THEN '/a.txt' ELSE '/x.tiff' END AS path FROM pages WHERE page_id % 5 IN (0, 1, 4)")
def scan_media_listing(spark, d):
    k = F.col("page_id") % 5
    return dumps.media_listing(t(spark, d, "pages").select(F.concat("url", F.when(k == 0, "/a.JPG").when(k == 1, "/a.webp").when(k == 2, "/b-Illustration.png").when(k == 3, "/a.txt").otherwise("/x.tiff")).alias("path")))


@query("parse_entity_payloads", "SELECT p_name || ' ' || p_partkey AS name, 'Q' || p_partkey AS qid, p_name AS en, p_type AS alias, CASE WHEN p_size % 2 = 0 THEN 'http://x/' || p_partkey END AS page, '' || p_size AS ext, (p_size - 1)::DOUBLE AS low, (p_size + 2)::DOUBLE AS high FROM part")
def parse_entity_payloads(spark, d):
    k, s = F.col("p_partkey"), F.col("p_size")
    amount = lambda n: text('{"mainsnak":{"datavalue":{"value":{"amount":"+', n, '","unit":"1"}}}}')
    body = text('{"id":"Q', k, '","labels":{"en":{"value":"', F.col("p_name"), '"}},"aliases":{"de":[{"value":"', F.col("p_type"), '"}]},"sitelinks":{"', F.when(s % 2 == 0, "enwiki").otherwise("commonswiki2"), '":{"url":"http://x/', k, '"}},"claims":{"P1":[{"mainsnak":{"datavalue":{"value":"', s, '"}}}],"P2":[', amount(s + 2), ",", amount(s - 1), "]}}")
    e = payloads.parse_entities(t(spark, d, "part").select(text(F.col("p_name"), " ", k).alias("name"), body.alias("body")), {"ext": "P1"}, "P2")
    return e.select("name", "qid", F.col("labels")["en"].alias("en"), F.element_at(F.col("aliases")["de"], 1).alias("alias"), F.try_element_at("wikipedia", F.lit("en")).alias("page"), "ext", "low", "high")


@query("parse_name_search_payloads", "SELECT '' || p_partkey AS query, i AS pos, p_name AS name, 'i' || i || '-' || p_partkey AS ipni_id, p_size % 2 = 0 AS in_powo, CASE WHEN p_size % 3 <> 0 THEN p_partkey END AS usage_key FROM part, unnest([0, 1]) AS u(i)")
def parse_name_search_payloads(spark, d):
    """Id-search and match payloads of parts; some matched nothing."""
    k = F.col("p_partkey")
    one = lambda i: text('{"id":"i', str(i), "-", k, '","name":"', F.col("p_name"), '","inPowo":', F.when(F.col("p_size") % 2 == 0, "true").otherwise("false"), "}")
    rows = t(spark, d, "part").select(k.cast("string").alias("name"), text('{"results":[', one(0), ",", one(1), "]}").alias("body"), text('{"usageKey":', k, ',"matchType":"', F.when(F.col("p_size") % 3 == 0, "NONE").otherwise("EXACT"), '"}').alias("m"))
    match = payloads.parse_matches(rows.select("name", F.col("m").alias("body"))).select(F.col("name").alias("query"), "usage_key")
    return payloads.parse_id_search(rows.select("name", "body")).join(match, "query", "left")


@query("parse_media_payloads", "SELECT '' || p_partkey AS name, p_name AS title, 'u' || p_partkey AS url, p_size AS width, 'CC BY' AS license, true AS license_ok, 'a b' AS description FROM part WHERE p_size % 4 <> 0")
def parse_media_payloads(spark, d):
    k = F.col("p_partkey")
    info = text('[{"url":"u', k, '","mime":"image/png","width":', F.col("p_size"), ',"extmetadata":{"LicenseShortName":{"value":"<b>CC  BY</b>"},"ImageDescription":{"value":"<p>a<br>b</p>"}}}]')
    body = text('{"query":{"pages":{"1":{"title":"', F.col("p_name"), '","imageinfo":', F.when(F.col("p_size") % 4 == 0, "[]").otherwise(info), "}}}}")
    return payloads.parse_media(t(spark, d, "part").select(k.cast("string").alias("name"), body.alias("body"))).select("name", "title", "url", "width", "license", "license_ok", "description")


@query("parse_occurrence_media", "SELECT '' || o_custkey AS name, 'u' || o_orderkey % 7 AS url, arg_min(o_orderpriority, o_orderkey) AS license FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY ALL")
def parse_occurrence_media(spark, d):
    """A customer's orders as occurrences with media, URLs repeated."""
    k = F.col("o_orderkey")
    media = text('{"media":[{"identifier":"u', k % 7, '","type":"', F.when(k % 3 == 0, "Sound").otherwise("StillImage"), '","license":"', F.col("o_orderpriority"), '"}]}')
    rows = t(spark, d, "orders").groupBy("o_custkey").agg(F.transform(F.sort_array(F.collect_list(F.struct(k.alias("k"), media.alias("m")))), lambda x: x["m"]).alias("m"))
    return payloads.parse_occurrence_media(rows.select(F.col("o_custkey").cast("string").alias("name"), text('{"results":[', F.array_join("m", ","), "]}").alias("body"))).select("name", "url", "license")


@query("parse_names_table", "SELECT p_name || p_partkey AS name, 'en' AS lang, [p_brand || ' & co', p_type] AS names FROM part UNION ALL SELECT p_name || p_partkey, 'de', ['x''' || p_size] FROM part")
def parse_names_table(spark, d):
    row = lambda v, lang: text("<tr> <td>", v, "</td> <td class='l'>", lang, "</td>")
    name = text(F.col("p_name"), F.col("p_partkey"))
    body = text('<table id="tbcommon">', row(text(F.col("p_brand"), " &amp; co"), "English (UK)"), row(text("<i>", F.col("p_type"), "</i>"), " english"), row(F.col("p_type"), "English"), row(F.upper(name), "English"), row(text("x&#39;", F.col("p_size")), "German"), row(F.col("p_type"), "Klingon"), "</table><tr><td>no</td><td>English</td>")
    return payloads.parse_names_table(t(spark, d, "part").select(name.alias("name"), body.alias("body")), {"english": "en", "german": "de"})


@query("parse_gallery_pages", "WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\\b[^>]*href=\"([^\"]*)\"[^>]*>(.*?)</a>', 1)) AS href, unnest(regexp_extract_all(html, '(?is)<a\\b[^>]*href=\"([^\"]*)\"[^>]*>(.*?)</a>', 2)) AS txt FROM pages) SELECT page_id, count(*) AS links, count(DISTINCT href) AS targets, max(length(trim(regexp_replace(regexp_replace(txt, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))))::INT AS longest FROM l GROUP BY page_id")
def parse_gallery_pages(spark, d):
    """The anchors of the pages."""
    rows = payloads.links(t(spark, d, "pages").select(F.col("page_id").alias("key"), F.col("html").alias("body")))
    return rows.groupBy(F.col("key").alias("page_id")).agg(F.count("*").alias("links"), F.count_distinct("href").alias("targets"), F.max(F.length("text")).alias("longest"))


@query("gallery_species", "SELECT p_partkey AS item_id, p_partkey AS species_id, p_name || ' L.' AS label, p_size AS plates FROM part UNION ALL SELECT p_partkey, p_partkey + 3, p_name || ' b', 0 FROM part WHERE p_partkey % 3 = 0")
def gallery_species(spark, d):
    """Search pages of parts: two labels and a count, a variety, another name, and for every third a second species."""
    k, name = F.col("p_partkey"), F.col("p_name")
    link = lambda n, *inner: text('<a class="x" href="species.php?mobile=0&amp;id_species=', n, '">', *inner, "</a>")
    body = F.concat(link(k, name, " L. (1753)"), link(k, "<i>", name, "</i> L."), link(k, "[<strong>", F.col("p_size"), "</strong>]"), link(k + 1, name, " var. x"), link(k + 2, "another"), F.when(k % 3 == 0, link(k + 3, name, " b")).otherwise(""), text('<a href="about.php?id_species=1">', name, "</a>"))
    return payloads.gallery_species(t(spark, d, "part").select(k.alias("key"), F.upper(name).alias("wanted"), body.alias("body"))).withColumnRenamed("key", "item_id")


@query("gallery_plates", "SELECT p_partkey AS item_id, p_partkey + 1 AS plate_id, p_name || ' / ' || p_type || ', Curtis' AS title, p_type AS author, 4 AS score FROM part UNION ALL SELECT p_partkey, p_partkey + 2, p_name || ' / x, Curtis', 'x', 0 FROM part")
def gallery_plates(spark, d):
    """Gallery pages of parts: a thumbnail twice, others without a plate, a link to the same plate and one to another."""
    k, name = F.col("p_partkey"), F.col("p_name")
    image = text('<img title="', name, " / ", F.col("p_type"), ', Curtis" src="/a/ILLUSTRATIONS_thumbnails/', k + 1, '.jpg">')
    body = F.concat(image, image, text('<img src="/a/ILLUSTRATIONS_thumbnails/0.jpg"><img src="logo.png"><a href="illustration.php?id_illustration=', k + 1, '">again</a><a href="illustration.php?id_illustration=', k + 2, '">', name, " / x, Curtis</a>"))
    return payloads.gallery_plates(t(spark, d, "part").select(k.alias("key"), body.alias("body"))).withColumnRenamed("key", "item_id")


@query("parse_article_pages", "SELECT '' || p_partkey AS name, p_name || ', ' || p_type || ' a text' AS text FROM part WHERE p_size % 3 <> 0")
def parse_article_pages(spark, d):
    lang = F.when(F.col("p_size") % 3 == 0, "FI").otherwise("EN")
    body = text('{"articles":[{"language":"sv","html":"no"},{"language":"', lang, '","html":"<p>a</p> <b>text</b>","names":["', F.col("p_name"), '","', F.col("p_type"), '"]}]}')
    return payloads.parse_articles(t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("name"), body.alias("body")))


# ---- folders


def as_json(key, **fields):
    """A line of a dump: an object of one entry."""
    return F.to_json(F.map_from_arrays(F.array(key.cast("string")), F.array(F.struct(*[v.alias(k) for k, v in fields.items()])))).alias("value")


@query(
    "scan_catalog_dump",
    """SELECT 'list' AS node, NULL AS lang, '' || c_custkey AS key, c_name AS name, NULL AS more FROM customer UNION ALL SELECT 'headers', NULL, '' || c_custkey, c_name, c_mktsegment FROM customer
    UNION ALL SELECT 'details', NULL, '' || p_partkey, p_name, p_brand FROM part UNION ALL SELECT 'translations', l, '' || p_partkey, upper(p_name), l FROM part, unnest(['en', 'sk']) AS u(l)""",
)
def scan_catalog_dump(spark, d):
    """Customers and parts written as a dump and read back for all stages but one, whose file is broken and stays unopened."""
    path = scratch(spark, "dump")
    c, p = t(spark, d, "customer"), t(spark, d, "part")
    key = F.col("c_custkey")
    c.select(F.to_json(F.create_map(key.cast("string"), F.col("c_name"))).alias("value")).write.text(f"{path}/plants_to_update.json")
    c.select(as_json(key, name=F.col("c_name"), more=F.col("c_mktsegment"))).write.text(f"{path}/plants_headers.json")
    p.select(as_json(F.col("p_partkey"), name=F.col("p_name"), more=F.col("p_brand"))).write.text(f"{path}/plants_v2.json")
    for lang in ("en", "sk"):
        p.select(as_json(F.col("p_partkey"), name=F.upper("p_name"), more=F.lit(lang))).write.text(f"{path}/translations/{lang}.json")
    p.select(F.lit("{broken").alias("value")).write.text(f"{path}/apg_iv_v3.json")
    dump = catalog_dump.scan_catalog_dump(spark, path, ["counts", "search", "web"])
    out = catalog_dump.listed_items(dump).select(F.lit("list").alias("node"), F.lit(None).cast("string").alias("lang"), F.col("item_id").cast("string").alias("key"), "name", F.lit(None).cast("string").alias("more"))
    for node in ("headers", "details", "translations"):
        rows = catalog_dump.node_records(dump, node, "name string, more string")
        out = out.unionByName(rows.select(F.lit(node).alias("node"), "lang" if node == "translations" else F.lit(None).cast("string").alias("lang"), "key", "name", "more"))
    return out


@query(
    "scan_patch_dir",
    """SELECT s_suppkey AS item_id, replace(replace(s_name, '#', ' # '), '  ', ' ') AS latin, 'L' || s_suppkey AS label, CASE WHEN s_suppkey % 4 = 0 THEN 'leaf' WHEN s_suppkey % 4 = 1 THEN 'stem' ELSE '' END AS lacking, 0 AS batch FROM supplier WHERE s_suppkey % 7 <> 0""",
)
def scan_patch_dir(spark, d):
    """Suppliers as patch files, two of four without a field and every seventh hidden, streamed in twice: the second run finds nothing new."""
    path, k = scratch(spark, "patches"), F.col("s_suppkey")
    body = F.to_json(F.struct(text("L", k).alias("label"), F.when(k % 4 != 0, "l").alias("leaf"), F.when(k % 4 == 1, " ").otherwise("s").alias("stem")))
    name = text(F.when(k % 7 == 0, "_").otherwise(""), k, "_", F.replace("s_name", F.lit("#"), F.lit("_#_")), ".json")
    write_files(t(spark, d, "supplier").select(name.alias("path"), body.alias("body")), f"{path}/in")
    with listed_together(spark):
        for _ in range(2):
            patches.stream_patch_files(spark, f"{path}/in", "label string, leaf string, stem string", ["label", "leaf", "stem"], f"{path}/out", f"{path}/checkpoint", 1_000_000).awaitTermination()
    accepted, rejected = patches.patches_so_far(spark, f"{path}/out")
    return accepted.unionByName(rejected).select("item_id", "latin", "label", F.array_join("lacking", ",").alias("lacking"), "batch")


@query(
    "scan_job_packets",
    """SELECT replace(s_name, '#', ' ') AS packet, s_suppkey AS id, s_name AS name, CASE WHEN s_suppkey % 3 <> 0 THEN 'F' || s_nationkey END AS family, CASE WHEN s_suppkey % 5 <> 0 THEN 2 END AS synonyms,
      CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE 'de,en' END AS languages, CASE WHEN s_suppkey % 4 <> 0 THEN 'L' || s_suppkey END AS label,
      array_to_string(list_filter([CASE WHEN s_suppkey % 3 = 0 THEN 'plants_header' END, CASE WHEN s_suppkey % 5 = 0 THEN 'synonyms' END], lambda x: x IS NOT NULL), ',') AS lacking FROM supplier""",
)
def scan_job_packets(spark, d):
    """Suppliers as packets: a third with a broken header, a fifth without synonyms and a quarter without translations."""
    path, k = scratch(spark, "packets"), F.col("s_suppkey")
    file = lambda name, body, here=F.lit(True): F.when(here, F.struct(F.concat(F.replace("s_name", F.lit("#"), F.lit(" ")), F.lit(f"/{name}.json")).alias("path"), body.alias("body")))
    files = [
        file("job", F.to_json(F.struct(F.col("s_name").alias("accepted_name")))),
        file("plants_v2", F.to_json(F.struct(k.alias("id"), F.col("s_name").alias("name")))),
        file("plants_header", F.when(k % 3 == 0, "{no").otherwise(F.to_json(F.struct(text("F", F.col("s_nationkey")).alias("family"))))),
        file("synonyms", F.lit('{"ipni":[{"name":"a"},{"name":"b"}]}'), k % 5 != 0),
        file("translations/en", F.to_json(F.struct(text("L", k).alias("label"))), k % 4 != 0),
        file("translations/de", F.lit('{"names":["n"]}'), k % 4 != 0),
    ]
    write_files(t(spark, d, "supplier").select(F.explode(F.array_compact(F.array(*files))).alias("f")).select("f.*"), path)
    schemas = {"job": "accepted_name string", "plants_v2": "id long, name string", "plants_header": "family string", "synonyms": "ipni array<struct<name:string>>"}
    rows = dumps.scan_job_packets(spark, path, schemas)
    spoken = F.array_join(F.sort_array(F.map_keys("translations")), ",")
    return rows.select("packet", "plants_v2.id", F.col("job.accepted_name").alias("name"), "plants_header.family", F.size("synonyms.ipni").alias("synonyms"), spoken.alias("languages"), F.try_element_at("translations", F.lit("en"))["label"].alias("label"), F.array_join("lacking", ",").alias("lacking"))


# ---- streams


def event_stream(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "events")
    return spark.readStream.schema(rows.schema).parquet(f"{d}/event[s].parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def event_postings(rows: DataFrame) -> DataFrame:
    keys = F.array(F.lit("_"), text(F.col("event_type"), "_"), text("_", F.get_json_object("props", "$.k").cast("int") % 7), text(F.col("event_type"), "_", F.get_json_object("props", "$.k").cast("int") % 7))
    return rows.select(F.explode(keys).alias("key"), F.col("event_id").alias("item_id"))


@query("stream_apply_patch", "SELECT key, count(DISTINCT event_id) AS n FROM (SELECT event_id, unnest(['_', event_type || '_', '_' || ((props->>'$.k')::INT % 7), event_type || '_' || ((props->>'$.k')::INT % 7)]) AS key FROM events) GROUP BY key")
def stream_apply_patch(spark, d):
    """Events as a stream of changed items: the counts of a full rebuild once the stream is read to its end."""
    path = scratch(spark)
    stream = patches.latest_versions(event_stream(spark, d), "event_id", "event_type", "ts", "40 days")
    patches.stream_patches(stream, event_postings, f"{path}/postings", f"{path}/checkpoint").awaitTermination()
    members = patches.postings_so_far(spark, f"{path}/postings")
    return counts_of(members, members.select("key").distinct())


@query("stream_counts", "WITH c AS (SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL) SELECT * FROM c WHERE start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR")
def stream_counts(spark, d):
    """Hourly counts by type of the windows that are closed at the stream's end."""
    path = scratch(spark)
    patches.stream_counts(event_stream(spark, d), ["event_type"], "ts", "1 hour", "2 hours", f"{path}/counts", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/counts").select(F.to_timestamp_ntz(F.date_format("start", "yyyy-MM-dd HH:mm:ss")).alias("start"), "event_type", "n")
