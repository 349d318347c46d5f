"""Checklist and name queries: parts as checklist names, suppliers and customers as distribution, documents and pages as sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalens.operators import names
from catalens.plans.registry import query


def checklist(spark: SparkSession, d: str) -> DataFrame:
    """Parts as names ``p_name size``: promo parts are accepted, standard ones synonyms, and point to the part a third as far on."""
    p, k = spark.read.parquet(f"{d}/part.parquet"), F.col("p_partkey")
    status = F.when(F.col("p_type") == "PROMO", "Accepted").when(F.col("p_type") == "STANDARD", "Synonym").otherwise("Unplaced")
    return p.select(k.alias("name_id"), F.concat_ws(" ", F.initcap("p_name"), (F.col("p_size") % 8).cast("string")).alias("name"), status.alias("status"), F.when(F.col("p_size") % 2 == 0, "Species").otherwise("Variety").alias("rank"), F.when(k % 5 != 0, F.floor(k / 3) + F.when(k % 97 == 0, 10_000_000).otherwise(0)).alias("accepted_id"))


CHECK = """(SELECT p_partkey AS name_id, (SELECT string_agg(upper(x[1]) || x[2:], ' ') FROM (SELECT unnest(string_split(p_name, ' ')) AS x)) || ' ' || p_size % 8 AS name, lower(p_name) || ' ' || p_size % 8 AS norm,
  CASE p_type WHEN 'PROMO' THEN 'Accepted' WHEN 'STANDARD' THEN 'Synonym' ELSE 'Unplaced' END AS status, CASE WHEN p_size % 2 = 0 THEN 'Species' ELSE 'Variety' END AS rank,
  CASE WHEN p_partkey % 5 <> 0 THEN p_partkey // 3 + CASE WHEN p_partkey % 97 = 0 THEN 10000000 ELSE 0 END END AS accepted_id FROM part)"""
ASKED = "(SELECT DISTINCT '  ' || upper(p_name) || '  ' || p_size % 8 AS query, lower(p_name) || ' ' || p_size % 8 AS norm FROM part WHERE p_size < 40)"
RESOLVED = f"""(WITH n AS {CHECK}, b AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY norm ORDER BY CASE status WHEN 'Accepted' THEN 2 WHEN 'Synonym' THEN 1 ELSE 0 END DESC, rank = 'Species' DESC, name_id) = 1)
  SELECT q.query, b.name_id AS hit_id, CASE WHEN b.status = 'Accepted' OR b.accepted_id IS NULL OR b.accepted_id NOT IN (SELECT name_id FROM n) THEN b.name_id ELSE b.accepted_id END AS name_id FROM {ASKED} q JOIN b USING (norm))"""
SYNONYMS = f"(SELECT accepted_id AS name_id, list(name ORDER BY name_id) AS synonyms FROM {CHECK} WHERE status = 'Synonym' AND accepted_id <> name_id GROUP BY accepted_id)"


def asked(spark, d):
    return spark.read.parquet(f"{d}/part.parquet").filter("p_size < 40").select(F.concat(F.lit("  "), F.upper("p_name"), F.lit("  "), (F.col("p_size") % 8).cast("string")).alias("query")).distinct()


def distribution(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers' nations as native areas and customers' as introduced ones of the parts whose key is theirs; some extinct or doubtful."""
    n = spark.read.parquet(f"{d}/nation.parquet")
    part = lambda t, key, nation, introduced: spark.read.parquet(f"{d}/{t}.parquet").join(n, F.col(nation) == F.col("n_nationkey")).select((F.col(key) % 300).alias("name_id"), F.col("n_regionkey").alias("l2"), F.col("n_name").alias("l3"), F.lit(introduced).alias("introduced"), (F.col(key) % 11 == 0).alias("extinct"), (F.col(key) % 13 == 0).alias("doubtful"), F.col(key).alias("pos"))
    return part("supplier", "s_suppkey", "s_nationkey", False).unionByName(part("customer", "c_custkey", "c_nationkey", True))


DIST = """(SELECT s_suppkey % 300 AS name_id, n_regionkey AS l2, n_name AS l3, false AS introduced, s_suppkey AS pos FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 11 <> 0 AND s_suppkey % 13 <> 0
  UNION ALL SELECT c_custkey % 300, n_regionkey, n_name, true, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 11 <> 0 AND c_custkey % 13 <> 0)"""
SETS = f"""(SELECT name_id, list_sort(list(DISTINCT l2)) AS l2, list(l3 ORDER BY introduced, pos, l3) AS l3, coalesce(list_sort(list(DISTINCT l2) FILTER (NOT introduced)), []) AS native_l2, coalesce(list_sort(list(DISTINCT l2) FILTER (introduced)), []) AS introduced_l2 FROM {DIST} GROUP BY name_id)"""


@query("resolve_accepted_name", f"SELECT * FROM {RESOLVED}")
def resolve_accepted_name(spark, d):
    return names.resolve_accepted_name(asked(spark, d), checklist(spark, d))


@query("best_name_row", f"SELECT norm, name_id FROM {CHECK} QUALIFY row_number() OVER (PARTITION BY norm ORDER BY CASE status WHEN 'Accepted' THEN 2 WHEN 'Synonym' THEN 1 ELSE 0 END DESC, rank = 'Species' DESC, name_id) = 1")
def best_name_row(spark, d):
    rows = checklist(spark, d).withColumn("norm", names.normalize_name(F.col("name")))
    return names.best_name_row(rows).select("norm", "name_id")


@query("synonym_list", f"SELECT * FROM {SYNONYMS}")
def synonym_list(spark, d):
    return names.synonym_list(checklist(spark, d))


@query("region_union", f"SELECT name_id, l2, native_l2, introduced_l2, l3 FROM {SETS}")
def region_union(spark, d):
    return names.distribution_sets(distribution(spark, d))


@query(
    "checklist_lookup",
    f"""SELECT r.query, r.hit_id, r.name_id, n.name AS accepted_name, coalesce(l2, []) AS l2, coalesce(native_l2, []) AS native_l2, coalesce(introduced_l2, []) AS introduced_l2, coalesce(l3, []) AS l3, coalesce(synonyms, []) AS synonyms
    FROM {RESOLVED} r JOIN {CHECK} n USING (name_id) LEFT JOIN {SETS} s USING (name_id) LEFT JOIN {SYNONYMS} y USING (name_id)""",
)
def checklist_lookup(spark, d):
    return names.checklist_lookup(asked(spark, d), checklist(spark, d), distribution(spark, d))


@query(
    "region_rollup_join",
    """WITH v AS (SELECT o_orderkey AS item_id, unnest([CASE o_custkey % 3 WHEN 0 THEN ' n' || c_nationkey WHEN 1 THEN 'nation_' || c_nationkey ELSE 'nowhere' END, 'NATION_' || o_orderkey % 30]) AS value FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT item_id, coalesce(list_sort(list(DISTINCT coalesce(a.n_regionkey, b.n_regionkey)) FILTER (coalesce(a.n_regionkey, b.n_regionkey) IS NOT NULL)), []) AS l2 FROM v LEFT JOIN nation a ON upper(trim(value)) = 'N' || a.n_nationkey LEFT JOIN nation b ON lower(trim(value)) = lower(b.n_name) GROUP BY item_id""",
)
def region_rollup_join(spark, d):
    """Areas of orders, as codes or names, to regions."""
    o, c = spark.read.parquet(f"{d}/orders.parquet"), spark.read.parquet(f"{d}/customer.parquet")
    code = F.when(F.col("o_custkey") % 3 == 0, F.concat(F.lit(" n"), "c_nationkey")).when(F.col("o_custkey") % 3 == 1, F.concat(F.lit("nation_"), "c_nationkey")).otherwise("nowhere")
    values = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("item_id"), F.explode(F.array(code, F.concat(F.lit("NATION_"), F.col("o_orderkey") % 30))).alias("value"))
    regions = spark.read.parquet(f"{d}/nation.parquet").select(F.concat(F.lit("N"), "n_nationkey").alias("code"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("l2"))
    return names.region_rollup(values, regions)


@query("id_override_join", "SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_custkey % 4 = 0 AND o_custkey IN (SELECT c_custkey FROM customer) THEN o_custkey + 1000000 ELSE o_custkey END AS cust FROM orders")
def id_override_join(spark, d):
    rows = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_custkey")).alias("cust"))
    over = spark.read.parquet(f"{d}/customer.parquet").filter("c_custkey % 4 = 0").select(F.col("c_custkey").alias("old_id"), (F.col("c_custkey") + 1_000_000).alias("new_id"))
    return names.id_override(rows, over, "cust").select("o_orderkey", "cust")


@query(
    "resolve_entities",
    """WITH q AS (SELECT DISTINCT p_partkey AS k, p_name || ' ' || p_partkey AS name, p_brand, p_type, p_size FROM part), r AS (SELECT *, k % 2 = 0 AS c, k % 3 = 0 AS e, k % 5 <> 0 AS m, k % 7 = 0 AS i FROM q)
    SELECT name, CASE WHEN c AND k % 4 <> 0 THEN p_brand WHEN m THEN p_type ELSE '' END AS family, CASE WHEN m AND p_size > 10 THEN p_type ELSE '' END AS ord,
      CASE WHEN c THEN 'G' || p_size WHEN m THEN 'H' || p_size ELSE split_part(name, ' ', 1) END AS genus, CASE WHEN c AND k % 8 = 0 THEN 'A' WHEN i THEN 'B' ELSE '' END AS author,
      CASE WHEN c AND k % 6 = 0 THEN 'c' || k WHEN i THEN 'i' || k WHEN e THEN 'e' || k ELSE '' END AS ipni_id, CASE WHEN e THEN 'g' || k WHEN m THEN '' || p_size END AS gbif_id, CASE WHEN e THEN 'Q' || k END AS qid,
      array_to_string(list_filter([CASE WHEN NOT c THEN 'checklist: name not found' WHEN k % 10 = 0 THEN 'checklist: empty distribution' END, CASE WHEN NOT e THEN 'entity: none' END, CASE WHEN NOT m THEN 'match: none' END, CASE WHEN NOT i AND NOT (c AND k % 6 = 0) THEN 'index: no id' END, CASE WHEN NOT (m AND p_size > 10) THEN 'order unknown' END], lambda x: x IS NOT NULL), '; ') AS warnings
    FROM r""",
)
def resolve_entities(spark, d):
    """Four sources that each know a part of the parts and leave some fields empty."""
    k = F.col("k")
    p = spark.read.parquet(f"{d}/part.parquet").withColumn("k", F.col("p_partkey")).withColumn("name", F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")))
    c = p.filter(k % 2 == 0).select("name", F.when(k % 4 != 0, F.col("p_brand")).otherwise("").alias("family"), F.concat(F.lit("G"), "p_size").alias("genus"), F.when(k % 8 == 0, "A").otherwise("").alias("author"), F.when(k % 6 == 0, F.concat(F.lit("c"), k)).alias("ipni_id"), F.when(k % 10 != 0, F.array(F.col("p_size"))).otherwise(F.array().cast("array<int>")).alias("l2"))
    e = p.filter(k % 3 == 0).select("name", F.concat(F.lit("e"), k).alias("ipni_id"), F.concat(F.lit("g"), k).alias("gbif_id"), F.concat(F.lit("Q"), k).alias("qid"))
    m = p.filter(k % 5 != 0).select("name", F.col("p_type").alias("family"), F.concat(F.lit("H"), "p_size").alias("genus"), F.when(F.col("p_size") > 10, F.col("p_type")).alias("ord"), F.col("p_size").alias("usage_key"))
    i = p.filter(k % 7 == 0).select("name", F.lit("B").alias("author"), F.concat(F.lit("i"), k).alias("ipni_id"))
    return names.resolve_entities(p.select("name"), c, e, m, i)


@query(
    "taxon_spine_join",
    """SELECT p_partkey, list_concat(['00_Genus=' || p_name], CASE WHEN p_size % 5 > 0 THEN ['01_Familia=' || p_brand] ELSE [] END,
      list_transform(CASE WHEN p_type IN ('SMALL', 'LARGE') THEN ['Ordo=' || p_type, 'Classis=r' || length(p_type), 'Regnum=all'] WHEN p_type = 'PROMO' THEN [] ELSE ['Ordo=' || p_type] END, lambda x, i: lpad('' || (i + CASE WHEN p_size % 5 > 0 THEN 1 ELSE 0 END), 2, '0') || '_' || x)) AS path FROM part""",
)
def taxon_spine_join(spark, d):
    """Part types as orders; two of them have a spine, derived from the types that occur."""
    p = spark.read.parquet(f"{d}/part.parquet")
    spines = p.select(F.col("p_type").alias("ord")).distinct().filter("ord in ('SMALL', 'LARGE')").select("ord", F.lit("Regnum/Classis/Ordo").alias("ranks"), F.concat(F.lit("all/r"), F.length("ord").cast("string"), F.lit("/"), "ord").alias("taxa"))
    rows = p.select("p_partkey", F.when(F.col("p_type") == "PROMO", "").otherwise(F.col("p_type")).alias("ord"), F.when(F.col("p_size") % 5 > 0, F.col("p_brand")).alias("family"), F.col("p_name").alias("genus"))
    return names.taxon_spine(rows, spines).select("p_partkey", "path")


@query(
    "already_in_catalog",
    """WITH c AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 0 THEN 'twin' ELSE c_name END AS name FROM customer WHERE c_custkey % 3 = 0), q AS (SELECT DISTINCT c_name AS name FROM customer UNION SELECT 'twin'),
      f AS (SELECT q.name, min(id) AS id FROM q LEFT JOIN c USING (name) GROUP BY q.name)
    SELECT name, CASE WHEN id IS NULL THEN (SELECT count(*) FROM c) + row_number() OVER (PARTITION BY id IS NULL ORDER BY lower(name[:2]), name) - 1 ELSE id END AS item_id, id IS NOT NULL AS known FROM f""",
)
def already_in_catalog(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet")
    catalog = c.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("item_id"), F.when(F.col("c_custkey") % 10 == 0, "twin").otherwise(F.col("c_name")).alias("name"))
    rows = c.select(F.explode(F.array(F.col("c_name"), F.lit("twin"))).alias("name")).distinct()
    return names.already_in_catalog(rows, catalog)


def entities(spark: SparkSession, d: str) -> DataFrame:
    """Parts as entities with labels, aliases and page URLs in several languages."""
    p = spark.read.parquet(f"{d}/part.parquet")
    return p.select(
        F.col("p_partkey").alias("item_id"), F.initcap("p_name").alias("latin"), F.array(F.col("p_type")).alias("synonyms"),
        F.create_map(F.lit("de"), F.initcap("p_name"), F.lit("en"), F.concat_ws(" ", F.lit("The"), "p_brand"), F.lit("fr"), F.lower("p_type")).alias("labels"),
        F.create_map(F.lit("en"), F.array(F.concat(F.lit("the  "), F.lower("p_brand")), F.concat(F.lit("Old "), "p_type"), F.concat("p_type", F.lit(" x"))), F.lit("de"), F.array(F.concat(F.lit("Altes Ding "), "p_size"))).alias("aliases"),
        F.create_map(F.lit("a"), F.concat(F.lit("https://sk.wikipedia.org/wiki/Vec_"), "p_size"), F.lit("b"), F.lit("https://www.wikipedia.org/wiki/None")).alias("wikipedia"),
    )


COLLECTED = """(SELECT item_id, lang, row_number() OVER (PARTITION BY item_id, lang ORDER BY pos)::INT AS n, name, source FROM (
  SELECT p_partkey AS item_id, u.* FROM part, unnest([{'pos': 1, 'lang': 'en', 'name': 'The ' || p_brand, 'source': 'entity'}, {'pos': 2, 'lang': 'de', 'name': 'Altes Ding ' || p_size, 'source': 'entity'},
    {'pos': 3, 'lang': 'en', 'name': 'Old ' || p_type, 'source': 'entity'}, {'pos': 4, 'lang': 'sk', 'name': 'Vec ' || p_size, 'source': 'title'}]) AS t(u) WHERE NOT (u.pos = 3 AND p_name LIKE 'old %')))"""


@query("name_collection", f"SELECT * FROM {COLLECTED}")
def name_collection(spark, d):
    """German labels are the scientific name and French ones a synonym, as names that begin with its first word, and drop out; the second alias repeats the English label."""
    return names.name_collection(names.entity_names(entities(spark, d)))


@query("translations_from_names", f"SELECT item_id, lang, list(name ORDER BY n)[1] AS label, list(name ORDER BY n)[2:] AS names FROM (SELECT item_id, lang, n, CASE lang WHEN 'de' THEN lower(name[1]) || name[2:] ELSE lower(name) END AS name FROM {COLLECTED}) GROUP BY item_id, lang")
def translations_from_names(spark, d):
    return names.translations_from_names(names.name_collection(names.entity_names(entities(spark, d))))


def old_translations(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet")
    return p.select(F.col("p_partkey").alias("item_id"), F.explode(F.array(F.lit("en"), F.lit("it"), F.lit("de-GT"))).alias("lang"), F.initcap("p_name").alias("latin"), F.when(F.col("p_size") % 3 == 0, F.upper("p_name")).when(F.col("p_size") % 3 == 1, F.lit("my label")).alias("label"), F.array(F.concat(F.lit("OLD "), F.col("p_type")), F.lit("mine")).alias("names"))


OLD = "(SELECT p_partkey AS item_id, unnest(['en', 'it', 'de-GT']) AS lang, p_name, CASE p_size % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN 'my label' END AS label, ['OLD ' || p_type, 'mine'] AS names, p_brand, p_type, p_size FROM part)"


@query(
    "merge_names_into_translations",
    f"""SELECT item_id, lang, CASE WHEN lang <> 'en' OR p_size % 3 = 1 THEN label ELSE 'the ' || lower(p_brand) END AS label, CASE WHEN lang = 'en' AND p_size % 3 = 1 THEN list_append(names, 'the ' || lower(p_brand)) ELSE names END AS names FROM {OLD}
    UNION ALL SELECT p_partkey, u.lang, u.label, [] FROM part, unnest([{{'lang': 'de', 'label': 'altes Ding ' || p_size}}, {{'lang': 'sk', 'label': 'vec ' || p_size}}]) AS t(u)""",
)
def merge_names_into_translations(spark, d):
    found = names.translations_from_names(names.name_collection(names.entity_names(entities(spark, d))))
    return names.merge_names_into_translations(old_translations(spark, d), found)


@query("unsourced_names", f"SELECT item_id, lang, value FROM (SELECT item_id, lang, p_name, p_brand, p_type, unnest(list_concat([label], names)) AS value FROM {OLD} WHERE lang <> 'de-GT') WHERE value IS NOT NULL AND lower(value) <> p_name AND NOT (lang = 'en' AND lower(value) IN ('the ' || lower(p_brand), CASE WHEN p_name NOT LIKE 'old %' THEN 'old ' || lower(p_type) END) IS TRUE)")
def unsourced_names(spark, d):
    return names.unsourced_names(old_translations(spark, d), names.name_collection(names.entity_names(entities(spark, d))))


_LINE = "CASE WHEN doc_id % 2 = 0 THEN regexp_extract(text, '\\S[^\\n]*') ELSE regexp_extract(string_split(text, chr(10))[-1], '\\S.*') END"


@query("labelled_line_extract", f"SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'cs' ELSE 'en' END AS lang, regexp_replace(x, '^[ .;]+|[ .;]+$', '', 'g') AS name, count(*) AS k FROM (SELECT doc_id, unnest(string_split(regexp_replace(replace({_LINE}, ';', ','), '\\([^)]*\\)', ',', 'g'), ',')) AS x FROM documents) WHERE length(regexp_replace(x, '^[ .;]+|[ .;]+$', '', 'g')) >= 3 AND NOT regexp_matches(regexp_replace(x, '^[ .;]+|[ .;]+$', '', 'g'), '^[0-9]+$') GROUP BY ALL")
def labelled_line_extract(spark, d):
    """Whole documents with a marker before the first line, blank or not, or before the last: that line as a list of names."""
    docs, first = spark.read.parquet(f"{d}/documents.parquet"), F.concat(F.lit("x\nČeská jména : "), "text")
    lines = F.split("text", "\n", -1)
    last = F.concat(F.array_join(F.slice(lines, F.lit(1), F.size(lines) - 1), "\n"), F.lit("\nCommon names: "), F.element_at(lines, -1))
    page = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, first).otherwise(last).alias("text"))
    cut = page.select(F.col("doc_id").alias("item_id"), F.lit("").alias("latin"), F.array().cast("array<string>").alias("synonyms"), "text")
    return names.page_names(cut).groupBy(F.col("item_id").alias("doc_id"), "lang", "name").agg(F.count("*").alias("k"))
