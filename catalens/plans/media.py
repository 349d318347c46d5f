"""Media queries: order lines as candidate pictures of parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalens.operators import media as ops
from catalens.plans.registry import query


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def candidates(spark: SparkSession, d: str) -> DataFrame:
    """(item_id, pos, step, title, url, license, mime, width, height, description, object_name, categories, role_hint, latin)."""
    line, part = t(spark, d, "lineitem"), t(spark, d, "part")
    rows = line.join(part, F.col("l_partkey") == F.col("p_partkey"))
    k, q = F.col("l_orderkey"), F.col("l_quantity").cast("int")
    role = F.when(q % 6 == 0, "leaf").when(q % 6 == 1, "flower").when(q % 6 == 2, "fruit").when(q % 6 == 3, "habit").when(q % 6 == 4, "trunk")
    return rows.select(
        F.col("p_partkey").alias("item_id"), (((k * 10 + F.col("l_linenumber")) * 1000 + F.col("l_suppkey") % 1000) * 100 + q).alias("pos"), (k % 4).cast("int").alias("step"),
        F.concat(F.when(k % 3 == 0, F.initcap("p_name")).otherwise("view"), F.lit(" "), (k % 17).cast("string"), F.when(k % 23 == 0, "'x'").otherwise("")).alias("title"), F.concat(F.lit("u"), k.cast("string")).alias("url"),
        F.when(k % 5 == 0, "CC BY-NC 4.0").when(k % 5 == 1, "CC0").when(k % 5 == 2, "Public domain").otherwise("CC_BY-SA 4.0").alias("license"), F.when(q % 7 == 0, "image/gif").when(q % 2 == 0, "image/jpeg").otherwise("image/png").alias("mime"),
        (q * 60).alias("width"), (q * 45).alias("height"), F.when(k % 19 == 0, "a Herbarium sheet").otherwise(F.concat_ws("-", F.split("p_name", " "))).alias("description"), F.lit(None).cast("string").alias("object_name"), F.lit("c").alias("categories"),
        F.when(k % 4 != 1, role).alias("role_hint"), F.col("p_name").alias("latin"),
    )


CANDS = """(SELECT p_partkey AS item_id, ((l_orderkey * 10 + l_linenumber) * 1000 + l_suppkey % 1000) * 100 + l_quantity::INT AS pos, l_orderkey % 4 AS step, CASE WHEN l_orderkey % 3 = 0 THEN upper(p_name[1]) || p_name[2:strpos(p_name, ' ')] || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] ELSE 'view' END || ' ' || l_orderkey % 17 || CASE WHEN l_orderkey % 23 = 0 THEN '''x''' ELSE '' END AS title,
  l_orderkey AS k, l_quantity::INT AS q, p_name, CASE WHEN l_orderkey % 4 = 1 THEN NULL ELSE CASE l_quantity::INT % 6 WHEN 0 THEN 'leaf' WHEN 1 THEN 'flower' WHEN 2 THEN 'fruit' WHEN 3 THEN 'habit' WHEN 4 THEN 'trunk' END END AS role_hint FROM lineitem JOIN part ON l_partkey = p_partkey)"""
USABLE = "(k % 5 <> 0 AND q % 7 <> 0 AND q * 45 >= 400 AND k % 23 <> 0 AND k % 19 <> 0)"
SCORE = "(CASE WHEN k % 3 = 0 THEN 5 ELSE 0 END + CASE WHEN q * 60 >= 2000 THEN 3 WHEN q * 60 >= 1000 THEN 2 WHEN q * 60 >= 600 THEN 1 ELSE 0 END + CASE WHEN q % 2 = 0 AND q % 7 <> 0 THEN 1 ELSE 0 END + CASE WHEN role_hint IS NOT NULL THEN 2 ELSE 0 END)"
GATE = "(k % 3 = 0 OR k % 19 <> 0)"


@query("license_filter", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 5 IN (1, 2, 3)")
def license_filter(spark, d):
    k = F.col("l_orderkey") % 5
    name = F.when(k == 0, "CC BY-NC 4.0").when(k == 1, "CC0").when(k == 2, "Public_domain").when(k == 3, "cc-by-sa").otherwise("own licence, CC BY")
    return t(spark, d, "lineitem").filter(ops.license_ok(name)).select("l_orderkey", "l_linenumber")


@query("license_url_filter", "SELECT page_id FROM pages WHERE page_id % 4 < 2")
def license_url_filter(spark, d):
    k = F.col("page_id") % 4
    url = F.when(k == 0, "https://creativecommons.org/licenses/BY/4.0").when(k == 1, "https://x/publicdomain/zero/1.0").when(k == 2, "https://creativecommons.org/licenses/by-nc/4.0").otherwise(F.col("url"))
    return t(spark, d, "pages").filter(ops.license_ok_url(url)).select("page_id")


@query("media_usable", f"SELECT item_id, pos FROM {CANDS} WHERE {USABLE}")
def media_usable(spark, d):
    return candidates(spark, d).filter(ops.media_usable()).select("item_id", "pos")


@query("species_gate", f"SELECT item_id, pos FROM {CANDS} WHERE {GATE}")
def species_gate(spark, d):
    return candidates(spark, d).filter(ops.species_gate(F.col("latin"))).select("item_id", "pos")


@query("category_role", "SELECT p_partkey, CASE p_size % 7 WHEN 0 THEN 'trunk' WHEN 1 THEN 'flower' WHEN 2 THEN 'leaf' WHEN 3 THEN 'fruit' WHEN 4 THEN 'habit' END AS role FROM part")
def category_role(spark, d):
    k = F.col("p_size") % 7
    kind = F.when(k == 0, " (Bark and leaves)").when(k == 1, " Blossoms").when(k == 2, " foliage").when(k == 3, " seeds").when(k == 4, " (habit)").when(k == 5, " flowers in art").otherwise(" others")
    return t(spark, d, "part").select("p_partkey", ops.category_role(F.concat("p_name", kind)).alias("role"))


@query("media_score_rank", f"SELECT item_id, pos, {SCORE} AS score, row_number() OVER (PARTITION BY item_id ORDER BY {SCORE} DESC, pos)::INT AS n FROM {CANDS}")
def media_score_rank(spark, d):
    rows = candidates(spark, d).withColumn("score", ops.media_score(F.col("latin")))
    return rows.select("item_id", "pos", "score", F.expr("row_number() over (partition by item_id order by score desc, pos)").alias("n"))


_OK = f"(SELECT *, {SCORE} AS score FROM {CANDS} WHERE {USABLE} AND {GATE})"
_FIRST = "QUALIFY row_number() OVER (PARTITION BY item_id, title ORDER BY step, pos) = 1"
COLLECT = f"""(WITH ok AS {_OK}, b AS (SELECT * FROM ok WHERE step < 2 {_FIRST}), m AS (SELECT * FROM ok WHERE step = 2 AND NOT EXISTS (SELECT 1 FROM b WHERE b.item_id = ok.item_id AND b.role_hint = ok.role_hint)),
  f AS (SELECT * FROM (SELECT * FROM b UNION ALL SELECT * FROM m) {_FIRST}), l AS (SELECT * FROM ok WHERE step = 3 AND item_id NOT IN (SELECT item_id FROM f) {_FIRST}) SELECT * FROM f UNION ALL SELECT * FROM l)"""


@query("media_collect", f"SELECT item_id, title, pos, score, role_hint FROM {COLLECT}")
def media_collect(spark, d):
    return ops.media_collect(candidates(spark, d)).select("item_id", "title", "pos", "score", "role_hint")


def files(spark, d):
    return ops.media_collect(candidates(spark, d)).withColumn("file", F.concat(F.lit("f"), F.col("pos").cast("string"))).withColumn("path", F.lit(""))


def items(spark, d):
    return t(spark, d, "part").select(F.col("p_partkey").alias("item_id"), F.when(F.col("p_size") % 3 == 0, "small Tree").alias("lifeform"), F.when(F.col("p_size") % 3 == 1, F.array(F.lit(1), F.lit(6))).alias("codes"))


PACK = f"""(WITH r AS (SELECT item_id, role_hint AS role, 'f' || pos AS file, row_number() OVER (PARTITION BY item_id, role_hint ORDER BY score DESC, pos) AS r FROM {COLLECT} WHERE role_hint IS NOT NULL),
  b AS (SELECT item_id, max(file) FILTER (role = 'flower' AND r = 1) AS fl, max(file) FILTER (role = 'leaf' AND r = 1) AS le, max(file) FILTER (role = 'fruit' AND r = 1) AS fr, max(file) FILTER (role = 'habit' AND r = 1) AS ha, max(file) FILTER (role = 'trunk' AND r = 1) AS tr, max(file) FILTER (role = 'flower' AND r = 2) AS f2 FROM r GROUP BY item_id),
  s AS (SELECT p_partkey AS item_id, fl, f2, list_filter(['flower=' || fl, 'leaf=' || le, 'fruit=' || fr, 'habit=' || ha, CASE WHEN p_size % 3 < 2 THEN 'trunk=' || tr END], lambda x: x IS NOT NULL) AS a FROM part LEFT JOIN b ON item_id = p_partkey),
  u AS (SELECT item_id, fl, CASE WHEN len(a) < 3 AND f2 IS NOT NULL THEN list_append(a, 'flower=' || f2) ELSE a END AS a FROM s)
  SELECT item_id, CASE WHEN fl IS NULL THEN [] ELSE a[:5] END AS photos, CASE WHEN fl IS NULL OR len(a) < 3 THEN 'needs_review' ELSE 'ok' END AS status, CASE WHEN fl IS NULL THEN 'no flower or inflorescence photo' WHEN len(a) < 3 THEN 'fewer than 3 usable photos' ELSE '' END AS reason FROM u)"""


@query("media_pack", f"SELECT * FROM {PACK}")
def media_pack(spark, d):
    return ops.media_pack(files(spark, d), items(spark, d))


@query("media_fallback_union", f"SELECT item_id, 'u' || k AS url FROM {COLLECT} UNION ALL (SELECT DISTINCT item_id, 'u' || k FROM {CANDS} c WHERE k % 2 = 0 AND {GATE} AND item_id IN (SELECT item_id FROM {PACK} WHERE status <> 'ok') AND NOT EXISTS (SELECT 1 FROM {COLLECT} f WHERE f.item_id = c.item_id AND f.k = c.k))")
def media_fallback_union(spark, d):
    """The other source has every second candidate, of any licence."""
    first = files(spark, d)
    second = candidates(spark, d).filter("substr(url, 2) % 2 = 0").withColumn("score", F.lit(0)).withColumn("file", F.lit("")).withColumn("path", F.lit(""))
    return ops.media_fallback_union(first, second, ops.media_pack(first, items(spark, d))).select("item_id", "url")


@query("plate_score_rank", "SELECT p_partkey, author, score, row_number() OVER (PARTITION BY p_brand ORDER BY score DESC, p_partkey)::INT AS n FROM (SELECT *, p_type AS author, CASE p_size % 4 WHEN 0 THEN 7 WHEN 1 THEN 1 WHEN 2 THEN -2 ELSE 8 END AS score FROM part)")
def plate_score_rank(spark, d):
    k = F.col("p_size") % 4
    words = F.when(k == 0, "Curtis, hand-coloured").when(k == 1, "fig. 3").when(k == 2, "[outline]").otherwise("Flora Dan, Fl. Dan. Kerner [x] outline")
    words = F.when(k == 2, "outline").when(k == 3, "Curtis Kerner").otherwise(words)
    plates = t(spark, d, "part").select(F.col("p_brand").alias("item_id"), F.col("p_partkey").alias("plate_id"), F.concat("p_name", F.lit(" / "), "p_type", F.lit(", "), words).alias("title"))
    return ops.plate_rank(plates).select(F.col("plate_id").alias("p_partkey"), "author", "score", "n")


@query("species_hit_rank", "SELECT p_name AS query, arg_max(p_partkey, p_size * 1000000 - p_partkey) AS species_id FROM part GROUP BY p_name")
def species_hit_rank(spark, d):
    return ops.species_hit_rank(t(spark, d, "part").select(F.col("p_name").alias("query"), F.col("p_partkey").alias("species_id"), F.col("p_size").alias("plates"))).select("query", "species_id")


def hits(spark, d):
    k = F.col("p_partkey")
    return t(spark, d, "part").select(F.col("p_brand").alias("query"), k.alias("pos"), F.when(F.col("p_size") == 7, F.upper("p_brand")).otherwise(F.col("p_name")).alias("name"), F.when(k % 3 == 0, F.lit("a Plant")).alias("description"), (k % 4 == 0).alias("flag"), F.when(k % 5 == 0, F.lit("c")).alias("code"))


@query("taxon_hit_pick", "SELECT p_brand AS query, arg_min(p_partkey, CASE WHEN p_size = 7 THEN 0 ELSE 1000000000 END + CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 100000000 END + p_partkey) AS pos FROM part GROUP BY p_brand")
def taxon_hit_pick(spark, d):
    return ops.taxon_hit_pick(hits(spark, d).withColumnRenamed("name", "label")).select("query", "pos")


@query("id_hit_pick", "SELECT p_brand AS query, arg_min(p_partkey, CASE WHEN p_size = 7 THEN 0 ELSE 1000000000 END + CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE 100000000 END + p_partkey) AS pos FROM part GROUP BY p_brand")
def id_hit_pick(spark, d):
    return ops.id_hit_pick(hits(spark, d).withColumnRenamed("flag", "in_powo")).select("query", "pos")


@query("exact_hit_pick", "SELECT p_brand AS query, arg_min(p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE 100000000 END + p_partkey) AS pos FROM part WHERE p_size = 7 AND p_partkey % 3 <> 1 AND p_partkey % 5 = 0 GROUP BY p_brand")
def exact_hit_pick(spark, d):
    k = F.col("pos") % 3
    rows = hits(spark, d).withColumn("kind", F.when(k == 1, "virus").otherwise("Plant")).withColumn("scientific", F.when(k == 2, F.lit(True))).withColumnRenamed("flag", "preferred")
    return ops.exact_hit_pick(rows).select("query", "pos")
