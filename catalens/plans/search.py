"""Search-index queries: parts as items, their type as language, name as label, brand and others as further names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalens.operators import facets, search
from catalens.plans.facets import DOMAINS, PAIRS_SQL, order_items
from catalens.plans.registry import query

# ---- facets, continued


@query("facet_lists", f"SELECT key, o_orderkey // 4096 AS block, list_sort(list(o_orderkey)) AS ids FROM ({PAIRS_SQL}) GROUP BY key, block")
def facet_lists(spark, d):
    """The lists' blocks, encoded for storage and decoded."""
    lists = facets.read_lists(facets.stored_lists(facets.facet_lists(order_items(spark, d), "o_orderkey", DOMAINS, 4096)))
    return lists.select("key", "block", facets.list_ids(F.col("places"), F.col("block"), 4096).alias("ids"))


@query("facet_match", f"SELECT o_orderkey, '_F__1-URGENT' AS key FROM ({PAIRS_SQL}) WHERE key = '_F__1-URGENT' UNION ALL SELECT o_orderkey, 'R__P_' FROM ({PAIRS_SQL}) WHERE key = 'R__P_'")
def facet_match(spark, d):
    """Orders that match two keys, and none for a key of three parts, by the predicate itself."""
    keys = F.explode(F.array(F.lit("_F__1-URGENT"), F.lit("R__P_"), F.lit("R__P")))
    rows = order_items(spark, d).withColumn("key", keys)
    return rows.filter(facets.facet_match(F.col("key"), [F.col(a) for a in DOMAINS])).select("o_orderkey", "key")




@query(
    "facet_key_diff",
    f"""WITH b AS ({PAIRS_SQL}), a AS (SELECT * FROM b WHERE o_orderkey % 7 <> 0), c AS (SELECT * FROM b WHERE o_orderkey % 7 <> 1)
    SELECT o_orderkey, key, 'add' AS change FROM (SELECT * FROM c EXCEPT SELECT * FROM a) UNION ALL SELECT o_orderkey, key, 'remove' FROM (SELECT * FROM a EXCEPT SELECT * FROM c)""",
)
def facet_key_diff(spark, d):
    """From the orders without those divisible by 7 to the orders without those that leave 1."""
    rows = order_items(spark, d)
    return facets.facet_key_diff(rows.filter("o_orderkey % 7 <> 0"), rows.filter("o_orderkey % 7 <> 1"), "o_orderkey", DOMAINS)


# ---- names


def part_translations(spark: SparkSession, d: str) -> DataFrame:
    """(lang, pos, item_id, label, names): a label for all but every 9th part; a name with a dot for every 10th."""
    p = spark.read.parquet(f"{d}/part.parquet")
    return p.select(
        F.col("p_type").alias("lang"), F.col("p_partkey").alias("pos"), F.col("p_partkey").alias("item_id"),
        F.when(F.col("p_partkey") % 9 != 0, F.initcap("p_name")).alias("label"),
        F.array(F.col("p_brand"), F.when(F.col("p_partkey") % 10 == 0, F.concat("p_name", F.lit("."))).otherwise(F.upper("p_name")), F.lit("")).alias("names"),
    )


HITS = """(SELECT p_type AS lang, p_partkey AS pos, p_partkey AS item_id, u.hit_pos, u.name, u.hit_pos = 0 AS is_label FROM part,
  unnest([{'hit_pos': 0, 'name': CASE WHEN p_partkey % 9 <> 0 THEN lower(p_name) END}, {'hit_pos': 1, 'name': lower(p_brand)},
          {'hit_pos': 2, 'name': CASE WHEN p_partkey % 10 = 0 THEN lower(p_name) || '.' ELSE lower(p_name) END}]) AS t(u) WHERE u.name IS NOT NULL)"""


@query("search_index", f"SELECT lang, name, arg_min(is_label, pos * 10 + hit_pos) AS is_label, list_sort(list(DISTINCT item_id)) AS ids FROM {HITS} WHERE NOT regexp_matches(name, '[./#$\\[\\]]') GROUP BY lang, name")
def search_index(spark, d):
    return search.search_index(search.name_hits(part_translations(spark, d)))


@query("illegal_key_filter", f"SELECT lang, item_id, name FROM {HITS} WHERE regexp_matches(name, '[./#$\\[\\]]')")
def illegal_key_filter(spark, d):
    return search.search_warnings(search.name_hits(part_translations(spark, d)))


@query(
    "translation_catalog_semi",
    "SELECT p.p_type AS lang, p.p_name AS name, p.p_partkey AS pos, m.id AS item_id FROM part p JOIN (SELECT p_name, max(p_partkey) AS id FROM part WHERE p_size > 10 GROUP BY p_name) m USING (p_name) WHERE p.p_size <= 10",
)
def translation_catalog_semi(spark, d):
    """Names of small parts against a catalog of the larger ones: the last id of a name counts."""
    p = spark.read.parquet(f"{d}/part.parquet")
    rows = p.filter("p_size <= 10").select(F.col("p_type").alias("lang"), F.col("p_name").alias("name"), F.col("p_partkey").alias("pos"))
    return search.catalog_translations(rows, p.filter("p_size > 10").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"))).select("lang", "name", "pos", "item_id")


def part_catalog(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Items named ``name brand``, and their details: every 4th has another name of its own; synonyms are size and price."""
    p = spark.read.parquet(f"{d}/part.parquet").withColumn("name", F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")))
    detail = p.select("name", F.when(F.col("p_partkey") % 4 == 0, F.concat("p_brand", F.lit(" "), "p_type")).alias("detail_name"), F.array(F.concat(F.lit("Size "), "p_size"), F.concat(F.lit("v."), "p_size"), F.col("p_type")).alias("synonyms"))
    return p.select(F.col("p_partkey").alias("item_id"), "name"), detail


@query(
    "latin_search_index",
    """WITH h AS (SELECT p_partkey AS id, u.k, lower(u.name) AS name FROM part, unnest([
      {'k': 0, 'name': CASE WHEN p_partkey % 4 = 0 THEN p_brand || ' ' || p_type ELSE p_name || ' ' || p_partkey END}, {'k': 1, 'name': 'Size ' || p_size}, {'k': 3, 'name': p_type}]) AS t(u))
    SELECT 'la' AS lang, name, arg_min(k = 0, id * 10 + k) AS is_label, list_sort(list(DISTINCT id)) AS ids FROM h WHERE NOT regexp_matches(name, '[./#$\\[\\]]') GROUP BY name""",
)
def latin_search_index(spark, d):
    return search.search_index(search.latin_hits(*part_catalog(spark, d)))


def geography(spark: SparkSession, d: str) -> DataFrame:
    """Taxa of the nations' tree: regions (after their nations, as a walk leaves them), nations, and suppliers' count."""
    s = spark.read.parquet(f"{d}/supplier.parquet").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("count"))
    n = spark.read.parquet(f"{d}/nation.parquet").join(s, "n_nationkey", "left").withColumn("count", F.coalesce("count", F.lit(0)) + 0.5)
    r = spark.read.parquet(f"{d}/region.parquet")
    nations = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 5 == 4, "Regnum").otherwise("Genus").alias("rank"), "count", F.concat("r_name", F.lit("/"), "n_name", F.lit("/list")).alias("path"), (F.col("n_regionkey") * 1000 + F.col("n_nationkey")).alias("seq"), F.concat(F.lit("/m/"), (F.col("n_nationkey") % 7).cast("string"), F.lit(", /m/r"), "n_regionkey").alias("external"))
    regions = n.groupBy("n_regionkey").agg(F.sum("count").alias("count")).join(r, F.col("n_regionkey") == r["r_regionkey"]).select(F.col("r_name").alias("name"), F.lit("Ordo").alias("rank"), "count", F.concat("r_name", F.lit("/list")).alias("path"), (F.col("r_regionkey") * 1000 + 999).alias("seq"), F.concat(F.lit("/m/r"), F.col("r_regionkey").cast("string")).alias("external"))
    return nations.unionByName(regions)


TAXA = """(WITH s AS (SELECT n.*, r.r_name, count(s.s_suppkey) + 0.5 AS c FROM nation n JOIN region r ON n_regionkey = r_regionkey LEFT JOIN supplier s ON s_nationkey = n_nationkey GROUP BY ALL)
  SELECT n_name AS name, CASE WHEN n_nationkey % 5 = 4 THEN 'Regnum' ELSE 'Genus' END AS rank, c, r_name || '/' || n_name || '/list' AS path, n_regionkey * 1000 + n_nationkey AS seq, ['' || (n_nationkey % 7), 'r' || n_regionkey] AS ext FROM s
  UNION ALL SELECT r_name, 'Ordo', sum(c), r_name || '/list', n_regionkey * 1000 + 999, ['r' || n_regionkey] FROM s GROUP BY r_name, n_regionkey)"""


def photo_items(spark, d):
    """Customers of the first nations as items named like nations or by themselves, and synonyms."""
    c = spark.read.parquet(f"{d}/customer.parquet").join(spark.read.parquet(f"{d}/nation.parquet"), F.col("c_nationkey") == F.col("n_nationkey"))
    items = c.select(F.col("c_custkey").alias("item_id"), F.when(F.col("c_nationkey") % 6 == 0, F.col("n_name")).otherwise(F.col("c_name")).alias("name"), F.concat(F.lit("/x/"), (F.col("c_custkey") % 50).cast("string")).alias("external"))
    synonyms = c.select(F.col("c_custkey").alias("item_id"), F.lit(0).alias("pos"), F.concat_ws(" ", "c_mktsegment", F.col("n_name")).alias("synonym"), F.col("c_name").alias("name")).unionByName(c.select(F.col("c_custkey").alias("item_id"), F.lit(1).alias("pos"), F.col("n_name").alias("synonym"), F.col("c_name").alias("name")))
    return items, synonyms


ITEMS = "(SELECT c_custkey AS id, c_name, c_mktsegment, n_name, CASE WHEN c_nationkey % 6 = 0 THEN n_name ELSE c_name END AS name FROM customer JOIN nation ON c_nationkey = n_nationkey)"


@query(
    "photo_index",
    f"""WITH i AS {ITEMS}, e AS (
      SELECT lower(name) AS key, 3 AS prio, id AS seq, 0 AS s2, 1::BIGINT AS count, name AS path FROM i
      UNION ALL SELECT lower(name), 2, seq, 0, round_even(c, 0)::BIGINT, path FROM {TAXA} WHERE rank IN ('Ordo', 'Genus')
      UNION ALL SELECT lower(c_mktsegment || ' ' || n_name), 1, -id, 0, 1, c_name FROM i UNION ALL SELECT lower(n_name), 1, -id, -1, 1, c_name FROM i)
    SELECT key, count, path FROM e QUALIFY row_number() OVER (PARTITION BY key ORDER BY prio DESC, seq DESC, s2 DESC) = 1""",
)
def photo_index(spark, d):
    items, synonyms = photo_items(spark, d)
    return search.photo_index(items, geography(spark, d), synonyms)


@query(
    "photo_token_index",
    f"""WITH e AS (SELECT unnest(ext) AS token, 0 AS prio, seq, round_even(c, 0)::BIGINT AS count, path FROM {TAXA} WHERE rank IN ('Ordo', 'Genus')
      UNION ALL SELECT '' || (id % 50), 1, id, 1, name FROM {ITEMS})
    SELECT token, count, path FROM e QUALIFY row_number() OVER (PARTITION BY token ORDER BY prio DESC, seq DESC) = 1""",
)
def photo_token_index(spark, d):
    return search.photo_token_index(photo_items(spark, d)[0], geography(spark, d))


@query(
    "search_name_diff",
    f"""WITH o AS (SELECT DISTINCT lang, item_id, name FROM {HITS} WHERE item_id % 7 <> 0 OR hit_pos <> 1),
      n AS (SELECT DISTINCT lang, item_id, name FROM {HITS} WHERE item_id % 5 <> 0 OR hit_pos = 1)
    SELECT *, 'add' AS change FROM (SELECT * FROM n EXCEPT SELECT * FROM o) UNION ALL SELECT *, 'remove' FROM (SELECT * FROM o EXCEPT SELECT * FROM n)""",
)
def search_name_diff(spark, d):
    """Every 7th part lacked its brand before; every 5th has only its brand afterwards."""
    t = part_translations(spark, d)
    old = t.withColumn("names", F.when(F.col("item_id") % 7 == 0, F.slice("names", 2, 2)).otherwise(F.col("names")))
    gone = F.col("item_id") % 5 == 0
    new = t.withColumn("label", F.when(~gone, F.col("label"))).withColumn("names", F.when(gone, F.slice("names", 1, 1)).otherwise(F.col("names")))
    return search.search_name_diff(old, new)
