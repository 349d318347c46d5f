"""Taxonomy queries: regions, nations and segments as taxa, customers as items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalens.operators import taxonomy as ops
from catalens.plans.registry import query


def entries(spark: SparkSession, d: str) -> DataFrame:
    """(item_id, apg): customers' maps of numbered ranks; bad keys and empty names among them."""
    c, n, r = (spark.read.parquet(f"{d}/{x}.parquet") for x in ("customer", "nation", "region"))
    rows = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select(F.col("c_custkey").alias("item_id"), F.create_map(F.lit("02_Regio"), "r_name", F.lit("00_Genus"), "c_mktsegment", F.lit("01_Natio"), F.when(F.col("c_custkey") % 10 == 0, "").otherwise(F.col("n_name")), F.lit("bad"), F.lit("x"), F.lit("zz_Rank"), F.lit("y")).alias("apg"))


ROWS = "(SELECT c_custkey AS item_id, r_name, n_name, c_mktsegment AS s, c_custkey % 10 = 0 AS short FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
PATHS = f"(SELECT item_id, unnest(CASE WHEN short THEN [{{'p': r_name, 'name': r_name, 'rank': 'Regio'}}, {{'p': r_name || '/' || s, 'name': s, 'rank': 'Genus'}}] ELSE [{{'p': r_name, 'name': r_name, 'rank': 'Regio'}}, {{'p': r_name || '/' || n_name, 'name': n_name, 'rank': 'Natio'}}, {{'p': r_name || '/' || n_name || '/' || s, 'name': s, 'rank': 'Genus'}}] END) AS t FROM {ROWS})"


def paths(spark, d):
    return entries(spark, d).select("item_id", ops.ordered_path(F.col("apg")).alias("path"))


@query("ordered_path", f"SELECT item_id, CASE WHEN short THEN 'Regio=' || r_name || '/Genus=' || s ELSE 'Regio=' || r_name || '/Natio=' || n_name || '/Genus=' || s END AS path FROM {ROWS}")
def ordered_path(spark, d):
    return paths(spark, d).select("item_id", F.array_join(F.transform("path", lambda s: F.concat(s["rank"], F.lit("="), s["name"])), "/").alias("path"))


@query("taxon_path_patch", f"SELECT item_id, CASE WHEN short THEN '00_Genus=' || s || ',01_Regio=' || r_name ELSE '00_Genus=' || s || ',01_Natio=' || n_name || ',02_Regio=' || r_name END AS apg FROM {ROWS}")
def taxon_path_patch(spark, d):
    """Paths and back: the maps numbered anew."""
    back = ops.path_to_map(F.col("path"))
    return ops.taxon_path_patch(entries(spark, d), "apg").select("item_id", F.array_join(F.transform(F.array_sort(F.map_entries(back)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("apg"))


@query("taxon_rollup", f"SELECT t.p AS path, t.name AS name, min(t.rank) AS rank, count(DISTINCT item_id) AS count FROM {PATHS} GROUP BY ALL")
def taxon_rollup(spark, d):
    return ops.taxon_rollup(paths(spark, d))


def edges(spark, d):
    c, n, r = (spark.read.parquet(f"{d}/{x}.parquet") for x in ("customer", "nation", "region"))
    a = r.select(F.col("r_name").alias("name"), F.lit("").alias("parent"), F.lit("Regio").alias("rank"))
    b = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("name"), F.col("r_name").alias("parent"), F.lit("Natio").alias("rank"))
    e = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_name").alias("name"), F.col("n_name").alias("parent"), F.lit("Genus").alias("rank"))
    return a.unionByName(b).unionByName(e)


@query("taxon_flatten", "WITH RECURSIVE e AS (SELECT r_name AS name, '' AS parent, 'Regio' AS rank FROM region UNION ALL SELECT n_name, r_name, 'Natio' FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT c_name, n_name, 'Genus' FROM customer JOIN nation ON c_nationkey = n_nationkey), w AS (SELECT name AS path, name, rank, 0 AS level FROM e WHERE parent = '' UNION ALL SELECT w.path || '/' || e.name, e.name, e.rank, w.level + 1 FROM w JOIN e ON e.parent = w.name) SELECT * FROM w")
def taxon_flatten(spark, d):
    return ops.taxon_flatten(edges(spark, d), "")


@query("taxon_members", f"SELECT DISTINCT t.p AS path, item_id FROM {PATHS} WHERE NOT (t.rank = 'Genus' AND t.name = 'MACHINERY')")
def taxon_members(spark, d):
    """Members of all ancestors in a tree without one of the segments."""
    lowest = paths(spark, d).select(F.array_join(F.transform("path", lambda s: s["name"]), "/").alias("path"), "item_id")
    tree = ops.taxon_rollup(paths(spark, d)).filter("not (rank = 'Genus' and name = 'MACHINERY')")
    return ops.taxon_members(tree, lowest)


@query("taxon_attach", f"SELECT item_id, 1 AS step, r_name AS node FROM {ROWS} UNION ALL SELECT item_id, 2, CASE WHEN short THEN r_name || '/extra/' || s ELSE r_name || '/' || n_name END FROM {ROWS} UNION ALL SELECT item_id, 3, r_name || '/' || n_name || '/' || s FROM {ROWS} WHERE NOT short")
def taxon_attach(spark, d):
    """A tree of regions with a rich section between them and their segments; items without a nation land there, nations are made."""
    c = spark.read.parquet(f"{d}/customer.parquet").select("c_mktsegment").distinct()
    r = spark.read.parquet(f"{d}/region.parquet").select("r_name")
    zero = lambda n: [F.lit(n).cast("long").alias("n"), F.lit(0).cast("long").alias("children"), F.lit(0).cast("long").alias("tokens")]
    tree = r.select(F.col("r_name").alias("path"), F.col("r_name").alias("name"), F.lit("Regio").alias("rank"), *zero(5)).unionByName(r.select(F.concat("r_name", F.lit("/extra")).alias("path"), F.lit("extra").alias("name"), F.lit("Tribus").alias("rank"), *zero(4)))
    tree = tree.unionByName(r.crossJoin(F.broadcast(c)).select(F.concat("r_name", F.lit("/extra/"), "c_mktsegment").alias("path"), F.col("c_mktsegment").alias("name"), F.lit("Genus").alias("rank"), *zero(1_000_000_000)))
    return ops.taxon_attach(tree, paths(spark, d))[0]
