"""Smaller operators, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalens.functions import strings as S
from catalens.operators import facets, names
from catalens.operators import text as text_ops
from catalens.plans.registry import query
from catalens.plans.text import described, t
from catalens.sources import dumps
from catalens.sources.shared import scratch


@query("facet_keys", "WITH a AS (SELECT DISTINCT p_brand AS v FROM part UNION ALL SELECT ''), b AS (SELECT DISTINCT p_type AS v FROM part UNION ALL SELECT '') SELECT a.v || '_' || b.v AS key FROM a, b")
def facet_keys(spark, d):
    """The key domain of the brands and types that occur; the sets are fixed and small, so more than 1000 values are an error."""
    p = t(spark, d, "part")

    def values(c):
        found = sorted(r[0] for r in p.select(c).distinct().limit(1001).collect())
        if len(found) > 1000:
            raise ValueError(f"{c} has more than 1000 values and is no axis of a key domain")
        return found

    return facets.facet_keys(spark, {"brand": values("p_brand"), "type": values("p_type")})


@query("height_pick", "SELECT p_partkey AS item_id, (p_size + 20)::INT AS high_cm FROM part")
def height_pick(spark, d):
    """Of an imperial and a metric range of a whole plant, and one of a leaf, the metric one of the plant."""
    s = F.col("p_size")
    text = F.concat(F.lit("It grows 3 to 4 ft tall. The plant is "), s, F.lit(" to "), s + 20, F.lit(" cm high. "), F.lit("x" * 90), F.lit(" leaf 900 to 990 cm long"))
    return t(spark, d, "part").select(F.col("p_partkey").alias("item_id"), text_ops.infer_height(text).alias("h")).select("item_id", "h.high_cm")


@query("ordered_distinct", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN ['F', o_orderpriority] ELSE [o_orderstatus, 'F', o_orderpriority] END AS v FROM orders")
def ordered_distinct(spark, d):
    return t(spark, d, "orders").select("o_orderkey", F.array_distinct(F.array("o_orderstatus", F.lit("F"), "o_orderpriority", "o_orderstatus")).alias("v"))


@query("append_to_named_list", "SELECT p_partkey, CASE WHEN p_name = 'red bolt' THEN [p_size, 999]::BIGINT[] ELSE [p_size]::BIGINT[] END AS ids FROM part")
def append_to_named_list(spark, d):
    lists = t(spark, d, "part").select("p_partkey", F.col("p_type").alias("lang"), F.concat(F.lit(" "), F.upper("p_name")).alias("name"), F.array(F.col("p_size").cast("long")).alias("ids"))
    return names.append_to_named_list(lists, "Red Bolt ", 999)[0].select("p_partkey", "ids")


@query("languages_without_list", "SELECT p_type AS lang FROM part GROUP BY p_type HAVING NOT bool_or(p_name = 'red bolt' AND p_size < 9)")
def languages_without_list(spark, d):
    lists = t(spark, d, "part").select(F.col("p_type").alias("lang"), F.when(F.col("p_size") < 9, F.col("p_name")).otherwise("x").alias("name"), F.array(F.lit(1).cast("long")).alias("ids"))
    return names.append_to_named_list(lists, "red bolt", 1)[1]


@query("name_parts", "SELECT p_partkey, split_part(p_name, ' ', 1) AS genus, split_part(p_name, ' ', 2) AS species, replace(p_name, ' ', '-') AS dashed, p_name[1] AS initial FROM part")
def name_parts(spark, d):
    p = S.name_parts(F.col("p_name"))
    return t(spark, d, "part").select("p_partkey", p["genus"].alias("genus"), p["species"].alias("species"), p["name-"].alias("dashed"), p["initial"].alias("initial"))


@query("habitat_sentences", "SELECT p_partkey AS item_id, CASE p_size % 3 WHEN 0 THEN 'A plant of the meadow.' WHEN 1 THEN 'A plant of the garden and forest.' END AS habitat FROM part")
def habitat_sentences(spark, d):
    """The sentence on the habitat of each described part, by its codes."""
    rows = described(spark, d).select("item_id", "text")

    def run(frames):
        for frame in frames:
            frame["habitat"] = [text_ops.habitat_sentences([x], "", [1, 2, 4], set(), text_ops.HABITAT_WORDS, text_ops.FIELD_WORDS) for x in frame["text"]]
            yield frame[["item_id", "habitat"]]

    return rows.mapInPandas(run, "item_id long, habitat string")


@query("write_index_outputs", "SELECT p_type AS lang, count(*) AS n, sum(p_partkey)::BIGINT AS s FROM part GROUP BY p_type")
def write_index_outputs(spark, d):
    """Parts written as index tables, those by language read back."""
    p = t(spark, d, "part").select(F.col("p_type").alias("lang"), "p_partkey", "p_name")
    path = f"{scratch(spark)}/index"
    dumps.write_index_outputs(path, p, p, p, p, p, p)
    return spark.read.parquet(f"{path}/search").groupBy("lang").agg(F.count("*").alias("n"), F.sum("p_partkey").alias("s"))


@query("web_lang", "SELECT doc_id, CASE lang WHEN 'fr' THEN 'fr-FR' WHEN 'en' THEN 'en' ELSE lang END AS lang FROM documents")
def web_lang(spark, d):
    """Language codes by alias."""
    return t(spark, d, "documents").select("doc_id", S.aliased(F.col("lang"), {"fr": "fr-FR"}).alias("lang"))
