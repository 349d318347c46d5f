"""Observation queries: events as observations, users as observers, event types as items; parts by brand as groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalens.operators import stats
from catalens.plans.registry import query


def observations(spark: SparkSession, d: str) -> DataFrame:
    """(obs_key, observer, item, ms, lat, lon, country): the place follows from the value and props; every third has its country."""
    e = spark.read.parquet(f"{d}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.col("event_id").alias("obs_key"), F.col("user_id").cast("string").alias("observer"), F.concat_ws("-", "event_type", (k % 7).cast("string")).alias("item"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
        (k - 45).cast("double").alias("lat"), (F.col("user_id") % 90 - 30).cast("double").alias("lon"), F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("c"), (k % 11).cast("string"))).alias("country"),
    )


OBS = """(SELECT event_id AS obs_key, '' || user_id AS observer, event_type || '-' || ((props->>'$.k')::INT % 7) AS item, epoch_us(ts) // 1000 AS ms,
  ((props->>'$.k')::INT - 45)::DOUBLE AS lat, (user_id % 90 - 30)::DOUBLE AS lon, CASE WHEN event_id % 3 = 0 THEN 'c' || ((props->>'$.k')::INT % 11) END AS country FROM events)"""
_SUM = "count(*) AS n, min(ms) AS first_ms, first(item ORDER BY ms, obs_key) AS first_item, max(ms) AS last_ms, first(item ORDER BY ms DESC, obs_key) AS last_item"
RANK = f"(SELECT observer, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, min(obs_key)) AS rank FROM {OBS} GROUP BY observer)"


@query("observation_public_stats", f"SELECT *, (SELECT item FROM {OBS} GROUP BY item ORDER BY count(*) DESC, item LIMIT 1) AS most_item, (SELECT count(*) FROM {OBS} GROUP BY item ORDER BY 1 DESC LIMIT 1) AS most_n FROM (SELECT {_SUM}, count(DISTINCT observer) AS observers, count(DISTINCT item) AS items FROM {OBS})")
def observation_public_stats(spark, d):
    return stats.observation_public_stats(observations(spark, d))


@query("observation_countries", f"SELECT country, count(*) AS n FROM {OBS} WHERE country IS NOT NULL GROUP BY country")
def observation_countries(spark, d):
    return stats.observation_countries(observations(spark, d))


@query("observer_rank", f"SELECT * FROM {RANK}")
def observer_rank(spark, d):
    return stats.observer_rank(observations(spark, d))


@query("observation_user_stats", f"SELECT s.*, CASE WHEN s.observer LIKE '%3' THEN 0 ELSE r.rank END AS rank FROM (SELECT observer, {_SUM}, count(DISTINCT item) AS items, count(DISTINCT country) AS countries FROM {OBS} GROUP BY observer) s JOIN {RANK} r USING (observer)")
def observation_user_stats(spark, d):
    """Observers whose id ends in 3 are in no ranking."""
    rows = observations(spark, d)
    return stats.observation_user_stats(rows, stats.observer_rank(rows).filter("observer not like '%3'"))


@query("forward_fill", "SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS signup FROM events")
def forward_fill(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", "user_id", "ts", "event_type")
    return stats.forward_fill(e, "user_id", ["ts", "event_id"], F.when(F.col("event_type") == "signup", F.col("event_id")), "signup").select("event_id", "user_id", "signup")


def boxes(spark: SparkSession, d: str) -> DataFrame:
    """A bounding box for each nation."""
    k = F.col("n_nationkey")
    return spark.read.parquet(f"{d}/nation.parquet").select(F.col("n_name").alias("country"), (k * 3 - 40).cast("double").alias("lat0"), (k * 3 - 20 + k % 4).cast("double").alias("lat1"), (k * 2 - 30).cast("double").alias("lon0"), (k * 2 + 5 + k % 3).cast("double").alias("lon1"))


BOX = "(SELECT n_name AS box, n_nationkey * 3 - 40 AS lat0, n_nationkey * 3 - 20 + n_nationkey % 4 AS lat1, n_nationkey * 2 - 30 AS lon0, n_nationkey * 2 + 5 + n_nationkey % 3 AS lon1 FROM nation)"


@query("fill_country", f"""SELECT obs_key, coalesce(country, (SELECT box FROM {BOX} b WHERE o.lat BETWEEN lat0 AND lat1 AND o.lon BETWEEN lon0 AND lon1 ORDER BY (lat1 - lat0) * (lon1 - lon0), box LIMIT 1)) AS country FROM {OBS} o""")
def fill_country(spark, d):
    return stats.fill_country(observations(spark, d), boxes(spark, d)).select("obs_key", "country")


@query(
    "review_decisions",
    """SELECT event_id AS obs_key, CASE event_type WHEN 'purchase' THEN 'public' WHEN 'error' THEN 'rejected' ELSE 'new' END AS status,
      CASE WHEN event_type = 'purchase' THEN 'a' || event_id || '.webp' ELSE 'a' || event_id || '.jpg' END AS photo,
      CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'seen' || chr(10) ELSE '' END || 'value ' || event_id % 5 ELSE CASE WHEN event_id % 2 = 0 THEN 'seen' ELSE '' END END AS note, event_type = 'purchase' AS in_public FROM events""",
)
def review_decisions(spark, d):
    """Purchases are approved, errors rejected, clicks skipped, others without a decision."""
    e = spark.read.parquet(f"{d}/events.parquet")
    obs = e.select(F.col("event_id").alias("obs_key"), F.lit("new").alias("status"), F.array(F.concat(F.lit("a"), F.col("event_id").cast("string"), F.lit(".jpg"))).alias("photos"), F.when(F.col("event_id") % 2 == 0, "seen").otherwise("").alias("note"))
    says = F.when(F.col("event_type") == "purchase", "ok").when(F.col("event_type") == "error", "reject").when(F.col("event_type") == "click", "skip")
    decisions = e.select(F.col("event_id").alias("obs_key"), says.alias("decision"), F.concat(F.lit("value "), (F.col("event_id") % 5).cast("string")).alias("reason")).filter("decision is not null")
    return stats.review_decisions(obs, decisions).withColumn("photo", F.element_at("photos", 1)).drop("photos")


def part_traits(spark: SparkSession, d: str) -> DataFrame:
    """(item_id, name, codes, low, high): parts with codes but for every 3rd, bounds but for every 4th."""
    k = F.col("p_partkey")
    return spark.read.parquet(f"{d}/part.parquet").select(k.alias("item_id"), F.col("p_name").alias("name"), F.when(k % 3 == 0, F.array().cast("array<int>")).otherwise(F.array(F.col("p_size") % 4, F.length("p_type") % 5)).alias("codes"), F.when(k % 4 != 0, F.col("p_size")).alias("low"), F.when(k % 4 != 0, F.col("p_size") + F.length("p_brand")).alias("high"))


TRAITS = "(SELECT p_partkey AS item_id, p_name AS name, CASE WHEN p_partkey % 3 = 0 THEN [] ELSE [p_size % 4, (length(p_type) % 5)::INT] END AS codes, CASE WHEN p_partkey % 4 <> 0 THEN p_size END AS low, CASE WHEN p_partkey % 4 <> 0 THEN p_size + length(p_brand) END AS high, p_brand FROM part)"


def majority(rows: str, key: str) -> str:
    return f"""(WITH f AS (SELECT {key}, row_number() OVER () AS i, codes FROM {rows} WHERE len(codes) > 0), n AS (SELECT {key}, count(*) AS n FROM f GROUP BY {key}),
      k AS (SELECT {key}, code, count(DISTINCT i) AS k FROM (SELECT {key}, i, unnest(codes) AS code FROM f) GROUP BY {key}, code),
      m AS (SELECT *, max(k) OVER (PARTITION BY {key}) AS top, bool_or(k * 2 > n) OVER (PARTITION BY {key}) AS strict FROM k JOIN n USING ({key}))
      SELECT {key}, list_sort(list(code)) AS codes FROM m WHERE CASE WHEN strict THEN k * 2 > n ELSE k = top END GROUP BY {key})"""


@query("majority_codes", f"SELECT * FROM {majority(TRAITS, 'name')}")
def majority_codes(spark, d):
    return stats.majority_codes(part_traits(spark, d), "name", "codes")


@query("group_median_int", "SELECT p_brand, round_even(median(p_size), 0)::INT AS size FROM part GROUP BY p_brand")
def group_median_int(spark, d):
    return spark.read.parquet(f"{d}/part.parquet").groupBy("p_brand").agg(stats.group_median_int("p_size").alias("size"))


SISTERS = """(SELECT item_id, sister_id, n FROM (SELECT a.p_partkey AS item_id, b.p_partkey AS sister_id, row_number() OVER (PARTITION BY a.p_partkey ORDER BY b.p_partkey)::INT AS n
  FROM part a JOIN part b ON split_part(a.p_name, ' ', 1) = split_part(b.p_name, ' ', 1) AND a.p_name <> b.p_name) WHERE n <= 5)"""


@query("sister_items", f"SELECT * FROM {SISTERS}")
def sister_items(spark, d):
    return stats.sister_items(part_traits(spark, d).select("item_id", "name"))


@query(
    "fill_from_group",
    f"""WITH t AS {TRAITS}, s AS (SELECT s.item_id, s.n, t.name AS sister, t.codes, t.low, t.high FROM {SISTERS} s JOIN t ON s.sister_id = t.item_id),
      c AS {majority('s', 'item_id')}, b AS (SELECT item_id, round_even(median(low), 0)::INT AS gl, round_even(median(high), 0)::INT AS gh, list(sister ORDER BY n)[:4] AS names FROM s GROUP BY item_id)
    SELECT t.item_id, t.name, CASE WHEN len(t.codes) = 0 AND c.codes IS NOT NULL THEN c.codes ELSE t.codes END AS codes,
      CASE WHEN t.low IS NULL AND gl IS NOT NULL AND gh IS NOT NULL THEN gl ELSE t.low END AS low, CASE WHEN t.low IS NULL AND gl IS NOT NULL AND gh IS NOT NULL THEN gh ELSE t.high END AS high,
      CASE WHEN (len(t.codes) = 0 AND c.codes IS NOT NULL) OR (t.low IS NULL AND gl IS NOT NULL AND gh IS NOT NULL) THEN 'median/majority of ' || array_to_string(names, ', ') END AS note
    FROM t LEFT JOIN b USING (item_id) LEFT JOIN c USING (item_id)""",
)
def fill_from_group(spark, d):
    traits = part_traits(spark, d)
    return stats.fill_from_group(traits, stats.sister_items(traits.select("item_id", "name")), traits)


@query("review_queue", "SELECT event_id AS obs_key, 'review' AS status, user_id FROM events WHERE event_type = 'purchase'")
def review_queue(spark, d):
    """Purchases wait for a review; other events are new or have no status."""
    e = spark.read.parquet(f"{d}/events.parquet")
    status = F.when(F.col("event_type") == "purchase", "review").when(F.col("event_type") == "click", "new")
    return stats.review_queue(e.select(F.col("event_id").alias("obs_key"), status.alias("status"), "user_id"))
