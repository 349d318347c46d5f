"""Facet queries: orders with flags, line statuses, order status and priority as axes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalens.operators import facets as ops
from catalens.plans.registry import query

#: The domain of each axis; ``X`` stands in no order, so that keys without items occur.
DOMAINS = {"flag": ["A", "N", "R", "X"], "line": ["F", "O"], "status": ["F", "O", "P", "X"], "priority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]}


def order_items(spark: SparkSession, d: str) -> DataFrame:
    held = lambda c, axis: F.array_compact(F.array(*[F.when(F.max(F.col(c) == v), F.lit(v)) for v in DOMAINS[axis]])).alias(axis)
    lines = spark.read.parquet(f"{d}/lineitem.parquet").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(held("l_returnflag", "flag"), held("l_linestatus", "line"))
    orders = spark.read.parquet(f"{d}/orders.parquet")
    return orders.join(lines, "o_orderkey", "left").select("o_orderkey", "o_orderdate", "flag", "line", F.array("o_orderstatus").alias("status"), F.array("o_orderpriority").alias("priority"))


def _domain(axis: str) -> str:
    return "(SELECT unnest([" + ", ".join(f"'{v}'" for v in ["", *DOMAINS[axis]]) + f"]) AS {axis})"


KEYS_SQL = "SELECT concat_ws('_', flag, line, status, priority) AS key, * FROM " + " CROSS JOIN ".join(map(_domain, DOMAINS))
PAIRS_SQL = f"""
  SELECT DISTINCT k.key, o.o_orderkey
  FROM ({KEYS_SQL}) k JOIN orders o ON (k.status = '' OR k.status = o.o_orderstatus) AND (k.priority = '' OR k.priority = o.o_orderpriority)
  WHERE (k.flag = '' OR (k.flag, o.o_orderkey) IN (SELECT l_returnflag, l_orderkey FROM lineitem))
    AND (k.line = '' OR (k.line, o.o_orderkey) IN (SELECT l_linestatus, l_orderkey FROM lineitem))
"""


@query("facet_counts", f"SELECT k.key, count(p.o_orderkey) AS n FROM ({KEYS_SQL}) k LEFT JOIN ({PAIRS_SQL}) p USING (key) GROUP BY k.key")
def facet_counts(spark, d):
    return ops.facet_counts(order_items(spark, d), "o_orderkey", DOMAINS)
