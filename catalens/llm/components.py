"""Connected components of links, and links within buckets.

Components: large-star and small-star steps in turn (each node's neighbours are linked to the smallest of them), until
the links are stars around the smallest ids. Links, components and members stay in DataFrames throughout.

Buckets: rows that share a key are compared within their bucket. Buckets over ``cap`` rows are cut into blocks and each
pair of blocks is a task of its own (at most 2 x cap rows), so that all pairs are compared and none is too large to
hold. What a task emits follows its rows, not its pairs: a spanning forest of the links that it finds, or counts.
"""

from __future__ import annotations

import gc

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.llm.common import saved


def connected_components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60, tidy: bool = False) -> DataFrame:
    """(id, component_id) for each id in a link; component_id is the smallest id reachable. Links with a null end, and of an id to itself, are void.

    With ``tidy`` the driver collects its garbage after each round, upon which Spark removes what earlier rounds shuffled;
    else those files stay until it happens to.
    """
    now = saved(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).isNotNull() & F.col(b).isNotNull()).toDF("u", "v", "whole").filter("whole and u > v").select("u", "v").distinct())
    state = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        now = saved(small)
        was, state = state, now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tidy:
            del both, least, large, small
            discard_unused(now)
        if state == was:
            break
    else:
        raise RuntimeError("the components did not settle")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct())


def discard_unused(df: DataFrame) -> None:
    """Let Spark's cleaner find the shuffles and checkpoints of plans that are no longer referred to."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def cells(rows: DataFrame, key: str, by: str, cap: int, weight: str | None = None) -> DataFrame:
    """``rows`` of keys with two rows or more, with column ``cell``: the block pairs of its bucket that a row takes part in.

    A block has about ``cap`` rows or, with a column ``weight``, rows of that weight in sum.
    ``by`` is the column whose hash deals a large bucket's rows to blocks; ``home`` tells a row's own block in the cell
    (0 or 1), and within the cell (i, j) with i < j only pairs across the two blocks are new.
    """
    size = F.count("*").over(_by(key))
    whole = F.sum(weight).over(_by(key)) if weight else size
    dealt = rows.withColumn("__size", size).withColumn("__blocks", F.ceil(whole / cap).cast("int")).filter("__size > 1")
    block = F.pmod(F.xxhash64(by), F.col("__blocks")).cast("int")
    dealt = dealt.withColumn("__block", block).withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    low, high = F.least("__block", "__other"), F.greatest("__block", "__other")
    cell = low.cast("long") * F.lit(1 << 31) + high
    return dealt.withColumn("cell", cell).withColumn("home", F.when(low == high, -1).otherwise((F.col("__block") == high).cast("int"))).drop("__size", "__blocks", "__block", "__other")


def _by(key: str):
    from pyspark.sql import Window

    return Window.partitionBy(key)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For n nodes and links (a, b): the smallest node reachable from each."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        was = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == was).all():
            break
    while (label[label] != label).any():
        label = label[label]
    return label


def run_pairs(starts: np.ndarray, n: int, most: int = 2_000_000):
    """Pairs (i, j), i < j, of rows in the same run, in blocks of about ``most``; runs begin at ``starts``."""
    ends = np.append(starts[1:], n)
    end_of = np.repeat(ends, ends - starts)
    count = end_of - np.arange(n) - 1
    total = np.cumsum(count)
    at = 0
    while at < n:
        upto = int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right"))
        upto = max(upto, at + 1)
        c = count[at:upto]
        i = np.repeat(np.arange(at, upto), c)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(c) - c, c)
        if len(i):
            yield i, j
        at = upto
