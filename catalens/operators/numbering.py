"""Dense numbers in a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalens.sources.shared import saved


def numbered(df: DataFrame, *order: str | Column, to: str = "number", base: int = 0, parts: int | None = None) -> DataFrame:
    """``df`` with column ``to``: ``base``, ``base`` + 1, ... in the order given.

    Rows are dealt to partitions by ranges of the whole order and sorted there, so a value that all rows share doesn't
    gather them; a row's number is its place in its partition behind the sizes of those before it. The sorted rows are
    kept, as places must not change between the two passes. Rows that the order leaves equal share a partition, so it
    should be total. What a single task sees is one row for each partition.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = saved(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)).withColumn("__id", F.monotonically_increasing_id())
    part, place = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    kept = kept.withColumns({"__part": part, "__place": place}).drop("__id")
    sizes = kept.groupBy("__part").agg(F.count("*").alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    # as many rows as there are partitions
    return kept.join(F.broadcast(sizes), "__part").withColumn(to, F.col("__before") + F.col("__place") + F.lit(base).cast("long")).drop("__part", "__place", "__before")
