"""Incremental index maintenance as a stream of changed items."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from catalens.sources.dumps import parse_patches


def latest_versions(stream: DataFrame, item_id: str, version: str, time: str, delay: str) -> DataFrame:
    """A stream without second deliveries of an item's version within ``delay``; state older than that is dropped."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([item_id, version])


def stream_patches(stream: DataFrame, postings: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Write the postings (key, item_id) of each micro-batch below ``path``; a batch that is run again overwrites its own files."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        postings(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_counts(stream: DataFrame, keys: list[str], time: str, window: str, delay: str, path: str, checkpoint: str) -> StreamingQuery:
    """Append counts of ``keys`` in windows of ``time`` to Parquet files, each window once its time is ``delay`` past."""
    counts = stream.withWatermark(time, delay).groupBy(F.window(time, window), *keys).agg(F.count("*").alias("n"))
    rows = counts.select(F.col("window.start").alias("start"), *keys, "n")
    return rows.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_patch_files(spark: SparkSession, folder: str, schema: str, required: list[str], out: str, checkpoint: str, files_at_once: int = 1000) -> StreamingQuery:
    """Read the patch files of ``folder`` that no earlier run with this checkpoint has read, and end.

    Whole patches go to ``out``/accepted, those that lack something to ``out``/rejected, in a folder for each batch; a
    batch that is run again after a failure overwrites its own. A patch is known by its file's name: one that is to
    be corrected comes back under another. Files that begin with _ are hidden.
    """
    rows = spark.readStream.option("maxFilesPerTrigger", files_at_once).text(folder, wholetext=True, pathGlobFilter="*.json")
    rows = parse_patches(rows.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("body")), schema, required)
    nothing = spark.createDataFrame([], rows.schema)
    for kind in ("accepted", "rejected"):
        nothing.write.mode("overwrite").parquet(f"{out}/{kind}/batch=-1")

    def apply(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()  # read once for both sinks
        try:
            for kind, here in (("accepted", F.size("lacking") == 0), ("rejected", F.size("lacking") > 0)):
                kept.filter(here).write.mode("overwrite").parquet(f"{out}/{kind}/batch={batch_id}")
        finally:
            kept.unpersist()

    return rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def patches_so_far(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) patches of all runs, with the batch they came in."""
    return tuple(spark.read.parquet(f"{out}/{kind}") for kind in ("accepted", "rejected"))


def postings_so_far(spark: SparkSession, path: str) -> DataFrame:
    """Distinct postings of all batches."""
    return spark.read.parquet(path).select("key", "item_id").distinct()
