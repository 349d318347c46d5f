"""Folders and files that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession, name: str = "stream") -> str:
    """A new folder below spark.checkpoint.dir; only a local session, whose executor is itself, may do without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="catalens-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if re.match(r"[a-z][a-z0-9+.-]*:/", path) else (fs.LocalFileSystem(), path)


def write_files(files: DataFrame, folder: str) -> int:
    """Write (path, body) rows as files below ``folder``, each under its own name; how many there are now.

    For sources that hold a file for each item under a given name, as patches and packets do; tables go through Spark's
    writers. Files are dealt to as many tasks as a shuffle has, as a table of one part may be many files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = store_of(folder)
        for batch in batches:
            made = set()
            for path, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                whole = f"{top.rstrip('/')}/{path}"
                here = whole.rsplit("/", 1)[0]
                if here not in made:
                    store.create_dir(here, recursive=True)
                    made.add(here)
                with store.open_output_stream(whole) as out:
                    out.write(body.encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    dealt = files.select("path", "body").repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")
    return dealt.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


@contextmanager
def listed_together(spark: SparkSession) -> Iterator[None]:
    """Folders of many files are listed by as many tasks as a shuffle has; else each folder, or file of a stream, is a task up to 10,000."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def saved(df: DataFrame) -> DataFrame:
    """The same rows with the lineage cut, kept in the shared folder, where the loss of an executor can't reach them."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(scratch(spark, "checkpoints"))
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """The same rows as a table in the shared folder: as ``saved``, but Spark knows its size anew.

    For rounds of joins: a checkpoint keeps the size that was estimated for its plan, and products of products outgrow every number.
    """
    path = scratch(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
