"""What the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir; only a local session, whose executor is itself, may do without it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        found = found or local_dir(sc.master)
        sc.setCheckpointDir(found)
    return found or sc._jsc.sc().getCheckpointDir().get()


def local_dir(master: str) -> str:
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="catalens-")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """The same rows with the lineage cut, kept in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id's decimal digits leaves 1 on division by 3; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fold(doc_id: str = "doc_id") -> Column:
    """That remainder itself; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def with_columns(schema: T.StructType, more: str) -> T.StructType:
    """``schema`` with the DDL fields ``more`` behind it; columns of those names in ``schema`` give way."""
    extra = T._parse_datatype_string(more)
    names = {f.name.lower() for f in extra}
    return T.StructType([f for f in schema if f.name.lower() not in names] + list(extra))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_batches(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    return df.mapInArrow(f, schema)


def append(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """``batch`` without the columns named, and with them at its end."""
    low = {k.lower() for k in columns}
    keep = [i for i, n in enumerate(batch.schema.names) if n.lower() not in low]
    return pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + list(columns.values()), names=[batch.schema.names[i] for i in keep] + list(columns))


def texts_of(batch: pa.RecordBatch, name: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False).tolist()


_HELD: dict = {}


def held(key: object, make: Callable):
    """What ``make`` gives, kept by a Python worker for its next tasks until another key is asked for."""
    if key not in _HELD:
        release()
        _HELD[key] = make()
    return _HELD[key]


def release() -> None:
    """Let go of what tasks of another operator kept in this worker."""
    _HELD.clear()


class Memo(dict):
    """A dictionary that makes missing values and holds ``limit`` of them at most.

    Once half of them are new, the older half goes, but for those asked for since: what is frequent stays.
    """

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self.make, self.half, self.old = make, max(1, limit // 2), {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def byte_letters() -> dict[int, int]:
    """For str.translate: the letters that byte-level files of the tokenizers library show bytes as."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}  # the bytes that stand for themselves
    return {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in shown)}


def byte_shower() -> Callable[[str], str]:
    """Those letters for all bytes of a string."""
    letters = byte_letters()
    table = [chr(letters.get(b, b)) for b in range(256)]
    return lambda text: "".join([table[b] for b in text.encode()])


def piped(df: DataFrame, schema: T.StructType | str, *steps: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Several batch functions in one Python worker, each fed with the one before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps:
            batches = step(batches)
        return batches

    return df.mapInArrow(run, schema)


def whole_runs(batches: Iterable[pa.RecordBatch], keys: list[str], least: int = 50_000) -> Iterator[pa.Table]:
    """Tables of whole runs of equal ``keys``, of ``least`` rows or more but for the last, from batches in which equal keys are neighbours."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < least:
            continue
        whole = pa.Table.from_batches(held)
        cut = last_run(whole, keys)
        if cut:
            yield whole.slice(0, cut)
            rest = whole.slice(cut).combine_chunks()
            held = rest.to_batches()
            rows = rest.num_rows
        else:
            held = whole.combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def last_run(whole: pa.Table, keys: list[str]) -> int:
    """Where the last run begins."""
    n = whole.num_rows
    same = np.ones(n, bool)
    for k in keys:
        col = whole[k].to_numpy()
        same &= col == col[-1]
    odd = np.flatnonzero(~same)
    return int(odd[-1]) + 1 if len(odd) else 0


def partitions_for(spark: SparkSession) -> int:
    """As many partitions as the session shuffles to."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
