"""Catalog dumps as a data source: format ``catalog_dump``, with the files that the chosen stages need and no others.

A dump is a folder with a JSON file for each node, and one for each language's translations. Instead of a file there may
be a folder of part files under the same name, and a file may hold several objects one behind the other (JSON lines), so
that large nodes are read by many tasks. Files are read a piece at a time: a task holds one entry, never a whole file.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from catalens.sources.dumps import normalize_plant_list
from catalens.sources.shared import store_of

#: The file of each node, and the nodes that each stage needs (true: their lack is an error). Fixed values of the dump's layout.
FILES = {"list": "plants_to_update.json", "headers": "plants_headers.json", "details": "plants_v2.json", "taxonomy": "apg_iv_v3.json", "translations": "translations"}
STAGES = {
    "counts": {"headers": True},
    "search": {"details": False, "translations": False},
    "photo": {"details": False, "taxonomy": True},
    "web": {"headers": True, "details": False, "translations": False},
}
ALWAYS = {"list": True}

#: Small files share a task up to this many bytes.
TASK_BYTES = 32 << 20


@dataclass
class DumpFiles(InputPartition):
    """What one task reads: (node, language, number of the file in its node, path)."""

    files: list[tuple[str, str | None, int, str]]


def needed_nodes(stages: Sequence[str]) -> dict[str, bool]:
    """Nodes that the stages need, with whether their lack is an error."""
    odd = set(stages) - set(STAGES)
    if odd:
        raise ValueError(f"unknown stages: {', '.join(sorted(odd))}")
    out = dict(ALWAYS)
    for stage in stages:
        for node, required in STAGES[stage].items():
            out[node] = out.get(node, False) or required
    return out


def json_entries_of(stream: io.TextIOBase, piece: int = 1 << 18) -> Iterator[tuple[str | None, str]]:
    """(key, JSON text of the value) for all entries of the objects and arrays in a stream; entries of arrays have no key.

    What is read and not yet used is at most one entry and a piece; pieces double while an entry doesn't end.
    """
    decoder = json.JSONDecoder()
    text, at, ended = "", 0, False

    def more() -> None:
        nonlocal text, at, ended
        got = stream.read(max(piece, len(text) - at))
        ended = not got
        text, at = text[at:] + got, 0

    def peek() -> str:
        """The next character that isn't space; empty at the end."""
        nonlocal at
        while True:
            while at < len(text) and text[at].isspace():
                at += 1
            if at < len(text) or ended:
                return text[at : at + 1]
            more()

    def value() -> tuple[object, str]:
        nonlocal at
        peek()
        while True:
            try:
                found, end = decoder.raw_decode(text, at)
                if ended or end < len(text) and text[end] not in "0123456789.eE+-":  # a number may go on
                    raw, at = text[at:end], end
                    return found, raw
            except json.JSONDecodeError:
                if ended:
                    raise
            more()

    def sign(allowed: str) -> str:
        nonlocal at
        found = peek()
        if not found or found not in allowed:
            raise ValueError(f"one of {allowed} was expected, not {found or 'the end'}")
        at += 1
        return found

    while peek():
        keyed = sign("{[") == "{"
        close = "}" if keyed else "]"
        if peek() == close:
            sign(close)
            continue
        while True:
            key = None
            if keyed:
                key = str(value()[0])
                sign(":")
            yield key, value()[1]
            if sign("," + close) == close:
                break


class DumpReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        self.nodes = needed_nodes([s.strip() for s in options.get("stages", ",".join(STAGES)).split(",") if s.strip()])
        self.task_bytes = int(options.get("taskBytes", TASK_BYTES))

    def partitions(self) -> Sequence[DumpFiles]:
        store, top = store_of(self.path)
        tasks, size = [DumpFiles([])], 0
        for node, required in self.nodes.items():
            found = list(_translations(store, top) if node == "translations" else _parts(store, f"{top}/{FILES[node]}", None))
            if required and not found:
                raise FileNotFoundError(f"missing {self.path}/{FILES[node]}")
            for i, (lang, path, n) in enumerate(found):
                if tasks[-1].files and size + n > self.task_bytes:
                    tasks.append(DumpFiles([]))
                    size = 0
                tasks[-1].files.append((node, lang, i, path))
                size += n
        return tasks

    def read(self, partition: DumpFiles) -> Iterator[tuple]:
        store, _ = store_of(self.path)
        for node, lang, number, path in partition.files:
            bundle = node == "translations" and lang is None
            with store.open_input_stream(path) as raw, io.TextIOWrapper(raw, "utf-8") as stream:
                try:
                    for i, (key, value) in enumerate(json_entries_of(stream)):
                        at = (number << 40) + i
                        if bundle:  # one file: language -> entries
                            yield from ((node, key, (at << 24) + j, k, v) for j, (k, v) in enumerate(json_entries_of(io.StringIO(value))))
                        else:
                            yield node, lang, at, str(i) if key is None else key, value
                except ValueError as e:
                    raise ValueError(f"{path}: {e}") from e


def _parts(store: fs.FileSystem, path: str, lang: str | None) -> Iterator[tuple[str | None, str, int]]:
    """(language, path, bytes) of a node's file, or of its part files by name."""
    info = store.get_file_info(path)
    if info.type == fs.FileType.File:
        yield lang, path, info.size or 0
    elif info.type == fs.FileType.Directory:
        for x in sorted(store.get_file_info(fs.FileSelector(path)), key=lambda x: x.base_name):
            if x.type == fs.FileType.File and x.base_name[0] not in "._":
                yield lang, x.path, x.size or 0


def _translations(store: fs.FileSystem, top: str) -> Iterator[tuple[str | None, str, int]]:
    """One bundle of all languages if there is one, or else a file (or folder of parts) for each."""
    bundle = list(_parts(store, f"{top}/translations.json", None))
    if bundle:
        yield from bundle
        return
    folder = f"{top}/{FILES['translations']}"
    if store.get_file_info(folder).type == fs.FileType.Directory:
        for x in sorted(store.get_file_info(fs.FileSelector(folder)), key=lambda x: x.base_name):
            if x.base_name.endswith(".json") and x.base_name[0] not in "._":
                yield from _parts(store, x.path, x.base_name.removesuffix(".json"))


class CatalogDump(DataSource):
    """Rows (node, lang, pos, key, value) of a dump; ``pos`` rises in the order of a node, ``value`` is JSON.

    Options: the path; ``stages``, comma-separated (all by default). A needed file that is missing fails the query, one
    that is merely useful gives no rows, and files of other stages aren't opened.
    """

    @classmethod
    def name(cls) -> str:
        return "catalog_dump"

    def schema(self) -> str:
        return "node string, lang string, pos long, key string, value string"

    def reader(self, schema) -> DumpReader:
        return DumpReader(self.options)


def scan_catalog_dump(spark: SparkSession, path: str, stages: Sequence[str] = tuple(STAGES)) -> DataFrame:
    """The dump's rows for these stages."""
    spark.dataSource.register(CatalogDump)
    return spark.read.format("catalog_dump").option("stages", ",".join(stages)).load(path)


def node_records(dump: DataFrame, node: str, schema: str) -> DataFrame:
    """(pos, key, and the fields of ``schema``) of one node's entries; for translations also their language."""
    rows = dump.filter(F.col("node") == node).select(*(["lang"] if node == "translations" else []), "pos", "key", F.from_json("value", schema).alias("v"))
    return rows.select(*[c for c in rows.columns if c != "v"], "v.*")


def listed_items(dump: DataFrame) -> DataFrame:
    """(item_id, name) of the list node in any of its three forms: an array, an object with ``list``, or an object of positions."""
    rows = dump.filter("node = 'list'")
    inner = rows.filter("key = 'list'").select(F.explode(normalize_plant_list(F.col("value"))).alias("e")).select("e.item_id", "e.name")
    name = F.get_json_object(F.concat(F.lit("["), "value", F.lit("]")), "$[0]")
    return rows.select(F.col("key").try_cast("long").alias("item_id"), name.alias("name")).filter("item_id is not null").unionByName(inner)
