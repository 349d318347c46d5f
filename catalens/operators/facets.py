"""Faceted counts and posting lists over a complete key domain.

An item has several values on each axis. A key names one value, or the wildcard (empty part), for each axis, joined with
``_``. Item values outside an axis's domain are ignored.

Items with the same values on all axes are one vector. Vectors are found first, by a partial aggregation, and only they
are exploded to the keys they match: so what is exploded follows the distinct vectors and not the items, and each pair of
vector and key is made once, so multi-valued items are not counted twice, which a CUBE over exploded axes would do.

Posting lists are cut into blocks by range of ids, so that a common key has a row for each block, which many tasks make
and read. They are worked on as places within a block and stored as the gaps between them: small numbers that Parquet's
dictionary packs into a few bits each.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WILDCARD = ""
#: Ids in the range of a block, so that places in it fit a smallint.
BLOCK = 1 << 15


def facet_keys(spark: SparkSession, domains: dict[str, Sequence[str]]) -> DataFrame:
    """All keys: the product of each axis's domain and the wildcard. Its size is fixed by the domains."""
    out = spark.range(1)
    for axis, domain in domains.items():
        out = out.withColumn(axis, F.explode(F.array(*[F.lit(str(v)) for v in [WILDCARD, *domain]])))
    return out.select(facet_key([F.col(a) for a in domains]).alias("key"))


def facet_key(parts: Sequence[Column]) -> Column:
    """The key of one value (null: wildcard) for each axis."""
    return F.concat_ws("_", *[F.coalesce(p.cast("string"), F.lit(WILDCARD)) for p in parts])


def axis_vectors(items: DataFrame, item_id: str, domains: dict[str, Sequence[str]]) -> DataFrame:
    """(item_id, axes): the allowed values of each axis in order, each once; the columns named in ``domains`` are arrays (null: no values)."""
    none = F.array().cast("array<string>")
    allowed = lambda axis, domain: F.sort_array(F.array_intersect(F.coalesce(F.col(axis).cast("array<string>"), none), F.array(*[F.lit(str(v)) for v in domain])))
    return items.select(item_id, *[allowed(a, d).alias(a) for a, d in domains.items()])


def explode_keys(vectors: DataFrame, axes: Sequence[str]) -> DataFrame:
    """``vectors`` once for each key they match, with ``key`` in place of the axes."""
    others = [c for c in vectors.columns if c not in axes]
    out = vectors.select(*others, *[F.concat(F.array(F.lit(WILDCARD)), a).alias(a) for a in axes])
    for axis in axes:
        out = out.withColumn(axis, F.explode(axis))
    return out.select(facet_key([F.col(a) for a in axes]).alias("key"), *others)


def matching_keys(items: DataFrame, item_id: str, domains: dict[str, Sequence[str]]) -> DataFrame:
    """(key, item_id) for each key an item matches: for a few items, as changed ones, or where pairs themselves are wanted."""
    return explode_keys(axis_vectors(items, item_id, domains), list(domains))


def _keys_of(vectors: str, axes: Sequence[str]) -> Column:
    """The distinct keys that any of an item's vectors matches, as an array."""

    def product(v: Column) -> Column:
        values = lambda axis: F.concat(F.array(F.lit(WILDCARD)), v[axis])
        keys = values(axes[0])
        for axis in axes[1:]:
            keys = F.flatten(F.transform(keys, lambda k: F.transform(values(axis), lambda x: F.concat(k, F.lit("_"), x))))  # noqa: B023
        return keys

    return F.array_distinct(F.flatten(F.transform(vectors, product)))


def facet_counts(items: DataFrame, item_id: str, domains: dict[str, Sequence[str]]) -> DataFrame:
    """Items per key; keys of the domain without items are kept with zero."""
    vectors = axis_vectors(items, item_id, domains).groupBy(*domains).agg(F.count("*").alias("items"))
    found = explode_keys(vectors, list(domains)).groupBy("key").agg(F.sum("items").alias("found"))
    keys = facet_keys(items.sparkSession, domains)
    return keys.join(found, "key", "left").select("key", F.coalesce("found", F.lit(0)).cast("long").alias("n"))


def facet_members(items: DataFrame, item_id: str, domains: dict[str, Sequence[str]]) -> DataFrame:
    """Posting rows (key, item_id), each once: keys are made distinct within an item, so items are shuffled and not their keys."""
    held = axis_vectors(items, item_id, domains).groupBy(item_id).agg(F.collect_set(F.struct(*domains)).alias("__v"))
    return held.select(F.explode(_keys_of("__v", list(domains))).alias("key"), item_id)


def facet_lists(items: DataFrame, item_id: str, domains: dict[str, Sequence[str]], block: int = BLOCK) -> DataFrame:
    """(key, block, places): the posting lists of keys with items, in blocks of ``block`` ids (whole numbers; null ids are in no list)."""
    vectors = axis_vectors(items, item_id, domains).filter(F.col(item_id).isNotNull())
    number = F.floor(F.col(item_id) / block)
    dealt = vectors.groupBy(*domains, number.alias("block")).agg(F.collect_set((F.col(item_id) - number * block).cast("smallint")).alias("places"))
    return _united(explode_keys(dealt, list(domains)))


def _united(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("key", "block").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"))


def merge_lists(base: DataFrame, patch: DataFrame) -> DataFrame:
    """Two sets of posting lists in one: the same lists however often a patch is merged."""
    return _united(base.unionByName(patch))


def list_ids(places: Column, number: Column, block: int = BLOCK) -> Column:
    """The ids of a block in order."""
    return F.transform(places, lambda x: x.cast("long") + number * block)


def stored_lists(lists: DataFrame) -> DataFrame:
    """(key, block, gaps) to be written: each place less the one before it, the first as it is."""
    before = F.concat(F.array(F.lit(0).cast("smallint")), F.slice("places", F.lit(1), F.size("places") - 1))
    return lists.select("key", "block", F.zip_with("places", before, lambda x, y: (x - y).cast("smallint")).alias("gaps"))


def read_lists(stored: DataFrame) -> DataFrame:
    """(key, block, places) of stored lists: running sums, which no function on arrays makes in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gaps = batch.column(2)
            size = gaps.value_lengths().to_numpy()
            sums = np.cumsum(gaps.flatten().to_numpy(), dtype=np.int64)
            ends = np.cumsum(size, dtype=np.int64)
            before = np.concatenate([[0], sums])[ends - size]
            places = pa.array((sums - np.repeat(before, size)).astype(np.int16))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), places)], names=["key", "block", "places"])

    return stored.select("key", "block", "gaps").mapInArrow(run, "key string, block long, places array<smallint>")


def list_counts(lists: DataFrame, keys: DataFrame) -> DataFrame:
    """Items per key, from the lists themselves; zeros are kept for the keys of the domain."""
    found = lists.groupBy("key").agg(F.sum(F.size("places")).alias("found"))
    return keys.join(found, "key", "left").select("key", F.coalesce("found", F.lit(0)).cast("long").alias("n"))


def facet_match(key: Column, axes: Sequence[Column]) -> Column:
    """Whether an item with these axis arrays matches a key; a key without as many parts as axes matches nothing."""
    parts = F.split(key, "_", -1)
    each = [(F.element_at(parts, i + 1) == WILDCARD) | F.coalesce(F.array_contains(a.cast("array<string>"), F.element_at(parts, i + 1)), F.lit(False)) for i, a in enumerate(axes)]
    return F.when(F.size(parts) == len(axes), reduce(Column.__and__, each)).otherwise(F.lit(False))


def facet_key_diff(old: DataFrame, new: DataFrame, item_id: str, domains: dict[str, Sequence[str]]) -> DataFrame:
    """(item_id, key, change) with change ``add`` or ``remove`` between two states of the items.

    The states of an item meet as vectors, and its keys are compared in its row: what is shuffled follows the items.
    """
    a = axis_vectors(old, item_id, domains).select(item_id, F.struct(*domains).alias("was"))
    b = axis_vectors(new, item_id, domains).select(item_id, F.struct(*domains).alias("now"))
    both = a.unionByName(b, allowMissingColumns=True).groupBy(item_id).agg(F.collect_set("was").alias("was"), F.collect_set("now").alias("now"))
    both = both.filter(F.col("was") != F.col("now")).select(item_id, _keys_of("was", list(domains)).alias("was"), _keys_of("now", list(domains)).alias("now"))
    told = lambda keys, change: F.transform(keys, lambda k: F.struct(k.alias("key"), F.lit(change).alias("change")))
    changes = F.concat(told(F.array_except("now", "was"), "add"), told(F.array_except("was", "now"), "remove"))
    return both.select(item_id, F.explode(changes).alias("c")).select(item_id, "c.key", "c.change")
