"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints with at most 3 differing bits, cut into 2 halves, have a half in which they differ by one bit at most. So
each distinct fingerprint is indexed by both halves with each of their bits left out in turn (2 x 32 variants); two such
fingerprints meet in the bucket of a variant, and there are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.llm.common import append, partitions_for, saved, texts_of, whole_runs, with_columns
from catalens.llm.components import cells, connected_components, forest, run_pairs

SHINGLE, SEED, BITS_APART, BLOCK = 3, 42, 3, 1024


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles, repeats included; 0 without words."""
    words = text.encode().lower().split() if text else []  # bytes: A-Z only are lowered, and only ASCII space splits
    if not words:
        return 0
    if len(words) < size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 200):  # up to 200 bits add up in a byte
        bits = np.unpackbits(hashes[at : at + 200].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.uint8)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text: str = "text", to: str = "fp") -> DataFrame:
    """``df`` with column ``to``: the fingerprint of each whole text as a signed long (null or no words: 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t) for t in texts_of(batch, text)], np.uint64)
            yield append(batch, **{to: pa.array(found.view(np.int64))})

    return df.mapInArrow(run, with_columns(df.schema, f"`{to}` long"))


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links of each bucket's fingerprints that differ by few bits; batches are sorted by (variant, cell)."""
    for part in whole_runs(batches, ["variant", "cell"]):
        variant, cell, fp, home = (part[c].to_numpy() for c in ("variant", "cell", "fp", "home"))
        n = len(fp)
        new = np.ones(n, bool)
        new[1:] = (variant[1:] != variant[:-1]) | (cell[1:] != cell[:-1])
        bits = fp.view(np.uint64)
        label = np.arange(n)
        for i, j in run_pairs(np.flatnonzero(new), n):
            near = np.bitwise_count(bits[i] ^ bits[j]) <= BITS_APART
            near &= (home[i] < 0) | (home[i] != home[j])
            if near.any():
                low = forest(n, np.append(np.arange(n), i[near]), np.append(label, j[near]))
                label = low
        far = np.flatnonzero(label != np.arange(n))
        a, b = fp[far], fp[label[far]]
        if len(a):
            pairs = np.unique(np.stack([a, b], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])


def near_links(distinct: DataFrame, cap: int = BLOCK) -> DataFrame:
    """(a, b): links that span the classes of fingerprints (column fp, distinct) within 3 bits of each other."""
    halves = [F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))]
    keys = []
    for h, half in enumerate(halves):
        for bit in range(32):
            # the half without one bit, and behind it which half and which bit
            keys.append(F.shiftleft(half.bitwiseAND(F.lit(0xFFFFFFFF & ~(1 << bit))), 6) + F.lit(32 * h + bit))
    # dealt out before each becomes 64 rows
    variants = distinct.repartition(partitions_for(distinct.sparkSession), "fp").select("fp", F.explode(F.array(*keys)).alias("variant"))
    dealt = cells(variants, "variant", "fp", cap)
    return dealt.repartition("variant", "cell").sortWithinPartitions("variant", "cell").mapInArrow(_links, "a long, b long")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for each row: its fingerprint, and the smallest id reachable by links within 3 bits.

    Texts that are null or hold no word have fingerprint 0 and link like any other. Rows with one fingerprint are one
    class from the start, so thousands of copies cost no pairs. Repeated rows are returned as often as they come. A null
    id stays null and is no component's smallest unless all its ids are null.
    """
    rows = saved(fingerprints(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))).select("doc_id", "fp"))
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    component = connected_components(near_links(classes.select("fp")).distinct())
    of_class = classes.join(component, F.col("fp") == F.col("id"), "left").select("fp", "first", F.coalesce("component_id", "fp").alias("group"))
    smallest = of_class.groupBy("group").agg(F.min("first").alias("component_id"))
    return rows.join(of_class.join(smallest, "group").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def op7_simhash(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id."""
    return near_duplicates(documents).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
