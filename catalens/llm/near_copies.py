"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates are, for one, the links of SimHash fingerprints of those shingles by deletion variants (``simhash.near_links``).
Fingerprints of texts at 0.8 are about 10 of 64 bits apart, where variants would need hundreds of rows a text; so, for
the other, texts that share a band of their shingles' least hashes are linked as well: 24 bands of 5 minima each, so
that a pair at 0.8 shares no band with probability (1 - 0.8^5)^24 = 7e-5, and pairs above it more rarely.

The components of those links are compared exactly: the texts of a component meet once (a large one in block pairs), the
sizes of their intersections are counted from 64-bit hashes of all shingles, and only pairs that reach the similarity
are links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.llm.chunks import slices
from catalens.llm.common import append, saved, texts_of, whole_runs, with_columns
from catalens.llm.components import cells, connected_components
from catalens.llm.simhash import near_links
from catalens.llm.substrings import _Q, _mix, word_hashes

SHINGLE, PERCENT, BANDS, MINIMA = 5, 80, 24, 5
#: Bytes of text in a block, and those that are worked on at once.
BLOCK, SLICE = 3_000_000, 1_500_000

_FACTORS = np.random.default_rng(7).integers(0, 1 << 63, BANDS * MINIMA, np.uint64) * np.uint64(2) + np.uint64(1)


def _words(text: str | None) -> bytes:
    return b" ".join(text.encode().lower().split()) if text else b""  # as in the fingerprints of op7


def shingles(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's word shingles (repeats included; fewer words than ``size`` are one shingle), and their number by text."""
    hashes, counts = word_hashes(texts)
    first = np.cumsum(counts) - counts
    many = np.where(counts < size, np.minimum(counts, 1), counts - size + 1)
    row = np.repeat(np.arange(len(counts)), many)
    at = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    left = first[row] + counts[row] - at
    gram = np.zeros(len(at), np.uint64)
    for j in range(size):
        here = j < left
        word = hashes[np.minimum(at + j, max(0, len(hashes) - 1))] if len(hashes) else gram
        gram = np.where(here, gram * np.uint64(_Q) + word, gram)
    return _mix(gram), many


def bands(gram: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The band hashes of each text (rows of BANDS), from its shingles' hashes, which begin at ``starts``."""
    out = np.empty((len(starts), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(starts), b + 1, np.uint64)
        for factor in _FACTORS[b * MINIMA : (b + 1) * MINIMA]:
            key = _mix(key * np.uint64(_Q) + np.minimum.reduceat(gram * factor, starts))
        out[:, b] = key
    return out.view(np.int64)


def simhashes(gram: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The fingerprint of each text: a bit is 1 if set in over half of its shingles' hashes."""
    ones = np.empty((len(starts), 64), np.int64)
    for byte in range(8):
        bits = np.unpackbits(((gram >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.uint8)[:, None], axis=1, bitorder="little")
        ones[:, 8 * byte : 8 * byte + 8] = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
    size = np.diff(np.append(starts, len(gram)))
    return np.packbits(2 * ones > size[:, None], axis=1, bitorder="little").view("<i8").ravel()


def _signed(df: DataFrame, banded: bool) -> DataFrame:
    """``df`` with ``key`` (a hash of the text's words in lower case) and, if asked for, ``bands``, ``fp`` and ``size`` of texts with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words = [_words(t) for t in texts_of(part, "text")]
                more = {"key": pa.array(np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64).view(np.int64))}
                if banded:
                    gram, many = shingles(words)
                    some = np.flatnonzero(many)
                    starts = (np.cumsum(many) - many)[some]
                    held = np.zeros(len(words) + 1, np.int32)
                    held[some + 1] = BANDS
                    found, fp = (bands(gram, starts), simhashes(gram, starts)) if len(some) else (np.zeros(0, np.int64),) * 2
                    wide = np.zeros(len(words), np.int64)
                    wide[some] = fp
                    more |= {"bands": pa.ListArray.from_arrays(pa.array(np.cumsum(held), pa.int32()), pa.array(found.ravel())), "fp": pa.array(wide, mask=many == 0), "size": pa.array([len(w) for w in words], pa.int64())}
                yield append(part, **more)

    return df.mapInArrow(run, with_columns(df.schema, "key long" + ", bands array<long>, fp long, size long" * banded))


def similar(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that span the classes of the sets (each without repeats) with a Jaccard similarity of ``percent`` or more."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    kinds, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(size) - size
    held = np.zeros(len(kinds), np.int32)
    label, links = np.arange(n), []
    for i in range(n - 1):
        if (label == label[0]).all():
            break
        own = flat[starts[i] : starts[i] + size[i]]
        held[own] = 1
        shared = np.add.reduceat(held[flat[starts[i] :]], starts[i:] - starts[i]).astype(np.int64)
        held[own] = 0
        near = i + np.flatnonzero(100 * shared >= percent * (size[i] + size[i:] - shared))
        for j in near[label[near] != label[i]]:
            if label[j] != label[i]:
                links.append((i, int(j)))
                label[label == label[j]] = label[i]
    return links


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each cell's texts; batches are sorted by (component, cell)."""
    for part in whole_runs(batches, ["component", "cell"], 200):
        component, cell, key = (part[c].to_numpy() for c in ("component", "cell", "key"))
        edge = np.flatnonzero((component[1:] != component[:-1]) | (cell[1:] != cell[:-1])) + 1
        for lo, hi in zip([0, *edge], [*edge, len(key)]):
            gram, many = shingles([_words(t) for t in part["text"].slice(lo, hi - lo).to_pylist()])
            pairs = similar([np.unique(g) for g in np.split(gram, np.cumsum(many)[:-1])])
            if pairs:
                a, b = key[lo + np.array(pairs)].T
                yield pa.RecordBatch.from_arrays([pa.array(a.copy()), pa.array(b.copy())], names=["a", "b"])


def near_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text", cap: int = BLOCK) -> DataFrame:
    """(doc_id, component_id) for each row: the smallest id reachable by links of similar texts.

    Texts of the same words are one class from the start, and so are those without words, null among them. Repeated rows
    are returned as often as they come. A null id stays null and is no component's smallest unless all its ids are null.
    Other columns play no part, whatever their names. An empty table gives an empty one.
    """
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = saved(_signed(docs, True).select("doc_id", "key", "bands", "fp", "size"))
    classes = rows.groupBy("key").agg(F.min("doc_id").alias("first"), F.first("bands").alias("bands"), F.first("fp").alias("fp"), F.first("size").alias("size"))
    banded = classes.select("key", F.explode("bands").alias("band"))
    least = banded.groupBy("band").agg(F.min("key").alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # texts of one fingerprint are linked to the least of them, and those of near fingerprints to one another
    of_print = classes.filter("fp is not null").groupBy("fp").agg(F.min("key").alias("least"))
    prints = near_links(of_print.select("fp")).distinct().join(of_print.select(F.col("fp").alias("a"), F.col("least").alias("key")), "a").join(of_print.select(F.col("fp").alias("b"), "least"), "b").select("key", "least")
    same = classes.join(of_print, "fp").filter("key != least").select("key", "least")
    links = banded.join(least, "band").filter("key != least").select("key", "least").unionByName(same).unionByName(prints)
    candidates = connected_components(links.distinct(), "key", "least", tidy=True)
    dealt = cells(candidates.select(F.col("id").alias("key"), F.col("component_id").alias("component")).join(classes.select("key", "size"), "key"), "component", "key", cap, "size")
    members = classes.select("key", "first").join(candidates.select(F.col("id").alias("key")), "key", "left_semi").withColumnRenamed("first", "doc_id")
    # one row stands for a class: that of its smallest id
    told = _signed(docs, False).join(members.withColumnsRenamed({"key": "k", "doc_id": "d"}), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k"))).groupBy("key").agg(F.first("text").alias("text"))
    met = dealt.select("component", "cell", "key").join(told, "key").repartition("component", "cell").sortWithinPartitions("component", "cell")
    component = connected_components(met.mapInArrow(_verified, "a long, b long").distinct(), tidy=True)
    of_class = classes.select("key", "first").join(component, F.col("key") == F.col("id"), "left").select("key", "first", F.coalesce("component_id", "key").alias("group"))
    smallest = of_class.groupBy("group").agg(F.min("first").alias("component_id"))
    return rows.select("doc_id", "key").join(of_class.join(smallest, "group").select("key", "component_id"), "key").select("doc_id", "component_id")
