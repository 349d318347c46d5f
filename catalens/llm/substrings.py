"""Repeated passages by prefix-partitioned suffix trees over words.

Suffixes are split into groups by a prefix of varying length: from a suffix's start to the end of the anchor that its
first ``size`` words choose, the smallest by hash of the runs of ``ANCHOR`` words among them (leftmost of equals). Equal
windows choose the same anchor at the same offset, so suffixes that share their first ``size`` words fall into one
group. Groups that a count proves to hold a single suffix have no inner node and are left out before any words are
sent. A group too large for a task is cut by hash first; of each part only the earliest suffix of a node is left, and
those meet again under the longest prefix, all ``size`` words, where a node's parts are few.

A group's subtree is its suffixes in order of their words, each as far as the words sent for its anchor reach (from
``size`` to 2 ``size`` - ``ANCHOR`` words), with the lengths that neighbours have in common: the intervals of neighbours
sharing ``size`` words or more are the subtree's deep inner nodes, each a repeat. All but the earliest leaf of a node are
repeats of an earlier passage; runs of them in a document make up its maximal repeats. Words are compared by 64-bit
codes, which are no function of their letters' positions and sums.

Documents with the same whole text are one from the start: of copies only the one of smallest id is cut into suffixes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalens.llm.chunks import slices
from catalens.llm.common import partitions_for, saved, texts_of, whole_runs

SIZE, ANCHOR, GROUP_ROWS = 20, 7, 4096
#: A prefix of over a HEAVY-th of all places is dealt over SALTS tasks; there are fewer than HEAVY of them.
HEAVY, SALTS = 1000, 64
#: Bytes of text that are worked on at once.
SLICE = 1_500_000
#: Stands for a null id while documents are joined; a row of this id counts as one without.
NO_ID = -(1 << 63)
#: A place holds 28 bits of the text's hash, 30 of the first word's number and 6 of how many windows begin there, or of where the anchor is.
START = (1 << 30) - 1

_P, _Q = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str | None] | list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of each text, never 0, and how many words each text has. Words end at ASCII white space.

    A word is taken 8 bytes at a time, each mixed into what the ones before it gave; words over 64 bytes by XXH3.
    """
    raw = [b"" if t is None else t if isinstance(t, bytes) else t.encode() for t in texts]
    joined = b"\n".join(raw) + b"\n" * 8
    data = np.frombuffer(joined, np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    eights = np.ndarray(len(data) - 7, "<u8", joined, strides=(1,))
    size = end - start
    hashes = size.astype(np.uint64) * np.uint64(_P)
    left = np.arange(len(start))
    for at in range(0, 64, 8):
        left = left[size[left] > at] if at else left
        if not len(left):
            break
        eight = eights[start[left] + at] & _MASKS[np.minimum(size[left] - at, 8)]
        hashes[left] = _mix((hashes[left] ^ eight) * np.uint64(_Q) + np.uint64(at + 1))
    for i in np.flatnonzero(size > 64).tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(joined[start[i] : end[i]], 42)
    hashes[hashes == 0] = 1
    bounds = np.cumsum([len(r) + 1 for r in raw])
    counts = np.diff(np.searchsorted(start, np.concatenate([[0], bounds])))
    return hashes, counts


def anchors(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """For each anchor: its hash, its text, the first and the number of the windows in that text that choose it, and its place behind the first."""
    width = min(ANCHOR, size)
    n = len(hashes)
    if n < size:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none, none
    gram = np.zeros(n - width + 1, np.uint64)
    for j in range(width):
        gram = gram * np.uint64(_Q) + hashes[j : j + len(gram)]
    gram = _mix(gram)
    text = np.repeat(np.arange(len(counts)), counts)
    first = np.repeat(np.cumsum(counts) - counts, counts)
    at = np.flatnonzero(text[: n - size + 1] == text[size - 1 :])  # windows inside one text
    choice = np.lib.stride_tricks.sliding_window_view(gram, size - width + 1)[at].argmin(1) + at
    new = np.ones(len(at), bool)
    new[1:] = (choice[1:] != choice[:-1]) | (at[1:] != at[:-1] + 1)
    lead = np.flatnonzero(new)
    return gram[choice[lead]], text[at[lead]], (at - first[at])[lead], np.diff(np.append(lead, len(at))), (choice - at)[lead]


def _anchor_rows(size: int, places: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                key, text, start, windows, _ = anchors(*word_hashes(texts_of(part, "text")), size)
                keys = pa.array(key.view(np.int64))
                if not places:
                    yield pa.RecordBatch.from_arrays([keys], names=["key"])
                    continue
                column = lambda name: part.column(part.schema.get_field_index(name)).take(pa.array(text))  # noqa: B023,E731
                place = (column("body").to_numpy() << 36) | (start << 6) | windows
                yield pa.RecordBatch.from_arrays([keys, column("doc_id"), pa.array(place)], names=["key", "doc_id", "place"])

    return run


def _suffix_rows(size: int):
    """The suffixes at a document's places: words from the first window's start to the last one's end, as 64-bit codes.

    The anchor's words, which a group's suffixes have in common, stay behind; the place tells where they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                get = lambda name: part.column(part.schema.get_field_index(name))  # noqa: B023,E731
                hashes, counts = word_hashes(texts_of(part, "text"))
                codes = hashes.astype("<u8")
                key, row, start, windows, offset = anchors(hashes, counts, size)
                places = get("places")
                place = places.flatten().to_numpy()
                of = np.repeat(np.arange(part.num_rows), places.value_lengths().to_numpy(zero_copy_only=False))
                known = (of << 40) | (place >> 28)
                order = np.argsort(known)
                spot = (row << 40) | start
                at_ = np.minimum(np.searchsorted(known, spot, sorter=order), max(0, len(known) - 1))
                hit = np.flatnonzero(known[order[at_]] == spot) if len(known) else np.zeros(0, np.int64)
                parts = (place[order[at_[hit]]] >> 8) & 0xFFFFF
                key, row, start, windows, offset = (x[hit] for x in (key, row, start, windows, offset))
                first = np.cumsum(counts) - counts
                begin, width = first[row] + start, min(ANCHOR, size)
                cut = begin + offset
                words = [codes[a:b].tobytes() + codes[c:d].tobytes() for a, b, c, d in zip(begin.tolist(), cut.tolist(), (cut + width).tolist(), (begin + windows - 1 + size).tolist())]
                doc = get("doc_id").take(pa.array(row))
                salt = _mix((start + 1).astype(np.uint64) * np.uint64(_P) + doc.to_numpy().view(np.uint64))
                dealt = np.where(parts > 1, 1 + (salt % np.maximum(parts, 1).astype(np.uint64)).astype(np.int64), 0)  # 0: the whole group
                place = (get("body").take(pa.array(row)).to_numpy() << 36) | (start << 6) | offset
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(dealt.astype(np.int32)), doc, pa.array(place), pa.array(words, pa.binary())], names=["key", "part", "doc_id", "place", "words"])

    return run


def subtree(words: np.ndarray, reach: np.ndarray, group: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of group, words and place, and how many words each has in common with the one before it.

    ``words`` has a suffix in each row, 0 behind its end; ``reach`` is how many words it has.
    """
    order = np.lexsort([start, doc])
    text = np.concatenate([group.astype(">u8")[:, None], words.astype(">u8")], 1)
    text = np.ascontiguousarray(text).view(f"S{8 * text.shape[1]}").ravel()
    order = order[np.argsort(text[order], kind="stable")]
    w, g, r = words[order], group[order], reach[order]
    same = np.ones((len(w), words.shape[1] + 1), bool)
    same[1:, :-1] = w[1:] == w[:-1]
    same[:, -1] = False
    common = same.argmin(1)
    common[1:] = np.minimum(common[1:], np.minimum(r[1:], r[:-1]))
    common[:1] = 0
    common[1:][g[1:] != g[:-1]] = 0
    return order, common


def _repeats(size: int):
    """For each group, the windows that repeat an earlier one; of cut groups also what is left, under its longest prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_runs(batches, ["key", "part"], 10_000):
            n = part.num_rows
            key, piece, doc, place = (part[c].to_numpy() for c in ("key", "part", "doc_id", "place"))
            start, body = (place >> 6) & START, place.view(np.uint64) >> np.uint64(36)
            new = np.ones(n, bool)
            new[1:] = (key[1:] != key[:-1]) | (piece[1:] != piece[:-1])
            raw, width = part["words"].to_pylist(), min(ANCHOR, size)
            length = np.array([len(r) // 8 for r in raw]) + width
            first = np.cumsum(length) - length
            codes = np.zeros(int(length.sum() + length.max()), "<u8")
            text = np.ones(len(codes), bool)
            text[int(length.sum()) :] = False
            text[((first + (place & 63))[:, None] + np.arange(width)).ravel()] = False
            codes[text] = np.frombuffer(b"".join(raw), "<u8")
            windows = length - size + 1
            row = np.repeat(np.arange(n), windows)
            shift = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
            reach = length[row] - shift
            deep = np.arange(int(length.max()))
            words = np.where(deep < reach[:, None], codes[(first[row] + shift)[:, None] + deep], np.uint64(0))
            # a row has a window once, so (row, start) is its place
            group, d, s = np.cumsum(new)[row], doc[row], start[row] + shift
            order, common = subtree(words, reach, group, d, s)
            node = common < size  # the first leaf of a deep node, or a leaf by itself
            at = np.flatnonzero(node)
            # leaves of a node stand in order of their words beyond its depth: the earliest is not always the first
            rank = np.empty(len(order), np.int64)
            rank[np.lexsort([s, d])] = np.arange(len(order))
            of = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(order))))
            lead = np.lexsort([s, d])[np.minimum.reduceat(rank[order], at)][of]
            again = np.zeros(len(row), bool)
            again[order] = (d[order] != d[lead]) | (s[order] != s[lead])
            mask = np.zeros(n, np.int64)
            np.bitwise_or.at(mask, row[again], np.int64(1) << shift[again])
            use = np.flatnonzero(mask)
            left = np.flatnonzero(~again & (piece[row] > 0))
            h = [key[row[left]].view(np.uint64), np.zeros(len(left), np.uint64)]
            for j in range(size):
                code = words[left, j]
                h = [_mix(h[0] * np.uint64(_P) + code), _mix(h[1] * np.uint64(_Q) + (code ^ np.uint64(_P)))]
            mine = place & ~np.int64(63)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([doc[use], d[left]])),
                    pa.array(np.concatenate([mine[use], mine[row[left]] + (shift[left] << 6)])),
                    pa.array(np.concatenate([mask[use], np.zeros(len(left), np.int64)])),
                    pa.array(np.concatenate([doc[use], h[0].view(np.int64)])),
                    pa.array(np.concatenate([mine[use], h[1].view(np.int64)])),
                ],
                names=["doc_id", "place", "mask", "h1", "h2"],
            )

    return run


def marked(df: DataFrame, size: int, text: str, doc_id: str) -> DataFrame:
    """Columns doc_id, text, rest (a struct of the other columns, if there are any), repeats and copy; see ``repeats``."""
    if not 4 <= size <= 60:
        raise ValueError("size must be from 4 to 60 words")
    others = [F.col(f"`{c}`") for c in df.columns if c not in (doc_id, text)]
    # ids that can't be null, so that both uses of ``dealt`` are read from one shuffle
    id_, t = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NO_ID)), F.col(f"`{text}`")
    body = F.xxhash64(F.coalesce(t, F.lit(""))).bitwiseAND(F.lit((1 << 28) - 1))  # never null to the planner
    rest = [F.struct(*others).alias("rest")] if others else []
    every = df.select(id_.alias("doc_id"), body.alias("body"), t.alias("text"), *rest)
    docs = every.filter(F.col("doc_id") != NO_ID)
    firsts = docs.select("doc_id", "body", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha")).groupBy("sha").agg(F.min(F.struct("doc_id", "body")).alias("f")).select("f.doc_id", "f.body")
    counted = saved(docs.select("text").mapInArrow(_anchor_rows(size, False), "key long").groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
    heavy = F.col("n") >= max(GROUP_ROWS, (counted.agg(F.sum("n")).first()[0] or 0) // HEAVY)
    hot = F.broadcast(counted.filter(heavy).select("key", F.lit(True).alias("hot")))  # fewer than HEAVY rows
    salts = F.explode(F.sequence(F.lit(0), F.when(heavy, SALTS - 1).otherwise(0)))
    placed = docs.select("doc_id", "body", "text").mapInArrow(_anchor_rows(size, True), "key long, doc_id long, place long").join(hot, "key", "left")
    placed = placed.withColumn("salt", F.when(F.col("hot"), F.pmod(F.hash("doc_id", "place"), F.lit(SALTS))).otherwise(0)).drop("hot")
    parts = F.least(F.ceil(F.col("n") / GROUP_ROWS), F.lit(0xFFFFF))
    # start, parts of the group and windows in one number
    packed = F.shiftleft(F.shiftright("place", 6).bitwiseAND(F.lit(START)), 28) + parts * 256 + F.col("place").bitwiseAND(F.lit(63))
    inner = placed.join(counted.withColumn("salt", salts), ["key", "salt"]).groupBy("doc_id", F.shiftrightunsigned("place", 36).alias("body")).agg(F.collect_list(packed).alias("places"))
    # dealt once, for the suffixes and for the answer
    dealt = every.repartition(partitions_for(df.sparkSession), "doc_id", "body")
    # all columns go on to the tasks, or the two uses would be dealt differently
    work = dealt.join(inner.join(firsts, ["doc_id", "body"]), ["doc_id", "body"])
    suffixes = work.mapInArrow(_suffix_rows(size), "key long, part int, doc_id long, place long, words binary")
    found = suffixes.repartition("key", "part").sortWithinPartitions("key", "part").mapInArrow(_repeats(size), "doc_id long, place long, mask long, h1 long, h2 long")
    start = F.shiftright("place", 6).bitwiseAND(F.lit(START))
    left = F.col("mask") == 0
    earliest = F.min(F.struct("doc_id", start.alias("start"))).over(Window.partitionBy(left, "h1", "h2"))
    later = (F.col("first.doc_id") != F.col("doc_id")) | (F.col("first.start") != start)
    marks = found.withColumn("first", earliest).withColumn("mask", F.when(left, later.cast("long")).otherwise(F.col("mask"))).filter("mask != 0")
    marks = marks.groupBy("doc_id", F.shiftrightunsigned("place", 36).alias("body")).agg(F.collect_list(F.struct(start.alias("start"), "mask")).alias("repeats"))
    known = firsts.join(marks, ["doc_id", "body"], "left").withColumn("copy", F.lit(False))
    has_id = F.col("doc_id") != NO_ID
    out = dealt.join(known, ["doc_id", "body"], "left").withColumn("copy", has_id & F.coalesce("copy", F.lit(True)) & F.coalesce(F.col("text") != "", F.lit(False)))
    return out.select(F.when(has_id, F.col("doc_id")).alias("doc_id"), "text", *["rest"] * len(rest), "repeats", "copy")


def unpacked(df: DataFrame, of: DataFrame, text: str, doc_id: str, new: tuple[str, ...]) -> DataFrame:
    """``df`` with the columns of ``of`` by their own names, then the new ones; old columns of the new ones' names give way."""
    low = {c.lower() for c in new}
    own = {doc_id: F.col("doc_id"), text: F.col("text")}
    return df.select(*[own.get(c, F.col(f"rest.`{c}`")).alias(c) for c in of.columns if c.lower() not in low], *new)


def repeats(df: DataFrame, size: int = SIZE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``df`` with ``repeats``: for each row the windows of ``size`` words that also start earlier, as (start, mask) pairs, and ``copy``.

    Bit i of a mask stands for the window i words behind start. ``copy`` is true of a row whose whole text a smaller id
    has as well; it has no pairs, as all its windows are repeats. Earlier means a smaller id, or the same id and an
    earlier start; rows that repeat an id are the same document, so a window at the same start of such a row is not
    earlier. Rows with a null id have no order: they repeat nothing and are repeated by nothing. Null texts have no words.
    Other columns stay, whatever their names; old columns named repeats or copy are replaced.
    """
    return unpacked(marked(df, size, text, doc_id), df, text, doc_id, ("repeats", "copy"))


def covered(n_words: int, pairs: list | None, copy: bool, size: int) -> np.ndarray:
    """Which words of a text a repeated window covers."""
    if copy:
        return np.full(n_words, n_words >= size)
    depth = np.zeros(n_words + 1, np.int64)
    if pairs:
        start, mask = (np.array([p[k] for p in pairs], np.int64) for k in ("start", "mask"))
        for i in range(int(mask.max()).bit_length()):
            at = start[(mask >> i) & 1 == 1] + i
            np.add.at(depth, at, 1)
            np.add.at(depth, at + size, -1)
    return np.cumsum(depth[:-1]) > 0


def _spans(gone: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def dedupe(df: DataFrame, size: int = SIZE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``df`` with each text's words that no repeated window covers, joined by one space, and spans and n_words.

    ``spans`` are the maximal runs of covered words, as [from, to) in the text given. All rows come back, with their
    other columns; a null text stays null if there was nothing to remove, which is always so. See ``repeats`` for null
    ids, repeated ids and null texts. Old columns named spans or n_words are replaced, others stay whatever their names.
    """
    found = marked(df, size, text, doc_id)
    names = [c for c in found.columns if c not in ("repeats", "copy")]
    schema = T.StructType([*(found.schema[c] for c in names), *T._parse_datatype_string("n_words long, spans array<struct<from: int, to: int>>")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                column = dict(zip(part.schema.names, part.columns))
                texts, counts, spans = [], [], []
                for t, pairs, copy in zip(texts_of(part, "text"), column["repeats"].to_pylist(), column["copy"].to_pylist()):
                    words = [] if t is None else t.encode().split()
                    gone = covered(len(words), pairs, copy, size) if pairs or copy else None
                    counts.append(len(words))
                    spans.append([{"from": a, "to": b} for a, b in _spans(gone)] if gone is not None else [])
                    kept = words if gone is None else [w for w, g in zip(words, gone.tolist()) if not g]
                    texts.append(None if t is None else b" ".join(kept).decode())
                column["text"] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays([*(column[c] for c in names), pa.array(counts, pa.int64()), pa.array(spans, spans_type)], names=[*names, "n_words", "spans"])

    return unpacked(found.mapInArrow(run, schema), df, text, doc_id, ("n_words", "spans"))


def op5_substrings(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    done = dedupe(documents.select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["to"] - s["from"]))
    return done.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
