"""Best-fit packing of documents into sequences, certified by lower bounds and mended where a bound shows a gap.

Documents longer than a sequence are cut; all pieces are dealt over partitions by hash, so that a partition is a fair
sample of the lengths whatever the source. Each partition packs its pieces by best-fit decreasing, and dual-feasible
functions of its lengths prove how many bins any packing of them needs. Full bins stay; the pieces of bins with gaps
are exchanged: dealt anew over fewer partitions and packed again. This goes on until the bins of all partitions are as
few as the bound of all lengths, a single partition is left, or a round neither saves a bin nor fills bins enough to
settle a quarter of its pieces. So what moves between rounds shrinks; a task's share of pieces doubles from round to
round, up to 16 times the first one.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.llm.chunks import Column, cut_at_spaces, gathered, slices, with_ends
from catalens.llm.common import Memo, append, byte_shower, fresh, held, map_batches, saved, with_columns

CAPACITY, END_ID, PIECES_PER_TASK = 4096, 1, 40_000


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing of ``lengths`` needs."""
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1).astype(np.int64), capacity)


def bound_of_counts(count: np.ndarray, capacity: int) -> int:
    """Bins that any packing of so many pieces of each length needs, by the best of the dual-feasible functions tried.

    u_k (k = 1..20) rounds (k+1)x/C down to whole k-ths unless it is whole; U_e (each e up to C/2) counts pieces over
    C - e as full bins and drops those under e; the plain sum is U_0.
    """
    x = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * x).sum()) // capacity)
    for k in range(1, 21):
        whole = (k + 1) * x % capacity == 0
        weight = np.where(whole, x * k, (k + 1) * x // capacity * capacity)  # in units of 1 / (k C)
        best = max(best, -(-int((count * weight).sum()) // (k * capacity)))
    above = np.cumsum(count[::-1])[::-1]
    mass = np.concatenate([[0], np.cumsum(count * x)])
    e = np.arange(1, capacity // 2 + 1)
    big = above[capacity - e + 1]  # pieces over C - e
    middle = mass[capacity - e + 1] - mass[e]  # mass of those from e to C - e
    return max(best, int((big + -(-middle // capacity)).max()))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and the bins' fill. Each piece, longest first, goes to the fullest bin that takes it.

    Open bins are kept by the room they have left, in stacks with a bit mask of the rooms in use; ties go to the bin
    opened or filled last.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, fill = 0, []
    order = np.argsort(-lengths, kind="stable")
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        left = room - size
        if left:
            stacks[left].append(b)
            rooms |= 1 << left
    return bins, offsets, np.array(fill, np.int64)


def _packer(length: str, task: str, capacity: int, first: int):
    """What packs one task's pieces and tells which bins are full."""

    def work(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        sizes = frame[length].to_numpy(np.int64)
        bins, offsets, fill = best_fit_decreasing(sizes, capacity)
        frame = frame.drop(columns=task)
        frame["sequence_id"] = ((first + int(key[0])) << 24) + bins
        frame["offset"] = offsets
        frame["certified"] = len(fill) == lower_bound(sizes, capacity)
        frame["full"] = fill[bins] == capacity
        return frame

    return work


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY, per_task: int = PIECES_PER_TASK) -> DataFrame:
    """``pieces`` with sequence_id, offset, certified and bound.

    ``bound`` is the least number of sequences that any packing of all pieces needs; ``certified`` tells whether the
    round that placed a piece met the bound of its own partition, or all sequences together meet ``bound``. ``pieces``
    should be narrow; each length is from 1 to ``capacity``, and pieces of null or other lengths come back with nulls in
    sequence_id, offset and certified. Repeated rows are pieces of their own and are dealt out apart. Other columns
    stay, whatever their names; old columns named sequence_id, offset, certified, full or bound are replaced. An empty
    table gives an empty one.
    """
    base = pieces.drop(*[c for c in pieces.columns if c.lower() in ("sequence_id", "offset", "certified", "full", "bound")])
    names = base.columns
    row, task = fresh(base, "__row"), fresh(base, "__task")
    base = saved(base.withColumn(row, F.monotonically_increasing_id()))
    size = F.col(f"`{length}`").cast("long")
    fits = F.coalesce(size.between(1, capacity), F.lit(False))
    count = np.zeros(capacity + 1, np.int64)
    for r in base.filter(fits).groupBy(size.alias("size")).agg(F.count("*").alias("n")).collect():  # capacity rows at most
        count[r["size"]] = r["n"]
    bound = bound_of_counts(count, capacity)
    # pieces as long as a sequence fill one each: the sign keeps their numbers apart
    alone = base.filter(fits & (size == capacity)).select("*", (-1 - F.col(row)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified"))
    done = [base.filter(~fits).selectExpr("*", "cast(null as long) sequence_id", "cast(null as long) offset", "cast(null as boolean) certified"), alone]
    schema = with_columns(base.schema, "sequence_id long, offset long, certified boolean, full boolean")
    open_, n, first, settled, before, total = base.filter(fits & (size < capacity)), int(count[:-1].sum()), 0, int(count[-1]), None, int(count[-1])
    last, share = None, per_task
    while n:
        tasks = -(-n // share)
        spread = F.pmod(F.xxhash64(F.lit(first), F.col(row)), F.lit(tasks)).cast("int")
        placed = saved(open_.withColumn(task, spread).groupBy(task).applyInPandas(_packer(length, task, capacity, first), schema))
        # the piece at offset 0 stands for its bin
        full = {r["full"]: (r["pieces"], r["bins"]) for r in placed.groupBy("full").agg(F.count("*").alias("pieces"), F.sum((F.col("offset") == 0).cast("long")).alias("bins")).collect()}
        total = settled + sum(b for _, b in full.values())
        if before is not None and total > before:  # worse: the bins stay as they were
            total, placed, n = before, last, 0
        else:
            left = full.get(False, (0, 0))[0]
            saved_none, n = total == before and left > 0.75 * n, left
            if tasks == 1 or total <= bound or saved_none:
                n = 0
        if not n:
            done.append(placed.drop("full"))
            break
        settled += full.get(True, (0, 0))[1]
        done.append(placed.filter("full").drop("full"))
        before, last = total, placed.filter("not full")
        open_ = last.select(*names, row)
        first, share = first + tasks, min(2 * share, 16 * per_task)
    certified = F.when(F.col("sequence_id").isNotNull() & F.lit(total <= bound), True).otherwise(F.col("certified"))
    return reduce(DataFrame.unionByName, done).select(*[F.col(f"`{c}`") for c in names], "sequence_id", "offset", certified.alias("certified"), F.lit(bound).cast("long").alias("bound"))


#: The pattern whose matches a word-level file encodes, white space left out (a fixed value of the file).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters below are letters, numbers or neither in all tables since the first that had them: Latin and its extensions.
ELSEWHERE = "\u0250"
#: Bytes of text that are encoded at once.
SLICE = 2_000_000


class WordEncoder:
    """Encoder of a word-level BPE file of the tokenizers library.

    The file's normalizer composes characters, lowers them and drops white space, and never joins characters across a
    space; so texts are cut at spaces and line feeds, and the library's model is asked for each distinct match of the
    pattern once. Texts that hold the string of an added token are encoded by the library as they are, and so are chunks
    with a character from ``ELSEWHERE`` on: which of those are letters and numbers depends on the library's own tables.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize, self.normalize = self.tokenizer.model.tokenize, self.tokenizer.normalizer.normalize_str
        self.find, self.shown = regex.compile(WORD_PATTERN).findall, byte_shower()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.of_piece, self.of_chunk = Memo(self._ids, 200_000), Memo(self._chunk, 700_000)

    def _ids(self, piece: str) -> bytes:
        letters = piece if piece.isascii() and piece.isalnum() else self.shown(piece)
        return array("I", [t.id for t in self.tokenize(letters)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if not chunk.isascii():
            if max(chunk) >= ELSEWHERE or max(whole := self.normalize(chunk)) >= ELSEWHERE:
                return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
            chunk = whole
        if chunk.isalpha():  # one match
            return self._ids(chunk)
        if chunk[:-1].isalpha() and not chunk[-1].isalnum() and not chunk[-1].isspace():  # a word and one mark
            return self.of_chunk[chunk[:-1]] + self.of_piece[chunk[-1]]
        return b"".join(map(self.of_piece.__getitem__, self.find(chunk)))

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: none), one text behind the other, and how many each has."""
        texts = pc.fill_null(texts, "")
        out, odd = Column(len(texts)), np.zeros(len(texts), bool)
        for token in self.added:
            odd |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(odd)
        out.put_bytes(rows, [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts.take(pa.array(rows)).to_pylist()])
        rows = np.flatnonzero(~odd)
        if len(rows):
            # A-Z may be lowered first: no composed character depends on their case
            kinds, index, many = cut_at_spaces(pc.replace_substring(pc.ascii_lower(texts.take(pa.array(rows))), "\n", " "))
            ids, count = gathered([*map(self.of_chunk.__getitem__, kinds)], index)
            out.put(rows, ids, np.add.reduceat(count, np.cumsum(many) - many))
        return out.ids(), out.count


def word_encoder(path: str) -> WordEncoder:
    """The encoder of a file, kept by each Python worker until it works for another operator."""
    return held(("words", path), lambda: WordEncoder(path))


def cut(df: DataFrame, path: str, text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row for each piece of each document: all columns but the text, and piece, start, length, ids (little-endian uint32).

    A document's ids are those of its whole text (null: none) and ``end_id``; more than ``capacity`` are cut into pieces of
    that length. Old columns named piece, start, length or ids are replaced; repeated rows give repeated pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(path)
        for batch in batches:
            for part in slices(batch, text, SLICE):
                at = part.schema.get_field_index(text)
                rest = pa.RecordBatch.from_arrays([c for i, c in enumerate(part.columns) if i != at], names=[n for i, n in enumerate(part.schema.names) if i != at])
                ids, count = with_ends(*encode.column(part.column(at)), end_id)
                pieces = -(-count // capacity)
                row = np.repeat(np.arange(len(count)), pieces)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                length = np.minimum(count[row] - nth * capacity, capacity)
                edges = np.concatenate([[0], np.cumsum(length)]) * 4
                cells = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(ids)])
                yield append(rest.take(pa.array(row)), piece=pa.array(nth.astype(np.int32)), start=pa.array(nth * capacity), length=pa.array(length), ids=cells)

    return map_batches(df, run, with_columns(df.drop(text).schema, "piece int, start long, length long, ids binary"))


def op3_packing(documents: DataFrame, path: str) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, certified, bound."""
    pieces = cut(documents.select("doc_id", "text"), path)
    return pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
