"""Spelling variants by pivotal grams: all pairs of words one edit apart, and each word's far more frequent neighbour.

A word's grams are its bigrams. Of its three rarest kinds (its prefix) dynamic programming chooses two disjoint ones of
least frequency, the pivots: the left one from the first places of these kinds, the right one from their last places. One
edit leaves the left pivot and all before it as they are, or the right pivot and all behind it. And where a kind's first
place lies in a part that both words share it is the first place in both, so no other places are indexed.

Of two words one edit apart, the one whose prefix ends at the rarer kind finds its intact pivot in the other's prefix.
So pivots are looked up among the grams of all prefixes. The position limit is exact: as the text on the pivot's side is
intact, a gram is indexed with that text (by a 64-bit hash), and lengths differ by one at most. Candidates are then
verified letter by letter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.llm.common import saved, texts_of, whole_runs

RUN, LEAST, DROPPED = "[a-zÀ-ÿ]", 7, 31
TIMES = 10
BLOCK = 16_384

_LETTERS = 90  # a-z and U+00C0 to U+00FF
_CODE = np.zeros(256, np.int64)
_CODE[97:123], _CODE[0xC0:] = np.arange(26), np.arange(26, 90)
_NEVER = 1 << 20  # behind all ranks
_BASE = 0x9E3779B97F4A7C15
#: Longer words are verified one pair at a time.
_WIDE = 48
_LOW_BYTES = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF], np.int32)


def misspelt(run: str, start: int) -> str:
    """The run, without one code point if the crc32 of id and run says so; ``start`` is the crc32 of what stands before it."""
    h = zlib.crc32(run.encode(), start)
    if h % DROPPED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(df: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(word, n): occurrences of each word of ``least`` or more letters in all texts, summed by each task before they are sent."""
    run_of = re.compile(f"{RUN}{{{least},}}")
    rows = df.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text")).filter("text is not null")

    def batch_of(count: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(count)), pa.array(list(count.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        size = 0
        for batch in batches:
            for i, t in zip(texts_of(batch, "id"), texts_of(batch, "text")):
                start = zlib.crc32(f"{i}:".encode())
                for found, times in Counter(run_of.findall(t.encode().lower().decode())).items():  # bytes: A-Z only are lowered
                    word = misspelt(found, start)
                    if len(word) >= least:
                        size += len(word) if word not in count else 0
                        count[word] += times
                if size > 4_000_000:
                    yield batch_of(count)
                    count, size = Counter(), 0
        if count:
            yield batch_of(count)

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, letters, numbers of bigrams) for words of each length."""
    plain = [w.encode("latin-1") for w in words.to_pylist()]
    size = np.array([len(w) for w in plain], np.int64)
    for length in np.unique(size).tolist():
        rows = np.flatnonzero(size == length)
        letters = np.frombuffer(b"".join([plain[i] for i in rows.tolist()]), np.uint8).reshape(len(rows), length)
        code = _CODE[letters]
        yield rows, letters, code[:, :-1] * _LETTERS + code[:, 1:]


def gram_frequencies(words: DataFrame) -> np.ndarray:
    """For each bigram the number of words that hold it; 8,100 numbers at most come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_LETTERS * _LETTERS, np.int64)
        for batch in batches:
            for _, _, grams in _by_length(batch.column(0)):
                grams = np.sort(grams, axis=1)
                first = np.ones(grams.shape, bool)
                first[:, 1:] = grams[:, 1:] != grams[:, :-1]
                total += np.bincount(grams[first], minlength=len(total))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], names=["gram", "n"])

    out = np.zeros(_LETTERS * _LETTERS, np.int64)
    for gram, n in words.select("word").mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n")).collect():
        out[gram] = n
    return out


def prefixes(grams: np.ndarray, rank: np.ndarray, kinds: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first places, last places, last rank, rank covered) of the ``kinds`` rarest kinds of grams of words of one length.

    Places are masks over the grams' positions. A word with fewer kinds has all its grams in its prefix and so covers every rank.
    """
    ranks = rank[grams]
    order = np.argsort(ranks, axis=1, kind="stable")
    ordered = np.take_along_axis(ranks, order, 1)
    change = ordered[:, 1:] != ordered[:, :-1]
    edge = np.ones((len(grams), 1), bool)
    starts, ends = np.hstack([edge, change]), np.hstack([change, edge])
    nth = np.cumsum(starts, axis=1)
    mine = nth <= kinds
    first, last = np.zeros(grams.shape, bool), np.zeros(grams.shape, bool)
    np.put_along_axis(first, order, starts & mine, 1)
    np.put_along_axis(last, order, ends & mine, 1)
    to = np.where(mine, ordered, -1).max(1)
    return first, last, to, np.where(nth[:, -1] < kinds, _NEVER, to)


def pivots(first: np.ndarray, last: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(left, right): the places of two disjoint grams of least weight, the left one of ``first`` and the right one of ``last``.

    Over places from left to right, the least weight of a left pivot so far is kept, and each right pivot is added to the
    least one that ends before it.
    """
    far = np.int64(1) << 60
    left = np.where(first, weight, far)
    best = np.minimum.accumulate(left, axis=1)
    b = (best[:, :-2] + np.where(last, weight, far)[:, 2:]).argmin(1) + 2
    open_ = np.arange(left.shape[1]) <= (b - 2)[:, None]
    return np.where(open_, left, far + 1).argmin(1), b


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ np.uint64(salt)) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
    return (h ^ (h >> np.uint64(29))).view(np.int64)


def side_hashes(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the text up to the end of each gram, and from its start on."""
    n = letters.shape[1]
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate([[1], np.full(n - 1, _BASE, np.uint64)]).astype(np.uint64), dtype=np.uint64)
        c = letters.astype(np.uint64) + np.uint64(1)
        up = np.cumsum(c * power, axis=1, dtype=np.uint64)
        down = np.cumsum((c * power[::-1])[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
    return _mixed(up[:, 1:], 1), _mixed(down[:, :-1], 2)


_ENTRY = "key long, intact int, pivot boolean, word string, n long, len int, upto int, covers int"


def index_entries(words: DataFrame, frequencies: np.ndarray) -> DataFrame:
    """A row for each kind of a word's prefix and each side, with the hash of gram and text on that side; ``pivot`` tells those that are looked up.

    ``intact`` is the length of that text with the gram, negative for the right side.
    """
    rank = np.empty(len(frequencies), np.int64)
    rank[np.lexsort((np.arange(len(frequencies)), frequencies))] = np.arange(len(frequencies))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 20_000):
                part = batch.slice(start, 20_000)
                for rows, letters, grams in _by_length(part.column(0)):
                    first, last, upto, covers = prefixes(grams, rank)
                    a, b = pivots(first, last, frequencies[grams])
                    for mask, hashes, pivot, right in zip((first, last), side_hashes(letters), (a, b), (False, True)):
                        i, at = np.nonzero(mask)
                        mine = part.take(pa.array(rows[i]))
                        intact = at - letters.shape[1] if right else at + 2
                        columns = [pa.array(hashes[i, at]), pa.array(intact.astype(np.int32)), pa.array(pivot[i] == at), mine.column(0), mine.column(1), pa.array(np.full(len(i), letters.shape[1], np.int32)), pa.array(upto[i].astype(np.int32)), pa.array(covers[i].astype(np.int32))]
                        yield pa.RecordBatch.from_arrays(columns, names=["key", "intact", "pivot", "word", "n", "len", "upto", "covers"])

    return words.select("word", "n").mapInArrow(run, _ENTRY)


def dealt(entries: DataFrame, cap: int = BLOCK) -> DataFrame:
    """``entries`` in cells: keys over ``cap`` rows are cut into blocks, and each block of pivots meets each block of grams in a cell of its own.

    ``role``: 0 is looked up in, 1 looks up, 2 does both. Only keys over the cap are joined to their number of blocks.
    """
    large = entries.groupBy("key").agg(F.count("*").alias("rows")).filter(F.col("rows") > cap).select("key", F.ceil(F.col("rows") / cap).cast("int").alias("blocks"))
    cut = entries.join(large, "key", "left")
    block = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    cell = lambda i, j, role: F.struct((i * F.col("blocks") + j).alias("cell"), F.lit(role).alias("role"))
    inside = F.transform(every, lambda j: cell(block, j, 0))
    looking = F.when(F.col("pivot"), F.transform(every, lambda i: cell(i, block, 1))).otherwise(F.array().cast("array<struct<cell:int,role:int>>"))
    alone = F.array(F.struct(F.lit(0).alias("cell"), F.when(F.col("pivot"), 2).otherwise(0).alias("role")))
    return cut.withColumn("to", F.explode(F.when(F.col("blocks").isNull(), alone).otherwise(F.concat(inside, looking)))).select("key", "to.cell", "to.role", "intact", "word", "n", "len", "upto", "covers")


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point leads from one word to the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    x, y = (np.frombuffer(w.encode("latin-1"), np.uint8) for w in (a, b))
    differs = np.flatnonzero(x != y[: len(x)])
    at = int(differs[0]) if len(differs) else len(x)
    return bool((x[at + (len(a) == len(b)) :] == y[at + 1 :]).all())


class _Letters:
    """The words of a table as letters, aligned left and right, for the verification of many pairs at once."""

    def __init__(self, words: pa.Array, size: np.ndarray):
        self.words, self.size = words, size
        wide = int(min(size.max(initial=1), _WIDE))
        kept = [w.encode("latin-1") if n <= wide else b"" for w, n in zip(words.to_pylist(), size.tolist())]
        self.left = np.frombuffer(b"".join([w.ljust(wide, b"\0") for w in kept]), np.uint8).reshape(-1, wide)
        self.right = np.frombuffer(b"".join([w.rjust(wide, b"\0") for w in kept]), np.uint8).reshape(-1, wide)[:, ::-1]

    def ends(self, intact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the three letters next to the intact text, the three at the word's other end, from there inwards), each as a number."""
        near, far = np.zeros(len(intact), np.int32), np.zeros(len(intact), np.int32)
        rows, wide = np.arange(len(intact)), self.left.shape[1]
        for k in range(3):
            at = np.minimum(np.abs(intact) + k, wide - 1)
            near |= np.where(intact > 0, self.left[rows, at], self.right[rows, at]).astype(np.int32) << (8 * k)
            far |= np.where(intact > 0, self.right[:, min(k, wide - 1)], self.left[:, min(k, wide - 1)]).astype(np.int32) << (8 * k)
        return near, far

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        shared = np.zeros(len(i), np.int64)
        for side in (self.left, self.right):
            differs = side[i] != side[j]
            shared += np.where(differs.any(1), differs.argmax(1), side.shape[1])
        a, b = self.size[i], self.size[j]
        out = np.where(a == b, shared == a - 1, (np.abs(a - b) == 1) & (shared >= np.minimum(a, b)))
        for k in np.flatnonzero((a > _WIDE) | (b > _WIDE)).tolist():
            out[k] = one_edit(self.words[int(i[k])].as_py(), self.words[int(j[k])].as_py())
        return out


def _verified(batches: Iterator[pa.RecordBatch], most: int = 500_000) -> Iterator[pa.RecordBatch]:
    """(word, near, near_n) both ways for pairs one edit apart; batches are sorted by key, cell and length.

    Before pairs are compared letter by letter, the ends of what isn't known to be intact are: one edit can't change both
    of them, as far as they don't overlap.
    """
    for part in whole_runs(batches, ["key", "cell"]):
        key, cell, size, role, upto, covers, intact = (part[c].to_numpy() for c in ("key", "cell", "len", "role", "upto", "covers", "intact"))
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])
        place = (np.cumsum(new) << 32) + size  # rises with the rows
        looking = np.flatnonzero(role > 0)
        low, high = np.searchsorted(place, place[looking] - 1, "left"), np.searchsorted(place, place[looking] + 1, "right")
        looking, low, count = (x[high - low > (role[looking] == 2)] for x in (looking, low, high - low))
        if not len(looking):
            continue
        words = part["word"].combine_chunks()
        letters, n = _Letters(words, size.astype(np.int64)), part["n"].combine_chunks()
        near, far = letters.ends(intact)
        rest = np.where(size <= _WIDE, size - np.abs(intact), 0)  # of wide words nothing is ruled out
        total = np.cumsum(count)
        at = 0
        while at < len(looking):
            upto_row = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
            c = count[at:upto_row]
            i = np.repeat(looking[at:upto_row], c)
            j = np.repeat(low[at:upto_row], c) + np.arange(len(i)) - np.repeat(np.cumsum(c) - c, c)
            compared = _LOW_BYTES[np.minimum(np.minimum(rest[i], rest[j]) // 2, 3)]
            may = ((near[i] ^ near[j]) & compared == 0) | ((far[i] ^ far[j]) & compared == 0)
            i, j = i[may], j[may]
            may = (role[j] != 1) & (i != j) & (upto[i] <= covers[j])
            i, j = i[may], j[may]
            hit = letters.near(i, j)
            i, j = i[hit], j[hit]
            if len(i):
                both, other = pa.array(np.concatenate([i, j])), pa.array(np.concatenate([j, i]))
                yield pa.RecordBatch.from_arrays([words.take(both), words.take(other), n.take(other)], names=["word", "near", "near_n"])
            at = upto_row


def near_words(words: DataFrame, cap: int = BLOCK) -> DataFrame:
    """(word, near, near_n): every pair of distinct words one edit apart, both ways, once each."""
    entries = dealt(index_entries(words, gram_frequencies(words)), cap)
    found = entries.repartition("key", "cell").sortWithinPartitions("key", "cell", "len").mapInArrow(_verified, "word string, near string, near_n long")
    return found.repartition("word").groupBy("word", "near").agg(F.first("near_n").alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last word that following forms leads to; the ways double in length with each join.

    A form occurs ten times as often as its word, so a way has few steps and no rings.
    """
    now = saved(forms.select("word", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = saved(now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("grown")))
        if not longer.filter("grown").limit(1).count():
            return longer.select("word", "root")
        now = longer.select("word", "root")


def variants(df: DataFrame, doc_id: str = "doc_id", text: str = "text", least_n: int = 2, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of 7 or more letters and ``least_n`` or more occurrences.

    Null texts have no words; a null id counts as the empty string. Repeated rows count as often as they come, ties
    between forms go to the smaller word, words of any length are compared whole, and no text or an empty table gives an
    empty result. Other columns of ``df`` are not looked at.
    """
    words = saved(word_counts(df, doc_id, text).filter(F.col("n") >= least_n))
    best = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct(-F.col("near_n"), F.col("near"))).alias("best"))
    known = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.col1")).alias("near_n"))
    far = F.col("near_n") >= times * F.col("n")
    known = saved(known.select("word", "n", "n_near", F.when(far, F.col("near")).alias("form"), F.when(far, F.col("near_n")).alias("form_n")))
    return known.join(roots(known.filter("form is not null")), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(documents: DataFrame) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    return variants(documents)
