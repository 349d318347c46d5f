"""Language identification by prediction by partial matching.

Each language has a context tree over bytes: a context (up to ``order`` bytes before, back to the space that opens the
word) holds counts of the bytes that followed it in the fitting sample. A byte that the longest context has seen costs
-log2(count / (total + kinds)); else the escape -log2(kinds / (total + kinds)) is paid and the next shorter context
asked, down to a uniform byte. A word is coded with the space that ends it, so a text's code length, that of all its
bytes and a space behind them, is the sum over its words. The statistics are frozen, so that of a word is a constant:
each worker works out each distinct word once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalens.llm.chunks import slices
from catalens.llm.common import append, fold, held_out, release, texts_of, with_columns

#: Bytes of context; documents of each language in the fitting sample, whose whole texts it takes.
ORDER, SAMPLE_DOCUMENTS = 4, 300
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")


def word_bytes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words, each between two spaces, and each byte's place in its word (0 for the space before it)."""
    raw = [b" %s " % w.encode() for w in words]
    joined = np.frombuffer(b"".join(raw), np.uint8)
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    starts = np.cumsum(lengths) - lengths
    return joined, np.arange(len(joined)) - np.repeat(starts, lengths)


def _grams(data: np.ndarray, place: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a byte that is coded has ``order`` bytes of its word before it, and the number that those and the byte make."""
    at = np.flatnonzero(place >= max(order, 1))
    code = np.zeros(len(at), np.uint64)
    for back in range(order, -1, -1):
        code = (code << np.uint64(8)) | data[at - back].astype(np.uint64)
    return at, code


class PPM:
    """Context trees of several languages, resolved: each byte after each known context has its full cost in every language."""

    def __init__(self, samples: dict[str, list[str]], order: int = ORDER):
        self.langs, self.order = sorted(samples), order
        k = len(self.langs)
        counted = []
        for lang in self.langs:
            data, place = word_bytes([w for text in samples[lang] for w in text.split(" ")])
            counted.append([np.unique(_grams(data, place, o)[1], return_counts=True) for o in range(order + 1)])
        self.grams: list[np.ndarray] = []
        self.costs: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []
        self.escapes: list[np.ndarray] = []
        for o in range(order + 1):
            grams = np.unique(np.concatenate([c[o][0] for c in counted] or [np.zeros(0, np.uint64)]))
            contexts = np.unique(grams >> np.uint64(8))
            cost, escape = np.full((len(grams), k), np.nan), np.zeros((len(contexts), k))
            for j, c in enumerate(counted):
                mine, count = c[o]
                own, inverse = np.unique(mine >> np.uint64(8), return_inverse=True)
                total, kinds = np.bincount(inverse, count, len(own)), np.bincount(inverse, minlength=len(own))
                cost[np.searchsorted(grams, mine), j] = -np.log2(count / (total + kinds)[inverse])
                escape[np.searchsorted(contexts, own), j] = -np.log2(kinds / (total + kinds))
            # where a language lacks the gram: its escape here, then what the shorter context says
            lower = self._resolve(grams & np.uint64((1 << 8 * o) - 1 if o else 0), o - 1, k)
            here = escape[np.searchsorted(contexts, grams >> np.uint64(8))]
            self.costs.append(np.where(np.isnan(cost), here + lower, cost).astype(np.float32))
            self.grams.append(grams)
            self.contexts.append(contexts)
            self.escapes.append(escape.astype(np.float32))

    def _resolve(self, code: np.ndarray, order: int, k: int) -> np.ndarray:
        """Costs of grams of one order, in every language."""
        out = np.zeros((len(code), k), np.float32)
        left = np.arange(len(code))
        while order >= 0 and len(left):
            grams, contexts = self.grams[order], self.contexts[order]
            if len(grams):
                at = np.minimum(np.searchsorted(grams, code[left]), len(grams) - 1)
                found = grams[at] == code[left]
                out[left[found]] += self.costs[order][at[found]]
                left = left[~found]
                context = code[left] >> np.uint64(8)
                at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
                known = contexts[at] == context
                out[left[known]] += self.escapes[order][at[known]]
            code = code & np.uint64((1 << 8 * order) - 1 if order else 0)
            order -= 1
        out[left] += 8  # a uniform byte
        return out

    def word_costs(self, words: list[str]) -> np.ndarray:
        """Code length in bits of each word and the space behind it in each language."""
        data, place = word_bytes(words)
        out = np.zeros((len(data), len(self.langs)), np.float32)
        capped = np.minimum(place, self.order)
        for o in range(1, self.order + 1):
            at = np.flatnonzero(capped == o)
            code = np.zeros(len(at), np.uint64)
            for back in range(o, -1, -1):
                code = (code << np.uint64(8)) | data[at - back].astype(np.uint64)
            out[at] = self._resolve(code, o, len(self.langs))
        return np.add.reduceat(out, np.flatnonzero(place == 0)) if len(words) else out


class Coder:
    """Code lengths of texts by a model, with the words' costs kept."""

    def __init__(self, model: PPM, limit: int = 200_000):
        self.model, self.limit = model, limit
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.costs = np.zeros((1 << 15, len(self.model.langs)), np.float32)

    def lengths(self, texts: list[str]) -> np.ndarray:
        """Bits of each text, with a space behind it, in each language."""
        parts = [t.split(" ") for t in texts]
        if len(self.rows) > self.limit:
            self._clear()
        new = list({w for p in parts for w in p if w not in self.rows})
        need = len(self.rows) + len(new)
        if need > len(self.costs):
            self.costs = np.concatenate([self.costs, np.zeros((max(need - len(self.costs), len(self.costs)), self.costs.shape[1]), np.float32)])
        self.costs[len(self.rows) : need] = self.model.word_costs(new)
        self.rows.update(zip(new, range(len(self.rows), need)))
        get = self.rows.__getitem__
        return np.array([self.costs[np.fromiter(map(get, p), np.int64, len(p))].sum(0, dtype=np.float64) for p in parts]).reshape(len(texts), -1)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", order: int = ORDER, documents: int = SAMPLE_DOCUMENTS) -> PPM:
    """A model from the whole texts of at most ``documents`` rows of each language, those of smallest hash of id and text.

    The bound on rows makes what reaches the driver independent of how many there are, whatever ids and texts repeat.
    """
    draw = F.pmod(F.xxhash64(doc_id, text, F.lit(29)), F.lit(1 << 30))
    rows = labelled.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), draw.alias("draw"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return PPM({}, order)
    # twice as many as needed are taken at first, so that few are sorted
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, math.ceil(min(1.0, (2 * documents + 50) / n) * (1 << 30)))])
    taken = rows.filter(F.col("draw") <= share[F.col("lang")]).withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text"))).filter(F.col("nth") <= documents)
    samples: dict[str, list[str]] = {}
    for r in sorted(taken.select("lang", "text").toLocalIterator()):
        samples.setdefault(r["lang"], []).append(r["text"])
    return PPM(samples, order)


def identify(df: DataFrame, model: PPM, text: str = "text") -> DataFrame:
    """``df`` with lang_pred (the language that codes the whole text shortest), score (its share of the likelihood) and bits_per_byte.

    A null text and one without a letter get ``und``, as do all texts if the model knows no language; their score is 0.
    Of equal code lengths the language first in the alphabet wins. Rows are taken one by one: repeated rows get the same
    answer, other columns stay, and old columns of the three names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        coder = Coder(shared.value)
        langs = np.array([*shared.value.langs, UNDETERMINED], object)
        for batch in batches:
            for part in slices(batch, text, 2_000_000):
                texts = texts_of(part, text)
                use = [i for i, t in enumerate(texts) if t is not None and len(langs) > 1 and _LETTER.search(t)]
                best, score, bits = np.full(len(texts), len(langs) - 1), np.zeros(len(texts)), np.zeros(len(texts))
                if use:
                    cost = coder.lengths([texts[i] for i in use])
                    least = cost.min(1)
                    best[use] = cost.argmin(1)
                    score[use] = 1 / np.exp2(np.maximum(least[:, None] - cost, -1000)).sum(1)
                    bits[use] = least / np.array([len(texts[i].encode()) + 1 for i in use])
                yield append(part, lang_pred=pa.array(langs[best].tolist(), pa.string()), score=pa.array(score), bits_per_byte=pa.array(bits))

    return df.mapInArrow(run, with_columns(df.schema, "lang_pred string, score double, bits_per_byte double"))


def op1_language(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score and bits_per_byte; learned from the documents that aren't held out."""
    model = fit(documents.filter(fold() != 1))
    return identify(documents.select("doc_id", held_out().alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")
