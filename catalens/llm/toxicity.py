"""Toxicity by noisy-channel deobfuscation.

What a writer meant is restored first: a token with digits or symbols among its letters, with letters repeated, or
spelled out with spaces, opens a lattice of readings (a symbol for one of the letters it looks like, a separator for
nothing, a run for one letter or two), and Viterbi decoding finds the reading that channel costs and a character
trigram model make likeliest. So do neighbours that are no known words but make one together. Known words, and tokens of
plain letters without a run, have one reading only and skip the lattice. The restored words are then scored: words, and
beginnings of words not seen often enough, carry the log ratio of their rates in toxic and other documents where that
ratio is beyond chance. All distinct signs of a text count.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.llm.common import Memo, append, fold, held_out, release, texts_of, with_columns

#: Labelled documents of the fitting sample.
SAMPLE_DOCUMENTS, THRESHOLD = 4_000, 0.7

#: What digits and symbols stand for (fixed values).
LOOKS_LIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou"}
#: Channel costs in nats.
SUBSTITUTED, DROPPED, DOUBLED, COLLAPSED, SPACED = 1.0, 1.5, 1.0, 2.0, 0.3

_WORD = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"([^\W\d_])\1")
_SPELLED = re.compile(r"(?<!\S)(?:[^\W_]|[@$!|+*])(?:[ .\-_*]{1,2}(?:[^\W_]|[@$!|+*])){2,}(?!\S)")
# what is no letter, digit or look-alike; behind a word also ! and the like, which mostly are marks there
_EDGE = re.compile(r"^[^\w@$!|+(€£*]+|[^\w@$|+€£*]+$")


class CharacterModel:
    """Trigrams of a word's characters, interpolated with bigrams and single characters by Witten-Bell weights."""

    def __init__(self, trigrams: dict[str, int]):
        self.counts: list[dict[str, Counter]] = [defaultdict(Counter) for _ in range(3)]
        for gram, n in trigrams.items():
            for o in range(3):
                self.counts[o][gram[2 - o : 2]][gram[2]] += n
        self.kinds = max(1, len(self.counts[0][""])) + 1
        self.totals = [{c: sum(x.values()) for c, x in t.items()} for t in self.counts]
        self.counts = [dict(t) for t in self.counts]

    def cost(self, gram: str) -> float:
        """-log of the probability of a gram's last character after the others."""
        return -math.log(self._p(gram[:-1], gram[-1]))

    def _p(self, context: str, ch: str) -> float:
        p = 1 / self.kinds
        for o in range(len(context) + 1):
            c = context[len(context) - o :]
            seen = self.counts[o].get(c)
            if seen:
                n, k = self.totals[o][c], len(seen)
                p = (seen.get(ch, 0) + k * p) / (n + k)
        return p


def trigrams(words: dict[str, int]) -> Counter:
    """How often each trigram comes in the words as often as told, with two spaces before and one behind each."""
    found: Counter = Counter()
    for w, n in words.items():
        padded = f"  {w} "
        for i in range(len(w) + 1):
            found[padded[i : i + 3]] += n
    return found


def all_trigrams(documents: DataFrame, text: str = "text") -> DataFrame:
    """(gram, n): the character trigrams of the words of all whole texts, a word counted once a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        found: Counter = Counter()
        for batch in batches:
            for t in filter(None, texts_of(batch, text)):
                words.update(set(_WORD.findall(t.lower())))
                if len(words) > 200_000:
                    found.update(trigrams(words))
                    words.clear()
        found.update(trigrams(words))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["gram", "n"])

    return documents.select(text).mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def readings(token: str) -> list[list[tuple[str, float]]]:
    """The lattice of a token: for each stretch of it, what it may stand for and the cost of that."""
    out, i = [], 0
    while i < len(token):
        ch, j = token[i], i + 1
        while j < len(token) and token[j] == ch:
            j += 1
        run = j - i
        if ch.isalpha():
            # a double letter is common in plain words; a longer run is not
            each = [(ch * run, 0.0)] if run <= 2 else [(ch, DOUBLED), (ch * 2, DOUBLED)]
            if run == 2:
                each.append((ch, COLLAPSED))
        elif ch in LOOKS_LIKE:
            each = [(c * k, SUBSTITUTED * run) for c in LOOKS_LIKE[ch] for k in range(1, min(run, 2) + 1)]
            if not ch.isdigit():
                each.append(("", DROPPED))
        elif ch.isspace():
            each = [("", SPACED), (" ", SPACED)]
        elif ch.isalnum():
            each = [(ch * run, 0.0)]
        else:
            each = [("", SPACED)]
        out.append(each)
        i = j
    return out


def decode(token: str, cost: dict[str, float]) -> str:
    """The likeliest reading of a lower-case token (Viterbi over the last two characters); ``cost`` has the trigrams' costs."""
    states = {"  ": (0.0, "")}
    for each in readings(token):
        after: dict[str, tuple[float, str]] = {}
        for last, (so_far, text) in states.items():
            for letters, price in each:
                c, ctx = so_far + price, last
                for ch in letters:
                    c += cost[ctx + ch]
                    ctx = "  " if ch == " " else ctx[1] + ch
                if ctx not in after or c < after[ctx][0]:
                    after[ctx] = (c, text + letters)
        states = after
    return min((c + cost[ctx + " "], text) for ctx, (c, text) in states.items())[1]


@dataclass
class ToxicityModel:
    """What the score of a text needs: characters, signs (word or beginning -> log ratio; 0 blocks shorter ones), the prior and the words seen often enough."""

    characters: CharacterModel | None = None
    words: dict[str, float] = field(default_factory=dict)
    beginnings: dict[str, float] = field(default_factory=dict)
    prior: float = math.log(0.1 / 0.9)
    known: frozenset[str] = frozenset()

    def sign(self, word: str) -> float:
        found = self.words.get(word)
        if found is not None:
            return found
        for k in range(min(len(word), 9), 3, -1):
            found = self.beginnings.get(word[:k])
            if found is not None:
                return found
        return 0.0


class Scorer:
    """Restores and scores texts by a model, with each distinct chunk worked out once."""

    def __init__(self, model: ToxicityModel, limit: int = 600_000):
        self.model = model
        self.cost = Memo(model.characters.cost, 200_000) if model.characters else None
        self.restored = Memo(self._restore, limit // 4)
        self.signs = Memo(self._signs, limit)
        # what a word with a sign may begin with if a space was put into it
        self.heads = frozenset(w[:k] for w, s in model.words.items() if s for k in range(1, len(w))) if self.cost is not None else frozenset()

    def _restore(self, token: str) -> str:
        core = _EDGE.sub("", token.lower())
        if not core or self.cost is None or core in self.model.known or (core.isalpha() and not _RUN.search(core)) or not _WORD.search(core):
            return core
        return decode(core, self.cost)

    def _signs(self, chunk: str) -> tuple:
        found = [(w, self.model.sign(w)) for token in chunk.split() for w in _WORD.findall(self.restored[token])]
        return tuple(x for x in found if x[1])

    def _joined(self, tokens: list[str]) -> list[tuple[int, str]]:
        """Where two neighbours, not both of them known words, are likelier one word with a sign; tokens are in lower case."""
        out = []
        for i in [i for i, t in enumerate(tokens[:-1]) if t in self.heads]:
            after = _EDGE.sub("", tokens[i + 1])
            word = tokens[i] + after
            if after and self.model.words.get(word) and not (tokens[i] in self.model.known and after in self.model.known) and decode(f"{tokens[i]} {after}", self.cost) == word:
                out.append((i, word))
        return out

    def _spelled(self, text: str) -> Iterator[tuple[int, int, str]]:
        """Runs of single characters, with what they spell."""
        if self.cost is not None:
            for m in _SPELLED.finditer(text):
                if _WORD.search(m[0]):
                    yield m.start(), m.end(), decode(m[0].lower(), self.cost)

    def restore(self, text: str) -> str:
        """The text in lower case with each token restored; words spelled out letter by letter, or cut in two, are put together."""
        parts, at = [], 0
        for start, end, word in [*self._spelled(text), (len(text), len(text), "")]:
            tokens = text[at:start].lower().split()
            cut = dict(self._joined(tokens))
            parts += [cut.get(i, self.restored[t]) for i, t in enumerate(tokens) if i - 1 not in cut]
            parts.append(word)
            at = end
        return " ".join(p for p in parts if p)

    def score(self, text: str | None) -> float:
        """The probability of the label from all distinct signs; without any, the prior."""
        found: set = set()
        if text:
            for signs in filter(None, map(self.signs.__getitem__, text.split(" "))):
                found.update(signs)
            more = [w for _, w in self._joined(text.lower().split(" "))]
            for _, _, spelled in self._spelled(text):
                more += _WORD.findall(spelled)
            found.update((w, s) for w in more if (s := self.model.sign(w)))
        z = self.model.prior + sum(sorted(s for _, s in found))
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def _rows_kept(rows: Iterable[tuple[str, int]]) -> Iterator[tuple[str, int]]:
    """One row of each label for texts with the same smallest shingle hash: copies and near copies speak once."""
    seen = set()
    for text, toxic in rows:
        w = text.split()
        key = min((xxhash.xxh64_intdigest(" ".join(w[k : k + 3])) for k in range(max(1, len(w) - 2))), default=0), toxic
        if key not in seen:
            seen.add(key)
            yield text, toxic


def learn(rows: Iterable[tuple[str, int]], characters: CharacterModel | None = None, least: float = 3, noise: float = 0.02, rare: float = 1e-4, share: float = 5) -> ToxicityModel:
    """A model of labelled texts.

    A word counts once a document. A beginning of 4 to 9 letters sums its words' counts, each scaled down to ``share``
    documents, so that a frequent word does not speak for its neighbours. A sign is kept if, of two explanations, one
    being that it marks toxic documents but for ``noise`` and holds for a share ``rare`` of words, that one is likelier.
    """
    toxic, other, n = Counter(), Counter(), [0, 0]
    for text, label in _rows_kept(rows):
        (toxic if label else other).update({w for t in text.lower().split() for w in _WORD.findall(t)})
        n[label] += 1
    if not n[1] or not n[0]:
        return ToxicityModel(characters)
    base = n[1] / (n[0] + n[1])

    def ratio(a: float, b: float) -> float:
        if math.log(rare) + a * math.log((1 - noise) / base) + b * math.log(noise / (1 - base)) < 0:
            return 0.0
        return math.log((a + 0.5) / (n[1] + 1)) - math.log((b + 0.5) / (n[0] + 1))

    begin: dict[str, list[float]] = {}
    for w in toxic.keys() | other.keys():
        a, b = toxic[w], other[w]
        scale = min(1.0, share / (a + b))
        for k in range(4, min(len(w), 9) + 1):
            e = begin.setdefault(w[:k], [0.0, 0.0])
            e[0] += a * scale
            e[1] += b * scale
    beginnings = {w: ratio(*e) for w, e in begin.items() if sum(e) >= least}
    words = {w: ratio(toxic[w], other[w]) for w in toxic.keys() | other.keys() if toxic[w] + other[w] >= least}
    del begin
    # a sign of 0 matters only where a shorter beginning has one
    live = {w for w, s in beginnings.items() if s}
    behind = lambda w: any(w[:k] in live for k in range(4, min(len(w), 10)))
    return ToxicityModel(characters, {w: s for w, s in words.items() if s or behind(w)}, {w: s for w, s in beginnings.items() if s or behind(w)}, math.log(base / (1 - base)), frozenset(words))


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> ToxicityModel:
    """A model from the whole texts of at most ``sample`` labelled documents that aren't held out, those of smallest hash.

    The character model, which needs no labels, is of all documents: only its table of trigrams leaves the tasks.

    Rows with a null id, label or text don't count. The labels drawn are few enough to be sent to all tasks, so that
    only the sample's texts leave the tasks; rows that repeat an id are bounded as well.
    """
    usable = labels.filter((fold() != 1) & F.col("toxic").isNotNull()).select("doc_id", (F.col("toxic") != 0).cast("int").alias("toxic")).distinct()
    total = usable.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) <= min(1.0, sample / max(1, total)) * (1 << 30)
    drawn = F.broadcast(usable.filter(draw).limit(2 * sample))
    rows = documents.select("doc_id", "text").filter("text is not null").join(drawn, "doc_id").orderBy(F.xxhash64("doc_id", "text"), "text", "toxic").limit(sample).select("text", "toxic")
    grams = {r["gram"]: r["n"] for r in all_trigrams(documents).toLocalIterator()}
    return learn(sorted((r["text"], r["toxic"]) for r in rows.toLocalIterator()), CharacterModel(grams) if grams else None)


def _mapped(df: DataFrame, model: ToxicityModel, more: str, work) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        scorer = Scorer(shared.value)
        for batch in batches:
            yield append(batch, **work(scorer, batch))

    return df.mapInArrow(run, with_columns(df.schema, more))


def restore(df: DataFrame, model: ToxicityModel, text: str = "text", to: str = "restored") -> DataFrame:
    """``df`` with column ``to``: the deobfuscated text (null stays null)."""
    return _mapped(df, model, f"`{to}` string", lambda s, b: {to: pa.array([None if t is None else s.restore(t) for t in texts_of(b, text)], pa.string())})


def score(df: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with score (0 to 1) and predicted (1 from ``threshold`` on) of each whole text.

    Null and empty texts, and those without signs, get the prior's score. Rows are taken one by one: repeated rows score
    alike, other columns stay, old columns of the two names are replaced.
    """

    def work(s: Scorer, b: pa.RecordBatch) -> dict:
        found = [s.score(t) for t in texts_of(b, text)]
        return {"score": pa.array(found, pa.float64()), "predicted": pa.array([int(x >= threshold) for x in found], pa.int32())}

    return _mapped(df, model, "score double, predicted int", work)


def op2_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted; learned from labelled documents that aren't held out."""
    return score(documents.select("doc_id", held_out().alias("held_out"), "text"), fit(documents, labels)).select("doc_id", "held_out", "score", "predicted")
