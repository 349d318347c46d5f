"""Secret scans by character Markov models, in DataFrame functions only.

Base rules find secrets by their form. The models find more: a run of key characters is scored by the log-likelihood
ratio of two first-order character models, one of random strings and one of ordinary identifiers, and becomes a span of
kind ``markov`` where the ratio is high enough. Both models are trained from labelled samples: values that the base rules
find are random strings (each distinct value once), runs of letters in one case elsewhere, as words joined by underscores,
are ordinary ones. Runs of mixed characters are neither, so that secrets yet unknown don't pass for ordinary.

All positions are code points. Nothing but the counts of character pairs, at most 2 x 66 x 66, leaves the executors, and
scoring is a projection of the documents without a shuffle.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalens.llm.common import fresh


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


ASSIGN = f"({_either_case('password|passwd|secret|token|api_?key')})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{14,}"  # 18 characters or more; a shorter run holds no longer match
HEX = "[0-9a-f]{16,}"
VALUE_LEAST = 12

KEY_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_="
#: Runs of key characters that are scored, and those that ordinary identifiers are learned from, if they are of one case.
CANDIDATE, ORDINARY, ONE_CASE = "[A-Za-z0-9+/_=]{16,}", "[A-Za-z0-9+/_=]{10,}", "^[A-Z]?[a-z_]+$|^[A-Z_]+$"
#: A span is added at this log-likelihood ratio (natural log), in sum and for each pair of characters.
LEAST_SUM, LEAST_MEAN = 10.0, 0.5

_SPANS = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


def _matches(text: Column, pattern: str, kind: str, rank: int, group: int = 0) -> Column:
    """The leftmost matches that don't overlap as an array of spans; ``value`` is a group of the match.

    Between k matches stand k + 1 gaps, so the lengths of gaps and matches in turn give the positions.
    """
    whole, value = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), value.alias("value"))

    def step(so_far: Column, part: Column) -> Column:
        start = so_far["at"] + F.char_length(part["gap"])
        end = start + F.coalesce(F.char_length(part["whole"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), part["value"].alias("value"))
        return F.struct(end.alias("at"), F.when(part["whole"].isNull(), so_far["spans"]).otherwise(F.concat(so_far["spans"], F.array(span))).alias("spans"))

    none = F.array().cast(_SPANS)
    found = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("spans")), step)["spans"]
    return F.when(text.rlike(pattern), found).otherwise(none)


def base_spans(text: Column) -> Column:
    """Spans of the base rules by start, then kind; none for a null text."""
    assigned = F.filter(_matches(text, ASSIGN, "assign", 0, 2), lambda s: F.char_length(s["value"]) >= VALUE_LEAST)
    return F.array_sort(F.concat(assigned, _matches(text, ACCESS, "access", 1), _matches(text, HEX, "hex", 2)))


def _pairs(value: Column) -> Column:
    """The value's neighbouring key characters as numbers, first x 66 + second; null where one is no key character."""
    codes = F.transform(F.split(value, ""), lambda c: F.when(c != "", F.nullif(F.instr(F.lit(KEY_CHARS), c), F.lit(0)) - 1))
    return F.zip_with(codes, F.slice(codes, F.lit(2), F.greatest(F.size(codes), F.lit(1))), lambda a, b: a * len(KEY_CHARS) + b)


def pair_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(random boolean, pair string, n long): pairs of key characters in the labelled samples."""
    t = F.col(text)
    values = df.select(F.explode(base_spans(t)["value"]).alias("value")).distinct()
    left = t
    for pattern in (ASSIGN, ACCESS, HEX):
        left = F.when(left.rlike(pattern), F.regexp_replace(left, pattern, " ")).otherwise(left)
    ordinary = df.select(left.alias("left")).select(F.explode(F.regexp_extract_all("left", F.lit(ORDINARY), F.lit(0))).alias("value")).filter(F.col("value").rlike(ONE_CASE))
    both = values.select(F.lit(True).alias("random"), "value").unionByName(ordinary.select(F.lit(False).alias("random"), "value"))
    pairs = both.filter(F.char_length("value") > 1).select("random", "value", F.explode(F.sequence(F.lit(1), F.char_length("value") - 1)).alias("i")).select("random", F.substr("value", F.col("i"), F.lit(2)).alias("pair"))
    counted = pairs.groupBy("random", "pair").agg(F.count("*").alias("n"))
    return counted.filter(F.col("pair").rlike(f"^[{KEY_CHARS}]{{2}}$"))


def ratios(counts: list[tuple[bool, str, int]]) -> list[int]:
    """For each pair of characters: thousandths of the log-likelihood ratio of its second one after its first.

    Both models are smoothed by the count of distinct followers (Witten and Bell) towards a uniform choice; the model of
    random strings is half uniform besides, as keys have other alphabets than those that the base rules happen to find.
    """
    k = len(KEY_CHARS)
    n = {(r, KEY_CHARS.index(p[0]) * k + KEY_CHARS.index(p[1])): c for r, p, c in counts}

    def chance(random: bool, a: int, b: int) -> float:
        row = [n.get((random, a * k + x), 0) for x in range(k)]
        total, kinds = sum(row), sum(c > 0 for c in row)
        return (row[b] + kinds / k) / (total + kinds) if total else 1 / k

    return [round(1000 * (math.log(0.5 * chance(True, a, b) + 0.5 / k) - math.log(chance(False, a, b)))) for a in range(k) for b in range(k)]


def fit(df: DataFrame, text: str = "text") -> list[int]:
    """The ratios learned from all texts; at most 2 x 66 x 66 counts come to the driver."""
    return ratios([tuple(r) for r in pair_counts(df, text).collect()])


def likelihood_ratio(value: Column, model: list[int]) -> Column:
    """Thousandths of the sum of log-likelihood ratios over the value's pairs of characters."""
    weights = F.from_json(F.lit(json.dumps(model)), "array<int>")
    return F.aggregate(_pairs(value), F.lit(0).cast("long"), lambda sum_, p: sum_ + F.coalesce(F.get(weights, p), F.lit(0)).cast("long"))


def markov_spans(text: Column, base: Column, model: list[int], least_sum: float = LEAST_SUM, least_mean: float = LEAST_MEAN) -> Column:
    """Runs of 16 or more key characters apart from the base spans that look random by the models."""

    def looks_random(s: Column) -> Column:
        ratio = likelihood_ratio(s["value"], model)
        return (ratio >= round(1000 * least_sum)) & (ratio >= round(1000 * least_mean) * (F.char_length(s["value"]) - 1))

    apart = lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    return F.filter(_matches(text, CANDIDATE, "markov", 3), lambda s: apart(s) & looks_random(s))


def scan(df: DataFrame, model: list[int] | None = None, text: str = "text", to: str = "secrets") -> DataFrame:
    """``df`` with column ``to``: spans (start, rank, end, kind, value) of the base rules and of the models, in order of start and kind.

    Null and empty texts have none. Repeated rows are scanned as often as they come; an empty table gives an empty one. A
    column named ``to`` is replaced.
    """
    model = fit(df, text) if model is None else model
    name = fresh(df, "base__")
    out = df.withColumn(name, base_spans(F.col(text)))
    return out.withColumn(to, F.array_sort(F.concat(name, markov_spans(F.col(text), F.col(name), model)))).drop(name)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op13_secrets(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256 (of the base spans), spans (all spans)."""
    found = scan(documents.select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = joined(F.filter("secrets", lambda s: s["kind"] != "markov"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(base, 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))


_AT = """
{name}_all AS (SELECT rid, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}', 0) AS whole, regexp_extract_all(text, '{pattern}', {group}) AS vals FROM docs WHERE text IS NOT NULL),
{name}_each AS (SELECT rid, unnest(whole) AS whole, unnest(vals) AS value, unnest(gaps[1:len(whole)]) AS gap, generate_subscripts(whole, 1) AS k FROM {name}_all),
{name}_found AS (SELECT rid, '{name}' AS kind, {rank} AS rank, value, fin - length(whole) AS ini, fin FROM (SELECT *, sum(length(gap) + length(whole)) OVER (PARTITION BY rid ORDER BY k)::BIGINT AS fin FROM {name}_each) WHERE length(value) >= {least}),"""


def _oracle() -> str:
    quoted = lambda p: p.replace("'", "''")
    rules = (("assign", ASSIGN, 2, 0, VALUE_LEAST), ("access", ACCESS, 0, 1, 1), ("hex", HEX, 0, 2, 1), ("markov", CANDIDATE, 0, 3, 1))
    parts = "".join(_AT.format(name=n, pattern=quoted(p), group=g, rank=r, least=m) for n, p, g, r, m in rules)
    k, chars, strip = len(KEY_CHARS), KEY_CHARS, "text"
    for p in (ASSIGN, ACCESS, HEX):
        strip = f"regexp_replace({strip}, '{quoted(p)}', ' ', 'g')"
    code = lambda at: f"(strpos('{chars}', substr(value, {at}, 1)) - 1)"
    pairs = lambda source, more: f"SELECT {more}, {code('i')} AS a, {code('i + 1')} AS b FROM (SELECT *, unnest(range(1, length(value))) AS i FROM {source}) WHERE {code('i')} >= 0 AND {code('i + 1')} >= 0"
    listed = lambda where: f"string_agg(kind || ':' || ini || ':' || fin, ',' ORDER BY ini, rank) FILTER (WHERE {where})"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),{parts}
base AS (SELECT * FROM assign_found UNION ALL SELECT * FROM access_found UNION ALL SELECT * FROM hex_found),
samples AS (SELECT DISTINCT TRUE AS random, value FROM base UNION ALL
  SELECT FALSE, value FROM (SELECT unnest(regexp_extract_all({strip}, '{ORDINARY}', 0)) AS value FROM docs WHERE text IS NOT NULL) WHERE regexp_matches(value, '{ONE_CASE}')),
counts AS (SELECT random, a, b, count(*) AS n FROM ({pairs("samples", "random")}) GROUP BY ALL),
totals AS (SELECT random, a, sum(n) AS total, count(*) AS kinds FROM counts GROUP BY ALL),
codes AS (SELECT unnest(range({k})) AS c),
chances AS (SELECT m.random, x.c AS a, y.c AS b, CASE WHEN t.total IS NULL THEN 1.0::DOUBLE / {k} ELSE (coalesce(n, 0) + t.kinds::DOUBLE / {k}) / (t.total + t.kinds)::DOUBLE END AS p
  FROM codes x CROSS JOIN codes y CROSS JOIN (VALUES (TRUE), (FALSE)) m(random) LEFT JOIN counts c ON c.random = m.random AND c.a = x.c AND c.b = y.c LEFT JOIN totals t ON t.random = m.random AND t.a = x.c),
weights AS (SELECT r.a, r.b, round_even(1000 * (ln(0.5 * r.p + 0.5::DOUBLE / {k}) - ln(o.p)), 0)::BIGINT AS w FROM chances r JOIN chances o ON r.random AND NOT o.random AND r.a = o.a AND r.b = o.b),
apart AS (SELECT * FROM markov_found m WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = m.rid AND b.ini < m.fin AND m.ini < b.fin)),
ratios AS (SELECT rid, ini, sum(w) AS ratio FROM ({pairs("apart", "rid, ini")}) p JOIN weights USING (a, b) GROUP BY ALL),
added AS (SELECT m.* FROM apart m JOIN ratios USING (rid, ini) WHERE ratio >= {round(1000 * LEAST_SUM)} AND ratio >= {round(1000 * LEAST_MEAN)} * (length(value) - 1)),
every AS (SELECT * FROM base UNION ALL SELECT * FROM added),
told AS (SELECT rid, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex, {listed("rank < 3")} AS base, {listed("TRUE")} AS spans FROM every GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN told USING (rid)
"""


ORACLE = _oracle()
