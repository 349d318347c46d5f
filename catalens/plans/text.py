"""Text queries: documents and pages as they are, and descriptions of parts put together from their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalens.functions import strings as S
from catalens.operators import stats
from catalens.operators import text as ops
from catalens.plans.registry import query
from catalens.plans.stats import SISTERS, majority


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---- pages

_STRIP = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<!--.*?-->', '', 'g'), '(?is)<script\b[^>]*>.*?</script\s*>', '', 'g'), '(?is)<style\b[^>]*>.*?</style\s*>', '', 'g'), '(?is)<noscript\b[^>]*>.*?</noscript\s*>', '', 'g'), '(?is)<svg\b[^>]*>.*?</svg\s*>', '', 'g'), '(?i)</?(p|div|br|li|tr|h1|h2|h3|h4|td|th)\b[^>]*>', chr(10), 'g'), '<[^>]+>', '', 'g')"""
_DECODED = _STRIP
for _e, _c in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
    _DECODED = f"replace({_DECODED}, '{_e}', '{_c}')"
PLAIN = rf"(SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(regexp_replace({_DECODED}, '\[[0-9]+(?:\s*,\s*[0-9]+)*\]', '', 'g'), '[ \t]+', ' ', 'g'), '\n{{2,}}', chr(10), 'g'), '^\s+|\s+$', '', 'g') AS text FROM pages)"


def plain(spark, d):
    return t(spark, d, "pages").select("page_id", "url", ops.html_to_text(F.col("html")).alias("text"))


@query("html_to_text", f"SELECT page_id, text FROM {PLAIN}")
def html_to_text(spark, d):
    return plain(spark, d).select("page_id", "text")


@query("html_to_text_exact")
def html_to_text_exact(spark, d):
    return t(spark, d, "pages").select("page_id", ops.html_to_text_exact("html").alias("text"))


_LOW = "lower(text)"
_START = f"CASE WHEN strpos({_LOW}, 'zzz') > 0 THEN strpos({_LOW}, 'zzz') WHEN strpos({_LOW}, 'la ') > 0 THEN strpos({_LOW}, 'la ') ELSE 1 END"


def _stop(m: str) -> str:
    return f"CASE WHEN strpos({_LOW}[s:], '{m}') > 41 THEN strpos({_LOW}[s:], '{m}') + s - 1 END"


CLIP = f"(SELECT page_id, url, text, trim(text[s:coalesce(least({_stop('that')}, {_stop('des')}), length(text) + 1) - 1], ' ' || chr(10) || chr(9) || chr(13)) AS clip FROM (SELECT *, {_START} AS s FROM {PLAIN}))"


@query("clip_text", f"SELECT page_id, clip FROM {CLIP}")
def clip_text(spark, d):
    return plain(spark, d).select("page_id", ops.clip_text(F.col("text"), ["zzz", "La "], ["that", "DES"]).alias("clip"))


_NAME = "CASE WHEN page_id % 2 = 0 THEN 'The Of' ELSE 'un la' END"
_HIT = f"length(text) >= 80 AND (strpos({_LOW}, lower({_NAME})) > 0 OR (strpos({_LOW}, split_part(lower({_NAME}), ' ', 1)) > 0 AND strpos({_LOW}, split_part(lower({_NAME}), ' ', 2)) > 0))"


@query("page_hit_filter", f"SELECT page_id FROM {PLAIN} WHERE {_HIT}")
def page_hit_filter(spark, d):
    name = F.when(F.col("page_id") % 2 == 0, "The Of").otherwise("un la")
    return plain(spark, d).filter(ops.page_hit(F.col("text"), name)).select("page_id")


@query("extract_page", f"SELECT page_id, CASE WHEN {_HIT} THEN (CASE WHEN clip = '' THEN text ELSE clip END)[:8000] END AS extract FROM {CLIP}")
def extract_page(spark, d):
    name = F.when(F.col("page_id") % 2 == 0, "The Of").otherwise("un la")
    return plain(spark, d).select("page_id", ops.extract_page(F.col("text"), name, ["zzz", "La "], ["that", "DES"]).alias("extract"))


# ---- documents

_FLAT = "trim(replace(text, chr(10), ' '), ' ' || chr(9) || chr(13))"
SENT = rf"(SELECT doc_id, list_filter(list_transform(string_split(regexp_replace({_FLAT}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS s FROM documents)"


@query("split_sentences", f"SELECT doc_id, len(s) AS n, s[1] AS first, s[-1] AS last FROM {SENT}")
def split_sentences(spark, d):
    return t(spark, d, "documents").select("doc_id", ops.sentences(F.col("text")).alias("s")).select("doc_id", F.size("s").cast("long").alias("n"), F.try_element_at("s", F.lit(1)).alias("first"), F.try_element_at("s", F.lit(-1)).alias("last"))


@query("keyword_sentences", f"SELECT doc_id, list_filter(s, lambda x: strpos(lower(x), 'token') > 0 OR strpos(lower(x), 'license') > 0) AS hits FROM {SENT}")
def keyword_sentences(spark, d):
    return t(spark, d, "documents").select("doc_id", ops.keyword_sentences(F.col("text"), ["token", "license"]).alias("hits"))


@query("split_sections", "WITH r AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents), k AS (SELECT doc_id, CASE WHEN i = 1 THEN '' ELSE 'L' || i % 3 END AS section, i, trim(line, ' ' || chr(9) || chr(13)) AS body FROM r) SELECT doc_id, section, arg_max(body, i) AS body FROM k GROUP BY ALL")
def split_sections(spark, d):
    """Documents with a heading put before each line but the first; headings repeat, so the last of a name counts."""
    lines = F.split("text", "\n")
    made = F.array_join(F.transform(lines, lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.lit("== L"), ((i + 1) % 3).cast("string"), F.lit(" ==\n"), x))), "\n")
    return ops.split_sections(t(spark, d, "documents").select("doc_id", made.alias("text")), "text", "doc_id")


# ---- descriptions of parts


def described(spark: SparkSession, d: str) -> DataFrame:
    """(item_id, text, lifeform, family, color_ids, low_cm, high_cm), dealt to as many tasks as a shuffle has: the table is small, and what is read off its texts is not."""
    k, size = F.col("p_partkey"), F.col("p_size")
    m = F.element_at(F.array(*[F.lit(x.capitalize()) for x in ops.MONTHS]), (size % 12 + 1).cast("int"))
    m2 = F.element_at(F.array(*[F.lit(x[:3]) for x in ops.MONTHS]), (k % 12 + 1).cast("int"))
    text = F.concat(
        F.lit("A plant of the "), F.when(size % 3 == 0, "meadow").when(size % 3 == 1, "garden and forest").otherwise("moon"), F.lit(". "),
        F.when(k % 4 == 0, F.concat(F.lit("It grows "), size.cast("string"), F.lit(" to "), (size + 20).cast("string"), F.lit(" cm tall. "))).when(k % 4 == 1, F.concat(F.lit("Its stem reaches "), size.cast("string"), F.lit(".5 feet. "))).otherwise("The leaf is 9 cm long. "),
        F.when(k % 5 == 0, F.concat(F.lit("It flowers from "), m, F.lit(" to "), m2, F.lit(". "))).when(k % 5 == 1, "Petals are white, in late summer. ").otherwise("Flowers blue above the large leaves with red veins. "),
        F.when(k % 7 == 0, "The seed is deadly.").when(k % 7 == 1, "Poisonous if eaten.").otherwise("Pentamerous."),
    )
    part = t(spark, d, "part").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    return part.select(k.alias("item_id"), text.alias("text"), F.when(size % 4 == 0, "Tree").when(size % 4 == 1, "bulb geophyte").alias("lifeform"), F.when(k % 3 == 0, "Liliaceae").otherwise(F.col("p_brand")).alias("family"), F.when(k % 6 == 0, F.array(F.lit("Q943"), F.lit("Q1"))).alias("color_ids"), F.when(k % 2 == 0, size).alias("low_cm"), F.lit(None).cast("int").alias("high_cm"))


_K, _S = "p_partkey", "p_size"
COLOR = f"list_sort(list_distinct(list_concat(CASE WHEN {_K} % 6 = 0 THEN [2] ELSE [] END, CASE {_K} % 5 WHEN 0 THEN [] WHEN 1 THEN [1] ELSE [4] END)))"
HABITAT = f"list_sort(list_concat(CASE {_S} % 3 WHEN 0 THEN [1] WHEN 1 THEN [2, 4] ELSE [] END, CASE WHEN {_S} % 4 = 0 THEN [6] ELSE [] END))"
PETAL = f"CASE WHEN {_K} % 7 > 1 THEN [2] WHEN {_K} % 3 = 0 THEN [3] ELSE [] END"


@query("infer_color", f"SELECT {_K} AS item_id, {COLOR} AS codes, CASE WHEN {_K} % 6 = 0 THEN 0.8 WHEN {_K} % 5 = 0 THEN 0.0 ELSE 0.7 END::DOUBLE AS confidence, array_to_string(list_concat(CASE WHEN {_K} % 6 = 0 THEN ['id Q943'] ELSE [] END, CASE {_K} % 5 WHEN 0 THEN [] WHEN 1 THEN ['word white'] ELSE ['red in lines or spots', 'word blue'] END), ';') AS evidence FROM part")
def infer_color(spark, d):
    return described(spark, d).select("item_id", ops.infer_color(F.col("text"), F.col("color_ids")).alias("a")).select("item_id", F.col("a.values").alias("codes"), F.col("a.confidence").alias("confidence"), F.array_join("a.evidence", ";").alias("evidence"))


@query("infer_habitat", f"SELECT {_K} AS item_id, {HABITAT} AS codes, CASE WHEN {_S} % 4 = 0 THEN 0.85 WHEN {_S} % 3 < 2 THEN 0.65 ELSE 0 END::DOUBLE AS confidence FROM part")
def infer_habitat(spark, d):
    return described(spark, d).select("item_id", ops.infer_habitat(F.col("text"), F.col("lifeform")).alias("a")).select("item_id", F.col("a.values").alias("codes"), F.col("a.confidence").alias("confidence"))


@query("infer_petal", f"SELECT {_K} AS item_id, {PETAL} AS codes, {_K} % 7 > 1 OR {_K} % 3 = 0 AS ok FROM part")
def infer_petal(spark, d):
    return described(spark, d).select("item_id", ops.infer_petal(F.col("text"), F.col("family")).alias("a")).select("item_id", F.col("a.values").alias("codes"), F.col("a.ok").alias("ok"))


HEIGHT = f"CASE {_K} % 4 WHEN 0 THEN {_S} WHEN 1 THEN {_S} * 30 + 15 END"
HEIGHT2 = f"CASE {_K} % 4 WHEN 0 THEN {_S} + 20 WHEN 1 THEN {_S} * 30 + 15 END"


@query("infer_height", f"SELECT {_K} AS item_id, ({HEIGHT})::INT AS low_cm, ({HEIGHT2})::INT AS high_cm, CASE {_K} % 4 WHEN 0 THEN {_S} || ' to ' || ({_S} + 20) || ' cm' WHEN 1 THEN 'reaches ' || {_S} || '.5 feet' END AS evidence FROM part")
def infer_height(spark, d):
    return described(spark, d).select("item_id", ops.infer_height("text").alias("h")).select("item_id", "h.*")


@query("infer_flowering", f"SELECT {_K} AS item_id, (CASE {_K} % 5 WHEN 0 THEN least({_S} % 12, {_K} % 12) + 1 WHEN 1 THEN 8 END)::INT AS first, (CASE {_K} % 5 WHEN 0 THEN greatest({_S} % 12, {_K} % 12) + 1 WHEN 1 THEN 9 END)::INT AS last FROM part")
def infer_flowering(spark, d):
    return described(spark, d).select("item_id", ops.infer_flowering("text").alias("f")).select("item_id", "f.first", "f.last")


@query("infer_toxicity", f"SELECT {_K} AS item_id, CASE {_K} % 7 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS toxicity FROM part")
def infer_toxicity(spark, d):
    return described(spark, d).select("item_id", ops.infer_toxicity(F.col("text")).alias("toxicity"))


GROUP = f"""(SELECT {_K} AS item_id, p_name AS name, CASE WHEN {_S} % 3 <> 0 THEN [1 + {_S} % 5] ELSE []::INT[] END AS color, CASE WHEN {_K} % 4 <> 0 THEN [(1 + {_K} % 6)::INT, 2] ELSE []::INT[] END AS habitat,
  CASE WHEN {_K} % 3 <> 0 THEN {_S} END AS height_from, CASE WHEN {_K} % 3 = 1 THEN {_S} * 2 END AS height_to, CASE WHEN {_K} % 2 = 0 THEN 1 + {_S} % 12 END AS flowering_from, CASE WHEN {_K} % 2 = 0 THEN 2 + {_S} % 12 END AS flowering_to FROM part)"""


def known_traits(spark: SparkSession, d: str) -> DataFrame:
    """Parts as items that the catalog has."""
    k, size, none = F.col("p_partkey"), F.col("p_size"), F.array().cast("array<int>")
    return t(spark, d, "part").select(
        k.alias("item_id"), F.col("p_name").alias("name"), F.when(size % 3 != 0, F.array(1 + size % 5)).otherwise(none).alias("color"), F.when(k % 4 != 0, F.array((1 + k % 6).cast("int"), F.lit(2))).otherwise(none).alias("habitat"),
        F.when(k % 3 != 0, size).alias("height_from"), F.when(k % 3 == 1, size * 2).alias("height_to"), F.when(k % 2 == 0, 1 + size % 12).alias("flowering_from"), F.when(k % 2 == 0, 2 + size % 12).alias("flowering_to"),
    )


def _told(c: str) -> str:
    at = "CASE {k} % 5 WHEN 0 THEN {f}({s} % 12, {k} % 12) + 1 WHEN 1 THEN {x} END"
    return at.format(k=_K, s=_S, f="least" if c == "from" else "greatest", x=8 if c == "from" else 9)


@query(
    "infer_traits",
    f"""WITH g AS {GROUP}, s AS (SELECT s.item_id, s.n, g.* EXCLUDE (item_id) FROM {SISTERS} s JOIN g ON s.sister_id = g.item_id),
      c AS {majority("(SELECT item_id, color AS codes FROM s)", "item_id")}, h AS {majority("(SELECT item_id, habitat AS codes FROM s)", "item_id")},
      m AS (SELECT item_id, round_even(median(height_from), 0)::INT AS hf, round_even(median(height_to), 0)::INT AS ht, round_even(median(flowering_from), 0)::INT AS ff, round_even(median(flowering_to), 0)::INT AS ft, 'from ' || array_to_string(list(name ORDER BY n)[:4], ', ') AS names FROM s GROUP BY item_id),
      t AS (SELECT {_K} AS item_id, {COLOR} AS color, {HABITAT} AS habitat, {PETAL} AS petal, coalesce(({HEIGHT})::INT, CASE WHEN {_K} % 2 = 0 THEN {_S} END) AS height_from, coalesce(({HEIGHT2})::INT, CASE WHEN {_K} % 2 = 0 THEN {_S} END) AS height_to,
        ({_told("from")})::INT AS flowering_from, ({_told("to")})::INT AS flowering_to, CASE {_K} % 7 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS toxicity FROM part),
      f AS (SELECT t.*, m.*  EXCLUDE (item_id), c.codes AS cc, h.codes AS hc, len(color) = 0 AND cc IS NOT NULL AS fc, len(habitat) = 0 AND hc IS NOT NULL AS fh, height_from IS NULL AND hf IS NOT NULL AND ht IS NOT NULL AS fs, flowering_from IS NULL AND ff IS NOT NULL AND ft IS NOT NULL AS fm
        FROM t LEFT JOIN m USING (item_id) LEFT JOIN c USING (item_id) LEFT JOIN h USING (item_id))
    SELECT item_id, CASE WHEN fc THEN cc ELSE color END AS color, CASE WHEN fh THEN hc ELSE habitat END AS habitat, petal, CASE WHEN fs THEN hf ELSE height_from END AS height_from, CASE WHEN fs THEN ht ELSE height_to END AS height_to,
      CASE WHEN fm THEN ff ELSE flowering_from END AS flowering_from, CASE WHEN fm THEN ft ELSE flowering_to END AS flowering_to, toxicity, CASE WHEN fc OR fh OR fs OR fm THEN names END AS filled FROM f""",
)
def infer_traits(spark, d):
    """Traits of the described parts, with gaps filled from parts of the same first word."""
    known = known_traits(spark, d)
    found = ops.complete_traits(ops.infer_traits(described(spark, d)), stats.sister_items(known.select("item_id", "name")), known)
    return found.select("item_id", F.col("color.values").alias("color"), F.col("habitat.values").alias("habitat"), F.col("petal.values").alias("petal"), "height_from", "height_to", "flowering_from", "flowering_to", "toxicity", "filled")


WORDS = {k: v for k, v in zip(("flower", "inflorescence", "fruit", "leaf", "stem", "habitat"), (("the ", "que "), ("ed ", "ment "), ("ing ", "en "), ("tion ", "der "), ("er ", "los "), ("of ", "la ")))}


@query("draft_sections")
def draft_sections(spark, d):
    """Documents as pages: lead and lines as sections, frequent syllables as the fields' words."""
    lines = F.split("text", "\n")
    line = lambda i: F.coalesce(F.try_element_at(lines, F.lit(i)), F.lit(""))
    pages = t(spark, d, "documents").select(F.col("doc_id").alias("item_id"), line(1).alias("lead"), line(2).alias("description"), line(3).alias("ecology"), line(4).alias("distribution"), F.array_join(F.slice(lines, F.lit(5), F.size(lines)), "\n").alias("other"), F.array(F.lit(1), F.lit(4)).alias("codes"), F.lit(None).cast("string").alias("fruit"), F.col("source").alias("lifeform"))
    return ops.draft_sections(pages, WORDS, {1: ("the", "la"), 4: ("ing", "que")})


@query("group_text_consensus", "SELECT source, CASE WHEN bool_or(strpos(lower(text), 'token') > 0) THEN 'has a token' WHEN bool_or(strpos(lower(text), '|') > 0) THEN 'has a table' ELSE 'plain' END AS sentence FROM documents WHERE text <> '' GROUP BY source HAVING count(*) >= 2 AND bool_and(strpos(lower(text), 'e') > 0)")
def group_text_consensus(spark, d):
    return ops.group_text_consensus(t(spark, d, "documents"), "source", "text", "e", [("token", "has a token"), ("|", "has a table")], "plain")


# ---- scalar functions, each over a whole table


@query("normalize_name", "SELECT p_partkey, 'x ' || lower(p_name) || ' x ' || lower(p_type) AS norm FROM part")
def normalize_name(spark, d):
    return t(spark, d, "part").select("p_partkey", S.normalize_name(F.concat(F.lit(" ×  "), F.upper("p_name"), F.lit("\t✕ "), "p_type", F.lit(" "))).alias("norm"))


@query("normalize_vernacular", "SELECT doc_id, trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) AS norm FROM documents")
def normalize_vernacular(spark, d):
    return t(spark, d, "documents").select("doc_id", S.normalize_vernacular(F.col("text")).alias("norm"))


@query("display_name", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN lower(p_name) WHEN p_size % 3 = 0 THEN p_type ELSE lower(p_brand[1]) || p_brand[2:] || ' ' || p_type END AS shown FROM part")
def display_name(spark, d):
    even = F.col("p_size") % 2 == 0
    name = F.when(even, F.upper("p_name")).when(F.col("p_size") % 3 == 0, F.col("p_type")).otherwise(F.concat_ws(" ", "p_brand", "p_type"))
    return t(spark, d, "part").select("p_partkey", S.display_name(F.concat(F.lit(" "), name), F.when(even, "en").otherwise("de")).alias("shown"))


@query("is_latinish", "SELECT p_partkey, p_size % 5 <> 4 AS latin FROM part")
def is_latinish(spark, d):
    k = F.col("p_size") % 5
    name = F.when(k == 0, F.upper("p_name")).when(k == 1, F.concat("p_type", F.lit("  var"))).when(k == 2, "").when(k == 3, F.concat(F.substring_index("p_name", " ", 1), F.lit(" anything"))).otherwise(F.col("p_brand"))
    return t(spark, d, "part").select("p_partkey", S.is_latinish(name, F.col("p_name"), F.array("p_type")).alias("latin"))


@query("split_cited_names", "SELECT p_partkey, [p_name, p_type] AS names FROM part")
def split_cited_names(spark, d):
    return t(spark, d, "part").select("p_partkey", S.split_cited_names(F.concat(F.lit(" "), "p_name", F.lit(" (x) 12; ab,, "), "p_type", F.lit(" ."))).alias("names"))


@query("url_language", "SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'fr' END AS lang, 'Part ' || page_id || ' é' AS title FROM pages")
def url_language(spark, d):
    url = F.concat(F.when(F.col("page_id") % 3 == 0, "https://fr.wikipedia.org/wiki/").when(F.col("page_id") % 3 == 1, "https://www.wikipedia.org/").otherwise("https://fr.example.org/"), F.lit("Part_"), F.col("page_id"), F.lit("_%C3%A9/"))
    return t(spark, d, "pages").select("page_id", S.url_language(url).alias("lang"), S.url_title(url).alias("title"))


@query("url_template", "SELECT p_partkey, 'x/' || split_part(p_name, ' ', 1) || '/' || split_part(p_name, ' ', 2) || '?q=' || replace(p_name, ' ', '+') AS url FROM part")
def url_template(spark, d):
    return t(spark, d, "part").select("p_partkey", S.url_template(F.lit("x/{genus}/{species}?q={name+}"), F.col("p_name")).alias("url"))


@query("family_alias", "SELECT p_partkey, CASE WHEN lower(p_type) = 'promo' THEN 'new' ELSE lower(p_type) END AS family FROM part")
def family_alias(spark, d):
    return t(spark, d, "part").select("p_partkey", S.family_alias(F.concat("p_type", F.lit(" 12-")), {"promo": "new"}).alias("family"))


@query("photo_prefix", "SELECT p_partkey, p_name[1] || split_part(p_name, ' ', 2)[1] AS prefix, CASE WHEN p_size % 2 = 0 THEN p_type ELSE 'Unknown' END || '/' || p_brand || '/' || replace(p_name, ' ', '_') AS folder, replace(p_name, ' ', '_') AS slug FROM part")
def photo_prefix(spark, d):
    return t(spark, d, "part").select("p_partkey", S.photo_prefix(F.upper("p_name")).alias("prefix"), S.storage_folder(F.when(F.col("p_size") % 2 == 0, F.col("p_type")), F.col("p_brand"), F.col("p_name")).alias("folder"), S.slug(F.col("p_name")).alias("slug"))


@query("derived_url", "SELECT page_id, CASE WHEN len(p) >= 3 THEN array_to_string(p[1:3], '/') || '/' || p[3] || '.webp' ELSE url END AS derived FROM (SELECT page_id, url, string_split(url, '/') AS p FROM pages)")
def derived_url(spark, d):
    return t(spark, d, "pages").select("page_id", S.derived_url(F.col("url")).alias("derived"))


@query("plate_names", "SELECT p_partkey, [p_name || '.webp', p_name || '@1600.webp', p_name || '@400.webp'] AS plates, p_name || '_distribution.webp' AS map FROM part")
def plate_names(spark, d):
    name = F.concat(F.lit("a/b/"), "p_name", F.when(F.col("p_size") % 2 == 0, "@1600").otherwise(""), F.lit(".webp"))
    return t(spark, d, "part").select("p_partkey", S.plate_names(name).alias("plates"), S.distribution_map_name(name).alias("map"))


@query("quantity_to_cm", "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_size * 100 WHEN 1 THEN round_even(p_size * 0.5, 0)::INT WHEN 2 THEN p_size * 30 END AS cm FROM part")
def quantity_to_cm(spark, d):
    k = F.col("p_size") % 4
    unit = F.when(k == 0, "Metres").when(k == 1, "cm").when(k == 2, "feet").otherwise("miles")
    return t(spark, d, "part").select("p_partkey", S.quantity_to_cm(F.when(k == 1, F.col("p_size") * 0.5).otherwise(F.col("p_size")), unit).alias("cm"))


@query("strip_html", "SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM pages")
def strip_html(spark, d):
    return t(spark, d, "pages").select("page_id", S.strip_html(F.col("html")).alias("text"))


@query("normalize_latin", "SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z]+', ' ', 'g')) AS latin FROM documents")
def normalize_latin(spark, d):
    return t(spark, d, "documents").select("doc_id", S.normalize_latin(F.col("text")).alias("latin"))


@query("codes_to_int_set", "SELECT event_id, [(props->>'$.k')::INT] AS a, CASE WHEN event_id % 4 = 0 THEN [(event_id % 7)::INT] ELSE list_distinct([(event_id % 7)::INT, 3]) END AS b FROM events".replace("list_distinct([(event_id % 7)::INT, 3])", "CASE WHEN event_id % 7 = 3 THEN [3] ELSE [(event_id % 7)::INT, 3] END"))
def codes_to_int_set(spark, d):
    """Codes as JSON objects (the props themselves) and as lists with strings, nulls and repeats."""
    k = (F.col("event_id") % 7).cast("string")
    listed = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit('["'), k, F.lit('",null,""]'))).otherwise(F.concat(F.lit("["), k, F.lit(",3,3]")))
    return t(spark, d, "events").select("event_id", S.codes_to_int_set(F.col("props")).alias("a"), S.codes_to_int_set(listed).alias("b"))


@query("sparse_count", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 5 = 0 THEN 0 ELSE 2 END AS n FROM orders")
def sparse_count(spark, d):
    k = F.col("o_orderkey")
    values = F.when((k % 5 == 0) & (k % 3 != 0), F.array(F.lit(None).cast("string"))).otherwise(F.array(F.col("o_orderstatus"), F.when(k % 3 != 0, F.col("o_orderpriority"))))
    return t(spark, d, "orders").select("o_orderkey", S.sparse_count(values).alias("n"))


@query("plural_copy", "SELECT l_orderkey, CASE WHEN count(*) = 1 THEN 'one line' ELSE count(*) || ' lines' END AS copy, left(l_orderkey || '-token-token', 8) || '…oken' AS masked FROM lineitem GROUP BY l_orderkey")
def plural_copy(spark, d):
    n = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return n.select("l_orderkey", S.plural_copy(F.col("n"), "one line", "{n} lines").alias("copy"), S.mask_token(F.concat(F.col("l_orderkey").cast("string"), F.lit("-token-token"))).alias("masked"))


@query("mask_token", "SELECT c_custkey, CASE WHEN length(c_name) <= 12 THEN c_name ELSE substr(c_name, 1, 8) || '…' || substr(c_name, -4) END AS masked, c_nationkey::VARCHAR AS short FROM customer")
def mask_token(spark, d):
    return t(spark, d, "customer").select("c_custkey", S.mask_token(F.col("c_name")).alias("masked"), S.mask_token(F.col("c_nationkey").cast("string")).alias("short"))


@query("url_title", "SELECT page_id, replace(url_decode(replace(string_split(rtrim(u, '/'), '/')[-1], '+', '%2B')), '_', ' ') AS title FROM (SELECT page_id, url || CASE page_id % 3 WHEN 0 THEN '/a_%C3%A9+b%20c' ELSE '' END AS u FROM pages)")
def url_title(spark, d):
    """Titles of all pages' URLs, a third of them with escapes."""
    url = F.concat("url", F.when(F.col("page_id") % 3 == 0, "/a_%C3%A9+b%20c").otherwise(""))
    return t(spark, d, "pages").select("page_id", S.url_title(url).alias("title"))


@query("storage_folder", "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'Unknown' ELSE n_name END || '/' || CASE WHEN s_suppkey % 5 = 0 THEN 'Unknown' ELSE 'n' || s_nationkey END || '/' || replace(s_name || ' x', ' ', '_') AS folder FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def storage_folder(spark, d):
    s = t(spark, d, "supplier").join(t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    order, family = F.when(F.col("s_suppkey") % 3 != 0, F.col("n_name")), F.when(F.col("s_suppkey") % 5 == 0, "").otherwise(F.concat(F.lit("n"), F.col("s_nationkey").cast("string")))
    return s.select("s_suppkey", S.storage_folder(order, family, F.concat("s_name", F.lit(" x"))).alias("folder"))


@query("slug", "SELECT p_partkey, replace(p_name, ' ', '_') AS slug FROM part")
def slug(spark, d):
    return t(spark, d, "part").select("p_partkey", S.slug(F.col("p_name")).alias("slug"))
