"""Saved payloads of lookups, as rows (name, body): entities, matches, media, name tables, galleries, articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalens.functions.strings import strip_html
from catalens.operators.media import license_ok, plate_author, plate_score

_VALUE = "struct<value:string>"
_CLAIM = "struct<mainsnak:struct<datavalue:struct<value:string>>>"
ENTITY = f"struct<id:string,labels:map<string,{_VALUE}>,aliases:map<string,array<{_VALUE}>>,sitelinks:map<string,struct<title:string,url:string>>,claims:map<string,array<{_CLAIM}>>>"


def parse_entities(rows: DataFrame, fields: dict[str, str], quantity: str) -> DataFrame:
    """Entities of JSON bodies: labels, aliases, pages by language, the first string claim of each of ``fields`` (column -> property), and the bounds of a quantity's claims.

    A body that is no entity gives nulls.
    """
    e = rows.withColumn("e", F.from_json("body", ENTITY))
    claims = F.col("e.claims")
    first = lambda p: F.try_element_at(F.try_element_at(claims, F.lit(p)), F.lit(1))["mainsnak"]["datavalue"]["value"]
    amounts = F.filter(F.transform(F.coalesce(F.try_element_at(claims, F.lit(quantity)), F.array().cast(f"array<{_CLAIM}>")), lambda c: F.regexp_replace(F.get_json_object(c["mainsnak"]["datavalue"]["value"], "$.amount"), r"^\+", "").try_cast("double")), lambda x: x.isNotNull())
    pages = F.map_filter("e.sitelinks", lambda k, v: k.rlike("^[a-z]{2,3}wiki$"))
    return e.select(
        "name", F.col("e.id").alias("qid"), F.transform_values("e.labels", lambda k, v: v["value"]).alias("labels"), F.transform_values("e.aliases", lambda k, v: F.transform(v, lambda x: x["value"])).alias("aliases"),
        F.transform_keys(F.transform_values(pages, lambda k, v: v["url"]), lambda k, v: F.regexp_replace(k, "wiki$", "")).alias("wikipedia"), *[first(p).alias(c) for c, p in fields.items()],
        F.array_min(amounts).alias("low"), F.array_max(amounts).alias("high"),
    )


def parse_matches(rows: DataFrame) -> DataFrame:
    """Rows of match payloads; those that matched nothing drop out."""
    m = rows.withColumn("m", F.from_json("body", "struct<usageKey:long,matchType:string,status:string,family:string,genus:string,`order`:string>"))
    return m.filter("m.matchType <> 'NONE'").select("name", F.col("m.usageKey").alias("usage_key"), F.col("m.status").alias("status"), F.col("m.family").alias("family"), F.col("m.genus").alias("genus"), F.col("m.`order`").alias("ord"))


def parse_id_search(rows: DataFrame) -> DataFrame:
    """(query, pos, name, ipni_id, in_powo) of id-search payloads."""
    hit = F.posexplode(F.col("m.results")).alias("pos", "h")
    return rows.withColumn("m", F.from_json("body", "struct<results:array<struct<id:string,name:string,inPowo:boolean>>>")).select(F.col("name").alias("query"), hit).select("query", "pos", F.col("h.name").alias("name"), F.col("h.id").alias("ipni_id"), F.col("h.inPowo").alias("in_powo"))


_INFO = "struct<url:string,descriptionurl:string,mime:string,width:int,height:int,extmetadata:map<string,struct<value:string>>>"


def parse_media(rows: DataFrame) -> DataFrame:
    """Files of media queries: one row for each page with image information, tags stripped from its metadata."""
    page = F.explode(F.map_values("m.query.pages"))
    p = rows.withColumn("m", F.from_json("body", f"struct<query:struct<pages:map<string,struct<title:string,imageinfo:array<{_INFO}>>>>>")).select("name", page.alias("p")).filter(F.size("p.imageinfo") > 0).select("name", "p.title", F.element_at("p.imageinfo", 1).alias("i"))
    meta = lambda k: strip_html(F.try_element_at(F.col("i.extmetadata"), F.lit(k))["value"])
    text = lambda c: F.coalesce(F.col(f"i.{c}"), F.lit("")).alias(c)
    return p.select("name", F.coalesce("title", F.lit("")).alias("title"), text("url"), text("mime"), F.coalesce("i.width", F.lit(0)).alias("width"), F.coalesce("i.height", F.lit(0)).alias("height"), meta("LicenseShortName").alias("license"), license_ok(meta("LicenseShortName")).alias("license_ok"), meta("ImageDescription").alias("description"), meta("ObjectName").alias("object_name"), meta("Categories").alias("categories"), meta("Artist").alias("artist"))


def parse_occurrence_media(rows: DataFrame) -> DataFrame:
    """Media of occurrence payloads: images with a URL, each once for a name."""
    o = rows.withColumn("m", F.from_json("body", "struct<results:array<struct<media:array<struct<identifier:string,type:string,format:string,license:string>>>>>"))
    each = o.select("name", F.posexplode(F.flatten(F.transform("m.results", lambda r: F.coalesce(r["media"], F.array().cast("array<struct<identifier:string,type:string,format:string,license:string>>"))))).alias("pos", "i"))
    ok = each.filter((F.coalesce("i.identifier", F.lit("")) != "") & (F.col("i.type") == "StillImage"))
    return ok.groupBy("name", F.col("i.identifier").alias("url")).agg(F.min_by(F.struct("i.license", "i.format"), "pos").alias("r")).select("name", "url", "r.license", "r.format")


def language_code(label: Column, codes: dict[str, str]) -> Column:
    """The code of a language's name, parentheses left out."""
    raw = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim(label)), r"\s*\([^)]*\)\s*", " "), r"\s+", " "))
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in codes.items() for x in kv]), raw)


def parse_names_table(rows: DataFrame, codes: dict[str, str], table: str = "tbcommon") -> DataFrame:
    """(name, lang, names) of HTML tables of common names: distinct in order, scientific names and unknown languages left out."""
    part = F.regexp_extract("body", rf'(?is)id="{table}".*?</table>', 0)
    cell = r"(?is)<tr>\s*<td>(.*?)</td>\s*<td[^>]*>(.*?)</td>"
    plain = lambda x: F.trim(F.replace(F.replace(F.regexp_replace(x, "<[^>]+>", ""), F.lit("&#39;"), F.lit("'")), F.lit("&amp;"), F.lit("&")))
    both = F.arrays_zip(F.regexp_extract_all(part, F.lit(cell), F.lit(1)).alias("v"), F.regexp_extract_all(part, F.lit(cell), F.lit(2)).alias("l"))
    r = rows.select("name", F.posexplode(both).alias("pos", "z")).select("name", "pos", plain(F.col("z.v")).alias("v"), language_code(plain(F.col("z.l")), codes).alias("lang"))
    r = r.filter((F.col("v") != "") & F.col("lang").isNotNull() & (F.lower("v") != F.lower(F.trim("name"))))
    return r.groupBy("name", "lang").agg(F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"])).alias("names"))


def links(rows: DataFrame) -> DataFrame:
    """(key, pos, href, text) of a page's anchors, from (key, body)."""
    a = r'(?is)<a\b[^>]*href="([^"]*)"[^>]*>(.*?)</a>'
    both = F.arrays_zip(F.regexp_extract_all("body", F.lit(a), F.lit(1)).alias("href"), F.regexp_extract_all("body", F.lit(a), F.lit(2)).alias("text"))
    return rows.select("key", F.posexplode(both).alias("pos", "z")).select("key", "pos", "z.href", strip_html(F.col("z.text")).alias("text"))


#: Ranks below the species whose links are passed over (fixed values).
LOWER_RANKS = (" forma ", " variety ", " subspecies ", " subsp.", " var.", " f. ")


def _tags(rows: DataFrame, tag: str) -> DataFrame:
    return rows.withColumn("raw", F.regexp_extract_all("body", F.lit(tag), F.lit(0))).select("key", "wanted", F.posexplode("raw").alias("pos", "raw"))


def _attribute(name: str) -> Column:
    return F.regexp_extract("raw", rf'(?is)^<[^>]*\s{name}="([^"]*)"', 1)


_ANCHOR = r"(?is)<a\b[^>]*>.*?</a>"


def gallery_species(pages: DataFrame) -> DataFrame:
    """(key, species_id, label, plates) of search pages (key, wanted, body): the species whose label holds the wanted name.

    The label is the shortest of a species' links (the first of equals), the plates the largest number in brackets of its
    links, 0 without one. Links to lower ranks and empty ones don't count. Pages are dealt to as many tasks as a shuffle has
    before they are parsed.
    """
    pages = pages.repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key")
    a = _tags(pages, _ANCHOR).withColumn("href", _attribute("href")).withColumn("text", strip_html(F.col("raw")))
    species = F.regexp_extract("href", r"species\.php.*[?&;]id_species=(\d+)", 1).try_cast("long")
    low = F.concat(F.lit(" "), F.lower("text"), F.lit(" "))
    lower_rank = F.exists(F.array(*map(F.lit, LOWER_RANKS)), lambda r: F.contains(low, r))
    count = F.regexp_extract("raw", r"(?i)\[(?:<strong>)?(\d+)(?:</strong>)?\]", 1).try_cast("int")
    rows = a.select("key", "wanted", "pos", "text", species.alias("species_id"), count.alias("n")).filter(F.col("species_id").isNotNull() & (F.col("text") != "") & ~lower_rank)
    name = F.when(F.col("n").isNull() & F.contains(F.lower("text"), F.lower(F.trim("wanted"))), F.struct(F.length("text"), "pos", "text"))
    return rows.groupBy("key", "species_id").agg(F.min(name)["text"].alias("label"), F.coalesce(F.max("n"), F.lit(0)).alias("plates")).filter("label is not null")


def gallery_plates(pages: DataFrame) -> DataFrame:
    """(key, plate_id, title, author, score) of gallery pages (key, body): each plate once, thumbnails before links, which score 0."""
    pages = pages.select("key", F.lit(None).cast("string").alias("wanted"), "body")
    i = _tags(pages, r"(?is)<img\b[^>]*>").withColumn("src", _attribute("src")).filter(F.col("src").contains("ILLUSTRATIONS_thumbnails"))
    stem = F.regexp_replace(F.substring_index("src", "/", -1), r"\.[^.]*$", "")
    shown = i.filter(~F.substring_index("src", "/", -1).startswith("0.")).select("key", F.lit(0).alias("kind"), "pos", F.when(stem.rlike(r"^\d+$"), stem).try_cast("long").alias("plate_id"), _attribute("title").alias("title"))
    a = _tags(pages, _ANCHOR).withColumn("href", _attribute("href"))
    linked = a.select("key", F.lit(1).alias("kind"), "pos", F.regexp_extract("href", r"illustration\.php.*[?&;]id_illustration=(\d+)", 1).try_cast("long").alias("plate_id"), strip_html(F.col("raw")).alias("title"))
    rows = shown.unionByName(linked).filter("plate_id is not null")
    first = rows.groupBy("key", "plate_id").agg(F.min(F.struct("kind", "pos", "title")).alias("p")).select("key", "plate_id", "p.title", "p.kind")
    return first.select("key", "plate_id", "title", plate_author(F.col("title")).alias("author"), F.when(F.col("kind") == 0, plate_score(F.col("title"))).otherwise(0).alias("score"))


def parse_articles(rows: DataFrame) -> DataFrame:
    """(name, text) of the English article of nested payloads, behind the names."""
    m = rows.withColumn("m", F.from_json("body", "struct<articles:array<struct<language:string,html:string,names:array<string>>>>"))
    a = F.try_element_at(F.filter("m.articles", lambda x: F.lower(x["language"]) == "en"), F.lit(1))
    return m.select("name", a.alias("a")).filter("a is not null").select("name", F.trim(F.concat_ws(" ", F.array_join("a.names", ", "), strip_html(F.col("a.html")))).alias("text"))
