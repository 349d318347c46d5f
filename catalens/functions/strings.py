"""Column expressions over names, URLs, quantities and coded lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that may not stand in a key (fixed value).
ILLEGAL_KEY = r"[./#$\[\]]"
#: Markers of lines that list names, and their languages (fixed values).
NAME_LINES = (
    ("česká jména", "cs"), ("české jména", "cs"), ("české mená", "cs"), ("slovenská jména", "sk"), ("slovenské jména", "sk"),
    ("slovenská mená", "sk"), ("slovenské mená", "sk"), ("english names", "en"), ("common names", "en"),
)
#: Centimetres of a unit of length (fixed values).
UNIT_CM = {"m": 100, "meter": 100, "meters": 100, "metre": 100, "metres": 100, "cm": 1, "centimetre": 1, "centimetres": 1, "centimeter": 1, "centimeters": 1, "ft": 30, "foot": 30, "feet": 30, "in": 3, "inch": 3, "inches": 3}


def given(x: Column) -> Column:
    """The value, or null for an empty one."""
    return F.nullif(x, F.lit(""))


def first_given(*xs: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[given(x) for x in xs])


def spaced(x: Column) -> Column:
    """White space trimmed and collapsed; null stays."""
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def normalize_name(x: Column) -> Column:
    """Lower case, multiplication signs as x, spaces collapsed; null gives an empty string."""
    return F.coalesce(spaced(F.translate(F.lower(x), "×✕", "xx")), F.lit(""))


def normalize_vernacular(x: Column) -> Column:
    return F.coalesce(F.lower(spaced(x)), F.lit(""))


def display_name(x: Column, lang: Column) -> Column:
    """As shown: lower case; German keeps single nouns and lowers the first letter of several words."""
    t = F.coalesce(F.trim(x), F.lit(""))
    german = F.when(t.contains(" "), F.concat(F.lower(F.substring(t, 1, 1)), F.substring(t, 2, 1 << 30))).otherwise(t)
    return F.when(lang.eqNullSafe("de"), german).otherwise(F.lower(t))


def is_latinish(name: Column, latin: Column, synonyms: Column) -> Column:
    """Whether a name is empty, the scientific name, one of its synonyms (alone or with more behind it), or begins with its first word."""
    token, bits = normalize_vernacular(name), F.split(spaced(F.coalesce(latin, F.lit(""))), " ")
    same = (token == "") | (token == normalize_vernacular(latin))
    other = F.exists(F.coalesce(synonyms, F.array().cast("array<string>")), lambda s: (F.coalesce(s, F.lit("")) != "") & ((token == normalize_vernacular(s)) | token.startswith(F.concat(normalize_vernacular(s), F.lit(" ")))))
    two = (F.size(bits) >= 2) & (token == F.lower(F.array_join(F.slice(bits, 1, 2), " ")))
    genus, words = F.lower(F.element_at(bits, 1)), F.split(token, " ")
    return same | F.coalesce(other, F.lit(False)) | two | ((genus != "") & (F.size(words) >= 2) & (F.element_at(words, 1) == genus))


def split_cited_names(x: Column) -> Column:
    """Names of a cited list: parentheses split like commas; digits and names under 3 characters go."""
    parts = F.split(F.regexp_replace(F.coalesce(x, F.lit("")), r"\([^)]*\)", ","), "[,;]")
    return F.filter(F.transform(parts, lambda p: F.regexp_replace(p, r"^[ .;]+|[ .;]+$", "")), lambda p: (F.length(p) >= 3) & ~p.rlike(r"^[0-9]+$"))


def labelled_line(text: Column, marker: str) -> Column:
    """What stands behind ``marker :`` up to the line's end; null without the marker."""
    return given(F.regexp_extract(text, rf"(?iu){marker}\s*:\s*([^\n]+?)(?:\n|$)", 1))


def url_language(url: Column) -> Column:
    """The language subdomain of an encyclopedia's URL; null for other hosts and for those that are no language."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    first = F.substring_index(host, ".", 1)
    return F.when(host.endswith("wikipedia.org") & ~first.isin("www", "simple", "species", "wikipedia"), first)


def url_title(url: Column) -> Column:
    """The last part of a URL's path, percent signs decoded (a plus stays one), with spaces for underscores."""
    last = F.substring_index(F.rtrim(url, F.lit("/")), "/", -1)
    return F.translate(F.coalesce(F.try_url_decode(F.replace(last, F.lit("+"), F.lit("%2B"))), last), "_", " ")


def photo_prefix(name: Column) -> Column:
    """First letters of the first and the last word; xx for an empty name."""
    words = F.split(spaced(name), " ")
    return F.when(F.coalesce(spaced(name), F.lit("")) == "", "xx").otherwise(F.lower(F.concat(F.substring(F.element_at(words, 1), 1, 1), F.substring(F.element_at(words, -1), 1, 1))))


def storage_folder(order: Column, family: Column, name: Column) -> Column:
    return F.concat_ws("/", F.coalesce(given(order), F.lit("Unknown")), F.coalesce(given(family), F.lit("Unknown")), F.replace(name, F.lit(" "), F.lit("_")))


def slug(name: Column) -> Column:
    return F.replace(name, F.lit(" "), F.lit("_"))


def derived_url(url: Column) -> Column:
    """First three segments, and the third again as a .webp; shorter URLs stay, null is empty."""
    parts = F.split(url, "/")
    out = F.concat(F.array_join(F.slice(parts, 1, 3), "/"), F.lit("/"), F.element_at(parts, 3), F.lit(".webp"))
    return F.coalesce(F.when(F.size(parts) >= 3, out).otherwise(url), F.lit(""))


def plate_stem(name: Column) -> Column:
    """A file's name without folder, size suffix and extension."""
    return F.regexp_replace(F.regexp_replace(F.substring_index(name, "/", -1), r"\.[^.]+$", ""), "@(1600|400)$", "")


def plate_names(name: Column) -> Column:
    """The plate's files: full, and in two sizes."""
    stem = plate_stem(name)
    return F.array(*[F.concat(stem, F.lit(s), F.lit(".webp")) for s in ("", "@1600", "@400")])


def distribution_map_name(name: Column) -> Column:
    return F.concat(plate_stem(name), F.lit("_distribution.webp"))


def name_parts(name: Column) -> dict[str, Column]:
    """Tokens that a URL template may hold."""
    words = F.split(spaced(name), " ")
    genus, species = F.element_at(words, 1), F.coalesce(F.try_element_at(words, F.lit(2)), F.lit(""))
    return {"name": name, "Genus": genus, "genus": F.lower(genus), "species": species, "name_": slug(name), "name-": F.replace(F.lower(name), F.lit(" "), F.lit("-")), "name+": F.replace(name, F.lit(" "), F.lit("+")), "name%20": F.replace(name, F.lit(" "), F.lit("%20")), "initial": F.lower(F.substring(genus, 1, 1))}


def url_template(template: Column, name: Column) -> Column:
    """The template with each ``{token}`` of the name put in; without a brace as it is."""
    out = template
    for token, value in name_parts(name).items():
        out = F.replace(out, F.lit("{" + token + "}"), value)
    return out


def family_alias(family: Column, aliases: dict[str, str]) -> Column:
    """Letters only, lower case, and the current name of a family with an older one."""
    key = F.lower(F.regexp_replace(F.coalesce(family, F.lit("")), "[^A-Za-z]", ""))
    table = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv]) if aliases else None
    return F.coalesce(F.try_element_at(table, key), key) if table is not None else key


def quantity_to_cm(amount: Column, unit: Column) -> Column:
    """An amount of a unit in whole centimetres, halves to even; null for an unknown unit."""
    table = F.create_map(*[F.lit(x) for kv in UNIT_CM.items() for x in kv])
    return F.bround(amount.cast("double") * F.try_element_at(table, F.lower(unit))).cast("int")


def quantity_mid(value: Column) -> Column:
    """A claim's amount: the given one, else the middle of its bounds."""
    return F.coalesce(value["amount"].cast("double"), (value["lower"].cast("double") + value["upper"].cast("double")) / 2)


def strip_html(x: Column) -> Column:
    return spaced(F.regexp_replace(F.coalesce(x, F.lit("")), "<[^>]+>", " "))


def normalize_latin(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "[^a-z]+", " "))


def codes_to_int_set(raw: Column) -> Column:
    """Distinct ints of a JSON list, or of a JSON object's values; null and empty ones go."""
    listed = F.coalesce(F.from_json(raw, "array<string>"), F.map_values(F.from_json(raw, "map<string,string>")), F.array().cast("array<string>"))
    return F.array_distinct(F.transform(F.filter(listed, lambda x: F.coalesce(x, F.lit("")) != ""), lambda x: x.try_cast("int")))


def sparse_count(values: Column) -> Column:
    return F.coalesce(F.size(F.array_compact(values)), F.lit(0))


def plural_copy(n: Column, one: str, many: str) -> Column:
    """The template for n, with ``{n}`` put in."""
    return F.replace(F.when(n == 1, one).otherwise(many), F.lit("{n}"), n.cast("string"))


def mask_token(x: Column) -> Column:
    """First 8 and last 4 characters; short tokens stay."""
    return F.when(F.length(x) <= 12, x).otherwise(F.concat(F.substring(x, 1, 8), F.lit("…"), F.substring(x, -4, 4)))


def illegal_key(x: Column) -> Column:
    """Whether a name is no key: null, empty or with a character that keys may not hold."""
    return x.isNull() | (x == "") | x.rlike(ILLEGAL_KEY)


def aliased(code: Column, aliases: dict[str, str]) -> Column:
    """The code that an alias stands for; others stay."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv]), code), code)
