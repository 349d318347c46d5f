"""Catalog dumps, packets, patches, listings and index files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalens.sources.shared import listed_together


def read_whole(spark: SparkSession, path: str) -> DataFrame:
    """(file, body) of text files, each as one row."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("body"))


def json_entries(body: Column, value: str) -> Column:
    """Entries of a JSON object in its own order."""
    return F.map_entries(F.from_json(body, f"map<string,{value}>"))


def normalize_plant_list(body: Column) -> Column:
    """(id, name) of a list in any of three forms: an array, an object with ``list``, or an object of positions; in order of position, ``count`` left out."""
    array = lambda b: F.transform(F.from_json(b, "array<string>"), lambda n, i: F.struct(i.cast("long").alias("item_id"), n.alias("name")))
    keyed = F.filter(F.transform(json_entries(body, "string"), lambda e: F.struct(e["key"].try_cast("long").alias("item_id"), e["value"].alias("name"))), lambda x: x["item_id"].isNotNull())
    inner = F.get_json_object(body, "$.list")
    return F.when(body.rlike(r"^\s*\["), array(body)).when(inner.rlike(r"^\s*\["), array(inner)).otherwise(F.array_sort(keyed))


def read_translations(spark: SparkSession, path: str) -> DataFrame:
    """(lang, pos, latin, label, names) of a folder with one JSON file per language; a file's name is its language, and its order is kept."""
    rows = read_whole(spark, f"{path}/*.json").select(F.regexp_extract("file", r"([^/]+)\.json$", 1).alias("lang"), F.posexplode(json_entries(F.col("body"), "struct<label:string,names:array<string>>")).alias("pos", "e"))
    return rows.select("lang", "pos", F.col("e.key").alias("latin"), F.col("e.value.label").alias("label"), F.coalesce("e.value.names", F.array().cast("array<string>")).alias("names"))


def file_name_of(path: Column) -> Column:
    """The last part of a file's URI without its extension, percent signs decoded."""
    return F.url_decode(F.replace(F.regexp_extract(path, r"([^/]*)\.[^./]*$", 1), F.lit("+"), F.lit("%2B")))


def scan_job_packets(spark: SparkSession, path: str, schemas: dict[str, str], translation: str = "label string, names array<string>", optional: tuple[str, ...] = ()) -> DataFrame:
    """(packet, a struct for each file, translations, lacking) of a folder with a folder for each packet.

    All files come from one scan and are dealt by their folder, so a packet costs one row of a shuffle for each file and
    no join. ``schemas`` has the fields of each file by name; files below ``translations`` are a map by language, empty
    without any. ``lacking`` names the files that aren't there or aren't JSON, but for those in ``optional``.
    """
    names = ",".join([*schemas])
    with listed_together(spark):
        rows = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    file = F.col("_metadata.file_path")
    folder = lambda up: F.url_decode(F.replace(F.element_at(F.split(file, "/"), -up), F.lit("+"), F.lit("%2B")))
    rows = rows.select((folder(2) == "translations").alias("spoken"), folder(2).alias("near"), folder(3).alias("far"), file_name_of(file).alias("name"), F.when(F.try_parse_json("value").isNotNull(), F.col("value")).alias("body"))
    rows = rows.withColumn("packet", F.when(F.col("spoken"), F.col("far")).otherwise(F.col("near"))).filter(F.col("spoken") | F.col("name").isin(names.split(",")))
    body = {n: F.max(F.when(~F.col("spoken") & (F.col("name") == n), F.col("body"))).alias(n) for n in schemas}
    spoken = F.sort_array(F.collect_list(F.when(F.col("spoken") & F.col("body").isNotNull(), F.struct("name", "body"))))
    each = rows.groupBy("packet").agg(*body.values(), spoken.alias("translations"))
    lacking = F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in schemas if n not in optional])) if schemas else F.array()
    translations = F.transform_values(F.map_from_entries("translations"), lambda _, v: F.from_json(v, translation))
    return each.select("packet", *[F.from_json(n, schema).alias(n) for n, schema in schemas.items()], translations.alias("translations"), lacking.cast("array<string>").alias("lacking"))


def parse_patches(files: DataFrame, schema: str, required: list[str]) -> DataFrame:
    """(item_id, latin, the fields of ``schema``, lacking) of files (file, body) named ``{id}_{name}.json``; names have spaces for their underscores.

    ``lacking`` names the required fields that are missing or blank, and ``id`` for a file name without one; a file that
    isn't JSON lacks all.
    """
    stem = file_name_of(F.col("file"))
    rows = files.select(F.substring_index(stem, "_", 1).try_cast("long").alias("item_id"), F.replace(F.regexp_extract(stem, "^[^_]*_(.*)$", 1), F.lit("_"), F.lit(" ")).alias("latin"), F.from_json("body", schema).alias("p")).select("item_id", "latin", "p.*")
    lacks = lambda c: F.when(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == "", F.lit(c))
    return rows.withColumn("lacking", F.array_compact(F.array(F.when(F.col("item_id").isNull(), F.lit("id")), *map(lacks, required))))


def read_patches(spark: SparkSession, path: str, schema: str, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Patches of a folder (files that begin with _ are hidden): the whole ones, and those that lack a required field."""
    rows = parse_patches(read_whole(spark, f"{path}/*.json"), schema, required)
    return rows.filter(F.size("lacking") == 0).drop("lacking"), rows.filter(F.size("lacking") > 0)


def upload_list(lines: DataFrame, base: int, fields: list[str], codes: list[str]) -> DataFrame:
    """Rows of ``;``-separated lines (line, value): positional fields, those named in ``codes`` as int lists, and ids from ``base`` on in order of line."""
    parts = F.split("value", ";")
    get = lambda i, f: (F.transform(F.filter(F.split(F.coalesce(F.try_element_at(parts, F.lit(i)), F.lit("")), ","), lambda x: F.trim(x) != ""), lambda x: F.trim(x).try_cast("int")) if f in codes else F.trim(F.try_element_at(parts, F.lit(i)))).alias(f)
    rows = lines.filter(F.trim("value") != "")
    block = F.floor(F.col("line") / 1000)
    sizes = rows.groupBy(block.alias("block")).agg(F.count("*").alias("k"))
    sizes = sizes.select("block", F.coalesce(F.sum("k").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("block").orderBy("line")) - 1
    return rows.withColumn("block", block).join(sizes, "block").select((F.lit(base) + F.col("before") + within).cast("long").alias("item_id"), *[get(i, f) for i, f in enumerate(fields, 1)])


def message_copy(body: Column) -> Column:
    """Entries (lang, title, body) of a JSON map of prepared messages."""
    return F.transform(json_entries(body, "struct<title:string,body:string>"), lambda e: F.struct(e["key"].alias("lang"), e["value"]["title"].alias("title"), e["value"]["body"].alias("body")))


def media_listing(paths: DataFrame) -> DataFrame:
    """Image files of a listing (path): by extension, illustrations left out."""
    name = F.lower(F.substring_index("path", "/", -1))
    return paths.filter(name.rlike(r"\.(jpe?g|png|webp|tiff?)$") & ~name.contains("illustration"))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path) of the files below a folder, contents unread."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")


def write_index_outputs(path: str, counts: DataFrame, members: DataFrame, search: DataFrame, photo: DataFrame, web: DataFrame, labels: DataFrame) -> None:
    """All index tables below a folder; those with languages are partitioned by them."""
    for name, df in (("counts", counts), ("members", members), ("photo", photo), ("web_catalog", web)):
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    for name, df in (("search", search), ("web_labels", labels)):
        df.write.mode("overwrite").partitionBy("lang").parquet(f"{path}/{name}")
