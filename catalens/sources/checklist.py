"""Checklist files and region codes: pipe-separated names and distribution, and the positional region file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalens.functions.strings import given, normalize_name

NAME_COLUMNS = ("ipni_id", "taxon_rank", "taxon_status", "family", "genus", "species", "lifeform_description", "taxon_authors", "powo_id")


def read_pipes(spark: SparkSession, path: str) -> DataFrame:
    """A pipe-separated file with a header, all columns as strings; quotes are ordinary characters in it."""
    return spark.read.option("sep", "|").option("header", True).option("quote", '"').csv(path)


def checklist_names(raw: DataFrame) -> DataFrame:
    """Names of raw rows: without those that have no name; the accepted id falls back to the own; empty fields are ''.

    Of rows with one id one is kept, the largest by all columns: files carry no order once they are read in parallel.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    rows = raw.filter(F.coalesce("taxon_name", F.lit("")) != "").select(
        F.col("plant_name_id").try_cast("long").alias("name_id"), F.col("taxon_name").alias("name"), normalize_name(F.col("taxon_name")).alias("norm"),
        F.coalesce(given(F.col("accepted_plant_name_id")), F.col("plant_name_id")).try_cast("long").alias("accepted_id"), *[text(c) for c in NAME_COLUMNS],
    )
    fields = [c for c in rows.columns if c != "name_id"]
    return rows.groupBy("name_id").agg(F.max(F.struct(*fields)).alias("r")).select("name_id", "r.*")


def flag(x: Column) -> Column:
    """A flag column: null, empty, 0, false and False are false, anything else true."""
    return F.coalesce((x != "") & ~F.trim(x).isin("0", "false", "False"), F.lit(False))


def checklist_distribution(raw: DataFrame) -> DataFrame:
    """Distribution of raw rows: without those that have no whole region code or no name id."""
    l2 = F.col("region_code_l2").try_cast("int")
    rows = raw.filter(l2.isNotNull() & (F.coalesce("plant_name_id", F.lit("")) != ""))
    return rows.select(F.col("plant_name_id").try_cast("long").alias("name_id"), l2.alias("l2"), F.coalesce("area_code_l3", F.lit("")).alias("l3"), F.coalesce("area", F.lit("")).alias("area"), *[flag(F.col(c)).alias(n) for c, n in (("introduced", "introduced"), ("extinct", "extinct"), ("location_doubtful", "doubtful"))])


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """The positional file of region codes (line, level, code, name): a fixed table of some hundred lines, read whole to keep its order."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("line", "text"))
    parts = F.transform(F.split("text", ","), F.trim)
    return lines.select("line", parts.alias("p")).filter(F.size("p") >= 4).select("line", F.element_at("p", 2).alias("level"), F.element_at("p", 3).alias("code"), F.element_at("p", 4).alias("name"))


def region_hierarchy(lines: DataFrame, group: str | None = None) -> DataFrame:
    """(code, name, l2) of third-level lines: the last second-level code so far, by ``line`` (within ``group``); the last line of a code counts."""
    w = Window.partitionBy(*([group] if group else [F.lit(0)])).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumn("l2", F.last(F.when(F.col("level") == "L2", F.col("code").try_cast("int")), ignorenulls=True).over(w))
    rows = rows.filter((F.col("level") == "L3") & F.col("l2").isNotNull())
    return rows.groupBy(F.upper("code").alias("code")).agg(F.max_by(F.struct("name", "l2"), "line").alias("r")).select("code", F.substring("r.name", 1, 20).alias("name"), "r.l2")
