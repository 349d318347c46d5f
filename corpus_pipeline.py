"""A corpus from raw documents: language, toxicity, near copies, repeated passages, packed sequences.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalens.llm import near_copies, packing, ppm, substrings, toxicity
from catalens.llm.common import shared_path, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text that the best language codes in more bits a byte is in none of them: random bytes take 8.
GIBBERISH = 7.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned; those without letters, and those that no language explains, go."""
    found = ppm.identify(docs, ppm.fit(docs))
    return found.filter((F.col("lang_pred") != ppm.UNDETERMINED) & (F.col("bits_per_byte") <= GIBBERISH)).select(*COLUMNS)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.filter("predicted = 0").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies (five-word shingles, similarity 0.8 or more); rows that repeat its id stay with it, those without an id if a group has none."""
    groups = near_copies.near_copies(docs)
    kept = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi").select(*COLUMNS)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; n_chars follows, and documents left empty go."""
    done = substrings.dedupe(docs).withColumn("n_chars", F.length("text").cast("long"))
    return done.filter("text <> ''").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    return packing.op3_packing(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("toxicity", toxicity_filter), ("near_dedup", near_dedup), ("passage_dedup", passage_dedup), ("packing", pack)]

#: SQL cannot express the stages; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what all stages keep; each stage's result is a table in the shared folder.

    Rows with null ids or texts, repeated rows and columns of other names are treated as the stages' operators say; an
    empty ``documents`` gives an empty result.
    """
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        path = shared_path(spark, name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
