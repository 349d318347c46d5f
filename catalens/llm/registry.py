"""One query for each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from catalens.llm.byte_bpe import op6_byte_bpe
from catalens.llm.centroids import ORACLE as CENTROIDS_SQL
from catalens.llm.centroids import op12_centroids
from catalens.llm.common import table
from catalens.llm.packing import op3_packing
from catalens.llm.ppm import op1_language
from catalens.llm.secrets import ORACLE as SECRETS_SQL
from catalens.llm.secrets import op13_secrets
from catalens.llm.simhash import op7_simhash
from catalens.llm.spelling import op11_spelling
from catalens.llm.substrings import op5_substrings
from catalens.llm.toxicity import op2_toxicity
from catalens.llm.vectors import op4_near_vectors, op8_neighbours
from catalens.llm.warc import ORACLE, op10_revisits
from catalens.llm.wavelet import op9_wavelet

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    documents = lambda f, *a: lambda spark, d: f(table(spark, d, "documents"), *a)
    embeddings = lambda f: lambda spark, d: f(table(spark, d, "embeddings"))
    return {
        "op1_language": documents(op1_language),
        "op2_toxicity": lambda spark, d: op2_toxicity(table(spark, d, "documents"), table(spark, d, "labels")),
        "op3_packing": documents(op3_packing, public_tokenizers.path("word_bpe_49k.json")),
        "op4_near_vectors": embeddings(op4_near_vectors),
        "op5_substrings": documents(op5_substrings),
        "op6_byte_bpe": documents(op6_byte_bpe, public_tokenizers.path("byte_bpe_multi_50k.tiktoken")),
        "op7_simhash": documents(op7_simhash),
        "op8_neighbours": embeddings(op8_neighbours),
        "op9_wavelet": documents(op9_wavelet, public_tokenizers.path("byte_bpe_50k.json")),
        "op10_revisits": lambda spark, d: op10_revisits(table(spark, d, "pages")),
        "op11_spelling": documents(op11_spelling),
        "op12_centroids": embeddings(op12_centroids),
        "op13_secrets": documents(op13_secrets),
    }


def oracle_sql() -> dict[str, str]:
    return {"op10_revisits": ORACLE, "op12_centroids": CENTROIDS_SQL, "op13_secrets": SECRETS_SQL}
