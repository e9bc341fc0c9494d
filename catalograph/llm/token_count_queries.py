"""Query of the token counts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.llm.tables import table
from catalograph.llm.token_counts import read_vocabulary, token_counts


def vocabulary() -> tuple[str, ...]:
    return read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(table(spark, sf_dir, "documents"), vocabulary())
    return counted.select(F.col("id").alias("doc_id"), "n_tokens")


QUERIES = {"op3_token_counts": op3_token_counts}
ORACLES: dict[str, str] = {}
