"""Query of the packing operator: lengths are word-piece tokens of the whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.llm.packing import pack
from catalograph.llm.tables import table
from catalograph.llm.token_count_queries import vocabulary
from catalograph.llm.token_counts import token_counts


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(table(spark, sf_dir, "documents"), vocabulary())
    return pack(counted).select(F.col("id").alias("doc_id"), "n_tokens", "bucket_length", "batch", "place")


QUERIES = {"op8_packing": op8_packing}
ORACLES: dict[str, str] = {}
