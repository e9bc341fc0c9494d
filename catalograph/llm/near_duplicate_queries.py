"""Query of the SimHash near-duplicate operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.llm.near_duplicates import near_duplicates
from catalograph.llm.tables import table


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"),
                        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op4_simhash_near_dedup": op4_simhash_near_dedup}
ORACLES: dict[str, str] = {}
