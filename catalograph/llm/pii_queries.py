"""Query of the pseudonyms. The key here is for trials; a real one comes from where secrets are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.llm.pii import pseudonymised
from catalograph.llm.tables import table

TRIAL_KEY = b"trial key, not a secret"


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pseudonymised(table(spark, sf_dir, "documents"), TRIAL_KEY)
    return found.select(F.col("id").alias("doc_id"), "text", "replaced")


QUERIES = {"op5_pii": op5_pii}
ORACLES: dict[str, str] = {}
