"""Query of the document fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.llm.fingerprints import EDITED, compare_edited, hex_of, with_near
from catalograph.llm.tables import table, written


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_near(written(compare_edited(table(spark, sf_dir, "documents")), "compared"), EDITED)
    return rows.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", hex_of(F.col("high"), F.col("low")).alias("fingerprint"),
                       hex_of(F.col("edited_high"), F.col("edited_low")).alias("edited_fingerprint"), "near_edited", "near_next", "n_near")


QUERIES = {"op9_fingerprints": op9_fingerprints}
ORACLES: dict[str, str] = {}
