"""Query of the toxicity operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.llm.tables import held_out, table
from catalograph.llm.toxicity import fit, score_toxicity


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = fit(docs, table(spark, sf_dir, "labels"), "toxic")
    return score_toxicity(docs, net).select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score", "predicted")


QUERIES = {"op1_toxicity": op1_toxicity}
ORACLES: dict[str, str] = {}
