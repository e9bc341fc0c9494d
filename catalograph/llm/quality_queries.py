"""Query of the quality operator: sources are the hosts, languages their paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.llm.quality import fit, score_quality
from catalograph.llm.tables import held_out, table


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    classifier = fit(docs, table(spark, sf_dir, "labels"), "quality")
    return score_quality(docs, classifier).select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "evidence", "host_share", "path_share",
        "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


QUERIES = {"op10_quality_classifier": op10_quality_classifier}
ORACLES: dict[str, str] = {}
