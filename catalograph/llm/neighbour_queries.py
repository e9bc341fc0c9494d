"""Query of the nearest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.llm.neighbours import nearest
from catalograph.llm.tables import table


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


QUERIES = {"op7_nearest_neighbours": op7_nearest_neighbours}
ORACLES: dict[str, str] = {}
