"""Columnar tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, heavy: bool = False) -> DataFrame:
    """A stored Parquet table.

    ``heavy`` announces costly work per row. A table of fewer splits than cores would leave most of
    them idle, so such a small one is spread first; a large table has splits enough and is read as is.
    """
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if heavy and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df
