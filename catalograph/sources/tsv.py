"""Bulk tab-separated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalograph.operators.joins import join_semi
from catalograph.schema import NULL_TOKENS


def read_tsv(spark: SparkSession, path: str, schema: T.StructType, null_tokens=NULL_TOKENS,
             position: str | None = None, partitions: int | None = None, spread: bool = False) -> DataFrame:
    """Read an unquoted table with a header; any of the null tokens means null, in every column.

    Columns are read as text and cast afterwards, so that a null token is never a malformed number.
    A gzip file is one partition whatever its size: ``spread`` deals it out before further work, in as many partitions
    as its size asks for (``partitions`` fixes their number).
    ``position`` adds a load-order column that compares by file name, then by place in the file.
    """
    raw = (spark.read.option("sep", "\t").option("header", "true").option("quote", "")
           .option("escape", "").option("mode", "PERMISSIVE")
           .schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema]))
           .csv(path))

    def value(field: T.StructField):
        text = F.col(field.name)
        kept = F.when(~text.isin(list(null_tokens)), text)
        return (kept if isinstance(field.dataType, T.StringType)
                else kept.try_cast(field.dataType)).alias(field.name)

    columns = [value(f) for f in schema]
    if position:
        # File, block and row order: what comes last in a file is the last to be read, on any split.
        columns.append(F.struct(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias(
                "block"), F.monotonically_increasing_id().alias("row")).alias(position))
    typed = raw.select(*columns)
    if partitions:
        return typed.repartition(partitions)
    return typed.hint("rebalance") if spread else typed


def scan_filtered(df: DataFrame, key: str, ids: DataFrame | None = None) -> DataFrame:
    """Rows whose key is in the given set; without a set, or with an empty one, all rows."""
    if ids is None or ids.isEmpty():
        return df
    return join_semi(df, ids, key)
