"""Facets, counts and provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalograph.operators.lists import own_rows

FACET_LIMIT = 20


def facet_terms(df: DataFrame, field: str, k: int = FACET_LIMIT, mincount: int = 1) -> DataFrame:
    """Most frequent values of a field with their item counts; ties by value.

    An item counts once per value. Counting combines before the shuffle, so a value found in a third
    of all items costs no more than a rare one.
    """
    multi = isinstance(df.schema[field].dataType, T.ArrayType)
    value = F.explode(F.array_distinct(field)) if multi else F.col(field)
    counts = (df.where(F.col(field).isNotNull()).select(value.alias("value")).where(F.col("value").isNotNull())
              .groupBy("value").agg(F.count("*").alias("count"))
              .where(F.col("count") >= mincount))
    return counts.orderBy(F.col("count").desc(), F.col("value").asc()).limit(k)


def facet_summary(df: DataFrame, fields, k: int = FACET_LIMIT) -> DataFrame:
    """``(facet, value, count)``: ``facet_terms`` of several fields and, as facet ``''``, the number of items, in one pass.

    Values are text. Counts combine before the shuffle, and each task cuts its part to k values a facet.
    """
    nothing = F.lit(None).cast("double")

    def entry(facet: str, value: Column, number: Column = nothing) -> Column:
        return F.struct(F.lit(facet).alias("facet"), value.cast("string").alias("value"), number.alias("number"))

    def of(field: str) -> Column:
        kind = df.schema[field].dataType
        if isinstance(kind, T.ArrayType):
            values = F.coalesce(F.array_distinct(field), F.array().cast(kind))
            return F.transform(values, lambda v: entry(field, v))
        return F.array(entry(field, F.col(field), F.col(field).cast("double") if isinstance(kind, T.NumericType) else nothing))

    entries = [F.array(entry("", F.lit(""))), *[of(field) for field in fields]]
    counts = (own_rows(df).select(F.explode(F.concat(*entries)).alias("e")).select("e.*").where("value IS NOT NULL")
              .groupBy("facet", "value", "number").agg(F.count("*").alias("count")))
    place = F.row_number().over(Window.partitionBy("facet").orderBy(F.col("count").desc(), F.col("number").asc(), F.col("value").asc()))
    return counts.withColumn("_n", place).where(F.col("_n") <= k).select("facet", "value", "count")


def num_found(df: DataFrame) -> DataFrame:
    return own_rows(df).agg(F.count("*").alias("num_found"))


def collection_stats(items: DataFrame) -> DataFrame:
    """Items in the collection; continuation rows of oversized lists do not count."""
    return own_rows(items).agg(F.count("*").alias("total_docs"))


def provenance(base: str, matched: dict[str, Column]) -> Column:
    """Base source, then every source that matched, in the given order."""
    return F.array_compact(F.array(
        F.lit(base), *[F.when(hit, F.lit(name)) for name, hit in matched.items()]))


def source_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Records loaded per source, counted in one job."""
    parts = [df.agg(F.count("*").alias("records")).select(F.lit(name).alias("source"), "records")
             for name, df in frames.items()]
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total
