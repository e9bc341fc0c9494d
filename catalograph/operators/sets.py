"""Set operations on keyed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_append(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new, allowMissingColumns=True)


def unseen(candidates: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Candidates whose key is not known.

    Known keys are made distinct first: a key stored very often shrinks to one row per task before
    the shuffle, and the join then uses the same partitioning.
    """
    return candidates.join(known.select(key).distinct(), key, "left_anti")


def ordered_distinct(xs: Column | str) -> Column:
    """Array without duplicates, first occurrences kept in order."""
    return F.array_distinct(xs)


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(name).distinct()
