"""The stored collection: full refresh, upsert, and incremental loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.operators.joins import require_unique
from catalograph.operators.ordering import dedup_last_wins, first_per_group, first_rows
from catalograph.operators.sets import union_append, unseen


def full_refresh(df: DataFrame, path: str) -> DataFrame:
    """Replace the whole stored collection, then return it as stored."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def upsert(base: DataFrame, delta: DataFrame, key: str = "id", pos: str | None = None) -> DataFrame:
    """Stored records with those of the delta added or replaced; the delta's last record by ``pos`` wins.

    Without ``pos`` the delta has no last record, so a key that it repeats is refused.
    """
    if pos:
        latest = dedup_last_wins(delta, key, pos).drop(pos)
    else:
        require_unique(delta, key, "delta")
        latest = delta
    return union_append(unseen(base, latest, key), latest)


def limited(df: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """The first ``limit`` records in order; 0 means all."""
    return first_rows(df, order, limit) if limit > 0 else df


def new_only(candidates: DataFrame, existing: DataFrame, key: str, pos: str,
             limit: int = 0) -> DataFrame:
    """Candidates not stored yet, in input order."""
    known = existing.where(F.col(key).isNotNull())
    return limited(unseen(candidates, known, key), [F.col(pos).asc()], limit)


def append_unseen(existing: DataFrame, batch: DataFrame, key: str, order: str,
                  limit: int = 0) -> DataFrame:
    """Stored records plus the new ones; within the batch the first of a key wins."""
    fresh = first_per_group(unseen(batch, existing, key), key, order)
    return union_append(existing, limited(fresh, [F.col(order).asc()], limit))
