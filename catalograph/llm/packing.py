"""Packing by optimal length buckets.

The lengths of all documents are counted in one histogram on a fixed grid: exact up to 1024 tokens, above
that 64 steps to a doubling, so it has a few thousand bins whatever the corpus. A dynamic programme over the
bins chooses the bucket borders that minimise the padding of the whole corpus. Inside its bucket
each document gets a place, and documents of consecutive places form batches whose padded size stays
within the token budget. Places come from counts per shard of a bucket, so a bucket with most of the corpus is
spread over many tasks and only its last batch is short.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalograph.llm.tables import written

EXACT, STEPS = 1024, 64


@dataclass(frozen=True)
class PackingPlan:
    """Longest length of each bucket, ascending, and documents a batch of it."""

    lengths: tuple[int, ...]
    per_batch: tuple[int, ...]


def bin_of(length: Column) -> Column:
    """Bin of a length: itself up to ``EXACT``, then ``STEPS`` bins to a doubling."""
    fine = F.floor(F.log2(length / EXACT) * STEPS)
    return F.when(length <= EXACT, length).otherwise(EXACT + 1 + fine).cast("long")


def best_borders(longest: np.ndarray, count: np.ndarray, buckets: int) -> list[int]:
    """Last bin of each bucket, of at most ``buckets``, for the least total padded size; bins ascend by length.

    The sum of the lengths is fixed, so the least padded size is the least padding.
    """
    n = len(longest)
    before = np.concatenate(([0], np.cumsum(count, dtype=np.float64)))
    cost = longest * (before[1:] - 0.0)  # one bucket over bins 0..j
    came = []
    for _ in range(1, min(buckets, n)):
        better = np.empty(n)
        back = np.full(n, -1)
        for j in range(n):  # the last bucket is i+1..j
            options = cost[:j] + longest[j] * (before[j + 1] - before[1:j + 1])
            i = int(options.argmin()) if j else -1
            better[j], back[j] = (options[i], i) if j and options[i] < cost[j] else (cost[j], -2)
        came.append(back)
        if (back == -2).all():
            break
        cost = better
    borders, j = [n - 1], n - 1
    for back in reversed(came):
        if back[j] >= 0:
            j = int(back[j])
            borders.append(j)
    return borders[::-1]


def plan_packing(rows: DataFrame, buckets: int, budget: int) -> PackingPlan:
    """From ``n_tokens`` of every row: a histogram of bounded size goes to the driver."""
    bins = (rows.groupBy(bin_of(F.col("n_tokens")).alias("bin"))
            .agg(F.max("n_tokens").alias("longest"), F.count("*").alias("n")).toPandas().sort_values("bin"))
    if not len(bins):
        return PackingPlan((), ())
    longest = bins["longest"].to_numpy(np.float64)
    ends = best_borders(np.maximum(longest, 1), bins["n"].to_numpy(np.float64), buckets)
    lengths = tuple(int(longest[e]) for e in ends)
    return PackingPlan(lengths, tuple(max(1, budget // max(1, length)) for length in lengths))


def pack(lengths: DataFrame, buckets: int = 16, budget: int = 65_536, shard_rows: int = 50_000) -> DataFrame:
    """``(id, n_tokens, bucket_length, batch, place)`` for every row of ``lengths(id, n_tokens)``.

    ``batch`` numbers the batches of all buckets from 0, ``place`` the rows of a batch from 0. Rows of a batch
    have one ``bucket_length``; rows times that length stay within ``budget``, but for a document that is
    longer than the budget and is a batch by itself. A null length counts as 0. Repeated rows and null ids
    are packed like any other row; an empty table gives none.
    """
    rows = written(lengths.select("id", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"),
                                  F.monotonically_increasing_id().alias("row")), "lengths")
    plan = plan_packing(rows, buckets, budget)
    if not plan.lengths:
        return rows.select("id", "n_tokens", F.lit(0).cast("long").alias("bucket_length"),
                           F.lit(0).cast("long").alias("batch"), F.lit(0).alias("place"))
    bucket = sum((F.when(F.col("n_tokens") > length, 1).otherwise(0) for length in plan.lengths[:-1]), F.lit(0))
    shards = max(1, -(-rows.count() // shard_rows))
    rows = rows.select("*", bucket.alias("bucket"), F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"))
    counts = written(rows.groupBy("bucket", "shard").agg(F.count("*").alias("n")), "shards")
    totals = {r["bucket"]: r["n"] for r in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    first, known = 0, []  # a row per bucket
    for number, (length, each) in enumerate(zip(plan.lengths, plan.per_batch)):
        known.append((number, length, each, first))
        first += -(-totals.get(number, 0) // each)
    earlier = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("bucket").alias("b"), F.col("shard").alias("s"),
                            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))

    def of_bucket(column: int) -> Column:
        return F.element_at(F.array(*[F.lit(row[column]).cast("long") for row in known]), F.col("bucket") + 1)

    # a shard of a bucket has about shard_rows rows at most, by a hash of the row's number
    place = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("row")) - 1
    placed = (rows.withColumn("in_shard", place)
              .join(offsets, (F.col("bucket") == F.col("b")) & (F.col("shard") == F.col("s")))
              .withColumn("in_bucket", F.col("offset") + F.col("in_shard")))
    return placed.select("id", "n_tokens", of_bucket(1).alias("bucket_length"),
                         (of_bucket(3) + F.floor(F.col("in_bucket") / of_bucket(2)).cast("long")).alias("batch"),
                         F.pmod("in_bucket", of_bucket(2)).cast("int").alias("place"))
