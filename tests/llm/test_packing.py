"""Borders against every choice of borders, batches against their definition."""

import itertools
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalograph.llm import packing as P


def padded(longest, count, ends):
    start, total = 0, 0
    for end in ends:
        total += longest[end] * sum(count[start:end + 1])
        start = end + 1
    return total


def test_borders_are_optimal():
    rng = random.Random(2)
    for _ in range(150):
        n = rng.randint(1, 9)
        longest = np.array(sorted(rng.sample(range(1, 60), n)), float)
        count = np.array([rng.randint(1, 30) for _ in range(n)], float)
        buckets = rng.randint(1, 5)
        found = P.best_borders(longest, count, buckets)
        assert len(found) <= buckets and found[-1] == n - 1 and found == sorted(set(found))
        best = min(padded(longest, count, [*c, n - 1]) for k in range(min(buckets, n))
                   for c in itertools.combinations(range(n - 1), k))
        assert padded(longest, count, found) == best


def test_bins_keep_the_order(spark):
    rows = spark.range(0, 40_000).select(F.col("id"), P.bin_of(F.col("id")).alias("b")).orderBy("id").collect()
    bins = [r.b for r in rows]
    assert bins == sorted(bins) and bins[:1025] == list(range(1025))
    first = {}
    for i, b in enumerate(bins):
        first.setdefault(b, i)
    starts = sorted(first.values())
    assert all(after - start <= start / 64 + 1 for start, after in zip(starts, starts[1:]))
    assert spark.range(1).select(P.bin_of(F.lit(2**40))).first()[0] < 4000


@pytest.mark.parametrize("shard_rows", [7, 50_000])
def test_batches(spark, shard_rows):
    rng = random.Random(1)
    given = [(i, int(rng.paretovariate(0.7) * 20)) for i in range(700)]
    given += [(None, 5), (None, 5), (3, None), (4, 0), (4, 0), (9, 1_000_000)]
    frame = spark.createDataFrame(given, "id long, n_tokens long").withColumn("bucket", F.lit("clash")).repartition(5)
    got = P.pack(frame, buckets=6, budget=4096, shard_rows=shard_rows).collect()
    assert sorted(((r.id is None, r.id or 0, r.n_tokens) for r in got)) == sorted((i is None, i or 0, n or 0) for i, n in given)
    batches = defaultdict(list)
    for r in got:
        batches[r.batch].append(r)
    assert sorted(batches) == list(range(len(batches)))
    assert len({r.bucket_length for r in got}) <= 6
    full = defaultdict(list)
    for rows in batches.values():
        (length,) = {r.bucket_length for r in rows}
        assert sorted(r.place for r in rows) == list(range(len(rows)))
        assert all(r.n_tokens <= length for r in rows)
        assert len(rows) * length <= 4096 or len(rows) == 1
        full[length].append(len(rows))
    for length, sizes in full.items():  # all batches of a bucket but one are as full as the budget allows
        assert sum(s < max(1, 4096 // max(1, length)) for s in sizes) <= 1


def test_empty_and_equal(spark):
    assert P.pack(spark.createDataFrame([], "id long, n_tokens long")).collect() == []
    same = P.pack(spark.createDataFrame([(i, 10) for i in range(25)], "id long, n_tokens long"), budget=100).collect()
    assert {r.bucket_length for r in same} == {10} and {r.batch for r in same} == {0, 1, 2}
    none = P.pack(spark.createDataFrame([(1, 0), (2, 0)], "id long, n_tokens long")).collect()
    assert [(r.batch, r.n_tokens) for r in none] == [(0, 0), (0, 0)]
