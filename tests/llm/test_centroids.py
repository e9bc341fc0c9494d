"""Centroid clustering against a plain version."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalograph.llm import centroids as C
from catalograph.llm.centroid_queries import op13_centroid_clustering

SF = "/root/testdata/sf0.001"


def plain(rows, k, rounds, salt="3"):
    """(id, cluster, distance, cluster_inertia, inertia, centroid) of rows (id, whole numbers), all against all."""
    seeds = sorted((hashlib.sha256(f"{salt}:{i}".encode()).hexdigest(), v) for i, v in rows if i is not None)[:k]
    centroids = [list(v) for _, v in seeds]
    if not centroids:
        return []

    def near(v):
        return min((sum((x - c) ** 2 for x, c in zip(v, centroid)), n) for n, centroid in enumerate(centroids))

    for _ in range(rounds):
        groups = [[] for _ in centroids]
        for _, v in rows:
            groups[near(v)[1]].append(v)
        centroids = [[math.floor(sum(x) / len(g)) if len(g) == 1 else sum(x) // len(g) for x in zip(*g)] if g else c
                     for g, c in zip(groups, centroids)]
    found = [(i, *near(v)[::-1]) for i, v in rows]
    inertia = [sum(d for _, n, d in found if n == c) for c in range(len(centroids))]
    return [(i, n, d, inertia[n], sum(inertia), centroids[n]) for i, n, d in found]


def key(row):
    return (row[0] is None, row[0] or 0, row[1:5])


def check(spark, rows, dim, k=4, rounds=3):
    df = spark.createDataFrame(rows, "id long, v array<long>")
    got = sorted((tuple(r) for r in C.cluster(df, dim, k, rounds).collect()), key=key)
    assert got == sorted(plain(rows, k, rounds), key=key)


def test_against_plain(spark):
    rng = np.random.default_rng(3)
    middle = rng.integers(-900, 900, (5, 6))
    rows = [(n, (middle[n % 5] + rng.integers(-200, 200, 6)).tolist()) for n in range(700)]
    check(spark, rows, 6, 5, 6)


def test_ties_repeats_and_nulls(spark):
    rng = np.random.default_rng(4)
    rows = [(n % 40, rng.integers(-1, 2, 3).tolist()) for n in range(300)] + [(None, [0, 0, 0]), (None, [5, 5, 5])]
    check(spark, rows, 3, 6, 5)
    check(spark, [(n, [7, -7]) for n in range(50)], 2, 3, 4)       # all equal: empty clusters stay
    check(spark, [(1, [4]), (2, [9])], 1, 8, 10)                   # fewer rows than clusters
    check(spark, [(None, [1, 1])], 2)


def test_a_common_vector_fills_many_blocks(spark):
    rows = [(n, [3, -3, 5]) for n in range(900)] + [(n, [n % 7, n % 11, n % 13]) for n in range(900, 1400)]
    df = spark.createDataFrame(rows, "id long, v array<long>")
    blocks = C.zone_blocks(df, 3, rows=100)
    sizes = [len(r.ids) for r in blocks.collect()]
    assert sum(sizes) == 1400 and max(sizes) <= 100
    check(spark, rows, 3, 5, 4)


def test_empty(spark):
    df = spark.createDataFrame([], "id long, v array<long>")
    assert C.cluster(df, 4).collect() == []


def test_scaled(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.0001], "x"), (2, [0.5], "x"), (3, [0.5, None], "x"), (4, [nan, 1.0], "x"), (5, [inf, 1.0], "x"),
            (6, [1.0, -inf], "x"), (7, None, "x"), (8, [], "x"), (None, [1.0, 2.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, v string")
    assert sorted((r.id or 0, r.v) for r in C.scaled(df, 2).collect()) == [(0, [1024, 2048]), (1, [512, -1])]
    big = spark.createDataFrame([(1, [2e5, 0.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="beyond"):
        C.scaled(big, 2).collect()


@pytest.mark.parametrize("dim,bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_neighbours(dim, bits):
    """Along the whole curve each cell comes once and differs from the one before by one step in one component."""
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dim, indexing="ij"), -1).reshape(-1, dim)
    keys = C.hilbert(cells, bits)
    order = sorted(range(len(cells)), key=lambda n: keys[n].tobytes())
    assert len({keys[n].tobytes() for n in order}) == len(cells)
    steps = np.abs(np.diff(cells[order], axis=0))
    assert (steps.sum(1) == 1).all()


def test_candidates_hold_the_nearest(spark):
    rng = np.random.default_rng(8)
    dropped = 0
    for _ in range(300):
        v = rng.integers(-50, 50, 4) + rng.integers(-9, 10, (20, 4))
        centroids = rng.integers(-60, 60, (6, 4))
        if rng.random() < 0.3:
            centroids[4] = centroids[1]
        left = C.candidates(v.min(0), v.max(0), centroids)
        every = np.arange(6)
        assert all((a == b).all() for a, b in zip(C.nearest(v, centroids, left), C.nearest(v, centroids, every)))
        dropped += 6 - len(left)
    assert dropped > 600


def test_query(spark):
    rows = []
    for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect():
        if r.embedding is not None and len(r.embedding) == 64 and all(x is not None and math.isfinite(x) for x in r.embedding):
            rows.append((r.vec_id, [math.floor(1024 * x) for x in r.embedding]))
    got = op13_centroid_clustering(spark, SF)
    assert dict(got.dtypes) == {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint",
                                "inertia": "bigint", "centroid_sha256": "string"}
    expected = [(*r[:5], hashlib.sha256(",".join(map(str, r[5])).encode()).hexdigest()) for r in plain(rows, 8, 10)]
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_extra_columns(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").withColumns({c: F.lit("clash") for c in ("id", "v", "cluster", "place")})
    assert C.scaled(df, 64).columns == ["id", "v"]
