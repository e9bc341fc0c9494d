"""Multiprobe hashing against all pairs: recall, exact scores, ties, odd vectors."""

import itertools
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalograph.llm import neighbours as A

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k=5):
    """{query: [(id, score)]} by all pairs."""
    valid = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            valid[i] = np.array(v, np.float32).astype(float)
    out = {}
    for q, a in valid.items():
        if q % 50 == 0:
            scored = [(-float(A.cosines(a, b)), i) for i, b in valid.items() if i != q and len(a) == len(b)]
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def collected(frame, **kw):
    out = defaultdict(list)
    for r in A.nearest(frame, F.col("vec_id") % 50 == 0, **kw).orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.id, r.score))
        assert r.rank == len(out[r.query_id])
    return dict(out)


def recall(found, expected):
    hits = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in e}) for q, e in expected.items())
    return hits / sum(map(len, expected.values()))


def test_visits_are_ordered_and_begin_at_home():
    h = A.Hashing()
    v = np.random.default_rng(0).standard_normal((5, 16))
    seen = h.visited(v)
    assert (seen[:, :, 0] == h.buckets(np.floor(h.steps(v)))).all()
    steps = h.steps(v)
    for row, tab in itertools.product(range(5), range(h.tables)):
        assert len(set(seen[row, tab].tolist())) == h.probes
        inside = steps[row, tab] - np.floor(steps[row, tab])
        scores = {}
        for move in itertools.product((-1, 0, 1), repeat=h.functions):
            cost = sum(x * x if m < 0 else (1 - x) ** 2 if m > 0 else 0 for x, m in zip(inside, move))
            scores[int(h.buckets(np.floor(steps[row, tab]) + np.array(move))[0])] = cost
        costs = [scores[b] for b in seen[row, tab].tolist()]
        assert costs == pytest.approx(sorted(scores.values())[:h.probes])


@pytest.mark.parametrize("part_rows", [40, 20_000])
def test_recall_and_exact_scores(spark, part_rows):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((40, 24))
    rows = [(i, (centres[i % 40] + rng.standard_normal(24) * 0.6).astype(np.float32).tolist()) for i in range(1500)]
    found = collected(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA), hashing=A.Hashing(part_rows=part_rows))
    expected = plain(rows)
    assert recall(found, expected) >= 0.95
    vectors = {i: np.array(v, float) for i, v in rows}
    for q, given in found.items():
        assert all(s == A.cosines(vectors[q], vectors[i]) for i, s in given)
        assert given == sorted(given, key=lambda p: (-p[1], p[0]))


def test_given_tables(spark):
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        frame = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
        rows = [(r.vec_id, r.embedding) for r in frame.collect()]
        assert recall(collected(frame), plain(rows)) >= 0.95


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(4).astype(np.float32).tolist()) for i in range(1, 49)]
    rows += [(0, [1.0, 0, 0, 0]), (50, [0.0, 0, 0, 0]), (100, None), (150, []), (200, [1.0, None, 0, 0]), (250, [nan, 1, 1, 1]),
             (300, [inf, 1, 1, 1]), (None, [1.0, 2, 3, 4]), (350, [1.0, 2.0]), (351, [2.0, 1.0]), (400, [3.0]),
             (450, [1e-30, 2e-30, 1e-30, 0]), (500, [3e30, 1e30, 2e30, 0])]
    rows += [(i, [0.5, 0.25, -1.0, 2.0]) for i in range(600, 900)]  # copies, six of them queries
    rows = [(i, v and [None if x is None else float(x) for x in v]) for i, v in rows]
    frame = spark.createDataFrame([(*r, 0) for r in [*rows, rows[3], rows[-1]]], SCHEMA)
    for name in ("q", "id", "h", "v", "score", "rank", "part"):
        frame = frame.withColumn(name, F.lit("clash"))
    found, expected = collected(frame), plain(rows)
    assert set(found) == {q for q, e in expected.items() if e}
    for q in (600, 650, 850):
        assert [i for i, _ in found[q]] == [i for i in range(600, 607) if i != q][:5]
    assert found[350] == expected[350] and 400 not in found
    assert recall(found, expected) >= 0.95


def test_few_vectors_get_all(spark):
    rows = [(0, [1.0, 0.0]), (1, [-1.0, 0.1]), (2, [0.0, -1.0])]
    found = collected(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA))
    assert found == plain(rows) and len(found[0]) == 2
    assert collected(spark.createDataFrame([], SCHEMA)) == {}
    assert collected(spark.createDataFrame([(0, [1.0], 0)], SCHEMA)) == {}
