"""Nearest neighbours by cosine with multiprobe p-stable hashing.

Vectors are scaled to length one, where the largest cosine is the least distance. A table hashes a vector with
``functions`` random Gaussian projections cut into steps of ``width``; all of a vector's steps are its bucket. A
query visits, in each table, the ``probes`` buckets around its own that hold its neighbours most likely: a bucket
one step up or down in some projections is the likelier the nearer the query lies to those borders. What the
tables give is merged and ranked by the exact cosine of the original vectors.

Buckets are dealt to parts of about ``part_rows`` vectors. A query goes once to each part that holds some of
its buckets, and meets only the vectors of those buckets there. A part made too large by one bucket is cut into
blocks, which all its queries visit, so no task holds more than a block. Of identical vectors only the k + 1 least ids
can be among the k nearest of anything, and identical queries are searched once. A query that found fewer than
k (few vectors, or far from all) is compared with all vectors, block by block.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalograph.llm.tables import written

_EVERY = -(1 << 62)  # in place of a bucket: all vectors of the part
_CHUNK = 256         # queries compared at a time


@dataclass(frozen=True)
class Hashing:
    tables: int = 6
    functions: int = 6
    width: float = 1.6
    probes: int = 160
    part_rows: int = 20_000
    seed: int = 11

    def __post_init__(self):
        if self.functions > 8:
            raise ValueError("up to 8 functions a table: all their perturbations are weighed")

    def projections(self, dim: int) -> tuple[np.ndarray, np.ndarray]:
        """(dim, tables * functions) directions and their shifts, the same in every task."""
        rng = np.random.default_rng((self.seed, dim))
        number = self.tables * self.functions
        return rng.standard_normal((dim, number)), rng.uniform(0, 1, number)

    def steps(self, vectors: np.ndarray) -> np.ndarray:
        """Projections in steps of ``width``, (rows, tables, functions)."""
        directions, shifts = self.projections(vectors.shape[1])
        unit = vectors / np.linalg.norm(vectors / np.abs(vectors).max(1, keepdims=True), axis=1, keepdims=True) \
            / np.abs(vectors).max(1, keepdims=True)
        return (unit @ directions / self.width + shifts).reshape(-1, self.tables, self.functions)

    def buckets(self, whole: np.ndarray) -> np.ndarray:
        """Bucket number of whole steps (..., functions); equal numbers by chance only add candidates."""
        whole = np.atleast_2d(whole)
        out = np.zeros(whole.shape[:-1], np.uint64)
        for f in range(whole.shape[-1]):
            out = out * np.uint64(0x9E3779B97F4A7C15) + whole[..., f].astype(np.int64).view(np.uint64) + np.uint64(1)
            out ^= out >> np.uint64(31)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        return (out >> np.uint64(2)).astype(np.int64)

    def visited(self, vectors: np.ndarray) -> np.ndarray:
        """Buckets of each query and table, likeliest first, (rows, tables, probes)."""
        steps = self.steps(vectors)
        whole = np.floor(steps)
        inside = steps - whole
        moves = np.array(list(itertools.product((0, -1, 1), repeat=self.functions)))
        down, up = (moves == -1).astype(float), (moves == 1).astype(float)
        # the squared distances to the borders crossed: the less, the likelier the bucket holds a neighbour
        away = inside**2 @ down.T + (1 - inside) ** 2 @ up.T
        order = np.argsort(away, axis=2, kind="stable")[:, :, :self.probes]
        return self.buckets(whole[:, :, None, :] + moves[order])


def _matrix(column: pa.Array) -> np.ndarray:
    """A list array whose lists have one length, as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _by_dim(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = pa.compute.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes):
        yield batch.filter(pa.array(sizes == dim)) if (sizes != dim).any() else batch


def _hashed(hashing: Hashing, as_query: bool):
    """Rows (id, v) to rows (tab, dim, id, v, buckets), one a table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (small for b in batches for at in range(0, b.num_rows, 1000) for small in _by_dim(b.slice(at, 1000))):
            vectors = _matrix(batch.column("v"))
            if as_query:
                found = hashing.visited(vectors)
            else:
                found = hashing.buckets(np.floor(hashing.steps(vectors)))[:, :, None]
            for tab in range(hashing.tables):
                each = found[:, tab]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(each) + 1) * each.shape[1], pa.int32()),
                                                 pa.array(np.ascontiguousarray(each).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(each), tab, np.int32)), pa.array(np.full(len(each), vectors.shape[1], np.int32)),
                     batch.column("id"), batch.column("v"), lists], ["tab", "dim", "id", "v", "buckets"])

    return run


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows, in double precision, by the same steps wherever a pair meets."""
    return (a * b).sum(-1) / (np.sqrt((a * a).sum(-1)) * np.sqrt((b * b).sum(-1)))


class _Block:
    """The vectors of one part, or of one block of it, by bucket."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, buckets: np.ndarray):
        order = np.argsort(buckets, kind="stable")
        self.ids, self.vectors, self.buckets = ids[order], vectors[order], buckets[order]
        self.unit = self.vectors / np.sqrt((self.vectors**2).sum(1, keepdims=True))

    def nearest(self, ids: np.ndarray, vectors: np.ndarray, owner: np.ndarray, buckets: np.ndarray, keep: int):
        """For queries that visit ``buckets`` (``owner`` is the query of each): up to ``keep`` rows a query."""
        lo, hi = np.searchsorted(self.buckets, buckets), np.searchsorted(self.buckets, buckets, side="right")
        every = buckets == _EVERY
        lo[every], hi[every] = 0, len(self.ids)
        some = hi > lo
        owner, lo, hi = owner[some], lo[some], hi[some]
        unit = vectors / np.sqrt((vectors**2).sum(1, keepdims=True))
        wide = 2 * keep
        best = np.full((len(ids), wide), -np.inf)
        place = np.full((len(ids), wide), -1)
        order = np.argsort(lo, kind="stable")
        cuts = np.flatnonzero(np.concatenate(([True], lo[order][1:] != lo[order][:-1], [True]))) if len(lo) else []
        for a, b in itertools.pairwise(cuts):
            rows, first, last = owner[order[a:b]], lo[order[a]], hi[order[a]]
            for start in range(first, last, 4096):
                end = min(last, start + 4096)
                score = unit[rows] @ self.unit[start:end].T
                if end - start > wide:
                    top = np.argpartition(-score, wide - 1, axis=1)[:, :wide]
                    score = np.take_along_axis(score, top, 1)
                else:
                    top = np.broadcast_to(np.arange(end - start), score.shape)
                score, top = np.concatenate((best[rows], score), 1), np.concatenate((place[rows], top + start), 1)
                kept = np.argpartition(-score, wide - 1, axis=1)[:, :wide]
                best[rows], place[rows] = np.take_along_axis(score, kept, 1), np.take_along_axis(top, kept, 1)
        query, slot = np.nonzero(place >= 0)
        found = place[query, slot]
        exact = cosines(vectors[query], self.vectors[found])
        order = np.lexsort((self.ids[found], -exact, query))
        query, found, exact = query[order], found[order], exact[order]
        starts = np.searchsorted(query, np.arange(len(ids)))
        few = np.arange(len(query)) - starts[query] < keep
        return ids[query[few]], self.ids[found[few]], exact[few]


def _search(keep: int):
    """Rows sorted by (tab, dim, part, block, kind): a block's vectors, then its queries in chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, block = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("tab", "dim", "part", "block", "kind")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
            for a, b in itertools.pairwise(cuts):
                if a == b:
                    continue
                key, kind = tuple(keys[:4, a].tolist()), int(keys[4, a])
                if key != now:
                    now, held, block = key, [], None
                ids = batch.column("id").slice(a, b - a).to_numpy(zero_copy_only=False)
                if kind == 0:
                    held.append((ids, _matrix(batch.column("v").slice(a, b - a)),
                                 batch.column("buckets").slice(a, b - a).flatten().to_numpy()))
                    continue
                if block is None:
                    if not held:
                        continue
                    block = _Block(*(np.concatenate(part) for part in zip(*held)))
                    held = []
                for start in range(a, b, _CHUNK):
                    rows = batch.slice(start, min(_CHUNK, b - start))
                    lists = rows.column("buckets")
                    owner = np.repeat(np.arange(len(lists)), pa.compute.list_value_length(lists).to_numpy())
                    found = block.nearest(rows.column("id").to_numpy(), _matrix(rows.column("v")), owner,
                                          lists.flatten().to_numpy(), keep)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["q", "id", "score"])

    return run


def valid_vector(vector: Column) -> Column:
    """Neither null nor empty nor zero, without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _top(found: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` best of each query, each candidate once."""
    once = found.groupBy("q", "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    return once.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep).drop("place")


def nearest(table: DataFrame, is_query: Column, k: int = 5, hashing: Hashing = Hashing(), id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, id, score)``: up to ``k`` rows of ``table`` for each row that ``is_query`` selects.

    Rows without an id and invalid vectors take no part. An id that occurs more than once is one row (of different
    vectors, the one with the least hash). Only vectors of one length compare. Nearest first, ties to the smaller
    id; a query with fewer than ``k`` other vectors gets all of them. Other columns of ``table`` are not read
    but by ``is_query``; an empty table gives no row.
    """
    vector = F.col(vector_col).cast("array<double>")
    rows = (table.select(F.col(id_col).cast("long").alias("id"), vector.alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
            .where(F.col("id").isNotNull() & valid_vector(F.col("v")))
            .groupBy("id").agg(F.min(F.struct(F.xxhash64("v").alias("h"), "v")).alias("r"), F.max("is_query").alias("is_query")))
    rows = written(rows.select("id", "r.h", "r.v", "is_query"), "vectors")
    same = Window.partitionBy("h", "v").orderBy("id")
    vectors = rows.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1).select("id", "v")
    asked = rows.where("is_query")
    heads = written(asked.groupBy("h", "v").agg(F.min("id").alias("q")), "queries")
    index = written(vectors.mapInArrow(_hashed(hashing, False), "tab int, dim int, id long, v array<double>, buckets array<long>"), "index")
    number = index.where("tab = 0").count()
    parts = max(1, -(-number // hashing.part_rows))
    index = index.withColumn("part", F.pmod(F.col("buckets")[0], F.lit(parts)))
    # the blocks of each part: one row a table, vector length and part
    sizes = written(index.groupBy("tab", "dim", "part").agg(F.ceil(F.count("*") / (2 * hashing.part_rows)).alias("blocks")), "blocks")
    dealt = (index.join(sizes, ["tab", "dim", "part"])
             .select("tab", "dim", "part", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"), F.lit(0).alias("kind"), "id", "v", "buckets"))
    probes = heads.select(F.col("q").alias("id"), "v").mapInArrow(
        _hashed(hashing, True), "tab int, dim int, id long, v array<double>, buckets array<long>")
    part_of = lambda b: F.pmod(b, F.lit(parts))
    probes = (probes.select("*", F.explode(F.array_distinct(F.transform("buckets", part_of))).alias("part"))
              .withColumn("buckets", F.filter("buckets", lambda b: part_of(b) == F.col("part"))))

    def searched(queries: DataFrame, among: DataFrame) -> DataFrame:
        sent = (queries.join(sizes, ["tab", "dim", "part"])
                .select("tab", "dim", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
                        F.lit(1).alias("kind"), "id", "v", "buckets"))
        keys = ("tab", "dim", "part", "block")
        return _top(among.unionByName(sent).repartition(*keys).sortWithinPartitions(*keys, "kind")
                    .mapInArrow(_search(k + 1), "q long, id long, score double"), k + 1)

    found = written(searched(probes, dealt), "found")
    # k + 1 with the query itself; what the tables did not fill is compared with all vectors of table 0
    full = found.groupBy("q").agg(F.count("*").alias("n")).where(F.col("n") > k)
    open_ = written(heads.join(full, "q", "left_anti").select(F.col("q").alias("id"), "v", F.size("v").alias("dim")), "open")
    if not open_.isEmpty():
        everywhere = (open_.join(sizes.where("tab = 0").select("dim", "part"), "dim")
                      .select(F.lit(0).alias("tab"), "dim", "part", "id", "v", F.array(F.lit(_EVERY).cast("long")).alias("buckets")))
        rest = searched(everywhere, dealt.where("tab = 0"))
        found = _top(found.unionByName(rest), k + 1)
    members = asked.select(F.col("id").alias("query_id"), "h", "v").join(heads, ["h", "v"]).select("query_id", "q")
    other = found.join(members, "q").where("id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (other.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))
