"""Centroid clustering of integer vectors over zone maps along a Hilbert curve.

Vectors are ordered along a Hilbert curve through all their components (``BITS`` bits each, about the mean) and cut
into blocks, each with the least and greatest value of every component, its box. The blocks are written once; a
round reads them, and the box decides which centroids can be nearest to anything inside: over a box the difference of the
squared distances to two centroids is linear in the vector, so its least value is taken at a corner and is exact. A
centroid that is farther than another one at every corner leaves. The vectors of a block are compared with the
centroids left only; where one is left, the block's sum counts as a whole.

All arithmetic is in 64-bit integers, so sums, distances and ties are exact in any order of the rows. Between rounds
only the k centroids pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalograph.llm.tables import written

SCALE = 1024
LARGEST = 1 << 27   # beyond it a squared distance may leave 64 bits
BITS = 3
BLOCK_ROWS = 256


# ---------------------------------------------------------------- vectors

def scaled(vectors: DataFrame, dim: int, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(id, v)`` of the vectors with ``dim`` components, none null or not finite; ``v`` is floor(scale * x) of each.

    Other rows take no part; repeated rows stay, so does a row without an id. A component beyond ``LARGEST`` after scaling
    raises: its squared distances do not fit in 64 bits.
    """
    whole = F.col(vec_col)
    usable = (F.size(whole) == dim) & F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    x = F.transform(whole, lambda x: F.floor(x.cast("double") * scale))
    fits = F.forall(whole, lambda x: F.abs(x.cast("double")) * scale < LARGEST)
    return (vectors.where(F.col(vec_col).isNotNull()).where(usable)
            .select(F.col(id_col).cast("long").alias("id"),
                    F.when(fits, x).otherwise(F.raise_error(F.lit(f"a component is beyond {LARGEST // scale}"))).alias("v")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def starting_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors whose sha256 of ``salt:id`` is smallest, in that order; all if there are fewer.

    Rows of one id follow by their components. A row without an id starts no cluster.
    """
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    chosen = vectors.where("id IS NOT NULL").select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()
    return np.array([r.v for r in chosen], np.int64)


# ---------------------------------------------------------------- the curve

def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cells (rows, dim) below 2^bits, as rows of bytes, first bits first."""
    x = cells.astype(np.uint8).T.copy()
    bit = 1 << (bits - 1)
    while bit > 1:
        low = np.uint8(bit - 1)
        for axis in range(len(x)):
            high = (x[axis] & bit) > 0
            swapped = np.where(high, 0, (x[0] ^ x[axis]) & low).astype(np.uint8)
            x[0] ^= np.where(high, low, swapped).astype(np.uint8)
            if axis:
                x[axis] ^= swapped
        bit >>= 1
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    turn = np.zeros(x.shape[1], np.uint8)
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where(x[-1] & bit, bit - 1, 0).astype(np.uint8)
        bit >>= 1
    x ^= turn
    planes = [(x >> b & 1).T for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes, 1), axis=1)


def _spread(vectors: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each component, as whole numbers; they only shape the cells of the curve."""
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, square = 0, np.zeros(dim), np.zeros(dim)
        for batch in batches:
            v = _matrix(batch.column("v"), dim).astype(float)
            count, total, square = count + len(v), total + v.sum(0), square + (v * v).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array(np.full(dim, count)), pa.array(total), pa.array(square)],
                                         ["at", "n", "total", "square"])

    sums = (vectors.select("v").mapInArrow(moments, "at long, n long, total double, square double")
            .groupBy("at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("square").alias("square")).collect())
    n, total, square = (np.array([r[c] for r in sorted(sums)], float) for c in ("n", "total", "square"))
    mean = total / np.maximum(n, 1)
    return np.rint(mean), np.maximum(1, np.rint(np.sqrt(np.maximum(0, square / np.maximum(n, 1) - mean**2))))


def _along_curve(vectors: DataFrame, dim: int, bits: int) -> DataFrame:
    mean, deviation = _spread(vectors, dim)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"), dim)
            # the cells reach two deviations to either side; what lies farther out is in the last one
            cells = np.clip(((v - mean) / deviation + 2) * (1 << bits) / 4, 0, (1 << bits) - 1)
            keys = hilbert(cells, bits)
            yield pa.RecordBatch.from_arrays([pa.array([k.tobytes() for k in keys], pa.binary()), batch.column("id"), batch.column("v")],
                                             ["place", "id", "v"])

    return vectors.mapInArrow(placed, "place binary, id long, v array<long>")


_BLOCKS = "ids array<long>, vectors binary, low binary, high binary, total binary"


def zone_blocks(vectors: DataFrame, dim: int, bits: int = BITS, rows: int = BLOCK_ROWS) -> DataFrame:
    """Written blocks of up to ``rows`` vectors along the curve: ids, vectors, box and sum, numbers packed as 64 bits.

    Equal vectors are spread by their ids, so a vector that a third of the rows hold fills many blocks and tasks.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                v = _matrix(part.column("v"), dim)
                packed = [pa.array([x.astype("<i8").tobytes()], pa.binary()) for x in (v, v.min(0), v.max(0), v.sum(0))]
                ids = part.column("id")
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *packed],
                                                 [c.split(" ")[0] for c in _BLOCKS.split(", ")])

    ordered = _along_curve(vectors, dim, bits).repartitionByRange("place", "id").sortWithinPartitions("place", "id")
    return written(ordered.select("id", "v").mapInArrow(cut, _BLOCKS), "zones")


# ---------------------------------------------------------------- nearest centroids

def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to a vector of the box, ascending; ties go to the smaller number."""
    left = np.ones(len(centroids), bool)
    # |x - a|^2 - |x - b|^2 = 2 x (b - a) + |a|^2 - |b|^2, least at the corner that the sign of b - a picks
    step = 2 * (centroids[None] - centroids[:, None])                     # [a, b] = 2 (b - a)
    norm = (centroids * centroids).sum(1)
    least = np.where(step > 0, step * low, step * high).sum(2) + norm[:, None] - norm[None]
    number = np.arange(len(centroids))
    worse = (least > 0) | ((least == 0) & (number[:, None] > number[None]))  # a is never nearest beside b
    left &= ~worse.any(1)
    return np.flatnonzero(left)


def nearest(v: np.ndarray, centroids: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest of the numbered centroids to each vector, the smaller number on ties, and the squared distance."""
    distances = np.stack([((v - centroids[n]) ** 2).sum(1) for n in numbers.tolist()], 1)
    best = distances.argmin(1)
    return numbers[best], distances[np.arange(len(v)), best]


def _unpacked(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for n in range(batch.num_rows):
        arrays = [np.frombuffer(batch.column(c)[n].as_buffer(), "<i8") for c in ("vectors", "low", "high", "total")]
        yield batch.column("ids")[n].values, arrays[0].reshape(-1, dim), *arrays[1:]


def _totals(blocks: DataFrame, centroids: np.ndarray) -> list:
    """Per centroid the number and the componentwise sum of its vectors, as (cluster, n, total) rows."""
    k, dim = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            for _, v, low, high, total in _unpacked(batch, dim):
                left = candidates(low, high, centroids)
                if len(left) == 1:
                    counts[left[0]] += len(v)
                    totals[left[0]] += total
                    continue
                cluster, _ = nearest(v, centroids, left)
                for n in left.tolist():
                    own = cluster == n
                    counts[n] += own.sum()
                    totals[n] += v[own].sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(k), dim)), pa.array(np.tile(np.arange(dim), k)),
                                          pa.array(np.repeat(counts, dim)), pa.array(totals.ravel())], ["cluster", "at", "n", "total"])

    return (blocks.mapInArrow(sums, "cluster long, at long, n long, total long")
            .groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect())


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: floor(sum / count) of each component; one without vectors stays."""
    out = centroids.copy()
    for r in _totals(blocks, centroids):
        if r.n:
            out[r.cluster, r.at] = r.total // r.n
    return out


def assigned(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(id, cluster, distance)`` of every vector."""
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, v, low, high, _ in _unpacked(batch, dim):
                cluster, distance = nearest(v, centroids, candidates(low, high, centroids))
                yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"])

    return blocks.mapInArrow(run, "id long, cluster int, distance long")


def cluster(vectors: DataFrame, dim: int, k: int = 8, rounds: int = 10, salt: str = "3") -> DataFrame:
    """``(id, cluster, distance, cluster_inertia, inertia, centroid)`` of every row of ``vectors(id, v)``.

    ``v`` holds ``dim`` whole numbers (see ``scaled``). ``centroid`` is the final one, an array of long. Fewer than k rows with
    an id give as many clusters; no rows, or none with an id, give no rows. Repeated rows count each time.
    """
    empty = "id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
    spark = vectors.sparkSession
    centroids = starting_centroids(vectors, k, salt)
    if not len(centroids):
        return spark.createDataFrame([], empty)
    blocks = zone_blocks(vectors, dim)
    for _ in range(rounds):
        centroids = moved(blocks, centroids)
    rows = written(assigned(blocks, centroids), "clustered")
    inertia = {r.cluster: r.s for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    known = spark.createDataFrame([(n, s, sum(inertia.values()), centroids[n].tolist()) for n, s in inertia.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return rows.join(F.broadcast(known), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
