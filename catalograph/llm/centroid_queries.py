"""Query of centroid clustering, and its SQL twin: all vectors against all centroids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.llm.centroids import cluster, scaled
from catalograph.llm.tables import table


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster(scaled(table(spark, sf_dir, "embeddings"), 64), 64, k=8, rounds=10, salt="3")
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
                        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"))


def _round(n: int) -> str:
    """Nearest centroid of each vector as distance * 16 + number, and the next centroids."""
    return f"""near{n} AS MATERIALIZED (SELECT row, min(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))
      ::HUGEINT * 16 + k) AS best FROM kept, c{n} GROUP BY row),
    parts{n} AS (SELECT CAST(best % 16 AS INTEGER) AS k, i, sum(x) AS s, count(*) AS n FROM (SELECT best, unnest(v) AS x,
      generate_subscripts(v, 1) AS i FROM near{n} JOIN kept USING (row)) GROUP BY ALL),
    c{n + 1} AS MATERIALIZED (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM parts{n} GROUP BY k
      UNION ALL SELECT k, c FROM c{n} WHERE k NOT IN (SELECT k FROM parts{n}))"""


SQL = f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id,
      list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
      WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
    c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS INTEGER) AS k, v AS c FROM (
      SELECT * FROM kept WHERE vec_id IS NOT NULL ORDER BY sha256('3:' || vec_id), v LIMIT 8)),
    {', '.join(_round(n) for n in range(11))},
    found AS (SELECT vec_id, CAST(best % 16 AS INTEGER) AS cluster, CAST(best // 16 AS BIGINT) AS distance FROM near10 JOIN kept USING (row))
    SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
      CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM found JOIN c10 ON k = cluster"""

QUERIES = {"op13_centroid_clustering": op13_centroid_clustering}
ORACLES = {"op13_centroid_clustering": SQL}
