"""Query of the web archives, and its SQL twin: what the archives must hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catalograph.llm.tables import table
from catalograph.llm.warc import read_archives, write_archives


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(table(spark, sf_dir, "pages"))
    return read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH hashed AS (
    SELECT page_id, coalesce(html, '') AS payload, CAST(unhex(sha1(coalesce(html, ''))) AS BIT)::VARCHAR AS bits FROM pages),
firsts AS (SELECT payload, min(page_id) AS first FROM hashed GROUP BY payload)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
    list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST(16 * CAST(substr(bits, CAST(5 * i + 1 AS INT), 1) AS INT) + 8 * CAST(substr(bits, CAST(5 * i + 2 AS INT), 1) AS INT)
        + 4 * CAST(substr(bits, CAST(5 * i + 3 AS INT), 1) AS INT) + 2 * CAST(substr(bits, CAST(5 * i + 4 AS INT), 1) AS INT)
        + CAST(substr(bits, CAST(5 * i + 5 AS INT), 1) AS INT) + 1 AS INT), 1)), 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM hashed JOIN firsts USING (payload)
"""

QUERIES = {"op2_warc": op2_warc}
ORACLES = {"op2_warc": SQL}
