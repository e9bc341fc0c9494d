"""Query of the conversation prefix trie, and its SQL twin: nodes as lists of turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.llm.conversation_trie import borrowed_heads, ordered_turns, prefix_trie
from catalograph.llm.tables import table


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = ordered_turns(table(spark, sf_dir, "conversations"))
    trie = prefix_trie(turns.where("place = 0").select("conv"), borrowed_heads(turns))
    return trie.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs",
                       "n_children", "n_leaves", "saved_tokens", "ends_sha256")


# crc32 bit by bit, the lowest of a byte first
_CRC = """list_reduce([4294967295] || flatten(list_transform(string_split(cast(conv_id AS VARCHAR), ''), lambda d:
      list_transform(range(8), lambda i: (ascii(d) >> i) & 1))), lambda a, bit: xor(a >> 1, CASE WHEN xor(a & 1, bit) = 1 THEN 3988292384 ELSE 0 END))"""

SQL = rf"""WITH own AS MATERIALIZED (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns,
      CAST(xor({_CRC}, 4294967295) % 4 AS BIGINT) AS h FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    rebuilt AS MATERIALIZED (SELECT o.conv_id, coalesce(b.turns[1:o.h], []) || o.turns[o.h + 1:] AS turns
      FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
    members AS (SELECT conv_id, turns[1:d] AS node, d AS depth, len(turns) = d AS ends
      FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM rebuilt)),
    nodes AS MATERIALIZED (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(CASE WHEN ends THEN cast(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ids,
        (count(*) - 1) * coalesce(len(regexp_extract_all(node[depth].t, '[^ 	-]+')), 0) AS saved
      FROM members GROUP BY node, depth),
    below AS (SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
    valued AS (SELECT n.*, coalesce(b.n, 0) AS n_children FROM nodes n LEFT JOIN below b USING (node)),
    sums AS (SELECT node[1:d] AS node, CAST(count_if(n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
      FROM (SELECT node, n_children, saved, unnest(range(depth + 1)) AS d FROM valued) GROUP BY ALL)
    SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, sha256(v.ids) AS ends_sha256
    FROM valued v JOIN sums USING (node) LEFT JOIN nodes p ON v.depth > 0 AND p.node = v.node[1:v.depth - 1]"""

QUERIES = {"op12_conversation_trie": op12_conversation_trie}
ORACLES = {"op12_conversation_trie": SQL}
