"""Query of SentencePiece encoding and decoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.llm.pieces import round_trip
from catalograph.llm.tables import table


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("text", 256).alias("decoded_sha256"))


QUERIES = {"op6_sentencepiece": op6_sentencepiece}
ORACLES: dict[str, str] = {}
