"""Query of BPE encoding and decoding by tree concatenation."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.llm.byte_pairs import round_trip
from catalograph.llm.tables import table


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("packed", 256).alias("ids_sha256"),
                        F.sha2("text", 256).alias("decoded_sha256"))


QUERIES = {"op11_bpe": op11_bpe}
ORACLES: dict[str, str] = {}
