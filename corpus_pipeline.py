"""From ``documents`` to packed training batches: toxicity, quality, near duplicates, PII, packing.

``STAGES`` are (name, function) pairs. A function takes (spark, docs, sf_dir) and works on all rows its
predecessor kept; all but the last return the columns of ``docs``. Each result is written to the shared
folder and read again as the next stage's ``docs``, so a lost executor repeats one stage at most.

Cases, in every stage: nulls in any column stay as they are; texts are read whole, whatever their length; repeated rows
are rows of their own up to the third stage, which keeps one of them; an empty table gives an empty one with the same columns; further
columns are kept by all but the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.llm import near_duplicates, packing, pii, quality, toxicity
from catalograph.llm.pii_queries import TRIAL_KEY
from catalograph.llm.tables import table, written
from catalograph.llm.token_count_queries import vocabulary
from catalograph.llm.token_counts import token_counts


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network does not call toxic.

    A null or empty text, or one without a letter or digit, has the low score of a text without evidence and stays. Repeated
    rows stay or go together. Without labels of both kinds the base rate alone decides.
    """
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of sufficient quality, by text, source and language of the source.

    A null text counts as empty and is judged by its site; a null source or language is a site of its own. Repeated rows
    stay or go together; ties of the score at the threshold stay.
    """
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels"), "quality"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id.

    Null and empty texts have one fingerprint and are one group. Rows without an id come last, ties of the id go to the
    smaller hash of the text, and of rows equal in id and text one stays.
    """
    return near_duplicates.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data.

    A null text stays null, an empty one empty. Equal values have equal pseudonyms in all documents; of overlapping values
    the one that starts first counts.
    """
    return pii.with_pseudonyms(docs, TRIAL_KEY)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, bucket_length, batch, place)`` of all documents.

    A null or empty text has 0 tokens and is packed like any other; a text longer than a batch's budget is a batch of
    its own. Rows of a bucket are dealt to its batches by a hash of their place in the table.
    """
    return packing.pack(token_counts(docs, vocabulary())).select(
        F.col("id").alias("doc_id"), "n_tokens", "bucket_length", "batch", "place")


STAGES = [("toxicity", toxicity_stage), ("quality", quality_stage), ("near_duplicates", near_duplicate_stage),
          ("pii", pii_stage), ("packing", packing_stage)]

ORACLE_SQL = None  # a trained network, fingerprint groups and keyed permutations have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches of all documents of ``sf_dir`` that the stages kept, one row per document; see ``packing_stage``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
