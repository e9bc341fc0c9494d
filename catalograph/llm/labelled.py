"""A bounded sample of labelled documents, for the classifiers that are fitted on the driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.llm.tables import held_out


def known_labels(labels: DataFrame, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """``(i, y)``: the largest 0/1 label of each id outside the held-out fold."""
    return (labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y"))
            .where(F.col("i").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("i")))
            .groupBy("i").agg(F.max("y").alias("y")))


def share_of_ones(labels: DataFrame, label_col: str, id_col: str = "doc_id") -> float | None:
    """Share of label 1 among all ``known_labels``, None without any."""
    return known_labels(labels, label_col, id_col).agg(F.avg("y")).first()[0]


def _chosen(docs: DataFrame, labels: DataFrame, label_col: str, ones: int, zeros: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Ids ``(i, y)`` of the sample, chosen from ids alone by their hash, and all texts ``(i, t)``."""
    known = known_labels(labels, label_col, id_col)
    order = (F.xxhash64("i"), F.col("i"))
    ids = (known.where("y = 1").orderBy(*order).limit(ones)
           .unionByName(known.where("y = 0").orderBy(*order).limit(zeros)))
    return ids, docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where(F.col("t").isNotNull())


def training_values(docs: DataFrame, labels: DataFrame, label_col: str, ones: int, zeros: int,
                    value: Callable[[Column], Column], id_col: str = "doc_id", text_col: str = "text") -> tuple[list, list[int]]:
    """``value`` of the text and 0/1 label of up to ``ones`` and ``zeros`` labelled rows outside the held-out fold.

    The sample is chosen from ids alone by their hash, then only its texts are read, of any length. Rows without
    id, text or label do not take part; an id labelled more than once has its largest label, repeated documents
    count once.
    """
    ids, texts = _chosen(docs, labels, label_col, ones, zeros, id_col, text_col)
    # at most ones + zeros ids of 12 bytes are broadcast
    found = texts.join(F.broadcast(ids), "i").select("i", "y", value(F.col("t")).alias("v"))
    rows = found.groupBy("i").agg(F.min("v").alias("v"), F.max("y").alias("y")).toPandas().sort_values("i")
    return rows["v"].tolist(), rows["y"].tolist()


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, ones: int, zeros: int, most_chars: int,
                  id_col: str = "doc_id", text_col: str = "text") -> tuple[list[str], list[int]]:
    """Whole texts and 0/1 labels of up to ``ones`` and ``zeros`` labelled rows outside the held-out fold.

    As ``training_values``, and of each label rows are taken only until their texts have half of ``most_chars``
    characters together: a bound on rows, as a text is taken whole or not, whatever its own length up to that half.
    """
    ids, texts = _chosen(docs, labels, label_col, ones, zeros, id_col, text_col)
    sized = (texts.join(F.broadcast(ids), "i").groupBy("i").agg(F.max(F.length("t")).alias("n"), F.max("y").alias("y"),
                                                                F.min(F.xxhash64("i")).alias("h")).collect())
    taken, held = [], [0, 0]
    for row in sorted(sized, key=lambda r: (r["h"], r["i"])):
        if held[row["y"]] + row["n"] <= most_chars // 2:
            held[row["y"]] += row["n"]
            taken.append((row["i"], row["y"]))
    if not taken:
        return [], []
    kept = docs.sparkSession.createDataFrame(taken, ids.schema)
    found = texts.join(F.broadcast(kept), "i").groupBy("i").agg(F.min("t").alias("t"), F.max("y").alias("y"))
    rows = found.toPandas().sort_values("i")
    return rows["t"].tolist(), rows["y"].tolist()
