"""Small helpers shared by the operators: reading tables, folds, cutting lineage, slicing Arrow data."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.session import materialize

FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Fold 0 of five by crc32 of the id's text: no label of it is ever learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows read back from a table in the shared folder."""
    return materialize(df, f"llm-{label}")


LARGE = 1000  # a class with more than this part of all rows is large: there are fewer than that


def join_classes(rows: DataFrame, classes: DataFrame, on: list[str], size: str, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of their class; ``classes`` has a row per key ``on`` with its number of rows, ``size``.

    The large classes, fewer than ``LARGE`` by their sizes, are broadcast, so the rows of a hot key stay where they are;
    the others are joined by shuffles. ``classes`` is read several times: write it first.
    """
    total = classes.agg(F.sum(size)).first()[0] or 0
    large = F.col(size) * LARGE > total
    hot = rows.join(F.broadcast(classes.where(large).withColumn("_large", F.lit(True))), on, "left")
    rest = hot.where("_large IS NULL").select(*rows.columns).join(classes.where(~large), on, how)
    return hot.where("_large").drop("_large").unionByName(rest)


def text_slices(column: pa.Array, most_bytes: int = 4_000_000) -> Iterator[list[str]]:
    """Values of a string array, null as empty, in lists of about ``most_bytes``; a longer text is alone."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for place, size in enumerate(sizes.tolist()):
        if place > start and total + size > most_bytes:
            yield [x or "" for x in column.slice(start, place - start).to_pylist()]
            start, total = place, 0
        total += size
    if start < len(column):
        yield [x or "" for x in column.slice(start).to_pylist()]


_SPACE = re.compile(r"\s")


def cut_at_space(text: str, most: int = 1 << 20) -> Iterator[str]:
    """A text in parts of about ``most`` characters that end before white space, so no word is cut."""
    start = 0
    while len(text) - start > most:
        found = _SPACE.search(text, start + most)
        if not found:
            break
        yield text[start:found.start()]
        start = found.start()
    yield text[start:] if start else text
