"""The inverted index: ordinary tables derived from the items.

Items and postings are bucketed by item id with the same bucket count. Everything that is scored,
filtered or counted per item is then computed inside the bucket, so a search moves only its page.
Within a bucket postings are sorted by field and term, so Parquet statistics skip the row groups
without the wanted terms. A common term is spread over all buckets like the items that hold it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalograph.retrieval.analysis import (CATCH_ALL, CATCH_ALL_FIELD, EVERY_FIELD, KEYWORD_FIELDS, TEXT_FIELDS,
                                            Profile, positioned)
from catalograph.operators.lists import list_columns, own_rows, whole_lists
from catalograph.session import scratch_path

# Positions of continuation rows start at multiples of this.
PART_SPAN = 2 ** 31
# Text of a bucket: its postings, about ten times as large as sorted rows, then fit the memory of one task.
BUCKET_BYTES = 16 << 20


@dataclass(frozen=True)
class FieldStats:
    items: int          # items with at least one term in the field
    terms: int          # terms of all items in the field

    @property
    def average(self) -> float:
        return self.terms / self.items


@dataclass(frozen=True)
class Index:
    spark: SparkSession
    profile: Profile
    items_table: str
    postings_table: str
    terms_path: str
    fields: dict[str, FieldStats]
    total: int
    has_parts: bool
    path: str = ""
    buckets: int = 0
    generation: int = 0

    @property
    def items(self) -> DataFrame:
        return self.spark.table(self.items_table)

    @property
    def postings(self) -> DataFrame:
        return self.spark.table(self.postings_table)

    @property
    def term_stats(self) -> DataFrame:
        return self.spark.read.schema("field string, term string, df bigint").parquet(
            self.terms_path)

    def close(self) -> None:
        """Take the index's table names out of the session; its files stay and can be opened again."""
        for table in (self.items_table, self.postings_table):
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")

    def frequencies(self, columns=("id", "field", "term", "tf", "dl")) -> DataFrame:
        """Postings as one row per item, field and term, whatever the item's number of parts."""
        rows = self.postings
        if not self.has_parts:
            return rows.select(*columns)
        return rows.groupBy("id", "field", "term").agg(
            F.sum("tf").alias("tf"), F.max("dl").alias("dl")).select(*columns)


def _values(items: DataFrame, name: str) -> Column | None:
    """Field as an array of its values."""
    if name not in items.columns:
        return None
    column = F.col(name)
    if not isinstance(items.schema[name].dataType, T.ArrayType):
        column = F.array(column)
    return F.array_compact(F.coalesce(column.cast("array<string>"), F.array().cast("array<string>")))


def _termed(items: DataFrame, profile: Profile) -> tuple[DataFrame, list[str]]:
    """Rows ``(id, part, _field, ...)`` with one array of terms for each indexed field, null where a word was removed, and
    the fields' names. The index in an array is the term's place."""
    arrays = {}
    for name in TEXT_FIELDS:
        values = _values(items, name)
        if values is not None:
            arrays[name] = positioned(values, profile, name)
    if profile.catch_all:
        every = [v for v in (_values(items, name) for name in CATCH_ALL) if v is not None]
        arrays[CATCH_ALL_FIELD] = positioned(F.concat(*every), profile, CATCH_ALL_FIELD)
    again = {}
    if profile.every_field:
        # a row that continues a list repeats the id, which is the item's own row's to hold
        first = F.col("part") == 0 if "part" in items.columns else F.lit(True)
        none = F.array().cast("array<string>")
        again = {name: positioned(F.when(first | F.lit(name != "id"), _values(items, name)).otherwise(none), profile, EVERY_FIELD)
                 for name in items.columns if name != "part" and not (
                     name in TEXT_FIELDS and profile.stems(name) == profile.stems(EVERY_FIELD))}
    for name in KEYWORD_FIELDS:
        values = _values(items, name)
        if values is not None:
            arrays[name] = F.array_distinct(values)
    part = F.col("part") if "part" in items.columns else F.lit(0)
    rows = items.select("id", part.alias("part"), *[terms.alias(f"_{name}") for name, terms in arrays.items()],
                        *[terms.alias(f"_again_{name}") for name, terms in again.items()])
    if profile.every_field:
        # Fields that are analysed alike on their own are not analysed again.
        every = [f"_again_{name}" if name in again else f"_{name}" for name in items.columns if name != "part"]
        rows = rows.withColumn(f"_{EVERY_FIELD}", F.concat(*every)).drop(*[f"_again_{name}" for name in again])
        arrays[EVERY_FIELD] = rows[f"_{EVERY_FIELD}"]
    return rows, list(arrays)


def token_rows(items: DataFrame, profile: Profile) -> DataFrame:
    """(id, part, field, term, pos) of every indexed field, row by row without a shuffle."""
    def named(name: str) -> Column:
        start = F.col("part").cast("bigint") * PART_SPAN
        placed = F.transform(f"_{name}", lambda t, i: F.struct(F.lit(name).alias("field"), t.alias("term"), (i + start).alias("pos")))
        return F.filter(placed, lambda e: e["term"].isNotNull())

    rows, names = _termed(items, profile)
    return rows.select("id", "part", F.inline(F.concat(*[named(name) for name in names])))


def _postings_of(names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Postings of a batch of items, one field after the other, each sorted by term.

    A field has the term arrays of the rows that share an id and part, one as a rule, and its length.
    """
    names = sorted(names)
    span = PART_SPAN

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in names:
                arrays = batch.column(f"_{name}")
                of_row = pc.list_value_length(arrays).to_numpy(zero_copy_only=False)
                arrays = arrays.flatten()
                size = pc.list_value_length(arrays).to_numpy(zero_copy_only=False)
                words = arrays.flatten()
                kept = words.is_valid().to_numpy(zero_copy_only=False)
                row = np.repeat(np.repeat(np.arange(len(of_row)), of_row), size)[kept]
                place = (np.arange(len(words)) - np.repeat(np.cumsum(size) - size, size))[kept]
                if not len(row):
                    continue
                coded = words.drop_null().dictionary_encode()
                order = pc.sort_indices(coded.dictionary)
                terms = coded.dictionary.take(order)
                rank = np.empty(len(order), np.int64)
                rank[order.to_numpy()] = np.arange(len(order))
                rank = rank[coded.indices.to_numpy()]
                # Words come by row and place, but for those of several rows of the same id and part.
                by = np.argsort(rank, kind="stable") if of_row.max() < 2 else np.lexsort((place, row, rank))
                rank, row, place = rank[by], row[by], place[by]
                begins = np.flatnonzero(np.concatenate([[True], (rank[1:] != rank[:-1]) | (row[1:] != row[:-1])]))
                borders = np.append(begins, len(row))
                own, part = pa.array(row[begins]), batch.column("part").to_numpy().astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(own), batch.column("part").take(own), pa.repeat(name, len(own)), terms.take(pa.array(rank[begins])),
                     pa.array(np.diff(borders)), batch.column(f"_{name}_dl").take(own),
                     pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(place + part[row] * span))],
                    names=["id", "part", "field", "term", "tf", "dl", "positions"])

    return postings


def build_postings(items: DataFrame, profile: Profile, one_row: bool = False, repeats: bool = True) -> DataFrame:
    """(id, part, field, term, tf, dl, positions); no array outgrows one stored row's text.

    Terms are grouped by sorting those of a batch of items as numbers, so tokens never become rows that a task would have
    to sort, and postings come sorted as they are stored. ``one_row`` tells that every item has one row, whose lengths are
    the item's; ``repeats`` that rows of the same id and part may have to be united. On items bucketed by id neither needs a shuffle.
    """
    rows, names = _termed(items, profile)
    length = (lambda n: F.size(F.array_compact(f"_{n}")).cast("bigint")) if one_row else (
        lambda n: F.sum(F.size(F.array_compact(f"_{n}"))).over(W.partitionBy("id")))
    rows = rows.withColumns({f"_{n}_dl": length(n) for n in names})
    if one_row or not repeats:
        rows = rows.withColumns({f"_{n}": F.array(f"_{n}") for n in names})
    else:
        rows = rows.groupBy("id", "part").agg(*[F.collect_list(f"_{n}").alias(f"_{n}") for n in names],
                                              *[F.max(f"_{n}_dl").alias(f"_{n}_dl") for n in names])
    kind = dict(items.dtypes)["id"]
    return rows.mapInArrow(_postings_of(names), f"id {kind}, part int, field string, term string, tf bigint, dl bigint, positions array<bigint>")


@dataclass(frozen=True)
class Rows:
    """How the rows of a table of items are made up."""
    items: int           # own rows of items
    parts: int           # the highest part
    most: int            # rows of the same id and part, at most

    def postings(self, items: DataFrame, profile: Profile) -> DataFrame:
        return build_postings(items, profile, one_row=self.parts == 0 and self.most <= 1, repeats=self.most > 1)


def count_rows(items: DataFrame) -> Rows:
    """One row comes to the driver; on items bucketed by id nothing else moves."""
    row = items.groupBy("id", "part").agg(F.count("*").alias("n")).agg(
        F.sum(F.when(F.col("part") == 0, F.col("n"))), F.max("part"), F.max("n")).first()
    return Rows(row[0] or 0, row[1] or 0, row[2] or 0)


def term_stats(postings: DataFrame, has_parts: bool = True) -> DataFrame:
    """Items per (field, term). Parts of one item are united within their bucket; only partial
    counts, one per term and task, are shuffled."""
    rows = postings.select("id", "field", "term")
    rows = rows.distinct() if has_parts else rows
    return rows.groupBy("field", "term").agg(F.count("*").alias("df"))


def field_stats(postings: DataFrame) -> DataFrame:
    """Items and mean length per field."""
    lengths = postings.groupBy("id", "field").agg(F.sum("tf").alias("dl"))
    return lengths.groupBy("field").agg(
        F.count("*").alias("n"), F.sum("dl").alias("terms"), (F.sum("dl") / F.count("*")).alias("avgdl"))


def _create(spark: SparkSession, name: str, path: str, buckets: int, sort: str) -> None:
    """Name the files under ``path`` as a bucketed table of this session."""
    columns = spark.read.parquet(path).schema.toDDL()
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (id) SORTED BY ({sort}) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")


def _bucketed(df: DataFrame, name: str, path: str, buckets: int, sort: list[str]) -> None:
    (df.write.bucketBy(buckets, "id").sortBy(*sort).format("parquet").mode("overwrite")
     .option("path", path).saveAsTable(name))


def _names() -> tuple[str, str]:
    name = f"catalograph_{uuid.uuid4().hex}"
    return f"{name}_items", f"{name}_postings"


def bucket_count(spark: SparkSession, text_bytes: int) -> int:
    """Buckets for items with so much indexed text in all: as many as keep a bucket at ``BUCKET_BYTES``, one a core at least."""
    return max(spark.sparkContext.defaultParallelism, -(-text_bytes // BUCKET_BYTES))


def build_index(items: DataFrame, profile: Profile, path: str | None = None,
                buckets: int | None = None) -> Index:
    """Write the index tables under ``path`` (by default in the shared scratch folder).

    Items are shuffled once, by id; tokens and postings are made from the bucketed items in place.
    """
    spark = items.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = path or scratch_path(spark, "index")
    items_table, postings_table = _names()
    stored = items if "part" in items.columns else items.withColumn("part", F.lit(0))
    _bucketed(stored.repartition(buckets, "id"), items_table, f"{path}/items", buckets, ["id"])
    rows = count_rows(spark.table(items_table))
    _bucketed(rows.postings(spark.table(items_table), profile), postings_table,
              f"{path}/postings", buckets, ["field", "term"])
    postings = spark.table(postings_table)
    has_parts = rows.parts > 0
    term_stats(postings, has_parts).sortWithinPartitions("field", "term").write.parquet(
        f"{path}/terms")
    # One row per field comes to the driver.
    fields = {r["field"]: FieldStats(r["n"], r["terms"]) for r in field_stats(postings).collect()}
    index = Index(spark, profile, items_table, postings_table, f"{path}/terms", fields, rows.items,
                  has_parts, path, buckets)
    write_meta(index, f"{path}/meta/generation=0")
    return index


META = ("stem boolean, stop array<string>, catch_all boolean, every_field boolean, buckets int, total bigint, has_parts boolean, generation int, "
        "fields array<struct<field:string,items:bigint,terms:bigint>>")


def terms_path(path: str, generation: int) -> str:
    return f"{path}/terms" if generation == 0 else f"{path}/terms-{generation}"


def write_meta(index: Index, folder: str) -> None:
    """The index's description, one small file per generation; the latest counts."""
    p = index.profile
    meta = [(p.stem, list(p.stop), p.catch_all, p.every_field, index.buckets, index.total, index.has_parts, index.generation,
             [(name, f.items, f.terms) for name, f in index.fields.items()])]
    index.spark.createDataFrame(meta, META).coalesce(1).write.mode("overwrite").json(folder)


def open_index(spark: SparkSession, path: str) -> Index:
    """An index that an earlier session has written; a refresh that was cut off is finished first."""
    from catalograph.retrieval.refresh import finish

    finish(spark, path)
    meta = spark.read.schema(META).json(f"{path}/meta").orderBy(F.desc("generation")).first()
    items_table, postings_table = _names()
    _create(spark, items_table, f"{path}/items", meta["buckets"], "id")
    _create(spark, postings_table, f"{path}/postings", meta["buckets"], "field, term")
    fields = {f["field"]: FieldStats(f["items"], f["terms"]) for f in meta["fields"]}
    return Index(spark, Profile(meta["stem"], tuple(meta["stop"]), meta["catch_all"], meta["every_field"]), items_table, postings_table,
                 terms_path(path, meta["generation"]), fields, meta["total"], meta["has_parts"], path, meta["buckets"],
                 meta["generation"])


def fetch_items(index: Index, top: DataFrame) -> DataFrame:
    """Full items of a page of hits, with the page's other columns and ``rank``.

    The page's few rows come to the driver. As literals their ids prune buckets and row groups, so
    the wide columns are read for the page alone and never travel through scoring and sorting.
    """
    rows = top.collect()
    ids = [r["id"] for r in rows]
    ranked = index.spark.createDataFrame(
        [(i + 1, *r) for i, r in enumerate(rows)],
        T.StructType([T.StructField("rank", T.IntegerType()), *top.schema.fields]))
    found = index.items.where(F.col("id").isin(ids))
    rest = [c for c in found.columns if c == "id" or c not in top.columns]
    own = own_rows(found).select(*rest)
    if index.has_parts:
        lists = [c for c in list_columns(found) if c in rest]
        own = own.drop(*lists).join(whole_lists(found, "id", lists), "id").select(*rest)
    return own.join(F.broadcast(ranked), "id")
