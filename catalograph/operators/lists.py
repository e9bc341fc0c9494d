"""Ordered lists per key, with no row or task that grows with the largest key.

A list is a set of rows ``(key, part, values)``. Parts ascend along the list, the first is 0; a part holds at most
``part_rows`` values and about ``part_bytes`` bytes of them. Almost every key has part 0 only; a
key that owns a large share of the table is spread over many rows and tasks and loses nothing. Lists of
every size are made the same way.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalograph.session import materialize

LIST_ROWS = 50_000
LIST_BYTES = 16 << 20
_PARTS_OF_A_RANGE = 8192


def numbered(df: DataFrame, keys: list[str], order: list[str], size: Column | None = None) -> DataFrame:
    """Add ``_n``, the 0-based place of a row within its key, and ``_bytes``, the sizes before it,
    for keys of any size.

    The table is cut into ranges of (key, order), which also cuts the large keys; rows are numbered
    within (range, key), and a key that crosses a border gets the count of its rows in earlier
    ranges added. The ranges are written first: their borders come from a sample and must not move
    when a task runs again. ``order`` must be unique per key, and keys must not be null.
    """
    size = F.lit(0) if size is None else size
    ranged = materialize(df.withColumn("_size", size.cast("bigint")).repartitionByRange(*keys, *order)
                         .withColumn("_range", F.spark_partition_id()), "lists")
    counts = ranged.groupBy(*keys, "_range").agg(
        F.count("*").alias("_rows"), F.sum("_size").alias("_held"))
    spans = counts.groupBy(*keys).agg(F.count("*").alias("_ranges")).where("_ranges > 1")
    earlier = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    # Only keys that cross a border are listed, once per range they touch: at most twice as many
    # rows as there are ranges, whatever the data. That bound makes this broadcast safe.
    offsets = counts.join(spans.select(*keys), keys, "left_semi").select(
        *keys, "_range", F.coalesce(F.sum("_rows").over(earlier), zero).alias("_rows_before"),
        F.coalesce(F.sum("_held").over(earlier), zero).alias("_held_before"))
    within = W.partitionBy("_range", *keys).orderBy(*order)
    held = F.sum("_size").over(within.rowsBetween(W.unboundedPreceding, -1))
    placed = ranged.withColumns({"_place": F.row_number().over(within) - 1, "_held": held}).join(
        F.broadcast(offsets), [*keys, "_range"], "left")
    return placed.withColumns({
        "_n": F.col("_place") + F.coalesce("_rows_before", zero),
        "_bytes": F.coalesce("_held", zero) + F.coalesce("_held_before", zero),
    }).select(*df.columns, "_n", "_bytes")


def _bytes_of(column: str, kind: T.DataType) -> Column:
    """Bytes of a value's texts; other parts of a value are small."""
    if isinstance(kind, T.StringType):
        return F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(kind, T.StructType):
        texts = [f.name for f in kind.fields if isinstance(f.dataType, T.StringType)]
        return sum((F.coalesce(F.octet_length(f"{column}.`{t}`"), F.lit(0)) for t in texts), F.lit(0))
    return F.lit(0)


@dataclass(frozen=True)
class Lists:
    """Lists as two frames of rows (key, part, values): ``first`` has part 0, one row per key and grouped by it, so
    that Catalyst drops its join where no list is read; ``more`` has all further parts."""
    first: DataFrame
    more: DataFrame

    def map(self, change: Callable[[DataFrame], DataFrame]) -> Lists:
        return Lists(change(self.first), change(self.more))

    def rows(self) -> DataFrame:
        return self.first.unionByName(self.more)


def collect_in_order(df: DataFrame, key, value: Column | str, order: list[str],
                     name: str = "values", part_rows: int = LIST_ROWS,
                     part_bytes: int = LIST_BYTES) -> DataFrame:
    """Values per key in order, nulls kept, as rows (key, part, values); see ``ordered_lists``."""
    return ordered_lists(df, key, value, order, name, part_rows, part_bytes).rows()


def ordered_lists(df: DataFrame, key, value: Column | str, order: list[str],
                  name: str = "values", part_rows: int = LIST_ROWS,
                  part_bytes: int = LIST_BYTES) -> Lists:
    """Values per key in order, nulls kept; rows without a key are left out. ``order`` must be unique per key.

    One lazy plan: nothing is written or run here, and a query that reads no list drops the whole of it. Counts per
    key name the keys whose list outgrows a part (fewer than rows / ``part_rows``). All lists up to
    that, and the first part of the longer ones, are one grouping by key. What is left of the longer ones is
    cut into ranges of (key, order), so a hot key is spread, and each range into parts; their numbers ascend
    along the list but have gaps, and another run of the plan may cut them elsewhere.
    """
    keys = [key] if isinstance(key, str) else list(key)
    value = F.col(value) if isinstance(value, str) else value
    rows = df.select(*keys, *[c for c in order if c not in keys], value.alias("_v")).dropna(subset=keys)
    size = _bytes_of("_v", rows.schema["_v"].dataType).cast("bigint")
    place = F.struct(*order)
    held = F.coalesce(F.sum("_size").over(W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))

    # ---- the keys with further parts: the first part by a bounded window, then where it ends
    rows = rows.withColumn("_size", size)
    long = rows.groupBy(*keys).agg(F.count("*").alias("_rows"), F.sum("_size").alias("_held")).where(
        (F.col("_rows") > part_rows) | (F.col("_held") >= part_bytes)).select(*keys, F.lit(True).alias("_long"))
    first = (rows.join(long, keys, "left_semi")
             .withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= part_rows)
             .withColumn("_before", held).where(F.col("_before") < part_bytes))
    ends = first.groupBy(*keys).agg(F.max(place).alias("_end"))

    listed = rows.join(long, keys, "left").where("_long IS NULL").drop("_long").unionByName(first.drop("_n", "_before"))
    whole = listed.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(place.alias("_p"), "_v"))).alias("_l")).select(
        *keys, F.lit(0).alias("part"), F.transform("_l", lambda e: e["_v"]).alias(name))

    ranged = (rows.join(ends, keys).where(place > F.col("_end")).drop("_end").repartitionByRange(*keys, *order)
              .withColumn("_range", F.spark_partition_id()))
    within = W.partitionBy("_range", *keys).orderBy(*order)
    local = (F.floor((F.row_number().over(within) - 1) / part_rows)
             + F.floor(F.coalesce(F.sum("_size").over(within.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) / part_bytes))
    number = (1 + F.col("_range") * _PARTS_OF_A_RANGE + F.col("_local")).cast("int")
    # The number is an aggregate so that "part > 0" stays beside a reader's "part = 0", which Catalyst sees to be empty.
    more = ranged.withColumn("_local", local).groupBy("_range", *keys, "_local").agg(
        F.min(number).alias("part"), F.array_sort(F.collect_list(F.struct(place.alias("_p"), "_v"))).alias("_l")).select(
        *keys, "part", F.transform("_l", lambda e: e["_v"]).alias(name)).where("part > 0")
    return Lists(whole, more)


def own_rows(items: DataFrame) -> DataFrame:
    """Items without the rows that continue their lists: one row per item."""
    return items.where("part = 0") if "part" in items.columns else items


def list_columns(items: DataFrame) -> list[str]:
    """Columns whose lists may continue in further rows: every array, whatever its name."""
    return [f.name for f in items.schema if isinstance(f.dataType, T.ArrayType)]


def whole_lists(rows: DataFrame, key: str, names: list[str]) -> DataFrame:
    """One row per key with each list in full. For a few keys, such as those of a page: an item's list then
    fits where its page does."""
    def joined(name: str) -> Column:
        parts = F.array_sort(F.collect_list(F.when(F.col(name).isNotNull(), F.struct("part", name))))
        return F.when(F.size(parts) > 0, F.flatten(F.transform(parts, lambda p: p[name]))).alias(name)

    return rows.groupBy(key).agg(*[joined(name) for name in names])


def group_records(df: DataFrame, key: str, pos: str, part_rows: int = LIST_ROWS) -> DataFrame:
    """Records per key in load order, as rows (key, part, records)."""
    record = F.struct(*[c for c in df.columns if c != key])
    return collect_in_order(df, key, record, [pos], "records", part_rows)


def top_n_collect(df: DataFrame, key: str, value: Column | str, order: list[str], n: int,
                  name: str = "values") -> DataFrame:
    """First n values per key in order; n bounds the list, so one row per key holds it."""
    value = F.col(value) if isinstance(value, str) else value
    place = F.row_number().over(W.partitionBy(key).orderBy(*order))
    top = df.withColumn("_n", place).where(F.col("_n") <= n)
    lists = top.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("_n", value.alias("_v")))).alias("_l"))
    return lists.select(key, F.transform("_l", lambda e: e["_v"]).alias(name))


def attach_lists(items: DataFrame, lists: Lists | DataFrame, key: str, names: list[str]) -> DataFrame:
    """Add list columns to items that carry ``part``; absent lists stay null.

    Part 0 joins the item's own row. Later parts become continuation rows that hold the key, the
    part and the list only, so an oversized list stays whole. Of ``Lists``, a query that reads no list column
    keeps neither the join nor what makes the lists in its plan.
    """
    if isinstance(lists, DataFrame):
        lists = Lists(lists.where("part = 0"), lists.where("part > 0"))
    joined = items.join(lists.first.drop("part"), key, "left")
    more = lists.more.join(
        items.where("part = 0").select(key), key, "left_semi").select(key, "part", *names)
    return joined.unionByName(more, allowMissingColumns=True)
