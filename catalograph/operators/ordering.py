"""Sorts, limits, paging and first/last-per-group. Every order ends with a unique key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalograph.schema import CATALOGUE_LIMIT, PAGE_SIZE

def sort_keys(order: str, key: str = "id") -> list[Column]:
    """``"rating desc"`` as sort keys; missing numbers sort lowest, ties go by key."""
    field, _, direction = order.strip().partition(" ")
    column = F.col(field)
    first = column.desc_nulls_last() if direction.strip() == "desc" else column.asc_nulls_first()
    return [first, F.col(key).asc()]


def random_keys(seed: int, key: str = "id") -> list[Column]:
    """A repeatable random order for a seed, highest first."""
    return [F.md5(F.concat(F.lit(f"{seed}_"), F.col(key))).desc(), F.col(key).asc()]


def sort_field(df: DataFrame, order: str) -> DataFrame:
    return df.orderBy(*sort_keys(order))


def sort_relevance(scored: DataFrame) -> DataFrame:
    return scored.orderBy(F.col("score").desc(), F.col("id").asc())


def sort_random_seeded(df: DataFrame, seed: int) -> DataFrame:
    return df.orderBy(*random_keys(seed))


def first_rows(df: DataFrame, order: list[Column], limit: int, skip: int = 0) -> DataFrame:
    """Rows ``skip+1 .. skip+limit`` of a total order, in that order."""
    ordered = df.orderBy(*order)
    return (ordered.offset(skip) if skip else ordered).limit(limit)


def above_cut(df: DataFrame, lead: str, k: int, accuracy: int = 10_000) -> DataFrame:
    """Rows that can be among the ``k`` with the highest ``lead``: all of those, and few more.

    The cut is an approximate percentile whose rank is off by at most rows / ``accuracy``; twice that is
    left as room, so a large k sends about k rows to the final order, not k rows per task. Rows
    without ``lead`` are kept only where fewer than ``k`` rows have it.
    """
    known = F.count(lead)
    share = df.agg(known.alias("n"), F.count("*").alias("all")).first()
    n = share["n"]
    low = 1.0 - (k + 1) / n - 2.0 / accuracy if n else 0.0
    if low <= 0:
        return df
    cut = df.agg(F.percentile_approx(lead, low, accuracy).alias("cut")).first()["cut"]
    return df.where(F.col(lead) >= F.lit(cut))


def paginate(df: DataFrame, order: list[Column], page: int, size: int = PAGE_SIZE) -> DataFrame:
    return first_rows(df, order, size, (page - 1) * size)


def total_pages(found: Column | str, size: int = PAGE_SIZE) -> Column:
    return F.ceil(F.col(found) / size) if isinstance(found, str) else F.ceil(found / size)


def top_k_global(df: DataFrame, order: list[Column], k: int = CATALOGUE_LIMIT,
                 lead: str | None = None) -> DataFrame:
    """The first k rows. ``lead`` names the numeric column that ``order`` sorts by first, descending
    with nulls last; with it a large k is cut before rows move."""
    return first_rows(above_cut(df, lead, k) if lead else df, order, k)


def top_n_per_group(df: DataFrame, key, order: list[Column], n: int) -> DataFrame:
    """First n rows per key. The bound is applied before the shuffle too (window group limit), so a
    key that holds much of the table sends at most n rows per task."""
    keys = [key] if isinstance(key, str) else list(key)
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def first_per_group(df: DataFrame, key, pos: str) -> DataFrame:
    """Record with the lowest position per key."""
    return _pick(df, key, pos, F.min_by)


def dedup_last_wins(df: DataFrame, key, pos: str) -> DataFrame:
    """Record with the highest position per key, as a keyed load keeps it."""
    return _pick(df, key, pos, F.max_by)


def _pick(df: DataFrame, key, pos: str, choose) -> DataFrame:
    """One record per key by an aggregate that combines before the shuffle.

    A record without a position gives way to any with one; of several without, the greatest (or least) by its
    other values is kept whole.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    placed = F.col(pos).isNotNull() if choose is F.max_by else F.col(pos).isNull()
    digest = F.xxhash64(*[F.to_json(F.struct(*rest))])
    picked = df.groupBy(*keys).agg(choose(F.struct(*rest), F.struct(
        placed, pos, F.when(F.col(pos).isNull(), digest))).alias("_r"))
    return picked.select(*keys, "_r.*").select(*df.columns)


def cap_list(xs: Column | str, n: int = 50) -> Column:
    return F.slice(xs, 1, n)
