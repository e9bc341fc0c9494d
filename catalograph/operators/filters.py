"""Projections, predicates and filter specifications."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalograph.operators.lists import list_columns, own_rows, whole_lists
from catalograph.schema import (RATING_CEILING, RECENT_SINCE, VOTES_ANY_YEAR, VOTES_RECENT,
                                YEAR_CEILING, YEAR_FLOOR)


def project_fields(df: DataFrame, fields) -> DataFrame:
    return df.select(*fields)


def drop_rename(df: DataFrame, drop=(), rename: dict[str, str] | None = None) -> DataFrame:
    return df.drop(*drop).withColumnsRenamed(rename or {})


def match_all(items: DataFrame) -> DataFrame:
    """Every item with the constant score of a query that ranks nothing."""
    return own_rows(items).withColumn("score", F.lit(1.0))


def _is_array(df: DataFrame, field: str) -> bool:
    return isinstance(df.schema[field].dataType, T.ArrayType)


def equals(df: DataFrame, field: str, value) -> Column:
    if _is_array(df, field):
        return F.array_contains(field, value)
    return F.col(field) == F.lit(value)


def one_of(df: DataFrame, field: str, values) -> Column:
    """Any of the values; on an array field, any overlap."""
    if _is_array(df, field):
        return F.arrays_overlap(field, F.array(*[F.lit(v) for v in values]))
    return F.col(field).isin(list(values))


def in_range(df: DataFrame, field: str, low, high) -> Column:
    return F.col(field).between(low, high)


def condition(df: DataFrame, filters: dict) -> Column:
    """All filters together: a list means any of, a pair means an inclusive range."""
    def one(field: str, value) -> Column:
        if isinstance(value, list):
            return one_of(df, field, value)
        if isinstance(value, tuple) and len(value) == 2:
            return in_range(df, field, *value)
        return equals(df, field, value)

    return reduce(lambda a, b: a & b, [one(f, v) for f, v in filters.items()], F.lit(True))


def filter_eq(df: DataFrame, field: str, value) -> DataFrame:
    return df.where(equals(df, field, value))


def filter_in(df: DataFrame, field: str, values) -> DataFrame:
    return df.where(one_of(df, field, values))


def filter_range(df: DataFrame, field: str, low, high) -> DataFrame:
    return df.where(in_range(df, field, low, high))


def filter_conjunction(df: DataFrame, filters: dict) -> DataFrame:
    return df.where(condition(df, filters))


def request_filters(genres=(), year_min: str = "", year_max: str = "",
                    rating_min: str = "") -> dict:
    """Filters of a search form; blank bounds fall back to the fixed floor and ceiling."""
    filters: dict = {}
    if genres:
        filters["genres"] = list(genres)
    low, high = str(year_min).strip(), str(year_max).strip()
    if low or high:
        filters["year"] = (int(low) if low else YEAR_FLOOR, int(high) if high else YEAR_CEILING)
    if str(rating_min).strip():
        filters["rating"] = (float(str(rating_min).strip()), RATING_CEILING)
    return filters


def filter_two_tier(df: DataFrame, votes: str = "numVotes", year: str = "startYear",
                    high: int = VOTES_ANY_YEAR, low: int = VOTES_RECENT,
                    since: int = RECENT_SINCE) -> DataFrame:
    """Popular in any year, or recent with fewer votes; a null year fails the second test."""
    return df.where((F.col(votes) > high) | ((F.col(year) >= since) & (F.col(votes) > low)))


def filter_category(df: DataFrame, field: str, values) -> DataFrame:
    return df.where(F.col(field).isin(list(values)))


def get_by_id(items: DataFrame, item_id: str) -> DataFrame:
    """The item with this id, one row or none; lists that continue in further rows come back whole."""
    rows = items.where(F.col("id") == item_id)
    if "part" not in items.columns:
        return rows.limit(1)
    lists = list_columns(items)
    own = own_rows(rows).drop(*lists).join(whole_lists(rows, "id", lists), "id") if lists else own_rows(rows)
    return own.select(*items.columns).limit(1)


def starts_token(tokens: Column, prefix: str) -> Column:
    """Some token begins with the lower-cased prefix."""
    head = F.lower(F.lit(prefix))
    return F.exists(tokens, lambda t: F.startswith(t, head))


def presence_guard(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull())


def response_ok(df: DataFrame) -> DataFrame:
    return df.where(F.col("Response") == "True")
