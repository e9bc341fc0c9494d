"""Keyed lookups, overlays and title matching.

No join here is hinted: Spark broadcasts a side whose size it has checked and otherwise shuffles both,
and AQE splits the partitions of a hot key. The looked-up side is always reduced to one row per key
first, so a hot key can never multiply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.functions.scalars import falsy_fallback, overlay_values, strip, try_year
from catalograph.operators.lists import LIST_ROWS, Lists, attach_lists, ordered_lists
from catalograph.operators.ordering import dedup_last_wins
from catalograph.operators.sets import unseen
from catalograph.schema import STRINGS


class KeyRepeats(ValueError):
    """A key that must be unique occurs more than once."""


def join_inner(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "inner")


def require_unique(df: DataFrame, key: str, side: str) -> None:
    repeated = df.groupBy(key).count().where("count > 1").select(key).head(1)
    if repeated:
        raise KeyRepeats(f"{side} side repeats {key} = {repeated[0][0]!r}")


def join_one_to_one(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    require_unique(left, on, "left")
    require_unique(right, on, "right")
    return left.join(right, on, "inner")


def join_semi(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows whose key is among the ids; repeated ids are united before the shuffle."""
    return df.join(ids.select(on).distinct(), on, "left_semi")


def join_anti(candidates: DataFrame, known: DataFrame, on: str) -> DataFrame:
    return unseen(candidates, known, on)


def join_lookup(df: DataFrame, names: DataFrame, key: str, value: str, pos: str) -> DataFrame:
    """Add the value that ``names`` last gave to the key; unknown keys give null."""
    return df.join(dedup_last_wins(names.select(key, value, pos), key, pos).drop(pos), key, "left")


def join_overlay(items: DataFrame, enrich: DataFrame, item_key: str = "tconst",
                 enrich_key: str = "imdb_id", pos: str = "pos") -> DataFrame:
    """Enrichment by key: scores and poster are overwritten on a match, the plot only when given."""
    fields = ["metascore", "tomatometer", "poster", "plot"]
    known = enrich.where(F.col(enrich_key).isNotNull())
    latest = dedup_last_wins(known.select(enrich_key, *fields, pos), enrich_key, pos).select(
        F.col(enrich_key).alias(item_key), *[F.col(f).alias(f"_{f}") for f in fields],
        F.lit(True).alias("enriched"))
    old = {f: (f if f in items.columns else None) for f in fields}
    joined = items.join(latest, item_key, "left").withColumn(
        "enriched", F.coalesce("enriched", F.lit(False)))

    def new(field: str, mode: str) -> Column:
        before = F.col(old[field]) if old[field] else F.lit(None)
        return overlay_values(before, F.col(f"_{field}"), F.col("enriched"), mode)

    return joined.withColumns({
        "metascore": new("metascore", "overwrite"), "tomatometer": new("tomatometer", "overwrite"),
        "poster": new("poster", "overwrite"), "plot": new("plot", "truthy"),
    }).drop(*[f"_{f}" for f in fields])


def article_lists(recs: DataFrame, key: str, fields: list[str], pos: str,
                  part_rows: int = LIST_ROWS) -> Lists:
    """Per key and part, one array per field in load order, empty values left out."""
    present = recs.where(F.col(key).isNotNull())
    lists = ordered_lists(present, key, F.struct(*fields), [pos], "_recs", part_rows)

    def values(field: str) -> Column:
        xs = F.transform("_recs", lambda r: r[field])
        return F.filter(xs, lambda x: x.isNotNull() & (x != "")).alias(f"{field}s")

    return lists.map(lambda rows: rows.select(key, "part", *[values(f) for f in fields]))


def join_one_to_many(items: DataFrame, recs: DataFrame, on: str, fields: list[str], pos: str,
                     part_rows: int = LIST_ROWS) -> DataFrame:
    """Attach one array per field; oversized groups continue in further rows of the item."""
    base = items if "part" in items.columns else items.withColumn("part", F.lit(0))
    lists = article_lists(recs, on, fields, pos, part_rows)
    return attach_lists(base, lists, on, [f"{f}s" for f in fields])


def join_title_year(items: DataFrame, recs: DataFrame, value: str, pos: str = "pos") -> DataFrame:
    """Exact match on lower-cased title and year; the last record of a key wins."""
    latest = (recs.select(F.lower("title").alias("_title"), F.col("year").alias("_year"), value, pos)
              .transform(dedup_last_wins, ["_title", "_year"], pos).drop(pos))
    keyed = items.withColumns({"_title": F.lower("title"), "_year": F.col("year")})
    return keyed.join(latest, ["_title", "_year"], "left").drop("_title", "_year")


def title_year_lookup(items: DataFrame, title: str = "title", year: str = "year",
                      key: str = "id", pos: str = "pos") -> DataFrame:
    """Catalogue map from title and year to key; rows without a readable year are left out."""
    named = items.select(F.lower(title).alias("title_key"), try_year(year).alias("year"),
                         F.col(key).alias(key), F.col(pos).alias(pos))
    usable = named.where((F.col("title_key") != "") & F.col("year").isNotNull()
                         & (F.col("year") != 0))
    return dedup_last_wins(usable, ["title_key", "year"], pos).drop(pos)


def match_reviews(items: DataFrame, recs: DataFrame, values: list[str], pos: str = "pos",
                  tolerance: int = 1) -> DataFrame:
    """Resolve each distinct (title, year) of the items to one record.

    First the exact key as in ``join_title_year``. Without one, the first record in load order under
    the trimmed title whose year is 0 or within the tolerance; a record without a year met before
    that ends the search with no match.

    Records are reduced to one per (title, year) for either search, and an item asks for the few
    years it could accept, so equal titles never pair up: the work is linear however often one
    occurs. The answers of both searches meet in one grouping.
    """
    wanted = (items.select("title", "year")
              .where((F.col("title") != "") & F.col("year").isNotNull() & (F.col("year") != 0))
              .distinct())
    hit = F.struct(F.col("year").alias("found_year"), *values).alias("_hit")
    titled = recs.where(F.col("title").isNotNull())
    exact = (titled.where(F.col("year").isNotNull())
             .groupBy(F.lower("title").alias("_t"), F.col("year").alias("_y"))
             .agg(F.max_by(hit, F.col(pos)).alias("_hit")))
    # A record without a year is asked for under a value that no year takes.
    no_year = F.lit(-2147483648)
    first = (titled.groupBy(F.lower(strip("title")).alias("_t"),
                            F.coalesce("year", no_year).alias("_y"))
             .agg(F.min_by(hit, F.col(pos)).alias("_hit"), F.min(pos).alias("_pos")))
    asked = F.array_distinct(F.concat(
        F.array(no_year, F.lit(0)),
        F.sequence(F.col("year") - tolerance, F.col("year") + tolerance)))
    exact_hits = (wanted.withColumns({"_t": F.lower("title"), "_y": F.col("year")})
                  .join(exact, ["_t", "_y"]).select("title", "year", F.lit(0).alias("_try"),
                                                    F.lit(None).cast(recs.schema[pos].dataType)
                                                    .alias("_pos"), "_hit"))
    near_hits = (wanted.select("title", "year", F.lower(strip("title")).alias("_t"),
                               F.explode(asked).alias("_y"))
                 .join(first, ["_t", "_y"]).select("title", "year", F.lit(1).alias("_try"),
                                                   "_pos", "_hit"))
    best = (exact_hits.unionByName(near_hits).groupBy("title", "year")
            .agg(F.min_by("_hit", F.struct("_try", "_pos")).alias("_hit")))
    return best.where(F.col("_hit.found_year").isNotNull()).select(
        "title", "year", *[F.col(f"_hit.{v}").alias(v) for v in values])


def join_year_tolerance(items: DataFrame, recs: DataFrame, values: list[str], pos: str = "pos",
                        tolerance: int = 1) -> DataFrame:
    """Items with the record that exact or tolerant title matching gives them, else nulls."""
    return items.join(match_reviews(items, recs, values, pos, tolerance), ["title", "year"], "left")


def append_review(reviews: Column, matched: Column, review: Column) -> Column:
    """Reviews array with the matched review added; the array is created where absent."""
    empty = F.array().cast(STRINGS)
    return F.when(matched, F.concat(F.coalesce(reviews, empty),
                                    F.array(review))).otherwise(reviews)


def alternate(df: DataFrame, *names: str, kind: str = "string") -> Column:
    """First truthy value among alternative column names that the frame really has."""
    return falsy_fallback(*[n for n in names if n in df.columns], kind=kind)
