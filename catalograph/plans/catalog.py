"""From bulk tables to base catalogue items, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalograph.functions.scalars import digits_int, prefix_id, split_list_field
from catalograph.operators.filters import filter_category, filter_two_tier
from catalograph.operators.joins import join_inner, join_lookup, join_semi, require_unique
from catalograph.operators.lists import LIST_ROWS, Lists, attach_lists, ordered_lists, top_n_collect
from catalograph.operators.ordering import top_k_global, top_n_per_group
from catalograph.schema import (ACTOR_CATEGORIES, CATALOGUE_LIMIT, DIRECTOR_CATEGORIES,
                                SOURCE_BASE, STRINGS, TITLE_TYPE, TOP_CREDITS)
from catalograph.session import materialize


def popular_titles(basics: DataFrame, ratings: DataFrame, types=(TITLE_TYPE,),
                   limit: int = CATALOGUE_LIMIT, **tiers) -> DataFrame:
    """Titles of the wanted type that pass the two-tier vote test, most-voted first up to a limit."""
    titled = filter_category(basics, "titleType", types)
    rated = join_inner(titled, ratings, "tconst")
    dated = rated.withColumn("startYearNumber", F.col("startYear").try_cast("double"))
    chosen = filter_two_tier(dated, year="startYearNumber", **tiers).drop("startYearNumber")
    return top_k_global(chosen, [F.col("numVotes").desc(), F.col("tconst").asc()], limit, "numVotes")


def director_lists(principals: DataFrame, names: DataFrame, order: list[str],
                   categories=DIRECTOR_CATEGORIES, part_rows: int = LIST_ROWS) -> Lists:
    """Directors per title in file order; an unknown person stays as a null entry."""
    credits = filter_category(principals, "category", categories)
    named = join_lookup(credits, names, "nconst", "primaryName", "pos")
    return ordered_lists(named, "tconst", "primaryName", order, "directors", part_rows)


def cast_lists(principals: DataFrame, names: DataFrame, order: list[str],
               categories=ACTOR_CATEGORIES, n: int = TOP_CREDITS) -> DataFrame:
    """The first actors per title by billing, named in that order.

    The top n are taken before names are looked up, so the lookup sees n rows per title at most.
    """
    credits = filter_category(principals, "category", categories)
    billed = top_n_per_group(credits, "tconst", [F.col(c) for c in order], n)
    named = join_lookup(billed, names, "nconst", "primaryName", "pos")
    return top_n_collect(named, "tconst", "primaryName", [F.col(c) for c in order], n, "cast")


def assemble_items(titles: DataFrame, directors: Lists | DataFrame, cast: DataFrame) -> DataFrame:
    """Base records; titles without credits get empty lists."""
    none = F.array().cast(STRINGS)
    base = titles.select(
        prefix_id("tconst", SOURCE_BASE).alias("id"), "tconst", F.lit(0).alias("part"),
        F.col("primaryTitle").alias("title"), digits_int("startYear").alias("year"),
        split_list_field("genres", ",", drop_empty=True).alias("genres"),
        F.lit(None).cast("string").alias("plot"), F.col("averageRating").alias("rating"),
        "numVotes", F.lit(None).cast("int").alias("runtimeMinutes"))
    listed = attach_lists(base, directors, "tconst", ["directors"]).join(cast, "tconst", "left")
    own = F.col("part") == 0
    return listed.select(
        prefix_id("tconst", SOURCE_BASE).alias("id"), "tconst", "part", "title", "year", "genres",
        "plot", "rating", "numVotes", "runtimeMinutes",
        F.coalesce("directors", none).alias("directors"),
        F.when(own, F.coalesce("cast", none)).alias("cast"), F.lit(SOURCE_BASE).alias("source"))


def catalog_build(basics: DataFrame, ratings: DataFrame, principals: DataFrame, names: DataFrame,
                  order: list[str] = ("ordering",), director_order: list[str] | None = None,
                  types=(TITLE_TYPE,),
                  limit: int = CATALOGUE_LIMIT, director_categories=DIRECTOR_CATEGORIES,
                  actor_categories=ACTOR_CATEGORIES, part_rows: int = LIST_ROWS,
                  validate: bool = True, **tiers) -> DataFrame:
    """Selection, joins and credits together.

    ``order`` names the columns that order the credits of a title uniquely, ``director_order`` those
    for directors where they differ (file order: the position column of the read); ``names`` carries
    ``pos``. Credits are reduced to the selected titles before any name is looked up.
    """
    order = list(order)
    # Written once: at most ``limit`` rows, used by the check, the credits and the assembly.
    titles = materialize(popular_titles(basics, ratings, types, limit, **tiers), "titles")
    if validate:
        require_unique(titles, "tconst", "titles or ratings")
    credits = join_semi(principals, titles.select("tconst"), "tconst")
    return assemble_items(
        titles, director_lists(credits, names, list(director_order or order),
                               director_categories, part_rows),
        cast_lists(credits, names, order, actor_categories))
