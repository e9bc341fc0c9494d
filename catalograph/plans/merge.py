"""Enrichment of base items from three keyed sources into the final collection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalograph.functions.scalars import (digits_int, item_url, parse_ratings, prefix_id,
                                           split_list_field, try_year)
from catalograph.operators.filters import response_ok
from catalograph.operators.grouping import provenance
from catalograph.operators.joins import (alternate, append_review, article_lists, join_overlay, match_reviews)
from catalograph.operators.lists import LIST_ROWS, attach_lists
from catalograph.operators.ordering import dedup_last_wins
from catalograph.schema import (SOURCE_ARTICLES, SOURCE_BASE, SOURCE_ENRICH, SOURCE_REVIEWS,
                                STRINGS)
from catalograph.session import materialize

ARTICLE_FIELDS = ["headline", "abstract", "snippet"]


def format_enrichment(raw: DataFrame, extra=()) -> DataFrame:
    """Raw answers of the enrichment service as records; answers that report failure are dropped."""
    parsed = response_ok(raw).withColumn("_r", parse_ratings("Ratings"))
    return parsed.select(
        prefix_id("imdbID", SOURCE_ENRICH).alias("id"), F.col("imdbID").alias("imdb_id"),
        F.col("Title").alias("title"), digits_int("Year").alias("year"),
        split_list_field("Genre", ", ").alias("genres"), F.col("Plot").alias("plot"),
        split_list_field("Director", ", ").alias("directors"),
        split_list_field("Actors", ", ").alias("cast"), F.lit(SOURCE_ENRICH).alias("source"),
        item_url("imdbID").alias("url"), F.col("Poster").alias("poster"),
        F.col("_r.metascore").alias("metascore"), F.col("_r.tomatometer").alias("tomatometer"),
        F.col("_r.rating").alias("rating"), *extra)


def named_alike(items: DataFrame) -> DataFrame:
    """Items with ``title`` and ``year`` from whichever of the sources' column names they have."""
    if "primaryTitle" in items.columns:
        items = items.withColumn("title", alternate(items, "primaryTitle", "title")).drop("primaryTitle")
    if "startYear" in items.columns:
        items = items.withColumn("startYear", try_year("startYear"))
        items = items.withColumn("year", alternate(items, "startYear", "year", kind="int")).drop("startYear")
    return items


def merge_entities(items: DataFrame, enrich: DataFrame, reviews: DataFrame,
                   articles: DataFrame | None = None, pos: str = "pos",
                   part_rows: int = LIST_ROWS) -> DataFrame:
    """One left join per source, then id, provenance and review list.

    ``items`` carries ``tconst`` and the load order ``pos``; the last base record of a key wins. Its title and
    year may be named ``primaryTitle`` and ``startYear``; where an item has both, the first that says something
    counts. A review without a year counts as one of year 0, which matches any year. ``reviews`` of an item may be a
    list or one text.
    """
    items = named_alike(items)
    if "reviews" in items.columns and not isinstance(items.schema["reviews"].dataType, T.ArrayType):
        # one text: a list of one, and an empty one is no review
        items = items.withColumn("reviews", F.when(F.col("reviews") != "", F.array("reviews")))
    part = [] if "part" not in items.columns else ["part"]
    base = dedup_last_wins(items.where(F.col("tconst").isNotNull()), ["tconst", *part], pos)
    # Written once: the items are read here for the joins and again for their titles.
    base = materialize(base if part else base.withColumn("part", F.lit(0)), "base")
    own = base.where("part = 0")
    merged = join_overlay(own, enrich, "tconst", "imdb_id", pos)

    if articles is not None:
        lists = article_lists(articles, "imdb_id", ARTICLE_FIELDS, pos, part_rows)
        lists = lists.map(lambda rows: rows.withColumnRenamed("imdb_id", "tconst").withColumn("reported", F.lit(True)))
        names = [f"{f}s" for f in ARTICLE_FIELDS]
        merged = attach_lists(merged, lists, "tconst", [*names, "reported"])
    else:
        merged = merged.withColumn("reported", F.lit(False))

    hits = match_reviews(own, reviews.select(
        "title", F.coalesce("year", F.lit(0)).alias("year"), F.col("reviews").alias("critic_review"), "critic",
        F.col("rating").alias("critic_rating"), F.col("url").alias("critic_url"), pos),
        ["critic_review", "critic", "critic_rating", "critic_url"], pos)
    merged = merged.join(hits.withColumn("reviewed", F.lit(True)), ["title", "year"], "left")
    hit = F.coalesce("reviewed", F.lit(False))
    before = F.col("reviews") if "reviews" in merged.columns else F.lit(None).cast(STRINGS)

    # A review list that continues gets the review at its end, in the last row of the item.
    listed = "reviews" in base.columns
    last = base.groupBy("tconst").agg(F.max("part").alias("last")).where("last > 0")
    merged = merged.join(last, "tconst", "left")
    here = hit & F.col("last").isNull() if listed else hit
    merged = merged.withColumns({
        "reviews": append_review(before, here, F.col("critic_review")),
        "id": F.col("tconst"),
        "source": F.when(F.col("part") == 0, provenance(SOURCE_BASE, {
            SOURCE_ENRICH: F.col("enriched"),
            SOURCE_ARTICLES: F.coalesce("reported", F.lit(False)), SOURCE_REVIEWS: hit})),
    }).drop("tconst", "enriched", "reported", "reviewed", "last", pos)
    further = base.where("part > 0").drop(pos, "source")
    if listed:
        titles = own.select("tconst", F.col("title").alias("_title"), F.col("year").alias("_year"))
        found = hits.select(F.col("title").alias("_title"), F.col("year").alias("_year"),
                            F.lit(True).alias("_hit"), F.col("critic_review").alias("_review"))
        matched = titles.join(found, ["_title", "_year"]).select("tconst", "_hit", "_review")
        further = further.join(last, "tconst").join(matched, "tconst", "left")
        ends = (F.col("part") == F.col("last")) & F.coalesce("_hit", F.lit(False))
        further = further.withColumn("reviews", append_review(
            F.col("reviews"), ends, F.col("_review"))).drop("last", "_hit", "_review")
    further = further.withColumn("id", F.col("tconst")).drop("tconst")
    return merged.unionByName(further, allowMissingColumns=True)
