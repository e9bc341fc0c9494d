"""The user tasks of the search system as compositions of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalograph.operators.filters import condition
from catalograph.operators.ordering import first_rows, paginate, random_keys, sort_keys
from catalograph.retrieval.index import Index, fetch_items
from catalograph.retrieval.request import SearchRequest, matched_items
from catalograph.retrieval.scoring import Clause, boolean_terms, search_phrase_boost
from catalograph.retrieval.similar import similar_items
from catalograph.schema import PAGE_SIZE


def task_known_item(index: Index, title: str) -> DataFrame:
    """The best hit for a title, with its rating."""
    hit = first_rows(search_phrase_boost(index, title), [F.col("score").desc(), F.col("id")], 1)
    return fetch_items(index, hit).select("id", "title", "rating", "score")


def task_faceted(index: Index, genre: str, min_rating: float, year_from: int,
                 year_to: int | None = None) -> DataFrame:
    """Highly rated items of a genre since a year, best first."""
    items = index.items.where("part = 0")
    kept = items.where(condition(items, {"genres": [genre]}) & (F.col("rating") >= min_rating)
                       & (F.col("year") >= year_from))
    if year_to is not None:
        kept = kept.where(F.col("year") <= year_to)
    return kept.select("id", "title", "year", "rating")


def task_genre_decade(index: Index, genre: str, year_from: int, year_to: int, above: float,
                      k: int = 3) -> DataFrame:
    """The k best items of a genre in a span of years, rated strictly above a bound."""
    items = index.items.where("part = 0")
    kept = items.where(condition(items, {"genres": [genre], "year": (year_from, year_to)})
                       & (F.col("rating") > above))
    return first_rows(kept, sort_keys("rating desc"), k).select("id", "title", "year", "rating")


def task_discovery(index: Index, title: str, k: int = 10) -> DataFrame:
    """Items similar to the one a title search finds first, with their display fields; none if it finds nothing."""
    best = task_known_item(index, title).select("id").first()      # one row: the seed
    return similar_items(index, best["id"] if best else "", k=k)


def task_complex(index: Index, genre: str, word: str, year_from: int, year_to: int,
                 min_rating: float) -> DataFrame:
    """Items of a genre, span of years and rating whose plot, or genre list, has a word."""
    items = index.items.where("part = 0")
    kept = items.where(condition(items, {"genres": [genre], "year": (year_from, year_to)})
                       & (F.col("rating") >= min_rating))
    themed = boolean_terms(index, should=[Clause(word, "plot")]).select("id", F.lit(True).alias("hit"))
    return (kept.join(themed, "id", "left")
            .where(F.coalesce("hit", F.lit(False)) | F.array_contains("genres", word))
            .select("id", "title", "year", "rating"))


def lucky(index: Index, seed: int, size: int = PAGE_SIZE) -> DataFrame:
    """First page of everything in the random order of a seed."""
    every = matched_items(index, SearchRequest())
    page = paginate(every, random_keys(seed), 1, size).select("id")
    return fetch_items(index, page).select("id", "title", "year", "rating")
