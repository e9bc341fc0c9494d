"""Record schemas and the fixed values that results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

STRINGS = T.ArrayType(T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

TITLE_BASICS = _struct(tconst=S, titleType=S, primaryTitle=S, startYear=S, genres=S)
TITLE_RATINGS = _struct(tconst=S, averageRating=D, numVotes=I)
TITLE_PRINCIPALS = _struct(tconst=S, ordering=I, nconst=S, category=S)
NAME_BASICS = _struct(nconst=S, primaryName=S)

BASE_ITEM = _struct(id=S, tconst=S, title=S, year=I, genres=STRINGS, plot=S, rating=D, numVotes=I,
                    runtimeMinutes=I, directors=STRINGS, cast=STRINGS, source=S)
ENRICHMENT = _struct(id=S, imdb_id=S, title=S, year=I, genres=STRINGS, plot=S, directors=STRINGS,
                     cast=STRINGS, source=S, url=S, poster=S, metascore=I, tomatometer=I, rating=D)
ENRICHMENT_RAW = _struct(Response=S, imdbID=S, Title=S, Year=S, Genre=S, Plot=S, Director=S,
                         Actors=S, Poster=S,
                         Ratings=T.ArrayType(_struct(Source=S, Value=S)))
REVIEW = _struct(id=S, title=S, year=I, site=S, url=S, rating=D, genres=STRINGS, directors=STRINGS,
                 cast=STRINGS, plot=S, reviews=S, num_reviews=I, critic=S, review_date=S,
                 rating_value=D, rating_scale=D, summary=S)
# The searched collection. `part` is 0 except on rows that continue an oversized list.
ITEM = _struct(id=S, part=I, title=S, year=I, genres=STRINGS, directors=STRINGS, cast=STRINGS,
               site=S, url=S, rating=D, num_reviews=I, poster=S, plot=S, reviews=STRINGS,
               numVotes=I, metascore=I, tomatometer=I, critic_review=S, critic=S, critic_rating=D,
               critic_url=S, source=STRINGS)

# ---- fixed values: they must equal what existing users' data and results contain ----
NULL_TOKENS = ("\\N", "nan", "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
               "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "null")
TITLE_TYPE = "movie"
DIRECTOR_CATEGORIES = ("director",)
ACTOR_CATEGORIES = ("actor", "actress")
VOTES_ANY_YEAR = 500
VOTES_RECENT = 50
RECENT_SINCE = 2024
CATALOGUE_LIMIT = 250_000
TOP_CREDITS = 5
SOURCE_BASE, SOURCE_ENRICH = "imdb", "omdb"
SOURCE_ARTICLES, SOURCE_REVIEWS = "nyt", "rogerebert"
REVIEW_RATING_SCALE = 4.0
ITEM_URL = "https://www.imdb.com/title/"
YEAR_FLOOR, YEAR_CEILING, RATING_CEILING = 1900, 2024, 10.0
PAGE_SIZE = 10
SEARCH_FIELDS = ("id", "title", "year", "rating", "tomatometer", "genres", "directors", "cast",
                 "plot", "reviews", "url", "site", "num_reviews", "poster")
SIMILAR_FIELDS = ("id", "title", "year", "rating", "genres", "directors", "cast", "plot", "url",
                  "site", "poster")
FIELD_BOOSTS = {"title": 10.0, "cast": 5.0, "directors": 5.0, "plot": 2.0, "reviews": 2.0,
                "genres": 1.0}
PHRASE_BOOSTS = {"title": 25.0, "cast": 10.0, "directors": 10.0, "plot": 3.0, "reviews": 3.0}
SIMILAR_BY = ("plot", "title", "genres", "cast", "directors", "reviews")
# ---- end of fixed values ----
