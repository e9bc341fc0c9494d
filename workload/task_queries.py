"""User tasks and whole pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalograph.plans import tasks as K
from catalograph.plans.catalog import catalog_build
from catalograph.plans.merge import merge_entities
from workload import tables as T
from workload.registry import query
from workload.retrieval_queries import PHRASE, _full, _like, _seed_terms
from workload.scalar_queries import shown_items


@query("task_known_item", f"""WITH {_full(PHRASE)} SELECT id, title, rating, score FROM items
    JOIN ranked USING (id) ORDER BY score DESC, id LIMIT 1""")
def _(spark, sf):
    return K.task_known_item(T.index(spark, sf), PHRASE)


@query("task_faceted", f"""WITH {T.ITEMS} SELECT id, title, year, rating FROM items
    WHERE list_contains(genres, 'en') AND rating >= 8.0 AND year >= 2011""")
def _(spark, sf):
    return K.task_faceted(T.index(spark, sf), "en", 8.0, 2011)


@query("task_genre_decade", f"""WITH {T.ITEMS} SELECT id, title, year, rating FROM items
    WHERE list_contains(genres, 'fr') AND year BETWEEN 1990 AND 1999 AND rating > 7.0
    ORDER BY rating DESC, id LIMIT 3""")
def _(spark, sf):
    return K.task_genre_decade(T.index(spark, sf), "fr", 1990, 1999, 7.0, 3)


@query("task_discovery", f"""WITH {_full(PHRASE)},
    {_seed_terms("SELECT id FROM (SELECT id FROM ranked ORDER BY score DESC, id LIMIT 1)")},
    {_like(10)} SELECT seed, i.id, score, title, year, rating, array_to_string(genres, '|') AS genres, plot, site
    FROM liked JOIN items i ON i.id = liked.id""")
def _(spark, sf):
    found = K.task_discovery(T.index(spark, sf), PHRASE, 10).withColumn("genres", F.array_join("genres", "|"))
    return found.select("seed", "id", "score", "title", "year", "rating", "genres", "plot", "site")


@query("task_complex", f"""WITH {T.TOKENS} SELECT id, title, year, rating FROM items
    WHERE list_contains(genres, 'en') AND year BETWEEN 2000 AND 2024 AND rating >= 2.5
    AND (id IN (SELECT id FROM tokens WHERE field = 'plot' AND term = 'ndstnd')
      OR list_contains(genres, 'ndstnd'))""")
def _(spark, sf):
    return K.task_complex(T.index(spark, sf), "en", "ndstnd", 2000, 2024, 2.5)


@query("lucky", f"""WITH {T.ITEMS} SELECT id, title, year, rating FROM items
    ORDER BY md5('777_' || id) DESC, id LIMIT 10""")
def _(spark, sf):
    return K.lucky(T.index(spark, sf), 777)


CATALOG = f"""{T.BULK},
    chosen AS (SELECT * FROM basics JOIN ratings USING (tconst) WHERE titleType = 'F'
      AND (numVotes > 1500 OR (cast(startYear AS INTEGER) >= 1998 AND numVotes > 500))
      ORDER BY numVotes DESC, tconst LIMIT 4000),
    named AS (SELECT p.*, n.primaryName FROM principals p LEFT JOIN people n USING (nconst)
      WHERE tconst IN (SELECT tconst FROM chosen)),
    directed AS (SELECT tconst, string_agg(coalesce(primaryName, '?'), '|'
      ORDER BY ordering, line, nconst) AS directors FROM named WHERE category = 'R' GROUP BY tconst),
    billed AS (SELECT *, row_number() OVER (PARTITION BY tconst ORDER BY ordering, line, nconst) AS rn
      FROM named WHERE category IN ('A', 'N')),
    acted AS (SELECT tconst, string_agg(coalesce(primaryName, '?'), '|' ORDER BY rn) AS "cast"
      FROM billed WHERE rn <= 5 GROUP BY tconst),
    built AS (SELECT 'imdb_' || tconst AS id, tconst, primaryTitle AS title,
      cast(startYear AS INTEGER) AS year, replace(genres, ',', '|') AS genres,
      averageRating AS rating, numVotes, 'imdb' AS source, coalesce(directors, '') AS directors,
      coalesce("cast", '') AS "cast", pos
      FROM chosen LEFT JOIN directed USING (tconst) LEFT JOIN acted USING (tconst))"""


def _catalog(spark, sf):
    return catalog_build(
        T.basics(spark, sf).drop("pos"), T.ratings(spark, sf), T.principals(spark, sf),
        T.names(spark, sf), T.CREDIT_ORDER, types=("F",), limit=4000,
        director_categories=("R",), actor_categories=("A", "N"), high=1500, low=500, since=1998)


@query("catalog_build", f"WITH {CATALOG} SELECT * EXCLUDE (pos) FROM built")
def _(spark, sf):
    return shown_items(_catalog(spark, sf))


MERGED = """critics AS (SELECT * REPLACE (coalesce(year, 0) AS year) FROM reviews),
    ty AS (SELECT lower(title) AS t, year, arg_max(reviews, pos) AS reviews,
      arg_max(critic, pos) AS critic, arg_max(rating, pos) AS rating, arg_max(url, pos) AS url
      FROM critics GROUP BY ALL),
    near AS (SELECT i.tconst, r.*, row_number() OVER (PARTITION BY i.tconst ORDER BY r.pos) AS rn
      FROM base i JOIN critics r ON lower(trim(r.title)) = lower(trim(i.title))
      AND (r.year = 0 OR abs(r.year - i.year) <= 1)),
    heads AS (SELECT imdb_id AS tconst, string_agg(nullif(headline, ''), '|' ORDER BY pos) AS headlines,
      coalesce(string_agg(nullif(snippet, ''), '|' ORDER BY pos), '') AS snippets
      FROM articles GROUP BY imdb_id),
    merged AS (SELECT b.tconst AS id, b.title, b.year, e.metascore, e.tomatometer, e.poster,
      nullif(e.plot, '') AS plot, h.headlines, h.snippets,
      coalesce(ty.reviews, n.reviews) AS critic_review, coalesce(ty.critic, n.critic) AS critic,
      CASE WHEN ty.t IS NOT NULL THEN ty.rating ELSE n.rating END AS critic_rating,
      coalesce(ty.url, n.url) AS critic_url, coalesce(ty.reviews, n.reviews) AS reviews,
      'imdb' || CASE WHEN e.imdb_id IS NOT NULL THEN '|omdb' ELSE '' END ||
        CASE WHEN h.tconst IS NOT NULL THEN '|nyt' ELSE '' END ||
        CASE WHEN ty.t IS NOT NULL OR n.tconst IS NOT NULL THEN '|rogerebert' ELSE '' END AS source
      FROM base b LEFT JOIN enrichment e ON e.imdb_id = b.tconst
      LEFT JOIN heads h USING (tconst)
      LEFT JOIN ty ON ty.t = lower(b.title) AND ty.year = b.year
      LEFT JOIN near n ON n.tconst = b.tconst AND n.rn = 1)"""


def _merged(spark, sf, base):
    merged = merge_entities(base, T.enrichment(spark, sf), T.customer_reviews(spark, sf),
                            T.articles(spark, sf))
    lists = {c: F.array_join(c, "|") for c in ("headlines", "snippets", "reviews", "source")}
    return merged.withColumns(lists)


MERGED_COLUMNS = ("id", "title", "year", "metascore", "tomatometer", "poster", "plot", "headlines",
                  "snippets", "critic_review", "critic", "critic_rating", "critic_url", "reviews",
                  "source")


@query("merge_entities", f"""WITH {T.BULK}, {T.SOURCES}, base AS (SELECT tconst, primaryTitle AS title,
      cast(startYear AS INTEGER) AS year FROM basics), {MERGED} SELECT * FROM merged""")
def _(spark, sf):
    # Half of the records name their columns as the bulk files do, half as the catalogue does.
    bulk, title, year = F.col("pos") % 2 == 0, F.col("primaryTitle"), F.col("startYear")
    base = T.basics(spark, sf).select(
        "tconst", F.when(bulk, title).otherwise("").alias("primaryTitle"), F.when(~bulk, title).alias("title"),
        F.when(bulk, year).alias("startYear"), F.when(~bulk, year.cast("int")).alias("year"), "pos")
    return _merged(spark, sf, base).select(*MERGED_COLUMNS)


@query("catalog_enrich", f"""WITH {CATALOG}, {T.SOURCES}, base AS (SELECT * FROM built), {MERGED}
    SELECT m.*, b.genres, b.directors, b."cast", b.rating, b.numVotes FROM merged m
    JOIN built b ON b.tconst = m.id""")
def _(spark, sf):
    built = _catalog(spark, sf).withColumn("pos", F.col("tconst").cast("bigint"))
    lists = {c: F.array_join(c, "|", "?") for c in ("genres", "directors", "cast")}
    return _merged(spark, sf, built).withColumns(lists).select(
        *MERGED_COLUMNS, "genres", "directors", "cast", "rating", "numVotes")
