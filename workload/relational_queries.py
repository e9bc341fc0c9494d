"""Projections, filters, joins, groupings, orders and sets over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalograph.operators import filters as P
from catalograph.operators import grouping as G
from catalograph.operators import joins as J
from catalograph.operators import lists as L
from catalograph.operators import ordering as O
from catalograph.operators import sets as U
from catalograph.plans.catalog import cast_lists
from catalograph.retrieval import request as R
from workload import tables as T
from workload.registry import query

ITEMS = f"WITH {T.ITEMS}"
SHOWN = "id, title, year, rating"
SHOWN_COLUMNS = SHOWN.split(", ")
TITLE_WORDS = f"""WITH {T.ITEMS}, every AS (SELECT id, unnest(regexp_extract_all(lower(title),
    '{T.SQL_TOKEN}')) AS t FROM items), w AS (SELECT * FROM every WHERE t NOT IN {T.SQL_STOPS})"""


def _items(spark, sf):
    return T.items(spark, sf)


def _joined(df, *names):
    return df.withColumns({n: F.array_join(n, "|") for n in names})


# ---- projections and filters ----

@query("project_fields", f"""{ITEMS} SELECT id, title, year, rating, array_to_string(genres, '|')
    AS genres, array_to_string(directors, '|') AS directors, array_to_string("cast", '|') AS "cast",
    plot, cast(NULL AS VARCHAR) AS url, site, poster FROM items""")
def _(spark, sf):
    return _joined(P.project_fields(_items(spark, sf), P_SIMILAR), "genres", "directors", "cast")


P_SIMILAR = ("id", "title", "year", "rating", "genres", "directors", "cast", "plot", "url", "site",
             "poster")


@query("drop_rename", """SELECT o_orderkey AS id, o_custkey, o_totalprice AS price, o_orderdate,
    o_orderpriority FROM orders""")
def _(spark, sf):
    return P.drop_rename(T.table(spark, sf, "orders"), ["o_orderstatus"],
                         {"o_orderkey": "id", "o_totalprice": "price"})


@query("match_all", f"{ITEMS} SELECT {SHOWN}, 1.0::DOUBLE AS score FROM items")
def _(spark, sf):
    return P.match_all(_items(spark, sf)).select(*SHOWN_COLUMNS, "score")


@query("filter_eq", f"""{ITEMS} SELECT {SHOWN} FROM items WHERE list_contains(genres, 'de')
    AND site = 'src3'""")
def _(spark, sf):
    kept = P.filter_eq(P.filter_eq(_items(spark, sf), "genres", "de"), "site", "src3")
    return kept.select(*SHOWN_COLUMNS)


@query("filter_in", f"""{ITEMS} SELECT {SHOWN} FROM items
    WHERE (list_contains(genres, 'src1') OR list_contains(genres, 'es')) AND year IN (1999, 2004)""")
def _(spark, sf):
    kept = P.filter_in(P.filter_in(_items(spark, sf), "genres", ["src1", "es"]), "year",
                       [1999, 2004])
    return kept.select(*SHOWN_COLUMNS)


@query("filter_range", f"{ITEMS} SELECT {SHOWN} FROM items WHERE rating BETWEEN 4.5 AND 6.5")
def _(spark, sf):
    return P.filter_range(_items(spark, sf), "rating", 4.5, 6.5).select(*SHOWN_COLUMNS)


@query("filter_conjunction", f"""{ITEMS} SELECT {SHOWN} FROM items WHERE year BETWEEN 1995 AND 2010
    AND rating BETWEEN 3 AND 10 AND (list_contains(genres, 'en') OR list_contains(genres, 'fr'))
    AND site = 'src2'""")
def _(spark, sf):
    return P.filter_conjunction(_items(spark, sf), {
        "year": (1995, 2010), "rating": (3.0, 10.0), "genres": ["en", "fr"],
        "site": "src2"}).select(*SHOWN_COLUMNS)


@query("filter_request_defaults", f"""{ITEMS} SELECT {SHOWN} FROM items
    WHERE year BETWEEN 2005 AND 2024 AND rating BETWEEN 8.0 AND 10.0""")
def _(spark, sf):
    filters = P.request_filters(year_min=" 2005 ", year_max=" ", rating_min="8.0")
    return P.filter_conjunction(_items(spark, sf), filters).select(*SHOWN_COLUMNS)


@query("filter_two_tier", f"""WITH {T.BULK} SELECT tconst, numVotes, cast(startYear AS INTEGER) AS year
    FROM basics JOIN ratings USING (tconst)
    WHERE numVotes > 3000 OR (cast(startYear AS INTEGER) >= 2000 AND numVotes > 1500)""")
def _(spark, sf):
    rated = (T.basics(spark, sf).join(T.ratings(spark, sf), "tconst")
             .select("tconst", "numVotes", F.col("startYear").cast("int").alias("year")))
    return P.filter_two_tier(rated, year="year", high=3000, low=1500, since=2000)


@query("filter_category", f"WITH {T.BULK} SELECT * FROM principals WHERE category IN ('A', 'N')")
def _(spark, sf):
    return P.filter_category(T.principals(spark, sf), "category", ("A", "N"))


@query("get_by_id", f"{ITEMS} SELECT {SHOWN} FROM items WHERE id = '17'")
def _(spark, sf):
    return P.get_by_id(_items(spark, sf), "17").select(*SHOWN_COLUMNS)


@query("prefix_match", f"""{TITLE_WORDS} SELECT {SHOWN} FROM items
    WHERE id IN (SELECT id FROM w WHERE starts_with(t, 'th'))""")
def _(spark, sf):
    return R.prefix_match(_items(spark, sf), "title", "Th").select(*SHOWN_COLUMNS)


@query("autocomplete", f"""{TITLE_WORDS} SELECT title, cast(year AS VARCHAR) AS year, id FROM items
    WHERE id IN (SELECT id FROM w WHERE starts_with(t, 'ere')) ORDER BY id LIMIT 10""")
def _(spark, sf):
    return R.autocomplete(T.index(spark, sf), " Ere ")


@query("presence_guard", f"{ITEMS} SELECT id, num_reviews FROM items WHERE reviews IS NOT NULL")
def _(spark, sf):
    return P.presence_guard(_items(spark, sf), "reviews").select("id", "num_reviews")


@query("response_ok", "SELECT o_orderkey, 'True' AS \"Response\" FROM orders WHERE o_orderstatus = 'F'")
def _(spark, sf):
    answers = T.table(spark, sf, "orders").select("o_orderkey", F.when(
        F.col("o_orderstatus") == "F", "True").otherwise("False").alias("Response"))
    return P.response_ok(answers)


# ---- joins ----

@query("join_inner", f"""WITH {T.BULK} SELECT tconst, primaryTitle, averageRating, numVotes
    FROM ratings JOIN basics USING (tconst)""")
def _(spark, sf):
    both = J.join_inner(T.ratings(spark, sf), T.basics(spark, sf), "tconst")
    return both.select("tconst", "primaryTitle", "averageRating", "numVotes")


@query("join_one_to_one", f"""WITH {T.BULK} SELECT tconst, titleType, numVotes
    FROM basics JOIN ratings USING (tconst)""")
def _(spark, sf):
    both = J.join_one_to_one(T.basics(spark, sf), T.ratings(spark, sf), "tconst")
    return both.select("tconst", "titleType", "numVotes")


@query("join_semi", f"""WITH {T.BULK} SELECT * FROM principals
    WHERE tconst IN (SELECT tconst FROM ratings WHERE numVotes > 3000)""")
def _(spark, sf):
    return J.join_semi(T.principals(spark, sf), T.ratings(spark, sf).where("numVotes > 3000"),
                       "tconst")


@query("join_lookup", f"""WITH {T.BULK} SELECT p.*, n.primaryName
    FROM principals p LEFT JOIN people n USING (nconst)""")
def _(spark, sf):
    return J.join_lookup(T.principals(spark, sf), T.names(spark, sf), "nconst", "primaryName", "pos")


@query("join_overlay", f"""WITH {T.ITEMS}, {T.SOURCES} SELECT id, i.title, e.metascore, e.tomatometer,
    CASE WHEN e.imdb_id IS NOT NULL THEN e.poster ELSE i.poster END AS poster,
    coalesce(nullif(e.plot, ''), i.plot) AS plot
    FROM items i LEFT JOIN enrichment e ON e.imdb_id = i.id""")
def _(spark, sf):
    base = _items(spark, sf).select("id", "title", "poster", "plot")
    return J.join_overlay(base, T.enrichment(spark, sf), "id").drop("enriched")


@query("join_one_to_many", f"""WITH {T.ITEMS}, {T.SOURCES}, g AS (SELECT imdb_id AS id,
      string_agg(nullif(headline, ''), '|' ORDER BY pos) AS headlines,
      string_agg(nullif(abstract, ''), '|' ORDER BY pos) AS abstracts,
      string_agg(nullif(snippet, ''), '|' ORDER BY pos) AS snippets
      FROM articles GROUP BY imdb_id)
    SELECT id, headlines, abstracts, CASE WHEN g.id IS NOT NULL THEN coalesce(snippets, '') END
    AS snippets FROM items LEFT JOIN g USING (id)""")
def _(spark, sf):
    recs = T.articles(spark, sf).withColumnRenamed("imdb_id", "id")
    both = J.join_one_to_many(_items(spark, sf).select("id", "part"), recs, "id",
                              ["headline", "abstract", "snippet"], "pos")
    return _joined(both, "headlines", "abstracts", "snippets").drop("part")


@query("join_title_year", f"""WITH {T.TITLES}, k AS (SELECT lower(title) AS t, year,
      arg_max(reviews, pos) AS reviews FROM recs WHERE year IS NOT NULL GROUP BY ALL)
    SELECT id, title, titles.year, k.reviews FROM titles
    LEFT JOIN k ON k.t = lower(title) AND k.year = titles.year""")
def _(spark, sf):
    return J.join_title_year(T.part_titles(spark, sf), T.part_reviews(spark, sf),
                             "reviews").drop("pos")


@query("title_year_lookup", f"""WITH {T.TITLES} SELECT lower(title) AS title_key, year,
    arg_max(id, pos) AS id FROM titles WHERE year <> 0 GROUP BY ALL""")
def _(spark, sf):
    return J.title_year_lookup(T.part_titles(spark, sf))


@query("join_year_tolerance", f"""WITH {T.TITLES},
    k AS (SELECT lower(title) AS t, year, arg_max(reviews, pos) AS reviews FROM recs
      WHERE year IS NOT NULL GROUP BY ALL),
    n AS (SELECT i.id, r.reviews, r.year, row_number() OVER (PARTITION BY i.id ORDER BY r.pos) AS rn
      FROM titles i JOIN recs r ON lower(trim(r.title)) = lower(trim(i.title))
      AND (r.year IS NULL OR r.year = 0 OR abs(r.year - i.year) <= 1))
    SELECT i.id, i.title, i.year, coalesce(k.reviews, n.reviews) AS reviews FROM titles i
    LEFT JOIN k ON k.t = lower(i.title) AND k.year = i.year
    LEFT JOIN n ON n.id = i.id AND n.rn = 1 AND n.year IS NOT NULL""")
def _(spark, sf):
    return J.join_year_tolerance(T.part_titles(spark, sf), T.part_reviews(spark, sf),
                                 ["reviews"]).drop("pos")


@query("join_anti", """SELECT o_orderkey FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def _(spark, sf):
    known = T.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.join_anti(T.table(spark, sf, "orders").select("o_orderkey"), known, "o_orderkey")


# ---- groupings ----

@query("collect_in_order", f"""WITH {T.BULK} SELECT tconst, 0 AS part, string_agg(coalesce(primaryName,
    '?'), '|' ORDER BY ordering, line, nconst) AS people
    FROM principals LEFT JOIN people USING (nconst) GROUP BY tconst""")
def _(spark, sf):
    named = J.join_lookup(T.principals(spark, sf), T.names(spark, sf), "nconst", "primaryName", "pos")
    lists = L.collect_in_order(named, "tconst", "primaryName", T.CREDIT_ORDER, "people")
    return lists.withColumn("people", F.array_join("people", "|", "?"))


@query("top_n_collect", f"""WITH {T.BULK}, b AS (SELECT *, row_number() OVER (PARTITION BY tconst
      ORDER BY ordering, line, nconst) AS rn FROM principals WHERE category IN ('A', 'N'))
    SELECT tconst, string_agg(coalesce(primaryName, '?'), '|' ORDER BY rn) AS "cast" FROM b
    LEFT JOIN people USING (nconst) WHERE rn <= 5 GROUP BY tconst""")
def _(spark, sf):
    lists = cast_lists(T.principals(spark, sf), T.names(spark, sf), T.CREDIT_ORDER, ("A", "N"))
    return lists.withColumn("cast", F.array_join("cast", "|", "?"))


@query("facet_terms", f"""{ITEMS}, v AS (SELECT DISTINCT id, unnest(genres) AS value FROM items
      WHERE rating >= 2) SELECT value, count(*) AS count FROM v GROUP BY value
    ORDER BY count DESC, value LIMIT 20""")
def _(spark, sf):
    return G.facet_terms(_items(spark, sf).where("rating >= 2"), "genres")


@query("facet_numeric", f"""{ITEMS} SELECT year AS value, count(*) AS count FROM items
    WHERE rating >= 2 GROUP BY year ORDER BY count DESC, value LIMIT 20""")
def _(spark, sf):
    return G.facet_terms(_items(spark, sf).where("rating >= 2"), "year")


@query("facet_values_all", f"""{ITEMS}, v AS (SELECT DISTINCT id, unnest(genres) AS value FROM items)
    SELECT value, count(*) AS count FROM v GROUP BY value ORDER BY count DESC, value LIMIT 50""")
def _(spark, sf):
    return R.facet_values(_items(spark, sf), "genres", 50)


@query("dedup_last_wins", """SELECT user_id, arg_max(event_id, event_id) AS event_id,
    arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value
    FROM events GROUP BY user_id""")
def _(spark, sf):
    rows = T.table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    return O.dedup_last_wins(rows, "user_id", "event_id")


@query("group_records", """SELECT conv_id, 0 AS part, string_agg(turn || ':' || role || ':' || text,
    '|' ORDER BY turn) AS records FROM conversations GROUP BY conv_id""")
def _(spark, sf):
    lists = L.group_records(T.table(spark, sf, "conversations"), "conv_id", "turn")
    told = F.transform("records", lambda r: F.concat_ws(":", r["turn"], r["role"], r["text"]))
    return lists.withColumn("records", F.array_join(told, "|"))


@query("num_found", f"{ITEMS} SELECT count(*) AS num_found FROM items WHERE rating >= 5")
def _(spark, sf):
    return G.num_found(_items(spark, sf).where("rating >= 5"))


@query("collection_stats", "SELECT count(*) AS total_docs FROM documents")
def _(spark, sf):
    return G.collection_stats(_items(spark, sf))


# ---- per-group orders ----

@query("top_n_per_group", f"""WITH {T.BULK}, r AS (SELECT *, row_number() OVER (PARTITION BY tconst
      ORDER BY ordering, line, nconst) AS rn FROM principals)
    SELECT tconst, ordering, nconst, category, line FROM r WHERE rn <= 5""")
def _(spark, sf):
    return O.top_n_per_group(T.principals(spark, sf), "tconst",
                             [F.col(c) for c in T.CREDIT_ORDER], 5)


@query("first_match_per_group", """SELECT user_id, min(event_id) AS event_id, arg_min(value, event_id)
    AS value FROM events WHERE event_type = 'error' GROUP BY user_id""")
def _(spark, sf):
    rows = T.table(spark, sf, "events").where("event_type = 'error'")
    return O.first_per_group(rows.select("user_id", "event_id", "value"), "user_id", "event_id")


@query("last_per_group", """SELECT o_custkey, max(o_orderkey) AS o_orderkey,
    arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY o_custkey""")
def _(spark, sf):
    rows = T.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return O.dedup_last_wins(rows, "o_custkey", "o_orderkey")


# ---- sorts and limits ----

@query("sort_field", f"{ITEMS} SELECT {SHOWN} FROM items ORDER BY rating DESC NULLS LAST, id")
def _(spark, sf):
    return O.sort_field(_items(spark, sf), "rating desc").select(*SHOWN_COLUMNS)


@query("sort_random_seeded", f"""{ITEMS} SELECT {SHOWN}, md5('42_' || id) AS shuffle FROM items
    ORDER BY shuffle DESC, id""")
def _(spark, sf):
    ordered = O.sort_random_seeded(_items(spark, sf), 42)
    return ordered.select(*SHOWN_COLUMNS, F.md5(F.concat(F.lit("42_"), "id")).alias("shuffle"))


@query("paginate", f"""{ITEMS} SELECT {SHOWN}, (SELECT cast(ceil(count(*) / 10) AS BIGINT) FROM items)
    AS total_pages FROM items ORDER BY year DESC NULLS LAST, id LIMIT 10 OFFSET 20""")
def _(spark, sf):
    items = _items(spark, sf).select(*SHOWN_COLUMNS)
    pages = G.num_found(items).select(O.total_pages("num_found").alias("total_pages"))
    page = O.paginate(items, O.sort_keys("year desc"), 3)
    return page.crossJoin(pages)          # one row: the count


@query("top_k_global", f"""WITH {T.BULK} SELECT tconst, numVotes FROM ratings
    ORDER BY numVotes DESC, tconst LIMIT 5000""")
def _(spark, sf):
    rows = T.ratings(spark, sf).select("tconst", "numVotes")
    return O.top_k_global(rows, [F.col("numVotes").desc(), F.col("tconst")], 5000, "numVotes")


@query("limit_new", """SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 800""")
def _(spark, sf):
    rows = T.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return O.first_rows(rows, [F.col("o_orderkey")], 800)


# ---- sets ----

@query("union_append", """SELECT n_nationkey AS key, n_name AS name, n_regionkey AS region FROM nation
    UNION ALL SELECT cast(s_suppkey AS INTEGER), s_name, NULL FROM supplier""")
def _(spark, sf):
    old = T.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"),
        F.col("n_regionkey").alias("region"))
    new = T.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("int").alias("key"), F.col("s_name").alias("name"))
    return U.union_append(old, new)


@query("difference_keys", """SELECT c_custkey AS o_custkey FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def _(spark, sf):
    keys = T.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return U.unseen(keys, T.table(spark, sf, "orders"), "o_custkey")


@query("distinct_urls", r"""SELECT DISTINCT regexp_replace(url, '[?#].*\z', '') AS url FROM pages""")
def _(spark, sf):
    urls = T.table(spark, sf, "pages").select(F.regexp_replace("url", r"[?#].*\z", "").alias("url"))
    return U.distinct_values(urls, "url")
