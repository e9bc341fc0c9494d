"""Text analysis, index tables and ranked search over all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalograph.operators.ordering import first_rows, sort_relevance
from catalograph.retrieval import analysis as A
from catalograph.retrieval import similar as S
from catalograph.retrieval import scoring as X
from catalograph.retrieval.highlight import highlight_fragment, result_page
from catalograph.retrieval.index import build_index, fetch_items, field_stats, token_rows
from catalograph.retrieval.refresh import refresh_index
from catalograph.retrieval.request import SearchRequest, get_with_similar, search
from workload import tables as T
from workload.registry import query

WORDS = "therly ndstnd thanha"
PHRASE = "der und"
SEED = "12"
POSTINGS = f"WITH {T.POSTINGS}"
KEYWORDS = "('genres', 'directors', 'cast')"


# ---- analysis ----

@query("analyze_title", f"""WITH {T.ITEMS} SELECT id, coalesce(array_to_string(list_filter(
    regexp_extract_all(lower(title), '{T.SQL_TOKEN}'), lambda t: t NOT IN {T.SQL_STOPS}), ' '), '')
    AS terms FROM items""")
def _(spark, sf):
    return T.items(spark, sf).select("id", F.array_join(A.analyze_title("title"), " ").alias("terms"))


@query("analyze_general", f"""WITH {T.TOKENS} SELECT field, term, count(*) AS n, min(pos) AS first_pos,
    max(pos) AS last_pos FROM tokens GROUP BY field, term""")
def _(spark, sf):
    rows = token_rows(T.items(spark, sf), A.PLAIN).where(F.col("field").isin(list(A.TEXT_FIELDS)))
    return rows.groupBy("field", "term").agg(
        F.count("*").alias("n"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))


@query("analyze_general_stemmed", f"""WITH {T.TOKENS_STEMMED}
    SELECT i.id, coalesce(string_agg(term, ' ' ORDER BY pos), '') AS terms FROM items i
    LEFT JOIN (SELECT * FROM tokens WHERE field = 'plot') t ON t.id = i.id GROUP BY i.id""")
def _(spark, sf):
    return T.items(spark, sf).select("id", F.array_join(A.analyze_general("plot"), " ").alias("terms"))


@query("analyze_keyword", f"WITH {T.ITEMS} SELECT id, unnest(genres) AS term FROM items")
def _(spark, sf):
    return A.analyze_keyword(T.items(spark, sf), "genres")


@query("catch_all", f"""WITH {T.ITEMS} SELECT id, concat_ws(' ', title, plot,
    array_to_string(reviews, ' '), array_to_string(genres, ' '), array_to_string(directors, ' '),
    array_to_string("cast", ' ')) AS text FROM items""")
def _(spark, sf):
    return T.items(spark, sf).select("id", A.catch_all().alias("text"))


# ---- index tables ----

@query("build_postings", f"""{POSTINGS} SELECT id, field, term, tf, cast(dl AS BIGINT) AS dl,
    array_to_string(positions, ' ') AS positions FROM postings""")
def _(spark, sf):
    return T.index(spark, sf).postings.select(
        "id", "field", "term", "tf", "dl", F.array_join(F.col("positions").cast("array<string>"),
                                                        " ").alias("positions"))


@query("corpus_stats", f"""{POSTINGS} SELECT field, '' AS term, n, round(avgdl, 6) AS avgdl
    FROM field_stats UNION ALL SELECT field, term, df, NULL FROM term_stats""")
def _(spark, sf):
    index = T.index(spark, sf)
    fields = field_stats(index.postings).select(
        "field", F.lit("").alias("term"), "n", F.round("avgdl", 6).alias("avgdl"))
    return fields.unionByName(index.term_stats.select(
        "field", "term", F.col("df").alias("n"), F.lit(None).cast("double").alias("avgdl")))


EVERY = "src3 1999 de 4.2"


# All fields once more as one general field, numbers included, searched for words of several of them.
@query("catch_all_every", f"""WITH {T.ITEMS},
    every AS (SELECT id, unnest(list_filter([id, title, cast(year AS VARCHAR), site, cast(rating AS VARCHAR), plot,
      cast(num_reviews AS VARCHAR)] || genres || directors || "cast" || coalesce(reviews, []), lambda v: v IS NOT NULL)) AS v FROM items),
    terms AS (SELECT id, unnest(regexp_extract_all(lower(v), '{T.SQL_TOKEN}')) AS term FROM every),
    counted AS (SELECT id, term, count(*) AS tf FROM terms WHERE term NOT IN {T.SQL_STOPS} GROUP BY id, term),
    measured AS (SELECT *, sum(tf) OVER (PARTITION BY id) AS dl, count(*) OVER (PARTITION BY term) AS df FROM counted),
    whole AS (SELECT count(DISTINCT id) AS n, cast(sum(tf) AS DOUBLE) / count(DISTINCT id) AS avgdl FROM counted)
    SELECT id, round(sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE))
      * tf / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))), 6) AS score
    FROM measured, whole WHERE term IN ('src3', '1999', 'de', '4.2') GROUP BY id""")
def _(spark, sf):
    items = T.items(spark, sf)
    index = build_index(items, A.Profile(stem=False, every_field=True), buckets=T.buckets(spark, sf, 2))
    return X.search_field(index, A.EVERY_FIELD, EVERY)


# An index of the documents as they were, some of them with another text or not there yet, brought up to date.
@query("index_refresh", f"""{POSTINGS} SELECT field, '' AS term, n, round(avgdl, 6) AS avgdl
    FROM field_stats UNION ALL SELECT field, term, df, NULL FROM term_stats
    UNION ALL SELECT field, id, cast(sum(tf) AS BIGINT), sum(hash_of) FROM (SELECT field, id, tf,
      cast(list_sum(positions) AS DOUBLE) AS hash_of FROM postings) GROUP BY field, id""")
def _(spark, sf):
    items = T.items(spark, sf)
    number = F.col("id").cast("long")
    stale = items.withColumn("plot", F.when(number % 97 == 5, F.lit("an earlier text")).otherwise(F.col("plot"))).where(
        (number % 89 != 7) | (F.col("part") > 0))
    index = refresh_index(build_index(stale, A.PLAIN, buckets=T.buckets(spark, sf)), items.where((number % 97 == 5) | (number % 89 == 7)))
    fields = field_stats(index.postings).select(
        "field", F.lit("").alias("term"), "n", F.round("avgdl", 6).alias("avgdl"))
    terms = index.term_stats.select("field", "term", F.col("df").alias("n"), F.lit(None).cast("double").alias("avgdl"))
    places = F.aggregate("positions", F.lit(0).cast("bigint"), lambda a, x: a + x).cast("double")
    rows = index.postings.groupBy("field", F.col("id").alias("term")).agg(F.sum("tf").alias("n"), F.sum(places).alias("avgdl"))
    return fields.unionByName(terms).unionByName(rows)


# ---- ranked search ----

def _terms(text: str) -> str:
    return "(" + ", ".join(f"'{t}'" for _, t in A.PLAIN.query_terms(text, "plot")) + ")"


def _weighted(text: str, name: str = "weighted") -> str:
    """Best boosted field per word, summed; the whole text against whole-value fields."""
    return f"""boosts AS (SELECT * FROM (VALUES ('title', 10), ('cast', 5), ('directors', 5),
      ('plot', 2), ('reviews', 2), ('genres', 1)) AS b(field, boost)),
    {name}_best AS (SELECT id, slot, max(boost * bm25) AS s FROM (
        SELECT id, field, bm25, CASE WHEN field IN {KEYWORDS} THEN '*' ELSE term END AS slot
        FROM scored WHERE (field NOT IN {KEYWORDS} AND term IN {_terms(text)})
          OR (field IN {KEYWORDS} AND term = '{text}')) JOIN boosts USING (field)
      GROUP BY id, slot),
    {name} AS (SELECT id, sum(s) AS base FROM {name}_best GROUP BY id)"""


def _phrase(text: str) -> str:
    """Best boosted phrase score per item over the text fields and the whole-value fields."""
    words = A.PLAIN.query_terms(text, "plot")
    terms = ", ".join(f"('{t}', {p - words[0][0]})" for p, t in words)
    return f"""phrase_terms AS (SELECT * FROM (VALUES {terms}) AS t(term, shift)),
    phrase_boosts AS (SELECT * FROM (VALUES ('title', 25), ('cast', 10), ('directors', 10),
      ('plot', 3), ('reviews', 3)) AS b(field, boost)),
    starts AS (SELECT id, field, pos - shift AS start FROM tokens JOIN phrase_terms USING (term)
      GROUP BY ALL HAVING count(*) = {len(words)}),
    phrases AS (SELECT id, field, count(*) AS tf FROM starts GROUP BY id, field),
    phrase_idf AS (SELECT field, sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE))) AS w
      FROM term_stats JOIN field_stats USING (field) JOIN phrase_terms USING (term) GROUP BY field),
    phrase_scores AS (
      SELECT p.id, p.field, w * p.tf / (p.tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * d.dl / avgdl))
        AS s FROM phrases p JOIN phrase_idf USING (field) JOIN field_stats USING (field)
        JOIN (SELECT DISTINCT id, field, dl FROM postings) d ON d.id = p.id AND d.field = p.field
      UNION ALL SELECT id, field, bm25 FROM scored
        WHERE field IN ('cast', 'directors') AND term = '{text}' AND {len(words)} > 1),
    boosted AS (SELECT id, max(boost * s) AS extra FROM phrase_scores
      JOIN phrase_boosts USING (field) GROUP BY id)"""


def _full(text: str) -> str:
    return f"""{T.POSTINGS}, {_weighted(text)}, {_phrase(text)},
    ranked AS (SELECT id, round(base + coalesce(extra, 0), 6) AS score FROM weighted
      LEFT JOIN boosted USING (id))"""


@query("search_field", f"""{POSTINGS} SELECT id, round(sum(bm25), 6) AS score FROM scored
    WHERE field = 'plot' AND term IN {_terms(WORDS)} GROUP BY id""")
def _(spark, sf):
    return X.search_field(T.index(spark, sf), "plot", WORDS)


@query("sort_relevance", f"""{POSTINGS} SELECT id, round(sum(bm25), 6) AS score FROM scored
    WHERE field = 'reviews' AND term IN {_terms("le de und")} GROUP BY id ORDER BY score DESC, id""")
def _(spark, sf):
    return sort_relevance(X.search_field(T.index(spark, sf), "reviews", "le de und"))


@query("search_weighted", f"""WITH {T.POSTINGS}, {_weighted(WORDS)}
    SELECT id, round(base, 6) AS score FROM weighted""")
def _(spark, sf):
    return X.search_weighted(T.index(spark, sf), WORDS)


@query("search_weighted_keyword", f"""WITH {T.POSTINGS}, {_weighted('src3')}
    SELECT id, round(base, 6) AS score FROM weighted""")
def _(spark, sf):
    return X.search_weighted(T.index(spark, sf), "src3")


def _weighted_stemmed(text: str) -> str:
    """As ``_weighted`` where a word has a term of its own in each field."""
    terms = ", ".join(f"('{f}', '{t}', '{p}', {boost})" for f, boost in (("title", 10), ("plot", 2), ("reviews", 2))
                      for p, t in A.STEMMED.query_terms(text, f))
    whole = ", ".join(f"('{f}', '{text}', '*', {boost})" for f, boost in (("cast", 5), ("directors", 5), ("genres", 1)))
    return f"""wanted AS (SELECT * FROM (VALUES {terms}, {whole}) AS w(field, term, slot, boost)),
    weighted_best AS (SELECT id, slot, max(boost * bm25) AS s FROM scored JOIN wanted USING (field, term) GROUP BY id, slot),
    weighted AS (SELECT id, sum(s) AS base FROM weighted_best GROUP BY id)"""


@query("search_weighted_stemmed", f"""WITH {T.POSTINGS_STEMMED}, {_weighted_stemmed(WORDS)}
    SELECT id, round(base, 6) AS score FROM weighted""")
def _(spark, sf):
    return X.search_weighted(T.index(spark, sf, stem=True), WORDS)


@query("search_phrase_boost", f"WITH {_full(PHRASE)} SELECT id, score FROM ranked")
def _(spark, sf):
    return X.search_phrase_boost(T.index(spark, sf), PHRASE)


def _passing() -> str:
    return "year BETWEEN 1995 AND 2024 AND rating BETWEEN 2.0 AND 10.0"


FACETED = SearchRequest.from_form(WORDS, year_min="1995", rating_min="2.0")


@query("search_faceted", f"""WITH {_full(WORDS)},
    matched AS (SELECT i.*, score FROM items i JOIN ranked USING (id) WHERE {_passing()}),
    hits AS (SELECT id, score FROM matched ORDER BY score DESC, id LIMIT 10),
    genre AS (SELECT value, count(*) AS n FROM (SELECT DISTINCT id, unnest(genres) AS value
      FROM matched) GROUP BY value ORDER BY n DESC, value LIMIT 20),
    years AS (SELECT year AS value, count(*) AS n FROM matched GROUP BY year
      ORDER BY n DESC, value LIMIT 20)
    SELECT 'hit' AS section, id AS value, score, cast(NULL AS BIGINT) AS n FROM hits
    UNION ALL SELECT 'found', '', NULL, count(*) FROM matched
    UNION ALL SELECT 'genres', value, NULL, n FROM genre
    UNION ALL SELECT 'year', cast(value AS VARCHAR), NULL, n FROM years""")
def _(spark, sf):
    result = search(T.index(spark, sf), FACETED, keep=False)
    none, no_score = F.lit(None).cast("bigint"), F.lit(None).cast("double")
    hits = result.page.select(F.lit("hit").alias("section"), F.col("id").alias("value"), "score", none.alias("n"))
    section = F.when(F.col("facet") == "", F.lit("found")).otherwise(F.col("facet")).alias("section")
    return hits.unionByName(result.summary.select(section, "value", no_score.alias("score"), F.col("count").alias("n")))


@query("boolean_terms", f"""WITH {T.POSTINGS}, {_weighted('ndstnd', 'need')},
    first AS (SELECT id, base AS s FROM need),
    second AS (SELECT id, sum(bm25) AS s FROM scored WHERE field = 'plot' AND term = 'thanha'
      GROUP BY id),
    barred AS (SELECT DISTINCT id FROM postings WHERE field = 'genres' AND term = 'src3')
    SELECT id, round(first.s + coalesce(second.s, 0), 6) AS score FROM first
    LEFT JOIN second USING (id) WHERE id NOT IN (SELECT id FROM barred)""")
def _(spark, sf):
    return X.boolean_terms(T.index(spark, sf), must=[X.Clause("ndstnd")],
                           should=[X.Clause("thanha", "plot")],
                           must_not=[X.Clause("src3", "genres")])


@query("boolean_phrase", f"""WITH {T.POSTINGS}, {_phrase('eres thst')}
    SELECT id, round(s, 6) AS score FROM phrase_scores WHERE field = 'plot'""")
def _(spark, sf):
    return X.boolean_terms(T.index(spark, sf), must=[X.Clause("eres thst", "plot", phrase=True)])


def _fragment(terms: str, text: str, source: str) -> str:
    """Best 200-character slice of ``text`` with matched words marked, per row of ``source``."""
    return f"""slices AS (
      SELECT id, i, substr(t, i * 200 + 1, 200) AS slice FROM (
        SELECT id, {text} AS t, unnest(range(greatest(cast(ceil(length({text}) / 200) AS BIGINT), 1)))
          AS i FROM {source})),
    counted_slices AS (SELECT id, i, slice, len(list_filter(regexp_extract_all(lower(slice),
        '{T.SQL_TOKEN}'), lambda t: t IN {terms})) AS hits FROM slices),
    best AS (SELECT id, arg_max(slice, hits * 1000000 - i) AS slice, max(hits) AS hits
      FROM counted_slices GROUP BY id),
    fragments AS (SELECT id, CASE WHEN hits > 0 THEN array_to_string(list_transform(
        regexp_extract_all(slice, '(?s){T.SQL_TOKEN}|.'), lambda p: CASE WHEN lower(p) IN {terms}
          THEN '<mark>' || p || '</mark>' ELSE p END), '') ELSE {text} END AS fragment
      FROM best JOIN {source} USING (id))"""


@query("highlight_fragment", f"""WITH {T.ITEMS}, {_fragment(_terms(WORDS), 'plot', 'items')}
    SELECT id, fragment FROM fragments""")
def _(spark, sf):
    marked = highlight_fragment(T.items(spark, sf), "plot", WORDS, A.PLAIN)
    return marked.select("id", "fragment")


def _stemming_to(text: str) -> str:
    """Words whose stem is one of the query's."""
    stems = ", ".join(f"'{t}'" for _, t in A.STEMMED.query_terms(text, "plot"))
    return f"(SELECT list(term) FROM stems WHERE stem IN ({stems}))"


@query("highlight_fragment_stemmed", f"""WITH {T.TOKENS_STEMMED}, chosen AS (SELECT {_stemming_to(WORDS)} AS words),
    marked_items AS (SELECT id, plot, words FROM items, chosen),
    slices AS (SELECT id, i, words, substr(plot, i * 200 + 1, 200) AS slice FROM (SELECT *,
        unnest(range(greatest(cast(ceil(length(plot) / 200) AS BIGINT), 1))) AS i FROM marked_items)),
    counted_slices AS (SELECT id, i, slice, len(list_filter(regexp_extract_all(lower(slice), '{T.SQL_TOKEN}'),
        lambda t: list_contains(words, t))) AS hits FROM slices),
    best AS (SELECT id, arg_max(slice, hits * 1000000 - i) AS slice, max(hits) AS hits FROM counted_slices GROUP BY id)
    SELECT id, CASE WHEN hits > 0 THEN array_to_string(list_transform(regexp_extract_all(slice, '(?s){T.SQL_TOKEN}|.'),
        lambda p: CASE WHEN list_contains(words, lower(p)) THEN '<mark>' || p || '</mark>' ELSE p END), '') ELSE plot END
      AS fragment FROM best JOIN marked_items USING (id)""")
def _(spark, sf):
    marked = highlight_fragment(T.items(spark, sf), "plot", WORDS, A.STEMMED)
    return marked.select("id", "fragment")


@query("result_page", f"""WITH {_full(WORDS)},
    hits AS (SELECT i.*, score FROM items i JOIN ranked USING (id) ORDER BY score DESC, id LIMIT 10),
    {_fragment(_terms(WORDS), 'plot', 'hits')}
    SELECT id, title, score, fragment AS highlighted_plot, coalesce(reviews[1], '') AS review,
      CASE WHEN length(fragment) > 300 THEN substr(fragment, 1, 300) || '...' ELSE fragment END
      AS snippet FROM hits JOIN fragments USING (id)""")
def _(spark, sf):
    index = T.index(spark, sf)
    ranked = X.search_phrase_boost(index, WORDS)
    hits = first_rows(ranked, [F.col("score").desc(), F.col("id")], 10)
    shown = result_page(fetch_items(index, hits), WORDS, A.PLAIN)
    review = F.coalesce(F.get("reviews", F.lit(0)), F.lit(""))
    return shown.select("id", "title", "score", "highlighted_plot", review.alias("review"), "snippet")


@query("entry_search_page")
def _(spark, sf):
    return search(T.index(spark, sf), SearchRequest(WORDS), keep=False).page.select(
        "id", "title", "year", "rating", "snippet", "score")


# ---- similar items ----

def _seed_terms(seeds: str) -> str:
    return f"""weighted_terms AS (
      SELECT id AS seed, field, term, df, round(tf * (1 + ln(((SELECT count(*) FROM items) + 1) /
        (df + 1)::DOUBLE)), 9) AS weight FROM postings JOIN term_stats USING (field, term)
      WHERE field <> 'site' AND id IN ({seeds})),
    top_terms AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seed
        ORDER BY weight DESC, field, term) AS rn FROM weighted_terms) WHERE rn <= 25)"""


def _like(k: int, factor: str = "1") -> str:
    return f"""like_scores AS (
      SELECT seed, id, round(sum(bm25 * {factor}), 6) AS score FROM scored
      JOIN (SELECT *, max(weight) OVER (PARTITION BY seed) AS top FROM top_terms) USING (field, term)
      WHERE id <> seed GROUP BY seed, id),
    liked AS (SELECT seed, id, score FROM (SELECT *, row_number() OVER (PARTITION BY seed
        ORDER BY score DESC, id) AS rn FROM like_scores) WHERE rn <= {k})"""


ONE_SEED = f"{_seed_terms(repr(SEED))}"
BENCH_SEEDS = _seed_terms("SELECT cast(item_id AS VARCHAR) FROM benchmark")


@query("mlt_terms", f"""WITH {T.POSTINGS}, {ONE_SEED}
    SELECT seed, field, term, df, weight FROM top_terms""")
def _(spark, sf):
    return S.mlt_terms(T.index(spark, sf), [SEED])


@query("mlt_terms_stemmed", f"""WITH {T.POSTINGS_STEMMED}, {ONE_SEED}
    SELECT seed, field, term, df, weight FROM top_terms""")
def _(spark, sf):
    return S.mlt_terms(T.index(spark, sf, stem=True), [SEED])


@query("more_like_this", f"WITH {T.POSTINGS}, {ONE_SEED}, {_like(10)} SELECT * FROM liked")
def _(spark, sf):
    return S.more_like_this(T.index(spark, sf), SEED, k=10)


@query("more_like_this_boosted", f"""WITH {T.POSTINGS}, {ONE_SEED}, {_like(5, 'weight / top')}
    SELECT * FROM liked""")
def _(spark, sf):
    return S.more_like_this(T.index(spark, sf), SEED, k=5, boost=True)


@query("similar_items", f"""WITH {T.POSTINGS}, {ONE_SEED}, {_like(10)}
    SELECT seed, score, i.id, title, year, rating, array_to_string(genres, '|') AS genres,
      array_to_string(directors, '|') AS directors, array_to_string("cast", '|') AS "cast", plot, site
    FROM liked JOIN items i ON i.id = liked.id""")
def _(spark, sf):
    found = S.similar_items(T.index(spark, sf), SEED, k=10).drop("url", "poster")
    return found.withColumns({c: F.array_join(c, "|") for c in ("genres", "directors", "cast")})


def _seeds(spark, sf):
    return T.table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("id"))


@query("more_like_this_batch", f"""WITH {T.POSTINGS}, {BENCH_SEEDS}, {_like(5)}
    SELECT * FROM liked""")
def _(spark, sf):
    return S.more_like_this_batch(T.index(spark, sf), _seeds(spark, sf), k=5)


@query("similar_items_batch", f"""WITH {T.POSTINGS}, {BENCH_SEEDS}, {_like(5)}
    SELECT seed, score, i.id, title, year, rating, array_to_string(genres, '|') AS genres, plot, site
    FROM liked JOIN items i ON i.id = liked.id""")
def _(spark, sf):
    found = S.similar_items_batch(T.index(spark, sf), _seeds(spark, sf), k=5).withColumn("genres", F.array_join("genres", "|"))
    return found.select("seed", "score", "id", "title", "year", "rating", "genres", "plot", "site")


# every document is a seed
@query("more_like_this_every", f"""WITH {T.POSTINGS}, {_seed_terms("SELECT id FROM items")}, {_like(3)}
    SELECT * FROM liked""")
def _(spark, sf):
    return S.more_like_this_batch(T.index(spark, sf), T.items(spark, sf).where("part = 0").select("id"), k=3)


@query("more_like_this_stemmed", f"WITH {T.POSTINGS_STEMMED}, {ONE_SEED}, {_like(10)} SELECT * FROM liked")
def _(spark, sf):
    return S.more_like_this(T.index(spark, sf, stem=True), SEED, k=10)


@query("get_with_similar", f"""WITH {T.POSTINGS}, {ONE_SEED}, {_like(5, 'weight / top')}
    SELECT i.id, i.title, i.year, (SELECT string_agg(l.id || '=' || printf('%.3f', score) || '=' || o.year
      || '=' || o.title, ' ' ORDER BY score DESC, l.id) FROM liked l JOIN items o ON o.id = l.id) AS similar
    FROM items i WHERE i.id = '{SEED}'""")
def _(spark, sf):
    found = get_with_similar(T.index(spark, sf), SEED)
    similar = F.transform("similar", lambda s: F.concat(
        s["id"], F.lit("="), F.format_string("%.3f", s["score"]), F.lit("="), s["year"].cast("string"),
        F.lit("="), s["title"]))
    return found.select("id", "title", "year", F.array_join(similar, " ").alias("similar"))
