"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalograph.functions import scalars as S
from catalograph.operators.grouping import provenance
from catalograph.operators.ordering import cap_list
from catalograph.operators.sets import ordered_distinct
from catalograph.operators.pages import make_document
from catalograph.plans.catalog import assemble_items, cast_lists, director_lists
from catalograph.plans.merge import format_enrichment
from workload import tables as T
from workload.registry import query

SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
CLEAN = f"trim(regexp_replace(%s, '{SPACE}+', ' ', 'g'))"


def _docs(spark, sf):
    return T.table(spark, sf, "documents")


@query("clean_text", f"SELECT doc_id, {CLEAN % 'text'} AS cleaned FROM documents")
def _(spark, sf):
    return _docs(spark, sf).select("doc_id", S.clean_text("text").alias("cleaned"))


@query("extract_year", """SELECT doc_id, try_cast(nullif(regexp_extract(
    text, '(?:19|20)[0-9]{2}', 0), '') AS INTEGER) AS year FROM documents""")
def _(spark, sf):
    return _docs(spark, sf).select("doc_id", S.extract_year("text").alias("year"))


@query("normalize_rating", """SELECT p_partkey, round_even(
    cast(p_size AS DOUBLE) / 2 / 4 * 10, 1) AS of_four, CASE WHEN p_size % 5 = 0 THEN 0.0::DOUBLE
    ELSE round_even(p_retailprice / (p_size % 5) * 10, 1) END AS of_varying FROM part""")
def _(spark, sf):
    return T.table(spark, sf, "part").select(
        "p_partkey", S.normalize_rating(F.col("p_size") / F.lit(2.0), 4.0).alias("of_four"),
        S.normalize_rating("p_retailprice", (F.col("p_size") % 5).cast("double")).alias(
            "of_varying"))


@query("hash_id", """SELECT doc_id, substr(md5(text), 1, 12) AS plain,
    source || '_' || substr(md5(text || '_' || doc_id), 1, 12) AS by_source,
    'site_' || substr(md5(text), 1, 12) AS prefixed FROM documents""")
def _(spark, sf):
    return _docs(spark, sf).select(
        "doc_id", S.hash_id("text").alias("plain"),
        F.concat_ws("_", "source", S.hash_id(F.concat("text", F.lit("_"), F.col("doc_id")))).alias(
            "by_source"), S.hash_id("text", "site").alias("prefixed"))


@query("extract_number", """SELECT doc_id, try_cast(nullif(replace(regexp_extract(
    text, '[0-9,]+', 0), ',', ''), '') AS BIGINT) AS number FROM documents""")
def _(spark, sf):
    return _docs(spark, sf).select("doc_id", S.extract_number("text").alias("number"))


@query("split_clean", f"""SELECT doc_id, array_to_string(list_filter(list_transform(
    string_split(text, ','), lambda x: regexp_replace(x, '^{SPACE}+|{SPACE}+\\z', '', 'g')),
    lambda x: x <> ''), '|') AS pieces FROM documents""")
def _(spark, sf):
    return _docs(spark, sf).select(
        "doc_id", F.array_join(S.split_clean("text"), "|").alias("pieces"))


@query("truncate_words", r"""SELECT doc_id, CASE WHEN length(text) <= 500 THEN text ELSE
    regexp_replace(substr(text, 1, 500), ' [^ ]*\z', '') || '...' END AS short FROM documents""")
def _(spark, sf):
    return _docs(spark, sf).select("doc_id", S.truncate_words("text", 500).alias("short"))


@query("truncate_chars", f"""SELECT doc_id,
    CASE WHEN length(text) <= 300 THEN text ELSE substr(text, 1, 300) || '...' END AS plain,
    CASE WHEN length(text) <= 200 THEN text ELSE regexp_replace(substr(text, 1, 200),
      '^{SPACE}+|{SPACE}+\\z', '', 'g') || '...' END AS trimmed FROM documents""")
def _(spark, sf):
    return _docs(spark, sf).select("doc_id", S.truncate_chars("text", 300).alias("plain"),
                                   S.truncate_chars("text", 200, trim=True).alias("trimmed"))


@query("make_document", f"""WITH {T.ITEMS} SELECT
    'library_' || substr(md5(title || '_' || year || '_library'), 1, 12) AS id, title, year,
    'library' AS site, cast(NULL AS VARCHAR) AS url, rating, array_to_string(genres, '|') AS genres,
    '' AS directors, array_to_string("cast", '|') AS "cast", plot,
    coalesce(reviews[1], '') AS reviews, num_reviews FROM items""")
def _(spark, sf):
    docs = T.items(spark, sf).select(
        "title", "year", "url", "rating", "genres",
        F.lit(None).cast("array<string>").alias("directors"), "cast", "plot",
        S.first_or_blank("reviews").alias("reviews"), "num_reviews")
    made = make_document(docs, "library")
    return made.withColumns({c: F.array_join(c, "|") for c in ("genres", "directors", "cast")})


@query("title_year_key", """SELECT p_partkey, lower(p_name) || '_' || p_size AS title_key
    FROM part""")
def _(spark, sf):
    return T.table(spark, sf, "part").select(
        "p_partkey", S.title_year_key("p_name", "p_size").alias("title_key"))


@query("digits_int", r"""WITH w AS (SELECT event_id, regexp_extract(props, ': *([^}]*)', 1) AS v
    FROM events) SELECT event_id,
    CASE WHEN regexp_matches(v, '^[0-9]+\z') THEN try_cast(v AS INTEGER) END AS digits,
    CASE WHEN regexp_matches(props, '^[0-9]+\z') THEN 1 END AS no_digits FROM w
    JOIN events USING (event_id)""")
def _(spark, sf):
    return T.table(spark, sf, "events").select(
        "event_id", S.digits_int(F.regexp_extract("props", ": *([^}]*)", 1)).alias("digits"),
        S.digits_int("props").alias("no_digits"))


@query("try_year", """SELECT p_partkey, try_cast(trim(CASE WHEN p_size % 4 = 0 THEN p_name
    ELSE ' ' || (1960 + p_size) END) AS INTEGER) AS year FROM part""")
def _(spark, sf):
    raw = F.when(F.col("p_size") % 4 == 0, F.col("p_name")).otherwise(
        F.concat(F.lit(" "), (1960 + F.col("p_size")).cast("string")))
    return T.table(spark, sf, "part").select("p_partkey", S.try_year(raw).alias("year"))


def _raw_ratings():
    """Ratings as the enrichment service words them, from a part's numbers."""
    size = F.col("p_size")

    def entry(source, value):
        return F.struct(F.lit(source).alias("Source"), value.alias("Value"))

    return F.array_compact(F.array(
        entry("Internet Movie Database",
              F.concat((size / F.lit(10.0)).cast("string"), F.lit("/10"))),
        entry("Rotten Tomatoes", F.concat(size.cast("string"), F.lit("%"))),
        F.when(size % 2 == 0, entry("Metacritic", F.concat(size.cast("string"), F.lit("/100")))),
        F.when(size % 3 == 0, entry("Rotten Tomatoes",
                                    F.concat((size + 1).cast("string"), F.lit("%"))))))


@query("parse_ratings", """SELECT p_partkey, cast(p_size AS DOUBLE) / cast(10 AS DOUBLE) AS rating,
    CASE WHEN p_size % 3 = 0 THEN p_size + 1 ELSE p_size END AS tomatometer,
    CASE WHEN p_size % 2 = 0 THEN p_size END AS metascore FROM part""")
def _(spark, sf):
    return T.table(spark, sf, "part").select(
        "p_partkey", S.parse_ratings(_raw_ratings()).alias("r")).select("p_partkey", "r.*")


@query("format_enrichment", """SELECT 'omdb_' || p_partkey AS id, cast(p_partkey AS VARCHAR) AS imdb_id,
    p_name AS title, CASE WHEN p_size % 4 <> 0 THEN 1960 + p_size END AS year,
    p_type || '|' || p_brand AS genres, p_name AS plot, CASE WHEN p_size % 5 = 0 THEN ''
    ELSE p_brand END AS directors, p_brand || '|' || p_name AS "cast", 'omdb' AS source,
    'https://www.imdb.com/title/' || p_partkey || '/' AS url, 'N/A' AS poster,
    CASE WHEN p_size % 2 = 0 THEN p_size END AS metascore,
    CASE WHEN p_size % 3 = 0 THEN p_size + 1 ELSE p_size END AS tomatometer,
    cast(p_size AS DOUBLE) / cast(10 AS DOUBLE) AS rating FROM part WHERE p_type <> 'PROMO'""")
def _(spark, sf):
    size = F.col("p_size")
    year = (1960 + size).cast("string")
    raw = T.table(spark, sf, "part").select(
        F.when(F.col("p_type") != "PROMO", "True").otherwise("False").alias("Response"),
        F.col("p_partkey").cast("string").alias("imdbID"), F.col("p_name").alias("Title"),
        F.when(size % 4 == 0, F.concat(year, F.lit("–2012"))).otherwise(year).alias("Year"),
        F.concat_ws(", ", "p_type", "p_brand").alias("Genre"), F.col("p_name").alias("Plot"),
        F.when(size % 5 != 0, F.col("p_brand")).alias("Director"),
        F.concat_ws(", ", "p_brand", "p_name").alias("Actors"), F.lit("N/A").alias("Poster"),
        _raw_ratings().alias("Ratings"))
    return format_enrichment(raw).withColumns(
        {c: F.array_join(c, "|") for c in ("genres", "directors", "cast")})


@query("split_list_field", """SELECT doc_id, array_to_string(list_filter(string_split(text, ','),
    lambda x: x <> ''), '|') AS genres, array_to_string(string_split(text, ', '), '|') AS people
    FROM documents""")
def _(spark, sf):
    return _docs(spark, sf).select(
        "doc_id", F.array_join(S.split_list_field("text", ",", True), "|").alias("genres"),
        F.array_join(S.split_list_field("text", ", "), "|").alias("people"))


@query("prefix_id", "SELECT 'imdb_' || o_orderkey AS base_id, 'omdb_' || o_orderkey AS other_id FROM orders")
def _(spark, sf):
    key = F.col("o_orderkey").cast("string")
    return T.table(spark, sf, "orders").select(
        S.prefix_id(key, "imdb").alias("base_id"), S.prefix_id(key, "omdb").alias("other_id"))


@query("item_url", "SELECT 'https://www.imdb.com/title/' || o_orderkey || '/' AS url FROM orders")
def _(spark, sf):
    return T.table(spark, sf, "orders").select(
        S.item_url(F.col("o_orderkey").cast("string")).alias("url"))


@query("resolve_url", r"""WITH p AS (SELECT page_id, url,
    regexp_extract(url, '^[a-z]+://[^/?#]*', 0) AS origin,
    regexp_replace(url, '[?#].*\z', '') AS bare FROM pages)
    SELECT page_id, origin || '/a/' || page_id AS rooted,
    regexp_replace(bare, '[^/]*\z', '') || 'next.html' AS relative,
    regexp_extract(url, '^([a-z]+):', 1) || '://cdn.example.org/x' AS other_host,
    bare || '?page=2' AS query_only, 'mailto:a@example.org' AS absolute,
    origin || regexp_replace(regexp_replace(regexp_replace(substr(bare, length(origin) + 1), '[^/]*\z', ''), '[^/]+/\z', ''), '^\z', '/')
      || 'up.html?x=../y' AS above, origin || '/c' || page_id || '/' AS dotted FROM p""")
def _(spark, sf):
    base = F.col("url")
    return T.table(spark, sf, "pages").select(
        "page_id", S.resolve_url(base, F.concat(F.lit("/a/"), F.col("page_id"))).alias("rooted"),
        S.resolve_url(base, F.lit("next.html")).alias("relative"),
        S.resolve_url(base, F.lit("//cdn.example.org/x")).alias("other_host"),
        S.resolve_url(base, F.lit("?page=2")).alias("query_only"),
        S.resolve_url(base, F.lit("mailto:a@example.org")).alias("absolute"),
        S.resolve_url(base, F.lit("./../up.html?x=../y")).alias("above"),
        S.resolve_url(base, F.concat(F.lit("/a/./b/../../../c"), F.col("page_id"), F.lit("/x/.."))).alias("dotted"))


@query("url_is_review", r"""SELECT page_id, regexp_matches(regexp_extract(url,
    '^[a-z]+://[^/?#]*([^?#]*)', 1), '^/en/') AS is_english_path,
    length(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)) -
    length(replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '-', '')) >= 2 AND
    starts_with(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/reviews/') AS is_review
    FROM pages""")
def _(spark, sf):
    return T.table(spark, sf, "pages").select(
        "page_id", S.url_is_review("url", "/en/", 0).alias("is_english_path"),
        S.url_is_review("url").alias("is_review"))


@query("date_part_before_T", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day
    FROM orders""")
def _(spark, sf):
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return T.table(spark, sf, "orders").select("o_orderkey", S.date_part(stamp).alias("day"))


@query("star_class_rating", """SELECT p_partkey, CASE WHEN p_size % 7 <> 0 THEN
    cast(p_size AS DOUBLE) / cast(10 AS DOUBLE) END AS stars FROM part""")
def _(spark, sf):
    size = F.col("p_size")
    classes = F.concat(F.lit("filled "), F.when(size % 7 == 0, F.lit("starry")).otherwise(
        F.concat(F.lit("star"), size.cast("string"))), F.lit(" small"))
    return T.table(spark, sf, "part").select("p_partkey", S.star_class_rating(classes).alias("stars"))


@query("snippet", f"""WITH {T.ITEMS}, s AS (SELECT id, coalesce(nullif(CASE WHEN num_reviews > 2
    THEN '' ELSE plot END, ''), nullif(reviews[1], ''), '') AS t FROM items)
    SELECT id, CASE WHEN length(t) > 300 THEN substr(t, 1, 300) || '...' ELSE t END AS snippet
    FROM s""")
def _(spark, sf):
    plot = F.when(F.col("num_reviews") > 2, F.lit("")).otherwise(F.col("plot"))
    return T.items(spark, sf).select(
        "id", S.snippet(plot, S.first_or_blank("reviews")).alias("snippet"))


@query("truncate_list", f"""WITH {T.ITEMS} SELECT id,
    array_to_string(coalesce(reviews, [])[1:5], '|') AS first_five FROM items""")
def _(spark, sf):
    return T.items(spark, sf).select(
        "id", F.array_join(S.truncate_list("reviews"), "|").alias("first_five"))


@query("join_with_comma", f"""WITH {T.ITEMS} SELECT id, coalesce(array_to_string(genres, ', '), '')
    AS genres, coalesce(array_to_string(reviews, ', '), '') AS reviews FROM items""")
def _(spark, sf):
    return T.items(spark, sf).select("id", S.join_with_comma("genres").alias("genres"),
                                     S.join_with_comma("reviews").alias("reviews"))


@query("format_rating", f"""WITH {T.ITEMS} SELECT id, CASE WHEN rating = 0 THEN ''
    ELSE printf('%.1f/10', rating) END AS shown FROM items""")
def _(spark, sf):
    return T.items(spark, sf).select("id", S.format_rating("rating").alias("shown"))


@query("capitalize", """SELECT doc_id, upper(substr(text, 1, 1)) || lower(substr(text, 2)) AS shown
    FROM documents""")
def _(spark, sf):
    return _docs(spark, sf).select("doc_id", S.capitalize("text").alias("shown"))


@query("first_or_scalar", f"WITH {T.ITEMS} SELECT id, coalesce(reviews[1], '') AS review FROM items")
def _(spark, sf):
    return T.items(spark, sf).select("id", S.first_or_blank("reviews").alias("review"))


@query("poster_or_null", """SELECT doc_id, CASE WHEN quality = 1 AND toxic = 0
    THEN 'poster ' || doc_id END AS poster FROM labels""")
def _(spark, sf):
    raw = (F.when(F.col("toxic") == 1, F.lit("N/A")).when(F.col("quality") == 0, F.lit(""))
           .otherwise(F.concat(F.lit("poster "), F.col("doc_id"))))
    return T.table(spark, sf, "labels").select("doc_id", S.poster_or_null(raw).alias("poster"))


@query("highlight_terms", """SELECT doc_id, regexp_replace(regexp_replace(text, '(?i)(that)',
    '<mark>\\1</mark>', 'g'), '(?i)(ion\\.)', '<mark>\\1</mark>', 'g') AS marked FROM documents
    """.replace("\\\\", "\\"))
def _(spark, sf):
    return _docs(spark, sf).select(
        "doc_id", S.highlight_terms("text", ["that", "ion."]).alias("marked"))


@query("assemble_item", f"""WITH {T.BULK}, named AS (
      SELECT p.*, n.primaryName FROM principals p LEFT JOIN people n USING (nconst)),
    directed AS (
      SELECT tconst, list(primaryName ORDER BY ordering, line, nconst) AS directors FROM named
      WHERE category = 'R' GROUP BY tconst),
    billed AS (
      SELECT *, row_number() OVER (PARTITION BY tconst ORDER BY ordering, line, nconst) AS rn
      FROM named WHERE category IN ('A', 'N')),
    acted AS (
      SELECT tconst, list(primaryName ORDER BY rn) AS "cast" FROM billed WHERE rn <= 5
      GROUP BY tconst)
    SELECT 'imdb_' || tconst AS id, tconst, primaryTitle AS title,
      cast(startYear AS INTEGER) AS year, replace(genres, ',', '|') AS genres,
      averageRating AS rating, numVotes, 'imdb' AS source,
      coalesce(array_to_string(list_transform(directors, lambda x: coalesce(x, '?')), '|'), '') AS directors,
      coalesce(array_to_string(list_transform("cast", lambda x: coalesce(x, '?')), '|'), '') AS "cast"
    FROM basics JOIN ratings USING (tconst) LEFT JOIN directed USING (tconst)
    LEFT JOIN acted USING (tconst)""")
def _(spark, sf):
    titles = T.basics(spark, sf).drop("pos").join(T.ratings(spark, sf), "tconst")
    credits, names = T.principals(spark, sf), T.names(spark, sf)
    built = assemble_items(
        titles, director_lists(credits, names, T.CREDIT_ORDER, ("R",)),
        cast_lists(credits, names, T.CREDIT_ORDER, ("A", "N")))
    return shown_items(built)


def shown_items(built):
    lists = {c: F.array_join(c, "|", "?") for c in ("genres", "directors", "cast")}
    return built.withColumns(lists).drop("part", "plot", "runtimeMinutes")


@query("falsy_fallback", """SELECT doc_id, coalesce(nullif(CASE WHEN quality = 1 THEN '' ELSE 'low'
    END, ''), CASE WHEN toxic = 1 THEN 'toxic' ELSE '' END) AS word,
    coalesce(nullif(quality, 0), toxic) AS number FROM labels""")
def _(spark, sf):
    word = F.when(F.col("quality") == 1, F.lit("")).otherwise(F.lit("low"))
    other = F.when(F.col("toxic") == 1, F.lit("toxic")).otherwise(F.lit(""))
    return T.table(spark, sf, "labels").select(
        "doc_id", S.falsy_fallback(word, other).alias("word"),
        S.falsy_fallback("quality", "toxic", kind="int").alias("number"))


@query("overlay_values", """SELECT d.doc_id,
    CASE WHEN l.doc_id IS NOT NULL THEN CASE WHEN l.quality = 1 THEN 'new' END ELSE d.lang END
      AS overwritten,
    CASE WHEN l.doc_id IS NOT NULL AND l.quality = 1 THEN 'new' ELSE d.lang END AS kept
    FROM documents d LEFT JOIN labels l USING (doc_id)""")
def _(spark, sf):
    labels = T.table(spark, sf, "labels").withColumn("hit", F.lit(True))
    joined = _docs(spark, sf).join(labels, "doc_id", "left")
    hit = F.coalesce("hit", F.lit(False))
    new = F.when(F.col("quality") == 1, F.lit("new"))
    return joined.select("doc_id", S.overlay_values("lang", new, hit).alias("overwritten"),
                         S.overlay_values("lang", new, hit, "truthy").alias("kept"))


@query("facet_pairs", """SELECT doc_id, lang || '=' || n_chars AS pairs FROM documents""")
def _(spark, sf):
    flat = F.array("lang", F.col("n_chars").cast("string"), "source")
    pairs = F.transform(S.facet_pairs(flat), lambda p: F.concat(
        p["value"], F.lit("="), p["count"].cast("string")))
    return _docs(spark, sf).select("doc_id", F.array_join(pairs, ",").alias("pairs"))


@query("provenance", """SELECT doc_id, 'imdb' || CASE WHEN quality = 1 THEN '|omdb' ELSE '' END ||
    CASE WHEN toxic = 1 THEN '|nyt' ELSE '' END AS sources FROM labels""")
def _(spark, sf):
    sources = provenance("imdb", {"omdb": F.col("quality") == 1, "nyt": F.col("toxic") == 1})
    return T.table(spark, sf, "labels").select("doc_id", F.array_join(sources, "|").alias("sources"))


@query("cap_per_page", """SELECT page_id, array_to_string(regexp_extract_all(html,
    'href="([^"]*)"', 1)[1:50], ' ') AS links FROM pages""")
def _(spark, sf):
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    return T.table(spark, sf, "pages").select(
        "page_id", F.array_join(cap_list(links), " ").alias("links"))


@query("ordered_distinct", f"""WITH w AS (
      SELECT doc_id, unnest(regexp_extract_all(lower(text), '{T.SQL_TOKEN}')) AS t,
        generate_subscripts(regexp_extract_all(lower(text), '{T.SQL_TOKEN}'), 1) AS i
      FROM documents),
    f AS (SELECT doc_id, t, min(i) AS i FROM w GROUP BY doc_id, t)
    SELECT doc_id, string_agg(t, ' ' ORDER BY i) AS words FROM f GROUP BY doc_id""")
def _(spark, sf):
    words = F.regexp_extract_all(F.lower("text"), F.lit(T.TOKEN), F.lit(0))
    return (_docs(spark, sf).select("doc_id", F.array_join(ordered_distinct(words), " ").alias(
        "words")).where("words <> ''"))
