"""The driver tables seen as catalogue sources. Each view has a DataFrame and a SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.retrieval.analysis import STOP_WORDS, TOKEN, Profile
from catalograph.retrieval.index import Index, bucket_count, build_index
from catalograph.operators.lists import attach_lists, ordered_lists
from catalograph.session import tune
from catalograph.sources.tables import read_table

FIRST_SENTENCE = "^[^.!?\\n]*"


HEAVY_TABLES = ("documents", "pages", "conversations", "orders")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    tune(spark)
    return read_table(spark, f"{sf}/{name}.parquet", heavy=name in HEAVY_TABLES)


# ---- documents as searched items ----

def items(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("id"), "turn", "text")
    reviews = ordered_lists(turns, "id", "text", ["turn"], "reviews")
    counts = turns.groupBy("id").agg(F.count("*").cast("int").alias("num_reviews"))
    docs = table(spark, sf, "documents")
    base = docs.select(
        F.col("doc_id").cast("string").alias("id"), F.lit(0).alias("part"),
        F.trim(F.regexp_extract("text", FIRST_SENTENCE, 0)).alias("title"),
        (1990 + F.col("doc_id") % 35).cast("int").alias("year"),
        F.array("lang", "source").alias("genres"), F.array("source").alias("directors"),
        F.array("lang").alias("cast"), F.col("source").alias("site"),
        (F.col("n_chars") % 100 / F.lit(10.0)).alias("rating"), F.col("text").alias("plot"),
        F.lit(None).cast("string").alias("poster"), F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("int").alias("tomatometer"))
    counted = base.join(counts, "id", "left").withColumn(
        "num_reviews", F.coalesce("num_reviews", F.lit(0)))
    return attach_lists(counted, reviews, "id", ["reviews"])


ITEMS = f"""review_lists AS (
  SELECT cast(conv_id AS VARCHAR) AS id, list(text ORDER BY turn) AS reviews
  FROM conversations GROUP BY conv_id),
items AS (
  SELECT cast(doc_id AS VARCHAR) AS id,
    trim(regexp_extract(text, '{FIRST_SENTENCE}', 0)) AS title,
    cast(1990 + doc_id % 35 AS INTEGER) AS year, [lang, source] AS genres,
    [source] AS directors, [lang] AS "cast", source AS site,
    cast(n_chars % 100 AS DOUBLE) / cast(10 AS DOUBLE) AS rating, text AS plot, reviews,
    cast(NULL AS VARCHAR) AS poster, cast(coalesce(len(reviews), 0) AS INTEGER) AS num_reviews
  FROM documents LEFT JOIN review_lists ON review_lists.id = cast(doc_id AS VARCHAR))"""

SQL_TOKEN = TOKEN.replace("'", "''")
SQL_STOPS = "(" + ", ".join(f"'{w}'" for w in STOP_WORDS) + ")"

TOKENS = f"""{ITEMS},
texts AS (
  SELECT id, 'title' AS field, 0 AS nth, title AS value FROM items
  UNION ALL SELECT id, 'plot', 0, plot FROM items
  UNION ALL SELECT cast(conv_id AS VARCHAR), 'reviews', turn, text FROM conversations
  WHERE conv_id IN (SELECT doc_id FROM documents)),
split AS (
  SELECT id, field, nth, regexp_extract_all(lower(value), '{SQL_TOKEN}') AS toks FROM texts
  WHERE value IS NOT NULL),
placed AS (
  SELECT id, field, toks, coalesce(sum(len(toks) + 100) OVER (PARTITION BY id, field ORDER BY nth
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM split),
words AS (
  SELECT id, field, unnest(toks) AS term,
    cast(start + generate_subscripts(toks, 1) - 1 AS BIGINT) AS pos FROM placed),
tokens AS (SELECT * FROM words WHERE term NOT IN {SQL_STOPS})"""

POSTINGS = f"""{TOKENS},
keywords AS (
  SELECT id, 'genres' AS field, unnest(genres) AS term,
    cast(generate_subscripts(genres, 1) - 1 AS BIGINT) AS pos FROM items
  UNION ALL SELECT id, 'directors', unnest(directors), 0 FROM items
  UNION ALL SELECT id, 'cast', unnest("cast"), 0 FROM items
  UNION ALL SELECT id, 'site', site, 0 FROM items WHERE site IS NOT NULL),
counted AS (
  SELECT id, field, term, count(*) AS tf, list(pos ORDER BY pos) AS positions
  FROM (SELECT * FROM tokens UNION ALL SELECT * FROM keywords) GROUP BY id, field, term),
postings AS (
  SELECT *, sum(tf) OVER (PARTITION BY id, field) AS dl FROM counted),
term_stats AS (SELECT field, term, count(*) AS df FROM postings GROUP BY field, term),
field_stats AS (
  SELECT field, count(*) AS n, cast(sum(dl) AS DOUBLE) / count(*) AS avgdl
  FROM (SELECT DISTINCT id, field, dl FROM postings) GROUP BY field),
scored AS (
  SELECT p.id, p.field, p.term, p.tf, t.df,
    ln(1 + (f.n - t.df + 0.5::DOUBLE) / (t.df + 0.5::DOUBLE)) *
    CASE WHEN p.field IN ('genres', 'directors', 'cast', 'site') THEN 1 / 2.2::DOUBLE
      ELSE p.tf / (p.tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * p.dl / f.avgdl)) END AS bm25
  FROM postings p JOIN term_stats t USING (field, term) JOIN field_stats f USING (field))"""

# ---- the same with Porter's stems, over the distinct words ----

_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_M0, _M1 = f"^({_C})?{_V}{_C}", f"^({_C})?{_V}{_C}{_V}{_C}"


def _rules(word: str, pairs, measure: str) -> str:
    """CASE that replaces the longest suffix of the (suffix, replacement) pairs that the word ends in."""
    whens = []
    for suffix, new in sorted(pairs, key=lambda p: -len(p[0])):
        rest = f"left({word}, length({word}) - {len(suffix)})"
        also = f" AND right({rest}, 1) IN ('s', 't')" if suffix == "ion" else ""
        whens.append(f"WHEN suffix({word}, '{suffix}') THEN CASE WHEN regexp_matches({rest}, '{measure}'){also} "
                     f"THEN {rest} || '{new}' ELSE {word} END")
    return f"CASE {' '.join(whens)} ELSE {word} END"


_SECOND = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
           ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
           ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
           ("iviti", "ive"), ("biliti", "ble"), ("logi", "log"))
_THIRD = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
_FOURTH = [(s, "") for s in ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
                             "ism", "ate", "iti", "ous", "ive", "ize")]

STEMS = f"""stem0 AS (SELECT DISTINCT term, CASE WHEN left(term, 1) = 'y' THEN 'Y' || substr(term, 2) ELSE term END AS w FROM unstemmed),
stem1 AS (SELECT term, CASE WHEN suffix(w, 'sses') OR suffix(w, 'ies') THEN left(w, length(w) - 2)
    WHEN suffix(w, 's') AND NOT suffix(w, 'ss') THEN left(w, length(w) - 1) ELSE w END AS w FROM stem0),
stem2 AS (SELECT term, w, CASE WHEN suffix(w, 'eed') THEN NULL WHEN suffix(w, 'ed') THEN left(w, length(w) - 2)
    WHEN suffix(w, 'ing') THEN left(w, length(w) - 3) END AS cut FROM stem1),
stem3 AS (SELECT term, CASE
    WHEN suffix(w, 'eed') THEN CASE WHEN regexp_matches(left(w, length(w) - 3), '{_M0}') THEN left(w, length(w) - 1) ELSE w END
    WHEN cut IS NULL OR NOT regexp_matches(cut, '^({_C})?[aeiouy]') THEN w
    WHEN suffix(cut, 'at') OR suffix(cut, 'bl') OR suffix(cut, 'iz') THEN cut || 'e'
    WHEN length(cut) > 1 AND substr(cut, -1) = substr(cut, -2, 1) AND substr(cut, -1) NOT IN ('a', 'e', 'i', 'o', 'u', 'l', 's', 'z')
      AND (substr(cut, -1) <> 'y' OR regexp_matches(cut, '[aeiou]y(yy)*$|[^aeiouy](yy)+$')) THEN left(cut, length(cut) - 1)
    WHEN regexp_matches(cut, '^{_C}[aeiouy][^aeiouwxy]$') THEN cut || 'e' ELSE cut END AS w FROM stem2),
stem4 AS (SELECT term, CASE WHEN suffix(w, 'y') AND regexp_matches(left(w, length(w) - 1), '^({_C})?[aeiouy]')
    THEN left(w, length(w) - 1) || 'i' ELSE w END AS w FROM stem3),
stem5 AS (SELECT term, {_rules('w', _SECOND, _M0)} AS w FROM stem4),
stem6 AS (SELECT term, {_rules('w', _THIRD, _M0)} AS w FROM stem5),
stem7 AS (SELECT term, {_rules('w', _FOURTH, _M1)} AS w FROM stem6),
stem8 AS (SELECT term, CASE WHEN suffix(w, 'e') AND (regexp_matches(left(w, length(w) - 1), '{_M1}')
    OR regexp_matches(left(w, length(w) - 1), '^({_C})?{_V}{_C}({_V})?$')
      AND NOT regexp_matches(left(w, length(w) - 1), '^{_C}[aeiouy][^aeiouwxy]$')) THEN left(w, length(w) - 1) ELSE w END AS w FROM stem7),
stem9 AS (SELECT term, CASE WHEN suffix(w, 'll') AND regexp_matches(w, '{_M1}') THEN left(w, length(w) - 1) ELSE w END AS w FROM stem8),
stems AS (SELECT term, CASE WHEN length(term) < 3 THEN term WHEN left(w, 1) = 'Y' THEN 'y' || substr(w, 2) ELSE w END AS stem FROM stem9)"""

TOKENS_STEMMED = TOKENS.replace("tokens AS (SELECT", "unstemmed AS (SELECT") + f""",
{STEMS},
tokens AS (SELECT id, field, CASE WHEN field = 'title' THEN term ELSE stem END AS term, pos FROM unstemmed JOIN stems USING (term))"""
POSTINGS_STEMMED = POSTINGS.replace(TOKENS, TOKENS_STEMMED)

def buckets(spark: SparkSession, sf: str, times: int = 1) -> int:
    """Buckets for an index that holds the texts of all items so many times over."""
    held = [table(spark, sf, name).agg(F.sum(F.octet_length("text"))).first()[0] or 0 for name in ("documents", "conversations")]
    return bucket_count(spark, times * sum(held))


_INDEXES: dict[tuple[str, str, bool], Index] = {}


def index(spark: SparkSession, sf: str, stem: bool = False) -> Index:
    """The index over all documents; built on first use and kept for the application's life."""
    key = (spark.sparkContext.applicationId, sf, stem)
    if key not in _INDEXES:
        _INDEXES[key] = build_index(items(spark, sf), Profile(stem=stem), buckets=buckets(spark, sf))
    return _INDEXES[key]


# ---- orders, line items and suppliers as bulk tables ----

def basics(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("tconst"),
        F.col("o_orderstatus").alias("titleType"),
        F.concat(F.lit("Order of "), F.col("o_custkey").cast("string")).alias("primaryTitle"),
        F.year("o_orderdate").cast("string").alias("startYear"),
        F.concat("o_orderstatus", F.lit(","), "o_orderpriority").alias("genres"),
        F.col("o_orderkey").alias("pos"))


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("tconst"),
        (F.floor(price) % 100 / F.lit(10.0)).alias("averageRating"),
        F.floor(price / 100).cast("int").alias("numVotes"))


def principals(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("tconst"), F.col("l_linenumber").alias("ordering"),
        F.col("l_suppkey").cast("string").alias("nconst"), F.col("l_returnflag").alias("category"),
        F.col("l_partkey").alias("line"))


def names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("nconst"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("primaryName"),
        F.col("s_suppkey").alias("pos"))


CREDIT_ORDER = ["ordering", "line", "nconst"]

BULK = """basics AS (
  SELECT cast(o_orderkey AS VARCHAR) AS tconst, o_orderstatus AS titleType,
    'Order of ' || o_custkey AS primaryTitle, cast(year(o_orderdate) AS VARCHAR) AS startYear,
    o_orderstatus || ',' || o_orderpriority AS genres, o_orderkey AS pos FROM orders),
ratings AS (
  SELECT cast(o_orderkey AS VARCHAR) AS tconst,
    cast(floor(o_totalprice) % 100 AS DOUBLE) / cast(10 AS DOUBLE) AS averageRating,
    cast(floor(o_totalprice / 100) AS INTEGER) AS numVotes FROM orders),
principals AS (
  SELECT cast(l_orderkey AS VARCHAR) AS tconst, l_linenumber AS ordering,
    cast(l_suppkey AS VARCHAR) AS nconst, l_returnflag AS category, l_partkey AS line
  FROM lineitem),
people AS (
  SELECT cast(s_suppkey AS VARCHAR) AS nconst,
    CASE WHEN s_acctbal >= 0 THEN s_name END AS primaryName FROM supplier)"""


# ---- enrichment, articles and reviews of orders ----

def enrichment(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("imdb_id"), F.col("quality").alias("metascore"),
        F.col("toxic").alias("tomatometer"),
        F.when(F.col("quality") == 1, F.concat(F.lit("poster "), F.col("doc_id"))).alias("poster"),
        F.when(F.col("toxic") == 1, F.lit("flagged")).otherwise(F.lit("")).alias("plot"),
        F.col("doc_id").alias("pos"))


def articles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("imdb_id"), F.col("role").alias("headline"),
        F.col("text").alias("abstract"),
        F.when(F.col("turn") % 2 == 1, F.col("role")).otherwise(F.lit("")).alias("snippet"),
        F.col("turn").alias("pos"))


def customer_reviews(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    year = (F.when(key % 11 == 0, F.lit(None)).when(key % 13 == 0, 0)
            .otherwise(1994 + key % 9).cast("int"))
    return table(spark, sf, "customer").select(
        F.concat(F.lit("order OF "), key.cast("string")).alias("title"), year.alias("year"),
        F.concat("c_mktsegment", F.lit(" says "), "c_name").alias("reviews"),
        F.col("c_name").alias("critic"), (key % 41 / F.lit(10.0)).alias("rating"),
        F.concat(F.lit("https://reviews.example.org/"), key.cast("string")).alias("url"),
        key.alias("pos"))


SOURCES = """enrichment AS (
  SELECT cast(doc_id AS VARCHAR) AS imdb_id, quality AS metascore, toxic AS tomatometer,
    CASE WHEN quality = 1 THEN 'poster ' || doc_id END AS poster,
    CASE WHEN toxic = 1 THEN 'flagged' ELSE '' END AS plot FROM labels),
articles AS (
  SELECT cast(conv_id AS VARCHAR) AS imdb_id, role AS headline, text AS abstract,
    CASE WHEN turn % 2 = 1 THEN role ELSE '' END AS snippet, turn AS pos FROM conversations),
reviews AS (
  SELECT 'order OF ' || c_custkey AS title,
    cast(CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 0
      ELSE 1994 + c_custkey % 9 END AS INTEGER) AS year,
    c_mktsegment || ' says ' || c_name AS reviews, c_name AS critic,
    cast(c_custkey % 41 AS DOUBLE) / cast(10 AS DOUBLE) AS rating,
    'https://reviews.example.org/' || c_custkey AS url, c_custkey AS pos FROM customer)"""


# ---- parts as titles with years ----

def part_titles(spark: SparkSession, sf: str) -> DataFrame:
    title = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(" "), F.upper("p_name"))).otherwise(
        F.col("p_name"))
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("id"), title.alias("title"),
        F.col("p_size").alias("year"), F.col("p_partkey").alias("pos"))


def part_reviews(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    year = F.when(size == 7, F.lit(None)).when(size % 25 == 0, 0).otherwise(size * 2).cast("int")
    return table(spark, sf, "part").select(
        F.col("p_name").alias("title"), year.alias("year"),
        F.concat("p_type", F.lit(" "), "p_brand").alias("reviews"), F.col("p_partkey").alias("pos"))


TITLES = """titles AS (
  SELECT cast(p_partkey AS VARCHAR) AS id,
    CASE WHEN p_size % 3 = 0 THEN ' ' || upper(p_name) ELSE p_name END AS title,
    p_size AS year, p_partkey AS pos FROM part),
recs AS (
  SELECT p_name AS title, cast(CASE WHEN p_size = 7 THEN NULL WHEN p_size % 25 = 0 THEN 0
      ELSE p_size * 2 END AS INTEGER) AS year,
    p_type || ' ' || p_brand AS reviews, p_partkey AS pos FROM part)"""
