"""Extraction from all stored pages.

The rules point at the elements these pages have; the default rules are covered by unit tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalograph.functions import markup as M
from catalograph.functions.markup import PageRules, Sel
from catalograph.operators import pages as H
from catalograph.plans.reviews import collect_reviews
from workload import tables as T
from workload.registry import query

RULES = PageRules(
    base_url="https://pages.example.org", link_contains="/", link_path="/", link_hyphens=0,
    link_block=(Sel("article"), Sel("nav")), teaser=(Sel("h1"), Sel("li")),
    next_head=Sel("a", "href", "/an", "contains"), next_link=Sel("a", "href", "/que", "contains"),
    next_block=Sel("nav"), more_text="der",
    rating_meta=Sel("meta", "charset", "utf-8"), star_span=Sel("html"),
    date_meta=Sel("meta", "name", "date"), date_spans=(Sel("footer"),),
    author_links=(Sel("a", "href", "/", "contains"),), titles=(M.by_class("page-title", "h1"), Sel("h1")),
    decks=(M.by_class("ad"),), bodies=(M.by_class("review__body", "div"), Sel("article")),
    credit_area=Sel("body"), credit_column=Sel("nav"), credit_heading=Sel("li"),
    primary_heading=Sel("ul"), credit_item=Sel("li"), genre_link=Sel("a"), genre_skip=("the", "de"),
    info_item=Sel("article"), info_label=Sel("h1"), info_value=Sel("p"),
    genre_labels=None, director_labels=None, cast_labels=None)

S = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"


def _clean(x: str) -> str:
    return f"trim(regexp_replace({x}, '{S}+', ' ', 'g'))"


def _decoded(x: str) -> str:
    for name, char in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "''''"),
                       ("&nbsp;", "chr(160)"), ("&amp;", "'&'")):
        x = f"replace({x}, '{name}', {char})"
    return x


def _text(x: str) -> str:
    return _decoded(f"regexp_replace({x}, '(?s)<[^>]*>', '', 'g')")


def _nodes(x: str, separator: str = " ") -> str:
    marked = _decoded(f"regexp_replace({x}, '(?s)<[^>]*>', chr(1), 'g')")
    return (f"array_to_string(list_filter(list_transform(string_split({marked}, chr(1)), lambda n: "
            f"regexp_replace(n, '^{S}+|{S}+\\z', '', 'g')), lambda n: n <> ''), '{separator}')")


PAGES = r"""prepared AS (SELECT page_id, url, regexp_replace(html,
    '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g') AS page FROM pages)"""
H1 = "regexp_extract(page, '(?is)<h1>(.*?)</h1>', 1)"
ARTICLE = "regexp_extract(page, '(?is)<article>(.*?)</article>', 1)"
TITLE = _clean(_text(H1))
AD = "regexp_extract(page, '(?is)<div class=\"ad\">(.*?)</div>', 1)"
SUMMARY = _clean(_nodes(AD))
NAV = "regexp_extract(page, '(?is)<nav>(.*?)</nav>', 1)"
ANCHOR = "<a href=\"[^\"]*\">.*?</a>"
FIRST_LINK = _clean(_text(f"regexp_extract(page, '(?is){ANCHOR}', 0)"))
FOOTER = _clean(_text("regexp_extract(page, '(?is)<footer>(.*?)</footer>', 1)"))
BLOCKS = M.BLOCK_TAGS
BODY = f"""list_filter(list_transform(string_split(regexp_replace({ARTICLE}, '(?i)<p(?:\\s[^>]*)?>',
    chr(2), 'g'), chr(2))[2:], lambda c: {_nodes(
        f"regexp_extract(c, '(?is)^(.*?)(?:</?(?:{BLOCKS})(?:[ /][^>]*)?>|$)', 1)")}),
    lambda p: p <> '')""".replace("|$)", "|\\z)")
BODY = f"array_to_string({BODY}, ' ')"
LINKS = f"""anchors AS (
    SELECT page_id, i, regexp_extract(a, 'href="([^"]*)"', 1) AS href, a FROM (
      SELECT page_id, unnest(regexp_extract_all(page, '(?is){ANCHOR}')) AS a,
        generate_subscripts(regexp_extract_all(page, '(?is){ANCHOR}'), 1) AS i FROM prepared)),
  resolved AS (
    SELECT page_id, i, CASE WHEN regexp_matches(href, '^[a-z]+:') THEN href
      ELSE 'https://pages.example.org' || href END AS link, {_clean(_text('a'))} AS title
    FROM anchors WHERE contains(href, '/')),
  listed AS (
    SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS place FROM (
      SELECT *, row_number() OVER (PARTITION BY page_id, link ORDER BY i) AS nth FROM resolved)
    WHERE nth = 1)"""


def _pages(spark, sf):
    return T.table(spark, sf, "pages")


def _field(spark, sf, name, read):
    return H.prepared(_pages(spark, sf), RULES).select("page_id", read(F.col("page"), RULES).alias(name))


@query("page_links", f"""WITH {PAGES}, {LINKS}
    SELECT page_id, cast(place AS INTEGER) AS place, link AS url,
      CASE WHEN title = '' THEN 'Untitled Review' ELSE title END AS title,
      coalesce(try_cast(nullif(regexp_extract(title, '(?:19|20)[0-9]{{2}}', 0), '') AS INTEGER),
        try_cast(nullif(regexp_extract({_clean(_text("regexp_extract(page, '(?is)<li>(.*?)</li>', 1)"))},
          '(?:19|20)[0-9]{{2}}', 0), '') AS INTEGER)) AS year
    FROM listed JOIN prepared USING (page_id) WHERE place < 50""")
def _(spark, sf):
    return H.page_links(_pages(spark, sf), RULES).drop("summary")


@query("link_summary", f"""WITH {PAGES}, {LINKS} SELECT page_id, link AS url,
    {_clean(_text("regexp_extract(page, '(?is)<li>(.*?)</li>', 1)"))} AS summary
    FROM listed JOIN prepared USING (page_id) WHERE place < 50""")
def _(spark, sf):
    return H.link_summary(_pages(spark, sf), RULES)


_HEAD = "regexp_extract(page, '(?is)<a href=\"([^\"]*/an[^\"]*)\"', 1)"
_NEXT = "regexp_extract(page, '(?is)<a href=\"([^\"]*/que[^\"]*)\"', 1)"
_FIRST = f"regexp_extract({NAV}, '(?is)<a href=\"([^\"]*)\"', 1)"
NEXT = f"""found AS (
    SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*', 0) AS origin,
      list_distinct(list_filter([{_HEAD}, CASE WHEN {_NEXT} <> '' THEN {_NEXT} ELSE {_FIRST} END,
        (SELECT arg_min(regexp_extract(a, 'href="([^"]*)"', 1), i) FROM (
          SELECT unnest(regexp_extract_all(page, '(?is){ANCHOR}')) AS a,
            generate_subscripts(regexp_extract_all(page, '(?is){ANCHOR}'), 1) AS i)
          WHERE contains({_text('a')}, 'der'))], lambda h: h <> '')) AS hrefs
    FROM prepared),
  nexts AS (SELECT DISTINCT page_id, CASE WHEN starts_with(h, '/') THEN origin || h ELSE h END AS next_url
    FROM (SELECT page_id, origin, unnest(hrefs) AS h FROM found))"""
NEXT_RULES = RULES.__class__(**{**RULES.__dict__, "base_url": "http"})


@query("next_pages", f"WITH {PAGES}, {NEXT} SELECT page_id, next_url FROM nexts")
def _(spark, sf):
    return H.next_pages(_pages(spark, sf), NEXT_RULES)


@query("frontier_expand", f"""WITH {PAGES}, {NEXT}, queued AS (
      SELECT DISTINCT next_url FROM nexts JOIN labels ON doc_id = page_id WHERE quality = 1)
    SELECT DISTINCT next_url AS url FROM nexts WHERE next_url NOT IN (SELECT next_url FROM queued)
      AND next_url NOT IN (SELECT url FROM pages)""")
def _(spark, sf):
    pages = _pages(spark, sf)
    good = T.table(spark, sf, "labels").where("quality = 1").select(F.col("doc_id").alias("page_id"))
    queued = H.next_pages(pages.join(good, "page_id", "left_semi"), NEXT_RULES)
    frontier = queued.select(F.col("next_url").alias("url")).distinct()
    return H.expand_frontier(pages, frontier, NEXT_RULES)


# Listings made from the stored pages: each names a page of half its number as next, and page 0 names itself.
@query("crawl", """WITH RECURSIVE listed AS (SELECT DISTINCT page_id, page_id // 2 AS next_id FROM pages),
    reached AS (SELECT page_id, 0 AS hop FROM listed WHERE page_id % 3 = 1
      UNION SELECT next_id, hop + 1 FROM reached JOIN listed USING (page_id) WHERE hop < 64)
    SELECT 'http://list.example.org/' || page_id AS url, cast(min(hop) AS INTEGER) AS hop FROM reached GROUP BY page_id""")
def _(spark, sf):
    number = F.col("page_id")
    listing = _pages(spark, sf).select(
        "page_id", F.concat(F.lit("http://list.example.org/"), number).alias("url"),
        F.concat(F.lit('<html><head><link rel="next" href="/x/../'), F.floor(number / 2), F.lit('"></head><body>'),
                 F.substring("html", 1, 200), F.lit("</body></html>")).alias("html"))
    return H.crawl(listing, listing.where("page_id % 3 = 1").select("url"), PageRules(base_url="http://list.example.org"))


@query("page_rating", """SELECT page_id, cast(NULL AS DOUBLE) AS rating FROM pages""")
def _(spark, sf):
    return _field(spark, sf, "rating", M.page_rating)


@query("page_rating_numbers", """WITH n AS (SELECT page_id, try_cast(regexp_extract(html,
      '<a href="/([^"]*)"', 1) AS DOUBLE) AS linked FROM pages)
    SELECT page_id, coalesce(linked, cast(page_id % 50 AS DOUBLE) / cast(10 AS DOUBLE)) AS rating FROM n""")
def _(spark, sf):
    starred = _pages(spark, sf).select("page_id", "url", F.concat(
        F.lit('<meta itemprop="ratingValue" content="'),
        F.regexp_extract("html", '<a href="/([^"]*)"', 1), F.lit('"/>'), "html",
        F.lit('<div class="star-box big"><div>'), F.lit('<img class="filled star'),
        (F.col("page_id") % 50).cast("string"), F.lit('"></div></div>')).alias("html"))
    rules = PageRules()
    return H.prepared(starred, rules).select(
        "page_id", M.page_rating(F.col("page"), rules).alias("rating"))


# Every third page has no star image but a star span, whose number is a word on every seventh page.
@query("page_rating_span", """SELECT page_id, CASE WHEN page_id % 3 <> 0 THEN cast(page_id % 50 AS DOUBLE) / cast(10 AS DOUBLE)
    WHEN page_id % 7 <> 0 THEN cast(page_id % 9 AS DOUBLE) / cast(2 AS DOUBLE) END AS rating FROM pages""")
def _(spark, sf):
    number = F.col("page_id")
    box = F.concat(F.lit('<div class="star-box"><img class="filled star'), (number % 50).cast("string"), F.lit('"></div>'))
    value = F.when(number % 7 == 0, F.lit("n/a")).otherwise((number % 9 / F.lit(2.0)).cast("string"))
    starred = _pages(spark, sf).select("page_id", "url", F.concat(
        "html", F.when(number % 3 != 0, box).otherwise(F.lit("")), F.lit('<p><span data-rating="'), value,
        F.lit('" class="big star-rating">stars</span>')).alias("html"))
    rules = PageRules()
    return H.prepared(starred, rules).select("page_id", M.page_rating(F.col("page"), rules).alias("rating"))


@query("page_date", f"WITH {PAGES} SELECT page_id, {FOOTER} AS review_date FROM prepared")
def _(spark, sf):
    return _field(spark, sf, "review_date", M.page_date)


@query("page_author", f"WITH {PAGES} SELECT page_id, {FIRST_LINK} AS critic FROM prepared")
def _(spark, sf):
    return _field(spark, sf, "critic", M.page_author)


@query("page_title", f"WITH {PAGES} SELECT page_id, {TITLE} AS title FROM prepared")
def _(spark, sf):
    return _field(spark, sf, "title", M.page_title)


@query("page_summary", f"WITH {PAGES} SELECT page_id, {SUMMARY} AS summary FROM prepared")
def _(spark, sf):
    return _field(spark, sf, "summary", M.page_summary)


NAV_TEXTS = f"""navs AS (
    SELECT page_id, i, {_clean(_text('a'))} AS t FROM (
      SELECT page_id, unnest(regexp_extract_all({NAV}, '(?is)<a href="[^"]*">.*?</a>')) AS a,
        generate_subscripts(regexp_extract_all({NAV}, '(?is)<a href="[^"]*">.*?</a>'), 1) AS i
      FROM prepared))"""
GENRES = """genres AS (SELECT page_id, string_agg(t, '|' ORDER BY i) AS genres FROM (
    SELECT page_id, t, min(i) AS i FROM navs WHERE t <> '' AND lower(t) NOT IN ('the', 'de')
    GROUP BY page_id, t) GROUP BY page_id)"""
CREDITS = """credits AS (SELECT page_id, string_agg(t, '|' ORDER BY i) AS people FROM navs
    WHERE t <> '' GROUP BY page_id)"""
FIRST_P = f"regexp_extract({ARTICLE}, '(?is)<p>(.*?)(?:</p>|\\z)', 1)"
VALUES = (f"list_filter(list_transform(string_split({_nodes(FIRST_P, ', ')}, ','), lambda v: "
          f"regexp_replace(v, '^{S}+|{S}+\\z', '', 'g')), lambda v: v <> '')")


@query("page_genres", f"""WITH {PAGES}, {NAV_TEXTS}, {GENRES}
    SELECT page_id, genres FROM prepared JOIN genres USING (page_id)""")
def _(spark, sf):
    return _field(spark, sf, "genres", lambda p, r: F.array_join(M.page_genres(p, r), "|"))


@query("page_credits", f"""WITH {PAGES}, {NAV_TEXTS}, {CREDITS}
    SELECT page_id, people FROM prepared JOIN credits USING (page_id)""")
def _(spark, sf):
    return _field(spark, sf, "people", lambda p, r: F.array_join(
        M.page_credits(p, r, r.cast_labels), "|"))


@query("page_metadata", f"WITH {PAGES} SELECT page_id, array_to_string({VALUES}, '|') AS people FROM prepared")
def _(spark, sf):
    return _field(spark, sf, "people", lambda p, r: F.array_join(
        M.page_metadata(p, r, r.director_labels), "|"))


@query("page_body", f"WITH {PAGES} SELECT page_id, {BODY} AS body FROM prepared")
def _(spark, sf):
    return _field(spark, sf, "body", M.page_body)


DETAILS = f"""details AS (
    SELECT page_id, url, coalesce(nullif({BODY}, ''), {SUMMARY}) AS review_text,
      cast(NULL AS DOUBLE) AS rating_value, {FOOTER} AS review_date, {FIRST_LINK} AS critic,
      {TITLE} AS item_title, try_cast(nullif(regexp_extract({TITLE}, '(?:19|20)[0-9]{{2}}', 0), '')
        AS INTEGER) AS item_year, genres AS item_genres,
      array_to_string({VALUES}, '|') AS item_directors, people AS item_cast
    FROM prepared JOIN genres USING (page_id) JOIN credits USING (page_id))"""


@query("page_details", f"WITH {PAGES}, {NAV_TEXTS}, {GENRES}, {CREDITS}, {DETAILS} SELECT * FROM details")
def _(spark, sf):
    lists = ("item_genres", "item_directors", "item_cast")
    return H.page_details(_pages(spark, sf), RULES).withColumns(
        {c: F.array_join(c, "|") for c in lists})


@query("review_document", f"""WITH {PAGES}, {NAV_TEXTS}, {GENRES}, {CREDITS}, {DETAILS},
    listing AS (SELECT url, 'Listed ' || page_id AS title, cast(1950 + page_id AS INTEGER) AS year,
      CASE WHEN page_id % 2 = 0 THEN 'teaser ' || page_id ELSE '' END AS summary FROM pages),
    docs AS (SELECT d.*, l.summary, coalesce(nullif(item_title, ''), l.title) AS title,
      coalesce(nullif(item_year, 0), nullif(l.year, 0), 0) AS year
      FROM listing l JOIN details d USING (url))
    SELECT 'rogerebert_' || substr(md5(title || '_' || year || '_rogerebert'), 1, 12) AS id, title,
      year, 'rogerebert' AS site, url, cast(NULL AS DOUBLE) AS rating, item_genres AS genres,
      item_directors AS directors, item_cast AS "cast",
      coalesce(nullif(summary, ''), review_text) AS plot, review_text AS reviews,
      cast(NULL AS INTEGER) AS num_reviews, nullif(critic, '') AS critic, review_date,
      rating_value, 4.0::DOUBLE AS rating_scale, summary FROM docs""")
def _(spark, sf):
    pages = _pages(spark, sf)
    key = F.col("page_id").cast("string")
    listing = pages.select(
        "url", F.concat(F.lit("Listed "), key).alias("title"),
        (1950 + F.col("page_id")).cast("int").alias("year"),
        F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("teaser "), key)).otherwise("").alias("summary"))
    made = H.review_documents(listing, H.page_details(pages, RULES))
    return made.withColumns({c: F.array_join(c, "|") for c in ("genres", "directors", "cast")})


_LI = _clean(_text("regexp_extract(page, '(?is)<li>(.*?)</li>', 1)"))


@query("collect_reviews", f"""WITH {PAGES}, {NAV_TEXTS}, {GENRES}, {CREDITS}, {DETAILS}, {LINKS},
    stored AS (SELECT link AS url, max(page_id) AS stored_id FROM listed WHERE place = 0 GROUP BY link),
    links AS (SELECT * FROM (SELECT link AS url, CASE WHEN title = '' THEN 'Untitled Review' ELSE title END AS title,
        coalesce(try_cast(nullif(regexp_extract(title, '(?:19|20)[0-9]{{2}}', 0), '') AS INTEGER),
          try_cast(nullif(regexp_extract({_LI}, '(?:19|20)[0-9]{{2}}', 0), '') AS INTEGER)) AS year,
        {_LI} AS summary, row_number() OVER (PARTITION BY link ORDER BY page_id, place) AS rn
      FROM listed JOIN prepared USING (page_id) WHERE place < 50) WHERE rn = 1),
    docs AS (SELECT d.* EXCLUDE (url, rating_value), l.url, l.summary, coalesce(nullif(item_title, ''), l.title) AS title,
      coalesce(nullif(item_year, 0), nullif(l.year, 0), 0) AS year, (stored_id % 8)::DOUBLE / 2 AS rating_value
      FROM links l JOIN stored USING (url) JOIN details d ON d.page_id = stored_id)
    SELECT 'rogerebert_' || substr(md5(title || '_' || year || '_rogerebert'), 1, 12) AS id, title, year,
      'rogerebert' AS site, url, round_even(rating_value / 4 * 10, 1) AS rating, item_genres AS genres,
      item_directors AS directors, item_cast AS "cast", coalesce(nullif(summary, ''), review_text) AS plot,
      review_text AS reviews, cast(NULL AS INTEGER) AS num_reviews, nullif(critic, '') AS critic, review_date,
      rating_value, 4.0::DOUBLE AS rating_scale, summary FROM docs""")
def _(spark, sf):
    """Every page is a listing; the first link of a page is where that page, with a rating, was stored."""
    pages = _pages(spark, sf)
    first = H.page_links(pages, RULES).where("place = 0").select("page_id", F.col("url").alias("stored_at"))
    rating = F.concat(F.lit('<meta charset="utf-8" content="'), (F.col("page_id") % 8 / 2).cast("string"), F.lit('">'))
    reviews = pages.join(first, "page_id").select("page_id", F.col("stored_at").alias("url"), F.concat(rating, "html").alias("html"))
    made = collect_reviews(pages, reviews, RULES)
    return made.withColumns({c: F.array_join(c, "|") for c in ("genres", "directors", "cast")})
