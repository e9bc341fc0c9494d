"""Jobs over a stored ``pages(page_id, url, html)`` table: links, next pages, review documents."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.functions import markup as M
from catalograph.functions.scalars import (clean_text, extract_year, falsy_fallback, hash_id,
                                           normalize_rating, resolve_url, url_is_review)
from catalograph.functions.markup import PageRules, Sel
from catalograph.operators.sets import unseen
from catalograph.schema import REVIEW_RATING_SCALE, SOURCE_REVIEWS, STRINGS
from catalograph.session import materialize


def _links_of(fragment: Column, contains: str) -> Column:
    return M.elements(fragment, Sel("a", "href", contains, "contains"))


def prepared(pages: DataFrame, rules: PageRules) -> DataFrame:
    """Pages with markup noise removed once, in column ``page``, for all the fields read from it."""
    return pages.select("page_id", "url", M.prepare("html", rules.all_entities).alias("page"))


@lru_cache(maxsize=16)
def _link_columns(rules: PageRules, gateway: int) -> tuple[Column, Column, Column]:
    """Entries of a page's spans, those of reviews, and what is told of each; see ``_detail_columns``."""
    base, page = F.lit(rules.base_url), F.col("page")

    def entry(span: Column) -> Column:
        found = M.let(F.get(_links_of(M.between(page, span["begin"], span["end"]), rules.link_contains), F.lit(0)),
                      lambda link: F.struct(
                          M.attribute(F.regexp_extract(link, "(?s)^<[^>]*>", 0), "href").alias("href"),
                          clean_text(M.text(link)).alias("title")))
        return M.let(found, lambda f: F.struct(
            F.when(f["href"].isNotNull(), resolve_url(base, f["href"])).alias("url"),
            falsy_fallback(f["title"], F.lit(rules.untitled)).alias("title"),
            span["block_begin"].alias("block_begin"), span["block_end"].alias("block_end")))

    def teaser(e: Column) -> Column:
        block = F.when(e["block_end"] >= 0, M.between(page, e["block_begin"], e["block_end"]))
        return M.let(block, lambda b: clean_text(M.text(
            F.coalesce(*[M.inner_any(b, sel) for sel in rules.teaser]))))

    return (F.transform("spans", entry),
            F.filter("found", lambda e: url_is_review(e["url"], rules.link_path, rules.link_hyphens)),
            F.transform("found", lambda e: F.struct(
                e["url"].alias("url"), e["title"].alias("title"), teaser(e).alias("summary"))))


def page_links(pages: DataFrame, rules: PageRules) -> DataFrame:
    """Review links of each page, first occurrence per URL, in page order, capped per page.

    The summary of a link is the teaser of the nearest block of the first kind around it, blocks inside blocks
    counted, else of the nearest of the second kind. The list of one page never leaves its row before
    the cap, so a page costs no shuffle, and only the links that are listed look for their teaser.
    """
    entries, reviews, told = _link_columns(rules, id(pages.sparkSession.sparkContext._gateway))
    spans = prepared(pages, rules).withColumn("spans", M.link_spans("page", rules.link_block))
    found = spans.select("page_id", "page", entries.alias("found")).withColumn("found", reviews)
    found = found.withColumn("found", _first_by_url(F.col("found"), rules.links_per_page))
    # The outer form: from the inner one Spark infers a filter on the list's size, which evaluates the whole
    # extraction a second time below the scan's repartitioning.
    listed = (found.select("page_id", told.alias("found")).select("page_id", F.posexplode_outer("found"))
              .where(F.col("col").isNotNull()))
    return listed.select(
        "page_id", F.col("pos").alias("place"), "col.url", "col.title",
        falsy_fallback(extract_year("col.title"), extract_year("col.summary"),
                       kind="int").alias("year"),
        "col.summary")


def _first_by_url(entries: Column, cap: int) -> Column:
    """First entry of every URL in order, at most ``cap`` of them (a feature of listing pages)."""
    urls = F.transform(entries, lambda e: e["url"])
    kept = F.filter(entries, lambda e, i: F.array_position(urls, e["url"]) == i + 1)
    return F.slice(kept, 1, cap)


def link_summary(pages: DataFrame, rules: PageRules) -> DataFrame:
    return page_links(pages, rules).select("page_id", "url", "summary")


def next_page_urls(rules: PageRules) -> Column:
    """Candidate next pages of one page: head link, page link, "more" link; own site only."""
    page, here, own = F.col("page"), F.col("url"), rules.base_url
    paged = F.when(M.first_tag(page, rules.next_link).isNotNull(),
                   M.first_attribute(page, rules.next_link, "href")).otherwise(
        M.first_attribute(M.inner_any(page, rules.next_block), Sel("a"), "href"))
    more = F.get(F.filter(M.elements(page, Sel("a")), lambda a: F.contains(
        M.text(a), F.lit(rules.more_text))), F.lit(0))
    hrefs = F.array(M.first_attribute(page, rules.next_head, "href"), paged,
                    M.attribute(F.regexp_extract(more, "(?s)^<[^>]*>", 0), "href"))
    urls = F.transform(F.array_compact(hrefs), lambda h: resolve_url(here, h))
    return F.array_sort(F.array_distinct(F.filter(urls, lambda u: u.startswith(own))))


def next_pages(pages: DataFrame, rules: PageRules) -> DataFrame:
    return prepared(pages, rules).select(
        "page_id", F.explode(next_page_urls(rules)).alias("next_url"))


def expand_frontier(pages: DataFrame, frontier: DataFrame, rules: PageRules) -> DataFrame:
    """Next pages that are neither queued nor among the pages already read; one hop per call."""
    found = next_pages(pages, rules).select(F.col("next_url").alias("url")).distinct()
    return unseen(unseen(found, frontier.select("url"), "url"), pages.select("url"), "url")


def crawl(pages: DataFrame, start: DataFrame, rules: PageRules) -> DataFrame:
    """``(url, hop)`` of all pages that next-page links reach from ``start(url)``, ``hop`` links away at least.

    Links are read once from the stored pages; a round follows those of the last round's new pages only, so each
    page is expanded once and cycles end. Pages that are not stored are reached but lead no further. Each round is
    written to the shared folder, and there are as many rounds as the longest shortest chain has links.
    """
    links = materialize(prepared(pages, rules).select("url", F.explode(next_page_urls(rules)).alias("next")).distinct(), "links")
    last = start.select("url").where("url IS NOT NULL").distinct().withColumn("hop", F.lit(0))
    reached = last = materialize(last, "reached")
    hop = 0
    while not last.isEmpty():
        hop += 1
        found = links.join(last, "url").select(F.col("next").alias("url")).distinct()
        last = materialize(unseen(found, reached.select("url"), "url").withColumn("hop", F.lit(hop)), "reached")
        reached = reached.unionByName(last)
    return reached


@lru_cache(maxsize=16)
def _detail_columns(rules: PageRules, gateway: int) -> tuple[list[Column], list[Column]]:
    """Pieces that several fields need, and the fields made from them. They depend on the rules alone; making their
    thousands of expressions anew for each query would cost more than reading a small table."""
    page, infos, columns = F.col("page"), F.col("infos"), F.col("columns")
    pieces = [M.page_title(page, rules).alias("item_title"), M.page_body(page, rules).alias("body"),
              M.page_summary(page, rules).alias("deck"), M.credit_columns(page, rules).alias("columns"),
              M.info_items(page, rules).alias("infos")]
    fields = [falsy_fallback("body", "deck").alias("review_text"), M.page_rating(page, rules).alias("rating_value"),
              M.page_date(page, rules).alias("review_date"), M.page_author(page, rules).alias("critic"),
              extract_year("item_title").alias("item_year"), F.col("item_title"),
              M.genres_of(infos, columns, rules).alias("item_genres"),
              M.metadata_of(infos, columns, rules, rules.director_labels).alias("item_directors"),
              M.credits_of(columns, rules, rules.cast_labels).alias("item_cast")]
    return pieces, fields


def page_details(pages: DataFrame, rules: PageRules) -> DataFrame:
    """All fields of each review page. Pieces that several fields need are cut out once per page."""
    pieces, fields = _detail_columns(rules, id(pages.sparkSession.sparkContext._gateway))
    cut = prepared(pages, rules).select("page_id", "url", "page", *pieces)
    return cut.select("page_id", "url", *fields)


def make_document(df: DataFrame, site: str) -> DataFrame:
    """The twelve fixed fields of a document; the id hashes title, year and site."""
    def listed(name: str) -> Column:
        return F.coalesce(F.col(name), F.array().cast(STRINGS)).alias(name)

    text_id = F.concat_ws("_", F.coalesce("title", F.lit("None")),
                          F.coalesce(F.col("year").cast("string"), F.lit("None")), F.lit(site))
    return df.select(
        hash_id(text_id, site).alias("id"), "title", "year", F.lit(site).alias("site"), "url",
        "rating", listed("genres"), listed("directors"), listed("cast"), "plot", "reviews",
        "num_reviews", *[c for c in df.columns if c not in DOCUMENT_FIELDS])


DOCUMENT_FIELDS = ("id", "title", "year", "site", "url", "rating", "genres", "directors", "cast",
                   "plot", "reviews", "num_reviews")


def review_documents(links: DataFrame, details: DataFrame, site: str = SOURCE_REVIEWS,
                     scale: float = REVIEW_RATING_SCALE) -> DataFrame:
    """Listing entries joined with the details of the page they point to."""
    joined = links.alias("l").join(details.alias("d"), F.col("l.url") == F.col("d.url"))
    merged = joined.select(
        falsy_fallback("d.item_title", "l.title").alias("title"),
        F.coalesce(F.nullif("d.item_year", F.lit(0)), F.nullif("l.year", F.lit(0)),
                   F.lit(0)).alias("year"),
        F.col("l.url").alias("url"),
        normalize_rating("d.rating_value", scale).alias("rating"),
        F.col("d.item_genres").alias("genres"), F.col("d.item_directors").alias("directors"),
        F.col("d.item_cast").alias("cast"),
        falsy_fallback("l.summary", "d.review_text").alias("plot"),
        F.col("d.review_text").alias("reviews"), F.lit(None).cast("int").alias("num_reviews"),
        F.nullif("d.critic", F.lit("")).alias("critic"), F.col("d.review_date"),
        F.col("d.rating_value"), F.lit(scale).alias("rating_scale"), F.col("l.summary"))
    return make_document(merged, site)
