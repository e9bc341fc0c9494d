"""From stored listing and review pages to review documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalograph.functions.markup import PageRules
from catalograph.operators.joins import join_semi
from catalograph.operators.ordering import dedup_last_wins, first_per_group
from catalograph.operators.pages import page_details, page_links, review_documents
from catalograph.operators.sets import union_append, unseen
from catalograph.schema import REVIEW_RATING_SCALE, SOURCE_REVIEWS
from catalograph.sources.store import limited


def collect_reviews(listing: DataFrame, pages: DataFrame, rules: PageRules,
                    existing: DataFrame | None = None, limit: int = 0,
                    site: str = SOURCE_REVIEWS, scale: float = REVIEW_RATING_SCALE) -> DataFrame:
    """Stored documents plus one for every linked review page not stored yet.

    The first link to a URL counts, in listing order; links whose page was not fetched are skipped
    before the limit. Only the pages still needed are taken apart.
    """
    links = page_links(listing, rules).withColumn("seen_at", F.struct("page_id", "place"))
    fresh = first_per_group(links, "url", "seen_at")
    if existing is not None:
        fresh = unseen(fresh, existing, "url")
    fetched = pages.where(F.col("html").isNotNull())
    wanted = limited(join_semi(fresh, fetched, "url"), [F.col("seen_at").asc()], limit)
    # A page stored more than once counts once, with its latest copy.
    needed = join_semi(fetched, wanted, "url")
    latest = dedup_last_wins(needed.select("page_id", "url", "html"), "url", "page_id")
    made = review_documents(wanted, page_details(latest, rules), site, scale)
    return union_append(existing, made) if existing is not None else made
