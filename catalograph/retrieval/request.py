"""One search request: query, filters, order, page, facets."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.operators.filters import condition, get_by_id, request_filters, starts_token
from catalograph.operators.grouping import facet_summary, facet_terms, num_found
from catalograph.operators.ordering import first_rows, paginate, random_keys, sort_keys
from catalograph.retrieval.analysis import STOP_WORDS, analyze_title
from catalograph.retrieval.highlight import result_page
from catalograph.retrieval.index import Index, fetch_items
from catalograph.retrieval.scoring import search_phrase_boost
from catalograph.retrieval.similar import similar_items
from catalograph.schema import PAGE_SIZE, SEARCH_FIELDS

MATCH_ALL = "*:*"
LARGEST_PAGE = 1_000   # a page's ids come to the driver; larger results are read from ``matched``


@dataclass(frozen=True)
class SearchRequest:
    text: str = MATCH_ALL
    filters: dict = field(default_factory=dict)
    sort: str | None = None          # "rating desc", "year asc", "random_<seed> desc"
    page: int = 1
    size: int = PAGE_SIZE
    facets: tuple[str, ...] = ("genres", "year")

    def __post_init__(self):
        if self.page < 1 or not 0 <= self.size <= LARGEST_PAGE:
            raise ValueError(f"pages count from 1 and hold at most {LARGEST_PAGE} items")

    @classmethod
    def from_form(cls, q: str = "", genres=(), year_min: str = "", year_max: str = "",
                  rating_min: str = "", sort: str = "", page: int = 1) -> SearchRequest:
        return cls(q.strip() or MATCH_ALL,
                   request_filters(genres, year_min, year_max, rating_min), sort or None, page)

    @property
    def all_items(self) -> bool:
        return self.text.strip() in ("", MATCH_ALL)


@dataclass(frozen=True)
class SearchResult:
    matched: DataFrame               # every matching item: id, score, facet and sort fields
    page: DataFrame                  # display columns of the requested page, with rank
    num_found: DataFrame
    facets: dict[str, DataFrame]
    summary: DataFrame               # count and all facets in one pass: facet ('' for the count), value, count

    def release(self) -> None:
        """Give back the storage of the matched set."""
        self.matched.unpersist()


def order_of(request: SearchRequest) -> list[Column]:
    sort = request.sort
    if sort and sort.startswith("random_"):
        return random_keys(int(sort.split()[0].removeprefix("random_")))
    if sort:
        return sort_keys(sort)
    return [F.col("score").desc(), F.col("id").asc()]


def matched_items(index: Index, request: SearchRequest) -> DataFrame:
    """Items that pass the filters and match the query: id, score, facet and sort fields only.

    Filters come first and never change a score: statistics are those of the whole collection.
    Items and postings share their buckets, so both joins stay in place.
    """
    own = index.items.where("part = 0")
    passing = own.where(condition(own, request.filters)) if request.filters else own
    sort = (request.sort or "").split(" ")[0]
    wanted = {"id", *request.facets, *([sort] if sort in own.columns else [])}
    narrow = passing.select(*[c for c in own.columns if c in wanted])
    if request.all_items:
        return narrow.withColumn("score", F.lit(1.0))
    scores = search_phrase_boost(index, request.text,
                                 ids=passing if request.filters else None)
    return narrow.join(scores, "id")


def search(index: Index, request: SearchRequest, keep: bool = True) -> SearchResult:
    """Page, count and facets of one request over one matched set.

    ``keep`` stores the narrow matched set for the three results (memory, then disk; recomputed if
    an executor is lost) until ``release``.
    """
    matched = matched_items(index, request)
    matched = matched.persist(StorageLevel.MEMORY_AND_DISK) if keep else matched
    top = paginate(matched, order_of(request), request.page, request.size).select("id", "score")
    shown = result_page(fetch_items(index, top), "" if request.all_items else request.text,
                        index.profile)
    columns = [c for c in SEARCH_FIELDS if c in shown.columns]
    page = shown.select("rank", *columns, "highlighted_plot", "highlighted_reviews", "snippet",
                        "score").orderBy("rank")
    facets = {f: facet_terms(matched, f) for f in request.facets}
    return SearchResult(matched, page, num_found(matched), facets, facet_summary(matched, request.facets))


def facet_values(items: DataFrame, name: str, k: int = 20) -> DataFrame:
    """Facet over the whole collection."""
    return facet_terms(items, name, k)


def prefix_match(items: DataFrame, name: str, prefix: str, stop=STOP_WORDS) -> DataFrame:
    """Items with a word of the field that begins with the prefix; removed words do not count."""
    return items.where(starts_token(analyze_title(name, stop), prefix))


def prefix_ids(index: Index, name: str, prefix: str) -> DataFrame:
    """Ids with a term of the field that begins with the prefix. Postings are sorted by term, so the
    prefix reaches the scan; ids are made distinct within their bucket."""
    return index.postings.where(
        (F.col("field") == name) & F.col("term").startswith(prefix.lower())).select("id").distinct()


def autocomplete(index: Index, q: str, k: int = 10) -> DataFrame:
    """Suggestions for typed text of at least two characters: title, year or '', id."""
    typed = q.strip()
    found = prefix_ids(index, "title", typed)
    found = found if len(typed) >= 2 else found.where(F.lit(False))
    items = fetch_items(index, first_rows(found, [F.col("id").asc()], k))
    return items.orderBy("rank").select(
        "title", F.coalesce(F.col("year").cast("string"), F.lit("")).alias("year"), "id")


def get_with_similar(index: Index, item_id: str, k: int = 5) -> DataFrame:
    """One item with its k most similar items, weighted by term interest, as an ordered array of their score
    and display fields."""
    similar = similar_items(index, item_id, k=k, boost=True)
    fields = [c for c in similar.columns if c not in ("seed", "score", "id")]
    ranked = similar.groupBy("seed").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("_order"), "id", "score", F.struct(*fields).alias("_f")))).alias("_s"))
    shown = F.transform("_s", lambda s: F.struct(
        s["id"].alias("id"), s["score"].alias("score"), *[s["_f"][f].alias(f) for f in fields]))
    ranked = ranked.select(F.col("seed").alias("id"), shown.alias("similar"))
    joined = get_by_id(index.items, item_id).join(ranked, "id", "left")
    return joined.withColumn("similar", F.coalesce(
        "similar", F.array().cast(ranked.schema["similar"].dataType)))
