import pytest
from pyspark.sql import functions as F

from catalograph.functions import markup as M
from catalograph.functions.markup import PageRules
from catalograph.operators import pages as H
from catalograph.plans.reviews import collect_reviews

RULES = PageRules(base_url="https://h.org")


@pytest.fixture(scope="module")
def read(one):
    def value(column_of, html, rules=RULES, *more):
        return one(column_of(M.prepare(F.col("html"), rules.all_entities), rules, *more), html=html)
    return value


def test_rating_fallbacks(read):
    meta = '<meta itemprop="ratingValue" content="3.5">'
    bad = "<meta content='four' itemprop=ratingValue>"
    box = '<div class="a star-box"><div></div><img class="filled star25"></div>'
    span = '<span class="star-rating" data-rating="1.5"></span>'
    assert read(M.page_rating, meta + box + span) == 3.5
    assert read(M.page_rating, bad + box + span) == 2.5
    assert read(M.page_rating, box.replace("star25", "starry") + span) == 1.5
    assert read(M.page_rating, span.replace("1.5", "x")) is None
    assert read(M.page_rating, '<img class="filled star25">') is None      # outside the box
    assert read(M.page_rating, "<p>none</p>") is None


def test_date_fallbacks(read):
    meta = '<meta itemprop="datePublished" content="2020-01-01">'
    og = '<meta property="og:updated_time" content="2021-02-03T04:05">'
    span = '<span class="review-info__date"> March  <b>3</b> </span>'
    last = "<span class='x publish-date'>April 4</span>"
    assert read(M.page_date, meta + og + span) == "2020-01-01"
    assert read(M.page_date, og + span) == "2021-02-03"
    assert read(M.page_date, span + last) == "March 3"
    assert read(M.page_date, last) == "April 4"
    assert read(M.page_date, "<p></p>") is None


def test_author_fallbacks(read):
    meta = '<meta name="author" content="Ann &amp; Bo">'
    link = '<a href="/contributors/ann">Ann <i>B</i></a>'
    byline = '<em class="byline__name">Cy</em>'
    plain = '<a class="author" href="/x">Di</a>'
    assert read(M.page_author, meta + link) == "Ann & Bo"
    assert read(M.page_author, link + byline) == "Ann B"
    assert read(M.page_author, byline + plain) == "Cy"
    assert read(M.page_author, plain) == "Di"


def test_title_and_summary(read):
    assert read(M.page_title, "<h1>One</h1><h1 class='page-title'> Two\n2010</h1>") == "Two 2010"
    assert read(M.page_title, "<h1>One</h1>") == "One"
    assert read(M.page_title, "<h2>No</h2>") is None
    deck = '<p class="article-info__deck">a<b> b </b>c</p>'
    meta = '<meta name="description" content=" d  e ">'
    og = '<meta property="og:description" content="f">'
    assert read(M.page_summary, deck + meta) == "a b c"
    assert read(M.page_summary, meta + og) == "d e"
    assert read(M.page_summary, og) == "f"
    assert read(M.page_summary, '<meta name="description" content="">' + og) == ""
    assert read(M.page_summary, "") == ""


CREDITS = """<div id="content-lower"><div class="credit-col"><div><h4 class="page-title">Film</h4></div>
<a href="/genre/drama">Drama</a><a href="/genre/x">Movie Reviews</a><a href="/genre/drama">Drama</a>
<a href="/genre/war">War</a></div>
<div class="credit-col"><h4>Cast</h4><ul><li><a href="/a">Ann</a> as <b>B</b></li>
<li><a href="/c">Cy</a></li></ul></div>
<div class="credit-col"><h4>Directed by</h4><ul><li>Di <i>E</i></li><li> </li></ul></div></div>"""


def test_genres_and_credits(read):
    assert read(M.page_genres, CREDITS) == ["Drama", "War"]
    assert read(M.page_credits, CREDITS, RULES, ("Cast",)) == ["Ann", "Cy"]
    assert read(M.page_credits, CREDITS, RULES, ("Director", "Directed by")) == ["Di E"]
    assert read(M.page_credits, "<div></div>", RULES, ("Cast",)) == []


def test_metadata_then_credits(read):
    info = ('<div class="review-info__item"><span class="review-info__label">Genres</span>'
            '<span class="review-info__value"><a>Noir</a>, <a>Crime</a></span></div>')
    assert read(M.page_metadata, info, RULES, ("Genre", "Genres")) == ["Noir", "Crime"]
    assert read(M.page_genres, info) == ["Noir", "Crime"]
    assert read(M.page_metadata, info + CREDITS, RULES, ("Directed by",)) == ["Di E"]


def test_body_respects_nesting_and_unclosed_paragraphs(read):
    html = ("<script>var t='</div><p>no</p>'</script><div class='entry-content x'><div>"
            "<p>one<p><b>two</b>three</p></div><p> </p>loose<p>four<div>five</div></div><p>out</p>")
    assert read(M.page_body, html) == "one two three four"
    assert read(M.page_body, "<p>no container</p>") == ""


def test_rare_entities_in_one_pass(read):
    rules = PageRules(all_entities=True)
    html = "<h1>A &copy; &#233; &amp;copy; &#60;b&#62;</h1>"
    assert read(M.page_title, html, rules) == "A © é &copy; <b>"


LISTING = """<article><p>Teaser 2011 </p><a href="/reviews/a-b-c">First</a>
<a href="/reviews/a-b-c">Again</a></article><div><a href="https://h.org/reviews/d-e-f"> </a>
<p class="review-stack__tease">Near</p></div><a href="/reviews/short">x</a>
<a href="/reviews/g-h-i-2012">Title (1999)</a><link rel="next" href="/page/2">
<div class="pagination__next"><a href="page/3">n</a></div><a href="https://o.org/z">More Reviews</a>"""


def test_links_of_a_listing(spark):
    pages = spark.createDataFrame([(1, "https://h.org/list/", LISTING)],
                                  "page_id int, url string, html string")
    got = [tuple(r)[2:] for r in H.page_links(pages, RULES).orderBy("place").collect()]
    assert got == [("https://h.org/reviews/a-b-c", "First", 2011, "Teaser 2011"),
                   ("https://h.org/reviews/d-e-f", "Untitled Review", None, "Near"),
                   ("https://h.org/reviews/g-h-i-2012", "Title (1999)", 1999, "")]
    nexts = {r["next_url"] for r in H.next_pages(pages, RULES).collect()}
    assert nexts == {"https://h.org/page/2", "https://h.org/list/page/3"}
    queue = spark.createDataFrame([("https://h.org/page/2",)], "url string")
    assert [r["url"] for r in H.expand_frontier(pages, queue, RULES).collect()] == [
        "https://h.org/list/page/3"]


def test_link_cap_keeps_the_first(spark):
    html = "".join(f'<a href="/reviews/a-b-{i}">t</a>' for i in range(60))
    pages = spark.createDataFrame([(1, "https://h.org/", html)],
                                  "page_id int, url string, html string")
    urls = [r["url"] for r in H.page_links(pages, RULES).orderBy("place").collect()]
    assert urls == [f"https://h.org/reviews/a-b-{i}" for i in range(50)]


def test_collect_reviews_from_stored_pages(spark):
    review = ("<h1>Film (2010)</h1><meta itemprop='ratingValue' content='2.5'>"
              "<div class='review__body'><p>Good.</p></div>")
    rows = [(1, "https://h.org/list/", LISTING), (2, "https://h.org/reviews/a-b-c", review),
            (3, "https://h.org/reviews/g-h-i-2012", review.replace("Film (2010)", ""))]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    listing = pages.where("page_id = 1")
    first = collect_reviews(listing, pages, RULES)
    got = {r["url"]: r for r in first.collect()}
    assert set(got) == {"https://h.org/reviews/a-b-c", "https://h.org/reviews/g-h-i-2012"}
    a = got["https://h.org/reviews/a-b-c"]
    assert (a["title"], a["year"], a["rating"], a["plot"], a["reviews"]) == (
        "Film (2010)", 2010, 6.2, "Teaser 2011", "Good.")
    b = got["https://h.org/reviews/g-h-i-2012"]
    assert (b["title"], b["year"], b["plot"]) == ("Title (1999)", 1999, "Good.")
    stored = first.where(F.col("url") == a["url"])
    assert collect_reviews(listing, pages, RULES, stored).count() == 2
    assert collect_reviews(listing, pages, RULES, limit=1).count() == 1


def test_summary_of_the_nearest_enclosing_block(spark):
    def summaries(html):
        rows = H.page_links(spark.createDataFrame([(1, "u", html)], "page_id int, url string, html string"), RULES)
        return {r["url"].rsplit("/", 1)[1]: r["summary"] for r in rows.collect()}
    link = "<a href='/reviews/%s-a-2001'>Film</a>"
    assert summaries(f"<div><div>img</div>{link % 'x'}<p>Teaser</p></div>") == {"x-a-2001": "Teaser"}
    nested = f"<article><article><p>Inner</p>{link % 'i'}</article>{link % 'o'}<p>Outer</p></article>"
    assert summaries(nested) == {"i-a-2001": "Inner", "o-a-2001": "Inner"}      # the first in the outer block's tree
    assert summaries(f"<article><article>in</article>{link % 'o'}<p>Outer</p></article>") == {"o-a-2001": "Outer"}
    both = f"<article><div><p>Div</p></div><div>{link % 'b'}</div><p class='review-stack__tease'>Tease</p></article>"
    assert summaries(both) == {"b-a-2001": "Tease"}                              # an article comes before a nearer div
    assert summaries(f"<div><p>Far</p><div>{link % 'n'}</div></div>") == {"n-a-2001": ""}
    assert summaries(f"{link % 'r'}<div>{link % 'r'}<p>Second</p></div>") == {"r-a-2001": ""}
    assert summaries(f"</div></article>{link % 's'}<p>x</p>") == {"s-a-2001": ""}
    assert summaries("<div><p>T</p><a href='/reviews/w-a-2001'><div>Big</div> film</a></div>") == {"w-a-2001": "T"}


def test_crawl_follows_chains_and_ends_cycles(spark):
    rules = PageRules(base_url="https://h.org")
    links = {0: 1, 1: 2, 2: 3, 3: 0, 4: 5, 5: 99, 7: 7, 8: 1}
    rows = [(i, f"https://h.org/{i}", f'<head><link rel="next" href="/{n}"></head>') for i, n in links.items()]
    pages = spark.createDataFrame(rows + rows[:2] + [(6, "https://h.org/6", None), (None, None, "<p>")], "page_id long, url string, html string")
    start = spark.createDataFrame([("https://h.org/8",), ("https://h.org/4",), ("https://h.org/7",), ("https://h.org/4",), (None,)], "url string")
    got = {r["url"].removeprefix("https://h.org/"): r["hop"] for r in H.crawl(pages, start, rules).collect()}
    assert got == {"8": 0, "4": 0, "7": 0, "1": 1, "5": 1, "2": 2, "99": 2, "3": 3, "0": 4}
    assert H.crawl(pages, start.limit(0), rules).count() == 0
