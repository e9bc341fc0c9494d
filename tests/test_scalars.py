import pytest
from pyspark.sql import functions as F

from catalograph.functions import scalars as S


def lit(x):
    return F.lit(x)


@pytest.mark.parametrize("value, scale, expected", [
    (0.5, 4.0, 1.2), (1.5, 4.0, 3.8), (2.5, 4.0, 6.2), (3.5, 4.0, 8.8), (3.0, 0.0, 0.0)])
def test_normalize_rating_ties_to_even(one, value, scale, expected):
    assert one(S.normalize_rating(lit(value), scale)) == expected


@pytest.mark.parametrize("text, expected", [
    ("Film (2010)", 2010), ("12019", 2019), ("1899", None), ("", None)])
def test_extract_year(one, text, expected):
    assert one(S.extract_year(lit(text))) == expected


@pytest.mark.parametrize("text, expected", [
    ("1,234 reviews", 1234), (",", None), ("none", None), ("a 12 b 34", 12)])
def test_extract_number(one, text, expected):
    assert one(S.extract_number(lit(text))) == expected


@pytest.mark.parametrize("text, expected", [
    ("2010", 2010), ("2010–2012", None), ("", None), (None, None), (" 2010", None)])
def test_digits_int(one, text, expected):
    assert one(S.digits_int(lit(text).cast("string"))) == expected


def test_clean_text_collapses_unicode_space(one):
    assert one(S.clean_text(lit("  a\t\nb   c\x1c "))) == "a b c"
    assert one(S.clean_text(lit(None).cast("string"))) == ""


def test_split_clean(one):
    assert one(S.split_clean(lit(" a , ,b ,"))) == ["a", "b"]
    assert one(S.split_clean(lit(""))) == []
    assert one(S.split_clean(lit(None).cast("string"))) == []
    assert one(S.split_clean(lit("a.b"), ".")) == ["a", "b"]


def test_truncate_words(one):
    assert one(S.truncate_words(lit("short"), 10)) == "short"
    assert one(S.truncate_words(lit("one two three"), 9)) == "one two..."
    assert one(S.truncate_words(lit("abcdefghij"), 5)) == "abcde..."
    assert one(S.truncate_words(lit("one two"), 4)) == "one..."


def test_truncate_chars(one):
    assert one(S.truncate_chars(lit("abcdef"), 3)) == "abc..."
    assert one(S.truncate_chars(lit("ab cdef"), 3, trim=True)) == "ab..."


def test_hash_id_matches_md5_prefix(one):
    assert one(S.hash_id(lit("a"))) == "0cc175b9c0f1"
    assert one(S.hash_id(lit("a"), "site")) == "site_0cc175b9c0f1"


def test_parse_ratings_last_entry_of_a_source_wins(spark):
    rows = [("a", [("Internet Movie Database", "8.8/10"), ("Rotten Tomatoes", "87%"),
                   ("Metacritic", "74/100"), ("Rotten Tomatoes", "90%")]), ("b", []), ("c", None)]
    df = spark.createDataFrame(rows, "k string, r array<struct<Source:string,Value:string>>")
    got = {r["k"]: (r["v"]["rating"], r["v"]["tomatometer"], r["v"]["metascore"])
           for r in df.select("k", S.parse_ratings("r").alias("v")).collect()}
    assert got == {"a": (8.8, 90, 74), "b": (None, None, None), "c": (None, None, None)}


@pytest.mark.parametrize("href, expected", [
    ("/reviews/a", "https://h.org/reviews/a"), ("b.html", "https://h.org/x/b.html"),
    ("//cdn.org/c", "https://cdn.org/c"), ("http://o.org/d", "http://o.org/d"),
    ("?p=2", "https://h.org/x/y?p=2"), ("#top", "https://h.org/x/y?q=1#top")])
def test_resolve_url(one, href, expected):
    assert one(S.resolve_url(lit("https://h.org/x/y?q=1#z"), lit(href))) == expected


@pytest.mark.parametrize("href, expected", [
    ("g:h", "g:h"), ("g", "http://a/b/c/g"), ("./g", "http://a/b/c/g"), ("g/", "http://a/b/c/g/"), ("/g", "http://a/g"),
    ("//g", "http://g"), ("?y", "http://a/b/c/d;p?y"), ("g?y", "http://a/b/c/g?y"), ("#s", "http://a/b/c/d;p?q#s"),
    ("g#s", "http://a/b/c/g#s"), ("g?y#s", "http://a/b/c/g?y#s"), (";x", "http://a/b/c/;x"), ("g;x", "http://a/b/c/g;x"),
    ("", "http://a/b/c/d;p?q"), (".", "http://a/b/c/"), ("./", "http://a/b/c/"), ("..", "http://a/b/"), ("../", "http://a/b/"),
    ("../g", "http://a/b/g"), ("../..", "http://a/"), ("../../", "http://a/"), ("../../g", "http://a/g"),
    ("../../../g", "http://a/g"), ("/./g", "http://a/g"), ("/../g", "http://a/g"), ("g.", "http://a/b/c/g."), ("..g", "http://a/b/c/..g"),
    ("./../g", "http://a/b/g"), ("./g/.", "http://a/b/c/g/"), ("g/../h", "http://a/b/c/h"), ("g?y/../x", "http://a/b/c/g?y/../x")])
def test_resolve_url_by_the_published_examples(one, href, expected):
    assert one(S.resolve_url(lit("http://a/b/c/d;p?q"), lit(href))) == expected


def test_url_is_review(one):
    assert one(S.url_is_review(lit("https://h.org/reviews/a-b-2010?x=1")))
    assert not one(S.url_is_review(lit("https://h.org/reviews/a-b")))
    assert not one(S.url_is_review(lit("https://h.org/blog/reviews/a-b-c")))


def test_small_formatters(one):
    assert one(S.star_class_rating(lit("filled star25 x"))) == 2.5
    assert one(S.star_class_rating(lit("filled starry"))) is None
    assert one(S.date_part(lit("2020-01-02T10:00"))) == "2020-01-02"
    assert one(S.format_rating(lit(7.5))) == "7.5/10"
    assert one(S.format_rating(lit(0.0))) == ""
    assert one(S.capitalize(lit("hELLO wORLD"))) == "Hello world"
    assert one(S.poster_or_null(lit("N/A"))) is None
    assert one(S.poster_or_null(lit("x.jpg"))) == "x.jpg"
    assert one(S.highlight_terms(lit("A.b ab"), ["a.b"])) == "<mark>A.b</mark> ab"
    assert one(S.item_url(lit("tt1"))).endswith("/title/tt1/")


def test_lists(one):
    assert one(S.truncate_list(F.col("x"), 2), x=["a", "b", "c"]) == ["a", "b"]
    assert one(S.join_with_comma(F.col("x")), x=["a", "b"]) == "a, b"
    assert one(S.join_with_comma(lit(None).cast("array<string>"))) == ""
    assert one(S.first_or_blank(F.col("x")), x=["a", "b"]) == "a"
    assert one(S.first_or_blank(F.array().cast("array<string>"))) == ""
    assert one(S.split_list_field(lit("Drama,,Comedy"), ",", True)) == ["Drama", "Comedy"]
    assert one(S.split_list_field(lit("A B, C"), ", ")) == ["A B", "C"]
    assert one(S.split_list_field(lit(None).cast("string"), ", ")) == []


def test_falsy_fallback(one):
    assert one(S.falsy_fallback(lit(""), lit("b"))) == "b"
    assert one(S.falsy_fallback(lit("a"), lit("b"))) == "a"
    assert one(S.falsy_fallback(lit(0), lit(5), kind="int")) == 5
    assert one(S.falsy_fallback(F.array().cast("array<string>"), F.array(lit("x")),
                                kind="array")) == ["x"]


def test_overlay_values(one):
    old, null = lit("old"), lit(None).cast("string")
    assert one(S.overlay_values(old, null, lit(True))) is None
    assert one(S.overlay_values(old, lit(""), lit(True), "truthy")) == "old"
    assert one(S.overlay_values(old, lit("new"), lit(True), "truthy")) == "new"
    assert one(S.overlay_values(old, lit("new"), lit(False))) == "old"


def test_snippet_prefers_plot_and_cuts(one):
    assert one(S.snippet(lit(""), lit("r"))) == "r"
    assert one(S.snippet(lit("p" * 301), lit("r"))) == "p" * 300 + "..."
    assert one(S.snippet(lit(None).cast("string"), lit(None).cast("string"))) == ""


def test_facet_pairs_drops_odd_tail(one):
    got = one(S.facet_pairs(F.array(lit("a"), lit("3"), lit("b"), lit("2"), lit("c"))))
    assert [(p["value"], p["count"]) for p in got] == [("a", 3), ("b", 2)]
    assert one(S.facet_pairs(F.array().cast("array<string>"))) == []
