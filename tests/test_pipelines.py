from pyspark.sql import functions as F

from catalograph.operators.filters import get_by_id
from catalograph.operators.grouping import num_found
from catalograph.operators.lists import own_rows, whole_lists
from catalograph.plans.catalog import catalog_build
from catalograph.plans.merge import format_enrichment, merge_entities
from catalograph import schema as C

BASICS = [("t1", "movie", "One", "2001", "Drama,War"), ("t2", "movie", "Two", "2024", None),
          ("t3", "short", "Three", "2024", "Short"), ("t4", "movie", "Four", None, "X,"),
          ("t5", "movie", "Five", "1990", "Y")]
RATINGS = [("t1", 7.0, 900), ("t2", 6.0, 60), ("t3", 9.0, 9000), ("t4", 5.0, 501), ("t5", 5.0, 500)]
CREDITS = [("t1", i, f"n{i}", "actor" if i % 2 else "actress") for i in range(1, 8)] + [
    ("t1", 8, "n1", "director"), ("t1", 9, "zz", "director"), ("t1", 10, "n2", "director"),
    ("t4", 1, "n3", "writer"), ("t9", 1, "n1", "actor")]
NAMES = [(f"n{i}", f"Name {i}", i) for i in range(1, 7)] + [("n1", "Name 1 again", 99)]


def build(spark, **options):
    return catalog_build(
        spark.createDataFrame(BASICS, C.TITLE_BASICS), spark.createDataFrame(RATINGS, C.TITLE_RATINGS),
        spark.createDataFrame(CREDITS, C.TITLE_PRINCIPALS),
        spark.createDataFrame(NAMES, "nconst string, primaryName string, pos int"), **options)


def test_catalog_build(spark):
    got = {r["tconst"]: r for r in build(spark).collect()}
    assert set(got) == {"t1", "t2", "t4"}
    one = got["t1"]
    assert one["id"] == "imdb_t1" and one["genres"] == ["Drama", "War"] and one["year"] == 2001
    assert one["directors"] == ["Name 1 again", None, "Name 2"]
    assert one["cast"] == ["Name 1 again", "Name 2", "Name 3", "Name 4", "Name 5"]
    assert got["t4"]["year"] is None and got["t4"]["genres"] == ["X"]
    assert got["t2"]["directors"] == [] == got["t2"]["cast"] == got["t2"]["genres"]
    assert {r["tconst"] for r in build(spark, limit=1).collect()} == {"t1"}


def test_oversized_director_list_continues(spark):
    rows = [r for r in build(spark, part_rows=2).collect() if r["tconst"] == "t1"]
    rows.sort(key=lambda r: r["part"])
    assert [r["directors"] for r in rows] == [["Name 1 again", None], ["Name 2"]]
    assert rows[1]["title"] is None and rows[1]["id"] == "imdb_t1"


def test_merge(spark):
    base = build(spark).withColumn("pos", F.monotonically_increasing_id())
    enrich = spark.createDataFrame(
        [("t1", 80, 90, None, "Better plot", 0)],
        "imdb_id string, metascore int, tomatometer int, poster string, plot string, pos long")
    reviews = spark.createDataFrame(
        [("ONE", 2002, "Near", "Ann", 7.5, "u1", 0), ("two", 2024, "Exact", "Bo", 5.0, "u2", 1),
         ("Two", 2024, "Last", "Cy", 6.0, "u3", 2), ("four", 2000, "No year", "Di", 1.0, "u4", 3)],
        "title string, year int, reviews string, critic string, rating double, url string, pos long")
    articles = spark.createDataFrame(
        [("t2", "h1", "", None, 1), ("t2", "h0", "a0", "s0", 0)],
        "imdb_id string, headline string, abstract string, snippet string, pos long")
    got = {r["id"]: r for r in merge_entities(base, enrich, reviews, articles).collect()}
    assert set(got) == {"t1", "t2", "t4"}
    assert got["t1"]["source"] == ["imdb", "omdb", "rogerebert"]
    assert (got["t1"]["plot"], got["t1"]["critic_review"], got["t1"]["reviews"]) == (
        "Better plot", "Near", ["Near"])
    assert got["t2"]["source"] == ["imdb", "nyt", "rogerebert"]
    assert (got["t2"]["critic"], got["t2"]["headlines"], got["t2"]["abstracts"]) == (
        "Cy", ["h0", "h1"], ["a0"])
    assert got["t4"]["source"] == ["imdb"] and got["t4"]["reviews"] is None


def test_merge_of_a_list_in_parts_equals_that_of_the_whole(spark):
    names = "tconst string, part int, title string, year int, reviews array<string>, plot string, pos int"
    whole = [("t1", 0, "One", 2001, ["r1", "r2", "r3"], "p", 0), ("t2", 0, "Two", 2002, ["s1"], "q", 1)]
    parts = [("t1", 0, "One", 2001, ["r1", "r2"], "p", 0), ("t1", 1, None, None, ["r3"], None, None), whole[1]]
    enrich = spark.createDataFrame([], "imdb_id string, metascore int, tomatometer int, poster string, plot string, pos int")
    reviews = spark.createDataFrame([("One", 2001, "NEW", "Ann", 7.5, "u1", 0)],
                                    "title string, year int, reviews string, critic string, rating double, url string, pos int")
    merged = []
    for rows in (whole, parts):
        got = merge_entities(spark.createDataFrame(rows, names), enrich, reviews)
        lists = {r["id"]: r["reviews"] for r in whole_lists(got, "id", ["reviews"]).collect()}
        own = {r["id"]: (r["title"], r["critic"], r["source"]) for r in own_rows(got).collect()}
        assert num_found(got).first()[0] == 2
        merged.append((lists, own, get_by_id(got, "t1").first()["reviews"]))
    assert merged[0] == merged[1] and merged[0][2] == ["r1", "r2", "r3", "NEW"]


def test_merge_twice_keeps_one_row_per_key(spark):
    base = build(spark).withColumn("pos", F.lit(0))
    double = base.unionByName(base.withColumns({"pos": F.lit(1), "title": F.lit("later")}))
    none = spark.createDataFrame([], "imdb_id string, metascore int, tomatometer int, poster string, "
                                     "plot string, pos int")
    reviews = spark.createDataFrame([], "title string, year int, reviews string, critic string, "
                                        "rating double, url string, pos int")
    got = merge_entities(double, none, reviews).collect()
    assert len(got) == 3 and {r["title"] for r in got} == {"later"}


def test_format_enrichment(spark):
    raw = spark.createDataFrame(
        [("True", "t1", "One", "2001", "Drama, War", "P", "A B, C", None, "N/A",
          [("Metacritic", "74/100")]),
         ("False", "t2", None, None, None, None, None, None, None, None),
         ("True", "t3", "Three", "2010–2012", None, None, "", "X", None, [])], C.ENRICHMENT_RAW)
    got = {r["imdb_id"]: r for r in format_enrichment(raw).collect()}
    assert set(got) == {"t1", "t3"}
    assert got["t1"]["genres"] == ["Drama", "War"] and got["t1"]["directors"] == ["A B", "C"]
    assert got["t1"]["cast"] == [] and got["t1"]["metascore"] == 74 and got["t1"]["year"] == 2001
    assert got["t3"]["year"] is None and got["t3"]["directors"] == [] and got["t3"]["rating"] is None


def test_merge_takes_either_name_and_reviews_without_a_year(spark):
    base = spark.createDataFrame(
        [("t1", "One", None, "2001", None, 0), ("t2", "", "Two", None, 2002, 1), ("t3", None, "Three", "bad", 2003, 2)],
        "tconst string, primaryTitle string, title string, startYear string, year int, pos int")
    enrich = spark.createDataFrame([], "imdb_id string, metascore int, tomatometer int, poster string, plot string, pos int")
    reviews = spark.createDataFrame(
        [("one", None, "No year", "Ann", 7.5, "u1", 0), ("Two", 2003, "Near", "Bo", 5.0, "u2", 1), ("Three", 1990, "Far", "Cy", 5.0, "u3", 2)],
        "title string, year int, reviews string, critic string, rating double, url string, pos int")
    got = {r["id"]: (r["title"], r["year"], r["critic_review"]) for r in merge_entities(base, enrich, reviews).collect()}
    assert got == {"t1": ("One", 2001, "No year"), "t2": ("Two", 2002, "Near"), "t3": ("Three", 2003, None)}
