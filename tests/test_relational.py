import random

import pytest
from pyspark.sql import functions as F

from catalograph.operators import grouping as G
from catalograph.operators import joins as J
from catalograph.operators import lists as L
from catalograph.operators import ordering as O
from catalograph.operators.filters import request_filters


def hot_rows(spark, n=600):
    """One key owns a third of all rows."""
    rows = [("hot" if i % 3 == 0 else f"k{i % 40}", (i * 7919) % n, f"v{i}" if i % 5 else None)
            for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, pos int, v string").repartition(6)


def expected_lists(rows):
    out = {}
    for key, _, value in sorted(rows, key=lambda r: r[1]):
        out.setdefault(key, []).append(value)
    return out


@pytest.mark.parametrize("part_rows", [1000, 50, 7])
def test_lists_are_whole_for_a_hot_key(spark, part_rows):
    rows, df = hot_rows(spark)
    got = {}
    for r in sorted(L.collect_in_order(df, "k", "v", ["pos"], part_rows=part_rows).collect(),
                    key=lambda r: (r["k"], r["part"])):
        assert len(r["values"]) <= part_rows
        got.setdefault(r["k"], []).extend(r["values"])
    assert got == expected_lists(rows)


def test_lists_are_cut_by_bytes(spark):
    df = spark.createDataFrame([("k", i, "x" * (40 if i == 3 else 9)) for i in range(12)], "k string, pos int, v string")
    parts = L.collect_in_order(df, "k", "v", ["pos"], part_rows=100, part_bytes=30).orderBy("part").collect()
    assert [v for p in parts for v in p["values"]] == ["x" * (40 if i == 3 else 9) for i in range(12)]
    assert all(sum(map(len, p["values"][:-1])) < 30 for p in parts) and parts[0]["part"] == 0 and len(parts) > 3


def test_group_records_keeps_load_order(spark):
    rows, df = hot_rows(spark, 90)
    lists = {r["k"]: [x["v"] for x in r["records"]]
             for r in L.group_records(df, "k", "pos").collect()}
    assert lists == expected_lists(rows)


def test_attach_lists_continues_in_further_rows(spark):
    _, df = hot_rows(spark)
    items = spark.createDataFrame([("hot", 0, "a"), ("none", 0, "b")], "k string, part int, t string")
    lists = L.collect_in_order(df, "k", "pos", ["pos"], "places", part_rows=50)
    got = L.attach_lists(items, lists, "k", ["places"]).collect()
    hot = sorted((r for r in got if r["k"] == "hot"), key=lambda r: r["part"])
    parts = [r["part"] for r in hot]
    assert parts[0] == 0 and len(set(parts)) == len(parts) >= 4
    assert [r["t"] for r in hot] == ["a"] + [None] * (len(parts) - 1)
    assert sum(len(r["places"]) for r in hot) == 200
    assert [r["places"] for r in got if r["k"] == "none"] == [None]


@pytest.mark.parametrize("limit, skip", [(1, 0), (150, 0), (600, 0), (900, 0), (40, 333), (5, 599)])
def test_first_rows_come_in_order(spark, limit, skip):
    rows, df = hot_rows(spark)
    expected = sorted(sorted(rows, key=lambda r: r[1]), key=lambda r: r[0], reverse=True)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = O.first_rows(df, [F.col("k").desc(), F.col("pos").asc()], limit, skip).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [(r["k"], r["pos"]) for r in got] == [(r[0], r[1]) for r in expected[skip:skip + limit]]


@pytest.mark.parametrize("k", [1, 17, 400, 990, 2000])
def test_top_k_by_a_cut(spark, k):
    df = spark.range(1000).select("id", F.when(F.col("id") % 50 != 0, F.col("id") * 7919 % 61).alias("votes"))
    order = [F.col("votes").desc_nulls_last(), F.col("id").asc()]
    plain = [tuple(r) for r in df.orderBy(*order).limit(k).collect()]
    assert [tuple(r) for r in O.top_k_global(df, order, k, "votes").collect()] == plain
    assert O.above_cut(df, "votes", k).count() >= min(k, 1000)


def test_records_without_a_position(spark):
    rows = [("a", None, "x"), ("a", 3, "y"), ("b", None, "z"), ("c", None, "p"), ("c", None, "q")]
    df = spark.createDataFrame(rows, "k string, pos int, v string")
    for pick in (O.dedup_last_wins, O.first_per_group):
        got = {r["k"]: (r["pos"], r["v"]) for r in pick(df, "k", "pos").collect()}
        assert got["a"] == (3, "y") and got["b"] == (None, "z") and got["c"] in ((None, "p"), (None, "q"))


def test_pages_concatenate_to_the_full_order(spark):
    rows = [(f"i{i}", None if i % 7 == 0 else i % 5) for i in range(33)]
    df = spark.createDataFrame(rows, "id string, rating int")
    order = O.sort_keys("rating desc")
    full = [r["id"] for r in df.orderBy(*order).collect()]
    paged = [r["id"] for p in range(1, 5) for r in O.paginate(df, order, p).collect()]
    assert paged == full and full[-1] in {f"i{i}" for i in range(0, 33, 7)}
    up = [r["rating"] for r in O.sort_field(df, "rating asc").collect()]
    assert up[:5] == [None] * 5


def test_random_order_repeats_for_a_seed(spark):
    df = spark.createDataFrame([(str(i),) for i in range(50)], "id string")
    first = [r["id"] for r in O.sort_random_seeded(df, 5).collect()]
    again = [r["id"] for r in O.sort_random_seeded(df.repartition(3), 5).collect()]
    other = [r["id"] for r in O.sort_random_seeded(df, 6).collect()]
    assert first == again != other


def test_top_n_bounds_rows_before_the_shuffle(spark):
    _, df = hot_rows(spark)
    top = O.top_n_per_group(df, "k", [F.col("pos")], 3)
    assert top.groupBy("k").count().agg(F.max("count")).first()[0] == 3
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_last_and_first_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("b", 2, "y")],
                               "k string, pos int, v string")
    assert {tuple(r) for r in O.dedup_last_wins(df, "k", "pos").collect()} == {
        ("a", 3, None), ("b", 2, "y")}
    assert {tuple(r) for r in O.first_per_group(df, "k", "pos").collect()} == {
        ("a", 1, "x"), ("b", 2, "y")}


def test_one_to_one_join_refuses_repeats(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    right = spark.createDataFrame([("a", 1), ("a", 2)], "k string, y int")
    assert J.join_one_to_one(left, right.limit(1), "k").count() == 1
    with pytest.raises(J.KeyRepeats):
        J.join_one_to_one(left, right, "k")
    with pytest.raises(J.KeyRepeats):
        J.join_one_to_one(right, left, "k")


def reference_match(items, recs, tolerance=1):
    """Plain restatement of title matching, for comparison."""
    exact, titles = {}, {}
    for title, year, value in recs:
        exact[f"{title.lower()}_{year}"] = value
        titles.setdefault(title.lower().strip(), []).append((year, value))
    out = {}
    for key, title, year in items:
        hit = exact.get(f"{title.lower()}_{year}") if title and year else None
        if hit is None and title and year:
            for y, value in titles.get(title.lower().strip(), []):
                if y is None:
                    break
                if y == 0 or abs(y - year) <= tolerance:
                    hit = value
                    break
        out[key] = hit
    return out


def test_title_matching_against_brute_force(spark):
    rng = random.Random(3)
    names = ["A", "a ", " A", "b", "B", "c"]
    recs = [(rng.choice(names), rng.choice([None, 0, 1999, 2000, 2001, 2002, 2003]), f"r{i}")
            for i in range(25)]
    items = [(str(i), rng.choice(names + [""]), rng.choice([None, 0, 1998, 2000, 2002, 2004]))
             for i in range(60)]
    df = J.join_year_tolerance(
        spark.createDataFrame(items, "id string, title string, year int"),
        spark.createDataFrame([(*r, i) for i, r in enumerate(recs)],
                              "title string, year int, v string, pos int"), ["v"])
    assert {r["id"]: r["v"] for r in df.collect()} == reference_match(items, recs)


def test_overlay_overwrites_all_but_the_plot(spark):
    items = spark.createDataFrame([("1", "p1", "x.jpg"), ("2", "p2", "y.jpg")],
                                  "tconst string, plot string, poster string")
    enrich = spark.createDataFrame(
        [("1", 70, None, "old.jpg", "no", 0), ("1", 71, 90, None, "", 1), (None, 1, 1, "", "", 2)],
        "imdb_id string, metascore int, tomatometer int, poster string, plot string, pos int")
    got = {r["tconst"]: r.asDict() for r in J.join_overlay(items, enrich).collect()}
    assert (got["1"]["metascore"], got["1"]["tomatometer"]) == (71, 90)
    assert (got["1"]["poster"], got["1"]["plot"], got["1"]["enriched"]) == (None, "p1", True)
    assert (got["2"]["poster"], got["2"]["metascore"], got["2"]["enriched"]) == ("y.jpg", None, False)


def test_facets_count_an_item_once_per_value(spark):
    df = spark.createDataFrame([("1", ["a", "a", "b"]), ("2", ["b", None]), ("3", None)],
                               "id string, genres array<string>")
    assert [tuple(r) for r in G.facet_terms(df, "genres").collect()] == [("b", 2), ("a", 1)]


def test_request_defaults():
    assert request_filters() == {}
    assert request_filters(year_min="2000") == {"year": (2000, 2024)}
    assert request_filters(year_max=" 1990 ") == {"year": (1900, 1990)}
    assert request_filters(["x"], rating_min="7.0") == {"genres": ["x"], "rating": (7.0, 10.0)}


def test_unread_lists_leave_the_plan(spark):
    """Nothing runs while lists are planned; a query that reads none has no join and no second scan."""
    conversations = spark.createDataFrame([(f"k{i % 5}", i, f"v{i}") for i in range(40)], "k string, pos int, v string")
    items = spark.createDataFrame([(f"k{i}", 0, ["a", "b"], i) for i in range(6)], "k string, part int, tags array<string>, year int")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "lists")
    listed = L.attach_lists(items, L.ordered_lists(conversations, "k", "v", ["pos"], "places", part_rows=3), "k", ["places"])
    assert not tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for unread in (G.num_found(listed), G.facet_terms(listed, "tags"), G.facet_terms(listed, "year"),
                   listed.where("year > 2").select("k", "year")):
        plan = unread._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "collect_list" not in plan and "Union" not in plan, plan
    assert sorted(v for r in listed.collect() for v in r["places"] or []) == sorted(f"v{i}" for i in range(40))
