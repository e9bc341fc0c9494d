import math
import os
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalograph.operators.joins import KeyRepeats
from catalograph.plans import tasks as K
from catalograph.retrieval import refresh as R
from catalograph.retrieval import scoring as X
from catalograph.retrieval import similar as S
from catalograph.retrieval.analysis import PLAIN, STEMMED, Profile, analyze_general, tokenize
from catalograph.retrieval.highlight import highlight_fragment
from catalograph.retrieval.index import (BUCKET_BYTES, bucket_count, build_index, build_postings, count_rows,
                                         open_index, token_rows)
from catalograph.retrieval.request import (SearchRequest, autocomplete, get_with_similar,
                                           prefix_ids, prefix_match, search)
from catalograph.retrieval.stemming import stem, stem_all
from workload import tables

SF = "/root/testdata/sf0.001"

DDL = ("id string, part int, title string, year int, rating double, genres array<string>, "
       "directors array<string>, cast array<string>, site string, plot string, "
       "reviews array<string>, url string, num_reviews int, poster string, tomatometer int")
ROWS = [
    ("1", 0, "The Dark Knight", 2008, 9.0, ["Action", "Crime"], ["Nolan"], ["Bale", "Ledger"], None,
     "A dark knight guards the city at night", ["Dark and brooding. Knights rise"], None, None, "N/A", 94),
    ("2", 0, "Dark City", 1998, 7.6, ["Sci-Fi"], ["Proyas"], ["Sewell"], None,
     "A man in a city without daylight", None, None, None, "p.jpg", None),
    ("3", 0, "Knight and Day", 2010, 6.3, ["Action"], ["Mangold"], ["Cruise"], None,
     "A spy and a woman on the run", ["Fun", "A dark turn by day"], None, None, None, None),
    ("4", 0, "Inception", 2010, 8.8, ["Action", "Sci-Fi"], ["Nolan"], ["DiCaprio"], None,
     "A thief who steals dreams of the city", [], None, None, None, 87),
    ("5", 0, None, None, None, None, None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ROWS, DDL)


@pytest.fixture(scope="module")
def index(items):
    return build_index(items, PLAIN, buckets=3)


def scores(df):
    return {r["id"]: r["score"] for r in df.collect()}


@pytest.mark.parametrize("word, expected", [
    ("caresses", "caress"), ("ponies", "poni"), ("ties", "ti"), ("cats", "cat"), ("feed", "feed"),
    ("agreed", "agre"), ("plastered", "plaster"), ("bled", "bled"), ("motoring", "motor"),
    ("sing", "sing"), ("conflated", "conflat"), ("troubled", "troubl"), ("sized", "size"),
    ("hopping", "hop"), ("falling", "fall"), ("hissing", "hiss"), ("failing", "fail"),
    ("filing", "file"), ("happy", "happi"), ("sky", "sky"), ("relational", "relat"),
    ("conditional", "condit"), ("rational", "ration"), ("digitizer", "digit"),
    ("vietnamization", "vietnam"), ("operator", "oper"), ("feudalism", "feudal"),
    ("decisiveness", "decis"), ("hopefulness", "hope"), ("formaliti", "formal"),
    ("triplicate", "triplic"), ("formative", "form"), ("electrical", "electr"),
    ("goodness", "good"), ("revival", "reviv"), ("allowance", "allow"), ("inference", "infer"),
    ("adjustable", "adjust"), ("replacement", "replac"), ("adjustment", "adjust"),
    ("adoption", "adopt"), ("communism", "commun"), ("probate", "probat"), ("rate", "rate"),
    ("cease", "ceas"), ("controll", "control"), ("roll", "roll"), ("is", "is"), ("été", "été")])
def test_stems(word, expected):
    assert stem(word) == expected


def test_stems_over_columns_equal_those_of_words(spark):
    """Every rule's suffix on stems of all shapes, y after vowels and consonants, and words with other letters."""
    rng = random.Random(6)
    ends = ["", "s", "es", "ies", "sses", "ed", "eed", "ing", "y", "yy", "e", "le", "ll", "at", "bl", "ational", "tional", "ization",
            "fulness", "iviti", "icate", "ical", "ness", "ement", "ment", "ent", "sion", "tion", "ion", "able", "ou", "ive"]
    words = ["".join(rng.choice("aeiouybclstz") for _ in range(rng.randint(0, 6))) + end for end in ends for _ in range(250)]
    words += ["don't", "été", "über", "y", "yy", "yyy", "1st", "日本語", "a.b.c", ""]
    df = spark.createDataFrame([(words, )], "t array<string>")
    assert df.select(stem_all(F.col("t"))).first()[0] == [stem(w) for w in words]
    frame = spark.createDataFrame([(["running", None, "the"],), (None,)], "t array<string>")
    stemmed = frame.select(stem_all(F.col("t")).alias("s"))
    assert [r["s"] for r in stemmed.collect()] == [["run", None, "the"], None]
    assert "Python" not in stemmed._jdf.queryExecution().executedPlan().toString()


def test_tokens(one):
    assert one(tokenize(F.lit("O'Neil’s U.S.A. end. ÉTÉ-2 snake_case"))) == [
        "o'neil’s", "u.s.a", "end", "été", "2", "snake_case"]
    assert one(analyze_general(F.lit("The running ponies"))) == ["run", "poni"]


def brute_force(field_index, words, boosts):
    """BM25 with the best boosted field per word, over the literal rows."""
    names = [c.split()[0] for c in DDL.split(", ")]
    docs = [dict(zip(names, row)) for row in ROWS]
    stop = PLAIN.stop

    def terms(doc, field):
        value = doc[field]
        values = value if isinstance(value, list) else [value] if value else []
        if field in ("genres", "directors", "cast"):
            return list(dict.fromkeys(values))
        return [w for v in values for w in re.findall(r"\w+", v.lower()) if w not in stop]

    total = {}
    for word in words:
        best = {}
        for field, boost in boosts.items():
            bags = {d["id"]: terms(d, field) for d in docs}
            bags = {i: b for i, b in bags.items() if b}
            n, avg = len(bags), sum(map(len, bags.values())) / max(len(bags), 1)
            df = sum(word in b for b in bags.values())
            for i, bag in bags.items():
                tf = bag.count(word)
                if tf:
                    s = boost * math.log(1 + (n - df + .5) / (df + .5)) * tf / (
                        tf + 1.2 * (.25 + .75 * len(bag) / avg))
                    best[i] = max(best.get(i, 0), s)
        for i, s in best.items():
            total[i] = total.get(i, 0) + s
    return {i: round(s, 6) for i, s in total.items()}


def test_weighted_search_against_brute_force(index):
    boosts = {"title": 10.0, "plot": 2.0, "reviews": 2.0}
    got = scores(X.search_weighted(index, "dark knight city", boosts))
    want = brute_force(index, ["dark", "knight", "city"], boosts)
    assert got.keys() == want.keys()
    assert all(got[i] == pytest.approx(want[i], abs=2e-6) for i in want)


def test_whole_value_fields_need_the_whole_query(index):
    assert set(scores(X.search_weighted(index, "Nolan"))) == {"1", "4"}
    assert "4" not in scores(X.search_weighted(index, "Nolan Dark"))
    assert set(scores(X.search_weighted(index, "nolan"))) == set()
    assert "4" in scores(X.search_weighted(index, "nolan dark", people_tokenized=True))


def test_phrase_boost_never_filters(index):
    plain = scores(X.search_weighted(index, "dark knight"))
    boosted = scores(X.search_phrase_boost(index, "dark knight"))
    assert plain.keys() == boosted.keys()
    assert boosted["1"] > plain["1"] and boosted["2"] == plain["2"] and boosted["3"] == plain["3"]


def test_phrase_does_not_cross_values(index):
    phrase = [X.Clause("fun dark", phrase=True)]
    assert scores(X.boolean_terms(index, must=phrase)) == {}
    assert set(scores(X.boolean_terms(index, must=[X.Clause("dark turn", "reviews", True)]))) == {"3"}


def test_boolean_clauses(index):
    got = X.boolean_terms(index, must=[X.Clause("dark")], must_not=[X.Clause("Sci-Fi", "genres")])
    assert set(scores(got)) == {"1", "3"}
    got = X.boolean_terms(index, should=[X.Clause("spy"), X.Clause("thief")])
    assert set(scores(got)) == {"3", "4"}
    assert set(scores(X.boolean_terms(index, must_not=[X.Clause("dark")]))) == {"4", "5"}


def test_filters_do_not_change_scores(index):
    every = search(index, SearchRequest("dark city"))
    some = search(index, SearchRequest("dark city", {"year": (1990, 2005)}))
    assert scores(some.page).items() <= scores(every.page).items()
    assert set(scores(some.page)) == {"2"}
    assert some.num_found.first()[0] == 1
    assert {r["value"]: r["count"] for r in some.facets["genres"].collect()} == {"Sci-Fi": 1}
    every.release(), some.release()


def test_summary_equals_count_and_facets(index):
    for request in (SearchRequest("dark"), SearchRequest(), SearchRequest("nothing like it"), SearchRequest(facets=("directors", "cast", "rating"))):
        result = search(index, request, keep=False)
        rows = [tuple(r) for r in result.summary.collect()]
        found = result.num_found.first()[0]
        assert [r for r in rows if not r[0]] == ([("", "", found)] if found else [])
        for name, facet in result.facets.items():
            assert sorted((v, n) for f, v, n in rows if f == name) == sorted((str(r["value"]), r["count"]) for r in facet.collect())


def test_search_page_order_and_columns(index):
    result = search(index, SearchRequest("dark", size=2))
    rows = result.page.collect()
    assert [r["rank"] for r in rows] == [1, 2]
    assert rows[0]["score"] >= rows[1]["score"]
    second = search(index, SearchRequest("dark", size=2, page=2)).page.collect()
    assert {r["id"] for r in rows} | {r["id"] for r in second} == {"1", "2", "3"}
    assert all(c <= result.num_found.first()[0] for c in [
        r["count"] for r in result.facets["genres"].collect()])
    by_year = search(index, SearchRequest(sort="year desc")).page.collect()
    assert [r["id"] for r in by_year] == ["3", "4", "1", "2", "5"]
    marked = {r["id"]: r["snippet"] for r in rows}
    assert "<mark>dark</mark> knight" in marked["1"]
    assert search(index, SearchRequest("  ")).num_found.first()[0] == 5
    stored = {r["id"]: r["poster"] for r in index.items.collect()}
    assert all(r["poster"] == stored[r["id"]] for r in rows)      # as stored; only the detail view reads N/A as missing


def test_autocomplete(index, items):
    assert [r["id"] for r in autocomplete(index, "Kn").collect()] == ["1", "3"]
    assert autocomplete(index, " k ").count() == 0
    assert autocomplete(index, "th").count() == 0                  # "The" is not indexed
    assert autocomplete(index, "incep").first()["year"] == "2010"
    assert {r["id"] for r in prefix_match(items, "title", "KN").collect()} == {"1", "3"}
    plan = prefix_ids(index, "title", "kn")._jdf.queryExecution().executedPlan().toString()
    assert "StartsWith(term" in plan and "Exchange" not in plan


def test_similar_items(index):
    got = S.more_like_this(index, "1", k=3).collect()
    assert "1" not in {r["id"] for r in got} and {r["id"] for r in got} <= {"2", "3", "4"}
    assert S.more_like_this(index, "missing").count() == 0
    batch = S.more_like_this_batch(index, index.items.select("id"), k=3).collect()
    own = [(r["id"], r["score"]) for r in batch if r["seed"] == "1"]
    assert sorted(own) == sorted((r["id"], r["score"]) for r in got)
    assert all(r["seed"] != r["id"] for r in batch)
    item = get_with_similar(index, "1", 2).first()
    assert len(item["similar"]) == 2 and item["title"] == "The Dark Knight"
    assert get_with_similar(index, "5").first()["similar"] == []


@pytest.mark.parametrize("boost", [False, True])
@pytest.mark.parametrize("first_items", [0, 40, 400])
def test_batch_similarity_is_exact_whatever_is_set_apart(spark, first_items, boost):
    """Common terms are treated apart at any bound; the result must not change."""
    items = tables.items(spark, SF).where("id % 2 = 0")
    small = build_index(items, PLAIN, buckets=4)
    seeds = items.where("id % 10 = 0").select("id")
    # with all terms in the first round no term is left to be set apart
    plain = S._best(S._sums(small, S._weighed(small, S.mlt_terms(small, seeds), S.SIMILAR_BY, boost), F.lit(True), S.SIMILAR_BY), 3)
    apart = S.more_like_this_batch(small, seeds, k=3, boost=boost, first_items=first_items)
    assert sorted(map(tuple, apart.collect())) == sorted(map(tuple, plain.collect()))


def test_batch_similarity_meets_in_blocks(spark, monkeypatch):
    """No row is made for a seed and an item that meet in a term; blocks of any size give the same rows."""
    monkeypatch.setattr(S, "BLOCK_HITS", 2_000)
    monkeypatch.setattr(S, "BLOCK_TERMS", 200)
    items = tables.items(spark, SF).where("id % 4 = 0")
    small = build_index(items, PLAIN, buckets=4)
    seeds = items.select("id")
    plain = S._best(S._sums(small, S._weighed(small, S.mlt_terms(small, seeds), S.SIMILAR_BY, False), F.lit(True), S.SIMILAR_BY), 3)
    blocks = S.more_like_this_batch(small, seeds, k=3)
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" in plan and plan.count("Join") == 2     # terms with their numbers, postings with their numbers
    assert sorted(map(tuple, blocks.collect())) == sorted(map(tuple, plain.collect()))


@pytest.mark.parametrize("cells", [1, 7, 1 << 20])
def test_best_of_a_block(cells):
    postings = pa.table({"id": ["b", "a", "c", "b", "a", "d"], "code": [1, 1, 1, 2, 3, 9], "part": [0.5, 0.5, 0.25, 1.0, 1.0, 1.0]})
    wanted = pa.table({"seed": ["a", "x", "y", "z"], "codes": [[1, 3], [1, 2], [7], []], "ws": [[1.0, 2.0], [1.0, 2.0], [1.0], []]},
                      schema=pa.schema({"seed": pa.string(), "codes": pa.list_(pa.int64()), "ws": pa.list_(pa.float64())}))
    best = lambda k, p=postings, w=wanted: sorted(map(tuple, (r.values() for r in S.best_of_block(k, cells)(p, w).to_pylist())))
    assert best(1) == [("a", "b", 0.5), ("x", "b", 2.5)]
    assert best(2) == [("a", "b", 0.5), ("a", "c", 0.25), ("x", "a", 0.5), ("x", "b", 2.5)]
    assert best(9) == [("a", "b", 0.5), ("a", "c", 0.25), ("x", "a", 0.5), ("x", "b", 2.5), ("x", "c", 0.25)]
    assert best(2, w=wanted.slice(0, 0)) == best(2, p=postings.slice(0, 0)) == []
    equal = pa.table({"id": ["b", "a", "c"], "code": [1, 1, 1], "part": [0.5, 0.5, 0.5]})
    assert best(2, p=equal, w=wanted.slice(1, 1)) == [("x", "a", 0.5), ("x", "b", 0.5)]


@pytest.mark.parametrize("common", [1, 5, 100_000])
def test_seeds_go_to_the_postings(spark, index, monkeypatch, common):
    """The postings of the seeds' items are neither shuffled nor written before their terms are weighed, but for rare terms."""
    monkeypatch.setattr(S, "COMMON_TERMS", common)
    seeds = spark.createDataFrame([("1",), ("4",), ("4",), (None,)], "id string")
    terms = S.mlt_terms(index, seeds)
    plan = terms._jdf.queryExecution().executedPlan().toString()
    postings = plan[plan.index("LeftSemi"):]
    assert "Exchange" not in postings[:postings.index("FileScan")] and index.postings_table in postings
    alone = S.mlt_terms(index, ["1", "4"])
    assert terms.count() and sorted(map(tuple, terms.collect())) == sorted(map(tuple, alone.collect()))


@pytest.mark.parametrize("n", [1, 2, 48])
def test_blocks_are_dealt_apart(spark, n):
    """Two meetings of blocks never share a task while another has none."""
    numbers = S.dealt_apart(spark, n)
    rows = spark.createDataFrame([(b,) for b in numbers], "b int").repartition(n, "b")
    assert [r[0] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().orderBy("p").select("count").collect()] == [1] * n


@pytest.mark.parametrize("cells", [1, 5_000])
def test_best_of_a_block_of_many_items(cells):
    """More items than stretches are made for; equal scores and scores that only rounding makes equal go by id."""
    rng = random.Random(7)
    k, items, terms = 3, 700, range(40)
    held = {(f"i{n:03d}", t): rng.choice([0.25, 0.5, 0.5 + 1e-8, 0.5 - 1e-8]) for n in range(items) for t in terms if rng.random() < 0.1}
    asked = {f"i{s:03d}" if s % 2 else f"x{s}": {t: rng.choice([1.0, 2.0]) for t in rng.sample(terms, 4)} for s in range(30)}
    rows = list(held.items())
    rng.shuffle(rows)
    postings = pa.table({"id": [i for (i, _), _ in rows], "code": [t for (_, t), _ in rows], "part": [p for _, p in rows]})
    wanted = pa.Table.from_batches([pa.RecordBatch.from_pydict(
        {"seed": [s], "codes": [sorted(ts)], "ws": [[ts[t] for t in sorted(ts)]]}) for s, ts in asked.items()])
    plain = []
    for seed, ts in asked.items():
        sums = {f"i{n:03d}": sum(ts[t] * held.get((f"i{n:03d}", t), 0) for t in sorted(ts)) for n in range(items)}
        best = sorted((-math.floor(v * 1e6 + 0.5), i) for i, v in sums.items() if v > 0 and i != seed)[:k]
        plain += [(seed, i, -v / 1e6) for v, i in best]
    assert sorted(map(tuple, (r.values() for r in S.best_of_block(k, cells)(postings, wanted).to_pylist()))) == sorted(plain)


def test_batch_similarity_shows_its_items(index, spark):
    seeds = spark.createDataFrame([("1",), ("4",), ("none",)], "id string")
    found = S.similar_items_batch(index, seeds, k=2)
    assert {"seed", "id", "score", "title", "year", "genres"} <= set(found.columns)
    assert sorted((r["seed"], r["id"], r["score"]) for r in found.collect()) == sorted(
        map(tuple, S.more_like_this_batch(index, seeds, k=2).select("seed", "id", "score").collect()))
    assert sorted((r["seed"], r["title"]) for r in found.where("seed = '1'").collect()) == sorted(
        (r["seed"], r["title"]) for r in S.similar_items(index, "1", k=2).collect())


def test_highlighting(spark):
    text = "x" * 199 + " dark dark " + "y" * 190 + " dark"
    df = spark.createDataFrame([("1", text), ("2", "Nothing here"), ("3", None)], "id string, plot string")
    got = {r["id"]: r["f"] for r in highlight_fragment(df, "plot", "dark", PLAIN, "f").collect()}
    assert got["1"] == "<mark>dark</mark> <mark>dark</mark> " + "y" * 190
    assert got["2"] == "Nothing here" and got["3"] is None
    df = spark.createDataFrame([("1", "Running runs, ran.")], "id string, plot string")
    assert highlight_fragment(df, "plot", "run", STEMMED, "f").first()["f"] == (
        "<mark>Running</mark> <mark>runs</mark>, ran.")


def test_stemmed_index_finds_inflections(items):
    index = build_index(items, STEMMED, buckets=2)
    assert "1" in scores(X.search_field(index, "reviews", "knight"))      # "Knights"
    assert scores(X.search_field(index, "title", "knights")) == {}        # titles are not stemmed


def test_catch_all_field(items):
    index = build_index(items, Profile(stem=True, catch_all=True), buckets=2)
    assert set(scores(X.search_field(index, "text", "nolan"))) == {"1", "4"}
    assert set(scores(X.search_field(index, "text", "knights"))) == {"1", "3"}
    assert "text" not in build_index(items, PLAIN, buckets=2).fields


def test_every_field_with_numbers(spark, items, tmp_path):
    index = build_index(items, Profile(stem=True, every_field=True), str(tmp_path / "index"), buckets=2)
    for words, found in (("2010", {"3", "4"}), ("9.0", {"1"}), ("94", {"1"}), ("nolan", {"1", "4"}), ("knights", {"1", "3"}), ("5", {"5"})):
        assert set(scores(X.search_field(index, "_text_", words))) == found
    assert open_index(spark, str(tmp_path / "index")).profile == index.profile


def test_reopened_index_answers_alike(spark, items, tmp_path):
    path = str(tmp_path / "index")
    built = build_index(items, PLAIN, path, buckets=3)
    opened = open_index(spark, path)
    assert opened.fields == built.fields and opened.total == 5
    assert scores(X.search_phrase_boost(opened, "dark knight")) == scores(
        X.search_phrase_boost(built, "dark knight"))


def _contents(index):
    postings = [tuple(map(str, r)) for r in index.postings.select("id", "part", "field", "term", "tf", "dl", "positions").collect()]
    return (sorted(tuple(map(str, r)) for r in index.items.collect()), sorted(postings),
            sorted(map(tuple, index.term_stats.collect())), index.fields, index.total)


def _bucket_files(path):
    return {n for t in ("items", "postings") for n in os.listdir(f"{path}/{t}") if n.startswith("part-")}


@pytest.mark.parametrize("cut_off", [False, True])
def test_refresh_equals_a_rebuild(spark, items, tmp_path, monkeypatch, cut_off):
    """Changed, new and removed items; only touched buckets are written, and a cut-off swap is finished on opening."""
    path = str(tmp_path / "index")
    old = build_index(items, PLAIN, path, buckets=7)
    files = _bucket_files(path)
    changed = [(*ROWS[1][:2], "Bright City", *ROWS[1][3:]), ("9", 0, "New arrival", 2020, *ROWS[0][4:])]
    parts = [("9", 1, *[None] * 8, ["and one more knight"], *[None] * 4)]
    removed = spark.createDataFrame([("3",), ("2",), ("none",), (None,)], "id string")
    if cut_off:
        monkeypatch.setattr(R, "finish", lambda spark, path: None)
    new = R.refresh_index(old, spark.createDataFrame(changed + parts, DDL), removed)
    monkeypatch.undo()
    reopened = open_index(spark, path)
    rebuilt = build_index(spark.createDataFrame([ROWS[0], *changed, *parts, ROWS[3], ROWS[4]], DDL), PLAIN, buckets=7)
    assert _contents(reopened) == _contents(rebuilt)
    assert reopened.has_parts and reopened.generation == new.generation == 1
    if not cut_off:
        assert _contents(new) == _contents(rebuilt)
    touched = {r[0] for r in spark.createDataFrame([("2",), ("3",), ("9",), ("none",)], "id string").select(
        F.pmod(F.hash("id"), F.lit(7))).collect()}
    kept = {n for n in files if R._bucket_of(n) not in touched}
    assert kept and kept <= _bucket_files(path) and not {n for n in files - kept} & _bucket_files(path)
    assert not [n for n in os.listdir(path) if n.startswith(("staged", "journal")) and "crc" not in n]
    assert scores(X.search_phrase_boost(reopened, "dark knight")) == scores(X.search_phrase_boost(rebuilt, "dark knight"))
    plan = X.search_weighted(reopened, "dark knight")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(id" not in plan


@pytest.mark.parametrize("held", [["1"], ["2", "4"], []])
def test_refresh_leaves_rows_in_their_buckets(spark, items, tmp_path, held):
    """What a refresh reads of the touched buckets comes from their files alone and is met with the changed ids without a shuffle."""
    path = str(tmp_path / "index")
    index = build_index(items, PLAIN, path, buckets=7)
    bucket = F.pmod(F.hash("id"), F.lit(7))
    touched = {r[0] for r in items.where(F.col("id").isin(held)).select(bucket).collect()} or set(range(7))
    ids = items.select("id").where("id > 2").repartition(7, "id")
    for table, whole in (("items", index.items), ("postings", index.postings)):
        rows = R._by_buckets(index, R._Files(spark, path), table, touched)
        met = rows.join(ids, "id", "left_anti").groupBy("id").count()
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan        # that of the ids
        inside = whole.where(bucket.isin(list(touched)))
        assert sorted(map(str, rows.collect())) == sorted(map(str, inside.collect()))
        assert {R._bucket_of(r[0]) for r in rows.select("_metadata.file_name").collect()} <= touched
    fresh = R.refresh_index(index, items.where("id = 1").withColumn("title", F.lit("Another")))
    assert "another" in {r["term"] for r in fresh.term_stats.collect()} and not [n for n in os.listdir(path) if n.startswith("staged")]


def test_refresh_counts_an_item_in_parts_once(spark, items, tmp_path):
    """Terms that an item has in several of its rows count once, before and after it leaves."""
    parts = spark.createDataFrame([("1", 1, *[None] * 8, ["dark again", "night"], *[None] * 4)], DDL)
    index = build_index(items.unionByName(parts), PLAIN, str(tmp_path / "index"), buckets=3)
    kept = R.refresh_index(index, items.where("id = 2"))
    assert _contents(kept) == _contents(build_index(items.unionByName(parts), PLAIN, buckets=3))
    gone = R.refresh_index(kept, items.limit(0), spark.createDataFrame([("1",)], "id string"))
    assert _contents(gone)[1:] == _contents(build_index(items.where("id <> 1"), PLAIN, buckets=3))[1:]


def test_refresh_without_changes_and_with_repeats(spark, items, tmp_path):
    index = build_index(items, PLAIN, str(tmp_path / "index"), buckets=2)
    assert R.refresh_index(index, items.limit(0)) is index
    with pytest.raises(KeyRepeats):
        R.refresh_index(index, items.unionByName(items))


def test_close_keeps_the_files(spark, items, tmp_path):
    index = build_index(items, PLAIN, str(tmp_path / "index"), buckets=2)
    before = scores(X.search_weighted(index, "dark"))
    index.close()
    assert not {t.name for t in spark.catalog.listTables()} & {index.items_table, index.postings_table}
    assert scores(X.search_weighted(open_index(spark, str(tmp_path / "index")), "dark")) == before


def test_items_in_parts_score_like_whole_items(spark, items):
    whole = build_index(items, PLAIN, buckets=2)
    split = [r if r[0] != "3" else (*r[:10], r[10][:1], *r[11:]) for r in ROWS]
    more = ("3", 1, *[None] * 8, ["A dark turn by day"], *[None] * 4)
    parts = build_index(spark.createDataFrame([*split, more], DDL), PLAIN, buckets=2)
    assert parts.has_parts and not whole.has_parts and parts.total == 5
    assert scores(X.search_weighted(parts, "dark day")) == scores(X.search_weighted(whole, "dark day"))


def test_scoring_stays_in_the_bucket(index):
    scored = X.search_weighted(index, "dark knight")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    assert "PushedFilters: [In(field" in plan.replace("`", "") or "In(field" in plan
    assert "positions" not in plan.split("ReadSchema")[1][:200]


def test_phrases_and_clauses_stay_in_the_bucket(index):
    """Words, phrases and clauses share one scan of the postings and move no hit."""
    some = index.items.where("year > 2000")
    clauses = {"must": [X.Clause("dark"), X.Clause("dark knight", phrase=True)], "should": [X.Clause("city", "plot")],
               "must_not": [X.Clause("Sci-Fi", "genres")]}
    for scored in (X.search_phrase_boost(index, "dark knight"), X.search_phrase_boost(index, "dark knight", ids=some),
                   X.boolean_terms(index, **clauses)):
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan
        assert plan.count(index.postings_table) == 1
    assert set(scores(X.search_phrase_boost(index, "dark knight", ids=some))) == {"1", "3"}
    assert set(scores(X.boolean_terms(index, **clauses))) == {"1"}


def test_phrases_of_repeated_words_and_items_in_parts(spark):
    rows = [("1", 0, ["to go go far"]), ("1", 1, ["go go", "far go"]), ("2", 0, ["go far go"]), ("3", 0, ["go go go"])]
    names = "id string, part int, reviews array<string>"
    index = build_index(spark.createDataFrame(rows, names), PLAIN, buckets=2)
    found = X.slot_scores(index, X._phrase(index, "go go", {"reviews": 1.0}, 0))
    assert set(r["id"] for r in found.collect()) == {"1", "3"}
    assert set(scores(X.boolean_terms(index, must=[X.Clause("go far", "reviews", True)]))) == {"1", "2"}
    whole = build_index(spark.createDataFrame([("1", 0, ["to go go far", "go go", "far go"]), *rows[2:]], names), PLAIN, buckets=2)
    assert scores(X.search_phrase_boost(index, "go go far", {"reviews": 2.0}, {"reviews": 3.0})) == scores(
        X.search_phrase_boost(whole, "go go far", {"reviews": 2.0}, {"reviews": 3.0}))


def test_tasks(index):
    assert K.task_known_item(index, "Inception").first()["rating"] == 8.8
    assert {r["id"] for r in K.task_faceted(index, "Sci-Fi", 8.0, 2010).collect()} == {"4"}
    assert [r["id"] for r in K.task_genre_decade(index, "Action", 2000, 2010, 6.3).collect()] == [
        "1", "4"]
    assert "1" not in {r["id"] for r in K.task_discovery(index, "The Dark Knight").collect()}
    assert {r["id"] for r in K.task_complex(index, "Action", "city", 2000, 2024, 7.5).collect()} == {
        "1", "4"}
    lucky = [r["id"] for r in K.lucky(index, 7).collect()]
    assert sorted(lucky) == ["1", "2", "3", "4", "5"]


def test_empty_stop_list():
    assert Profile(stem=False, stop=()).query_terms("to be", "title") == [(0, "to"), (1, "be")]


def test_a_page_is_bounded():
    for wrong in ({"size": 1001}, {"size": -1}, {"page": 0}):
        with pytest.raises(ValueError):
            SearchRequest(**wrong)


def _counted(rows):
    return {(r["id"], r["part"], r["field"], r["term"]): (r["tf"], r["dl"], list(r["positions"])) for r in rows}


def test_postings_are_made_inside_the_item_row(spark):
    rows = [("a", "red blue red", ["x"]), ("b", None, ["y", "y"]), ("c", "the", None), ("d", "blue", [None, "z"])]
    items = spark.createDataFrame(rows, "id string, plot string, genres array<string>")
    postings = build_postings(items, PLAIN, one_row=True)
    plan = postings._jdf.queryExecution().executedPlan().toString()
    assert not any(step in plan for step in ("Aggregate", "Exchange", "Window", "Sort "))
    wanted = {("a", 0, "plot", "red"): (2, 3, [0, 2]), ("a", 0, "plot", "blue"): (1, 3, [1]), ("a", 0, "genres", "x"): (1, 1, [0]),
              ("b", 0, "genres", "y"): (1, 1, [0]), ("d", 0, "plot", "blue"): (1, 1, [0]), ("d", 0, "genres", "z"): (1, 1, [0])}
    assert _counted(postings.collect()) == wanted
    assert _counted(build_postings(items, PLAIN).collect()) == wanted


def test_postings_come_sorted_as_they_are_stored(spark):
    """The sort of a bucket merges runs; a batch's postings are one run a field."""
    words = [f"w{(i * 7919) % 1000:03d}" for i in range(3000)]
    items = spark.createDataFrame([(str(n), " ".join(words[n::3] * 2), words[n::3][:5]) for n in range(3)],
                                  "id string, plot string, genres array<string>").coalesce(1)
    rows = build_postings(items, PLAIN, one_row=True).collect()
    terms = [(r["field"], r["term"], int(r["id"])) for r in rows]
    assert terms == sorted(terms) and len(terms) > 3000
    spots = [(r["field"], r["term"], p) for r in rows if r["id"] == "1" for p in r["positions"]]
    assert sorted(spots) == sorted((r["field"], r["term"], r["pos"]) for r in token_rows(items, PLAIN).where("id = '1'").collect())


@pytest.mark.parametrize("stem", [False, True])
def test_places_in_the_field_of_all_fields(spark, stem):
    items = spark.createDataFrame([("7", "The reds", "blues", ["x y"])], "id string, title string, plot string, genres array<string>")
    rows = build_postings(items, Profile(stem=stem, every_field=True), one_row=True).where("field = '_text_'").collect()
    red, blue = ("red", "blue") if stem else ("reds", "blues")
    assert {r["term"]: r["positions"] for r in rows} == {"7": [0], red: [102], blue: [203], "x": [304], "y": [305]}
    assert {r["dl"] for r in rows} == {5}


def test_postings_of_repeated_and_continued_rows(spark):
    rows = [("a", 0, "red blue"), ("a", 0, "red"), ("a", 1, "red"), (None, 0, "red"), (None, 0, "red blue")]
    items = spark.createDataFrame(rows, "id string, part int, plot string")
    span = 2 ** 31
    wanted = {("a", 0, "plot", "red"): (2, 4, [0, 0]), ("a", 0, "plot", "blue"): (1, 4, [1]), ("a", 1, "plot", "red"): (1, 4, [span]),
              (None, 0, "plot", "red"): (2, 3, [0, 0]), (None, 0, "plot", "blue"): (1, 3, [1])}
    assert _counted(build_postings(items, PLAIN).collect()) == wanted
    rows = count_rows(items)
    assert (rows.items, rows.parts, rows.most) == (4, 1, 2)
    assert _counted(rows.postings(items, PLAIN).collect()) == wanted


def test_buckets_grow_with_the_text(spark):
    cores = spark.sparkContext.defaultParallelism
    assert [bucket_count(spark, n) for n in (0, BUCKET_BYTES, 1000 * BUCKET_BYTES + 1)] == [cores, cores, 1001]


def test_a_bucket_is_one_task(items):
    index = build_index(items, PLAIN, buckets=40)
    assert [t.select("id").rdd.getNumPartitions() for t in (index.items, index.postings)] == [40, 40]
    index.close()
