import gzip
import json

import pytest

from pyspark.sql import functions as F

from catalograph import schema as C
from catalograph import session
from catalograph.operators.joins import KeyRepeats
from catalograph.sources import records, store
from catalograph.sources.tsv import read_tsv, scan_filtered


def test_tsv_nulls_quotes_and_types(spark, tmp_path):
    path = tmp_path / "basics.tsv.gz"
    lines = ["tconst\ttitleType\tprimaryTitle\tstartYear\tgenres",
             'tt1\tmovie\t"Quoted" title\t2001\tDrama,War', "tt2\tmovie\t\\N\tnan\tNA",
             "tt3\tshort\tÉté\t\t\\N"]
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    df = read_tsv(spark, str(path), C.TITLE_BASICS, position="pos", partitions=3)
    got = [tuple(r)[:5] for r in df.orderBy("pos").collect()]
    assert got == [("tt1", "movie", '"Quoted" title', "2001", "Drama,War"),
                   ("tt2", "movie", None, None, None), ("tt3", "short", "Été", None, None)]
    ids = spark.createDataFrame([("tt3",)], "tconst string")
    assert scan_filtered(df, "tconst", ids).count() == 1
    assert scan_filtered(df, "tconst", ids.limit(0)).count() == 3
    assert scan_filtered(df, "tconst").count() == 3


def test_tsv_numbers(spark, tmp_path):
    path = tmp_path / "ratings.tsv"
    path.write_text("tconst\taverageRating\tnumVotes\ntt1\t7.5\t12\ntt2\t\\N\tNA\n")
    rows = read_tsv(spark, str(path), C.TITLE_RATINGS).orderBy("tconst").collect()
    assert [tuple(r) for r in rows] == [("tt1", 7.5, 12), ("tt2", None, None)]


def test_json_arrays(spark, tmp_path):
    good, bad = tmp_path / "good.json", tmp_path / "bad.json"
    good.write_text(json.dumps([{"imdb_id": "tt1", "title": "é", "extra": 1}, {"imdb_id": "tt2"}],
                               indent=2))
    bad.write_text('[{"imdb_id": "tt1"')
    odd = tmp_path / "odd.json"
    odd.write_text(json.dumps([{"imdb_id": "tt1", "year": 2001}, {"imdb_id": "tt2", "year": "n/a", "title": "kept"},
                               {"imdb_id": "tt3", "year": [1], "title": "too"}]))
    typed = records.read_json_array(spark, str(odd), C.ENRICHMENT).orderBy("imdb_id").collect()
    assert [(r["imdb_id"], r["year"], r["title"]) for r in typed] == [
        ("tt1", 2001, None), ("tt2", None, "kept"), ("tt3", None, "too")]
    lost = tmp_path / "lost.json"
    lost.write_text(json.dumps([{"year": "n/a"}, {"imdb_id": "tt1", "genres": "Drama", "rating": 7, "year": 1.5}, {}, {"year": 3}]))
    kept = records.read_json_array(spark, str(lost), C.ENRICHMENT)
    assert kept.count() == 4 and kept.schema == C.ENRICHMENT
    assert sorted((r["imdb_id"] or "", r["year"] or 0, r["genres"], r["rating"]) for r in kept.collect()) == [
        ("", 0, None, None), ("", 0, None, None), ("", 3, None, None), ("tt1", 0, ["Drama"], 7.0)]
    rows = records.read_json_array(spark, str(good), C.ENRICHMENT).orderBy("imdb_id").collect()
    assert [(r["imdb_id"], r["title"]) for r in rows] == [("tt1", "é"), ("tt2", None)]
    assert records.read_json_array(spark, str(bad), C.ENRICHMENT).count() == 0
    missing = records.read_json_array(spark, str(tmp_path / "none.json"), C.ENRICHMENT)
    assert missing.count() == 0 and missing.schema == C.ENRICHMENT


def test_empty_collection_writes_nothing(spark, tmp_path):
    path = tmp_path / "a" / "b"
    df = spark.createDataFrame([("é",)], "id string")
    assert records.write_items(df.limit(0), str(path)) is False and not path.exists()
    assert records.write_items(df, str(path)) is True
    assert any("é" in f.read_text(encoding="utf-8") for f in path.glob("*.json"))


def test_full_refresh_replaces_everything(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "id string, x int")
    store.full_refresh(df, str(tmp_path / "t"))
    assert [tuple(r) for r in store.full_refresh(df.where("x = 2"), str(tmp_path / "t")).collect()] == [
        ("b", 2)]


def test_upsert_is_idempotent(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "id string, x int")
    delta = spark.createDataFrame([("b", 3, 0), ("b", 4, 1), ("c", 5, 0)], "id string, x int, pos int")
    once = store.upsert(base, delta, "id", "pos")
    twice = store.upsert(once, delta, "id", "pos")
    want = {("a", 1), ("b", 4), ("c", 5)}
    assert {tuple(r) for r in once.collect()} == want == {tuple(r) for r in twice.collect()}


def test_upsert_without_position_refuses_repeated_keys(spark):
    base = spark.createDataFrame([("a", 1)], "id string, x int")
    delta = spark.createDataFrame([("a", 2), ("b", 3)], "id string, x int")
    assert {tuple(r) for r in store.upsert(base, delta).collect()} == {("a", 2), ("b", 3)}
    with pytest.raises(KeyRepeats):
        store.upsert(base, delta.unionByName(delta))


def test_incremental_loads(spark):
    stored = spark.createDataFrame([("a", 0), (None, 1)], "url string, n int")
    batch = spark.createDataFrame([("b", 5), ("a", 4), ("c", 3), ("b", 2)], "url string, n int")
    order = [r["url"] for r in store.new_only(batch, stored, "url", "n", 2).orderBy("n").collect()]
    assert order == ["b", "c"]
    assert store.new_only(batch, stored, "url", "n").count() == 3
    grown = store.append_unseen(stored, batch, "url", "n", 1)
    assert {tuple(r) for r in grown.collect()} == {("a", 0), (None, 1), ("b", 2)}
    assert store.append_unseen(stored, batch, "url", "n").where(F.col("url") == "c").count() == 1


def test_scratch_is_released(spark, monkeypatch):
    monkeypatch.setattr(session, "_scratch", {})
    kept = session.materialize(spark.range(3).toDF("n"), "released")
    (path,) = session._scratch[spark.sparkContext.applicationId]
    assert kept.count() == 3 and records.path_exists(spark, path)
    assert session.release_scratch(spark) == 1 and not records.path_exists(spark, path)
    assert session.release_scratch(spark) == 0
