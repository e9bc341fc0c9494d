"""Reading, writing and incremental loading, on files made from the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as Y

from catalograph import schema as C
from catalograph.operators.grouping import source_counts
from catalograph.session import scratch_path
from catalograph.sources import records, store
from catalograph.sources.tsv import read_tsv, scan_filtered
from workload import tables as T
from workload.registry import query


def _written_tsv(spark, sf):
    """The bulk title table as an unquoted gzip file with the usual spellings of null."""
    path = scratch_path(spark, "tsv")
    raw = T.basics(spark, sf).drop("pos").withColumn(
        "genres", F.when(F.col("titleType") == "F", "\\N").when(F.col("titleType") == "P", "NA")
        .otherwise(F.concat(F.lit('"'), "genres")))
    (raw.write.option("sep", "\t").option("header", "true").option("quote", "")
     .option("compression", "gzip").csv(path))
    return path


@query("scan_tsv", f"""WITH {T.BULK} SELECT tconst, titleType, primaryTitle, startYear,
    CASE WHEN titleType = 'O' THEN '"' || genres END AS genres FROM basics""")
def _(spark, sf):
    return read_tsv(spark, _written_tsv(spark, sf), C.TITLE_BASICS, spread=True)


@query("scan_semi_filter", f"""WITH {T.BULK} SELECT tconst, titleType, primaryTitle FROM basics
    WHERE tconst IN (SELECT tconst FROM ratings WHERE numVotes > 3000)""")
def _(spark, sf):
    ids = T.ratings(spark, sf).where("numVotes > 3000").select("tconst")
    read = read_tsv(spark, _written_tsv(spark, sf), C.TITLE_BASICS, spread=True)
    return scan_filtered(read, "tconst", ids).select("tconst", "titleType", "primaryTitle")


REVIEW_COLUMNS = ("title", "year", "reviews", "critic", "rating", "url")


@query("scan_json_array", f"""WITH {T.SOURCES} SELECT {', '.join(c for c in REVIEW_COLUMNS if c != 'year')},
    CASE WHEN pos % 7 <> 0 THEN year END AS year FROM reviews""")
def _(spark, sf):
    path = scratch_path(spark, "array")
    rows = T.customer_reviews(spark, sf)
    # Each file holds one JSON array of at most 1,000 records, as the runs of a crawler leave them.
    # Some of its records have a word where a number belongs.
    record = F.to_json(F.struct(*rows.drop("pos").columns))
    mistyped = F.regexp_replace(record, '"year":[0-9]+', '"year":"n/a"')
    runs = rows.select(F.floor(F.col("pos") / 1000).alias("run"),
                       F.when(F.col("pos") % 7 == 0, mistyped).otherwise(record).alias("record"))
    runs = runs.groupBy("run").agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("record"), ","), F.lit("]")).alias("value"))
    runs.write.partitionBy("run").text(path)
    return records.read_json_array(spark, path, C.REVIEW).select(*REVIEW_COLUMNS)


@query("sink_json", f"WITH {T.ITEMS} SELECT id, title, plot, year FROM items")
def _(spark, sf):
    path = scratch_path(spark, "sink")
    records.write_items(T.items(spark, sf).select("id", "title", "plot", "year"), path)
    return records.read_json_lines(spark, path, Y.StructType.fromDDL(
        "id string, title string, plot string, year int"))


@query("load_full_refresh", f"WITH {T.ITEMS} SELECT id, title, year FROM items WHERE rating > 4")
def _(spark, sf):
    path = scratch_path(spark, "stored")
    items = T.items(spark, sf).select("id", "title", "year", "rating")
    store.full_refresh(items, path)
    return store.full_refresh(items.where("rating > 4").drop("rating"), path)


@query("upsert_by_key", """SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN d.lang
    ELSE 'label ' || l.quality END AS lang FROM documents d LEFT JOIN labels l USING (doc_id)
    UNION ALL SELECT doc_id, 'label ' || quality FROM labels
    WHERE doc_id NOT IN (SELECT doc_id FROM documents)""")
def _(spark, sf):
    base = T.table(spark, sf, "documents").select("doc_id", "lang")
    delta = T.table(spark, sf, "labels").select(
        "doc_id", F.concat(F.lit("label "), "quality").alias("lang"), F.col("doc_id").alias("pos"))
    earlier = delta.withColumns({"lang": F.lit("overwritten"), "pos": F.col("pos") - 1})
    return store.upsert(base, earlier.unionByName(delta), "doc_id", "pos")


@query("incremental_new", """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (
    SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') ORDER BY o_orderkey LIMIT 800""")
def _(spark, sf):
    stored = T.table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey"))
    candidates = T.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return store.new_only(candidates, stored, "o_orderkey", "o_orderkey", 800)


@query("append_unseen", """WITH stored AS (SELECT user_id, event_id, event_type FROM events
      WHERE event_type = 'error'),
    fresh AS (SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type
      FROM events WHERE event_type <> 'error' AND user_id NOT IN (SELECT user_id FROM stored)
      GROUP BY user_id ORDER BY event_id LIMIT 100)
    SELECT * FROM stored UNION ALL SELECT * FROM fresh""")
def _(spark, sf):
    events = T.table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return store.append_unseen(events.where("event_type = 'error'"),
                               events.where("event_type <> 'error'"), "user_id", "event_id", 100)


@query("load_summary", """SELECT 'base' AS source, count(*) AS records FROM orders
    UNION ALL SELECT 'enrichment', count(*) FROM labels
    UNION ALL SELECT 'reviews', count(*) FROM customer""")
def _(spark, sf):
    return source_counts({"base": T.basics(spark, sf), "enrichment": T.enrichment(spark, sf),
                          "reviews": T.customer_reviews(spark, sf)})
