"""Refresh of an index for changed items: only the buckets that hold one are written again.

The new content of the touched buckets is staged beside the tables, first its items, then the postings made from them; neither
leaves its bucket on the way, only what changed is shuffled. Counts of terms and field lengths are adjusted by what the changed
items held before and hold now. A journal
then names the files to remove and to move in, and the swap follows it; one that is cut off is done again from the
journal when the index is next opened. One writer at a time; readers open the index again afterwards.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.operators.joins import require_unique
from catalograph.retrieval.index import (FieldStats, Index, _bucketed, count_rows, field_stats, term_stats, terms_path,
                                         write_meta)

_BUCKET = re.compile(r"_(\d+)(?:\..*)?$")
TABLES = ("items", "postings")


class _Files:
    """The shared file system behind a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm = spark.sparkContext._jvm
        self.system = self.path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        if not self.system.exists(self.path(folder)):
            return []
        return [s.getPath().getName() for s in self.system.listStatus(self.path(folder))]

    def remove(self, name: str) -> None:
        self.system.delete(self.path(name), True)

    def move(self, old: str, new: str) -> None:
        """Move a file; one that has been moved before is left."""
        if self.system.exists(self.path(old)) and not self.system.rename(self.path(old), self.path(new)):
            raise OSError(f"could not move {old} to {new}")

    def read(self, name: str) -> str | None:
        if not self.system.exists(self.path(name)):
            return None
        stream = self.system.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Write beside and rename, so that a file of this name is always whole."""
        stream = self.system.create(self.path(name + ".new"), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.remove(name)
        self.move(name + ".new", name)


def _bucket_of(name: str) -> int | None:
    found = _BUCKET.search(name) if name.startswith("part-") else None
    return int(found[1]) if found else None


def _by_buckets(index: Index, files: _Files, table: str, touched: set[int]) -> DataFrame:
    """Rows of the touched buckets, read from their files alone and dealt by id as the buckets are."""
    rows = index.items if table == "items" else index.postings
    if len(touched) == index.buckets:
        return rows
    names = [n for n in files.names(f"{index.path}/{table}") if _bucket_of(n) in touched]
    return rows.where(F.col("_metadata.file_name").isin(names))


def refresh_index(index: Index, changed: DataFrame, removed: DataFrame | None = None) -> Index:
    """The index after ``changed`` items replaced those of the same id or were added, and items whose ids
    ``removed(id)`` lists left.

    ``changed`` has the items' columns (a missing one is null); an item in several rows has ``part``. An id both
    removed and changed is changed. An id that comes twice, or is null, is refused or left out. Equal to building the index anew
    over all items, at the cost of the touched buckets and the term counts.
    """
    spark, path = index.spark, index.path
    files = _Files(spark, path)
    changed = changed if "part" in changed.columns else changed.withColumn("part", F.lit(0))
    changed = changed.where("id IS NOT NULL")
    require_unique(changed.select(F.struct("id", "part").alias("row")), "row", "changed")
    ids = changed.select("id")
    ids = (ids if removed is None else ids.unionByName(removed.select("id").where("id IS NOT NULL"))).distinct()
    stage = f"{path}/staged-{uuid.uuid4().hex}"
    # Written, as the ids are read for each table; they go to the buckets, whose rows stay where they are.
    ids.write.parquet(f"{stage}/ids")
    ids = spark.read.schema(ids.schema).parquet(f"{stage}/ids")
    # the bucket numbers, never the ids, come to the driver
    touched = {r[0] for r in ids.select(F.pmod(F.hash("id"), F.lit(index.buckets))).distinct().collect()}
    if not touched:
        files.remove(stage)
        return index
    ids = ids.repartition(index.buckets, "id")
    for table in (index.items_table, index.postings_table):
        spark.catalog.refreshTable(table)
    old_items, old_postings = (_by_buckets(index, files, t, touched) for t in TABLES)

    names = {t: f"catalograph_{uuid.uuid4().hex}_{t}" for t in TABLES}
    columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in index.items.schema]
    new = old_items.join(ids, "id", "left_anti").unionByName(changed.repartition(index.buckets, "id"), allowMissingColumns=True)
    _bucketed(new.select(*columns), names["items"], f"{stage}/items", index.buckets, ["id"])
    before, after = old_items.where("part = 0").count(), count_rows(spark.table(names["items"]))
    _bucketed(after.postings(spark.table(names["items"]), index.profile), names["postings"], f"{stage}/postings",
              index.buckets, ["field", "term"])

    # ---- statistics by difference: of the postings that left and those that came, as all others are as before
    left, came = (p.join(ids, "id", "left_semi") for p in (old_postings, spark.table(names["postings"])))
    fields = {name: [f.items, f.terms] for name, f in index.fields.items()}
    for sign, postings in ((-1, left), (1, came)):
        for r in field_stats(postings).collect():
            entry = fields.setdefault(r["field"], [0, 0])
            entry[0] += sign * r["n"]
            entry[1] += sign * r["terms"]
    generation = index.generation + 1
    minus = term_stats(left, index.has_parts).withColumn("df", -F.col("df"))
    terms = (index.term_stats.unionByName(minus).unionByName(term_stats(came, after.parts > 0)).groupBy("field", "term")
             .agg(F.sum("df").alias("df")).where("df > 0"))
    terms.sortWithinPartitions("field", "term").write.parquet(terms_path(path, generation))
    refreshed = replace(index, terms_path=terms_path(path, generation), total=index.total - before + after.items, generation=generation,
                        fields={name: FieldStats(n, total) for name, (n, total) in fields.items() if n},
                        has_parts=index.has_parts or after.parts > 0)

    # ---- the swap
    journal = {"stage": stage, "swap": {t: {
        "remove": [n for n in files.names(f"{path}/{t}") if _bucket_of(n) in touched],
        "move": [n for n in files.names(f"{stage}/{t}") if _bucket_of(n) is not None]} for t in TABLES},
        "terms": index.terms_path, "generation": generation}
    write_meta(refreshed, f"{stage}/meta")
    files.write(f"{path}/journal", json.dumps(journal))
    finish(spark, path)
    for t in TABLES:
        spark.sql(f"DROP TABLE {names[t]}")
    for table in (index.items_table, index.postings_table):
        spark.catalog.refreshTable(table)
    return refreshed


def finish(spark: SparkSession, path: str) -> None:
    """Do what the journal names, if there is one. Doing it again after a failure has the same effect."""
    files = _Files(spark, path)
    text = files.read(f"{path}/journal")
    if text is None:
        return
    journal = json.loads(text)
    for table, swap in journal["swap"].items():
        for name in swap["remove"]:
            files.remove(f"{path}/{table}/{name}")
        for name in swap["move"]:
            files.move(f"{journal['stage']}/{table}/{name}", f"{path}/{table}/{name}")
    files.move(f"{journal['stage']}/meta", f"{path}/meta/generation={journal['generation']}")
    files.remove(journal["stage"])
    files.remove(journal["terms"])
    files.remove(f"{path}/journal")
