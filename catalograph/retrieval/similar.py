"""Items like a given one: interesting terms of the seed, then a search for any of them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalograph.operators.lists import own_rows
from catalograph.operators.ordering import first_rows, top_n_per_group
from catalograph.retrieval.index import Index
from catalograph.retrieval.scoring import SCORE_PLACES, idf, per_field, term_factor
from catalograph.schema import SIMILAR_BY, SIMILAR_FIELDS
from catalograph.session import materialize

MAX_TERMS = 25
COMMON_TERMS = 100_000   # terms whose counts go to the postings, as most postings are theirs
BLOCK_HITS = 8_000_000   # postings of a block of items
BLOCK_TERMS = 8_000_000  # terms of a block of seeds
CELLS = 1 << 17          # scores, and postings, that a task handles at a time: they fit its processor's cache
STRETCH = 64             # scores of a seed of which the highest stands for all when the k best are looked for
WEIGHT_PLACES = 9


def mlt_terms(index: Index, seeds: DataFrame | list[str], fields=SIMILAR_BY,
              max_terms: int = MAX_TERMS) -> DataFrame:
    """The most interesting terms per seed item: (seed, field, term, df, weight).

    Weight is term frequency times inverse item frequency; ties go by field, then term.
    """
    own = index.frequencies(("id", "field", "term", "tf")).where(F.col("field").isin(list(fields)))
    words, stats = ["field", "term"], index.term_stats
    if isinstance(seeds, list):
        # Reads the seeds' buckets only.
        counted = own.where(F.col("id").isin(seeds)).join(stats, words)
    else:
        # The seeds and the counts of the commonest terms, so many at most, go to the items' buckets. Only the postings of
        # rarer terms move to their counts, and back.
        own = own.join(seeds.select("id").distinct().repartition(index.buckets, "id"), "id", "left_semi")
        common = F.broadcast(first_rows(stats, [F.col("df").desc(), *words], COMMON_TERMS))
        rare = own.join(common.select(*words), words, "left_anti").join(stats, words)
        counted = own.join(common, words).unionByName(rare.repartition(index.buckets, "id"))
    weight = F.round(F.col("tf") * (1 + F.log((index.total + 1) / (F.col("df") + 1))),
                     WEIGHT_PLACES)
    weighted = counted.select(F.col("id").alias("seed"), "field", "term", "df", weight.alias("weight"))
    return top_n_per_group(weighted, "seed",
                           [F.col("weight").desc(), F.col("field"), F.col("term")], max_terms)


def _weighed(index: Index, terms: DataFrame, fields, boost: bool) -> DataFrame:
    """Seed terms with ``w``, the most that one of them can add to an item's score."""
    best = F.max("weight").over(W.partitionBy("seed"))
    factor = F.col("weight") / best if boost else F.lit(1.0)
    items = per_field(index, fields, lambda f: f.items)
    return terms.withColumn("w", factor * idf(items, F.col("df"))).drop("weight")


def _sums(index: Index, terms: DataFrame, wanted: Column, fields) -> DataFrame:
    """(id, seed, s): summed scores of the given terms. Grouping by id and seed stays in the item's
    bucket; the seed itself is left out."""
    hits = (index.frequencies().where(wanted).join(terms, ["field", "term"])
            .where(F.col("id") != F.col("seed")))
    return hits.groupBy("id", "seed").agg(
        F.sum(F.col("w") * term_factor(index, fields)).alias("s"))


def _best(sums: DataFrame, k: int) -> DataFrame:
    """Top k per seed; the cut is applied in each task first, so only k rows per seed and task move."""
    scored = sums.select("seed", "id", F.round("s", SCORE_PLACES).alias("score"))
    return top_n_per_group(scored, "seed", [F.col("score").desc(), F.col("id")], k)


def more_like_this(index: Index, item_id: str, fields=SIMILAR_BY, k: int = 5,
                   boost: bool = False) -> DataFrame:
    """Top k items that share the seed's interesting terms, by summed score; never the seed.

    The seed's terms, at most ``MAX_TERMS`` rows, come to the driver and become literals of the scan.
    """
    rows = mlt_terms(index, [item_id], fields).collect()
    spark = index.spark
    terms = spark.createDataFrame(
        [tuple(r) for r in rows],
        "seed string, field string, term string, df bigint, weight double")
    pairs = [(F.col("field") == r["field"]) & (F.col("term") == r["term"]) for r in rows]
    wanted = reduce(lambda a, b: a | b, pairs, F.lit(False))
    weighed = F.broadcast(_weighed(index, terms, fields, boost))
    return _best(_sums(index, weighed, wanted, fields), k)


def similar_items(index: Index, item_id: str, fields=SIMILAR_BY, k: int = 5, boost: bool = False,
                  shown=SIMILAR_FIELDS) -> DataFrame:
    """``more_like_this`` with the display fields of each similar item, best first.

    The k ids come to the driver, and as literals they prune the read of the wide columns.
    """
    best = more_like_this(index, item_id, fields, k, boost).collect()
    items = own_rows(index.items).where(F.col("id").isin([r["id"] for r in best]))
    scored = index.spark.createDataFrame([tuple(r) for r in best], "seed string, id string, score double")
    names = [n for n in shown if n in index.items.columns]
    return (scored.join(items.select(*names), "id").select("seed", "score", *names)
            .orderBy(F.col("score").desc(), F.col("id")))


def similar_items_batch(index: Index, seeds: DataFrame, fields=SIMILAR_BY, k: int = 5, boost: bool = False,
                        shown=SIMILAR_FIELDS) -> DataFrame:
    """``more_like_this_batch`` with the display fields of each similar item. The k rows of each seed are dealt to the
    items' buckets; the items do not move."""
    names = [n for n in shown if n in index.items.columns]
    best = more_like_this_batch(index, seeds, fields, k, boost)
    return own_rows(index.items).select(*names).join(best, "id").select("seed", "score", *names)


def more_like_this_batch(index: Index, seeds: DataFrame, fields=SIMILAR_BY, k: int = 5,
                         boost: bool = False, first_items: int | None = None) -> DataFrame:
    """``more_like_this`` for a table of seed ids.

    Many seeds share common terms, and a joined row for every seed and item that meet in one of them is what would
    not scale. Seeds and items are dealt into blocks instead, and a block of seeds meets a block of items in one
    task, which adds up their scores in arrays and hands on the k best items of each seed. A block of items holds
    about ``BLOCK_HITS`` postings and a block of seeds about ``BLOCK_TERMS`` terms, so a task's memory does not grow
    with the tables; the number of tasks, and the pairs that are scored, grow with items times seeds.

    The seeds' terms are written first and numbered: then their size is known, and Spark broadcasts the numbers only
    under its own threshold and shuffles both sides by term beyond it. ``first_items`` steered an earlier method;
    it is accepted and has no effect.
    """
    spark = index.spark
    terms = materialize(_weighed(index, mlt_terms(index, seeds, fields), fields, boost), "seed-terms")
    # Written, as the numbers must not change when a task runs again.
    numbers = materialize(terms.groupBy("field", "term").agg(F.max("df").alias("df")).withColumn(
        "code", F.monotonically_increasing_id()), "seed-codes")
    # A term's df is the number of its postings.
    hits, held = numbers.agg(F.sum("df")).first()[0] or 0, terms.count()
    items, groups = max(2 * spark.sparkContext.defaultParallelism, -(-hits // BLOCK_HITS)), max(1, -(-held // BLOCK_TERMS))

    # Every meeting of two blocks is a partition of its own.
    places = F.split(F.lit(",".join(map(str, dealt_apart(spark, items * groups)))), ",")

    def block(key: str, n: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    asked = terms.join(numbers.drop("df"), ["field", "term"]).groupBy("seed").agg(
        F.sort_array(F.collect_list(F.struct("code", "w"))).alias("_t")).select(
        "seed", F.col("_t.code").alias("codes"), F.col("_t.w").alias("ws"),
        block("seed", groups).alias("_s")).withColumn("_i", every(items))
    own = index.frequencies().where(F.col("field").isin(list(fields)) & F.col("id").isNotNull())
    found = own.join(numbers.drop("df"), ["field", "term"]).select(
        "id", "code", term_factor(index, fields).alias("part"), block("id", items).alias("_i")).withColumn("_s", every(groups))
    met = [rows.withColumn("_b", F.get(places, F.col("_i") * groups + F.col("_s")).cast("int")).drop("_i", "_s").repartition(
        items * groups, "_b").groupBy("_b") for rows in (found, asked)]
    best = met[0].cogroup(met[1]).applyInArrow(best_of_block(k), "seed string, id string, score double")
    return top_n_per_group(best, "seed", [F.col("score").desc(), F.col("id")], k)


def dealt_apart(spark: SparkSession, n: int) -> list[int]:
    """``n`` numbers, as int columns, of which partitioning by hash puts one into each of ``n`` partitions."""
    tried = 16 * n
    while True:
        number = F.col("id").cast("int")
        rows = spark.range(tried).groupBy(F.pmod(F.hash(number), F.lit(n))).agg(F.min(number)).collect()
        if len(rows) == n:
            return [r[1] for r in sorted(rows)]
        tried *= 2


def best_of_block(k: int, cells: int = CELLS) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The k best items (seed, id, score) of each seed by rounded score, then id, among the items of one block.

    ``postings`` are (id, code, part), ``wanted`` are (seed, codes, ws). Seeds are taken together as long as their
    scores, and the postings of their terms, fit arrays of ``cells`` numbers; a seed alone may exceed them.
    """
    def best(postings: pa.Table, wanted: pa.Table) -> pa.Table:
        ids = postings["id"].combine_chunks().dictionary_encode() if postings.num_rows else None
        if ids is None or not wanted.num_rows:
            return pa.table({"seed": pa.array([], pa.string()), "id": pa.array([], pa.string()), "score": pa.array([], pa.float64())})
        # Items are numbered in the order of their ids.
        order = pc.sort_indices(ids.dictionary)
        names, n = ids.dictionary.take(order), len(order)
        number = np.empty(n, np.int64)
        number[order.to_numpy()] = np.arange(n)
        code = postings["code"].to_numpy()
        by_code = np.argsort(code, kind="stable")
        code, item, part = code[by_code], number[ids.indices.to_numpy()][by_code], postings["part"].to_numpy()[by_code]

        found = [_best_of(batch, names, code, item, part, k, cells) for batch in wanted.to_batches() if batch.num_rows]
        return pa.concat_tables(found)

    return best


def _best_of(wanted: pa.RecordBatch, names: pa.Array, code: np.ndarray, item: np.ndarray, part: np.ndarray, k: int, cells: int) -> pa.Table:
    """The best items of a batch of seeds; the postings (code, item, part) are sorted by code, and items are numbered as in ``names``."""
    n, seeds, codes = len(names), wanted["seed"], wanted["codes"]
    wide = -(-n // STRETCH) * STRETCH                                # scores of a seed, the last stretch filled up
    borders = np.concatenate([[0], np.cumsum(pc.list_value_length(codes).to_numpy())])
    asked, ws = codes.flatten().to_numpy(), wanted["ws"].flatten().to_numpy()
    first = np.searchsorted(code, asked, "left")
    size = np.searchsorted(code, asked, "right") - first
    hits = np.concatenate([[0], np.cumsum(size)])[borders]           # postings before each seed
    itself = pc.index_in(seeds, value_set=names).fill_null(-1).to_numpy()
    rows, columns, scores = [], [], []
    a = 0
    while a < len(seeds):
        b = min(max(int(np.searchsorted(hits, hits[a] + cells, "right")) - 1, a + 1), a + max(cells // n, 1), len(seeds))
        lo, hi = borders[a], borders[b]
        count = size[lo:hi]
        place = np.repeat(first[lo:hi] - (np.cumsum(count) - count), count)
        place += np.arange(len(place))
        # A score's place among those of all seeds: its seed's row, then its item.
        row = np.repeat(np.repeat(np.arange(b - a) * wide, np.diff(borders[a:b + 1])), count)
        row += item[place]
        added = np.repeat(ws[lo:hi], count)
        added *= part[place]
        sums = np.bincount(row, added, (b - a) * wide).reshape(b - a, wide)
        met = np.flatnonzero(itself[a:b] >= 0)
        sums[met, itself[a:b][met]] = 0.0
        # The k-th highest of the stretches' highest scores is no higher than the k-th score, so nothing that is below it by
        # more than rounding may lift is among the k best. Every shared term scores above 0.
        least = np.full(b - a, np.nextafter(0, 1))
        if k <= wide // STRETCH:
            highest = np.partition(sums.reshape(b - a, -1, STRETCH).max(axis=2), -k, axis=1)[:, -k]
            least = np.maximum(least, highest - 2 * 10.0 ** -SCORE_PLACES)
        kept = np.flatnonzero(sums >= least[:, None])
        seed, column = np.divmod(kept, wide)
        rounded = np.floor(sums.ravel()[kept] * 10 ** SCORE_PLACES + 0.5).astype(np.int64)
        order = np.lexsort((column, -rounded, seed))
        seed, column, rounded = seed[order], column[order], rounded[order]
        begins = np.searchsorted(seed, np.arange(b - a))
        top = np.arange(len(seed)) - begins[seed] < k
        rows.append(seed[top] + a)
        columns.append(column[top])
        scores.append(rounded[top] / 10 ** SCORE_PLACES)
        a = b
    return pa.table({"seed": seeds.take(pa.array(np.concatenate(rows))), "id": names.take(pa.array(np.concatenate(columns))),
                     "score": np.concatenate(scores)})
