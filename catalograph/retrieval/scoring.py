"""Ranked search over the index: fields, weights, phrases, required and excluded clauses."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.retrieval.analysis import KEYWORD_FIELDS
from catalograph.retrieval.index import Index
from catalograph.schema import FIELD_BOOSTS, PHRASE_BOOSTS

K1, B = 1.2, 0.75        # fixed values of the ranking function
SCORE_PLACES = 6         # scores are compared and returned at this precision


def idf_value(n: int, df: int) -> float:
    return math.log(1 + (n - df + 0.5) / (df + 0.5))


def idf(n: Column, df: Column) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def tf_factor(tf: Column, dl: Column, average: Column) -> Column:
    return tf / (tf + K1 * ((1 - B) + B * dl / average))


def per_field(index: Index, fields, read) -> Column:
    """A statistic of the row's field, as one literal per field."""
    column = F.lit(None)
    for name in sorted(fields):
        if name in index.fields:
            column = F.when(F.col("field") == name, read(index.fields[name])).otherwise(column)
    return column


def term_factor(index: Index, fields) -> Column:
    """Frequency part of BM25. Whole-value fields have no length: factor 1/2.2."""
    keyword = F.col("field").isin(list(KEYWORD_FIELDS))
    return F.when(keyword, F.lit(1.0 / (1.0 + K1))).otherwise(tf_factor(
        F.col("tf"), F.col("dl"), per_field(index, fields, lambda f: f.average)))


@dataclass(frozen=True)
class Wanted:
    """One term looked for in one field; hits of one slot compete, slots add up.

    A term of a phrase has the phrase's number of terms as ``size`` and its distance from the first as ``shift``.
    """
    slot: int
    field: str
    term: str
    boost: float = 1.0
    shift: int = 0
    size: int = 1


def _any_of(wanted: list[Wanted]) -> Column:
    """Literal membership, so that it reaches the Parquet scan."""
    return (F.col("field").isin(sorted({w.field for w in wanted}))
            & F.col("term").isin(sorted({w.term for w in wanted})))


def item_counts(index: Index, wanted: list[Wanted]) -> dict[tuple[str, str], int]:
    """Items per wanted field and term: one row per query word and field comes to the driver."""
    if not wanted:
        return {}
    rows = index.term_stats.where(_any_of(wanted)).collect()
    return {(r["field"], r["term"]): r["df"] for r in rows}


def _weights(index: Index, wanted: list[Wanted]) -> list[tuple]:
    """(slot, field, term, shift, size, w) of what the index can have. A phrase weighs the summed idf of its terms,
    and a field that lacks one of them cannot have it."""
    counts = item_counts(index, wanted)
    phrases: dict[tuple[int, str], list[Wanted]] = {}
    rows = []
    for w in wanted:
        if w.size > 1:
            phrases.setdefault((w.slot, w.field), []).append(w)
        elif (w.field, w.term) in counts:
            rows.append((w.slot, w.field, w.term, 0, 1, w.boost * idf_value(index.fields[w.field].items, counts[w.field, w.term])))
    for terms in phrases.values():
        if all((w.field, w.term) in counts for w in terms):
            weight = terms[0].boost * sum(idf_value(index.fields[w.field].items, counts[w.field, w.term]) for w in terms)
            rows += [(w.slot, w.field, w.term, w.shift, w.size, weight) for w in terms]
    return rows


def slot_scores(index: Index, wanted: list[Wanted], ids: DataFrame | None = None) -> DataFrame:
    """(id, slot, s): best boosted score over fields per item and slot, words and phrases in one scan.

    The broadcast frame holds one row per query word and field. Places of phrases, scores and the restriction to given
    ids stay in the item's bucket; positions are read only if there is a phrase.
    """
    rows = _weights(index, wanted)
    if not rows:
        return index.spark.createDataFrame([], "id string, slot int, s double")
    weights = index.spark.createDataFrame(rows, "slot int, field string, term string, shift int, size int, w double")
    phrases = any(size > 1 for *_, size, _ in rows)
    found = index.postings.select("id", "field", "term", "tf", "dl", "positions") if phrases else index.frequencies()
    found = found.where(_any_of([w for w in wanted if w.term in {r[2] for r in rows}]))
    if ids is not None:
        found = found.join(ids.select("id"), "id", "left_semi")
    hits = found.join(F.broadcast(weights), ["field", "term"])
    if phrases:
        # A phrase begins where all its terms point to; a word has one row whatever its places, summed over parts.
        starts = F.when(F.col("size") > 1, F.transform("positions", lambda p: p - F.col("shift"))).otherwise(
            F.array(F.lit(None).cast("bigint")))
        met = hits.select("id", "slot", "field", "size", "w", "tf", "dl", F.explode(starts).alias("start")).groupBy(
            "id", "slot", "field", "start").agg(F.count("*").alias("met"), F.max("size").alias("size"), F.max("w").alias("w"),
                                                F.sum("tf").alias("tf"), F.max("dl").alias("dl"))
        met = met.where((F.col("size") == 1) | (F.col("met") == F.col("size")))
        hits = met.groupBy("id", "slot", "field").agg(
            F.when(F.max("size") > 1, F.count("*")).otherwise(F.max("tf")).alias("tf"), F.max("dl").alias("dl"), F.max("w").alias("w"))
    score = F.col("w") * term_factor(index, {field for _, field, *_ in rows})
    return hits.groupBy("id", "slot").agg(F.max(score).alias("s"))


def _phrase(index: Index, text: str, boosts: dict[str, float], slot: int) -> list[Wanted]:
    """The text as a phrase of each text field; none for fewer than two terms."""
    wanted = []
    for field, boost in boosts.items():
        terms = index.profile.query_terms(text, field) if field not in KEYWORD_FIELDS else []
        if len(terms) > 1:
            wanted += [Wanted(slot, field, term, boost, place - terms[0][0], len(terms)) for place, term in terms]
    return wanted


def _phrase_or_value(index: Index, text: str, boosts: dict[str, float], slot: int) -> list[Wanted]:
    """As ``_phrase``, and the whole text of several words as a value of the whole-value fields."""
    wanted = _phrase(index, text, boosts, slot)
    if len(index.profile.query_terms(text, "title")) > 1:
        wanted += [Wanted(slot, f, text.strip(), b) for f, b in boosts.items() if f in KEYWORD_FIELDS]
    return wanted


def search_field(index: Index, field: str, text: str) -> DataFrame:
    """BM25 of one field: sum over the query's terms."""
    return _ranked(slot_scores(index, _words(index, text, {field: 1.0})))


def _words(index: Index, text: str, boosts: dict[str, float], first_slot: int = 0) -> list[Wanted]:
    """Query words per text field; whole-value fields are compared with the whole query text."""
    wanted = []
    whole = text.strip()
    for field, boost in boosts.items():
        if field in KEYWORD_FIELDS:
            wanted.append(Wanted(first_slot - 1, field, whole, boost))
        else:
            wanted += [Wanted(first_slot + place, field, term, boost)
                       for place, term in index.profile.query_terms(text, field)]
    return wanted


def _ranked(slots: DataFrame) -> DataFrame:
    return slots.groupBy("id").agg(F.round(F.sum("s"), SCORE_PLACES).alias("score"))


def _weighted_slots(index: Index, text: str, boosts, people_tokenized: bool,
                    ids: DataFrame | None) -> DataFrame:
    if not people_tokenized:
        return slot_scores(index, _words(index, text, boosts), ids)
    # Opt-in: a word of a person's name is enough, compared without case.
    people = [f for f in ("cast", "directors") if f in boosts]
    words = index.profile.query_terms(text, "title")
    plain = {f: b for f, b in boosts.items() if f not in people}
    base = slot_scores(index, _words(index, text, plain), ids)
    parts = [base]
    for field in people:
        named = index.postings.where(F.col("field") == field)
        for place, word in words:
            hit = F.array_contains(F.split(F.lower("term"), r"\s+"), word)
            rows = named.where(hit).select("id").distinct()
            rows = rows if ids is None else rows.join(ids.select("id"), "id", "left_semi")
            parts.append(rows.select("id", F.lit(place).alias("slot"),
                                     F.lit(boosts[field] / (1 + K1)).alias("s")))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.groupBy("id", "slot").agg(F.max("s").alias("s"))


def search_weighted(index: Index, text: str, boosts: dict[str, float] = FIELD_BOOSTS,
                    people_tokenized: bool = False, ids: DataFrame | None = None) -> DataFrame:
    """Any query word in any field: per word the best boosted field, summed over the words."""
    return _ranked(_weighted_slots(index, text, boosts, people_tokenized, ids))


PHRASE = -2              # slot of the phrase, which competes with no word


def phrase_boost(index: Index, text: str, boosts: dict[str, float] = PHRASE_BOOSTS,
                 ids: DataFrame | None = None) -> DataFrame:
    """(id, boost): best boosted phrase score over fields, for queries of at least two words."""
    return slot_scores(index, _phrase_or_value(index, text, boosts, PHRASE), ids).select("id", F.col("s").alias("boost"))


def search_phrase_boost(index: Index, text: str, boosts: dict[str, float] = FIELD_BOOSTS,
                        phrases: dict[str, float] = PHRASE_BOOSTS,
                        ids: DataFrame | None = None) -> DataFrame:
    """Weighted search with the phrase boost added; phrases never change which items match."""
    slots = slot_scores(index, _words(index, text, boosts) + _phrase_or_value(index, text, phrases, PHRASE), ids)
    boosted = F.col("slot") == PHRASE
    sums = slots.groupBy("id").agg(F.sum(F.when(~boosted, F.col("s"))).alias("base"), F.max(F.when(boosted, F.col("s"))).alias("boost"))
    return sums.where("base IS NOT NULL").select("id", F.round(
        F.col("base") + F.coalesce("boost", F.lit(0.0)), SCORE_PLACES).alias("score"))


@dataclass(frozen=True)
class Clause:
    """A user-level condition: a word, or several words as a phrase, in one field or in all."""
    text: str
    field: str | None = None
    phrase: bool = False


def _clause_slots(index: Index, clause: Clause, boosts, first: int) -> list[Wanted]:
    """What a clause looks for, in slots from ``first`` on."""
    fields = {clause.field: 1.0} if clause.field else dict(boosts)
    if clause.phrase:
        return _phrase(index, clause.text, fields, first)
    return _words(index, clause.text, fields, first + 1)


def boolean_terms(index: Index, must: list[Clause] = (), should: list[Clause] = (),
                  must_not: list[Clause] = (),
                  boosts: dict[str, float] = FIELD_BOOSTS, ids: DataFrame | None = None) -> DataFrame:
    """Items with every required, no excluded and, if nothing is required, some optional clause.

    The words and phrases of all clauses are slots of one scan; one grouping settles the clauses of an item.
    """
    clauses = [*must, *should, *must_not]
    wanted_slots: list[Wanted] = []
    of_slot = F.lit(None).cast("int")
    first = 0
    for number, clause in enumerate(clauses):
        found = _clause_slots(index, clause, boosts, first)
        wanted_slots += found
        after = max([w.slot for w in found], default=first) + 1
        of_slot = F.when((F.col("slot") >= first) & (F.col("slot") < after), number).otherwise(of_slot)
        first = after
    slots = slot_scores(index, wanted_slots, ids).withColumn("clause", of_slot)
    met = slots.groupBy("id", "clause").agg(F.sum("s").alias("s"))
    wanted = len(must) + len(should)
    scored = met.groupBy("id").agg(
        F.count_if(F.col("clause") < len(must)).alias("required"),
        F.count_if(F.col("clause") >= wanted).alias("excluded"),
        F.count_if(F.col("clause") < wanted).alias("met"),
        F.sum(F.when(F.col("clause") < wanted, F.col("s"))).alias("s"))
    if wanted:
        kept = scored.where((F.col("required") == len(must)) & (F.col("excluded") == 0)
                            & (F.col("met") > 0))
        return kept.select("id", F.round("s", SCORE_PLACES).alias("score"))
    own = index.items.where("part = 0").select("id")
    return own.join(scored.where("excluded > 0").select("id"), "id", "left_anti").select(
        "id", F.lit(1.0).alias("score"))
