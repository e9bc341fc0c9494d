"""Marked fragments of the text that matched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.functions.scalars import first_or_blank, snippet
from catalograph.retrieval.analysis import TOKEN, Profile, tokenize
from catalograph.retrieval.stemming import stem_all

FRAGMENT = 200
MARK, END = "<mark>", "</mark>"


def matched_words(x: Column, terms: list[str], stems: bool) -> Column:
    """Lower-case words of the text whose term is wanted."""
    tokens = F.array_distinct(tokenize(x))
    if not stems:
        return F.filter(tokens, lambda t: t.isin(terms))
    return F.array_compact(F.zip_with(
        tokens, stem_all(tokens), lambda word, term: F.when(term.isin(terms), word)))


def fragment(x: Column, words: Column, size: int = FRAGMENT) -> Column:
    """Best slice of the text with its matched words marked; the whole text without a match.

    The text is cut into consecutive slices; the one with most matched words is taken, the earliest
    on ties. Its pieces (words and single other characters) are put together again, matched words
    wrapped, so that neighbouring or repeated hits never wrap twice.
    """
    slices = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.char_length(x) / size).cast("int") - 1, F.lit(0))),
        lambda i: F.substring(x, i * size + 1, F.lit(size)))
    scored = F.transform(slices, lambda s, i: F.struct(
        F.size(F.filter(tokenize(s), lambda t: F.array_contains(words, t))).alias("hits"),
        (-i).alias("place"), s.alias("text")))
    best = F.array_max(scored)
    pieces = F.regexp_extract_all(best["text"], F.lit(f"(?s){TOKEN}|."), F.lit(0))
    marked = F.array_join(F.transform(pieces, lambda p: F.when(
        F.array_contains(words, F.lower(p)), F.concat(F.lit(MARK), p, F.lit(END))).otherwise(p)),
        "")
    return F.when(best["hits"] > 0, marked).otherwise(x)


def highlight_fragment(df: DataFrame, field: str, query: str, profile: Profile,
                       name: str = "fragment", size: int = FRAGMENT) -> DataFrame:
    """Add the marked fragment of a text field for a query."""
    terms = sorted({t for _, t in profile.query_terms(query, field)})
    text = F.col(field)
    if not terms:
        return df.withColumn(name, text)
    # Two steps, so that the words are found once and not once per slice and piece.
    found = df.withColumn("_words", matched_words(text, terms, profile.stems(field)))
    return found.withColumn(name, fragment(text, F.col("_words"), size)).drop("_words")


def result_page(hits: DataFrame, query: str, profile: Profile) -> DataFrame:
    """Display columns of one page of hits: marked plot and review, snippet."""
    shown = hits.withColumns({"_plot": F.coalesce("plot", F.lit("")),
                              "_review": first_or_blank("reviews")})
    if query not in ("", "*:*"):
        terms = {f: sorted({t for _, t in profile.query_terms(query, f)})
                 for f in ("plot", "reviews")}
        words = {f: matched_words(F.col(c), terms[f], profile.stems(f))
                 if terms[f] else F.array().cast("array<string>")
                 for f, c in (("plot", "_plot"), ("reviews", "_review"))}
        shown = shown.withColumns({"_pw": words["plot"], "_rw": words["reviews"]}).withColumns({
            "highlighted_plot": fragment(F.col("_plot"), F.col("_pw")),
            "highlighted_reviews": fragment(F.col("_review"), F.col("_rw"))}).drop("_pw", "_rw")
    else:
        shown = shown.withColumns({"highlighted_plot": F.col("_plot"),
                                   "highlighted_reviews": F.col("_review")})
    return shown.withColumn(
        "snippet", snippet("highlighted_plot", "highlighted_reviews")).drop("_plot", "_review")
