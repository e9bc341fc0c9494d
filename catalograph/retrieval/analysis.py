"""Text analysis: tokens, stop words, stems. Index and query text are treated alike."""

from __future__ import annotations

from dataclasses import dataclass, field

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.retrieval.stemming import stem, stem_all

# A word: letters, marks, digits and underscores, joined inside by an apostrophe or a full stop.
TOKEN = r"[\p{L}\p{M}\p{N}_]+(?:['’.][\p{L}\p{M}\p{N}_]+)*"
VALUE_GAP = 100          # positions left free between two values of one field

# The usual English stop words of full-text search, in natural order (fixed values).
STOP_WORDS = ("a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into",
              "is", "it", "no", "not", "of", "on", "or", "such", "that", "the", "their", "then",
              "there", "these", "they", "this", "to", "was", "will", "with")

TITLE_FIELDS = ("title",)
GENERAL_FIELDS = ("plot", "reviews")
TEXT_FIELDS = TITLE_FIELDS + GENERAL_FIELDS
KEYWORD_FIELDS = ("genres", "directors", "cast", "site", "poster")
CATCH_ALL_FIELD = "text"
EVERY_FIELD = "_text_"
CATCH_ALL = ("title", "plot", "reviews", "genres", "directors", "cast")


@dataclass(frozen=True)
class Profile:
    """How text becomes terms: stop words, whether general text is stemmed (titles never), whether the main fields
    together are indexed once more as the general field ``text``, and whether all fields, numbers
    included, are as ``_text_``."""
    stem: bool = True
    stop: tuple[str, ...] = field(default=STOP_WORDS)
    catch_all: bool = False
    every_field: bool = False

    def stems(self, name: str) -> bool:
        return self.stem and (name in GENERAL_FIELDS or name in (CATCH_ALL_FIELD, EVERY_FIELD))

    def query_terms(self, text: str, name: str) -> list[tuple[int, str]]:
        """(position, term) of a query text for one field; a handful of words, on the driver."""
        words = regex.findall(TOKEN, text.lower())
        kept = [(i, w) for i, w in enumerate(words) if w not in self.stop]
        return [(i, stem(w) if self.stems(name) else w) for i, w in kept]


PLAIN = Profile(stem=False)
STEMMED = Profile(stem=True)


def tokenize(x: Column | str) -> Column:
    """Lower-case tokens in order."""
    text = F.col(x) if isinstance(x, str) else x
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def without_stops(tokens: Column, stop=STOP_WORDS) -> Column:
    """Tokens with removed words as null, so that positions keep their gaps."""
    if not stop:
        return tokens
    return F.transform(tokens, lambda t: F.when(~t.isin(list(stop)), t))


def analyze_title(x: Column | str, stop=STOP_WORDS) -> Column:
    """Terms of a title: no stemming."""
    return F.array_compact(without_stops(tokenize(x), stop))


def analyze_general(x: Column | str, stop=STOP_WORDS) -> Column:
    """Stemmed terms of general text."""
    return F.array_compact(stem_all(without_stops(tokenize(x), stop)))


def analyze_keyword(df: DataFrame, name: str) -> DataFrame:
    """Whole values as terms, case kept."""
    return df.select("id", F.explode(name).alias("term"))


def positioned(values: Column, profile: Profile, name: str) -> Column:
    """Terms of all values of one text field as one array; the index in the array is the position."""
    pad = F.array_repeat(F.lit(None).cast("string"), VALUE_GAP)
    tokens = F.flatten(F.transform(
        values, lambda v: F.concat(without_stops(tokenize(v), profile.stop), pad)))
    return stem_all(tokens) if profile.stems(name) else tokens


def catch_all(fields=CATCH_ALL) -> Column:
    """All given fields as one searchable text; list values are joined."""
    return F.concat_ws(" ", *fields)
