"""Column functions: text cleaning, parsing, formatting. All stay inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalograph.schema import ITEM_URL

# Whitespace as Unicode text handling understands it; the short class of the engine is ASCII only.
SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _nonempty(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def strip(x: Column | str) -> Column:
    """Trim Unicode whitespace from both ends."""
    return F.regexp_replace(_col(x), f"^{SPACE}+|{SPACE}+\\z", "")


def clean_text(x: Column | str) -> Column:
    """Collapse whitespace runs to one space and trim; null becomes the empty string."""
    return F.coalesce(F.trim(F.regexp_replace(_col(x), f"{SPACE}+", " ")), F.lit(""))


def extract_year(x: Column | str) -> Column:
    """First 19xx or 20xx anywhere in the text, else null."""
    return _nonempty(F.regexp_extract(_col(x), "(?:19|20)[0-9]{2}", 0)).try_cast("int")


def normalize_rating(value: Column | str, scale: Column | float = 10.0) -> Column:
    """Rescale to 0..10 with one decimal, ties to even; a zero scale gives 0.0."""
    top = scale if isinstance(scale, Column) else F.lit(float(scale))
    rescaled = F.bround(_col(value) / F.nullif(top, F.lit(0.0)) * 10.0, 1)
    return F.when(top == 0.0, F.lit(0.0)).otherwise(rescaled)


def hash_id(x: Column | str, prefix: str = "") -> Column:
    """First twelve hex digits of the md5, optionally after ``prefix_``."""
    digest = F.substring(F.md5(_col(x)), 1, 12)
    return F.concat(F.lit(prefix + "_"), digest) if prefix else digest


def extract_number(x: Column | str) -> Column:
    """First run of digits and commas as an integer; a run of commas only gives null."""
    run = F.regexp_extract(_col(x), "[0-9,]+", 0)
    return _nonempty(F.replace(run, F.lit(","))).try_cast("bigint")


def split_clean(x: Column | str, delimiter: str = ",") -> Column:
    """Split on a literal delimiter, trim the pieces and drop empty ones; null gives []."""
    pieces = F.transform(F.split(_col(x), re.escape(delimiter), -1), strip)
    return F.coalesce(F.filter(pieces, lambda p: p != ""), F.array().cast("array<string>"))


def truncate_words(x: Column | str, limit: int = 500) -> Column:
    """Cut a long text at the last space within ``limit`` characters and add dots."""
    text = _col(x)
    head = F.regexp_replace(F.substring(text, 1, limit), " [^ ]*\\z", "")
    return F.when(F.char_length(text) <= limit, text).otherwise(F.concat(head, F.lit("...")))


def truncate_chars(x: Column | str, limit: int = 300, trim: bool = False) -> Column:
    """Cut a long text after ``limit`` characters and add dots."""
    text = _col(x)
    head = F.substring(text, 1, limit)
    head = strip(head) if trim else head
    return F.when(F.char_length(text) <= limit, text).otherwise(F.concat(head, F.lit("...")))


def title_year_key(title: Column | str, year: Column | str) -> Column:
    """``lower(title)_year`` without trimming; null when either part is null."""
    return F.concat(F.lower(_col(title)), F.lit("_"), _col(year).cast("string"))


def digits_int(x: Column | str) -> Column:
    """Integer only when every character is a digit."""
    return F.when(_col(x).rlike("^[0-9]+\\z"), _col(x).try_cast("int"))


def try_year(x: Column | str) -> Column:
    """Year as an integer; text that is no number gives null."""
    return strip(_col(x).cast("string")).try_cast("int")


def rating_value(ratings: Column | str, source: str, kind: str) -> Column:
    """Value published by ``source`` in an array of (Source, Value); the last entry wins."""
    own = F.filter(_col(ratings), lambda r: r["Source"] == source)
    text = F.try_element_at(own, F.lit(-1))["Value"]
    number = F.replace(F.split_part(text, F.lit("/"), F.lit(1)), F.lit("%"))
    return strip(number).try_cast(kind)


def parse_ratings(ratings: Column | str) -> Column:
    """The three known rating sources as one struct."""
    return F.struct(
        rating_value(ratings, "Internet Movie Database", "double").alias("rating"),
        rating_value(ratings, "Rotten Tomatoes", "int").alias("tomatometer"),
        rating_value(ratings, "Metacritic", "int").alias("metascore"))


def split_list_field(x: Column | str, delimiter: str, drop_empty: bool = False) -> Column:
    """Split on a literal delimiter without trimming; null and '' give []."""
    pieces = F.split(_nonempty(_col(x)), re.escape(delimiter), -1)
    pieces = F.filter(pieces, lambda p: p != "") if drop_empty else pieces
    return F.coalesce(pieces, F.array().cast("array<string>"))


def prefix_id(key: Column | str, prefix: str) -> Column:
    return F.concat(F.lit(prefix + "_"), _col(key))


def item_url(key: Column | str, root: str = ITEM_URL) -> Column:
    return F.concat(F.lit(root), _col(key), F.lit("/"))


def without_dots(path: Column) -> Column:
    """A path that begins with ``/`` without its ``.`` and ``..`` segments; one above the root is left out."""
    def step(kept: Column, piece: Column) -> Column:
        return (F.when(piece == ".", kept).when(piece == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
                .otherwise(F.concat(kept, F.array(piece))))

    pieces = F.split(F.substring(path, 2, 2**31 - 1), "/")
    last = F.element_at(pieces, -1)
    pieces = F.when(last.isin(".", ".."), F.concat(pieces, F.array(F.lit("")))).otherwise(pieces)
    folded = F.concat(F.lit("/"), F.array_join(F.aggregate(pieces, F.array().cast("array<string>"), step), "/"))
    return F.when(F.contains(path, F.lit("/.")), folded).otherwise(path)


def resolve_url(base: Column | str, href: Column | str) -> Column:
    """Absolute form of a link. Dot segments of a path (``../``) are followed; links with a scheme or host stay as they are."""
    base, href = _col(base), _col(href)
    scheme = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(base, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    bare = F.regexp_replace(base, "[?#].*\\z", "")
    without_fragment = F.regexp_replace(base, "#.*\\z", "")
    path = F.substring(bare, F.char_length(origin) + 1, F.char_length(bare))
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, "[^/]*\\z", ""))
    own_path = F.regexp_extract(href, "^[^?#]*", 0)
    rest = F.substring(href, F.char_length(own_path) + 1, F.char_length(href))
    return (F.when(href == "", base)
            .when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
            .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
            .when(href.startswith("/"), F.concat(origin, without_dots(own_path), rest))
            .when(href.startswith("#"), F.concat(without_fragment, href))
            .when(href.startswith("?"), F.concat(bare, href))
            .otherwise(F.concat(origin, without_dots(F.concat(folder, own_path)), rest)))


def url_path(url: Column | str) -> Column:
    """Path of an absolute URL, without query and fragment."""
    return F.regexp_extract(_col(url), "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def url_is_review(url: Column | str, prefix: str = "/reviews/", hyphens: int = 2) -> Column:
    """The path lies under ``prefix`` and holds a slug of at least ``hyphens`` hyphens."""
    path = url_path(url)
    return path.startswith(prefix) & (F.regexp_count(path, F.lit("-")) >= hyphens)


def date_part(x: Column | str) -> Column:
    """Text before the first ``T`` of a timestamp text."""
    return F.split_part(_col(x), F.lit("T"), F.lit(1))


def star_class_rating(classes: Column | str) -> Column:
    """A ``starNN`` class token as NN/10; the first such token counts."""
    digits = F.regexp_extract(_col(classes), "(?:^|\\s)star([0-9]+)(?:\\s|\\z)", 1)
    return _nonempty(digits).try_cast("double") / 10.0


def truncate_list(xs: Column | str, limit: int = 5) -> Column:
    return F.slice(F.coalesce(_col(xs), F.array().cast("array<string>")), 1, limit)


def join_with_comma(xs: Column | str) -> Column:
    return F.coalesce(F.array_join(_col(xs), ", ", "None"), F.lit(""))


def format_rating(x: Column | str) -> Column:
    """``7.5/10``; blank when the rating is missing or zero."""
    value = _col(x)
    return F.when(value.isNull() | (value == 0), F.lit("")).otherwise(
        F.format_string("%.1f/10", value))


def capitalize(x: Column | str) -> Column:
    """First character upper case, all others lower case."""
    text = _col(x)
    return F.concat(F.upper(F.substring(text, 1, 1)),
                    F.lower(F.substring(text, F.lit(2), F.char_length(text))))


def first_or_blank(xs: Column | str) -> Column:
    return F.coalesce(F.get(_col(xs), F.lit(0)), F.lit(""))


def poster_or_null(x: Column | str) -> Column:
    return _nonempty(F.nullif(_col(x), F.lit("N/A")))


def highlight_terms(x: Column | str, terms: list[str]) -> Column:
    """Wrap every occurrence of every term, one term after the other, ignoring case."""
    text = _col(x)
    for term in terms:
        text = F.regexp_replace(text, f"(?i)({re.escape(term)})", "<mark>$1</mark>")
    return text


def falsy_fallback(*columns: Column | str, kind: str = "string") -> Column:
    """First column that is not null, empty, zero or an empty list; else the last one."""
    def truthy(c: Column) -> Column:
        if kind == "string":
            return F.nullif(c, F.lit(""))
        if kind == "array":
            return F.when(F.size(c) > 0, c)
        return F.nullif(c, F.lit(0).cast(kind))
    cols = [_col(c) for c in columns]
    return F.coalesce(*[truthy(c) for c in cols], cols[-1])


def overlay_values(old: Column | str, new: Column | str, matched: Column | str,
                   mode: str = "overwrite") -> Column:
    """New value on matched rows; mode ``truthy`` keeps the old one when the new one is empty."""
    old, new, matched = _col(old), _col(new), _col(matched)
    if mode == "truthy":
        return F.when(matched, F.coalesce(F.nullif(new, F.lit("")), old)).otherwise(old)
    return F.when(matched, new).otherwise(old)


def snippet(plot: Column | str, review: Column | str, limit: int = 300) -> Column:
    """Highlighted plot, else highlighted review, else ''; cut at ``limit`` characters.

    The cut counts characters of the marked text and may fall inside a mark.
    """
    text = F.coalesce(_nonempty(_col(plot)), _nonempty(_col(review)), F.lit(""))
    return truncate_chars(text, limit)


def facet_pairs(flat: Column | str) -> Column:
    """[v1, c1, v2, c2, ...] as an array of (value, count); an odd tail is dropped."""
    xs = _col(flat)
    pairs = F.floor(F.size(xs) / 2).cast("int")
    places = F.when(pairs > 0, F.sequence(F.lit(0), pairs - 1)).otherwise(
        F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct(
        F.get(xs, i * 2).alias("value"), F.get(xs, i * 2 + 1).try_cast("bigint").alias("count")))
