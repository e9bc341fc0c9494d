"""Column functions over stored page source: selectors, text and the page fields built on them.

A page is one row, so everything here is row-wise and needs no shuffle. Regular expressions see the
page after ``prepare`` has removed comments, scripts and styles.
"""

from __future__ import annotations

import html as html_text
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalograph.functions.scalars import (clean_text, date_part, split_clean, star_class_rating,
                                           strip)

ANY_TAG = "[a-zA-Z][a-zA-Z0-9]*"
NODE_BREAK = "\x01"
# Opening or closing one of these ends an unclosed paragraph.
BLOCK_TAGS = ("address|article|aside|blockquote|div|dl|fieldset|footer|form|h[1-6]|header|hr|main|"
              "nav|ol|p|pre|section|table|ul|body|html")


@dataclass(frozen=True)
class Sel:
    """One element: a tag name with at most one condition on one attribute."""
    tag: str = ANY_TAG
    attr: str | None = None
    value: str | None = None
    how: str = "equals"          # equals | contains | token

    def pattern(self) -> str:
        if self.attr is None:
            return f"<{self.tag}(?:[\\s/][^>]*)?>"
        v = re.escape(self.value)
        if self.how == "contains":
            quoted = [f'"[^"]*{v}[^"]*"', f"'[^']*{v}[^']*'", f"[^\\s\"'>]*{v}[^\\s\"'>]*"]
        elif self.how == "token":
            quoted = [f'"(?:[^"]*\\s)?{v}(?:\\s[^"]*)?"', f"'(?:[^']*\\s)?{v}(?:\\s[^']*)?'", v]
        else:
            quoted = [f'"{v}"', f"'{v}'", v]
        return (f"<{self.tag}\\s(?:[^>]*\\s)?{self.attr}\\s*=\\s*(?:{'|'.join(quoted)})"
                "(?:[\\s/][^>]*)?>")


def by_class(name: str, tag: str = ANY_TAG) -> Sel:
    return Sel(tag, "class", name, "token")


_REFERENCE = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);?")
# Characters that must stay escaped while the page is still markup.
_MARKUP_CHARS = {"<": "&lt;", ">": "&gt;", "&": "&amp;", '"': "&quot;", "'": "&#39;"}


def _expand(page: str) -> str:
    def one(match: re.Match) -> str:
        char = html_text.unescape(match.group())
        return _MARKUP_CHARS.get(char, char)
    return _REFERENCE.sub(one, page)


@F.pandas_udf(T.StringType())
def _expand_references(pages: pd.Series) -> pd.Series:
    return pages.map(_expand, na_action="ignore")


def decode(x: Column) -> Column:
    """The common character references to text; ``&amp;`` last, so nothing is decoded twice."""
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                       ("&nbsp;", "\u00a0"), ("&amp;", "&")):
        x = F.replace(x, F.lit(name), F.lit(char))
    return x


def prepare(page: Column | str, all_entities: bool = False) -> Column:
    """Page without comments, scripts and styles.

    ``all_entities`` also turns the rare character references into text, in one Arrow pass per page;
    the common ones are decoded later, in the JVM, once no markup is left around them.
    """
    page = F.col(page) if isinstance(page, str) else page
    page = F.regexp_replace(
        page, "(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>", "")
    return _expand_references(page) if all_entities else page


def links_in(page: str, kinds: tuple[Sel, ...]) -> list[tuple[int, int, int, int]]:
    """Per link of a page: begin and end of its source, and of the source inside its block.

    The block is the nearest open element of the first kind around the link, else of the second, and so on;
    without one its end is -1. What is never closed ends with the page.
    """
    tags = "|".join(dict.fromkeys([*[sel.tag for sel in kinds], "a"]))
    matches = [re.compile("(?is)" + sel.pattern()).fullmatch for sel in kinds]
    open_: list[list[list]] = [[] for _ in kinds]      # per kind: [end of the opening tag, end, wanted]
    links: list[list] = []                             # [begin, end, block]
    for tag in re.finditer(f"(?is)<(/?)({tags})(?=[\\s/>])[^>]*>", page):
        closing, name = tag[1], tag[2].lower()
        for kind, sel in enumerate(kinds):
            if sel.tag.lower() == name and not closing:
                open_[kind].append([tag.end(), len(page), matches[kind](tag[0]) is not None])
            elif sel.tag.lower() == name and open_[kind]:
                open_[kind].pop()[1] = tag.start()
        if name == "a" and closing:
            if links and links[-1][1] < 0:
                links[-1][1] = tag.end()
        elif name == "a":
            around = (block for blocks in open_ for block in reversed(blocks) if block[2])
            links.append([tag.start(), -1, next(around, None)])
    return [(begin, len(page) if end < 0 else end, *((block[0], block[1]) if block else (0, -1)))
            for begin, end, block in links]


def link_spans(page: Column, kinds: tuple[Sel, ...]) -> Column:
    """``links_in`` as an array of (begin, end, block_begin, block_end): one Arrow pass per page, offsets only."""

    @F.arrow_udf("array<struct<begin:int,end:int,block_begin:int,block_end:int>>")
    def of(pages: pa.Array) -> pa.Array:
        found = [links_in(page, kinds) if page is not None else [] for page in pages.to_pylist()]
        flat = np.array([span for spans in found for span in spans], np.int32).reshape(-1, 4)
        offsets = np.cumsum([0, *map(len, found)])
        spans = pa.StructArray.from_arrays([pa.array(column) for column in flat.T], ["begin", "end", "block_begin", "block_end"])
        mask = pages.is_null() if pages.null_count else None
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans, mask=mask)

    return of(page)


def between(page: Column, begin: Column, end: Column) -> Column:
    """Source from offset ``begin`` up to ``end``."""
    return F.substr(page, begin + 1, end - begin)


def first_tag(page: Column, sel: Sel) -> Column:
    """Opening tag of the first match, else null."""
    return F.nullif(F.regexp_extract(page, "(?is)" + sel.pattern(), 0), F.lit(""))


def attribute(tag: Column, name: str) -> Column:
    """Attribute value of an opening tag; null when absent or empty."""
    found = f"(?is)\\s{name}\\s*=\\s*(\"[^\"]*\"|'[^']*'|[^\\s\"'>]+)"
    value = F.regexp_replace(F.regexp_extract(tag, found, 1), "^[\"']|[\"']\\z", "")
    return decode(F.nullif(value, F.lit("")))


def first_attribute(page: Column, sel: Sel, name: str) -> Column:
    return attribute(first_tag(page, sel), name)


def elements(page: Column, sel: Sel) -> Column:
    """All matches as source text, for elements that do not nest in themselves."""
    close = f"</{sel.tag}\\s*>"
    return F.regexp_extract_all(page, F.lit(f"(?is){sel.pattern()}.*?(?:{close}|\\z)"), F.lit(0))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def after(page: Column, sel: Sel) -> Column:
    """Source after the opening tag of the first match; null when there is no match."""
    return F.get(F.split(page, "(?is)" + sel.pattern(), 2), F.lit(1))


def inner(page: Column, sel: Sel) -> Column:
    """Source inside the first match up to the first closing tag; null when there is no match."""
    return F.get(F.split(after(page, sel), f"(?i)</{sel.tag}\\s*>", 2), F.lit(0))


def _to_own_close(rest: Column, tag: str) -> Column:
    """Cut source that follows an opening tag where that tag is closed, counting nested ones."""
    opening = F.lit(f"(?i)<{tag}(?=[\\s/>])")
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("seen"), F.lit(0).alias("end"))

    def step(acc: Column, part: Column) -> Column:
        closed = acc["end"] > 0
        depth = acc["depth"] + F.when(closed, 1).otherwise(F.regexp_count(part, opening))
        seen = acc["seen"] + 1
        end = F.when(closed, acc["end"]).when(depth == 0, seen).otherwise(F.lit(0))
        return F.struct((depth - 1).alias("depth"), seen.alias("seen"), end.alias("end"))

    def cut(parts: Column) -> Column:
        end = F.aggregate(parts, start, step, lambda acc: acc["end"])
        return F.array_join(F.slice(parts, F.lit(1), F.coalesce(
            F.nullif(end, F.lit(0)), F.size(parts))), f"</{tag}>")

    return let(F.split(rest, f"(?i)</{tag}\\s*>", -1), cut)


def container(page: Column, *options: Sel) -> Column:
    """Source inside the first element that one of the options finds, nesting respected."""
    return F.coalesce(*[_to_own_close(after(page, sel), sel.tag) for sel in options])


def containers(page: Column, sel: Sel) -> Column:
    """Source inside every match; each is cut where its own tag is closed."""
    rests = let(F.split(page, "(?is)" + sel.pattern(), -1),
                lambda parts: F.slice(parts, F.lit(2), F.size(parts)))
    rests = F.coalesce(rests, F.array().cast("array<string>"))
    return F.transform(rests, lambda rest: _to_own_close(rest, sel.tag))


def text(fragment: Column) -> Column:
    """Text nodes joined without a separator."""
    return decode(F.regexp_replace(fragment, "(?s)<[^>]*>", ""))


def text_joined(fragment: Column, separator: str = " ") -> Column:
    """Text nodes trimmed, empty ones dropped, joined by the separator."""
    marked = decode(F.regexp_replace(fragment, "(?s)<[^>]*>", NODE_BREAK))
    nodes = F.filter(F.transform(F.split(marked, NODE_BREAK, -1), strip), lambda n: n != "")
    return F.array_join(nodes, separator)


def texts(fragments: Column, joined: bool = False) -> Column:
    """Cleaned, non-empty texts of an array of fragments."""
    read = (lambda f: clean_text(text_joined(f))) if joined else (lambda f: clean_text(text(f)))
    return F.filter(F.transform(fragments, read), lambda t: t != "")


@dataclass(frozen=True)
class PageRules:
    """Where each field is found. The defaults are the fixed values of the review pages."""
    base_url: str = "https://www.rogerebert.com"
    link_contains: str = "/reviews/"
    link_path: str = "/reviews/"
    link_hyphens: int = 2
    links_per_page: int = 50
    untitled: str = "Untitled Review"
    link_block: tuple[Sel, ...] = (Sel("article"), Sel("div"))
    teaser: tuple[Sel, ...] = (by_class("review-stack__tease"), Sel("p"))
    next_head: Sel = Sel("link", "rel", "next", "token")
    next_link: Sel = Sel("a", "rel", "next", "token")
    next_block: Sel = by_class("pagination__next")
    more_text: str = "More Reviews"
    rating_meta: Sel = Sel("meta", "itemprop", "ratingValue")
    star_box: Sel = by_class("star-box", "div")
    star_image: Sel = by_class("filled", "img")
    star_span: Sel = by_class("star-rating", "span")
    date_meta: Sel = Sel("meta", "itemprop", "datePublished")
    date_updated: Sel = Sel("meta", "property", "og:updated_time")
    date_spans: tuple[Sel, ...] = (by_class("review-info__date", "span"),
                                   by_class("publish-date", "span"))
    author_meta: Sel = Sel("meta", "name", "author")
    author_links: tuple[Sel, ...] = (Sel("a", "href", "/contributors/", "contains"),
                                     by_class("byline__name"), by_class("author", "a"))
    titles: tuple[Sel, ...] = (by_class("page-title", "h1"), Sel("h1"))
    decks: tuple[Sel, ...] = (by_class("review-info__deck"), by_class("article-info__deck"))
    summary_metas: tuple[Sel, ...] = (Sel("meta", "name", "description"),
                                      Sel("meta", "property", "og:description"))
    credit_area: Sel = Sel(ANY_TAG, "id", "content-lower")
    credit_column: Sel = by_class("credit-col", "div")
    credit_heading: Sel = Sel("h4")
    primary_heading: Sel = by_class("page-title", "h4")
    credit_item: Sel = Sel("li")
    genre_link: Sel = Sel("a", "href", "/genre/", "contains")
    genre_skip: tuple[str, ...] = ("movie reviews",)
    info_item: Sel = by_class("review-info__item", "div")
    info_label: Sel = by_class("review-info__label", "span")
    info_value: Sel = by_class("review-info__value", "span")
    genre_labels: tuple[str, ...] | None = ("Genre", "Genres")
    director_labels: tuple[str, ...] | None = ("Directed by", "Director")
    cast_labels: tuple[str, ...] | None = ("Cast",)
    bodies: tuple[Sel, ...] = (by_class("review__body", "div"), by_class("article-body", "div"),
                               by_class("entry-content", "div"))
    all_entities: bool = False


def _first_text(page: Column, options: tuple[Sel, ...], joined: bool = False) -> Column:
    """Cleaned text of the first element that one of the options finds; null without any."""
    found = F.coalesce(*[inner_any(page, sel) for sel in options])
    read = text_joined if joined else text
    return let(found, lambda f: F.when(f.isNotNull(), clean_text(read(f))))


def inner_any(page: Column, sel: Sel) -> Column:
    """Like ``inner`` for a selector that may leave the tag open: close it by its own name."""
    if sel.tag != ANY_TAG:
        return inner(page, sel)
    name = F.lower(F.regexp_extract(first_tag(page, sel), "^<([a-zA-Z0-9]+)", 1))
    return F.get(F.split(after(page, sel), F.concat(F.lit("(?i)</"), name, F.lit("\\s*>")), 2),
                 F.lit(0))


def page_rating(page: Column, rules: PageRules) -> Column:
    """Rating from the meta tag, else the star image, else the star span."""
    box = container(page, rules.star_box)
    return F.coalesce(
        first_attribute(page, rules.rating_meta, "content").try_cast("double"),
        star_class_rating(first_attribute(box, rules.star_image, "class")),
        first_attribute(page, rules.star_span, "data-rating").try_cast("double"))


def page_date(page: Column, rules: PageRules) -> Column:
    return F.coalesce(
        first_attribute(page, rules.date_meta, "content"),
        date_part(first_attribute(page, rules.date_updated, "content")),
        _first_text(page, rules.date_spans))


def page_author(page: Column, rules: PageRules) -> Column:
    return F.coalesce(first_attribute(page, rules.author_meta, "content"),
                      _first_text(page, rules.author_links))


def page_title(page: Column, rules: PageRules) -> Column:
    return _first_text(page, rules.titles)


def page_summary(page: Column, rules: PageRules) -> Column:
    """Deck text, else the description of the first description tag present, else ''."""
    described = F.coalesce(*[first_tag(page, sel) for sel in rules.summary_metas])
    return F.coalesce(_first_text(page, rules.decks, joined=True),
                      clean_text(attribute(described, "content")))


def _credit_area(page: Column, rules: PageRules) -> Column:
    sel = rules.credit_area
    if sel.tag != ANY_TAG:
        return container(page, sel)
    return container(page, *[Sel(tag, sel.attr, sel.value, sel.how)
                             for tag in ("div", "section", "main", "article")])


def _labelled(label: Column, labels: tuple[str, ...] | None) -> Column:
    if labels is None:
        return F.lit(True)
    return F.lower(label).isin([name.lower() for name in labels])


def credit_columns(page: Column, rules: PageRules) -> Column:
    """Source of the credit columns of a page."""
    return F.coalesce(containers(_credit_area(page, rules), rules.credit_column),
                      F.array().cast("array<string>"))


def info_items(page: Column, rules: PageRules) -> Column:
    """Source of the labelled info items of a page."""
    return containers(page, rules.info_item)


def credits_of(columns: Column, rules: PageRules, labels: tuple[str, ...] | None) -> Column:
    def headed(column: Column) -> Column:
        heading = inner(column, rules.credit_heading)
        return heading.isNotNull() & _labelled(clean_text(text(heading)), labels)

    def values(column: Column) -> Column:
        items = elements(column, rules.credit_item)
        links = F.flatten(F.transform(items, lambda item: elements(item, Sel("a"))))
        return let(links, lambda found: F.when(F.size(found) > 0, texts(found)).otherwise(
            texts(items, joined=True)))

    return F.flatten(F.transform(F.filter(columns, headed), values))


def metadata_of(items: Column, columns: Column, rules: PageRules,
                labels: tuple[str, ...] | None) -> Column:
    def labelled(item: Column) -> Column:
        label, value = inner(item, rules.info_label), inner(item, rules.info_value)
        return label.isNotNull() & value.isNotNull() & _labelled(clean_text(text(label)), labels)

    values = F.flatten(F.transform(F.filter(items, labelled), lambda item: split_clean(
        text_joined(inner(item, rules.info_value), ", "))))
    return let(values, lambda found: F.when(F.size(found) > 0, found).otherwise(
        credits_of(columns, rules, labels)))


def genres_of(items: Column, columns: Column, rules: PageRules) -> Column:
    primary = F.get(F.filter(columns, lambda c: first_tag(c, rules.primary_heading).isNotNull()),
                    F.lit(0))
    names = texts(elements(primary, rules.genre_link))
    kept = F.array_distinct(F.filter(names, lambda n: ~F.lower(n).isin(list(rules.genre_skip))))
    return let(kept, lambda found: F.when(F.size(found) > 0, found).otherwise(
        metadata_of(items, columns, rules, rules.genre_labels)))


def page_credits(page: Column, rules: PageRules, labels: tuple[str, ...] | None) -> Column:
    """Link texts, or else item texts, of the credit columns whose heading is one of the labels."""
    return credits_of(credit_columns(page, rules), rules, labels)


def page_metadata(page: Column, rules: PageRules, labels: tuple[str, ...] | None) -> Column:
    """Comma-separated values of the labelled info items; without any, the credits."""
    return metadata_of(info_items(page, rules), credit_columns(page, rules), rules, labels)


def page_genres(page: Column, rules: PageRules) -> Column:
    """Genre links of the primary credit column in first-seen order; without any, the metadata."""
    return genres_of(info_items(page, rules), credit_columns(page, rules), rules)


def page_body(page: Column, rules: PageRules) -> Column:
    """Non-empty paragraphs of the first body container present, joined by spaces; else ''.

    An unclosed paragraph ends where the next one or another block begins or ends.
    """
    body = container(page, *rules.bodies)
    chunks = let(F.split(body, "(?i)<p(?:\\s[^>]*)?>", -1),
                 lambda parts: F.slice(parts, F.lit(2), F.size(parts)))
    ends = f"(?is)^(.*?)(?:</?(?:{BLOCK_TAGS})(?:[\\s/][^>]*)?>|\\z)"
    paragraphs = F.transform(chunks, lambda c: text_joined(F.regexp_extract(c, ends, 1)))
    joined = F.array_join(F.filter(paragraphs, lambda p: p != ""), " ")
    return F.coalesce(joined, F.lit(""))
