"""Predicates over publications. Each is a Column, so Catalyst may push it to the scan or fold it into a stage's code."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import field, text_or_blank

# Title words of what isn't a research article.
EXCLUDE_TERMS = (
    "review", "perspective", "editorial", "correction", "comment", "highlight",
    "news", "erratum", "author correction", "publisher correction",
    "profile", "q&a", "inner workings", "front matter", "core concepts", "opinion",
    "retraction", "spotlight", "in this issue", "table of contents",
)
# Title patterns of software papers.
SOFTWARE_PATTERNS = (
    r"\b(pipeline|workflow|toolkit|toolbox|software package|software tool)\b",
    r"\b(web server|web application|web-based tool|web tool|database for)\b",
    r"\b(python package|r package|julia package|bioinformatics tool)\b",
)
# Article types that aren't research.
NON_RESEARCH_TYPES = ("briefing", "commentary", "perspective", "editorial", "news", "interview", "author summary", "correction", "erratum", "review")


def any_contains(text: Column, needles: Sequence[str]) -> Column:
    """Whether a text contains any of a few literal strings."""
    return reduce(Column.__or__, (text.contains(n) for n in needles), F.lit(False))


def is_research(title: Column, article_type: Column | None = None, terms: Sequence[str] = EXCLUDE_TERMS, patterns: Sequence[str] = SOFTWARE_PATTERNS, types: Sequence[str] = NON_RESEARCH_TYPES) -> Column:
    low = F.lower(text_or_blank(title))
    bad = any_contains(low, terms) | reduce(Column.__or__, (low.rlike(p) for p in patterns), F.lit(False))
    if article_type is not None:
        bad |= any_contains(F.lower(text_or_blank(article_type)), types)
    return ~bad


def is_green(authors: Column, title: Column, abstract: Column, names: Sequence[str], keywords: Sequence[str]) -> Column:
    """An author or a keyword of the allow-lists, anywhere in the text, in any case."""
    by_name = any_contains(F.lower(text_or_blank(authors)), [n.lower() for n in names])
    text = F.lower(F.concat_ws(" ", text_or_blank(title), text_or_blank(abstract)))
    return by_name | any_contains(text, [k.lower() for k in keywords])


def in_section(tags: Column, title: Column, abstract: Column, section: str) -> Column:
    low = section.lower()
    return F.coalesce(F.exists(tags, lambda t: F.lower(t).contains(low)), F.lit(False)) | F.lower(text_or_blank(title)).contains(low) | F.lower(text_or_blank(abstract)).contains(low)


def feed_defect(title: Column, link: Column, authors: Column, abstract: Column, least: int = 80) -> Column:
    """Why a feed's record is turned away; null if it isn't."""
    return (
        F.when(field(title) == "", "no title")
        .when(field(link) == "", "no link")
        .when(field(authors) == "", "no authors")
        .when(F.length(field(abstract)) < least, "short abstract")
    )


def enough_authors(source: Column, authors: Column, preprints: Sequence[str], green_names: Sequence[str], match_case: bool = False) -> Column:
    """Preprints of a single author are turned away, unless the author is on the allow-list.

    `match_case` compares lower-cased authors with names as they are written, as a history of editions may have been made.
    """
    low = F.lower(text_or_blank(authors))
    several = low.contains(",") | low.contains(";")
    green = any_contains(low, green_names if match_case else [n.lower() for n in green_names])
    return ~source.isin(*preprints) | several | green


def needs_scrape(authors: Column, abstract: Column, source: Column, always: Sequence[str] = (), least: int = 80) -> Column:
    return (field(authors) == "") | (F.length(field(abstract)) < least) | source.isin(*always)


def same_category(category: Column, wanted: str) -> Column:
    return F.lower(text_or_blank(category)) == wanted.lower()


def incomplete_editions(sidecars: DataFrame, edition: str = "edition") -> DataFrame:
    """Editions with a record that has no date; the others need no second look."""
    return sidecars.groupBy(edition).agg(F.max(F.col("date").isNull()).alias("open")).where("open").select(edition)
