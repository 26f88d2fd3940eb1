"""Data quality as columns: issues of a record are an array of texts, so a frame splits into kept and removed rows in one pass, and an
edition's issues are rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import publication_date
from ..functions.text import field, squashed

# Texts that say there is no text.
PLACEHOLDERS = ("n/a", "na", "none", "null", "unknown", "tbd", "-")
# Sentences that say there is no text.
UNAVAILABLE = (
    r"^(?:abstract|summary|authors?|title|source|content|information|data)?\s*(?:is|are|was|were)?\s*(?:not\s+available|unavailable|missing|unknown|not\s+provided)(?:\s+via\b.*)?[.!]?$",
    r"^no\s+(?:abstract|summary|authors?|title|source|content|information|data)(?:\s+(?:is|was))?\s*(?:available|provided|found)?(?:\s+via\b.*)?[.!]?$",
)
FIELDS = ("title", "authors", "abstract", "link", "source", "date")


def is_placeholder(c: Column) -> Column:
    clean = F.lower(squashed(F.coalesce(c.cast("string"), F.lit(""))))
    return (clean == "") | clean.isin(*PLACEHOLDERS) | clean.rlike(UNAVAILABLE[0]) | clean.rlike(UNAVAILABLE[1])


def _when(test: Column, *text: Column | str) -> Column:
    return F.when(test, F.concat(*(F.lit(t) if isinstance(t, str) else t for t in text)))


def record_issues(edition_date: Column, get=F.col, least_abstract: int = 80, days: int = 7) -> Column:
    """Issues of a record, each led by its title. A null field is blank."""
    value = {f: field(get(f)) for f in FIELDS}
    issues = []
    for f in FIELDS:
        issues.append(_when(value[f] == "", f"{f} is blank"))
        issues.append(_when((value[f] != "") & is_placeholder(value[f]), f"{f} contains placeholder text: '", value[f], "'"))
    size = F.length(value["abstract"])
    issues.append(_when((size > 0) & (size < least_abstract) & ~is_placeholder(value["abstract"]), "abstract is too short to be substantive (", size.cast("string"), " characters)"))
    link = F.lower(value["link"])
    issues.append(_when((link != "") & ~link.startswith("http://") & ~link.startswith("https://"), "link is not an HTTP(S) URL: '", value["link"], "'"))
    published, oldest = publication_date(get("date"), get("source"), get("link")), F.date_sub(edition_date, days)
    issues.append(_when(published.isNull() & (value["date"] != ""), "date is not parseable: '", value["date"], "'"))
    issues.append(_when(published < oldest, "publication date ", published.cast("string"), " is older than the allowed ", oldest.cast("string"), " cutoff"))
    issues.append(_when(published > edition_date, "publication date ", published.cast("string"), " is after edition date ", edition_date.cast("string")))
    lead = F.when(value["title"] == "", F.lit("")).otherwise(F.concat(value["title"], F.lit(" — ")))
    return F.transform(F.array_compact(F.array(*issues)), lambda i: F.concat(lead, i))


def summary_issues(c: Column, least_words: int = 6) -> Column:
    clean = field(c)
    found = F.array_compact(
        F.array(
            _when(is_placeholder(clean), "summary contains placeholder text: '", clean, "'"),
            _when(F.size(F.split(squashed(clean), " ")) < least_words, f"summary has fewer than {least_words} words"),
            _when(~clean.rlike("[.!?][\"'”’\\)\\]]*$"), "summary does not end as a complete sentence"),
        )
    )
    return F.when(clean == "", F.array(F.lit("summary is blank"))).otherwise(found)


def sanitize(papers: DataFrame, edition_date: Column, least_abstract: int = 80) -> tuple[DataFrame, DataFrame]:
    """Rows without issues, their date made canonical; and (seq, title, issues) of the others."""
    judged = papers.withColumn("issues", record_issues(edition_date, least_abstract=least_abstract))
    day = publication_date(F.col("date"), F.col("source"), F.col("link"))
    kept = judged.where(F.size("issues") == 0).drop("issues").withColumn("date", F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00+00:00")))
    return kept, judged.where(F.size("issues") > 0).select("seq", field(F.col("title")).alias("title"), "issues")


def required_size(candidates: int, least: int = 50, fraction: float = 0.0) -> int:
    if not 0 <= fraction <= 1:
        raise ValueError("a fraction is between 0 and 1")
    return max(least, math.ceil(candidates * fraction))


def required_size_column(candidates: Column, least: int = 50, fraction: float = 0.0) -> Column:
    return F.greatest(F.lit(least), F.ceil(candidates * fraction)).cast("long")


def allowed_failures(total: Column, fraction: float = 0.05, most: int = 5) -> Column:
    return F.when(total == 0, F.lit(0)).otherwise(F.least(F.lit(most), F.greatest(F.lit(1), F.floor(total * fraction)))).cast("long")


def repeated(items: DataFrame, key: Column, order: Sequence[str] = ("seq",)) -> DataFrame:
    """Second and later rows of each key that isn't blank, in order of arrival."""
    nth = F.row_number().over(Window.partitionBy("_key").orderBy(*order))
    return items.withColumn("_key", key).where("_key <> ''").withColumn("nth", nth).where("nth > 1").drop("_key")


def edition_issues(items: DataFrame, edition_date: Column, least: int = 50, candidates: int | None = None, fraction: float = 0.0, least_abstract: int = 80) -> DataFrame:
    """Issues of a selection as rows (seq, step, issue): its size first (seq null), then each item's in order.

    `items` are publications with a summary. Duplicates are found by windows over the keys, so no list is held anywhere.
    """
    required = least if candidates is None else required_size(candidates, least, fraction)
    note = "" if candidates is None else f" for {candidates} valid candidates"
    size = items.agg(F.count("*").alias("n")).where(F.col("n") < required).select(
        F.lit(None).cast("long").alias("seq"), F.lit(0).alias("step"), F.concat(F.lit("edition contains "), F.col("n").cast("string"), F.lit(f" papers; minimum is {required}{note}")).alias("issue")
    )
    title, link, name = field(F.col("title")), F.lower(field(F.col("link"))), F.lower(squashed(field(F.col("title"))))

    def nth(key: Column) -> Column:
        # blank keys aren't duplicates of each other, so each is told apart
        own = F.when(key == "", F.concat(F.lit("-"), F.col("seq").cast("string"))).otherwise(F.concat(F.lit("k"), key))
        return F.row_number().over(Window.partitionBy(own).orderBy("seq"))

    def told(step: int, found: Column) -> Column:
        return F.transform(found, lambda i: F.struct(F.lit(step).alias("step"), i.alias("issue")))

    def led(found: Column) -> Column:
        return F.transform(found, lambda i: F.concat(title, F.lit(" — "), i))

    judged = items.select(
        "seq",
        told(1, record_issues(edition_date, least_abstract=least_abstract)).alias("own"),
        told(2, led(summary_issues(F.col("summary")))).alias("texts"),
        F.when(nth(link) > 1, F.concat(title, F.lit(" — duplicate link '"), link, F.lit("'"))).alias("link_issue"),
        F.when(nth(name) > 1, F.concat(title, F.lit(" — duplicate title"))).alias("title_issue"),
    )
    rest = F.concat("own", "texts", told(3, F.array_compact(F.array("link_issue"))), told(4, F.array_compact(F.array("title_issue"))))
    return size.unionByName(judged.select("seq", F.explode(rest).alias("i")).select("seq", "i.step", "i.issue"))


class EditionRejected(ValueError):
    """A selection that must not be published."""


def require_clean(issues: DataFrame, shown: int = 20) -> None:
    """Raises with the first issues, if there are any."""
    if found := issues.orderBy("seq", "step", "issue").limit(shown).collect():
        raise EditionRejected("\n".join(r["issue"] for r in found))
