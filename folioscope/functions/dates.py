"""Date functions. Whatever can't be a date is null; offsets in feed dates are dropped and the time is taken as UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import field, text_or_blank

_MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def _date(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")), "yyyy-MM-dd")


def iso_prefix(c: Column) -> Column:
    """The date at the start of a text."""
    return F.try_to_date(F.nullif(F.regexp_extract(text_or_blank(c), r"^\s*(\d{4}-\d{2}-\d{2})", 1), F.lit("")), "yyyy-MM-dd")


def in_window(c: Column, end: Column, days: int = 7) -> Column:
    """Inclusive at both ends, by calendar date."""
    d = F.to_date(c)
    return d.between(F.date_sub(end, days), end)


def doi_date(c: Column, version: bool = False) -> Column:
    """The first-posted date that a preprint's DOI spells out; `version`: a version mark may follow it."""
    # Fixed value: how a preprint's DOI spells a date out.
    pattern = r"/(20\d{2})\.(\d{2})\.(\d{2})(?:\.|v|$)" if version else r"/(20\d{2})\.(\d{2})\.(\d{2})(?:\.|$)"
    s = F.lower(text_or_blank(c))
    return _date(F.nullif(F.regexp_extract(s, pattern, 1), F.lit("")), F.regexp_extract(s, pattern, 2), F.regexp_extract(s, pattern, 3))


def first_posted(doi: Column, reported: Column) -> Column:
    """The earlier of the reported date and the one in the DOI."""
    return F.least(F.to_date(reported), doi_date(doi))


def publication_date(date: Column, source: Column, link: Column) -> Column:
    """The reported date; for a preprint the first-posted date in its link if that is earlier. Null if the reported one is no date."""
    reported, source, low = iso_prefix(date), F.lower(field(source)), F.lower(field(link))
    preprint = source.rlike("biorxiv|medrxiv") | low.rlike(r"biorxiv\.org|medrxiv\.org|doi\.org/10\.64898/|doi\.org/10\.1101/")
    return F.when(reported.isNull(), F.lit(None).cast("date")).when(preprint, F.least(reported, doi_date(low, True))).otherwise(reported)


def preprint_link_date(link: Column) -> Column:
    """The date spelled out in a preprint's link, unless it is another publisher's."""
    own = link.rlike(r"(?i)(?:bio|med)rxiv\.org|doi\.org/10\.(?:1101|64898)/")
    return F.when(own, doi_date(link, True))


def feed_date(*tags: Column) -> Column:
    """The first tag's text that is a time, in RSS or Atom form."""

    def one(c: Column) -> Column:
        s = field(c)
        # The forms in which feeds write times.
        rss = F.regexp_replace(F.nullif(F.regexp_extract(s, r"(\d{1,2}\s+\w{3}\s+\d{4}\s+\d{2}:\d{2}:\d{2})", 1), F.lit("")), r"\s+", " ")
        january = F.regexp_replace(rss, "[A-Za-z]{3}", "Jan")  # what an unknown month is taken for
        by_rss = F.coalesce(F.try_to_timestamp(rss, F.lit("d MMM yyyy HH:mm:ss")), F.try_to_timestamp(january, F.lit("d MMM yyyy HH:mm:ss")))
        by_iso = F.try_to_timestamp(F.nullif(F.regexp_extract(s, r"(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})", 1), F.lit("")), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
        by_day = F.try_to_timestamp(F.nullif(F.regexp_extract(s, r"^(\d{4}-\d{1,2}-\d{1,2})$", 1), F.lit("")), F.lit("y-M-d"))
        return F.coalesce(by_rss, by_iso, by_day)

    return F.coalesce(*map(one, tags))


def date_of_parts(parts: Column) -> Column:
    """A date of year, month and day; a missing month or day is the first."""
    return _date(F.get(parts, F.lit(0)), F.coalesce(F.get(parts, F.lit(1)), F.lit(1)), F.coalesce(F.get(parts, F.lit(2)), F.lit(1)))


def earliest_not_future(dates: Column, now: Column) -> Column:
    return F.array_min(F.filter(F.array_compact(dates), lambda d: d <= now))


def first_iso(*columns: Column) -> Column:
    """The first column whose first ten characters are a date."""
    return F.coalesce(*(F.try_to_date(F.left(field(c), F.lit(10)), "y-M-d") for c in columns))


def normalized_date(c: Column) -> Column:
    """A date of the 2000s with one- or two-digit parts anywhere in a text; impossible dates are null."""
    # The forms in which pages write dates.
    s, pattern = field(c), r"\b(20\d{2})[-/.](\d{1,2})[-/.](\d{1,2})\b"
    numeric = _date(F.nullif(F.regexp_extract(s, pattern, 1), F.lit("")), F.regexp_extract(s, pattern, 2), F.regexp_extract(s, pattern, 3))
    spelled = (F.try_to_date(s, fmt) for fmt in ("MMMM d, y", "MMM d, y", "d MMM y", "MMM d y"))
    return F.coalesce(numeric, iso_prefix(s), *spelled)


def preferred_date(dates: Column, start: Column, end: Column) -> Column:
    """The first date within the window, else the latest up to its end, else the earliest."""
    d = F.array_distinct(F.array_compact(dates))
    return F.coalesce(F.get(F.filter(d, lambda x: x.between(start, end)), F.lit(0)), F.array_max(F.filter(d, lambda x: x <= end)), F.array_min(d))


def metadata_dates(html: Column) -> Column:
    """Dates that a page states about itself, in its meta tags and its structured data; texts, as they stand."""
    html = text_or_blank(html)
    # The names under which pages state dates.
    tags = F.regexp_extract_all(html, F.lit(r"(?i)<meta\b[^>]*>"), F.lit(0))
    named = F.filter(tags, lambda t: t.rlike(r"""(?i)(?:name|property|itemprop)\s*=\s*["'][^"']*(?:citation_(?:publication_)?date|dc\.date|datepublished|article:published_time|prism\.publicationdate)"""))
    contents = F.transform(named, lambda t: F.regexp_extract(t, r"""(?i)content\s*=\s*["']([^"']*)["']""", 1))
    stated = F.regexp_extract_all(html, F.lit(r"""(?i)["'](?:datePublished|dateCreated|dateModified)["']\s*:\s*["']([^"']+)["']"""), F.lit(1))
    return F.concat(contents, stated)


def monday(c: Column) -> Column:
    return F.to_date(F.date_trunc("week", c))


def edition_id(window_end: Column) -> Column:
    return F.date_sub(window_end, 7)


def archive_name(c: Column) -> Column:
    return F.concat(F.date_format(c, "MMMdd_yyyy"), F.lit(".qmd"))


def archive_window_end(name: Column) -> Column:
    """The end of the window that an archive file is named for."""
    return F.try_to_date(F.nullif(F.regexp_extract(name, r"^([A-Z][a-z]{2}\d{2}_\d{4})\.qmd$", 1), F.lit("")), "MMMdd_yyyy")


def title_date(c: Column) -> Column:
    return F.date_format(c, "MMM d yy")


def date_of_title(line: Column) -> Column:
    """The date in an edition's title line, with a year of two or four digits."""
    pattern = r'"([A-Za-z]{3})\s+(\d{1,2})\s+(\d{2,4})"'
    month = F.array_position(F.array(*map(F.lit, _MONTHS)), F.initcap(F.regexp_extract(line, pattern, 1)))
    year = F.regexp_extract(line, pattern, 3)
    return F.when(month > 0, _date(F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year), month, F.regexp_extract(line, pattern, 2)))
