"""Identity keys. Three systems live side by side, as their users compare with different histories: `identity_keys` (a set, Unicode
titles), `paper_key` (one key by precedence) and `candidate_keys` (a set, ASCII titles, DOI from the link too)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_url, field, known, strip_markdown, stripped, text_or_blank

# Fixed value: what a DOI looks like in running text.
_DOI = r"10\.\d{4,9}/[-._;()/:A-Za-z0-9]+"
_NO_KEYS = "array<string>"


def _found(c: Column, pattern: str, group: int = 0) -> Column:
    """The group's text, or null."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def normalize_doi(c: Column) -> Column:
    """The DOI in a text, its case kept; null if there is none."""
    s = F.regexp_replace(field(c), r"(?i)^https?://(dx\.)?doi\.org/", "")
    s = F.regexp_replace(s, r"(?i)^doi:\s*", "")
    return F.nullif(F.regexp_replace(_found(s, _DOI), r"[\]\).,;]+$", ""), F.lit(""))


def normalize_doi_lower(c: Column) -> Column:
    return normalize_doi(F.lower(text_or_blank(c)))


def normalize_link(c: Column) -> Column:
    s = F.regexp_replace(F.lower(field(c)), "^<", "")
    for pattern in (r">\s*$", r"\?rss=yes$", "#.*$", "/+$"):
        s = F.regexp_replace(s, pattern, "")
    return s


def normalize_title(c: Column) -> Column:
    return F.regexp_replace(F.lower(strip_markdown(text_or_blank(c))), "[^a-z0-9]+", "")


def title_letters(c: Column) -> Column:
    """Letters of any script and digits of a title, in lower case."""
    return F.regexp_replace(F.lower(text_or_blank(c)), r"[^\p{L}\p{Nd}]", "")


def bare_doi(c: Column) -> Column:
    s = F.regexp_replace(F.lower(known(c)), r"(?U)^\s+|\s+$", "")
    return F.regexp_replace(F.regexp_replace(s, r"^https?://(?:dx\.)?doi\.org/", ""), r"^doi:\s*", "")


def arxiv_key_id(link: Column) -> Column:
    """The arXiv id of a link, without version; null for other links."""
    s = F.lower(_found(text_or_blank(link), r"(?i)arxiv\.org/(?:abs|pdf)/([^/?#]+)", 1))
    return F.regexp_replace(F.regexp_replace(s, r"\.pdf$", ""), r"v\d+$", "")


def arxiv_link_id(link: Column) -> Column:
    """The arXiv id of an abstract page, else the last part of the link; without version."""
    c = text_or_blank(link)
    own = _found(c, r"arxiv\.org/abs/([^?#]+)", 1)
    return F.regexp_replace(F.coalesce(own, F.substring_index(c, "/", -1)), r"v\d+$", "")


def preprint_doi(link: Column) -> Column:
    return _found(text_or_blank(link), _DOI)


def _tagged(tag: str, c: Column) -> Column:
    """tag:value, or null for a null or blank value."""
    return F.when(c != "", F.concat(F.lit(tag + ":"), c))


def identity_key_parts(title: Column, link: Column, doi: Column) -> tuple[Column, Column, Column]:
    """The title, DOI and arXiv key, each null if there is none."""
    cut = F.get(F.split(bare_doi(doi), "[?#]", 2), F.lit(0))
    return _tagged("title", title_letters(title)), _tagged("doi", cut), _tagged("arxiv", arxiv_key_id(link))


def identity_keys(title: Column, link: Column, doi: Column) -> Column:
    return F.array_distinct(F.array_compact(F.array(*identity_key_parts(title, link, doi))))


def paper_key(title: Column, link: Column, doi: Column) -> Column:
    d = F.regexp_replace(F.lower(stripped(known(doi))), r"^https?://(dx\.)?doi\.org/", "")
    by_link = F.lower(stripped(known(link)))
    by_title = F.regexp_replace(F.lower(stripped(known(title))), "[^a-z0-9]+", "")
    return F.coalesce(_tagged("doi", d), _tagged("link", by_link), F.concat(F.lit("title:"), by_title))


def candidate_keys(title: Column, link: Column, doi: Column) -> Column:
    """Keys in order of priority: DOI, DOI of the link, link, title."""
    keys = (_tagged("doi", normalize_doi_lower(doi)), _tagged("doi", normalize_doi_lower(link)), _tagged("link", normalize_link(link)), _tagged("title", normalize_title(title)))
    return F.array_distinct(F.array_compact(F.array(*keys)))


def featured_keys(title: Column, link: Column, doi: Column) -> Column:
    return F.array_compact(F.array(F.concat(F.lit("title:"), title_letters(title)), _tagged("arxiv", arxiv_key_id(link)), _tagged("doi", bare_doi(doi))))


def source_of_url(link: Column) -> Column:
    """Name of the archive that hosts a link, else its host; blank if it isn't a URL."""
    host = F.regexp_replace(F.try_parse_url(clean_url(link), F.lit("HOST")), r"^www\.", "")
    known_hosts = F.when(host == "arxiv.org", "arXiv").when(host == "biorxiv.org", "bioRxiv").when(host == "medrxiv.org", "medRxiv")
    return F.coalesce(known_hosts, host, F.lit(""))


def doi_of_link_or_html(link: Column, html: Column) -> Column:
    """The first DOI found: in the link in one of four forms, then in the page's metadata, then anywhere in the page."""
    link, html = text_or_blank(link), text_or_blank(html)
    # Where pages and links state a DOI, in the order in which they are believed.
    candidates = (
        _found(link, r"(?i)doi\.org/(10\.\d{4,9}/[^?#]+)", 1),
        _found(link, r"(?i)/doi/(?:abs/|full/)?(10\.\d{4,9}/[^?#]+)", 1),
        F.concat(F.lit("10.1038/"), _found(link, r"(?i)nature\.com/articles/([^/?#]+)", 1)),
        F.concat(F.lit("10.1039/"), _found(link, r"(?i)/articlelanding/\d{4}/[a-z]+/([a-z0-9-]+)", 1)),
        _found(html, r"""(?i)(?:citation_doi|dc\.identifier)[^>]+content=["'](?:doi:)?(10\.\d{4,9}/[^"']+)""", 1),
        _found(html, r"""(?i)(?:doi\.org/|"doi"\s*:\s*")(10\.\d{4,9}/[^"'<>\s]+)""", 1),
    )
    return F.regexp_replace(F.coalesce(*candidates), "[).,;]+$", "")
