"""HTML functions. Markup can't be parsed by column expressions, so these run on Arrow batches with the standard library's parser."""

from __future__ import annotations

import json
import re
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SKIP, _BREAK = {"script", "style", "head", "title"}, {"p", "div", "br", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "ul", "ol", "table"}


class _Page(HTMLParser):
    """Text, images, meta tags, structured data and the text of each block of the tags asked for."""

    def __init__(self, blocks: tuple[str, ...] = ()) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks, self.text, self.images, self.meta, self.data = blocks, [], [], [], []
        self.open: list[tuple[str, list[str]]] = []
        self.closed: list[tuple[str, str]] = []
        self.quiet, self.script = 0, False

    def handle_starttag(self, tag, attrs):
        own = {k: v or "" for k, v in attrs}
        if tag == "img" and own.get("src"):
            self.images.append(own["src"])
        elif tag == "meta":
            self.meta.append(own)
        if tag == "script" and own.get("type") == "application/ld+json":
            self.script = True
            self.data.append("")
        if tag in _SKIP:
            self.quiet += 1
        elif tag in _BREAK:
            self._say("\n")
        if tag in self.blocks:
            self.open.append((tag, []))

    def handle_endtag(self, tag):
        if tag == "script":
            self.script = False
        if tag in _SKIP:
            self.quiet = max(0, self.quiet - 1)
        elif tag in _BREAK:
            self._say("\n")
        if tag in self.blocks:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == tag:
                    self.closed.append((tag, "".join(self.open.pop(k)[1])))
                    break

    def handle_data(self, data):
        if self.script and self.data:
            self.data[-1] += data
        elif not self.quiet:
            self._say(data)

    def _say(self, data: str) -> None:
        self.text.append(data)
        for _, held in self.open:
            held.append(data)


def _page(html: str | None, blocks: tuple[str, ...] = ()) -> _Page:
    page = _Page(blocks)
    page.feed(html or "")
    page.close()
    return page


_REFERENCE = re.compile("&(#[0-9]+;|#[xX][0-9a-fA-F]+;|[A-Za-z][A-Za-z0-9]*;)?")


def _ended(html: str) -> str:
    """Markup in which only references that end with a semicolon are references; any other ampersand stands for itself."""
    return _REFERENCE.sub(lambda m: m[0] if m[1] and (m[1][0] == "#" or m[1] in html5) else "&amp;" + m[0][1:], html)


def plain(html: str | None, ended: bool = False) -> str:
    """Text of a page, one space between blocks. As browsers do, a few names are decoded without their semicolon too, unless only `ended` references count."""
    return " ".join("".join(_page(_ended(html) if ended and html else html).text).split())


def _secure(src: str) -> str:
    return "https:" + src if src.startswith("//") else src


@F.pandas_udf(T.StringType())
def html_to_text(html: pd.Series) -> pd.Series:
    return html.map(plain)


@F.pandas_udf(T.StringType())
def ended_html_to_text(html: pd.Series) -> pd.Series:
    """As `html_to_text`; a reference that was cut off stays as it stands."""
    return html.map(lambda page: plain(page, ended=True))


def physics_abstract(html: str | None) -> dict:
    """Paragraphs joined, without the list of authors before and the citation after; and the images."""
    if not html:
        return {"abstract": "", "images": []}
    page = _page(html, ("p",))
    paragraphs = [" ".join(t.split()) for tag, t in page.closed if tag == "p"]
    text = " ".join(paragraphs) if paragraphs else plain(html)
    text = re.sub(r"^Author\(s\):.*?(?=\S{20,})", "", text.strip(), flags=re.S)
    text = re.sub(r"\[Phys\.\s*Rev\..*$|\[PRX\s+Life.*$", "", text)
    return {"abstract": text.strip(), "images": [_secure(s) for s in page.images]}


def chemistry_abstract(html: str | None) -> dict:
    """The last block of two or more lines that isn't a notice: authors first, then the abstract; and the graphical abstracts."""
    page = _page(html, ("div",))
    abstract = authors = ""
    for _, text in sorted(enumerate(page.closed), key=lambda x: x[0]):
        text = text[1].strip()
        notice = text.startswith(("Soft Matter", "Nanoscale")) or ("Open Access" in text and len(text) < 50) or "Creative Commons" in text or "licensed under" in text
        lines = [x.strip() for x in text.split("\n") if x.strip()]
        if notice or len(lines) < 2:
            continue
        lines = [x for x in lines if "The content of this RSS Feed" not in x and "To cite this article before page numbers" not in x]
        if lines:
            authors, abstract = lines[0], " ".join(lines[1:])
    images = [_secure(s).replace("http://", "https://", 1) if s.startswith(("http://", "//")) else s for s in page.images if "ImageService/image/GA" in s]
    return {"abstract": abstract, "authors": authors, "images": images}


@F.pandas_udf(T.StructType([T.StructField("abstract", T.StringType()), T.StructField("images", T.ArrayType(T.StringType()))]))
def clean_physics_abstract(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([physics_abstract(h) for h in html], columns=["abstract", "images"])


@F.pandas_udf(T.StructType([T.StructField("abstract", T.StringType()), T.StructField("authors", T.StringType()), T.StructField("images", T.ArrayType(T.StringType()))]))
def clean_chemistry_abstract(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([chemistry_abstract(h) for h in html], columns=["abstract", "authors", "images"])


_DOI = re.compile(r"10\.\d{4,9}/[-._;()/:A-Za-z0-9]+")


def page_metadata(html: str | None) -> dict:
    """Authors, abstract, article type and DOI that a page states; null where it doesn't."""
    page = _page(html)

    def metas(attr: str, *names: str) -> list[str]:
        return [m["content"].strip() for name in names for m in page.meta if m.get(attr) == name and m.get("content", "").strip()]

    authors = metas("name", "citation_author") or metas("name", "DC.creator")
    described = [*metas("name", "citation_abstract"), *metas("name", "DC.description"), *metas("property", "og:description")]
    for raw in page.data:
        try:
            data = json.loads(raw)
        except ValueError:
            continue
        if not isinstance(data, dict):
            continue
        about = data.get("mainEntity") if isinstance(data.get("mainEntity"), dict) else data
        names = about.get("author")
        if not authors and isinstance(names, list):
            authors = [t for a in names if (t := str(a.get("name", "") if isinstance(a, dict) else a).strip())]
        text = str(about.get("description") or "").strip()
        if not described and len(text) > 50:
            described = [text]
    kinds = metas("name", "citation_article_type", "dc.Type", "article:section")
    dois = [m[0].rstrip("]).,;") for t in metas("name", "citation_doi", "dc.Identifier", "DC.identifier", "DC.Identifier") if (m := _DOI.search(t))]
    return {"authors": authors or None, "abstract": described[0] if described else None, "article_type": kinds[0] if kinds else None, "doi": dois[0] if dois else None}


@F.pandas_udf(T.StructType([T.StructField("authors", T.ArrayType(T.StringType())), T.StructField("abstract", T.StringType()), T.StructField("article_type", T.StringType()), T.StructField("doi", T.StringType())]))
def scrape_metadata(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([page_metadata(h) for h in html], columns=["authors", "abstract", "article_type", "doi"])
