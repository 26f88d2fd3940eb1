"""Records of each source to publications: feeds (XML), Crossref, Europe PMC, bioRxiv, and an archive's listing pages."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schema
from ..functions import dates, html, keys, text
from ..operators.filters import feed_defect, in_section, is_green, is_research

#: Characters of feeds that a task parses at a time.
PARSED = 1 << 20
_ENTRY = "array<struct<title:string,link:string,guid:string,summary:string,doi:string,dates:array<string>,authors:array<string>,tags:array<string>,article_type:string>>"
_SUMMARY_TAGS, _DATE_TAGS, _DOI_TAGS = ("summary", "description", "content", "encoded"), ("published", "pubDate", "updated", "date"), ("doi", "identifier")


def _local(tag: str) -> str:
    return tag.rpartition("}")[2].rpartition(":")[2]


def _inner(node: ET.Element) -> str:
    return "".join(node.itertext()).strip()


def _entry(node: ET.Element) -> dict:
    held: dict[str, list[ET.Element]] = {}
    for child in node:
        held.setdefault(_local(child.tag), []).append(child)
    first = lambda *tags: next((t for tag in tags for x in held.get(tag, ()) if (t := _inner(x))), None)
    links = [x.get("href") or _inner(x) for x in held.get("link", ())]
    people = [_inner(name) if (name := next((c for c in x if _local(c.tag) == "name"), None)) is not None else _inner(x) for x in held.get("author", ())]
    people += [_inner(x) for x in held.get("creator", ())]
    tags = [t.lower() for x in held.get("category", ()) for t in (x.get("term"), x.get("label"), _inner(x)) if t]
    return {
        "title": first("title"), "link": next((x for x in links if x), None), "guid": first("guid"), "summary": first(*_SUMMARY_TAGS), "doi": first(*_DOI_TAGS),
        "dates": [t for tag in _DATE_TAGS for x in held.get(tag, ()) if (t := _inner(x))], "authors": people, "tags": tags, "article_type": first("section"),
    }


def parse_feed(body: str | None) -> list[dict] | None:
    """Entries of an Atom, RSS or RDF document; null if it isn't XML."""
    try:
        root = ET.fromstring(body or "")  # noqa: S314 - external entities aren't resolved
    except ET.ParseError:
        return None
    found = [x for x in root if _local(x.tag) == "entry"] + [y for x in root if _local(x.tag) == "channel" for y in x if _local(y.tag) == "item"]
    return [_entry(x) for x in found or [x for x in root if _local(x.tag) == "item"]]


def with_entries(bodies: DataFrame) -> DataFrame:
    """Adds the `entries` of `body`, which stays where it isn't XML alone. A task holds the entries of `PARSED` characters at a time, as they take some ten times as
    much, and not those of all bodies that Spark hands to it at once."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            share = batch["body"].map(lambda b: len(b or "")).cumsum() // PARSED
            for _, part in batch.groupby(share):
                entries = part["body"].map(parse_feed)
                yield part.assign(body=part["body"].where(entries.isna(), None), entries=entries)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in bodies.schema)
    return bodies.mapInPandas(parse, f"{kinds}, entries {_ENTRY}")


def feed_papers(bodies: DataFrame, feeds: DataFrame, oldest: Column, names: tuple[str, ...], keywords: tuple[str, ...], least: int = 80, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Publications of feeds, and what was turned away with the reason. Bodies: (name, body); feeds: (name, group, section).

    A body that isn't XML is read once more with its bare ampersands escaped; if it isn't even then, it is left out, or (strict) fails the query. Cheap tests come before the text is cleaned.
    """
    tried = with_entries(bodies.select("name", "body"))
    again = with_entries(tried.where("entries IS NULL").select("name", text.repair_xml(F.col("body")).alias("body"))).select("name", "entries")
    if strict:
        again = again.withColumn("entries", F.coalesce("entries", F.raise_error(F.concat(F.lit("not a feed: "), "name")).cast(_ENTRY)))
    entries = tried.where("entries IS NOT NULL").select("name", "entries").unionByName(again).select("name", F.explode("entries").alias("e")).select("name", "e.*")
    rows = entries.join(feeds, "name").withColumn("date", dates.feed_date(*(F.get("dates", F.lit(k)) for k in range(4))))
    title, summary = F.regexp_replace(F.col("title"), "\n", " "), text.text_or_blank(F.col("summary"))
    authors = text.distinct_authors(F.filter(F.transform("authors", text.clean_author), lambda a: a != ""))
    rows = rows.withColumns({"title": title, "summary": summary, "authors": F.array_join(authors, ", ")})
    chosen = (F.col("group") != "green_filter") | is_green(F.col("authors"), F.col("title"), F.col("summary"), names, keywords)
    section = F.lower("section")
    by_section = (F.col("group") != "section_filter") | F.exists("tags", lambda t: F.contains(t, section)) | F.contains(F.lower("title"), section) | F.contains(F.lower("summary"), section)
    rows = rows.where((F.col("date") >= oldest) & is_research(F.col("title"), F.col("article_type")) & chosen & F.coalesce(by_section, F.lit(False)))
    link = F.coalesce("link", "guid")
    cleaned = rows.select(
        F.col("name").alias("source"), "title", "authors", link.alias("link"), text.squashed(html.html_to_text("summary")).alias("abstract"), F.array().cast("array<string>").alias("images"), "date", F.coalesce(keys.normalize_doi(F.col("doi")), keys.normalize_doi(link)).alias("doi")
    )
    judged = cleaned.withColumn("defect", feed_defect(F.col("title"), F.col("link"), F.col("authors"), F.col("abstract"), least))
    return judged.where("defect IS NULL").drop("defect"), judged.where("defect IS NOT NULL")


def arxiv_papers(bodies: DataFrame, oldest: Column, now: Column) -> DataFrame:
    """Entries of an archive's API pages since a date, each id once. A date that can't be read is now."""
    entries = with_entries(bodies.select("page", "body")).select("page", F.posexplode("entries").alias("pos", "e")).select("page", "pos", "e.*")
    published = F.coalesce(dates.feed_date(F.get("dates", F.lit(0))), now)
    rows = entries.select(
        F.lit("arXiv").alias("source"),
        text.squashed(F.col("title")).alias("title"),
        F.array_join(F.transform("authors", text.clean_author), ", ").alias("authors"),
        F.col("link"),
        text.squashed(F.col("summary")).alias("abstract"),
        F.array().cast("array<string>").alias("images"),
        published.alias("date"),
        keys.normalize_doi(F.col("doi")).alias("doi"),
        keys.arxiv_link_id(F.col("link")).alias("paper_id"),
        "page",
        "pos",
    ).where((F.col("date") >= oldest) & is_research(F.col("title")))
    nth = F.row_number().over(Window.partitionBy("paper_id").orderBy("page", "pos"))
    return rows.withColumn("nth", nth).where("nth = 1").drop("nth", "page", "pos", "paper_id")


def _crossref_dates(keys_: tuple[str, ...]) -> Column:
    return F.array(*(dates.date_of_parts(F.get(F.col(f"`{k}`.`date-parts`"), F.lit(0))) for k in keys_))


def crossref_papers(items: DataFrame, source: str, now: Column, end: Column, days: int = 7) -> DataFrame:
    """Works whose earliest date that isn't in the future lies in the window."""
    kinds = ("published", "published-online", "published-print", "posted", "issued", "created", "deposited", "indexed")
    family = F.filter(F.coalesce("author", F.array().cast("array<struct<given:string,family:string,ORCID:string>>")), lambda a: F.coalesce(a["family"], F.lit("")) != "")
    names = F.transform(family, lambda a: F.when(F.coalesce(a["given"], F.lit("")) == "", a["family"]).otherwise(F.concat_ws(" ", a["given"], a["family"])))
    doi = F.coalesce("DOI", F.lit(""))
    abstract = text.stripped(F.regexp_replace(F.coalesce("abstract", F.lit("")), "<[^>]+>", ""))
    day = dates.earliest_not_future(_crossref_dates(kinds), now)
    return items.select(
        F.lit(source).alias("source"),
        F.regexp_replace(F.coalesce(F.get("title", F.lit(0)), F.lit("No Title")), "\n", " ").alias("title"),
        F.when(F.size(names) == 0, "Unknown").otherwise(F.array_join(names, ", ")).alias("authors"),
        F.when(doi != "", F.concat(F.lit("https://doi.org/"), doi)).otherwise(F.coalesce("URL", F.lit(""))).alias("link"),
        F.when(abstract == "", "Abstract not available via CrossRef API.").otherwise(abstract).alias("abstract"),
        F.array().cast("array<string>").alias("images"),
        day.cast("timestamp").alias("date"),
        F.when(doi != "", F.concat(F.lit("https://doi.org/"), doi)).alias("doi"),
    ).where(dates.in_window(F.col("date"), end, days))


def europepmc_papers(items: DataFrame, source: str, oldest: Column, group: str = "include_all", section: str | None = None, names: tuple[str, ...] = (), keywords: tuple[str, ...] = (), least: int = 80, strict: bool = True) -> DataFrame:
    """Research records since a date. Strict: an incomplete one fails the query, whether or not a later filter would drop it."""
    clean = lambda c: text.squashed(F.regexp_replace(text.text_or_blank(c), "<[A-Za-z/][^>]*>", ""))
    listed = F.array_join(F.filter(F.transform("authorList.author", lambda a: text.field(a["fullName"])), lambda a: a != ""), ", ")
    doi, number = F.lower(text.field(F.col("doi"))), text.field(F.col("id"))
    rows = items.select(
        F.lit(source).alias("source"),
        clean(F.col("title")).alias("title"),
        F.coalesce(F.nullif(text.field(F.col("authorString")), F.lit("")), listed, F.lit("")).alias("authors"),
        F.when(doi != "", F.concat(F.lit("https://doi.org/"), doi)).when(number != "", F.concat(F.lit("https://europepmc.org/article/"), F.coalesce("source", F.lit("MED")), F.lit("/"), number)).otherwise("").alias("link"),
        clean(F.col("abstractText")).alias("abstract"),
        F.array().cast("array<string>").alias("images"),
        dates.first_iso(F.col("firstPublicationDate"), F.col("electronicPublicationDate"), F.col("journalInfo.printPublicationDate")).alias("date"),
        F.nullif(doi, F.lit("")).alias("doi"),
        F.array_join("pubTypeList.pubType", ", ").alias("kind"),
    )
    if strict:
        rows = rows.withColumn("date", F.coalesce("date", F.raise_error(F.lit("a record has no usable date")).cast("date")))
    rows = rows.where((F.col("date") >= oldest) & is_research(F.col("title"), F.col("kind")))
    if strict:
        defect = F.concat_ws(", ", F.when(F.col("title") == "", "title"), F.when(F.col("authors") == "", "authors"), F.when(F.col("link") == "", "link"), F.when(F.length("abstract") < least, "abstract"))
        rows = rows.withColumn("title", F.when(defect == "", F.col("title")).otherwise(F.raise_error(F.concat(F.lit("a research record is missing "), defect)).cast("string")))
    if group == "section_filter" and section:
        rows = rows.where(in_section(F.array().cast("array<string>"), F.col("title"), F.col("abstract"), section))
    elif group == "green_filter":
        rows = rows.where(is_green(F.col("authors"), F.col("title"), F.col("abstract"), names, keywords))
    return rows.drop("kind").withColumn("date", F.col("date").cast("timestamp"))


def biorxiv_papers(items: DataFrame, collection: str, now: Column, end: Column, days: int = 7) -> DataFrame:
    """Preprints of a collection, dated by their first posting. A date that can't be read is now."""
    reported = F.coalesce(dates.iso_prefix(F.col("date")), F.to_date(now))
    return items.where(F.lower(F.coalesce("category", F.lit(""))) == collection.lower()).select(
        F.lit("bioRxiv").alias("source"),
        F.regexp_replace("title", "\n", " ").alias("title"),
        F.coalesce("authors", F.lit("")).alias("authors"),
        F.concat(F.lit("https://www.biorxiv.org/content/"), "doi", F.lit("v"), "version").alias("link"),
        text.clean_preprint_abstract(F.regexp_replace("abstract", "\n", " ")).alias("abstract"),
        F.array().cast("array<string>").alias("images"),
        dates.first_posted(F.col("doi"), reported).cast("timestamp").alias("date"),
        "doi",
    ).where(dates.in_window(F.col("date"), end, days))


def require_complete(searches: DataFrame, hits: Column, got: Column) -> None:
    """Raises if there is no search, or if one of them says it has no record, or more than it returned. A row a search."""
    counts = searches.select(hits.alias("hits"), got.alias("got"))
    none = F.coalesce("hits", F.lit(0)) == 0
    bad = counts.where(none | (F.col("hits") > F.coalesce("got", F.lit(0)))).first()
    if bad and bad["hits"]:
        raise ValueError(f"only {bad['got'] or 0} of {bad['hits']} records")
    if bad or counts.isEmpty():
        raise ValueError("no records; completeness can't be confirmed")


def europepmc_items(bodies: DataFrame) -> DataFrame:
    """Records of search results (body). Raises unless every search returned all that it found."""
    fields = f"hitCount long, resultList struct<result:array<struct<{_struct(schema.EUROPEPMC)}>>>"
    told = bodies.select(F.from_json("body", fields).alias("s")).select("s.*")
    require_complete(told, F.col("hitCount"), F.size("resultList.result"))
    return told.select(F.explode("resultList.result").alias("r")).select("r.*")


def _struct(ddl: str) -> str:
    """The fields of a DDL schema as those of a struct."""
    return StructType.fromDDL(ddl).simpleString()[len("struct<") : -1]


def listing_papers(pages: DataFrame, oldest: Column, reach: int = 20) -> DataFrame:
    """(paper_id, title, authors, date) of an archive's listing pages (name, body): dates stand in headers and are carried forward; title and
    authors are the last ones within `reach` lines after an id."""
    lines = pages.select("name", F.posexplode(F.split("body", "\n")).alias("pos", "line"))
    head = r"<h3>\w+,\s+(\d+)\s+(\w+)\s+(\d{4})\s+\("
    day = dates.feed_date(F.concat_ws(" ", F.nullif(F.regexp_extract("line", head, 1), F.lit("")), F.regexp_extract("line", head, 2), F.regexp_extract("line", head, 3), F.lit("00:00:00")))
    w = Window.partitionBy("name").orderBy("pos")
    ahead = w.rowsBetween(0, reach)
    tail = F.array_join(F.collect_list("line").over(w.rowsBetween(0, 5)), " ")
    titled = F.when(F.contains(F.col("line"), F.lit("<span class='descriptor'>Title:</span>")), F.regexp_extract(tail, r"<span class='descriptor'>Title:</span>\s*(.*?)(?:</div>|$)", 1))
    people = F.regexp_extract_all(F.nullif(F.regexp_extract("line", r"<div class='list-authors'>(.*?)</div>", 1), F.lit("")), F.lit(r">([^<]+)</a>"), F.lit(1))
    names = F.array_join(F.transform(people, lambda n: text.stripped(F.regexp_replace(n, r"\s*\(\d[^)]*\)\s*", ""))), ", ")
    marked = lines.select("name", "pos", F.last(day, True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("date"), F.nullif(F.regexp_extract("line", r"arXiv:(\d+\.\d+)", 1), F.lit("")).alias("paper_id"), F.last(titled, True).over(ahead).alias("title"), F.last(names, True).over(ahead).alias("authors"))
    title = text.stripped(F.regexp_replace("title", "<[^>]+>", ""))
    found = marked.where(F.col("paper_id").isNotNull() & (F.col("date") >= oldest)).select("paper_id", title.alias("title"), F.coalesce("authors", F.lit("")).alias("authors"), "date", "name", "pos")
    found = found.where((F.coalesce("title", F.lit("")) != "") & is_research(F.col("title")))
    nth = F.row_number().over(Window.partitionBy("paper_id").orderBy("name", "pos"))
    return found.withColumn("nth", nth).where("nth = 1").drop("nth", "name", "pos")
