"""Lookup joins: distinct keys are asked for once, in batches, by a bounded number of tasks, and answers are joined back. Cheap sources go first; the
next one is asked only for what is still open."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, keys, text
from ..sinks.shared import settle
from .web import Transport, fetch

#: Characters of bodies, and answers, that leave a task together.
ANSWER_CHARS, ANSWERS = 4 << 20, 1000
_ANSWER = ["batch_keys", "status", "body", "error"]


def answers(asked: DataFrame, key: str, url_of: Callable[[list[str]], str], get: Transport, batch: int = 1, partitions: int = 2, retries: int = 3) -> DataFrame:
    """(batch_keys, status, body, error): one answer per batch of distinct keys that aren't blank. A failed batch has a null body.

    `partitions` is how many tasks ask at a time, so that a service isn't asked by more; a transport that says it is `local` asks nobody, so single keys go to as many
    tasks as a shuffle has; batches are filled from a task's keys. Answers leave a task some megabytes at a time.
    """

    def run(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[str] = []
        told: list[tuple] = []
        size = 0

        def ask() -> int:
            status, body, error = fetch(get, url_of(held), retries)
            told.append((list(held), status, None if error else body, error))
            return len(body or "")

        for rows in source:
            for k in rows["key"]:
                held.append(k)
                if len(held) >= batch:
                    size += ask()
                    held = []
                    if size >= ANSWER_CHARS or len(told) >= ANSWERS:
                        yield pd.DataFrame(told, columns=_ANSWER)
                        told, size = [], 0
        if held:
            ask()
        if told:
            yield pd.DataFrame(told, columns=_ANSWER)

    distinct = asked.select(F.col(key).cast("string").alias("key")).where("key <> ''").distinct()
    if batch == 1 and getattr(get, "local", False):
        partitions = max(partitions, int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return distinct.repartition(partitions).mapInPandas(run, "batch_keys array<string>, status int, body string, error string")


def resolved(rows: DataFrame, key: str, value: str, stages: list[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Adds `value` from the first stage that knows a key; each stage maps (key) to (key, value) and is asked for open keys only."""
    open_ = rows.select(F.col(key).alias("key")).where("key IS NOT NULL").distinct()
    found = None
    for stage in stages:
        own = stage(open_).where(F.col(value).isNotNull()).groupBy("key").agg(F.max(value).alias(value))
        found = own if found is None else found.unionByName(own)
        open_ = open_.join(own, "key", "left_anti")
    return rows.join(found.withColumnRenamed("key", key), key, "left")


def crossref_work_url(doi: list[str]) -> str:
    return "https://api.crossref.org/works/" + quote(doi[0], safe="")


def crossref_author_url(orcid: str, since: str, rows: int = 10) -> str:
    return f"https://api.crossref.org/works?filter=orcid:{orcid},from-pub-date:{since}&rows={rows}"


def crossref_journal_url(issn: str, since: str, rows: int = 25) -> str:
    return f"https://api.crossref.org/works?filter=issn:{issn},from-pub-date:{since}&rows={rows}"


def crossref_title_url(title: list[str]) -> str:
    return f"https://api.crossref.org/works?query.title={quote(title[0], safe='')}&rows=1&select=title,published-online,published-print,published,issued,created"


def arxiv_url(category: str, size: int = 200) -> str:
    return f"https://export.arxiv.org/api/query?search_query=cat:{category}&sortBy=submittedDate&sortOrder=descending&start={{cursor}}&max_results={size}"


def arxiv_ids_url(ids: list[str]) -> str:
    return f"https://export.arxiv.org/api/query?id_list={','.join(ids)}&max_results={len(ids)}"


_WORK = "message struct<author:array<struct<given:string,family:string,ORCID:string>>,abstract:string>"


def work_metadata(found: DataFrame) -> DataFrame:
    """(key, authors, abstract, orcids) of answers about single works; orcids are null where the lookup failed."""
    m = F.from_json("body", _WORK)["message"]
    people = F.filter(m["author"], lambda a: F.coalesce(a["family"], F.lit("")) != "")
    names = F.transform(people, lambda a: F.concat_ws(" ", F.nullif(a["given"], F.lit("")), a["family"]))
    abstract = text.stripped(F.regexp_replace(m["abstract"], "<[^>]+>", ""))
    orcids = F.filter(F.transform(F.coalesce(m["author"], F.array().cast("array<struct<given:string,family:string,ORCID:string>>")), lambda a: a["ORCID"]), lambda o: o.isNotNull())
    return found.select(F.get("batch_keys", F.lit(0)).alias("key"), F.when(F.size(names) > 0, names).alias("authors"), F.nullif(abstract, F.lit("")).alias("abstract"), F.when(F.col("body").isNotNull(), orcids).alias("orcids"))


def arxiv_dates(found: DataFrame) -> DataFrame:
    """(key, date) of answers that list entries."""
    entry = found.select(F.explode(F.slice(F.split("body", "<entry>"), 2, 100_000)).alias("e"))
    return entry.select(keys.arxiv_key_id(F.regexp_extract("e", r"<id>([^<]+)</id>", 1)).alias("key"), dates.iso_prefix(F.regexp_extract("e", r"<published>([^<]+)</published>", 1)).alias("date"))


def scholar_dates(found: DataFrame) -> DataFrame:
    """(key, date) of answers that are a JSON array with external ids."""
    rows = found.select(F.explode(F.from_json("body", "array<struct<externalIds:struct<ArXiv:string>,publicationDate:string>>")).alias("r"))
    return rows.select(F.col("r.externalIds.ArXiv").alias("key"), dates.iso_prefix(F.col("r.publicationDate")).alias("date"))


def same_title(asked: Column, returned: Column) -> Column:
    """Whether a search by title found the work: three of its significant words, or all if there are fewer, stand in the title returned."""
    words = F.filter(F.split(F.lower(text.strip_markup(asked)), r"\W+"), lambda w: F.length(w) >= 5)

    def judged(x: Column) -> Column:
        hits = F.filter(x["words"], lambda w: F.contains(x["low"], w))
        return (F.size(x["words"]) > 0) & (F.size(hits) >= F.least(F.lit(3), F.size(x["words"])))

    # bound by a lambda, so that the title returned is cleaned once and not for each word
    return F.get(F.transform(F.array(F.struct(words.alias("words"), F.lower(text.strip_markup(returned)).alias("low"))), judged), F.lit(0))


_DATED = "`published-online`, `published-print`, published, issued, created".split(", ")
_DATED_WORK = "struct<title:array<string>, " + ", ".join(f"{k}:struct<`date-parts`:array<array<int>>>" for k in _DATED) + ">"


def _stated_dates(work: Column) -> Column:
    return F.array_compact(F.array(*(dates.date_of_parts(F.get(work[k.strip("`")]["date-parts"], F.lit(0))) for k in _DATED)))


def journal_dates(rows: DataFrame, get: Transport, start: Column, end: Column, partitions: int = 2) -> DataFrame:
    """(link, date) of articles (link, title): a date within the window that the page states, else the one preferred of all that the page and the work
    state. A work is asked for by its DOI, or by its title if link and page have none; then it must be the work of that title. Null if nothing is known."""
    asked = rows.select("link", "title").where("link <> ''").dropDuplicates(["link"])
    pages = settle(answers(asked, "link", lambda links: links[0], get, partitions=partitions))
    html = pages.select(F.get("batch_keys", F.lit(0)).alias("link"), "body")
    found = asked.join(html, "link", "left").withColumn("on_page", F.array_compact(F.transform(dates.metadata_dates(F.col("body")), dates.normalized_date)))
    found = found.withColumn("doi", keys.doi_of_link_or_html(F.col("link"), F.col("body"))).drop("body")
    open_ = found.where(~F.exists("on_page", lambda d: d.between(start, end)))
    by_doi = settle(answers(open_, "doi", crossref_work_url, get, partitions=partitions))
    by_title = settle(answers(open_.where("doi IS NULL"), "title", crossref_title_url, get, partitions=partitions))
    works = by_doi.select(F.get("batch_keys", F.lit(0)).alias("doi"), _stated_dates(F.from_json("body", f"message {_DATED_WORK}")["message"]).alias("by_doi"))
    hits = by_title.select(F.get("batch_keys", F.lit(0)).alias("title"), F.get(F.from_json("body", f"message struct<items:array<{_DATED_WORK}>>")["message"]["items"], F.lit(0)).alias("w"))
    titled = hits.where(same_title(F.col("title"), F.get("w.title", F.lit(0)))).select("title", _stated_dates(F.col("w")).alias("by_title"))
    out = found.join(works, "doi", "left").join(titled, "title", "left")
    none = F.array().cast("array<date>")
    looked_up = F.when(F.col("doi").isNotNull(), F.coalesce("by_doi", none)).otherwise(F.coalesce("by_title", none))
    return out.select("link", dates.preferred_date(F.concat("on_page", looked_up), start, end).alias("date"))


def backup_issns(failed: DataFrame, issns: DataFrame) -> DataFrame:
    """(name, issn) of the feeds (`name`) that a journal number stands in for, by name without case and white space around it; a feed without one
    is left out, and one that is listed twice has the number of least `pos`."""
    key = F.lower(F.trim("name"))
    known = issns.where("issn <> ''").groupBy(key.alias("_key")).agg(F.min_by("issn", "pos").alias("issn"))
    return failed.select("name", key.alias("_key")).distinct().join(known, "_key").select("name", "issn")
