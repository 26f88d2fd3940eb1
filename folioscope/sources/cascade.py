"""The archive's papers in one call: its API, for categories whose scan didn't end well its listing pages, and for those that these don't tell either its feed.
What a source before has found is left out of the next, by id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys, text
from ..sinks.shared import settle
from . import lookups, records, web

# Fixed value: seconds that the archive wants between two requests.
INTERVAL = 3.5
PAPER_COLUMNS = ("source", "title", "authors", "link", "abstract", "images", "date", "doi")


def listing_url(category: str) -> str:
    return f"https://arxiv.org/list/{category}/recent"


def feed_url(category: str) -> str:
    return f"https://rss.arxiv.org/rss/{category}"


def with_abstracts(listed: DataFrame, get: web.Transport, partitions: int = 2, retries: int = 1) -> DataFrame:
    """Papers of listing pages (paper_id, title, authors, date) with the abstract of each one's own page; blank where the page can't be read."""
    link = F.concat(F.lit("https://arxiv.org/abs/"), "paper_id")
    asked = listed.withColumn("link", link)
    pages = lookups.answers(asked, "link", lambda k: k[0], get, partitions=partitions, retries=retries)
    body = F.regexp_extract("body", r'(?s)<blockquote class="abstract mathjax">\s*<span class="descriptor">Abstract:</span>(.*?)</blockquote>', 1)
    told = pages.select(F.get("batch_keys", F.lit(0)).alias("link"), text.squashed(F.regexp_replace(body, "<[^>]+>", "")).alias("abstract"))
    rows = asked.join(told, "link", "left")
    return rows.select(F.lit("arXiv").alias("source"), "title", "authors", "link", F.coalesce("abstract", F.lit("")).alias("abstract"), F.array().cast("array<string>").alias("images"), F.col("date").cast("timestamp").alias("date"), F.lit(None).cast("string").alias("doi"))


def archive_papers(spark: SparkSession, categories: Sequence[str], oldest: Column, now: Column, folder: str | None = None, size: int = 200, pages: int = 50, retries: int = 3, partitions: int = 2, interval: float = INTERVAL) -> DataFrame:
    """Papers since a date, each id once, from the first source that tells each category. `folder` holds stored bodies, in place of the network.
    Requests to a host keep an interval of so many seconds.

    The scan of the API ends where what is older begins. A category without a paper in the window, whose scan ended well, isn't asked for again.
    """
    own = {"folder": folder} if folder else {"interval": interval}
    # pages of papers are asked for by several tasks, each of which keeps its share of the interval
    get = web.file_transport(folder) if folder else web.paced(web.http_transport(), interval * partitions)
    asked = [(c, lookups.arxiv_url(c, size)) for c in categories]
    # a row of an error passes the bound, so that it is known which categories are open
    api = settle(web.scan(spark, asked, pages=pages, pageSize=size, retries=retries, **own).where(F.col("newest") >= F.to_date(oldest)))
    found = [settle(records.arxiv_papers(api.where("error IS NULL"), oldest, now).select(*PAPER_COLUMNS))]
    open_ = _names(api.where("error IS NOT NULL"))  # categories are a list of settings
    if open_:
        lists = settle(web.scan(spark, [(c, listing_url(c)) for c in open_], retries=retries, **own).where("error IS NULL AND body LIKE '%<h3>%'"))
        listed = with_abstracts(_unseen(records.listing_papers(lists.select("name", "body"), oldest), F.col("paper_id"), found), get, partitions, retries)
        found.append(settle(listed.select(*PAPER_COLUMNS)))
        open_ = sorted(set(open_) - set(_names(lists)))
    if open_:
        feeds = web.scan(spark, [(c, feed_url(c)) for c in open_], retries=retries, **own).where("error IS NULL")
        told = records.arxiv_papers(feeds, oldest, F.lit(None).cast("timestamp"))  # an entry without a date is left out
        found.append(settle(_unseen(told, keys.arxiv_link_id(F.col("link")), found).select(*PAPER_COLUMNS)))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _names(pages: DataFrame) -> list[str]:
    return sorted(r["name"] for r in pages.select("name").distinct().collect())


def _unseen(rows: DataFrame, paper_id: Column, found: list[DataFrame]) -> DataFrame:
    """Rows whose id isn't among the papers found so far."""
    out = rows.withColumn("_id", paper_id)
    for df in found:
        out = out.join(df.select(keys.arxiv_link_id(F.col("link")).alias("_id")).distinct(), "_id", "left_anti")
    return out.drop("_id")
