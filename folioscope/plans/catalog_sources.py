"""More of the catalog: source records, listing pages, classification and archive backfill, as queries with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import policy
from ..sinks.shared import settle
from ..sources import lookups, records
from . import pipeline
from .driver_tables import EDITION, PAPERS_SQL, papers, read, spread

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def _end():
    return F.lit(EDITION).cast("date")


def _day(c):
    return F.date_format(c, "yyyy-MM-dd")


_AUGUST = "DATE '2026-08-01' + CAST(doc_id % 12 AS INT)"


@_query(f"""SELECT doc_id, source || ' ' || lang AS title, 'A ' || source || ', Z' AS authors, CASE WHEN doc_id % 3 = 0 THEN 'https://u/' || doc_id ELSE 'https://doi.org/10.1/' || doc_id END AS link,
  CASE WHEN doc_id % 4 = 0 THEN 'Abstract not available via CrossRef API.' ELSE lang END AS abstract, strftime({_AUGUST}, '%Y-%m-%d') AS date FROM documents WHERE {_AUGUST} BETWEEN DATE '2026-08-03' AND DATE '2026-08-10'""")
def crossref_records(spark, d):
    n = F.col("doc_id")
    none = F.lit(None).cast("struct<`date-parts`:array<array<int>>>")
    person = lambda g, f: F.struct(F.lit(g).cast("string").alias("given"), (f if not isinstance(f, str) else F.lit(f)).alias("family"), F.lit(None).cast("string").alias("ORCID"))
    parts = lambda *x: F.struct(F.array(F.array(*x)).alias("date-parts"))
    items = read(spark, d, "documents").select(
        F.when(n % 3 != 0, F.concat(F.lit("10.1/"), n.cast("string"))).alias("DOI"),
        F.concat(F.lit("https://u/"), n.cast("string")).alias("URL"),
        F.array(F.concat("source", F.lit("\n"), "lang")).alias("title"),
        F.when(n % 4 != 0, F.concat(F.lit("<jats:p>"), "lang", F.lit("</jats:p> "))).alias("abstract"),
        F.array(person("A", F.col("source")), person(None, "Z"), person("x", "")).alias("author"),
        parts(F.lit(2026), F.lit(8), (1 + n % 12).cast("int")).alias("published"),
        parts(F.lit(2030)).alias("published-online"),
        parts(F.lit(2026), F.lit(13), F.lit(1)).alias("published-print"),
        *(none.alias(k) for k in ("posted", "issued", "created", "deposited", "indexed")),
    )
    number = F.regexp_extract("link", r"(\d+)$", 1).cast("long").alias("doc_id")
    return records.crossref_papers(items, "C", F.lit("2027-01-01").cast("date"), _end()).select(number, "title", "authors", "link", "abstract", _day("date").alias("date"))


@_query("SELECT doc_id, 'On ' || source AS title, strftime(DATE '2026-07-20' + CAST(doc_id % 20 AS INT), '%Y-%m-%d') AS date FROM documents WHERE source IS NOT NULL AND DATE '2026-07-20' + CAST(doc_id % 20 AS INT) >= DATE '2026-08-03'")
def search_results(spark, d):
    """Results of many searches, each of which must state as many hits as it returned, as publications."""
    s = F.col("doc_id").cast("string")
    day = F.date_format(F.date_add(F.lit("2026-07-20").cast("date"), (F.col("doc_id") % 20).cast("int")), "yyyy-MM-dd")
    kind = F.struct(F.array(F.lit("Journal Article")).alias("pubType")).alias("pubTypeList")
    item = F.to_json(F.struct(s.alias("id"), F.lit("MED").alias("source"), F.concat(F.lit("On <i>"), "source", F.lit("</i>")).alias("title"), F.lit("A B").alias("authorString"), day.alias("firstPublicationDate"), F.lit("body text " * 12).alias("abstractText"), kind))
    found = read(spark, d, "documents").where("source IS NOT NULL").select("source", F.floor(F.col("doc_id") / 50).alias("part"), item.alias("item")).groupBy("source", "part").agg(F.count("*").alias("n"), F.array_join(F.collect_list("item"), ",").alias("items"))
    bodies = found.select(F.concat(F.lit('{"hitCount": '), F.col("n").cast("string"), F.lit(', "resultList": {"result": ['), "items", F.lit("]}}")).alias("body"))
    rows = records.europepmc_papers(records.europepmc_items(bodies), "Journal", F.lit("2026-08-03").cast("date"))
    return rows.select(F.regexp_extract("link", r"/(\d+)$", 1).cast("long").alias("doc_id"), "title", F.date_format("date", "yyyy-MM-dd").alias("date"))


@_query("""SELECT doc_id, 'T ' || source AS title, CASE WHEN doc_id % 2 = 0 THEN 'Given A' ELSE source || ', B' END AS authors, CASE WHEN doc_id % 3 = 0 THEN 'https://europepmc.org/article/MED/' || doc_id ELSE 'https://doi.org/10.1/a' || doc_id END AS link,
  strftime(DATE '2026-07-20' + CAST(doc_id % 20 AS INT), '%Y-%m-%d') AS date FROM documents WHERE doc_id % 5 <> 0 AND DATE '2026-07-20' + CAST(doc_id % 20 AS INT) >= DATE '2026-08-03'""")
def europepmc_records(spark, d):
    n = F.col("doc_id")
    s = n.cast("string")
    day = F.date_format(F.date_add(F.lit("2026-07-20").cast("date"), (n % 20).cast("int")), "yyyy-MM-dd")
    person = lambda c: F.struct(c.alias("fullName"))
    items = read(spark, d, "documents").select(
        s.alias("id"),
        F.lit("MED").alias("source"),
        F.when(n % 3 != 0, F.concat(F.lit("10.1/A"), s)).alias("doi"),
        F.concat(F.lit("<b>T</b>  "), "source").alias("title"),
        F.when(n % 2 == 0, " Given A ").alias("authorString"),
        F.when(n % 7 != 0, day).alias("firstPublicationDate"),
        F.when(n % 7 == 0, F.concat(day, F.lit("T00"))).alias("electronicPublicationDate"),
        F.lit("body text " * 12).alias("abstractText"),
        F.struct(F.array(F.when(n % 5 == 0, "Editorial").otherwise("Journal Article")).alias("pubType")).alias("pubTypeList"),
        F.struct(F.lit(None).cast("string").alias("printPublicationDate")).alias("journalInfo"),
        F.struct(F.array(person(F.col("source")), person(F.lit(" ")), person(F.lit("B"))).alias("author")).alias("authorList"),
    )
    number = F.regexp_extract("link", r"(\d+)$", 1).cast("long").alias("doc_id")
    return records.europepmc_papers(items, "J", F.lit("2026-08-03").cast("date")).select(number, "title", "authors", "link", _day("date").alias("date"))


@_query("""SELECT doc_id, 'https://www.biorxiv.org/content/10.1101/2026.08.0' || (1 + doc_id % 9) || '.' || doc_id || 'v2' AS link, source || ' says' AS abstract, strftime(least(DATE '2026-08-06', DATE '2026-08-01' + CAST(doc_id % 9 AS INT)), '%Y-%m-%d') AS date
FROM documents WHERE lang = 'en' AND least(DATE '2026-08-06', DATE '2026-08-01' + CAST(doc_id % 9 AS INT)) >= DATE '2026-08-03'""")
def preprint_records(spark, d):
    n = F.col("doc_id")
    items = read(spark, d, "documents").select(
        F.concat(F.lit("10.1101/2026.08.0"), (1 + n % 9).cast("string"), F.lit("."), n.cast("string")).alias("doi"), "source", F.lit("T\nU").alias("title"), F.lit("A").alias("authors"), F.lit("2026-08-06").alias("date"), F.lit("2").alias("version"), F.upper("lang").alias("category"),
        F.concat("source", F.lit("\nsays Graphical Abstract x")).alias("abstract"),
    )
    number = F.regexp_extract("link", r"\.(\d+)v2$", 1).cast("long").alias("doc_id")
    return records.biorxiv_papers(items, "en", F.lit("2026-08-10").cast("date"), _end()).select(number, "link", "abstract", _day("date").alias("date"))


@_query("""SELECT doc_id, 'Cells & ' || source AS title, 'Jo Doe, ' || source AS authors, 'https://x.org/' || doc_id AS link, CASE WHEN doc_id % 2 = 0 THEN '10.1000/' || doc_id END AS doi FROM documents WHERE doc_id % 4 <> 0 AND (doc_id % 3 <> 0 OR lang = 'de')""")
def feed_records(spark, d):
    n, s = F.col("doc_id"), F.col("doc_id").cast("string")
    day = F.when(n % 4 == 0, "Wed, 05 Aug 2020 10:00:00 GMT").otherwise("Wed, 05 Aug 2026 10:00:00 GMT")
    item = F.concat(
        F.lit("<rss xmlns:dc='d'><channel><item><title>Cells & "), "source", F.lit("</title><link>https://x.org/"), s, F.lit("</link><pubDate>"), day, F.lit("</pubDate><dc:creator>jo@x.org (Jo Doe)</dc:creator><dc:creator>"), "source",
        F.lit("</dc:creator><dc:creator>JO DOE</dc:creator><category>lang "), "lang", F.lit("</category>"), F.when(n % 2 == 0, F.concat(F.lit("<dc:identifier>doi:10.1000/"), s, F.lit("</dc:identifier>"))).otherwise(""), F.lit("<description>" + "Words of it. " * 10 + "</description></item></channel></rss>"),
    )
    docs = read(spark, d, "documents")
    feeds = docs.select(s.alias("name"), F.when(n % 3 == 0, "section_filter").otherwise("include_all").alias("group"), F.when(n % 3 == 0, "LANG DE").alias("section"))
    kept, _ = records.feed_papers(docs.select(s.alias("name"), item.alias("body")), feeds, F.lit("2026-08-03").cast("timestamp"), (), ())
    return kept.select(F.col("source").cast("long").alias("doc_id"), "title", "authors", "link", "doi")


@_query("""SELECT doc_id, '26' || lpad(CAST(doc_id % 100 AS VARCHAR), 2, '0') || '.' || doc_id AS paper_id, 'On ' || source || ' and ' || lang AS title, 'A One, ' || source AS authors, strftime(DATE '2026-08-03' + CAST(doc_id % 7 AS INT), '%Y-%m-%d') AS date FROM documents WHERE doc_id % 7 >= 2""")
def listing_records(spark, d):
    n, s = F.col("doc_id"), F.col("doc_id").cast("string")
    day = F.date_add(F.lit("2026-08-03").cast("date"), (n % 7).cast("int"))
    lines = (
        F.concat(F.lit("<h3>"), F.date_format(day, "EEE, d MMM yyyy"), F.lit(" (showing 1 of 1 entries )</h3>")),
        F.concat(F.lit("arXiv:26"), F.lpad((n % 100).cast("string"), 2, "0"), F.lit("."), s),
        F.concat(F.lit("<span class='descriptor'>Title:</span> On "), "source"),
        F.concat(F.lit("and "), "lang", F.lit("</div>")),
        F.concat(F.lit("<div class='list-authors'><a>A One (2)</a>, <a>"), "source", F.lit("</a></div>")),
    )
    pages = read(spark, d, "documents").select(s.alias("name"), F.concat_ws("\n", *lines).alias("body"))
    number = F.regexp_extract("paper_id", r"\.(\d+)$", 1).cast("long").alias("doc_id")
    return records.listing_papers(pages, F.lit("2026-08-05").cast("timestamp")).select(number, "paper_id", "title", "authors", _day("date").alias("date"))


@_query(f"""WITH {PAPERS_SQL}, h AS (SELECT *, CAST(contains(lower(title || ' ' || abstract), 'anonthe') AS INT) + CAST(contains(lower(title || ' ' || abstract), 'heed') AS INT) + CAST(contains(lower(title || ' ' || abstract), 'ungß') AS INT) AS hits, contains(lower(title || ' ' || abstract), 'e') AS e FROM papers)
SELECT seq, CASE WHEN source = 'src7' THEN 'featured' WHEN hits > 0 OR (e AND seq % 10 >= 5) THEN 'regular' END AS category,
  CASE WHEN source = 'src7' THEN 'Featured source or author' WHEN hits > 0 THEN 'AI Approved' WHEN NOT e THEN 'AI Recall Rejected' WHEN seq % 10 >= 5 THEN 'AI Recall Approved' ELSE 'AI Recall Rejected by Learning Gate' END AS reason,
  CAST(CASE WHEN source = 'src7' THEN NULL ELSE least(100, 30 + 25 * hits) END AS INT) AS initial FROM h""")
def classify_route(spark, d):
    p = papers(spark, d).withColumn("local_score", (F.col("seq") % 10) / 100)
    always = policy.keyword_model(("e",))
    out = policy.classify(p, F.col("source") == "src7", policy.keyword_model(("anonthe", "heed", "ungß")), always, settle)
    return out.select("seq", "category", "reason", F.col("initial_classifier_score").alias("initial"))


@_query("""SELECT 'P' || page_id AS title, CASE page_id % 5 WHEN 0 THEN '2026-08-01' WHEN 1 THEN '2026-08-02' WHEN 2 THEN '2026-08-03' WHEN 3 THEN '2026-08-06' END AS date,
  CASE WHEN page_id % 5 = 0 THEN 'Saved' WHEN page_id % 5 = 2 THEN 'bioRxiv' ELSE 'h' || page_id || '.org' END AS source FROM pages""")
def archive_backfill(spark, d):
    n, s = F.col("page_id"), F.col("page_id").cast("string")
    link = F.when(n % 5 == 2, F.concat(F.lit("https://www.biorxiv.org/content/10.1101/2026.08.03."), s, F.lit("v1"))).otherwise(F.concat(F.lit("https://www.h"), s, F.lit(".org/x")))
    pages = read(spark, d, "pages")
    entries = pages.select(F.concat(F.lit("P"), s).alias("title"), link.alias("link"))
    saved = pages.where("page_id % 5 = 0").select(link.alias("link"), F.lit("").alias("title"), n.alias("pos"), F.lit("Saved").alias("source"), F.lit("2026-08-01").alias("date"))
    history = pages.where("page_id % 5 = 1").select(F.lit("").alias("link"), F.concat(F.lit("P"), s).alias("title"), n.alias("pos"), F.lit("2026-08-02T00:00:00").alias("date"))
    arxiv = spark.createDataFrame([], "arxiv_id string, date string")
    html = pages.where("page_id % 5 = 3").select(link.alias("link"), F.lit('<meta name="citation_date" content="2026/07/01"><meta name="dc.date" content="2026-8-6">').alias("html"))
    return pipeline.backfill(entries, saved, history, arxiv, html, F.date_sub(_end(), 7), _end()).select("title", _day("date").alias("date"), "source")


@_query("""WITH w AS (SELECT doc_id, list_filter(string_split_regex(lower(trim(regexp_replace(regexp_replace(split_part(text, chr(10), 1), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))), '[^a-z0-9_]+'), lambda x: length(x) >= 5) AS a, lower(substring(text, 20)) AS b FROM documents)
SELECT doc_id, len(a) > 0 AND len(list_filter(a, lambda x: contains(trim(regexp_replace(b, '\\s+', ' ', 'g')), x))) >= least(3, len(a)) AS same FROM w""")
def title_search(spark, d):
    asked, returned = F.substring_index("text", "\n", 1), F.expr("substring(text, 20)")  # what follows the first words is all of the text
    return spread(read(spark, d, "documents").select("doc_id", "text")).select("doc_id", lookups.same_title(asked, returned).alias("same"))


@_query("SELECT source AS name, '0000-' || lpad(CAST(min(length(source) + doc_id) AS VARCHAR), 4, '0') AS issn FROM documents WHERE lang = 'de' AND source IN (SELECT source FROM documents WHERE doc_id % 3 = 0) GROUP BY source")
def backup_issn(spark, d):
    docs = read(spark, d, "documents")
    issns = docs.where("lang = 'de'").select(F.concat(F.lit(" "), F.upper("source")).alias("name"), F.col("doc_id").alias("pos"), F.concat(F.lit("0000-"), F.lpad((F.length("source") + F.col("doc_id")).cast("string"), 4, "0")).alias("issn"))
    return lookups.backup_issns(docs.where("doc_id % 3 = 0").select(F.col("source").alias("name")), issns)
