"""The rest of the catalog: files and sinks there and back, scans and lookups over stored responses, and small functions, as queries with their SQL."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from .. import schema
from ..functions import dates, html, keys, text
from ..operators import filters, policy
from ..sinks import files as sinks
from ..sinks.shared import scratch, settle
from ..sources import files, lookups, records, web
from . import pipeline
from .driver_tables import EDITION, PAPERS_SQL, papers, read, spread

QUERIES: dict = {}
SQL: dict[str, str] = {}
_P = "WITH " + PAPERS_SQL
_NOW = "2027-01-01"


def _query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def _end():
    return F.lit(EDITION).cast("date")


def _start():
    return F.date_sub(_end(), 7)


def _day(c):
    return F.date_format(c, "yyyy-MM-dd")


def _text(c):
    return F.col(c).cast("string")


# --- files and sinks ---------------------------------------------------------------------------------------------------------------------


@_query(f"{_P} SELECT link, title, doi, strftime(date, '%Y-%m-%dT00:00:00+00:00') AS date FROM papers")
def candidate_file(spark, d):
    path = scratch(spark)
    sinks.candidates(papers(spark, d).drop("abstract").withColumn("date", F.col("date").cast("timestamp")), path)
    return files.json_lines(spark, path, schema.PAPER_JSON, strict=True).select("link", "title", "doi", "date")


@_query(f"{_P} SELECT link, source, title, authors FROM papers")
def candidate_arrays(spark, d):
    path = scratch(spark)
    rows = papers(spark, d).select(F.floor(F.col("seq") / 1000).alias("part"), F.struct("source", "title", "authors", "link").alias("p"))
    rows.groupBy("part").agg(F.to_json(F.collect_list("p")).alias("value")).write.partitionBy("part").text(path)
    return files.candidates(spark, f"{path}/*").select("link", "source", "title", "authors")


@_query("SELECT doc_id, source FROM documents WHERE lang <> 'de'")
def tolerant_lines(spark, d):
    path = scratch(spark)
    line = F.to_json(F.struct("doc_id", "source"))
    read(spark, d, "documents").select(F.when(F.col("lang") == "de", F.concat(F.lit("{bad "), line)).otherwise(line).alias("value")).write.text(path)
    return files.json_lines(spark, path, "doc_id long, source string")


@_query("SELECT doc_id, text FROM documents")
def strict_lines(spark, d):
    path = scratch(spark)
    sinks.json_lines(spread(read(spark, d, "documents").select("doc_id", "text")), path)
    return files.json_lines(spark, path, "doc_id long, text string", strict=True)


@_query(f"{_P} SELECT link, CASE lang WHEN 'en' THEN 'Regular' ELSE 'featured' END AS label FROM papers JOIN documents ON seq = doc_id WHERE lang IN ('en', 'fr') AND seq % 3 <> 2")
def sent_before(spark, d):
    path = scratch(spark)
    rows = papers(spark, d).select("seq", "link", "title", "doi").join(read(spark, d, "documents").select(F.col("doc_id").alias("seq"), "lang"), "seq")
    label = F.when(F.col("lang") == "en", "Regular").when(F.col("lang") == "fr", "featured").otherwise("rejected")
    days = ("2026-07-27", "2026-08-03", EDITION)
    rows = rows.withColumn("label", label).withColumn("file", F.concat(F.lit("filter_decisions_"), F.element_at(F.array(*map(F.lit, days)), (1 + F.col("seq") % 3).cast("int")), F.lit(".jsonl")))
    for day in days:
        sinks.json_lines(rows.where(F.col("file") == f"filter_decisions_{day}.jsonl").drop("file"), f"{path}/filter_decisions_{day}.jsonl")
    return files.sent_decisions(spark, path, f"filter_decisions_{EDITION}.jsonl").select("link", "label")


@_query("SELECT doc_id, trim(value) AS value FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS value FROM documents) WHERE trim(value) <> ''")
def list_lines(spark, d):
    path = scratch(spark)
    docs = spread(read(spark, d, "documents").select("doc_id", "text"))
    tagged = docs.select(F.explode(F.transform(F.split("text", "\n"), lambda v: F.when(text.stripped(v) == "", v).otherwise(F.concat(F.lit("  "), _text("doc_id"), F.lit("|"), v, F.lit(" "))))).alias("value"))
    tagged.write.text(path)
    value = F.col("value")
    return files.lines(spark, path).select(F.substring_index(value, "|", 1).cast("long").alias("doc_id"), text.stripped(F.expr("substring(value, instr(value, '|') + 1)")).alias("value"))


@_query("SELECT CASE WHEN lang = 'en' THEN '0000-0002-' || lpad(CAST(doc_id % 10000 AS VARCHAR), 4, '0') || '-009X' END AS orcid, 'Jo ' || source || '-' || doc_id AS name FROM documents")
def author_list(spark, d):
    path = scratch(spark)
    number = F.concat(F.lit("0000-0002-"), F.lpad((F.col("doc_id") % 10000).cast("string"), 4, "0"), F.lit("-009X - "))
    read(spark, d, "documents").select(F.concat(F.when(F.col("lang") == "en", number).otherwise("  "), F.lit("Jo "), "source", F.lit("-"), _text("doc_id")).alias("value")).write.text(path)
    return files.listed_authors(spark, path)


@_query("SELECT 'doi:10.1/' || doc_id || lang AS key FROM documents WHERE lang <> 'es'")
def key_list(spark, d):
    path = scratch(spark)
    key = F.concat(F.lit(" DOI:10.1/"), _text("doc_id"), F.upper("lang"), F.lit(" # "), "source")
    read(spark, d, "documents").select(F.when(F.col("lang") == "es", F.concat(F.lit("  # "), key)).otherwise(key).alias("value")).write.text(path)
    return files.listed_keys(spark, path)


@_query("SELECT 'On ' || doc_id AS title, 'On ' || doc_id || ' ' || lang || ' ' || source AS text FROM documents JOIN labels USING (doc_id) WHERE toxic = 1")
def rejected_view(spark, d):
    path = scratch(spark)
    rows = read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id").select(F.concat(F.lit("On "), _text("doc_id")).alias("title"), F.concat(F.lit("*"), "lang", F.lit("*")).alias("abstract"), "source", F.when(F.col("toxic") == 1, "Rejected").otherwise("regular").alias("label"))
    sinks.json_lines(rows, path)
    return files.rejected_documents(spark, path).select("title", "text")


@_query(f"""{_P} SELECT week, p.link, CASE WHEN p.source = 'src1' THEN 'some' WHEN p.source = 'src2' THEN 'more' END AS selected_section, CASE WHEN p.source IN ('src1', 'src2') THEN 'selected' ELSE 'rejected' END AS label,
  CASE p.source WHEN 'src1' THEN 2.0 WHEN 'src2' THEN 1.0 ELSE 0.0 END AS training_weight FROM (SELECT *, '2026-W' || (30 + seq % 3) AS week FROM papers) p JOIN documents ON seq = doc_id WHERE lang <> 'de'""")
def snapshot_decisions(spark, d):
    """Each week's candidates at two commits, the last of which has lost a language."""
    path, out = scratch(spark), scratch(spark)
    rows = papers(spark, d).select("seq", "source", F.concat(F.lit("Paper "), _text("seq")).alias("title"), "link").join(read(spark, d, "documents").select(F.col("doc_id").alias("seq"), "lang"), "seq")
    rows = rows.withColumn("week", F.concat(F.lit("2026-W"), (30 + F.col("seq") % 3).cast("string")))
    commits = rows.withColumn("commit", F.explode(F.when(F.col("lang") == "de", F.array(F.lit("b1"))).otherwise(F.array(F.lit("b1"), F.lit("a2")))))
    chunks = commits.groupBy("week", "commit", F.floor(F.col("seq") / 3000).alias("part")).agg(F.to_json(F.collect_list(F.struct("source", "title", "link"))).alias("value"))
    chunks.drop("part").write.partitionBy("week", "commit").option("maxRecordsPerFile", 1).text(path)
    heads = rows.where("source IN ('src1', 'src2')").select("week", (2 * F.col("seq") + 10).alias("pos"), "source", F.concat(F.lit("#### ["), "title", F.lit("](<"), "link", F.lit(">)")).alias("line"))
    # sections follow each other, so those of one source stand behind those of the other
    far = F.lit(1 << 40)
    lines = heads.select("week", F.when(F.col("source") == "src2", F.col("pos") + far).otherwise(F.col("pos")).alias("pos"), "line")
    for line, at in (("## Some Papers", F.lit(0)), ("## More Papers", far)):
        lines = lines.unionByName(rows.select("week").distinct().select("week", at.cast("long").alias("pos"), F.lit(line).alias("line")))
    snaps = files.snapshots(spark, path).withColumn("commit_no", F.substring("commit", 2, 9).cast("long"))
    sinks.json_lines(pipeline.label_history(snaps, lines).select("week", "link", "selected_section", "label", "training_weight"), out, by="week")
    return spark.read.schema("week string, link string, selected_section string, label string, training_weight double").json(out)


@_query(f"{_P} SELECT seq, title FROM papers JOIN documents ON seq = doc_id WHERE lang = 'en'")
def stage_restart(spark, d):
    path = scratch(spark)
    rows = papers(spark, d).select("seq", "title").join(read(spark, d, "documents").select(F.col("doc_id").alias("seq"), "lang"), "seq")
    sinks.stage(rows.where("lang <> 'en'").drop("lang"), path, "2026-07-27", "feeds")  # of another window
    sinks.stage(rows.drop("lang"), path, "2026-08-03", "feeds")
    sinks.stage(rows.where("lang = 'en'").drop("lang"), path, "2026-08-03", "feeds")  # again, in place of the one before
    sinks.stage(rows.where("lang = 'fr'").drop("lang"), path, "2026-08-03", "archive")
    kept = settle(sinks.restored(spark, path, "2026-08-03", "feeds"))
    sinks.forget(spark, path)
    assert sinks.restored(spark, path, "2026-08-03", "feeds") is None
    return kept


@_query("""SELECT title, score, CAST(rank() OVER (ORDER BY score DESC, title) AS BIGINT) AS place FROM (SELECT source || '/' || lang AS title, round(avg(n_chars), 3) AS score FROM documents GROUP BY ALL)""")
def score_file(spark, d):
    """Scores of groups, by their place in the file."""
    path = scratch(spark)
    rows = read(spark, d, "documents").groupBy(F.concat_ws("/", "source", "lang").alias("title")).agg(F.round(F.avg("n_chars"), 3).alias("score"))
    sinks.scores(rows, path)
    at = F.row_number().over(_in_file_order()).cast("long")
    return spark.read.schema("title string, score double").json(path).select("title", "score", F.struct(F.col("_metadata.file_name").alias("f"), F.monotonically_increasing_id().alias("i")).alias("at")).select("title", "score", at.alias("place"))


def _in_file_order():
    from pyspark.sql import Window

    return Window.orderBy("at")  # a row per group of sources and languages


_ROUTED = f"""{_P}, h AS (SELECT *, CAST(contains(lower(title || ' ' || abstract), 'heed') AS INT) + CAST(contains(lower(title || ' ' || abstract), 'ungß') AS INT) AS hits FROM papers)"""


@_query(f"""{_ROUTED} SELECT link, CASE WHEN source = 'src7' THEN 'featured' WHEN hits > 0 THEN 'regular' ELSE 'rejected' END AS label, CASE WHEN source = 'src7' THEN 'Featured source or author' WHEN hits > 0 THEN 'AI Approved' ELSE 'AI Recall Rejected' END AS classifier_reason,
  CASE WHEN source <> 'src7' THEN 30 + 25 * hits END AS initial_classifier_score, CASE WHEN source <> 'src7' THEN CASE WHEN hits = 0 THEN 'other' WHEN contains(lower(title || ' ' || abstract), 'heed') THEN 'heed' ELSE 'ungß' END END AS initial_classifier_category, CASE WHEN source <> 'src7' AND hits = 0 THEN 30 END AS recall_classifier_score FROM h""")
def decision_audit(spark, d):
    path = scratch(spark)
    p = papers(spark, d).withColumn("local_score", F.lit(1.0))
    out = policy.classify(p, F.col("source") == "src7", policy.keyword_model(("heed", "ungß")), policy.keyword_model(()), settle)
    sinks.json_lines(out.withColumn("label", F.coalesce("category", F.lit("rejected"))).withColumn("classifier_reason", F.col("reason")).drop("abstract"), path)
    return files.json_lines(spark, path, schema.DECISION, strict=True).select("link", "label", "classifier_reason", "initial_classifier_score", "initial_classifier_category", "recall_classifier_score")


@_query(f"{_P} SELECT 'W33' AS week, link, CASE WHEN source = 'src3' THEN 'featured' END AS selected_section, CASE WHEN source = 'src3' THEN 2.0 ELSE 0.0 END AS training_weight FROM papers")
def final_decisions(spark, d):
    path, archived = scratch(spark), scratch(spark)
    p = papers(spark, d).withColumns({"title": F.concat(F.lit("Paper "), _text("seq")), "abstract": F.lit("")})
    line = F.concat(F.lit("#### ["), "title", F.lit("](<"), "link", F.lit(">)"))
    lines = p.where("source = 'src3'").select(F.lit("e").alias("file"), (F.col("seq") + 1).alias("pos"), line.alias("line")).unionByName(spark.createDataFrame([("e", -1, "# Featured Papers")], "file string, pos long, line string"))
    sinks.final_decisions(pipeline.record_final(p, lines, "W33", EDITION), path, archived)
    return spark.read.schema(schema.FINAL_DECISION).json(archived).select("week", "link", "selected_section", "training_weight")


@_query(f"{_P} SELECT link, CASE WHEN ai AND NOT ok THEN 'rejected' ELSE 'regular' END AS label, CASE WHEN ai AND NOT ok THEN 'AI Recall Rejected by Learning Gate' WHEN ai THEN 'AI Recall Approved' ELSE 'AI Approved' END AS reason, CASE WHEN ai AND NOT ok THEN '' ELSE title END AS summary FROM (SELECT *, source = 'src1' OR source = 'src2' AS ai, source = 'src2' AND seq % 10 >= 5 AS ok FROM papers)")
def repaired_rows(spark, d):
    """Frozen rows rewritten in a new version of the table they were read from."""
    path = scratch(spark)
    p = papers(spark, d).select("source", "title", "link", F.lit("").alias("abstract"), ((F.col("seq") % 10) / 100).alias("decision_local_score"), F.lit("regular").alias("decision_label"), F.when(F.col("source").isin("src1", "src2"), "AI Recall Approved").otherwise("AI Approved").alias("decision_classifier_reason"), F.col("title").alias("decision_summary"))
    sinks.swap(p.withColumn("source", F.when(F.col("source") == "src1", "PRL").otherwise(F.col("source"))).withColumn("title", F.lit("Light")), path)
    sinks.swap(pipeline.taken_back(sinks.current(spark, path)), path)
    return sinks.current(spark, path).select("link", "label", "reason", "summary")


@_query("SELECT DISTINCT source AS edition FROM documents WHERE lang = 'de'")
def open_editions(spark, d):
    path = scratch(spark)
    day = F.when(F.col("lang") != "de", F.date_add(_start(), (F.col("doc_id") % 7).cast("int")))
    sinks.sidecars(read(spark, d, "documents").select(_text("doc_id").alias("title"), F.lit("l").alias("link"), "source", day.alias("date"), F.col("source").alias("edition")), path)
    return filters.incomplete_editions(files.edition_sidecars(spark, path))


@_query("SELECT 'deferred' AS status, 'few' AS reason, count(*) AS n, 2 AS warnings FROM documents")
def status_files(spark, d):
    path = scratch(spark)
    spark.createDataFrame([("x",)], "value string").write.text(path)  # makes the folder
    sinks.status(f"{path}/status.json", "deferred", "few", n=read(spark, d, "documents").count())
    sinks.warnings(f"{path}/warnings.json", ["none of A", "none of B"])
    told = spark.read.text(f"{path}/warnings.json", wholetext=True).select(F.size(F.from_json("value", "array<string>"))).first()[0]
    return spark.read.schema("status string, reason string, n long").json(f"{path}/status.json").withColumn("warnings", F.lit(told))


# --- scans and lookups -------------------------------------------------------------------------------------------------------------------


def _scan(spark, requests, folder, **options):
    # stored pages keep nobody waiting, whatever number of them there is
    return web.scan(spark, requests, folder=folder, retries=1, seconds=1 << 30, **options)


def _numbered(spark, d, order, size):
    """Documents by source with their page in it."""
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("source").orderBy(*order)) - 1
    return read(spark, d, "documents").withColumn("day", F.date_sub(_end(), (F.col("doc_id") % 12).cast("int"))).withColumn("cursor", F.floor(nth / size) * size)


def _sources(spark, d):
    return [r[0] for r in read(spark, d, "documents").select("source").where("source IS NOT NULL").distinct().orderBy("source").collect()]  # feeds are a list of settings


_STANDING = f"SELECT doc_id, source, DATE '{EDITION}' - CAST(doc_id % 12 AS INT) AS day FROM documents"


@_query(f"SELECT doc_id, 'On ' || source AS title, 'A. ' || source AS authors, strftime(day, '%Y-%m-%d') AS date FROM ({_STANDING}) WHERE day >= DATE '{EDITION}' - 7")
def archive_scan(spark, d):
    """Pages of an API sorted by date, each read until what is older than the window begins."""
    folder, size = scratch(spark), 20
    s = F.col("source")
    entry = F.concat(F.lit("<entry><title>On\n "), s, F.lit("</title><id>http://arxiv.org/abs/2608."), _text("doc_id"), F.lit("v1</id><link href='http://arxiv.org/abs/2608."), _text("doc_id"), F.lit("v1'/><published>"), _day("day"), F.lit("T10:00:00Z</published><author><name>A. "), s, F.lit("</name></author><summary>Body.</summary></entry>"))
    pages = _numbered(spark, d, (F.desc("day"), "doc_id"), size).groupBy("source", "cursor").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.datediff(_end(), "day").alias("age"), entry.alias("e")))), lambda x: x["e"]), "").alias("all"))
    url = F.replace(F.concat(F.lit(lookups.arxiv_url("SRC", size)), F.lit("")), F.lit("SRC"), s)
    stored = pages.select("source", "cursor", F.concat(F.lit("<feed xmlns='http://www.w3.org/2005/Atom'>"), "all", F.lit("</feed>")).alias("body"))
    stored = stored.unionByName(pages.groupBy("source").agg((F.max("cursor") + size).alias("cursor")).withColumn("body", F.lit("")))  # a blank page ends a feed
    sinks.stored(stored.select(F.replace(url, F.lit("{cursor}"), _text("cursor")).alias("url"), "body"), folder)
    bodies = _scan(spark, [(n, lookups.arxiv_url(n, size)) for n in _sources(spark, d)], folder, pages=1 << 30, pageSize=size).where(F.col("newest") >= _start())
    found = records.arxiv_papers(web.required(bodies), _start().cast("timestamp"), F.lit(_NOW).cast("timestamp"))
    return found.select(F.regexp_extract("link", r"2608\.(\d+)v1$", 1).cast("long").alias("doc_id"), "title", "authors", _day("date").alias("date"))


@_query(f"SELECT doc_id, strftime(day, '%Y-%m-%d') AS date FROM ({_STANDING}) WHERE day >= DATE '{EDITION}' - 7")
def preprint_scan(spark, d):
    """Pages of an API with a cursor, up to the total that they state."""
    folder, size = scratch(spark), 30
    own = F.to_json(F.struct(F.concat(F.lit("10.64898/2026.12.31."), _text("doc_id")).alias("doi"), F.lit("T").alias("title"), F.lit("A").alias("authors"), _day("day").alias("date"), F.lit("1").alias("version"), F.col("source").alias("category"), F.lit("Text.").alias("abstract")))
    rows = _numbered(spark, d, ("doc_id",), size)
    pages = rows.groupBy("source", "cursor").agg(F.count("*").alias("count"), F.array_join(F.collect_list(own), ",").alias("all")).join(rows.groupBy("source").agg(F.count("*").alias("total")), "source")
    body = F.concat(F.lit('{"messages": [{"count": '), _text("count"), F.lit(', "total": "'), _text("total"), F.lit('"}], "collection": ['), "all", F.lit("]}"))
    blank = web.biorxiv_url("2026-08-03", EDITION, "SRC")
    sinks.stored(pages.select(F.replace(F.replace(F.lit(blank), F.lit("SRC"), F.col("source")), F.lit("{cursor}"), _text("cursor")).alias("url"), body.alias("body")), folder)
    found = _scan(spark, [(n, web.biorxiv_url("2026-08-03", EDITION, n)) for n in _sources(spark, d)], folder, pages=1 << 30)
    items = web.required(found).select("name", F.explode(F.from_json("body", f"collection array<struct<{', '.join(c.replace(' ', ':', 1) for c in schema.BIORXIV.split(', '))}>>")["collection"]).alias("i"))
    every = items.select("i.*").withColumn("category", F.lit("all"))
    out = records.biorxiv_papers(every, "all", F.lit(_NOW).cast("date"), _end())
    return out.select(F.regexp_extract("doi", r"\.(\d+)$", 1).cast("long").alias("doc_id"), _day("date").alias("date"))


@_query("SELECT doc_id, lang || ' by ' || source AS title FROM documents")
def backup_scan(spark, d):
    """An API whose pages end early, then a feed that is empty, then one that has entries."""
    folder = scratch(spark)
    docs = read(spark, d, "documents")
    item = F.concat(F.lit("<item><title>"), "lang", F.lit(" by "), "source", F.lit("</title><link>https://x.org/"), _text("doc_id"), F.lit("</link><pubDate>Wed, 05 Aug 2026 10:00:00 GMT</pubDate><dc:creator>Jo</dc:creator><description>" + "Words of it. " * 10 + "</description></item>"))
    parts = _numbered(spark, d, ("doc_id",), 500).withColumn("page", F.floor(F.col("cursor") / 500)).groupBy("source", "page").agg(F.array_join(F.collect_list(item), "").alias("all"))
    url = F.concat(F.lit("rss2/"), "source", F.lit("/"), _text("page"))
    feeds = parts.select(url.alias("url"), F.concat(F.lit("<rss xmlns:dc='d'><channel>"), "all", F.lit("</channel></rss>")).alias("body"))
    feeds = feeds.unionByName(parts.groupBy("source").agg((F.max("page") + 1).alias("page")).select(url.alias("url"), F.lit("").alias("body")))  # a blank page ends a feed
    api = docs.groupBy("source").agg(F.count("*").alias("n")).select(F.concat(F.lit("api/"), "source", F.lit("/0")).alias("url"), F.concat(F.lit('{"count": 1, "total": '), (F.col("n") + 1).cast("string"), F.lit("}")).alias("body"))
    sinks.stored(feeds.unionByName(api), folder)
    names = _sources(spark, d)
    tried = settle(_scan(spark, [(n, f"api/{n}/{{cursor}}") for n in names], folder, pages=2))
    spare = [settle(_scan(spark, [(n, f"{kind}/{n}/{{page}}") for n in names], folder, pages=1 << 30)) for kind in ("rss1", "rss2")]
    # a page that couldn't be read stays, as its feed isn't complete then
    bodies = web.first_complete(tried, *spare, complete=lambda df: web.whole(df, names)).where("body <> ''")
    known = bodies.select("name").distinct().select("name", F.lit("include_all").alias("group"), F.lit("").alias("section"))
    kept, _ = records.feed_papers(bodies.select("name", "body"), known, _start().cast("timestamp"), (), (), strict=True)
    return kept.select(F.regexp_extract("link", r"(\d+)$", 1).cast("long").alias("doc_id"), "title")


@_query("SELECT doi, 'A. ' || source || ', Z' AS authors, CASE WHEN lang <> 'de' THEN lang END AS abstract, '0000-' || source AS orcid FROM (SELECT DISTINCT '10.1/' || source || lang AS doi, source, lang FROM documents) WHERE lang <> 'es'")
def work_lookup(spark, d):
    """Distinct DOIs are asked for once, whatever number of documents has them; one language's aren't known."""
    folder = scratch(spark)
    docs = read(spark, d, "documents").select("source", "lang", F.concat(F.lit("10.1/"), "source", "lang").alias("doi"))
    works = docs.where("lang <> 'es'").distinct()
    person = F.concat(F.lit('{"given": "A.", "family": "'), "source", F.lit('", "ORCID": "0000-'), "source", F.lit('"}, {"given": "", "family": "Z"}, {"given": "B"}'))
    body = F.concat(F.lit('{"message": {"author": ['), person, F.lit("]"), F.when(F.col("lang") != "de", F.concat(F.lit(', "abstract": "<jats:p>'), "lang", F.lit('</jats:p> "'))).otherwise(""), F.lit("}}"))
    sinks.stored(works.select(F.concat(F.lit(lookups.crossref_work_url([""])), F.url_encode("doi")).alias("url"), body.alias("body")), folder)
    found = lookups.answers(docs, "doi", lookups.crossref_work_url, web.file_transport(folder), partitions=4, retries=1)
    known = lookups.work_metadata(found.where("body IS NOT NULL"))
    return known.select(F.col("key").alias("doi"), F.array_join("authors", ", ").alias("authors"), "abstract", F.array_join("orcids", ", ").alias("orcid"))


@_query("SELECT doc_id, CASE WHEN lang = 'en' THEN '2026-08-04' WHEN lang = 'fr' THEN '2026-08-05' END AS date FROM documents")
def date_lookup(spark, d):
    """Dates of preprints by id, from an archive and for what it doesn't know from an index; both answer batches."""
    docs = read(spark, d, "documents").select("doc_id", F.concat(F.lit("2608."), _text("doc_id"), F.substring("lang", 1, 1)).alias("paper"))

    def archive(url):
        ids = url.partition("id_list=")[2].partition("&")[0].split(",")
        return 200, "".join(f"<entry><id>http://arxiv.org/abs/{i}v2</id><published>2026-08-04T01:00:00Z</published></entry>" for i in ids if i.endswith("e")), None

    def index(url):
        return 200, json.dumps([{"externalIds": {"ArXiv": i}, "publicationDate": "2026-08-05"} if i.endswith("f") else None for i in url.split(",")]), None

    # languages en and es share a letter, so the second is told apart by what it is asked as
    docs = docs.join(read(spark, d, "documents").select("doc_id", "lang"), "doc_id").withColumn("paper", F.when(F.col("lang") == "es", F.concat("paper", F.lit("x"))).otherwise(F.col("paper")))
    stages = [
        lambda k: lookups.arxiv_dates(lookups.answers(k, "key", lookups.arxiv_ids_url, archive, batch=25)),
        lambda k: lookups.scholar_dates(lookups.answers(k, "key", ",".join, index, batch=500)).where("key IS NOT NULL"),
    ]
    return lookups.resolved(docs, "paper", "date", stages).select("doc_id", _day("date").alias("date"))


@_query("SELECT doc_id, CASE lang WHEN 'en' THEN '2026-08-05' WHEN 'fr' THEN '2026-08-06' WHEN 'de' THEN '2026-07-01' ELSE '2026-08-08' END AS date FROM documents")
def journal_dates(spark, d):
    """What the page states, what the work's record states, the work found by its title, or the nearest date outside the window."""
    folder = scratch(spark)
    n, lang = _text("doc_id"), F.col("lang")
    link = F.when(lang == "fr", F.concat(F.lit("https://doi.org/10.1000/"), n)).otherwise(F.concat(F.lit("https://x.org/"), n))
    rows = read(spark, d, "documents").select("doc_id", "lang", link.alias("link"), F.concat(F.lit("Wobbling membranes "), n).alias("title"))
    pages = rows.where("lang IN ('en', 'de', 'es')").select(F.col("link").alias("url"), F.concat(F.lit('<meta name="citation_date" content="'), F.when(lang == "en", "2026-08-05").otherwise("2026-07-01"), F.lit('"><p>x')).alias("body"))
    work = lambda day: F.lit(f'"published": {{"date-parts": [[2026, {day}]]}}')
    works = rows.where("lang = 'fr'").select(F.concat(F.lit(lookups.crossref_work_url([""])), F.url_encode(F.concat(F.lit("10.1000/"), _text("doc_id")))).alias("url"), F.concat(F.lit('{"message": {'), work("8, 6"), F.lit("}}")).alias("body"))
    asked = F.replace(F.lit(lookups.crossref_title_url(["TITLE"])), F.lit("TITLE"), F.replace(F.url_encode("title"), F.lit("+"), F.lit("%20")))
    title = F.when(lang == "es", F.col("title")).otherwise("Another work")
    hits = rows.where("lang IN ('de', 'es')").select(asked.alias("url"), F.concat(F.lit('{"message": {"items": [{"title": ["'), title, F.lit('"], '), work("8, 8"), F.lit("}]}}")).alias("body"))
    sinks.stored(pages.unionByName(works).unionByName(hits), folder)
    found = lookups.journal_dates(rows, web.file_transport(folder), _start(), _end(), 4)
    return rows.select("doc_id", "link").join(found, "link").select("doc_id", _day("date").alias("date"))


@_query("SELECT seq, CASE WHEN source = 'src1' THEN 'The abstract has more than six words in it.' ELSE s END AS summary, source <> 'src1' AND c <> '' AS fell_back FROM (SELECT doc_id AS seq, source, c, CASE WHEN c = '' THEN 'Summary unavailable.' WHEN s <> '' THEN trim(s) WHEN length(c) > 360 THEN trim(left(c, 360)) || '…' ELSE c END AS s FROM (SELECT doc_id, source, c, regexp_extract(c, '^(.{40,600}?[.!?])(?:\\s|$)', 1) AS s FROM (SELECT doc_id, source, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS c FROM documents)))")
def summaries(spark, d):
    def model(title, abstract):
        return "The abstract has more than six words in it." if title == "src1" else "Cut off"

    return policy.summarize(papers(spark, d).withColumn("title", F.col("source")), model, 8).select("seq", "summary", "fell_back")


@_query("""WITH q AS (SELECT doc_id, source, CASE source WHEN 'src1' THEN 'unsure' WHEN 'src2' THEN 'FALSE' ELSE 'TRUE' END AS answer, 1e-6 * (1.5 * octet_length(encode(source)) + 7.5 * 2) AS usd FROM documents WHERE source <> 'src7'),
e AS (SELECT 'first' AS pass, count(*) AS requests, sum(usd) AS reported FROM q UNION ALL SELECT 'repair', count(*), sum(usd) FROM q WHERE answer = 'unsure' UNION ALL SELECT 'recall', count(*), sum(usd) FROM q WHERE answer = 'FALSE')
SELECT 'ample' AS run, pass, requests, round(coalesce(reported, 0), 9) AS reported, 0.0 AS unreported FROM e
UNION ALL SELECT 'tight', 'first', count(*) // 10, round(avg(1e-6 * (1.5 * 4 + 15)) * (count(*) // 10), 9), 0.0 FROM documents
UNION ALL SELECT 'tight', p, 0, 0.0, 0.0 FROM (VALUES ('repair'), ('recall')) v(p)""")
def spend_ledger(spark, d):
    """What each pass of a classification asked and spent, with a ceiling that never binds and with one that the first pass uses up."""
    from ..operators.budget import Budget, Ledger

    rows = papers(spark, d).select("seq", "source", F.lit("").alias("abstract"), F.lit(0.0).alias("local_score"))

    def answer(prompt):
        word = {"src1": "unsure", "src2": "FALSE"}.get(prompt, "TRUE")
        return policy.Response(200, word, usage=(len(prompt.encode()), 2, 0))

    n = read(spark, d, "documents").count()
    found = []
    for run, title, ceiling in (("ample", F.col("source"), 1 << 40), ("tight", F.lit("same"), n // 10)):
        ledger = Ledger(spark, Budget(1e9, ceiling))
        model = policy.Metered(answer, lambda title, abstract: title, ledger.budget, 4)
        policy.classify(rows.withColumn("title", title), F.lit(False) if run == "tight" else F.col("source") == "src7", model, model, settle, 4, 3, ledger=ledger)
        found.append(ledger.spent().select(F.lit(run).alias("run"), "pass", "requests", F.round("reported", 9).alias("reported"), "unreported"))
    return found[0].unionByName(found[1])


@_query("SELECT doc_id AS seq, CASE source WHEN 'src1' THEN '' WHEN 'src2' THEN '' WHEN 'src4' THEN '' ELSE 'yes: ' || source END AS raw FROM documents")
def metered_model(spark, d):
    """A service that refuses one source, cuts another's answers off, fails for a third and is busy at first for a fourth."""
    seen: set[str] = set()

    def call(prompt):
        if prompt == "src1":
            return policy.Response(400)
        if prompt == "src4":
            raise OSError("no route")
        if prompt == "src3" and prompt not in seen:
            seen.add(prompt)
            return policy.Response(429, wait=0.0)
        return policy.Response(200, f"yes: {prompt} ", "MAX_TOKENS" if prompt == "src2" else "STOP", (10, 5, 1))

    model = policy.Metered(call, lambda title, abstract: title, policy.Budget(1e9, 1 << 60), 8, retries=2, sleep=lambda s: None)
    return policy.ask(papers(spark, d).withColumn("title", F.col("source")), model, 8).select("seq", "raw")


# --- streams -----------------------------------------------------------------------------------------------------------------------------

_TITLE_KEY = "nullif(regexp_replace(lower(title), '[^\\p{L}\\p{Nd}]', '', 'g'), '')"


@_query(f"""{_P}, t AS (SELECT p.*, lang = 'en' AS early, {_TITLE_KEY} AS tk FROM papers p JOIN documents ON seq = doc_id)
SELECT seq, early, strftime(CASE WHEN doi IS NULL THEN date ELSE least(date, DATE '2026-08-01' + CAST(seq % 12 AS INT)) END, '%Y-%m-%d') AS posted FROM t WHERE early OR ((tk IS NULL OR tk NOT IN (SELECT tk FROM t WHERE early AND tk IS NOT NULL)) AND (doi IS NULL OR lower(doi) NOT IN (SELECT lower(doi) FROM t WHERE early AND doi IS NOT NULL)))""")
def edition_stream(spark, d):
    """Two batches, the second of which runs twice: what the first sent isn't sent again, and nothing is lost or doubled by the repeat."""
    from ..streaming.editions import edition_writer, event_time

    state, out = scratch(spark), scratch(spark)
    rows = event_time(papers(spark, d).drop("abstract")).join(read(spark, d, "documents").select(F.col("doc_id").alias("seq"), (F.col("lang") == "en").alias("early")), "seq")
    write = edition_writer(state, out, F.lit(EDITION))
    for batch, which in ((0, "early"), (1, "NOT early"), (1, "NOT early")):
        write(rows.where(which), batch)
    return spark.read.parquet(out).select("seq", "early", _day("published").alias("posted"))


@_query(f"""{_P}, t AS (SELECT p.*, lang = 'en' AS early, {_TITLE_KEY} AS tk FROM papers p JOIN documents ON seq = doc_id)
SELECT seq, early, strftime(CASE WHEN doi IS NULL THEN date ELSE least(date, DATE '2026-08-01' + CAST(seq % 12 AS INT)) END, '%Y-%m-%d') AS posted FROM t WHERE early OR ((tk IS NULL OR tk NOT IN (SELECT tk FROM t WHERE early AND tk IS NOT NULL)) AND (doi IS NULL OR lower(doi) NOT IN (SELECT lower(doi) FROM t WHERE early AND doi IS NOT NULL)))""")
def keyed_edition_stream(spark, d):
    """The same editions by a running stream, stopped and started again between its two batches, with what was sent as state by identity key."""
    from ..streaming.editions import event_time, keyed_editions

    source, out, checkpoint = scratch(spark), scratch(spark), scratch(spark)
    rows = papers(spark, d).drop("abstract").join(read(spark, d, "documents").select(F.col("doc_id").alias("seq"), (F.col("lang") == "en").alias("early")), "seq")
    for which in ("early", "NOT early"):
        rows.where(which).write.mode("append").parquet(source)
        asked = event_time(spark.readStream.schema(rows.schema).parquet(source))
        keyed_editions(asked, out, F.lit(EDITION), checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select("seq", "early", _day("published").alias("posted"))


@_query("SELECT doc_id, lang FROM documents WHERE doc_id >= 0")
def preprint_stream(spark, d):
    """An API with a cursor as a stream: half of its records are there at the first trigger, the rest at the second, and no page is read twice."""
    folder, out, checkpoint, feeds, size = scratch(spark), scratch(spark), scratch(spark), 8, 25
    docs = read(spark, d, "documents").where("doc_id >= 0").select("doc_id", "lang", F.concat(F.lit("f"), (F.col("doc_id") % feeds).cast("string")).alias("feed"), F.floor(F.col("doc_id") / (feeds * size)).alias("page"))
    last = docs.agg(F.coalesce(F.max("page"), F.lit(0))).first()[0]
    every = spark.range(last + 1).select(F.col("id").alias("page")).join(spark.range(feeds).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("feed")))
    items = docs.groupBy("feed", "page").agg(F.array_join(F.collect_list(F.to_json(F.struct("doc_id", "lang"))), ",").alias("items"))
    pages = every.join(items, ["feed", "page"], "left").withColumn("url", F.concat(F.lit("api/"), "feed", F.lit("?c="), (F.col("page") * size).cast("string")))
    asked = [(f"f{k}", f"api/f{k}?c={{cursor}}") for k in range(feeds)]
    half = (last + 1) // 2
    for since, until in ((0, half), (half, last + 1)):
        body = F.concat(F.lit(f'{{"messages": [{{"count": {size}, "total": {until * size}}}], "collection": ['), F.coalesce("items", F.lit("")), F.lit("]}"))
        sinks.stored(pages.where((F.col("page") >= since) & (F.col("page") < until)).select("url", body.alias("body")), folder)
        rows = web.stream(spark, asked, folder=folder, retries=1, offsets=f"{checkpoint}-offsets.json").select("url", F.explode(F.from_json("body", "collection array<struct<doc_id:bigint,lang:string>>")["collection"]).alias("i"))
        rows.select("url", "i.*").writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema("url string, doc_id long, lang string").parquet(out).select("doc_id", "lang")


@_query(f"{_P} SELECT link, title, doi, strftime(date, '%Y-%m-%dT00:00:00+00:00') AS date, seq < 100 AS early FROM papers")
def candidate_papers_file(spark, d):
    """All candidates in one file that holds one array, put together from what many tasks wrote, and read again."""
    path = f"{scratch(spark)}/papers.json"
    rows = papers(spark, d).drop("abstract").withColumns({"date": F.col("date").cast("timestamp"), "early": F.col("seq") < 100})
    sinks.candidate_file(rows.repartition(16), path)
    return files.json_array(spark, path, schema.PAPER_JSON + ", early boolean").select("link", "title", "doi", "date", "early")


_CHUNK = "source || '-' || CAST(doc_id // 100 AS VARCHAR)"


@_query(f"SELECT {_CHUNK} AS edition, 'Paper ' || doc_id AS title, 'https://example.org/' || doc_id AS link, lang AS source FROM documents")
def sidecar_arrays(spark, d):
    """A sidecar with one array for each edition."""
    folder = scratch(spark)
    edition = F.concat("source", F.lit("-"), F.floor(F.col("doc_id") / 100).cast("string"))
    rows = read(spark, d, "documents").select(edition.alias("edition"), F.col("doc_id").alias("pos"), F.concat(F.lit("Paper "), _text("doc_id")).alias("title"), F.concat(F.lit("https://example.org/"), _text("doc_id")).alias("link"), F.col("lang").alias("source"), F.lit(None).cast("date").alias("date"))
    sinks.sidecar_files(rows.where("edition IS NOT NULL"), folder)
    return files.sidecars(spark, folder).select("edition", "title", "link", "source")


def _editions(spark, d):
    """Editions of at most 100 documents as markdown files: (file, text)."""
    n = _text("doc_id")
    entry = F.concat(F.lit("#### [Paper "), n, F.lit("](<https://example.org/"), n, F.lit(">)\n::: {.x}\n"), "source", F.lit(" in *"), "lang", F.lit("*\n"))
    docs = read(spark, d, "documents").where("source IS NOT NULL AND lang IS NOT NULL").withColumn("file", F.concat("source", F.lit("-"), F.floor(F.col("doc_id") / 100).cast("string"), F.lit(".qmd")))
    return docs.groupBy("file").agg(F.concat(F.lit("---\ntitle: x\n---\n## Some Papers\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", entry.alias("e")))), lambda x: x["e"]), "")).alias("text"))


@_query(f"SELECT {_CHUNK} || '.qmd' AS file, 'https://example.org/' || doc_id AS url, 'some' AS section, 'Paper ' || doc_id || ' ' || source || ' in ' || lang AS text FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL")
def archive_folder(spark, d):
    """All editions of a folder, read line by line and in parts, as training documents."""
    from ..operators import archive

    folder = scratch(spark)
    sinks.whole_files(_editions(spark, d).withColumnRenamed("file", "name"), folder)
    return archive.entries(files.archive_lines(spark, folder)).select("file", "url", "section", "text")


@_query(f"SELECT {_CHUNK} || '.qmd' AS file, 'Paper ' || doc_id AS title, 'https://example.org/' || doc_id AS link FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL")
def archive_titles(spark, d):
    """Titles and links alone, by the second reading of an edition, whose files are read whole."""
    from ..operators import archive

    folder = scratch(spark)
    sinks.whole_files(_editions(spark, d).withColumnRenamed("file", "name"), folder)
    return archive.titles_and_links(archive.lines_of(files.archive_files(spark, folder))).select("file", "title", "link")


# --- functions ---------------------------------------------------------------------------------------------------------------------------


@_query("SELECT doc_id, '<' || source || '> & \"' || lang || '\"' AS decoded, lang || '  ' || source AS paper_text, CASE lang WHEN 'en' THEN 2.0 WHEN 'fr' THEN 2.0 WHEN 'de' THEN 1.0 ELSE 0.0 END AS weight, CASE lang WHEN 'en' THEN 2.0 WHEN 'fr' THEN 2.0 ELSE 1.0 END AS training, '10.1101/2026.08.03.' || doc_id || 'v2' AS doi, source || ' is new' AS body, source AS field, '' AS known FROM documents")
def small_texts(spark, d):
    c = F.col("lang")
    section = F.when(c == "en", "featured").when(c == "fr", "some").when(c == "de", "more").otherwise("else")
    nature = F.concat(F.lit(" Nature Physics, Published online: 05 August 2026; doi:10.1038/x1\n"), "source", F.lit(" is new "))
    return read(spark, d, "documents").select(
        "doc_id",
        text.decode_xml(F.concat(F.lit("&lt;"), "source", F.lit("&gt; &amp; &quot;"), "lang", F.lit("&quot;"))).alias("decoded"),
        text.paper_text(c, F.lit("NULL "), F.col("source")).alias("paper_text"),
        text.section_weight(section).alias("weight"),
        text.section_weight(section, 1.0).alias("training"),
        keys.preprint_doi(F.concat(F.lit("https://www.biorxiv.org/content/10.1101/2026.08.03."), _text("doc_id"), F.lit("v2?rss=1"))).alias("doi"),
        text.drop_boilerplate(nature, "Nature").alias("body"),
        text.field(F.concat(F.lit(" "), "source", F.lit(" "))).alias("field"),
        text.known(F.lit("nothing")).alias("known"),
    )


@_query("SELECT doc_id, 'Vesicles of ' || source || ' bend, and so do ' || lang || '.' AS physics, 'https://cdn.org/' || doc_id || '.png' AS image, 'Jo ' || source AS authors, 'Cells of ' || lang || ' move fast.' AS chemistry, 'https://pubs.rsc.org/ImageService/image/GA?id=' || doc_id AS graphic FROM documents")
def publisher_abstracts(spark, d):
    n = _text("doc_id")
    aps = F.concat(F.lit("<p>Vesicles of "), "source", F.lit(" bend,</p><img src='//cdn.org/"), n, F.lit(".png'><p>and so do <b>"), "lang", F.lit("</b>. [Phys. Rev. E 1, 2] Published</p>"))
    rsc = F.concat(F.lit("<div><b>Soft Matter</b>, 2026</div><div><img src='http://pubs.rsc.org/ImageService/image/GA?id="), n, F.lit("'/><img src='x.gif'></div><div>Jo "), "source", F.lit("<br/>Cells of <i>"), "lang", F.lit("</i> move fast.<br/>The content of this RSS Feed (c)</div>"))
    found = spread(read(spark, d, "documents")).select("doc_id", html.clean_physics_abstract(aps).alias("p"), html.clean_chemistry_abstract(rsc).alias("c"))
    return found.select("doc_id", F.col("p.abstract").alias("physics"), F.get("p.images", F.lit(0)).alias("image"), "c.authors", F.col("c.abstract").alias("chemistry"), F.get("c.images", F.lit(0)).alias("graphic"))
