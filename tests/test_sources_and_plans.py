import json
import re
import time
from datetime import date, datetime

import pytest
from folioscope import schema
from folioscope.config import Settings
from folioscope.operators import policy, quality
from folioscope.plans import pipeline
from folioscope.sinks import files as sinks
from folioscope.sources import files, records, web
from folioscope.streaming import editions
from pyspark.sql import functions as F

DAY = "2026-08-10"


def day():
    return F.lit(DAY).cast("date")


ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Cells &amp; forces</title><link href="https://x.org/1"/><published>2026-08-05T01:02:03Z</published>
<author><name>jo@x.org (Jo Doe)</name></author><author><name>Jo Doe</name></author><category term="Biophysics"/><summary>&lt;p&gt;%s&lt;/p&gt;</summary></entry></feed>""" % ("An abstract of enough words. " * 5)
RSS = """<rss xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:prism="http://p"><channel><item><title>Light & matter</title><link>https://doi.org/10.1000/abc</link><pubDate>Wed, 05 Aug 2026 10:00:00 GMT</pubDate>
<dc:creator>A. One</dc:creator><description>%s</description></item><item><title>Old</title><link>l</link><pubDate>Wed, 05 Aug 2020 10:00:00 GMT</pubDate></item>
<item><title>Review of all</title><pubDate>Wed, 05 Aug 2026 10:00:00 GMT</pubDate></item><item><title>No authors</title><link>z</link><pubDate>Wed, 05 Aug 2026 10:00:00 GMT</pubDate><description>%s</description></item></channel></rss>""" % ("Body text is long. " * 8, "Body text is long. " * 8)


def test_web_source_and_feeds(spark, tmp_path):
    for url, body in (("u:atom", ATOM), ("u:rss", RSS), ("u:bad", "<rss")):
        (tmp_path / web.stored_name(url)).write_text(body)
    spark.dataSource.register(web.WebSource)
    requests = json.dumps([{"name": n, "url": u} for n, u in (("Atom", "u:atom"), ("Rss", "u:rss"), ("Bad", "u:bad"), ("Gone", "u:none"))])
    bodies = spark.read.format("web").option("requests", requests).option("folder", str(tmp_path)).load()
    got = {r.name: (r.status, r.error) for r in bodies.collect()}
    assert got == {"Atom": (200, None), "Rss": (200, None), "Bad": (200, None), "Gone": (404, "HTTP 404")}
    feeds = spark.createDataFrame([("Atom", "section_filter", "biophysics"), ("Rss", "include_all", None), ("Bad", "include_all", None)], "name string, group string, section string")
    kept, removed = records.feed_papers(bodies.where("status = 200"), feeds, F.lit("2026-08-03").cast("date"), (), ())
    rows = {r.title: r for r in kept.collect()}
    assert set(rows) == {"Cells & forces", "Light & matter"}
    assert rows["Cells & forces"].authors == "Jo Doe" and rows["Cells & forces"].abstract.startswith("An abstract of enough words.")
    assert rows["Light & matter"].doi == "10.1000/abc" and rows["Light & matter"].date == datetime(2026, 8, 5, 10)
    assert [r.defect for r in removed.collect()] == ["no authors"]


def test_pages_and_retries(spark, tmp_path):
    for page in range(3):
        (tmp_path / web.stored_name(f"u?c={page * 2}")).write_text("x" if page < 2 else " ")
    spark.dataSource.register(web.WebSource)
    df = spark.read.format("web").options(requests=json.dumps([{"name": "a", "url": "u?c={cursor}"}]), folder=str(tmp_path), pages="9", pageSize="2").load()
    assert [r.page for r in df.orderBy("page").collect()] == [0, 1, 2]
    answers, waits = [(429, "", 7.0), (500, "", None), (200, "ok", None)], []
    assert web.fetch(lambda u: answers.pop(0), "u", 3, 20, waits.append) == (200, "ok", None) and waits == [7.0, 6.0]
    assert web.fetch(lambda u: (404, "", None), "u", 3, 20, waits.append)[2] == "HTTP 404" and web.backoff(9) == 20
    assert web.biorxiv_url("2026-08-03", DAY, "cell biology", 0).endswith("/2026-08-03/2026-08-10/0/json?category=cell%20biology")


def test_europepmc(spark):
    good = {"id": "42568184", "source": "MED", "doi": "10.1016/J.bpj.2026.08.002", "title": "A <i>t</i>", "firstPublicationDate": "2026-08-08", "abstractText": "word " * 30, "pubTypeList": {"pubType": ["Journal Article"]}, "authorList": {"author": [{"fullName": "A B"}, {"fullName": ""}]}}
    editorial = {"id": "e", "title": "E", "firstPublicationDate": "2026-08-08", "pubTypeList": {"pubType": ["Editorial"]}}
    make = lambda rows: spark.createDataFrame([json.dumps(r) for r in rows], "string").select(F.from_json("value", schema.EUROPEPMC).alias("r")).select("r.*")
    rows = records.europepmc_papers(make([good, editorial]), "Biophysical Journal", F.lit("2026-08-03").cast("date")).collect()
    assert [(r.title, r.authors, r.link, r.doi) for r in rows] == [("A t", "A B", "https://doi.org/10.1016/j.bpj.2026.08.002", "10.1016/j.bpj.2026.08.002")]
    with pytest.raises(Exception, match="missing abstract"):
        records.europepmc_papers(make([good | {"abstractText": ""}]), "J", F.lit("2026-08-03").cast("date")).collect()
    with pytest.raises(ValueError, match="only 1 of 2"):
        records.require_complete(make([good]), F.lit(2), F.lit(1))
    result = lambda n, *rows: json.dumps({"hitCount": n, "resultList": {"result": list(rows)}})
    bodies = lambda *b: spark.createDataFrame([(x,) for x in b], "body string")
    assert [r.id for r in records.europepmc_items(bodies(result(1, good), result(2, good | {"id": "2"}, editorial))).orderBy("id").collect()] == ["2", "42568184", "e"]
    for broken, why in ((bodies(result(1, good), result(3, good, editorial)), "only 2 of 3"), (bodies(result(1, good), result(0)), "no records"), (bodies("<html>"), "no records"), (bodies(), "no records")):
        with pytest.raises(ValueError, match=why):
            records.europepmc_items(broken)


def test_crossref_and_biorxiv(spark):
    item = {"DOI": "10.1/X", "title": ["A\nB"], "author": [{"given": "A", "family": "B"}, {"family": "C"}, {"given": "only"}], "published": {"date-parts": [[2027]]}, "created": {"date-parts": [[2026, 8, 5]]}, "issued": {"date-parts": [[2026, 13, 1]]}}
    df = spark.createDataFrame([json.dumps(item), json.dumps({"URL": "u", "created": {"date-parts": [[2026, 8]]}})], "string").select(F.from_json("value", schema.CROSSREF).alias("r")).select("r.*")
    rows = records.crossref_papers(df, "CrossRef/Featured", day(), day(), 20).collect()
    assert [(r.title, r.authors, r.link, r.doi, r.abstract[:8]) for r in rows] == [("A B", "A B, C", "https://doi.org/10.1/X", "https://doi.org/10.1/X", "Abstract"), ("No Title", "Unknown", "u", None, "Abstract")]
    pre = spark.createDataFrame([("10.1101/2026.08.04.1", "T", "A", "2026-08-06", "2", "Biophysics", "Abs Graphical Abstract x"), ("10.1101/2020.01.01.1", "Old", "A", "2026-08-06", "2", "biophysics", "a"), ("10.1101/1", "O", "A", "2026-08-06", "1", "zoology", "a")], schema.BIORXIV)
    rows = records.biorxiv_papers(pre, "biophysics", day(), day()).collect()
    assert [(r.title, r.link, r.abstract, r.date.date()) for r in rows] == [("T", "https://www.biorxiv.org/content/10.1101/2026.08.04.1v2", "Abs", date(2026, 8, 4))]


def test_listing(spark):
    body = "\n".join(["<h3>Wed, 5 Aug 2026 (showing 2 of 2 entries )</h3>", "arXiv:2608.00001", "<div><span class='descriptor'>Title:</span> A title", "goes on</div>", "<div class='list-authors'><a>A One (1)</a>, <a>B Two</a></div>", *["-"] * 25, "<h3>Mon, 3 Jan 2022 (showing 1)</h3>", "arXiv:2201.00001", "<span class='descriptor'>Title:</span> Old</div>"])
    got = records.listing_papers(spark.createDataFrame([("c", body)], "name string, body string"), F.lit("2026-08-03").cast("date")).collect()
    assert [(r.paper_id, r.title, r.authors, r.date.date()) for r in got] == [("2608.00001", "A title goes on", "A One, B Two", date(2026, 8, 5))]


def test_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("0000-0001-2345-678X - A B\n\n  C D  \n")
    assert [(r.orcid, r.name) for r in files.listed_authors(spark, str(tmp_path / "a.txt")).collect()] == [("0000-0001-2345-678X", "A B"), (None, "C D")]
    (tmp_path / "k.txt").write_text("DOI:10.1/X # why\n# only\n\n")
    assert [r.key for r in files.listed_keys(spark, str(tmp_path / "k.txt")).collect()] == ["doi:10.1/x"]
    folder = tmp_path / "d"
    folder.mkdir()
    (folder / "filter_decisions_2026-08-03.jsonl").write_text('{"label": "Regular", "title": "t"}\n{bad\n{"label": "rejected", "title": "r"}\n')
    (folder / "filter_decisions_2026-08-10.jsonl").write_text('{"label": "regular", "title": "now"}\n')
    assert [r.title for r in files.sent_decisions(spark, str(folder), "filter_decisions_2026-08-10.jsonl").collect()] == ["t"]
    assert [r.title for r in files.rejected_documents(spark, str(folder)).collect()] == ["r"]
    with pytest.raises(Exception, match="(?i)malformed|corrupt|failfast"):
        files.json_lines(spark, str(folder), schema.DECISION, strict=True).collect()
    (tmp_path / "votes.json").write_text(json.dumps({"papers": [{"title": "x", "upvotes": 3, "downvotes": 0}]}))
    assert files.feedback(spark, str(tmp_path / "votes.json")).first().upvotes == 3


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "s", 0.5), (2, "t", 0.7)], "seq long, title string, score double")
    sinks.stage(rows, str(tmp_path / "stages"), "2026-08-03", "rss")
    sinks.stage(rows.where("seq = 1"), str(tmp_path / "stages"), "2026-08-03", "arxiv")
    assert sinks.restored(spark, str(tmp_path / "stages"), "2026-08-03", "rss").count() == 2
    sinks.stage(rows.limit(0), str(tmp_path / "stages"), "2026-08-03", "empty")  # a stage that rightly has no rows is done
    assert sinks.restored(spark, str(tmp_path / "stages"), "2026-08-03", "empty").count() == 0
    assert sinks.restored(spark, str(tmp_path / "stages"), "2026-07-27", "rss") is None and sinks.restored(spark, str(tmp_path / "none"), "x", "y") is None
    sinks.swap(rows, str(tmp_path / "table"))
    sinks.swap(sinks.current(spark, str(tmp_path / "table")).where("seq = 2"), str(tmp_path / "table"))
    assert [r.seq for r in sinks.current(spark, str(tmp_path / "table")).collect()] == [2]
    sinks.status(str(tmp_path / "s.json"), "ok", cost=1.5)
    assert json.loads((tmp_path / "s.json").read_text()) == {"status": "ok", "reason": "", "cost": 1.5}
    sinks.scores(rows, str(tmp_path / "scores"))
    assert [r.score for r in spark.read.json(str(tmp_path / "scores")).collect()] == [0.7, 0.5]


def candidates(spark, n=60):
    rows = [(i, "arXiv" if i % 2 else "Nature", f"Cells and forces {i}", "A. One, B. Two", f"https://x.org/{i}", "cells move under force " * 6 + "again.", "2026-08-05T00:00:00+00:00", None) for i in range(n)]
    return spark.createDataFrame(rows, "seq long, source string, title string, authors string, link string, abstract string, date string, doi string")


def test_curate_then_repair_and_record(spark):
    papers = candidates(spark)
    scores = spark.createDataFrame([(f"link:https://x.org/{i}", i / 100) for i in range(60)], "key string, score double")
    model = policy.keyword_model(("cells", "force"))
    items, decisions = pipeline.curate(papers, scores, F.col("seq") == 7, day(), model, model, lambda f: f.persist())
    listed = items.orderBy("place").collect()
    assert [r.seq for r in listed[:3]] == [7, 58, 59] or [r.seq for r in listed[:2]] == [7, 59]
    assert items.count() == 60 and {r.label for r in decisions.collect()} == {"featured", "regular"}
    frozen = decisions.select("link", "label", "classifier_reason", "local_score", "summary")
    again = pipeline.repair(papers, frozen, day())
    assert [r.seq for r in again.orderBy("place").collect()] == [r.seq for r in listed]
    document = "\n".join(f"#### [{r.title}](<{r.link}>)\n{r.summary}" for r in listed)
    assert pipeline.validate(papers, frozen, document, day()).count() == 0
    assert pipeline.validate(papers, frozen, document.replace("https://x.org/59>", "x"), day()).count() == 1
    as_lines = lambda d: spark.createDataFrame(list(enumerate(d.split("\n"))), "pos long, line string")
    assert pipeline.validate(papers, frozen, as_lines(document), day()).count() == 0
    for broken in (document.replace("https://x.org/59>", "x"), document.replace("#### ", "### ", 1), document.replace(listed[0].summary, "Changed.", 1)):
        both = [sorted(r.issue for r in pipeline.validate(papers, frozen, d, day()).collect()) for d in (broken, as_lines(broken))]
        assert both[0] == both[1]
    lines = spark.createDataFrame([("e", k, t) for k, t in enumerate(["# Featured Papers", "#### [x](<https://x.org/7>)", "## More Papers", "#### [Cells and forces 9](<y>)"])], "file string, pos int, line string")
    final = {r.title: (r.selected_section, r.training_weight) for r in pipeline.record_final(papers, lines, "2026-08-03", DAY).collect()}
    assert final["Cells and forces 7"] == ("featured", 2.0) and final["Cells and forces 9"] == ("more", 1.0) and final["Cells and forces 1"] == (None, 0.0)
    with pytest.raises(quality.EditionRejected, match="minimum is 50"):
        pipeline.curate(candidates(spark, 40), scores, F.lit(False), day(), model, model, lambda f: f.persist())


def test_score_ignores_rejections_and_history(spark):
    papers = candidates(spark, 3)
    training = spark.createDataFrame([("cells under force", 2.0)], "text string, weight double")
    votes = spark.createDataFrame([("docking", "", "", "", 0, 1)], "title string, summary string, source string, link string, upvotes long, downvotes long")
    got = {r.key: r.score for r in pipeline.score(papers, training, votes).collect()}
    assert len(got) == 3 and all(v > 0 for v in got.values())
    rows = [("w1", "c1", 1, 0, "A", "https://a", ""), ("w1", "c2", 2, 1, "B", "https://b", ""), ("w1", "c2", 2, 2, "C", "https://c", "")]
    snaps = spark.createDataFrame(rows, "week string, commit string, commit_no int, seq long, title string, link string, doi string")
    lines = spark.createDataFrame([("w1", 0, "## Some Papers"), ("w1", 1, "#### [B](<https://b/>)")], "week string, pos int, line string")
    out = {r.title: (r.label, r.training_weight) for r in pipeline.label_history(snaps, lines).collect()}
    assert out == {"B": ("selected", 2.0), "C": ("rejected", 0.0)}


def test_backfill(spark):
    entries = spark.createDataFrame([("Saved", "https://a"), ("Old", "https://b"), ("Pre", "https://www.biorxiv.org/content/10.1101/2026.08.04.1v1"), ("Arx", "https://arxiv.org/abs/2608.1v2"), ("Page", "https://www.nature.com/x"), ("None", "https://c")], "title string, link string")
    saved = spark.createDataFrame([("https://a", "", 0, "Src", "2026-08-01")], "link string, title string, pos int, source string, date string")
    history = spark.createDataFrame([("", "Old", 0, "2026-08-02")], "link string, title string, pos int, date string")
    arxiv = spark.createDataFrame([("2608.1", "2026-08-03")], "arxiv_id string, date string")
    pages = spark.createDataFrame([("https://www.nature.com/x", '<meta name="dc.date" content="2026-07-01"><meta name="citation_date" content="2026/8/6">')], "link string, html string")
    got = {r.title: (r.source, str(r.date)) for r in pipeline.backfill(entries, saved, history, arxiv, pages, F.date_sub(day(), 7), day()).collect()}
    assert got == {"Saved": ("Src", "2026-08-01"), "Old": ("b", "2026-08-02"), "Pre": ("bioRxiv", "2026-08-04"), "Arx": ("arXiv", "2026-08-03"), "Page": ("nature.com", "2026-08-06"), "None": ("c", "None")}


def test_settings():
    s = Settings.read({"MIN_ABSTRACT_CHARS": "100", "MAX_COST_USD": "x", "WINDOW_END_DATE": DAY})
    assert (s.min_abstract_chars, s.max_cost_usd, s.window_end_date) == (100, 5.0, date(2026, 8, 10))
    with pytest.raises(ValueError, match="YYYY"):
        Settings.read({"EDITION_ID": "soon"})


def test_stream_sends_each_publication_once(spark, tmp_path):
    source, state, out = (str(tmp_path / n) for n in ("in", "state", "out"))
    fields = "seq long, title string, link string, doi string, date timestamp"
    write = editions.edition_writer(state, out, F.date_format("date", "yyyy-MM-dd"))

    def go(rows):
        spark.createDataFrame(rows, fields).write.mode("append").parquet(source)
        q = spark.readStream.schema(fields).parquet(source).writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)

    when = datetime(2026, 8, 5)
    go([(1, "One", "l1", None, when), (2, "Two", "l2", "10.1/a", when)])
    time.sleep(0.1)
    go([(3, "ONE!", "l3", None, when), (4, "Three", "l4", "doi:10.1/A", when), (5, "Five", "l5", None, when)])
    assert sorted(r.seq for r in spark.read.parquet(out).collect()) == [1, 2, 5]
    write(spark.createDataFrame([(3, "ONE!", "l3", None, when), (5, "Five", "l5", None, when)], fields), 1)
    assert sorted(r.seq for r in spark.read.parquet(out).collect()) == [1, 2, 5]


def test_weekly_windows_share_their_monday(spark):
    rows = spark.createDataFrame([(datetime(2026, 8, 3, 5),), (datetime(2026, 8, 4),), (datetime(2026, 8, 10),)], "ts timestamp")
    got = {r.start.date(): r.n for r in editions.weekly_windows(rows, "ts").collect()}
    assert got == {date(2026, 7, 27): 1, date(2026, 8, 3): 3, date(2026, 8, 10): 1}


def _stored(folder, urls):
    for url, body in urls.items():
        (folder / web.stored_name(url)).write_text(body)


def _entries(*days):
    return "<feed>" + "".join(f"<entry><published>{d}T01:00:00Z</published></entry>" for d in days) + "</feed>"


def test_filters_are_pushed_into_a_scan(spark, tmp_path):
    _stored(tmp_path, {f"{n}?c={10 * k}": _entries(*days) for n in "abc" for k, days in enumerate([["2026-08-09", "2026-08-08"], ["2026-08-04", "2026-07-30"], ["2026-07-20"]])})
    df = web.scan(spark, [(n, n + "?c={cursor}") for n in "abc"], folder=tmp_path, pages=9, pageSize=10, retries=1)
    assert df.rdd.getNumPartitions() == 3 and df.where("page = 3 AND status = 404").count() == 3  # without a bound, until there is no page
    late = df.where((F.col("newest") >= F.lit("2026-08-01").cast("date")) & F.col("name").isin("a", "c") & (F.col("page") >= 0))
    assert late.rdd.getNumPartitions() == 2
    plan = late._jdf.queryExecution().executedPlan().toString()
    left = [x for x in plan.splitlines() if "Filter" in x and "Scan" not in x]
    assert len(left) == 1 and "page#" in left[0] and not re.search(r"newest#\d+ >|name#", left[0]), plan  # what isn't pushed is Spark's
    assert sorted((r.name, r.page, str(r.newest)) for r in late.collect()) == [(n, k, d) for n in "ac" for k, d in ((0, "2026-08-09"), (1, "2026-08-04"))]
    # a page that couldn't be read may hold anything, so it passes a bound and tells
    gone = web.scan(spark, [("x", "none")], folder=tmp_path, retries=1).where("newest > DATE '2026-08-01' AND name = 'x'")
    assert [r.error for r in gone.collect()] == ["HTTP 404"] and gone.where("name = 'y'").count() == 0
    # of a scan that isn't sorted, all pages are read
    every = web.scan(spark, [("a", "a?c={cursor}")], folder=tmp_path, pages=3, pageSize=10, retries=1, sorted="false").where("newest >= DATE '2026-08-01'")
    assert sorted(r.page for r in every.collect() if not r.error) == [0, 1]


def test_what_could_be_pushed():
    from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThan

    reader = web.PushedReader({"requests": '[{"name": "a", "url": "u"}, {"name": "b", "url": "v"}]'})
    rest = [LessThan(("newest",), date(2026, 1, 1)), EqualTo(("page",), 1), GreaterThan(("newest",), "2026")]
    assert list(reader.pushFilters([GreaterThan(("newest",), date(2026, 1, 31)), GreaterThanOrEqual(("newest",), date(2026, 1, 1)), In(("name",), ("a", "b")), EqualTo(("name",), "b"), *rest])) == rest
    assert reader.least == date(2026, 2, 1) and [p.name for p in reader.partitions()] == ["b"]


def test_dates_that_pages_state():
    body = '<published>2026-08-09T1</published><dc:date>2026-08-01</dc:date><pubDate>Mon</pubDate>{"date": "2026-07-01", "date":"2026-13-01"}'
    assert web.stated_dates(body) == [date(2026, 8, 9), date(2026, 8, 1), date(2026, 7, 1)]


def _run(frame, out, checkpoint):
    query = frame.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    query.awaitTermination(120)
    assert query.exception() is None


def test_a_stream_goes_on_behind_what_it_read(spark, tmp_path):
    folder, asked = tmp_path / "web", []
    folder.mkdir()
    page = lambda ids, total: json.dumps({"messages": [{"count": len(ids), "total": total}], "collection": ids})
    urls = [("p", "p?c={cursor}"), ("q", "q?c={cursor}"), ("feed", "feed")]

    def trigger():
        df = web.stream(spark, urls, folder=folder, retries=1, offsets=tmp_path / "offsets.json")
        _run(df.select("name", "url", "body"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        rows = sorted((r.name, r.url) for r in spark.read.parquet(str(tmp_path / "out")).collect())
        new = [r for r in rows if r not in asked or rows.count(r) > asked.count(r)]
        asked[:] = rows
        return sorted(set(new)) if "feed" not in dict(new) else new

    _stored(folder, {"p?c=0": page([1, 2], 3), "p?c=2": page([3], 3), "feed": _entries("2026-08-09")})
    assert set(trigger()) == {("p", "p?c=0"), ("p", "p?c=2"), ("feed", "feed")} and len(asked) == 3
    # a reader that starts again asks for nothing that was read: those pages are gone
    (folder / web.stored_name("p?c=0")).unlink()
    _stored(folder, {"p?c=3": page([4, 5], 5), "q?c=0": page([7], 1)})
    trigger()
    assert [a for a in asked if a[0] != "feed"] == [("p", "p?c=0"), ("p", "p?c=2"), ("p", "p?c=3"), ("q", "q?c=0")]
    assert asked.count(("feed", "feed")) == 2
    trigger()
    assert [a for a in asked if a[0] != "feed"] == [("p", "p?c=0"), ("p", "p?c=2"), ("p", "p?c=3"), ("q", "q?c=0")] and len(asked) == 7


def test_one_file_from_many_tasks(spark, tmp_path):
    from folioscope.sinks import files as sinks
    from folioscope.sources import files

    rows = spark.range(0, 1000, 1, 7).select("id", F.when(F.col("id") % 3 == 0, F.concat(F.lit("é\n\""), "id")).alias("t"))
    path = f"{tmp_path}/deep/papers.json"
    sinks.json_array_file(rows, path)
    want = [{"id": i, "t": f"é\n\"{i}" if i % 3 == 0 else None} for i in range(1000)]
    assert json.load(open(path)) == want
    assert sorted(files.json_array(spark, path, "id long, t string").collect()) == sorted(rows.collect())
    sinks.json_lines_file(rows.orderBy(F.desc("id")), f"{tmp_path}/deep/d.jsonl")
    assert [json.loads(x) for x in open(f"{tmp_path}/deep/d.jsonl")] == want[::-1]
    sinks.json_array_file(rows.limit(0), f"{tmp_path}/none.json")
    assert json.load(open(f"{tmp_path}/none.json")) == []
    # a job that fails leaves the file of the one before, and no parts
    broken = rows.withColumn("t", F.when(F.col("id") > 900, F.raise_error(F.lit("no"))).otherwise(F.col("t")))
    with pytest.raises(Exception, match="no"):
        sinks.json_array_file(broken, path)
    assert json.load(open(path)) == want and sorted(p.name for p in (tmp_path / "deep").iterdir() if not p.name.endswith(".crc")) == ["d.jsonl", "papers.json"]


def test_sidecars_as_arrays_and_status(spark, tmp_path):
    from folioscope.sinks import files as sinks
    from folioscope.sources import files

    rows = spark.createDataFrame([("Aug10_2026", 2, "B", "l2", None, date(2026, 8, 9)), ("Aug10_2026", 1, "A", "l1", "s", None), ("Aug3_2026", 1, "C", "l3", "s", date(2026, 8, 2))], "edition string, pos int, title string, link string, source string, date date")
    assert sinks.sidecar_files(rows, f"{tmp_path}/side") == 2
    assert json.load(open(f"{tmp_path}/side/Aug10_2026.papers.json")) == [{"title": "A", "link": "l1", "source": "s", "date": None}, {"title": "B", "link": "l2", "source": None, "date": "2026-08-09"}]
    assert {(r.edition, r.title) for r in files.sidecars(spark, f"{tmp_path}/side/*.json").collect()} == {("Aug10_2026", "A"), ("Aug10_2026", "B"), ("Aug3_2026", "C")}
    sinks.warnings(f"{tmp_path}/w.json", ["x"])
    sinks.warnings(f"{tmp_path}/w.json", [])
    assert not (tmp_path / "w.json").exists()


def test_keyed_state_over_batches_and_restarts(spark, tmp_path):
    """What shares a key with anything met in an earlier batch is dropped; copies in a batch pass; a batch reads the state of its keys alone."""
    fields = "seq long, title string, link string, doi string, date timestamp"
    when = datetime(2026, 8, 5)
    batches = [
        [(1, "One", "l", "10.1/a", when), (2, "Two", "l", None, when), (3, "Two", "l", "10.1/b", when), (9, None, None, None, when)],
        [(4, "ONE!", "l", None, when), (5, "Five", "l", "10.1/B", when), (6, "Six", "l", "10.1101/2026.07.01.5", when), (10, None, None, None, when)],
        [(7, "Five", "l", "10.1/c", when), (8, "Eight", "l", None, when), (6, "Six", "l", None, when)],
    ]
    read = []
    for rows in batches:
        spark.createDataFrame(rows, fields).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        frame = editions.event_time(spark.readStream.schema(fields).parquet(f"{tmp_path}/in"))
        query = editions.keyed_editions(frame, f"{tmp_path}/out", F.lit("e"), f"{tmp_path}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination(120)
        read.append(sum(s.numRowsUpdated for p in query.recentProgress for s in p.stateOperators))
    got = [(r.seq, r.published) for r in spark.read.parquet(f"{tmp_path}/out").orderBy("batch", "seq").collect()]
    # 7 shares its title with 5, which was dropped for its DOI: the same work
    assert [k for k, _ in got] == [1, 2, 3, 9, 6, 10, 8]
    assert dict(got)[6] == datetime(2026, 7, 1)  # the day of first posting
    assert read == [5, 6, 4]  # keys of the batch, not of all before


def test_keyed_state_is_asked_for_by_bucket(spark, tmp_path, monkeypatch):
    """A call of the state's function takes many keys, and each row still learns of its own key, whatever share a bucket."""
    monkeypatch.setattr(editions, "BUCKETS", 2)
    fields = "seq long, title string, link string, doi string, date timestamp"
    when, calls = datetime(2026, 8, 5), tmp_path / "calls"
    calls.mkdir()
    plain = editions._Met.handleInputRows

    class Counted(editions._Met):
        def handleInputRows(self, key, rows, timer_values):  # noqa: N802 - the interface's name
            import uuid

            (calls / uuid.uuid4().hex).touch()
            yield from plain(self, key, rows, timer_values)

    monkeypatch.setattr(editions, "_Met", Counted)
    for rows in ([(k, f"Title {k}", None, None, when) for k in range(60)], [(100 + k, f"Title {k}", None, None, when) for k in range(0, 120, 2)]):
        spark.createDataFrame(rows, fields).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        frame = editions.event_time(spark.readStream.schema(fields).parquet(f"{tmp_path}/in"))
        editions.keyed_editions(frame, f"{tmp_path}/out", F.lit("e"), f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination(120)
    assert sorted(r.seq for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [*range(60), *range(160, 220, 2)]
    assert len(list(calls.iterdir())) == 4


def test_pages_and_entries_are_held_a_few_at_a_time(spark, tmp_path, monkeypatch):
    """A reader's batches, and the entries that a task holds, are bounded by bytes and not by the number of pages."""
    monkeypatch.setattr(web, "BATCH", 1000)
    feed = "<rss><channel>" + "".join(f"<item><title>T{k}</title></item>" for k in range(20)) + "</channel></rss>"
    pages = [(f"f/{k}", feed if k < 9 else "") for k in range(10)]
    sinks.stored(spark.createDataFrame(pages, "url string, body string"), str(tmp_path))
    reader = web.WebReader({"requests": json.dumps([{"name": "f", "url": "f/{page}"}]), "folder": str(tmp_path), "pages": "99", "retries": "1"})
    (one,) = reader.partitions()
    batches = list(reader.read(one))
    assert [b.num_rows for b in batches] == [2, 2, 2, 2, 2] and [v for b in batches for v in b["page"].to_pylist()] == list(range(10))
    monkeypatch.setattr(records, "PARSED", 1000)
    bodies = spark.createDataFrame([(k, feed if k % 3 else "not & xml") for k in range(12)], "page long, body string").coalesce(1)
    spread = records.with_entries(bodies)
    got = spread.collect()
    assert [(r.page, r.entries and len(r.entries), r.body) for r in got] == [(k, 20, None) if k % 3 else (k, None, "not & xml") for k in range(12)]


def _commit(repo, day, **files):
    import subprocess

    for name, body in files.items():
        (repo / f"{name}.json").unlink(missing_ok=True)
        if body is not None:
            (repo / f"{name}.json").write_text(body)
    when = f"{day}T12:00:00+0000"
    run = lambda *a: subprocess.run(["git", "-C", str(repo), "-c", "user.name=x", "-c", "user.email=x@y", *a], check=True, capture_output=True, env={"PATH": "/usr/bin:/bin", "GIT_AUTHOR_DATE": when, "GIT_COMMITTER_DATE": when})
    run("add", "-A")
    run("commit", "-qm", day)


def test_history_asks_git_for_each_version(spark, tmp_path):
    import subprocess

    from folioscope.sources import history

    subprocess.run(["git", "init", "-q", str(tmp_path)], check=True)
    paper = lambda *ids: json.dumps([{"source": "s", "title": f"T{i}", "link": f"l{i}", "date": f"2026-08-{i:02d}T00:00:00+00:00", "images": []} for i in ids])
    _commit(tmp_path, "2026-08-03", papers=paper(1))
    _commit(tmp_path, "2026-08-05", papers=paper(1, 2))
    _commit(tmp_path, "2026-08-06", other="x")
    _commit(tmp_path, "2026-08-09", papers=None, keep="1")  # deleted at the end of its week
    _commit(tmp_path, "2026-08-10", papers=paper(3, 4))
    _commit(tmp_path, "2026-08-17", papers="no json")
    every = history.versions(spark, str(tmp_path), "papers.json")
    assert every.rdd.getNumPartitions() == 5
    assert [(str(r.week), r.commit_no) for r in every.orderBy("commit_no").collect()] == [("2026-08-03", 0), ("2026-08-03", 1), ("2026-08-10", 3), ("2026-08-17", 4)]
    rows = history.snapshots(spark, str(tmp_path))
    assert [(r.week, r.link) for r in rows.orderBy("seq").collect()] == [("2026-08-03", "l1"), ("2026-08-03", "l2"), ("2026-08-10", "l3"), ("2026-08-10", "l4")]
    lines = spark.createDataFrame([("2026-08-03", 0, "## Some Papers"), ("2026-08-03", 1, "#### [T2](<l2>)"), ("2026-08-10", 0, "#### [T3](<l3>)")], "week string, pos long, line string")
    told = {(r.week, r.title): (r.label, r.selected_section) for r in pipeline.label_history(rows, lines).collect()}
    assert told == {("2026-08-03", "T1"): ("rejected", None), ("2026-08-03", "T2"): ("selected", "some"), ("2026-08-10", "T3"): ("selected", "more"), ("2026-08-10", "T4"): ("rejected", None)}
    dates = history.known_dates(spark, str(tmp_path))
    assert sorted((r.link, r.date[:10]) for r in dates.collect()) == [("l1", "2026-08-01")] * 2 + [("l2", "2026-08-02"), ("l3", "2026-08-03"), ("l4", "2026-08-04")]
    with pytest.raises(Exception, match="no git repository"):
        history.versions(spark, f"{tmp_path}/none", "papers.json").collect()


def test_archive_cascade(spark, tmp_path):
    """One category by the API, one by its listing, one by its feed; an id found before isn't taken again."""
    from folioscope.sources import cascade, lookups

    entry = lambda i, d: f"<entry><title>Paper {i}</title><id>http://arxiv.org/abs/{i}v1</id><link href='http://arxiv.org/abs/{i}v1'/><published>{d}T00:00:00Z</published><summary>S</summary><author><name>A B</name></author></entry>"
    feed = lambda *e: "<feed xmlns='http://www.w3.org/2005/Atom'>" + "".join(e) + "</feed>"
    line = lambda i: f"<a href='/abs/{i}'>arXiv:{i}</a>\n<span class='descriptor'>Title:</span> Listed {i}</div>\n<div class='list-authors'><a href='x'>C D</a></div>"
    item = lambda i, d: f"<item><title>Fed {i}</title><link>https://arxiv.org/abs/{i}</link><description>D</description>{d}</item>"
    api = lambda c, k: lookups.arxiv_url(c, 2).replace("{cursor}", str(k))
    _stored(tmp_path, {
        api("a", 0): feed(entry("2608.1", "2026-08-09"), entry("2608.2", "2026-08-04")), api("a", 2): feed(entry("2607.9", "2026-07-01")),
        api("b", 0): feed(entry("2608.3", "2026-08-09"), entry("2608.4", "2026-08-08")),  # and then no page
        cascade.listing_url("b"): "<h3>Wed, 05 Aug 2026 (showing 2 of 2 entries )</h3>\n" + line("2608.4") + "\n" + line("2608.5"),
        "https://arxiv.org/abs/2608.5": '<blockquote class="abstract mathjax"> <span class="descriptor">Abstract:</span> Of\n <b>five</b>. </blockquote>',
        cascade.feed_url("c"): "<rss><channel>" + item("2608.1", "<pubDate>Wed, 05 Aug 2026 10:00:00 GMT</pubDate>") + item("2608.6", "<pubDate>Wed, 05 Aug 2026 10:00:00 GMT</pubDate>") + item("2608.7", "") + "</channel></rss>",
    })
    got = cascade.archive_papers(spark, ["a", "b", "c"], F.lit("2026-08-03").cast("timestamp"), F.lit("2026-08-10").cast("timestamp"), str(tmp_path), size=2, retries=1)
    assert sorted((r.title, r.abstract, str(r.date)[:10]) for r in got.collect()) == [("Fed 2608.6", "D", "2026-08-05"), ("Listed 2608.5", "Of five.", "2026-08-05"), *((f"Paper 2608.{i}", "S", d) for i, d in ((1, "2026-08-09"), (2, "2026-08-04"), (3, "2026-08-09"), (4, "2026-08-08")))]
    assert got.columns == list(cascade.PAPER_COLUMNS)


def test_requests_to_a_host_keep_their_interval(spark, tmp_path):
    now, slept, asked = [100.0], [], []

    def sleep(seconds):
        slept.append(round(seconds, 3))
        now[0] += seconds

    def get(url):
        asked.append((url, now[0]))
        now[0] += 1.0
        return (429, "", 30.0) if url == "busy" else (200, "x", None)

    pause = policy.SharedPause(str(tmp_path / "pause"), every=0.0, clock=lambda: now[0])
    polite = web.paced(get, 3.0, pause, lambda: now[0], sleep)
    assert [polite(u)[0] for u in ("a", "b", "busy")] == [200, 200, 429] and slept == [2.0, 2.0]
    other = web.paced(get, 3.0, policy.SharedPause(str(tmp_path / "pause"), every=0.0, clock=lambda: now[0]), lambda: now[0], sleep)
    began = now[0]
    assert other("c")[0] == 200 and asked[-1][1] - began == pytest.approx(30.0, abs=0.01)
    assert web.retry_after("7") == 7.0 and web.retry_after(" 0 ") is None and web.retry_after("soon") is None and web.retry_after(None) is None
    assert web.retry_after("Thu, 01 Jan 1970 00:01:40 GMT", lambda: 40.0) == 60.0 and web.retry_after("Thu, 01 Jan 1970 00:01:40 GMT", lambda: 400.0) is None

    urls = [(f"n{k}", f"https://{'ab'[k % 2]}.org/{k}") for k in range(6)]
    folder = tmp_path / "bodies"
    folder.mkdir()
    for name, url in urls:
        (folder / web.stored_name(url)).write_text(f"body of {name}")
    free, kept = (web.scan(spark, urls, folder=str(folder), interval=i) for i in (0, 0.01))
    assert free.rdd.getNumPartitions() == 6 and kept.rdd.getNumPartitions() == 2
    assert sorted(map(tuple, free.select("name", "body").collect())) == sorted(map(tuple, kept.select("name", "body").collect())) == [(n, f"body of {n}") for n, _ in urls]
    assert [r.name for r in kept.where("name = 'n3'").collect()] == ["n3"]


def test_an_array_with_a_record_a_line_is_read_by_many_tasks(spark, tmp_path):
    from folioscope.sinks import files as sinks
    from folioscope.sources import files

    rows = spark.range(3000).select("id", F.concat(F.lit("[{,\n "), F.lit("x" * 50), F.lit("}],")).alias("t"))
    path = f"{tmp_path}/papers.json"
    sinks.json_array_file(rows.repartition(4), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = files.json_array(spark, path, "id long, t string")
        assert got.rdd.getNumPartitions() > 4 and sorted(got.collect()) == sorted(rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    # files of any other kind as Spark reads them whole
    for k, text in enumerate(['[{"id": 1}, {"id": 2}]', '[\n{"id": 1,\n"t": "a"},\n{"id": 2}\n]\n', '[{"id": 1},\n{"id": 2}', '{"id": 1},\n[{"id": 2}]', '[{"id": 1}\n{"id": 2}]', '{"id": 3}', "[\n]", "[]", '[\n{"id": 1}\n,{"id": 2}\n]']):
        (tmp_path / f"{k}.json").write_text(text)
        whole = spark.read.schema("id long, t string").json(f"{tmp_path}/{k}.json", multiLine=True).collect()
        assert files.json_array(spark, f"{tmp_path}/{k}.json", "id long, t string").collect() == whole, text
