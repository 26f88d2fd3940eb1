import json
from datetime import date

import pytest
from folioscope.operators import budget, policy
from folioscope.sinks import files as sinks
from folioscope.sinks.shared import settle
from folioscope.sources import lookups, records, web
from pyspark.sql import functions as F

ARXIV = "<feed xmlns='http://www.w3.org/2005/Atom'>%s</feed>"
ENTRY = "<entry><id>http://arxiv.org/abs/%sv2</id><link href='http://arxiv.org/abs/%sv2'/><title>On  forces %s</title><published>%sT00:00:00Z</published><summary>S</summary><author><name>A B</name></author></entry>"


def entry(i, day):
    return ENTRY % (i, i, i, day)


def stored(folder, urls):
    for url, body in urls.items():
        (folder / web.stored_name(url)).write_text(body)
    return web.file_transport(str(folder))


def test_cascade_asks_for_open_keys_only(spark, tmp_path):
    first = stored(tmp_path, {lookups.arxiv_ids_url([i]): ARXIV % (entry(i, "2026-08-04") if i != "2608.2" else "") for i in ("2608.1", "2608.2", "2608.3")})
    second = stored(tmp_path, {"s:2608.2": json.dumps([{"externalIds": {"ArXiv": "2608.2"}, "publicationDate": "2026-08-05"}, None])})
    rows = spark.createDataFrame([("2608.1",), ("2608.2",), ("2608.2",), ("2608.9",), (None,)], "arxiv_id string")
    stages = [lambda k: lookups.arxiv_dates(lookups.answers(k, "key", lookups.arxiv_ids_url, first)), lambda k: lookups.scholar_dates(lookups.answers(k, "key", lambda ids: "s:" + ids[0], second))]
    got = sorted((str(r.arxiv_id), r.date) for r in lookups.resolved(rows, "arxiv_id", "date", stages).collect())
    assert got == [("2608.1", date(2026, 8, 4)), ("2608.2", date(2026, 8, 5)), ("2608.2", date(2026, 8, 5)), ("2608.9", None), ("None", None)]


def test_batches_and_works(spark, tmp_path):
    asked = spark.createDataFrame([(str(i),) for i in range(5)] * 2 + [("",)], "key string")
    got = lookups.answers(asked, "key", lambda k: "u", web.file_transport(str(tmp_path)), batch=2, partitions=1).collect()
    assert sorted(len(r.batch_keys) for r in got) == [1, 2, 2] and {r.status for r in got} == {404} and {r.body for r in got} == {None}
    body = json.dumps({"message": {"author": [{"given": "A", "family": "B", "ORCID": "https://orcid.org/1"}, {"given": "x"}, {"family": "C"}], "abstract": "<jats:p>Text</jats:p>"}})
    get = stored(tmp_path, {lookups.crossref_work_url(["10.1/a"]): body})
    rows = {r.key: r for r in lookups.work_metadata(lookups.answers(spark.createDataFrame([("10.1/a",), ("10.1/b",)], "key string"), "key", lookups.crossref_work_url, get)).collect()}
    assert (rows["10.1/a"].authors, rows["10.1/a"].abstract, rows["10.1/a"].orcids) == (["A B", "C"], "Text", ["https://orcid.org/1"])
    assert rows["10.1/b"].orcids is None
    titles = spark.createDataFrame([("Forces between moving <i>cells</i>", "On forces between moving cells"), ("Forces between moving cells", "Between us"), ("a b c", "a b c")], "a string, b string")
    assert [r[0] for r in titles.select(lookups.same_title(F.col("a"), F.col("b"))).collect()] == [True, False, False]


def test_sorted_scan_stops_at_what_is_old(spark, tmp_path):
    url = lookups.arxiv_url("physics.bio-ph", 2)
    pages = [[("2608.1", "2026-08-09"), ("2608.2", "2026-08-08")], [("2608.3", "2026-08-05"), ("2607.4", "2026-07-01")], [("2607.5", "2026-06-01")]]
    stored(tmp_path, {url.replace("{cursor}", str(2 * k)): ARXIV % "".join(entry(*e) for e in p) for k, p in enumerate(pages)})
    df = web.scan(spark, [("arXiv", url)], folder=tmp_path, pages=9, pageSize=2).where("newest >= DATE '2026-08-03'")
    assert df.count() == 2
    rows = records.arxiv_papers(df.unionAll(df), F.lit("2026-08-03").cast("timestamp"), F.lit("2026-08-10").cast("timestamp")).orderBy("link").collect()
    assert [(r.title, r.authors, r.source) for r in rows] == [(f"On forces 2608.{i}", "A B", "arXiv") for i in (1, 2, 3)]


def test_scans_that_end_early_say_so(spark, tmp_path):
    page = lambda n, total: json.dumps({"messages": [{"count": n, "total": str(total)}], "collection": list(range(n))})
    stored(tmp_path, {"u?c=0": page(3, 5), "u?c=3": page(2, 5), "v?c=0": page(3, 9), "v?c=3": page(3, 9), "w?c=0": page(3, 9), "w?c=3": page(0, 9)})
    spark.dataSource.register(web.WebSource)
    scan = lambda u: spark.read.format("web").options(requests=json.dumps([{"name": "a", "url": u + "?c={cursor}"}]), folder=str(tmp_path), pages="2", pageSize="100").load()
    assert [(r.page, r.error) for r in scan("u").orderBy("page").collect()] == [(0, None), (1, None)] and web.whole(scan("u"))
    assert [r.error for r in scan("v").orderBy("page").collect()] == [None, None, "incomplete: 2 pages read"]
    assert [r.error for r in scan("w").orderBy("page").collect()] == [None, None, "incomplete: an empty page"]
    assert web.first_complete(scan("v"), scan("u"), complete=web.whole).count() == 2


def test_metered_model_keeps_to_its_budget_over_tasks(spark):
    made = policy.Metered(lambda p: policy.Response(200, "yes", usage=(10, 1, 0)), lambda t, a: t, budget.Budget(max_requests=10), 4)
    df = spark.createDataFrame([(i, f"t{i}", "") for i in range(100)], "seq long, title string, abstract string")
    got = policy.ask(df, made, 4).collect()
    assert len(got) == 100 and sum(r.raw == "yes" for r in got) == 10
    whole = budget.Budget(max_usd=3.0, max_requests=11)
    assert sum(whole.share(4, i).max_requests for i in range(4)) == 11 and sum(whole.share(4, i).max_usd for i in range(4)) == 3.0
    now, waits = [0.0], []
    paced = policy.Metered(lambda p: policy.Response(200, "y"), lambda t, a: t, budget.Budget(), 2, 1.5, clock=lambda: now[0], sleep=lambda s: (waits.append(s), now.__setitem__(0, now[0] + s)))
    assert [paced("a", ""), paced("b", ""), paced("c", "")] == ["y"] * 3 and waits == [3.0, 3.0]


def _papers(spark, n, **columns):
    rows = spark.range(n).select(F.col("id").alias("seq"), F.concat(F.lit("t"), "id").alias("title"), F.lit("").alias("abstract"), F.lit("s").alias("source"), F.lit(0.0).alias("local_score"))
    return rows.withColumns(columns) if columns else rows


def test_passes_together_keep_to_one_ceiling(spark):
    """Whatever partitions a pass uses: 40 calls, where each pass for itself would have had 40."""
    made = policy.Metered(lambda p: policy.Response(200, "unsure", usage=(10, 1, 0)), lambda t, a: t, budget.Budget(max_requests=40), 4)
    for parts, repair in ((4, 2), (16, 9), (1, 1), (3, 50)):
        ledger = budget.Ledger(spark, made.budget)
        out = policy.classify(_papers(spark, 200), F.lit(False), made, made, settle, parts, repair, ledger=ledger)
        assert ledger.left().requests == 40 and out.count() == 200
        assert [r.requests for r in ledger.spent().where("pass = 'first'").collect()] == [40]
    # without a ledger of its own a classification makes one over the model's budget
    policy.classify(_papers(spark, 60), F.lit(False), made, made, settle, 2, 2)
    half = policy.Metered(lambda p: policy.Response(200, "unsure", usage=(10, 1, 0)), lambda t, a: t, budget.Budget(max_requests=60), 4)
    ledger = budget.Ledger(spark, half.budget)
    policy.classify(_papers(spark, 40), F.lit(False), half, half, settle, 4, 3, ledger=ledger)
    assert {r["pass"]: r.requests for r in ledger.spent().collect()} == {"first": 40, "repair": 20, "recall": 0}


def test_a_ledger_goes_on_where_a_run_ended(spark, tmp_path):
    b = budget.Budget(max_usd=1.0, max_requests=100)
    first = budget.Ledger(spark, b, f"{tmp_path}/ledger")
    assert first.left() == b and first.spent().count() == 0
    made = policy.Metered(lambda p: policy.Response(200, "x", usage=(1000, 100, 10)) if p != "t3" else policy.Response(503), lambda t, a: t, b, 4, retries=1)
    rows = settle(policy.ask(_papers(spark, 10), made, 4, first))
    first.record("first", rows)
    left = budget.Ledger(spark, b, f"{tmp_path}/ledger").left()
    assert left.requests == 10 and left.reported == pytest.approx(9 * budget.usage_cost(1000, 100, 10)) and left.unreported == pytest.approx(b.estimate("t3"))
    assert policy.Ledger(spark, b, f"{tmp_path}/ledger").left().share(4, 0).max_usd == pytest.approx((1.0 - left.exposure) / 4)
    state = policy.health(spark.createDataFrame([("regular", "AI Approved", 1)], "category string, reason string, recall_classifier_score int"), first).first()
    assert (state.attempts, state.failures, state.requests) == (2, 0, 10) and state.unreported == pytest.approx(left.unreported)


def test_dollars_hold_over_passes_and_attempts(spark):
    b = budget.Budget(max_usd=0.2)
    made = policy.Metered(lambda p: policy.Response(200, "unsure", usage=(len(p), 900, 0)), lambda t, a: t, b, 4)
    ledger = budget.Ledger(spark, b)
    policy.classify(_papers(spark, 300), F.lit(False), made, made, settle, 5, 2, ledger=ledger)
    assert 0.1 < ledger.left().exposure <= 0.2
    assert sum(b.share(3, i, 2).max_usd for i in range(3)) == pytest.approx(0.1) and sum(budget.Budget(max_requests=20).share(3, i, 2).max_requests for i in range(3)) <= 10


def test_a_pause_is_shared(tmp_path):
    now, waits = [100.0], []
    pauses = [policy.SharedPause(f"{tmp_path}/pause", 0.0, lambda: now[0]) for _ in range(2)]
    replies = [policy.Response(429, wait=7.0), policy.Response(200, "a")]
    sleep = lambda s: (waits.append(s), now.__setitem__(0, now[0] + s))
    one = policy.Metered(lambda p: replies.pop(0), lambda t, a: t, budget.Budget(), 1, clock=lambda: now[0], sleep=sleep, pause=pauses[0])
    two = policy.Metered(lambda p: policy.Response(200, "b"), lambda t, a: t, budget.Budget(), 1, clock=lambda: now[0], sleep=sleep, pause=pauses[1])
    assert pauses[1].wait() == 0.0
    pauses[0].extend(7.0)
    assert two("x", "") == "b" and waits == [pytest.approx(7.0)]
    assert one("x", "") == "a" and waits[1:] == [7.0]  # the service's own pause, which has passed when the other looks
    assert two("x", "") == "b" and len(waits) == 2


def test_repeated_training_documents_count(spark):
    from folioscope.plans import pipeline

    papers = spark.createDataFrame([(1, "cells move", "", "", "", ""), (2, "lasers shine", "", "", "", "")], "seq long, title string, abstract string, source string, link string, doi string")
    votes = spark.createDataFrame([], "title string, summary string, source string, link string, upvotes long, downvotes long")
    once = [("cells", 2.0), ("lasers", 2.0)]
    score = lambda rows: {r.key: r.score for r in pipeline.score(papers, spark.createDataFrame(rows, "text string, weight double"), votes).collect()}
    one, more = score(once), score(once + [("cells", 2.0)] * 3)
    assert abs(one["title:cellsmove"] - one["title:lasersshine"]) < 1e-9 and more["title:cellsmove"] > more["title:lasersshine"] + 0.1


def test_summaries_fall_back(spark):
    df = spark.createDataFrame([(0, "Good", "x"), (1, "Bad", "The abstract has a first sentence of enough letters. More."), (2, "Raise", "")], "seq long, title string, abstract string")

    def model(title, abstract):
        if title == "Raise":
            raise OSError
        return "A whole sentence about this very paper." if title == "Good" else "Fragment"

    got = [(r.summary, r.fell_back) for r in policy.summarize(df, model, 2).orderBy("seq").collect()]
    assert got == [("A whole sentence about this very paper.", False), ("The abstract has a first sentence of enough letters.", True), ("Summary unavailable.", False)]


def test_guarded_model():
    b, waits = budget.Budget(), []
    replies = [policy.Response(429, wait=5.0), policy.Response(503), policy.Response(200, " ok ", usage=(100, 20, 30))]
    assert policy.guarded(lambda p: replies.pop(0), b, 3, 20, waits.append)("hello") == "ok" and waits == [5.0, 6.0]
    assert b.requests == 3 and b.in_flight == pytest.approx(0) and b.reported == pytest.approx(525e-6) and b.unreported > 0
    assert policy.guarded(lambda p: policy.Response(200, "cut", "MAX_TOKENS"), b)("x") == ""
    assert policy.guarded(lambda p: policy.Response(400), b, sleep=waits.append)("x") == "" and len(waits) == 2


def test_journal_dates_without_a_page_or_a_work(spark):
    start, end = F.lit("2026-08-03").cast("date"), F.lit("2026-08-10").cast("date")
    work = '"published": {"date-parts": [[2026, 8]]}, "created": {"date-parts": [[2026, 8, 9]]}'
    known = {
        "https://a.org/1": '<meta name="citation_date" content="2026-07-01"><meta name="citation_doi" content="10.1000/a">',
        lookups.crossref_work_url(["10.1000/a"]): '{"message": {' + work + "}}",
        lookups.crossref_title_url(["Bending cells"]): '{"message": {"items": [{"title": ["BENDING <i>cells</i>"], ' + work + "}]}}",
        lookups.crossref_title_url(["Other cells here"]): '{"message": {"items": []}}',
    }
    get = lambda url: (200, known[url], None) if url in known else (404, "", None)
    rows = [("https://a.org/1", "A"), ("https://a.org/1", "A"), ("https://gone.org/2", "Bending cells"), ("https://gone.org/3", "Other cells here"), ("https://doi.org/10.1000/gone", None), (None, "x"), ("", "y")]
    found = lookups.journal_dates(spark.createDataFrame(rows, "link string, title string"), get, start, end)
    assert {(r.link, str(r.date)) for r in found.collect()} == {("https://a.org/1", "2026-08-09"), ("https://gone.org/2", "2026-08-09"), ("https://gone.org/3", "None"), ("https://doi.org/10.1000/gone", "None")}
    assert found.count() == 4
    assert lookups.journal_dates(spark.createDataFrame([], "link string, title string"), get, start, end).count() == 0


def test_stored_answers_arent_bound_to_a_few_tasks(spark, tmp_path, monkeypatch):
    """Stored bodies are read by as many tasks as a shuffle has, a service is asked by no more than was said; answers leave a task many at a time, and all of them."""
    asked = spark.range(60).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    sinks.stored(asked.where("id < 50").select(F.concat(F.lit("u/"), "key").alias("url"), F.concat(F.lit("body of "), "key").alias("body")), str(tmp_path))
    stored, service = web.file_transport(str(tmp_path)), lambda url: (200, url, None)
    url = lambda keys: f"u/{keys[0]}"
    assert lookups.answers(asked, "key", url, stored, partitions=2).rdd.getNumPartitions() == 4
    assert lookups.answers(asked, "key", url, service, partitions=2).rdd.getNumPartitions() == 2
    for most in (1, 7, 1000):
        monkeypatch.setattr(lookups, "ANSWERS", most)
        found = {r.batch_keys[0]: (r.status, r.body, r.error) for r in lookups.answers(asked, "key", url, stored, retries=1).collect()}
        assert found == {f"k{k}": (200, f"body of k{k}", None) if k < 50 else (404, None, "HTTP 404") for k in range(60)}
        pairs = lookups.answers(asked, "key", lambda keys: "x", service, batch=7, partitions=1).collect()
        assert sorted(k for r in pairs for k in r.batch_keys) == sorted(f"k{k}" for k in range(60)) and len(pairs) == 9


def test_a_local_model_isnt_bound_to_a_few_tasks(spark):
    """A model that asks nobody runs where the rows are; one that asks a service keeps to its number of tasks."""
    papers = spark.range(40).select(F.col("id").alias("seq"), F.lit("a heed").alias("title"), F.lit("b").alias("abstract"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        local, asking = policy.keyword_model(("heed",)), lambda title, abstract: "TRUE"
        assert policy.ask(papers, local, 2).rdd.getNumPartitions() == 4 and policy.ask(papers, asking, 2).rdd.getNumPartitions() == 2
        assert {'"score": 55' in r.raw for r in policy.ask(papers, local, 2).collect()} == {True}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


@pytest.mark.parametrize("lost, body", [("rss2/src1/0", None), ("rss2/src1/1", None), ("rss2/src1/0", "<html><br></html"), ("rss2/src1/0", "")])
def test_a_feed_that_breaks_off_is_no_result(spark, tmp_path, monkeypatch, lost, body):
    """A page that is missing, empty or no feed fails the scan, where the rest of the feeds was taken for all of them."""
    from folioscope.plans import catalog_runs

    spark.createDataFrame([(k, "t", "de", f"src{k % 3}") for k in range(9)], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert catalog_runs.backup_scan(spark, str(tmp_path)).count() == 9
    stored = catalog_runs.sinks.stored

    def broken(pages, folder):
        kept = pages.where(F.col("url") != lost)
        stored(kept if body is None else kept.unionByName(spark.createDataFrame([(lost, body)], "url string, body string")), folder)

    monkeypatch.setattr(catalog_runs.sinks, "stored", broken)
    with pytest.raises(Exception, match="sources is complete|not a feed"):
        catalog_runs.backup_scan(spark, str(tmp_path)).collect()


def test_scans_fail_where_a_page_is_missing(spark, tmp_path, monkeypatch):
    from folioscope.plans import catalog_runs

    spark.createDataFrame([(12 * k, "t", "de", "src1") for k in range(70)], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    scans = (catalog_runs.archive_scan, catalog_runs.preprint_scan)
    assert [q(spark, str(tmp_path)).count() for q in scans] == [70, 70]
    stored = catalog_runs.sinks.stored
    monkeypatch.setattr(catalog_runs.sinks, "stored", lambda pages, folder: stored(pages.where("NOT url RLIKE '/30/json|start=40'"), folder))
    for q in scans:
        with pytest.raises(Exception, match="a scan isn't complete"):
            q(spark, str(tmp_path)).collect()
