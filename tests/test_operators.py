import json
import os
from datetime import date

import pytest
from folioscope.operators import archive, budget, containment, dedup, feedback, filters, joins, policy, quality, rank, term_blocks, tfidf
from pyspark.sql import functions as F

PAPER = "seq long, source string, title string, authors string, link string, abstract string, date string, doi string"


def items(spark, n=50, **changes):
    rows = [dict(seq=i, source="Journal", title=f"Title {i}", authors="A. Author", link=f"https://x.org/{i}", abstract="word " * 30, date="2026-08-05T00:00:00+00:00", doi=None, summary="A complete sentence about this one paper.") for i in range(n)]
    for at, change in changes.items():
        rows[int(at[1:])] |= change
    return spark.createDataFrame([tuple(r.values()) for r in rows], PAPER + ", summary string")


def issues(df, **kw):
    return [r["issue"] for r in quality.edition_issues(df, F.lit("2026-08-10").cast("date"), **kw).orderBy("seq", "step").collect()]


def test_edition_gate(spark):
    assert issues(items(spark)) == []
    assert "minimum is 50" in issues(items(spark, 49))[0]
    assert "minimum is 77 for 153 valid candidates" in issues(items(spark), candidates=153, fraction=0.5)[0]


@pytest.mark.parametrize(
    ("change", "text"),
    [
        ({"date": "2026-08-02T23:59:59+00:00"}, "older than"),
        ({"date": "2026-08-11"}, "after edition date"),
        ({"source": "bioRxiv", "link": "https://www.biorxiv.org/content/10.1101/2023.08.22.554088v2"}, "publication date 2023-08-22 is older"),
        ({"source": "CrossRef/Featured", "link": "https://doi.org/10.64898/2026.07.31.742166"}, "publication date 2026-07-31 is older"),
        ({"abstract": "Abstract not available via CrossRef API.", "summary": "Abstract not available via CrossRef API."}, "placeholder text"),
        ({"summary": "Mid-spindle microtubules maintain invariant"}, "complete sentence"),
        ({"title": "Title 1", "link": "HTTPS://x.org/1"}, "duplicate"),
        *(({f: " "}, f"{f} is blank") for f in quality.FIELDS),
    ],
)
def test_one_row_mutations(spark, change, text):
    assert any(text in i for i in issues(items(spark, r2=change)))


def test_boundary_day_is_in(spark):
    assert issues(items(spark, r2={"date": "2026-08-03T00:00:00+00:00"})) == []


def test_placeholder_control(spark):
    row = spark.range(1).select(quality.is_placeholder(F.lit("Information on unavailable states is encoded")).alias("a"), quality.is_placeholder(F.lit("")).alias("b"), quality.is_placeholder(F.lit(" TBD ")).alias("c")).first()
    assert tuple(row) == (False, True, True)


def test_sanitize(spark):
    kept, removed = quality.sanitize(items(spark, 2, r1={"abstract": "short"}).drop("summary"), F.lit("2026-08-10").cast("date"))
    assert [r["date"] for r in kept.collect()] == ["2026-08-05T00:00:00+00:00"] and [r["seq"] for r in removed.collect()] == [1]
    with pytest.raises(ValueError, match="between"):
        quality.required_size(1, fraction=2)


def papers(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq long, source string, title string, doi string, date string").withColumn("date", F.col("date").cast("date"))


def test_dedup(spark):
    p = papers(spark, [("a", "T one", "10.1/A", "2026-08-02"), ("b", "T two", "10.1/a", "2026-08-01"), ("star", "T three", "10.1/a", "2026-08-09"), ("a", "No doi", None, "2026-08-01"), ("a", "No doi", None, "2026-08-01")])
    star = F.col("source") == "star"
    assert sorted(r.seq for r in dedup.by_doi(p, star).collect()) == [2, 3, 4]
    once = dedup.by_title(dedup.by_doi(p, star), star)
    assert sorted(r.seq for r in once.collect()) == [2, 3]
    assert sorted(r.seq for r in dedup.by_title(dedup.by_doi(once, star), star).collect()) == [2, 3]
    versions = papers(spark, [("b", "A physical model", "10.1101/example", "2026-08-02"), ("b", "A physical model", "10.1101/example", "2026-08-01")])
    assert [r.seq for r in dedup.by_first_posted(versions).collect()] == [1]
    blank = papers(spark, [("a", "水", None, "2026-08-01"), ("a", "力", None, "2026-08-01"), ("a", None, None, "2026-08-01")])
    assert dedup.by_title(blank, star).count() == 3 and dedup.by_title(blank, star, blank_is_unique=False).count() == 1


def test_filters(spark):
    df = spark.createDataFrame([("Review of x", "", "arXiv", "A. One"), ("Cells move", "Editorial", "arXiv", "A. One, B. Two"), ("A python package for x", "", "Nature", "Solo"), ("Forces", "", "arXiv", "Green Solo")], "title string, kind string, source string, authors string")
    assert [r.title for r in df.where(filters.is_research(F.col("title"), F.col("kind"))).collect()] == ["Forces"]
    keep = filters.enough_authors(F.col("source"), F.col("authors"), ("arXiv",), ("Green Solo",))
    assert [r.title for r in df.where(keep).collect()] == ["Cells move", "A python package for x", "Forces"]
    assert df.where(filters.enough_authors(F.col("source"), F.col("authors"), ("arXiv",), ("Green Solo",), match_case=True)).count() == 2
    assert df.where(filters.is_green(F.col("authors"), F.col("title"), F.col("kind"), ("green solo",), ("CELL",))).count() == 2
    side = spark.createDataFrame([("a", "2026-01-01"), ("a", None), ("b", "2026-01-01")], "edition string, date string")
    assert [r.edition for r in filters.incomplete_editions(side).collect()] == ["a"]


def test_joins(spark):
    p = spark.createDataFrame([(0, "A title", "https://arxiv.org/abs/2601.1v1", None), (1, "B", "x", "10.1000/b"), (2, "C", "y", None)], "seq long, title string, link string, doi string")
    sent = spark.createDataFrame([("", "http://arxiv.org/pdf/2601.1v3.pdf", None), ("", "", "doi:10.1000/B")], "title string, link string, doi string")
    assert [r.seq for r in joins.drop_sent(p, sent).collect()] == [2]
    with pytest.raises(ValueError, match="without a decision"):
        joins.frozen(p, spark.createDataFrame([("x", "regular")], "link string, label string"))
    with pytest.raises(ValueError, match="more than once"):
        joins.frozen(p, spark.createDataFrame([("x", "regular"), (" x", "regular")], "link string, label string"))
    names = spark.createDataFrame([("David Weitz",), ("Jose Garcia",), ("Cher",)], "name string")
    people = spark.createDataFrame([(0, "D. Weitz; X Y"), (1, "Garcia José"), (2, "Weitz, D."), (3, "Cherish Who"), (4, "Daniel Weitz")], "seq long, authors string")
    assert sorted((r.seq, r.name) for r in joins.author_matches(people, names).collect()) == [(0, "David Weitz"), (1, "Jose Garcia"), (3, "Cher")]
    row = spark.range(1).select(joins.trusted(F.lit("not_found"), F.lit("o")).alias("a"), joins.trusted(F.lit("error"), F.lit("o")).alias("b"), joins.trusted(F.lit("not_found"), F.lit(None)).alias("c")).first()
    assert tuple(row) == (False, True, True)


VOTES = "title string, summary string, source string, link string, upvotes long, downvotes long"


def test_feedback_and_scores(spark):
    votes = spark.createDataFrame([("Mechanical force transmission by molecular motors", "Motors walk", "S", "l", 3, 0), ("Virtual drug docking database", "Docking screens", "S", "m", 0, 2), ("Even", "x", "S", "n", 2, 1)], VOTES)
    rated = {r.title: (r.polarity, r.weight) for r in feedback.preferences(votes).collect()}
    assert rated == {"Mechanical force transmission by molecular motors": ("positive", 3.0), "Virtual drug docking database": ("negative", 4.0)}
    assert feedback.context(votes).first().context == "MORE LIKE THESE:\n- Mechanical force transmission by molecular motors (weighted +3)\n\nDOES NOT BELONG:\n- Virtual drug docking database (weighted -4)"
    papers = spark.createDataFrame([(1, "molecular motors transmit force"), (2, "a docking database for drug screens"), (3, "")], "doc_id long, text string")
    pos = feedback.preferences(votes).where("polarity = 'positive'").select(F.lit(1).cast("long").alias("doc_id"), "text", "weight")
    neg = feedback.preferences(votes).where("polarity = 'negative'").select(F.lit(1).cast("long").alias("doc_id"), "text", "weight")
    got = {r.doc_id: r.score for r in tfidf.scores(papers, pos, neg).collect()}
    assert got[1] > 0 > got[2] and got[3] == 0.0
    assert {r.score for r in tfidf.scores(papers, pos.limit(0), neg).collect()} == {0.0}


QMD = """---
title: "Aug 3 26"
---
#### [Loose](<https://x.org/0>)
Before any section
# Featured Papers
::: {.grid}
#### [A *bold* title](<https://x.org/1>)
*A. One, B. Two* <br>
First line.

## More Papers
#### [Split title]
(<https://x.org/2>)
Authors <br/> Second &amp; last.
#### [No link at all
Body
"""


def test_archive(spark):
    lines = archive.lines_of(spark.createDataFrame([("Aug10_2026.qmd", QMD)], "file string, text string"))
    got = [(r.title, r.url, r.section, r.text, r.weight) for r in archive.entries(lines).orderBy("pos").collect()]
    assert got == [
        ("Loose", "https://x.org/0", "more", "Loose Before any section", 1.0),
        ("A *bold* title", "https://x.org/1", "featured", "A bold title First line.", 2.0),
        ("Split title", "https://x.org/2", "more", "Split title Second & last.", 1.0),
        ("No link at all", "", "more", "No link at all Body", 1.0),
    ]
    assert [(r.title, r.link) for r in archive.titles_and_links(lines).orderBy("pos").collect()] == [("Loose", "https://x.org/0"), ("A *bold* title", "https://x.org/1"), ("Split title", "https://x.org/2")]


def test_classifier_responses(spark):
    raw = ['```json\n{"score": 78, "category": "cell mechanics", "explanation": "why"}\n```', '{"score": 31, "category": "clinical genomics", "explanation": "w"}', "TRUE", "", "{broken} maybe", '{"score": 2.5, "category": "c", "explanation": "e"}', "false positive"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, raw string")
    got = [tuple(r.r)[:4] for r in df.select("i", policy.parse_response(F.col("raw")).alias("r")).orderBy("i").collect()]
    assert got == [(True, "AI Approved", 78, "cell mechanics"), (False, "AI Rejected", 31, "clinical genomics"), (True, "AI Approved", 75, "unspecified"), (False, "AI Unavailable", None, ""), (False, "AI Ambiguous Response", None, ""), (False, "AI Rejected", 2, "c"), (False, "AI Rejected", 25, "unspecified")]
    recall = df.where("i = 1").select(policy.parse_response(F.col("raw"), "AI Recall").alias("r")).first().r
    assert recall.reason == "AI Recall Rejected"


def test_recall_policy(spark):
    rows = [("Optica", "Microscopy method living cells and protein membranes", 0.05), ("Optica", "Generating quantum entanglement from sunlight", 0.05), ("bioRxiv", "Membrane dynamics", 0.05), ("bioRxiv", "Membrane dynamics", 0.049)]
    df = spark.createDataFrame(rows, "source string, title string, s double")
    assert [r[0] for r in df.select(policy.recall_supported(F.col("source"), F.col("title"), F.lit(""), F.col("s"))).collect()] == [True, False, True, False]


def test_classify_passes(spark):
    rows = [(0, "Star", "x", "y", 0.0), (1, "arXiv", "cells and forces", "", 0.1), (2, "Optica", "quantum light", "", 0.9), (3, "arXiv", "flaky cells", "", 0.1), (4, "arXiv", "nothing", "", 0.1)]
    df = spark.createDataFrame(rows, "seq long, source string, title string, abstract string, local_score double")
    strict, lax = policy.keyword_model(("cells", "forces")), lambda t, a: json.dumps({"score": 90, "category": "c", "explanation": "e"})
    out = {r.seq: r for r in policy.classify(df, F.col("source") == "Star", strict, lax, lambda f: f.persist()).collect()}
    assert [(out[i].category, out[i].reason) for i in range(5)] == [("featured", "Featured source or author"), ("regular", "AI Approved"), (None, "AI Recall Rejected by Learning Gate"), ("regular", "AI Approved"), ("regular", "AI Recall Approved")]
    assert out[0].classifier_score is None and out[4].initial_classifier_score == 30 and out[4].classifier_score == 90


def test_budget():
    b = budget.Budget(max_usd=5.0, max_requests=1000)
    for _ in range(500):
        b.finish(b.begin("short"), 0.0)
    assert b.in_flight == pytest.approx(0) and b.requests == 500
    assert budget.usage_cost(100, 20, 30) == pytest.approx(100 * 1.5e-6 + 50 * 7.5e-6)
    b.finish(cost := b.begin("x"), None)
    assert b.unreported == pytest.approx(cost)
    with pytest.raises(budget.BudgetExhausted):
        budget.Budget(max_usd=1e-9).begin("x")
    full = budget.Budget(max_requests=0)
    with pytest.raises(budget.BudgetExhausted):
        full.begin("x")
    assert full.exhausted and sum(budget.quota(10, 3, i) for i in range(3)) == 10


def test_ranking(spark):
    rows = [(0, "arXiv", "B", 0.5), (1, "Nature", "C", 0.5), (2, "Nature", "a", 0.5), (3, "bioRxiv", "D", 0.9)]
    df = spark.createDataFrame(rows, "seq long, source string, title string, local_score double")
    assert [r.seq for r in rank.ranked(df).orderBy("rank").collect()] == [3, 2, 1, 0]
    order = rank.edition_order(df.where("seq IN (0, 3)"), df.where("seq IN (1, 2)"))
    assert [(r.seq, r.section) for r in order.orderBy("place").collect()] == [(0, "featured"), (3, "featured"), (2, "more"), (1, "more")]
    full = order.withColumns({"link": F.lit("https://x"), "authors": F.lit("A"), "date": F.lit(date(2026, 8, 5)), "summary": F.lit("S_s.")})
    text = rank.edition_markdown(full, "2026-08-03", "2026-08-10").first().markdown
    parsed = archive.entries(archive.lines_of(spark.createDataFrame([("e.qmd", text)], "file string, text string")))
    assert [(r.title, r.section) for r in parsed.orderBy("pos").collect()] == [("B", "featured"), ("D", "featured"), ("a", "more"), ("C", "more")]


def _plain_scan(rows, reach):
    """file, pos, last, total, before, after, ahead, first ahead of rows (file, pos, v), over lists."""
    out = {}
    for f in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == f), key=lambda r: r[1])
        last = total = None
        for k, (_, pos, v) in enumerate(own):
            last = v if v is not None else last
            total = (total or 0) + v if v is not None else total
            here = [x[2] for x in own[k : k + reach + 1] if x[2] is not None]
            out[f, pos] = (last, total, own[k - 1][2] if k else None, own[k + 1][2] if k + 1 < len(own) else None, here[-1] if here else None, here[0] if here else None)
    return out


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_scan_in_ranges(spark, size):
    import random

    from folioscope.operators.scan import Ahead, scan

    r = random.Random(size)
    rows = [(f, pos, None if r.random() < 0.6 else r.randrange(9)) for f in ("a", "b", None) for pos in r.sample(range(-40, 400), 60 if f else 5)]
    rows += [("c", k, None) for k in range(30)] + [("d", 5, 1)]
    df = spark.createDataFrame(rows, "file string, pos long, v int").repartition(3)
    v = F.col("v")
    got = scan(df, "file", "pos", {"last": v}, {"total": v}, {"before": v}, {"after": v}, {"ahead": Ahead(v, 4), "soon": Ahead(v, 4, False)}, size)
    assert {(x.file, x.pos): tuple(x)[3:] for x in got.collect()} == _plain_scan(rows, 4)


def test_one_file_with_all_lines_is_scanned_by_many_tasks(spark):
    from folioscope.operators.scan import scan

    df = spark.range(20_000).select(F.lit("e").alias("file"), F.col("id").alias("pos"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        got = scan(df, "file", "pos", {"mark": F.when(F.col("pos") % 3_000 == 0, F.col("pos"))}, {"n": F.lit(1)}, size=250)
        sizes = got.select("mark", "n").rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
        assert sum(sizes) == 20_000 and max(sizes) < 3_000
        assert got.where("mark <> pos - pos % 3000 OR n <> pos + 1").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_lines_of_a_file_read_in_parts(spark, tmp_path):
    from folioscope.sources import files

    lines = [f"line {k} " + "x" * (k % 50) for k in range(3000)]
    (tmp_path / "Aug10_2026.qmd").write_text("\n".join(lines))
    (tmp_path / "b.md").write_text("one\n\nthree\n")
    (tmp_path / "c.txt").write_text("no")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = files.archive_lines(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 10
        got = df.orderBy("file", "pos").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.line for r in got if r.file.startswith("Aug")] == lines and [r.line for r in got if r.file == "b.md"] == ["one", "", "three"]
    assert len({(r.file, r.pos) for r in got}) == len(got)


def _nested_loops(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "NestedLoop" in plan or "Cartesian" in plan


def test_containment_by_index(spark):
    import random

    from folioscope.operators.containment import containing

    r = random.Random(2)
    letters = "abcé日𝄞 .*"
    texts = [(k, "".join(r.choice(letters) for _ in range(r.randrange(60)))) for k in range(150)] + [(900, None), (None, "abc"), (901, "")]
    words = ["".join(r.choice(letters) for _ in range(r.randrange(1, 7))) for _ in range(400)] + ["", None, "a", "ab", "𝄞", "𝄞a", "zzz", "abz"]
    df = spark.createDataFrame(texts, "id long, text string").repartition(3)
    got = containing(df, spark.createDataFrame([(w,) for w in words], "word string"), "id", "text")
    assert not _nested_loops(got)
    assert sorted(map(tuple, got.collect())) == sorted({(k, w) for k, t in texts if k is not None and t for w in words if w and w in t})
    assert containing(df, spark.createDataFrame([], "word string"), "id", "text").count() == 0
    assert containing(df.limit(0), spark.createDataFrame([("a",)], "word string"), "id", "text").count() == 0


def test_many_keywords_without_nested_loops(spark):
    import random

    r = random.Random(3)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(6, 10))) for _ in range(20_000)]
    rows = [(k, "", "S", "x" + "".join(r.choice("abcdefgh") for _ in range(40)), "", None, "", "") for k in range(200)]
    rows += [(k, "", "S", "qq", "", "QQQ", "", "") for k in (300, 301)]
    df = spark.createDataFrame([(a, b, c, t, e, ab, g, h) for a, b, c, t, e, ab, g, h in rows], "seq long, x string, source string, title string, authors string, abstract string, date string, doi string")
    keys = spark.createDataFrame([(w,) for w in [*words, "Qq Q", None]], "keyword string")
    got = joins.contains_any(df, keys)
    assert not _nested_loops(got) and got.columns == df.columns
    want = {k for k, _, _, t, _, ab, _, _ in rows if any(w in f"{t} {ab or ''}" for w in words) or "qq q" in f"{t} {ab or ''}".lower()}
    assert {x.seq for x in got.collect()} == want >= {300, 301} and len(want) < 202
    assert joins.contains_any(df, spark.createDataFrame([("",), ("zz",)], "keyword string"), few=0).count() == 202


def test_one_word_names_by_their_parts(spark):
    authors = "Ann Smithson, Bo, J. Doe"
    df = items(spark, 3, _1=dict(authors=authors), _2=dict(authors="Al Bo"))
    names = spark.createDataFrame([(n,) for n in ("Smith", "bo", "O", "Zed", "", "J. Doe", "mithso")], "name string")
    got = joins.author_matches(df, names, keep_commas=False)
    assert not _nested_loops(got)
    parts = {1: ["ann smithson", "bo", "j doe"], 2: ["al bo"], 0: ["a author"]}
    want = {(k, n) for k, own in parts.items() for n in ("Smith", "bo", "O", "Zed", "mithso") for a in own if n.lower() in a} | {(1, "J. Doe")}
    assert {tuple(x) for x in got.collect()} == want


def _plain_scores(papers, positive, negative, bigrams=True):
    import math
    import re
    from collections import Counter

    def terms(t):
        w = [x for x in re.sub(r"[^a-z0-9]+", " ", t.lower()).split() if len(x) >= 3]
        return Counter(w + [f"{a}_{b}" for a, b in zip(w, w[1:], strict=False)] * bigrams)

    docs = [terms(t) for _, t in papers] + [terms(t) for _, t, _ in positive] + [terms(t) for _, t, _ in negative]
    df = Counter(x for d in docs for x in d)
    vec = [{x: (1 + math.log(n)) * (math.log((1 + len(docs)) / (1 + df[x])) + 1) for x, n in d.items()} for d in docs]
    length = lambda v: math.sqrt(sum(x * x for x in v.values())) or 1.0

    def middle(own, rows):
        c = Counter()
        for v, (*_, w) in zip(own, rows, strict=True):
            for x, y in v.items():
                c[x] += w * y / length(v)
        return {x: y / length(c) for x, y in c.items()}

    n, m = len(papers), len(papers) + len(positive)
    p, q = middle(vec[n:m], positive), middle(vec[m:], negative)
    return {k: sum(y * (p.get(x, 0) - q.get(x, 0)) for x, y in v.items()) / length(v) for (k, _), v in zip(papers, vec, strict=False)}


@pytest.mark.parametrize("frequent", [1, 40, 10**9])
def test_scores_with_terms_frequent_and_rare(spark, frequent):
    """The same scores whether every term is shuffled, some or none."""
    import random

    r = random.Random(6)
    words = [f"word{chr(97 + k)}" for k in range(20)]
    say = lambda: " ".join(r.choice(words[: r.randrange(1, 21)]) for _ in range(r.randrange(0, 30)))
    papers = [(k, say()) for k in range(40)]
    positive, negative = [(k, say(), r.choice([1.0, 2.0])) for k in range(15)], [(k, say(), 1.0) for k in range(6)]
    frame = lambda rows, extra="": spark.createDataFrame(rows, "doc_id long, text string" + extra)
    for neg in (negative, []):
        got = tfidf.scores(frame(papers), frame(positive, ", weight double"), frame(neg, ", weight double"), frequent=frequent)
        want = _plain_scores(papers, positive, neg)
        assert {x.doc_id: pytest.approx(x.score, abs=1e-9) for x in got.collect()} == want
    assert all(x.score == 0 for x in tfidf.scores(frame(papers), frame([], ", weight double"), frame(negative, ", weight double")).collect())


@pytest.mark.parametrize("size", [64, 8 << 20])
def test_scores_in_blocks(spark, monkeypatch, size):
    """The same scores from many blocks and parts as from one; copies on all sides are cut once, and a term is asked for once a block."""
    monkeypatch.setattr(tfidf, "TEXT_BYTES", size)
    asked, blocks = [], term_blocks.blocks
    monkeypatch.setattr(term_blocks, "blocks", lambda *a: asked.append(blocks(*a).persist()) or asked[0])
    say = lambda k: " ".join(f"word{chr(97 + (k * j) % 23)}" for j in range(30))
    papers, positive, negative = [(k, say(k % 40)) for k in range(80)], [(k, say(k), 1.0 + k % 2) for k in range(12)], [(k, say(k + 7), 1.0) for k in range(9)]
    frame = lambda rows, extra="": spark.createDataFrame(rows, "doc_id long, text string" + extra)
    got = tfidf.scores(frame(papers), frame(positive, ", weight double"), frame(negative, ", weight double"))
    assert {x.doc_id: pytest.approx(x.score, abs=1e-9) for x in got.collect()} == _plain_scores(papers, positive, negative)
    held = asked[0].where("part IS NULL").select("block", F.size("doc").alias("n"), F.size("term").alias("terms"), F.size("code").alias("entries")).collect()
    assert sum(r.n for r in held) == 23 and (len(held) > 8 if size == 64 else len(held) <= 4)
    told = asked[0].where("part IS NOT NULL").groupBy("block").agg(F.sum(F.size("term")).alias("n"), F.count("*").alias("parts"))
    assert {r.block: r.n for r in told.collect()} == {r.block: r.terms for r in held} and (told.agg(F.max("parts")).first()[0] > 1) == (size == 64)
    asked[0].unpersist()


def test_blocks_are_read_a_few_megabytes_at_a_time(spark, monkeypatch):
    """A row group holds a few rows of blocks, as a reader decodes all rows of one at once; texts and counts go once they were used."""
    import pyarrow.parquet as pq

    from folioscope.sinks import shared

    bound, kept, groups = 8 << 10, [], []

    def settled(df, **options):
        kept.append(out := shared.settle(df, **options))
        if "term" in df.columns or "a" in df.columns:
            groups.append([m.row_group(k).total_byte_size for f in out.inputFiles() if (m := pq.read_metadata(f.removeprefix("file://"))) for k in range(m.num_row_groups)])
        return out

    for name, value in (("settle", settled), ("TEXT_BYTES", 2 << 10), ("GROUP_BYTES", bound)):
        monkeypatch.setattr(tfidf, name, value, raising=False)
    say = lambda k: " ".join(f"word{chr(97 + (k * j) % 23)}{chr(97 + j % 26)}{chr(97 + k % 26)}" for j in range(100))
    papers, positive = [(k, say(k)) for k in range(120)], [(k, say(k), 1.0) for k in range(0, 120, 3)]
    got = tfidf.scores(spark.createDataFrame(papers, "doc_id long, text string"), spark.createDataFrame(positive, "doc_id long, text string, weight double"), spark.createDataFrame([], "doc_id long, text string, weight double"))
    assert len(groups) == 3 and all(sum(g) > 10 * bound and max(g) < 4 * bound for g in groups)
    left = [os.path.isdir(shared._PATHS[f].removeprefix("file:")) for f in kept if f in shared._PATHS]
    assert len(kept) == 5 and left == [True] * 3
    assert {x.doc_id: pytest.approx(x.score, abs=1e-9) for x in got.collect()} == _plain_scores(papers, positive, [])


@pytest.mark.parametrize("size", [64, 8 << 20])
def test_centroid_in_blocks(spark, monkeypatch, size):
    """The same from many blocks as from one; what is written down for chosen documents has a row a block and part of the terms, for others none."""
    import math
    from collections import Counter

    monkeypatch.setattr(tfidf, "TEXT_BYTES", size)
    kept, settle = [], tfidf.settle
    monkeypatch.setattr(tfidf, "settle", lambda df, **options: kept.append((df.columns, (out := settle(df, **options)).count())) or out)
    say = lambda k: " ".join(f"word{chr(97 + (k * j) % 23)}" for j in range(30))
    docs = [(k % 70, say(k)) for k in range(80)] + [(None, say(3)), (None, "alone"), (90, None), (91, "")]
    weights = [(k, 1.0 + k % 2) for k in range(0, 70, 3)] + [(6, 3.0), (90, 1.0), (91, 1.0), (500, 1.0)]
    got = tfidf.centroid(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(weights, "doc_id long, weight double")).collect()
    tf, df, sums = {}, Counter(), Counter()
    for key, t in docs:
        w = (t or "").split()
        tf.setdefault(key, Counter()).update(w + [f"{x}_{y}" for x, y in zip(w, w[1:], strict=False)])
    for c in tf.values():
        df.update(c.keys())
    for key, weight in weights:
        v = {t: (1 + math.log(n)) * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t, n in tf.get(key, {}).items()}
        length = math.sqrt(sum(x * x for x in v.values()) * sum(k == key for k, _ in weights))
        sums.update({t: x / length * weight for t, x in v.items()})
    norm = math.sqrt(sum(c * c for c in sums.values()))
    assert {r.term: pytest.approx(r.c, abs=1e-9) for r in got} == {t: c / norm for t, c in sums.items()} and len(got) == len(sums)
    assert [("part" in columns, "term" in columns) for columns, _ in kept] == [(True, True), (False, True)] and kept[1][1] == len(sums)
    assert size == 64 or kept[0][1] <= 8
    none = tfidf.centroid(spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string"), spark.createDataFrame([(1, 1.0)], "doc_id long, weight double"))
    assert none.schema.simpleString() == "struct<term:string,c:double>" and none.isEmpty()


def test_scores_of_ids_that_repeat_or_are_null(spark):
    """Rows of one id are one document, whose words don't run on into the next row; a null id has no score, yet counts."""
    frame = lambda rows, extra="": spark.createDataFrame(rows, "doc_id long, text string" + extra)
    papers = frame([(1, "motors walk"), (1, "along tracks"), (2, "motors walk"), (None, "motors walk"), (3, None)])
    got = [(r.doc_id, round(r.score, 9)) for r in tfidf.scores(papers, frame([(7, "motors walk", 1.0)], ", weight double"), frame([], ", weight double")).collect()]
    assert sorted(got, key=str) == sorted([(1, got_1 := dict(got)[1]), (1, got_1), (2, 1.0), (3, 0.0), (None, 0.0)], key=str) and 0 < got_1 < 1


def test_a_term_of_all_documents_meets_in_no_task(spark):
    counts = spark.range(60_000).select(F.col("id").alias("doc_id"), F.explode(F.array(F.lit("everywhere"), F.concat(F.lit("t"), (F.col("id") % 3000).cast("string")))).alias("term"), F.lit(1).alias("tf"))
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = tfidf.idf(tfidf.document_counts(counts), 60_000, "df")
        got = tfidf.by_term(counts, known.drop("df"), known.where(F.col("df") > 120_000 // 1000).drop("df"))
        sizes = got.select("idf", "tf").rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
        assert sum(sizes) == 120_000 and max(sizes) < 20_000
    finally:
        for k in ("shuffle.partitions", "adaptive.enabled", "autoBroadcastJoinThreshold"):
            spark.conf.unset(f"spark.sql.{k}")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_missing_from_lines_is_containment(spark):
    lines = ["#### [A (b)](<https://x.org/1>)", "  A summary of one line. ", "see https://x.org/22/full and more", "", None, "two", "parts"]
    df = spark.createDataFrame(list(enumerate(lines)), "pos long, line string")
    values = [("https://x.org/1", "A summary of one line."), ("https://x.org/2", None), ("https://x.org/3", ""), ("https://x.org/22", "summary of"), ("", "two\nparts"), ("", "two\nother"), ("x", "of one line. "), ("(b)", "]"), ("zzz", "two"), (None, None)]
    items = spark.createDataFrame([(i, *v) for i, v in enumerate(values)] + [(None, "nowhere", "")], "seq long, link string, summary string")
    got = sorted(r.seq for r in joins.missing_from_lines(items, df, "link", "summary").collect())
    known = [t or "" for t in lines]
    want = [i for i, v in enumerate(values) if not all(any(p.strip() in t for t in known) for c in v for p in (c or "").split("\n") if p.strip())]
    assert got == want == [2, 5, 8]
    assert joins.missing_from_lines(items, df.limit(0), "link", "summary").count() == 9
    assert joins.missing_from_lines(items.limit(0), df, "link").count() == 0


def test_counting_tasks_grow_with_the_text(spark, monkeypatch):
    """A task's table of counts is bounded by the text it gets, whatever Spark makes of the shuffle's size; rows that share an id are counted together."""
    docs = spark.createDataFrame([(i % 50, f"alpha beta{i % 7} alpha") for i in range(100)] + [(None, None)], "doc_id long, text string")
    want = sorted(tfidf.term_counts(docs).collect(), key=str)
    monkeypatch.setattr(tfidf, "TEXT_BYTES", 100)
    found = tfidf.term_counts(docs)
    assert found.rdd.getNumPartitions() == tfidf.tasks_for(docs, "text") >= 15
    assert sorted(found.collect(), key=str) == want and tfidf.tasks_for(docs.limit(0), "text") == spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("index_bytes", [64 << 20, 0])
def test_words_meet_few_texts_that_dont_contain_them(spark, monkeypatch, index_bytes):
    """Every 3-gram of these words stands in every text, so what meets must not grow with texts times words; the rows are those of a plain search."""
    monkeypatch.setattr(containment, "INDEX_BYTES", index_bytes)
    words = [f"{a}{b}{c}x{a}{b}" for a in "abc" for b in "abc" for c in "abc"] + ["b", "ab", "abcab", "abcxab", "é\n" * 5, "", None, "absent word"]
    texts = [(i, " ".join(w or "" for k, w in enumerate(words[:30]) if k % 3 == i % 3) + "é\n" * (i % 7)) for i in range(30)] + [(30, None), (30, "ab"), (30, "ab"), (None, "ab")]
    t, w = spark.createDataFrame(texts, "id long, t string"), spark.createDataFrame([(x,) for x in words], "word string")
    want = {(i, x) for i, s in texts for x in words if x and s and i is not None and x in s}
    got = [tuple(r) for r in containment.containing(t, w, "id", "t").collect()]
    assert sorted(got) == sorted(want)
    numbered = w.where("word <> ''").withColumn("w", F.monotonically_increasing_id())
    index = {r.word: r.gram for r in containment.anchors(t, numbered, "t").collect()}
    assert index["é\n" * 5] in ("é\n" * 3, "\né" * 3) and index["abaxab"] == "abaxab" and "absent word" not in index
