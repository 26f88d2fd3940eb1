from datetime import date, datetime

import pytest
from folioscope.functions import dates, html, keys, text
from pyspark.sql import functions as F


@pytest.fixture
def ask(spark):
    def get(*columns):
        row = spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first()
        return row[0] if len(columns) == 1 else tuple(row)

    return get


def L(v):
    return F.lit(v)


def test_markup(ask):
    assert ask(text.strip_markdown(L("<i>A</i> [link](http://x) **b** &amp; c_d  e"))) == "A link b & c d e"
    assert ask(text.strip_markup(L("A \\*b\\* &lt;c&gt; &#39;d&quot;"))) == "A *b* <c> 'd\""
    assert ask(text.escape_markdown(L("a\\b*c_d[e]\nf`"))) == "a\\\\b\\*c\\_d\\[e\\] f\\`"
    assert ask(text.link_target(L(" http://x ")), text.link_target(L(None).cast("string"))) == ("<http://x>", "#")
    assert ask(text.repair_xml(L("a & b &amp; &#1; &x;"))) == "a &amp; b &amp; &#1; &amp;x;"
    assert ask(text.squashed(L(" a \n\tb "))) == "a b"


def test_names(ask):
    assert ask(text.clean_author(L("jo@x.org (Jo Doe)")), text.clean_author(L("(Jo  Doe)")), text.clean_author(L("Jo jo@x.org"))) == ("Jo Doe", "Jo Doe", "Jo")
    assert ask(text.split_authors(L("A, B; C ;")), text.split_authors(L("A, B,")), text.split_authors(L(None).cast("string"))) == (["A, B", "C"], ["A", "B"], [])
    assert ask(text.normal_name(L("José-María O'Neil, Jr.")), text.normal_name(L("Doe, J."), False)) == ("jose maria o neil, jr", "doe j")
    assert ask(text.distinct_authors(F.array(L("A"), L("a"), L("B"), L("A")))) == ["A", "B"]


def test_terms(ask):
    assert ask(text.terms(L("The Cells use new *force* in cells"))) == ["cells", "force", "cells", "cells_force", "force_cells"]
    assert ask(text.terms(L("a")), text.bigrams(F.array(L("x")))) == ([], [])


def test_summary(ask):
    assert ask(text.extractive_summary(L("  "))) == "Summary unavailable."
    assert ask(text.extractive_summary(L("Short one. " + "x" * 50 + "! More."))) == "Short one. " + "x" * 50 + "!"
    assert ask(text.extractive_summary(L("y" * 400))) == "y" * 360 + "…"


def test_abstract_cleaners(ask):
    assert ask(text.clean_preprint_abstract(L("Text  Graphical Abstract x")), text.clean_preprint_abstract(L("TOC Graphic only"))) == ("Text", "TOC Graphic only")
    assert ask(text.clean_break_abstract(L("A, B<br/>The <b>body</b>. [Opt. Express 1, 2 (2026)]<BR>rest"))) == "The body."
    assert ask(text.drop_boilerplate(L("Nature Physics, Published online: 1 May 2026; doi:10.1038/x Body here"), "nature")) == "Body here"


def test_keys(ask):
    assert ask(keys.normalize_doi(L("https://dx.doi.org/10.1000/AbC.1).,")), keys.normalize_doi(L("no")), keys.normalize_doi_lower(L("doi: 10.1000/AbC]"))) == ("10.1000/AbC.1", None, "10.1000/abc")
    assert ask(keys.normalize_link(L(" <HTTPS://X.org/a/?rss=yes> ")), keys.normalize_link(L("https://x.org/a/#frag"))) == ("https://x.org/a", "https://x.org/a")
    assert ask(keys.identity_keys(L("Zürich 2!"), L("https://arxiv.org/pdf/2601.00001v3.pdf"), L("https://doi.org/10.1/X?y"))) == ["title:zürich2", "doi:10.1/x", "arxiv:2601.00001"]
    null = L(None).cast("string")
    assert ask(keys.identity_keys(L("?"), L(""), L("nothing"))) == []
    assert ask(keys.paper_key(L("T 1"), L("HTTP://x"), L("https://doi.org/10.1/A")), keys.paper_key(L("T"), L("HTTP://x"), L("null")), keys.paper_key(L("T 1"), null, null)) == ("doi:10.1/a", "link:http://x", "title:t1")
    assert ask(keys.paper_key(L("T"), L("https://x"), L("nothing"))) == "link:https://x"
    assert ask(keys.candidate_keys(L("A b"), L("https://doi.org/10.1234/Z"), L("10.1234/z"))) == ["doi:10.1234/z", "link:https://doi.org/10.1234/z", "title:ab"]
    assert ask(keys.arxiv_link_id(L("http://arxiv.org/abs/2601.00001v2")), keys.arxiv_link_id(L("x/y/hep-th9901001v1"))) == ("2601.00001", "hep-th9901001")
    assert ask(keys.source_of_url(L("https://www.biorxiv.org/x")), keys.source_of_url(L("not a url")), keys.source_of_url(L("<https://pubs.acs.org/y>"))) == ("bioRxiv", "", "pubs.acs.org")
    assert ask(keys.doi_of_link_or_html(L("https://www.nature.com/articles/s41-x?a"), L("")), keys.doi_of_link_or_html(L("x"), L('"doi" : "10.5555/q).'))) == ("10.1038/s41-x", "10.5555/q")


def test_dates(ask):
    d = date(2026, 8, 10)
    assert ask(*(dates.in_window(L(x).cast("date"), L(d)) for x in ("2026-08-02", "2026-08-03", "2026-08-10", "2026-08-11"))) == (False, True, True, False)
    pub = lambda day, source, link: dates.publication_date(L(day), L(source), L(link))
    assert ask(pub("2026-08-05T00:00:00+00:00", "bioRxiv", "https://www.biorxiv.org/content/10.1101/2023.08.22.554088v2")) == date(2023, 8, 22)
    assert ask(pub("2026-08-05", "CrossRef/Featured", "https://doi.org/10.64898/2026.07.31.742166")) == date(2026, 7, 31)
    assert ask(pub("2026-08-05", "x", "https://x/2026.07.31.1")) == date(2026, 8, 5)
    assert ask(pub("2026-08-05", "bioRxiv", "https://x/10.1101/2026.13.41.1v1"), pub("soon", "x", "")) == (date(2026, 8, 5), None)
    feed = lambda *t: dates.feed_date(*map(L, t))
    assert ask(feed("", "Mon, 02 Feb 2026 03:04:05 GMT"), feed("2026-02-03T04:05:06-05:00"), feed("2026-2-4"), feed("soon")) == (datetime(2026, 2, 2, 3, 4, 5), datetime(2026, 2, 3, 4, 5, 6), datetime(2026, 2, 4), None)
    assert ask(dates.date_of_parts(F.array(L(2026)))) == date(2026, 1, 1)
    assert ask(dates.normalized_date(L("on 2026/2/3,")), dates.normalized_date(L("2026-02-31")), dates.normalized_date(L("May 5, 2026")), dates.normalized_date(L("2026-02-01T01:02:03Z"))) == (date(2026, 2, 3), None, date(2026, 5, 5), date(2026, 2, 1))
    assert ask(dates.archive_name(L(d)), dates.archive_window_end(L("Aug10_2026.qmd")), dates.title_date(L(d)), dates.monday(L(date(2026, 8, 16)))) == ("Aug10_2026.qmd", d, "Aug 10 26", d)
    assert ask(dates.date_of_title(L('title: "Aug 3 26"')), dates.date_of_title(L('title: "Aug 3 2026"'))) == (date(2026, 8, 3), date(2026, 8, 3))
    out = F.array(*(L(x).cast("date") for x in ("2026-07-01", "2026-08-20", "2026-08-01")))
    assert ask(dates.preferred_date(out, L(date(2026, 8, 3)), L(d))) == date(2026, 8, 1)
    assert ask(dates.preprint_link_date(L("https://www.medrxiv.org/content/10.1101/2026.05.04.1v1")), dates.preprint_link_date(L("https://x/2026.05.04.1"))) == (date(2026, 5, 4), None)


def test_html():
    assert html.plain("<p>a&amp;b</p><script>x</script><div>c <b>d</b></div>") == "a&b c d"
    got = html.physics_abstract('<img src="//x/i.png"><p>Author(s): A. B and C. D</p><p>Extraordinarilylongfirstword follows. [Phys. Rev. X 1, 2]</p>')
    assert got == {"abstract": "Extraordinarilylongfirstword follows.", "images": ["https://x/i.png"]}
    got = html.chemistry_abstract('<div>Soft Matter, 2026</div><div><img src="http://p.rsc.org/services/ImageService/image/GA?id=1">A. B, C. D<br/>The abstract.<br/>The content of this RSS Feed (c)</div>')
    assert got == {"abstract": "The abstract.", "authors": "A. B, C. D", "images": ["https://p.rsc.org/services/ImageService/image/GA?id=1"]}
    page = html.page_metadata('<meta name="DC.creator" content=" A "><meta name="citation_doi" content="doi:10.1000/x."><script type="application/ld+json">{"mainEntity": {"author": [{"name": "Z"}], "description": "%s"}}</script>' % ("d" * 60))
    assert page == {"authors": ["A"], "abstract": "d" * 60, "article_type": None, "doi": "10.1000/x"}


def test_html_references_cut_off(spark):
    cut = "<h1>a&amp;&amp</h1><p>&quot;x&am&copy;&ampb; &#65; &#65 &lt</p>"
    assert html.plain(cut, ended=True) == 'a&&amp "x&am©&ampb; A &#65 &lt'
    assert html.plain(cut) == 'a&& "x&am©&b; A A <' and html.plain(None, ended=True) == ""
    assert [r[0] for r in spark.createDataFrame([("<p>x&amp</p>",), (None,)], "h string").select(html.ended_html_to_text("h")).collect()] == ["x&amp", ""]
