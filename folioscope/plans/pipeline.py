"""The engine's programs: ingest, score, curate, validate, repair, record, backfill. Each is one lazily built plan, except where a model is
asked or a gate must hold before anything is written."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import dates, keys, text
from ..operators import archive, dedup, feedback, filters, joins, policy, quality, rank, tfidf
from ..sinks.shared import settle


def union_stages(stages: Sequence[DataFrame]) -> DataFrame:
    """All sources in their fixed order; `seq` grows from stage to stage and within each, with gaps."""
    tagged = [s.drop("seq").withColumn("seq", F.monotonically_increasing_id() + F.lit(k << 58)) for k, s in enumerate(stages)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def ingest(papers: DataFrame, sent: DataFrame, end: Column, featured: Column, preprints: Sequence[str] = ("arXiv", "bioRxiv"), green_names: Sequence[str] = (), days: int = 7) -> DataFrame:
    """Candidates of an edition, the newest first.

    The order of steps is part of the result: an earlier copy outside the window may win over one inside it, and is then dropped with it, so
    the date gate stays behind the windows.
    """
    rows = papers.where(filters.enough_authors(F.col("source"), F.col("authors"), preprints, green_names))
    rows = dedup.by_title(dedup.by_doi(rows, featured), featured)
    rows = rows.where(dates.in_window(F.col("date"), end, days))
    return rank.newest_first(joins.drop_sent(rows, sent))


def score(papers: DataFrame, training: DataFrame, votes: DataFrame) -> DataFrame:
    """(key, score) of candidates against past selections (title, text, weight) and reader votes."""
    rated = feedback.preferences(votes)
    positive = training.select("text", "weight").unionByName(rated.where("polarity = 'positive'").select("text", "weight"))
    negative = rated.where("polarity = 'negative'").select("text", "weight")
    # repeated documents count each; their numbers are written down, as they must not change between uses
    numbered = [settle(d.withColumn("doc_id", F.monotonically_increasing_id())) for d in (positive, negative)]
    own = papers.select(F.col("seq").alias("doc_id"), text.paper_text(F.col("title"), F.col("abstract"), F.col("source")).alias("text"))
    scored = tfidf.scores(own, *numbered)
    keyed = papers.select(F.col("seq").alias("doc_id"), keys.paper_key(F.col("title"), F.col("link"), F.col("doi")).alias("key"))
    return dedup.latest_by(scored.join(keyed, "doc_id"), "key", "doc_id", "score")


def curate(candidates: DataFrame, scores: DataFrame, featured: Column, edition_date: Column, model: policy.Model, recall_model: policy.Model, keep: Callable[[DataFrame], DataFrame], settings: Settings | None = None, summary_model: policy.Model | None = None, ledger: policy.Ledger | None = None) -> tuple[DataFrame, DataFrame]:
    """The edition's items in order, and the decision on every candidate. Raises where a gate doesn't hold.

    Metered models, the summarizer too, spend from one ledger; without one it is made over the first model's budget.
    """
    s = settings or Settings()
    if ledger is None and (own := next((m.budget for m in (model, recall_model, summary_model) if isinstance(m, policy.Metered)), None)):
        ledger = policy.Ledger(candidates.sparkSession, own)
    kept, _ = quality.sanitize(candidates, edition_date, s.min_abstract_chars)
    kept = keep(joins.with_score(kept, scores, keys.paper_key(F.col("title"), F.col("link"), F.col("doi"))))
    n = kept.count()
    if n < s.min_edition_papers:
        raise quality.EditionRejected(f"{n} valid candidates; minimum is {s.min_edition_papers}")
    results = keep(policy.classify(kept, featured, model, recall_model, keep, s.classifier_partitions, s.repair_partitions, s.classifier_score_threshold, s.recall_min_local_score, ledger))
    state = policy.health(results).first()
    if state["failures"] > state["allowed"]:
        raise quality.EditionRejected(f"{state['failures']} of {state['attempts']} classifications failed; {state['allowed']} may")
    if summary_model:
        told = keep(policy.summarize(results.where("category IS NOT NULL"), summary_model, s.classifier_partitions, ledger))
        if ledger and isinstance(summary_model, policy.Metered):
            ledger.record("summary", told)
        told = told.select("seq", "summary")
        results = results.join(told, "seq", "left").withColumn("summary", F.coalesce("summary", F.lit("")))
    else:
        results = results.withColumn("summary", F.when(F.col("category").isNotNull(), text.extractive_summary(F.col("abstract"))).otherwise(F.lit("")))
    first = results.where("category = 'featured'")
    items = rank.edition_order(first, joins.without_featured(results.where("category = 'regular'"), first))
    quality.require_clean(quality.edition_issues(items, edition_date, s.min_edition_papers, n, s.min_selection_fraction, s.min_abstract_chars))
    label = F.coalesce("category", F.lit("rejected"))
    return items, results.withColumn("label", label).withColumn("classifier_reason", F.col("reason")).withColumn("classifier_threshold", F.lit(s.classifier_score_threshold)).withColumn("score_policy", F.lit(s.score_policy_version))


def validate(papers: DataFrame, decisions: DataFrame, document: str | DataFrame, edition_date: Column, least: int = 50) -> DataFrame:
    """Issues of finished artifacts, from the artifacts alone, as rows. The document is one text, or a table of its lines (pos, line), which no task needs whole."""
    accepted = decisions.where(F.lower("label").isin("featured", "regular"))
    chosen = joins.with_decisions(papers, accepted)
    lost = chosen.where("NOT matched").select(F.concat(F.lit("no candidate for "), "link").alias("issue"))
    items = papers.join(accepted.select(text.field(F.col("link")).alias("_l"), "summary"), text.field(papers["link"]) == F.col("_l")).drop("_l")
    own = quality.edition_issues(items, edition_date, least).select("issue")
    if isinstance(document, str):
        absent, headings = joins.missing_from_text(items, document, "link", "summary"), items.sparkSession.range(1).select(F.lit(sum(line.strip().startswith("#### ") for line in document.split("\n"))).cast("long").alias("headings"))
    else:
        absent, headings = joins.missing_from_lines(items, document, "link", "summary"), document.agg(F.count_if(F.startswith(text.stripped(F.col("line")), F.lit("#### "))).alias("headings"))
    told = absent.select(F.concat(F.lit("not in the document: "), text.field(F.col("title"))).alias("issue"))
    # one row each: two counts
    counts = items.agg(F.count("*").alias("n")).join(F.broadcast(headings)).where("n <> headings")
    return lost.unionByName(own).unionByName(told).unionByName(counts.select(F.concat(F.col("headings").cast("string"), F.lit(" headings for "), F.col("n").cast("string"), F.lit(" items")).alias("issue")))


def taken_back(rows: DataFrame) -> DataFrame:
    """Frozen rows with their label, reason and summary, where a recall approval that the policy no longer supports is a rejection."""
    supported = policy.recall_supported(F.col("source"), F.col("title"), F.col("abstract"), F.coalesce("decision_local_score", F.lit(0.0)))
    back = (F.col("decision_classifier_reason") == "AI Recall Approved") & ~supported
    return rows.withColumns({"label": F.when(back, "rejected").otherwise(F.col("decision_label")), "reason": F.when(back, "AI Recall Rejected by Learning Gate").otherwise(F.col("decision_classifier_reason")), "summary": F.when(back, "").otherwise(F.col("decision_summary")), "local_score": F.coalesce("decision_local_score", F.lit(0.0))})


def repair(papers: DataFrame, decisions: DataFrame, edition_date: Column, preprints: Sequence[str] = ("arXiv", "bioRxiv", "medRxiv"), least: int = 50) -> DataFrame:
    """A frozen edition derived again without a model: recall approvals that the policy no longer supports are taken back."""
    rows = taken_back(joins.frozen(papers, decisions))
    items = rank.edition_order(rows.where("label = 'featured'"), rows.where("label = 'regular'"), preprints)
    quality.require_clean(quality.edition_issues(items, edition_date, least))
    return items


def record_final(papers: DataFrame, edition_lines: DataFrame, week: str, run_date: str) -> DataFrame:
    """Every candidate with the section it was finally selected for, and its weight as training data."""
    found = joins.selected_section(papers, archive.entries(edition_lines).withColumnRenamed("url", "link"))
    section = F.col("selected_section")
    return found.select(F.lit(run_date).alias("run_date"), F.lit(week).alias("week"), F.when(section.isNull(), "rejected").otherwise("selected").alias("label"), section, text.section_weight(section).alias("training_weight"), "source", "title", "authors", "link", "doi", "abstract")


def label_history(snapshots: DataFrame, edition_lines: DataFrame) -> DataFrame:
    """Past candidates, each week's from its last snapshot, with the section they were selected for. Snapshots: (week, commit, commit_no, publications); lines: (week, pos, line)."""
    last = dedup.latest_by(snapshots.select("week", "commit", "commit_no").distinct(), "week", "commit_no", "commit")
    rows = snapshots.join(last, ["week", "commit"], "left_semi")
    listed = archive.entries(edition_lines.withColumnRenamed("week", "file")).select(F.col("file").alias("week"), "pos", "title", F.col("url").alias("link"), "section")
    own = rows.select("week", "seq", F.posexplode(keys.candidate_keys(F.col("title"), F.col("link"), F.col("doi"))).alias("place", "key"))
    theirs = listed.select("week", "pos", "section", F.explode(keys.candidate_keys(F.col("title"), F.col("link"), F.lit(""))).alias("key")).groupBy("week", "key").agg(F.max_by("section", "pos").alias("section"))
    best = own.join(theirs, ["week", "key"]).groupBy("week", "seq").agg(F.min_by("section", "place").alias("selected_section"))
    return rows.join(best, ["week", "seq"], "left").withColumn("label", F.when(F.col("selected_section").isNull(), "rejected").otherwise("selected")).withColumn("training_weight", text.section_weight(F.col("selected_section")))


def backfill(entries: DataFrame, saved: DataFrame, history: DataFrame, arxiv: DataFrame, pages: DataFrame, start: Column, end: Column) -> DataFrame:
    """(title, link, source, date) of an archive's entries: saved, historical, spelled out by a preprint's DOI, looked up, stated by its page.

    saved: (link, title, pos, source, date); history: (link, title, pos, date); arxiv: (arxiv_id, date); pages: (link, html).
    """
    rows = joins.by_link_else_title(entries, saved.withColumnRenamed("date", "saved_date").withColumnRenamed("source", "saved_source"), "saved_date", "saved_source")
    rows = joins.by_link_else_title(rows, history.withColumnRenamed("date", "history_date"), "history_date")
    rows = rows.withColumn("arxiv_id", keys.arxiv_key_id(F.col("link"))).join(arxiv.withColumnRenamed("date", "arxiv_date"), "arxiv_id", "left")
    known = F.coalesce(dates.normalized_date(F.col("saved_date")), dates.normalized_date(F.col("history_date")), dates.preprint_link_date(F.col("link")), dates.normalized_date(F.col("arxiv_date")))
    rows = rows.withColumn("known", known)
    stated = dates.preferred_date(F.transform(dates.metadata_dates(F.col("html")), dates.normalized_date), start, end)
    # pages are read for what nothing else dates
    paged = rows.where("known IS NULL").select("link").distinct().join(pages, "link").groupBy("link").agg(F.max(stated).alias("page_date"))
    rows = rows.join(paged, "link", "left")
    return rows.select("title", "link", F.coalesce(F.nullif("saved_source", F.lit("")), keys.source_of_url(F.col("link"))).alias("source"), F.coalesce("known", "page_date").alias("date"))
