"""Joins between publications, decisions, editions and allow-lists.

Where any of several keys may match, keys are exploded and joined by equality, and the row's verdict is pre-aggregated. Small lists become
broadcasts by Spark's own measure of their size; nothing here forces one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import candidate_keys, identity_key_parts, identity_keys
from ..functions.text import field, normal_name, split_authors, stripped, text_or_blank
from ..sinks.shared import settle
from .containment import containing
from .filters import any_contains


def exploded_keys(df: DataFrame, id_col: str, keys: Column) -> DataFrame:
    """(id, key, place) with a row per key; place 0 has the highest priority."""
    return df.select(id_col, F.posexplode(keys).alias("place", "key"))


def drop_sent(papers: DataFrame, sent: DataFrame) -> DataFrame:
    """Rows none of whose identity keys is among those of `sent` (title, link, doi).

    A row has at most one key of each kind, so a chain of anti joins tells, and what led to `papers` is planned once. Rows without a key of a
    kind get one of their own, so that they don't meet in one task.
    """
    keys = sent.select(F.explode(identity_keys(F.col("title"), F.col("link"), F.col("doi"))).alias("_key")).distinct()
    out = papers
    for part in identity_key_parts(F.col("title"), F.col("link"), F.col("doi")):
        own = F.coalesce(part, F.concat(F.lit("-"), F.col("seq").cast("string")))
        out = out.withColumn("_key", own).join(keys, "_key", "left_anti").drop("_key")
    return out


def manually_featured(papers: DataFrame, keys: DataFrame, own_keys: Column) -> DataFrame:
    """Rows one of whose keys stands in a list of keys (`key`)."""
    hit = papers.select("seq", F.explode(own_keys).alias("key")).join(keys.select("key").distinct(), "key", "left_semi").select("seq").distinct()
    return papers.join(hit, "seq", "left_semi")


def with_decisions(papers: DataFrame, decisions: DataFrame, order: str = "seq") -> DataFrame:
    """Each decision with its candidate by exact link; `matched` tells whether there is one. Of candidates with one link the last counts."""
    link = field(F.col("link"))
    last = papers.withColumn("link", link).groupBy("link").agg(F.max_by("title", order).alias("title"), F.max_by("date", order).alias("date"), F.lit(True).alias("found"))
    return decisions.withColumn("link", link).join(last, "link", "left").withColumn("matched", F.coalesce("found", F.lit(False))).drop("found")


def undecided(papers: DataFrame, decisions: DataFrame) -> DataFrame:
    """Links of candidates without a decision."""
    return papers.select(field(F.col("link")).alias("link")).distinct().join(decisions.select(field(F.col("link")).alias("link")), "link", "left_anti")


def repeated_decisions(decisions: DataFrame) -> DataFrame:
    """Links with more than one decision."""
    return decisions.groupBy(field(F.col("link")).alias("link")).agg(F.count("*").alias("n")).where("n > 1")


def frozen(papers: DataFrame, decisions: DataFrame) -> DataFrame:
    """Candidates with their one decision each; raises if a link is decided twice, or a candidate or decision is left alone."""
    if bad := repeated_decisions(decisions).limit(5).collect():
        raise ValueError(f"decided more than once: {[r['link'] for r in bad]}")
    if bad := undecided(papers, decisions).limit(5).collect():
        raise ValueError(f"without a decision: {[r['link'] for r in bad]}")
    if bad := undecided(decisions, papers).limit(5).collect():
        raise ValueError(f"without a candidate: {[r['link'] for r in bad]}")
    own = decisions.select(field(F.col("link")).alias("_link"), *(F.col(c).alias(f"decision_{c}") for c in decisions.columns if c != "link"))
    return papers.join(own, field(papers["link"]) == own["_link"]).drop("_link")


def selected_section(papers: DataFrame, edition: DataFrame) -> DataFrame:
    """Each candidate with the section of the edition it was selected for, or null: by DOI, else link, else title. Edition: (pos, title, link, section)."""
    own = exploded_keys(papers, "seq", candidate_keys(F.col("title"), F.col("link"), F.col("doi")))
    listed = exploded_keys(edition.withColumn("doi", F.lit("")).withColumn("_id", F.struct("pos", "section")), "_id", candidate_keys(F.col("title"), F.col("link"), F.lit("")))
    lookup = listed.groupBy("key").agg(F.max_by(F.col("_id.section"), F.col("_id.pos")).alias("section"))
    best = own.join(lookup, "key").groupBy("seq").agg(F.min_by("section", "place").alias("selected_section"))
    return papers.join(best, "seq", "left")


#: Keywords that are looked for in the row's own expression, at most; beyond, an index of the keywords decides which rows to look at.
FEW_KEYWORDS = 1_000


def contains_any(papers: DataFrame, keywords: DataFrame, few: int = FEW_KEYWORDS) -> DataFrame:
    """Rows whose title or abstract contains a keyword of a table (`keyword`). A keyword may be of any length; an empty one is in every text."""
    text = F.lower(F.concat_ws(" ", "title", "abstract"))
    words = keywords.where("keyword IS NOT NULL").select(F.lower("keyword").alias("word")).distinct()
    some = [r["word"] for r in words.limit(few + 1).collect()]
    if len(some) <= few:
        return papers.withColumn("_text", text).where(any_contains(F.col("_text"), some)).drop("_text")
    if not words.where("word = ''").isEmpty():
        return papers
    # texts that are alike are looked at once, and rows need no identity of their own
    told = papers.withColumns({"_text": text}).withColumn("_key", F.sha2("_text", 256))
    hit = containing(told.groupBy("_key").agg(F.min("_text").alias("_text")), words, "_key", "_text").select("_key").distinct()
    return told.join(hit, "_key", "left_semi").drop("_text", "_key")


def author_matches(papers: DataFrame, names: DataFrame, keep_commas: bool = True) -> DataFrame:
    """(seq, name) for each author of a paper who may be a person of a list: same first and last name, swapped, or an initial for the first.

    Equal last names, or swapped first and last ones, are joined by equality; names of one word are looked up by their rarest part.
    """
    authors = papers.select("seq", F.explode(split_authors(F.col("authors"))).alias("author")).select("seq", normal_name(F.col("author"), keep_commas).alias("author"))
    authors = authors.withColumn("parts", F.split("author", " ")).withColumns({"first": F.get("parts", F.lit(0)), "last": F.element_at("parts", -1), "n": F.size("parts")})
    listed = names.select("name", normal_name(F.col("name"), keep_commas).alias("g")).withColumn("g_parts", F.split("g", " "))
    listed = listed.withColumns({"g_first": F.get("g_parts", F.lit(0)), "g_last": F.element_at("g_parts", -1), "g_n": F.size("g_parts")})
    full, one = listed.where("g_n >= 2"), listed.where("g_n < 2 AND g <> ''")
    initial = ((F.length("g_first") == 1) & F.startswith(F.col("first"), F.col("g_first"))) | ((F.length("first") == 1) & F.startswith(F.col("g_first"), F.col("first")))
    several = authors.where("n >= 2")
    by_last = several.join(full, several["last"] == full["g_last"]).where((F.col("first") == F.col("g_first")) | initial)
    swapped = several.join(full, (several["last"] == full["g_first"]) & (several["first"] == full["g_last"]))
    # a name of one word may be any part of an author's name
    found = containing(authors.select("author").distinct().withColumn("whole", F.col("author")), one.select(F.col("g").alias("word")), "whole", "author")
    single = authors.join(found, authors["author"] == found["whole"]).join(one, F.col("word") == one["g"])
    return by_last.select("seq", "name").unionByName(swapped.select("seq", "name")).unionByName(single.select("seq", "name")).distinct()


def verified_orcid(matches: DataFrame, orcids: DataFrame) -> DataFrame:
    """Adds `verdict`: verified, not_found or error, for matches (doi, orcid) against looked-up ORCIDs (doi, orcids; null after a failed lookup)."""
    found = F.exists("orcids", lambda o: F.contains(o, F.col("orcid")))
    verdict = F.when((F.coalesce("doi", F.lit("")) == "") | F.col("orcids").isNull(), "error").when(found, "verified").otherwise("not_found")
    return matches.join(orcids, "doi", "left").withColumn("verdict", verdict).drop("orcids")


def trusted(verdict: Column, orcid: Column) -> Column:
    """A name without ORCID, one that was verified, or one whose lookup failed."""
    return orcid.isNull() | verdict.isin("verified", "error")


def with_score(papers: DataFrame, scores: DataFrame, key: Column) -> DataFrame:
    """Adds `local_score` by key, 0 where there is none."""
    return papers.withColumn("_key", key).join(scores.select(F.col("key").alias("_key"), F.col("score").alias("_score")), "_key", "left").withColumn("local_score", F.coalesce("_score", F.lit(0.0))).drop("_key", "_score")


def without_featured(regular: DataFrame, featured: DataFrame) -> DataFrame:
    """Regular rows whose title isn't featured too, in any case."""
    titles = featured.select(F.lower("title").alias("_t")).distinct()
    return regular.join(titles, F.lower(regular["title"]) == titles["_t"], "left_anti")


def by_link_else_title(papers: DataFrame, known: DataFrame, *values: str) -> DataFrame:
    """Values of the record with the same link, else the same title. Known: (link, title, pos, values); the last of equals counts."""
    def lookup(key: str) -> DataFrame:
        return known.where(F.col(key) != "").groupBy(F.col(key).alias(f"_{key}")).agg(*(F.max_by(v, "pos").alias(f"{key}_{v}") for v in values))

    out = papers
    for key in ("link", "title"):
        out = out.join(lookup(key), F.col(key) == F.col(f"_{key}"), "left").drop(f"_{key}")
    return out.withColumns({v: F.coalesce(f"link_{v}", f"title_{v}") for v in values}).drop(*(f"{k}_{v}" for k in ("link", "title") for v in values))


def overridden(papers: DataFrame, scraped: DataFrame, key: str = "link") -> DataFrame:
    """Authors and abstract of the page win where it states them; its DOI only fills a gap."""
    own = scraped.select(F.col(key), *(F.col(c).alias(f"_{c}") for c in ("authors", "abstract", "doi")))
    return papers.join(own, key, "left").withColumns({"authors": F.coalesce("_authors", "authors"), "abstract": F.coalesce("_abstract", "abstract"), "doi": F.coalesce("doi", "_doi")}).drop("_authors", "_abstract", "_doi")


def missing_from_text(items: DataFrame, document: str, *columns: str) -> DataFrame:
    """Items one of whose columns doesn't stand in a document, which is one text of an edition's size."""
    lost = F.lit(False)
    for c in columns:
        lost |= ~F.lit(document).contains(F.col(c))
    return items.where(lost)


def missing_from_lines(items: DataFrame, lines: DataFrame, *columns: str, id_col: str = "seq") -> DataFrame:
    """Items one of whose columns doesn't stand in a document that lies as a table of lines (pos, line), however long it is.

    A rendered edition shows a link as the target of a heading and a summary as a line of its own, so nearly all is settled by equality; only what isn't
    is looked for inside the lines, by the index of `containment`. Of a value with line breaks each line that isn't blank has to stand somewhere. Null and blank
    values stand everywhere; items without an id are not judged.
    """
    parts = F.filter(F.flatten(F.array(*(F.split(text_or_blank(F.col(c)), r"\r?\n") for c in columns))), lambda v: stripped(v) != "")
    asked = items.select(F.col(id_col).alias("_id"), F.explode(F.transform(parts, stripped)).alias("word"))
    rendered = F.concat(F.array(stripped(text_or_blank(F.col("line")))), F.regexp_extract_all("line", F.lit(r"\]\(<?([^<>()\s]+)>?\)"), 1))
    whole = lines.select(F.explode(rendered).alias("word")).distinct()
    open_ = settle(asked.select("word").distinct().join(whole, "word", "left_anti"))
    inside = containing(lines, open_, "pos", "line").select("word").distinct()
    lost = asked.join(open_.join(inside, "word", "left_anti"), "word").select("_id").distinct()
    return items.join(lost, items[id_col] == lost["_id"], "left_semi")
