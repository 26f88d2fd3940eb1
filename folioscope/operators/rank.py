"""Ranking and rendering of an edition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import escape_markdown, link_target


def newest_first(papers: DataFrame) -> DataFrame:
    return papers.orderBy(F.desc("date"), "seq")


def ranked(regular: DataFrame, preprints: Sequence[str] = ("arXiv", "bioRxiv"), by: Sequence[str] = ()) -> DataFrame:
    """Adds `rank`: by score, journals before preprints, then title; within each edition, if rows of several are told apart by `by`.

    An edition is one week's selection, so a window over one holds a few hundred rows.
    """
    order = Window.partitionBy(*by).orderBy(F.desc("local_score"), F.col("source").isin(*preprints).asc(), F.lower("title"), "seq")
    return regular.withColumn("rank", F.row_number().over(order))


def edition_order(featured: DataFrame, regular: DataFrame, preprints: Sequence[str] = ("arXiv", "bioRxiv"), by: Sequence[str] = ()) -> DataFrame:
    """Featured rows in order of arrival, then regular ones by rank: adds `section` and `place`."""
    first = featured.withColumn("section", F.lit("featured")).withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy("seq")))
    rest = ranked(regular, preprints, by).withColumn("section", F.lit("more"))
    both = first.unionByName(rest, allowMissingColumns=True)
    return both.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(F.when(F.col("section") == "featured", 0).otherwise(1), "rank"))).drop("rank")


def source_counts(papers: DataFrame) -> DataFrame:
    return papers.groupBy("source").agg(F.count("*").alias("n"))


def source_line(papers: DataFrame) -> DataFrame:
    """One row: sources with their counts, the most frequent first."""
    counted = source_counts(papers).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "source"))).alias("all"))
    return counted.select(F.array_join(F.transform("all", lambda s: F.concat(s["source"], F.lit(": "), (-s["m"]).cast("string"))), ", ").alias("line"))


def entry_markdown(title: Column, link: Column, authors: Column, source: Column, date: Column, summary: Column) -> Column:
    """A heading with a link, a line of authors, source and date ending in a break, and the summary."""
    head = F.concat(F.lit("#### ["), escape_markdown(title), F.lit("]("), link_target(link), F.lit(")"))
    about = F.concat(F.lit("**"), escape_markdown(source), F.lit("** · "), F.date_format(date, "yyyy-MM-dd"), F.lit(" · "), escape_markdown(authors), F.lit(" <br>"))
    return F.concat_ws("\n\n", head, F.concat_ws("\n", about, escape_markdown(summary)))


def edition_markdown(items: DataFrame, window_start: str, window_end: str, *by: str) -> DataFrame:
    """One row: the edition's text; or a row for each edition that the columns in `by` tell apart. Items: publications with summary, section and place."""
    entry = entry_markdown(F.col("title"), F.col("link"), F.col("authors"), F.col("source"), F.col("date"), F.col("summary"))

    def part(section: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(section, F.struct("place", entry.alias("text"))))), lambda x: x["text"]), "\n\n")

    head = F.concat(F.lit('---\ntitle: "'), F.date_format(F.lit(window_start).cast("date"), "MMM d yy"), F.lit(f'"\nedition_id: "{window_start}"\nwindow_end_date: "{window_end}"\n---'))
    both = items.groupBy(*by).agg(part(F.col("section") == "featured").alias("f"), part(F.col("section") != "featured").alias("m"))
    return both.select(*by, F.concat_ws("\n\n", head, F.lit("# Featured Papers"), F.col("f"), F.lit("## More Papers"), F.concat(F.col("m"), F.lit("\n"))).alias("markdown"))
