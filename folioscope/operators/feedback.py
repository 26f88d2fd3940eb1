"""Reader votes as training data and as a prompt's context."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clip, known, squashed, strip_markdown


def preferences(votes: DataFrame) -> DataFrame:
    """Votes (title, summary, source, link, upvotes, downvotes) with a preference, a downvote counting twice: adds polarity, weight and text."""
    score = F.coalesce("upvotes", F.lit(0)) - 2 * F.coalesce("downvotes", F.lit(0))
    text = strip_markdown(F.concat_ws(" ", known(F.col("title")), known(F.col("summary")), known(F.col("source"))))
    rated = votes.withColumn("preference", score).withColumn("text", text).where("preference <> 0 AND text <> ''")
    return rated.withColumn("polarity", F.when(F.col("preference") > 0, "positive").otherwise("negative")).withColumn("weight", F.abs("preference").cast("double"))


def strongest(votes: DataFrame, n: int = 12) -> DataFrame:
    """(polarity, rank, title, strength): the n strongest preferences each way, ties by title."""
    title = clip(squashed(known(F.col("title"))), 240)
    score = F.coalesce("upvotes", F.lit(0)) - 2 * F.coalesce("downvotes", F.lit(0))
    rated = votes.select(title.alias("title"), score.alias("preference")).where("preference <> 0 AND title <> ''")
    rated = rated.select(F.when(F.col("preference") > 0, "positive").otherwise("negative").alias("polarity"), "title", F.abs("preference").alias("strength"))
    nth = F.row_number().over(Window.partitionBy("polarity").orderBy(F.desc("strength"), F.lower("title"), "title"))
    return rated.withColumn("rank", nth).where(F.col("rank") <= n).select("polarity", "rank", "title", "strength")


def context(votes: DataFrame, n: int = 12) -> DataFrame:
    """One row: the strongest preferences as the text of a prompt."""
    sign = F.when(F.col("polarity") == "positive", "+").otherwise("-")
    line = F.concat(F.lit("- "), "title", F.lit(" (weighted "), sign, F.col("strength").cast("string"), F.lit(")"))
    rows = strongest(votes, n).withColumn("line", line)

    def listed(polarity: str):
        own = F.collect_list(F.when(F.col("polarity") == polarity, F.struct("rank", "line")))
        return F.array_join(F.transform(F.array_sort(own), lambda x: x["line"]), "\n")

    def or_none(c):
        return F.when(c == "", F.lit("- None yet")).otherwise(c)

    both = rows.agg(listed("positive").alias("p"), listed("negative").alias("n"))
    return both.select(F.concat(F.lit("MORE LIKE THESE:\n"), or_none(F.col("p")), F.lit("\n\nDOES NOT BELONG:\n"), or_none(F.col("n"))).alias("context"))
