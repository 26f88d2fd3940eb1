"""Entity resolution by priority: one winner per key by row_number, which Spark limits per group before the shuffle (WindowGroupLimit), so
a hot key costs each task one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import stripped, text_or_blank


def first_by(df: DataFrame, key: Column, order: Sequence[Column], pass_blank: bool = False) -> DataFrame:
    """The first row of each key in the given order. Rows without a key pass through; `pass_blank`: so do those with a blank one."""
    keyed = df.withColumn("_key", key)
    has = F.col("_key").isNotNull()
    if pass_blank:
        has = has & (F.col("_key") != "")
    # rows without a key get one of their own, so they neither meet in one task nor need a second scan
    own = F.when(has, F.concat(F.lit("k"), "_key")).otherwise(F.concat(F.lit("u"), F.xxhash64("seq").cast("string"), F.lit("/"), F.col("seq").cast("string")))
    nth = F.row_number().over(Window.partitionBy("_own").orderBy(*order))
    return keyed.withColumn("_own", own).withColumn("_nth", nth).where("_nth = 1").drop("_key", "_own", "_nth")


def by_doi(papers: DataFrame, featured: Column) -> DataFrame:
    """Per DOI: a featured row, then the earliest, then the first seen. Rows without a DOI pass."""
    return first_by(papers, F.lower("doi"), [featured.desc(), F.col("date").asc(), F.col("seq").asc()])


def by_title(papers: DataFrame, featured: Column, blank_is_unique: bool = True) -> DataFrame:
    """Per ASCII title key: a featured row, then the earliest, then the first seen. Titles without an ASCII letter or digit are told
    apart, unless a history in which they all fall together has to be repeated."""
    key = F.regexp_replace(F.lower(text_or_blank(F.col("title"))), "[^a-z0-9]", "")
    return first_by(papers, key, [featured.desc(), F.col("date").asc(), F.col("seq").asc()], blank_is_unique)


def by_first_posted(papers: DataFrame) -> DataFrame:
    """Preprint versions: the earliest per DOI, or title where there is none; the first seen on ties."""
    key = F.lower(F.coalesce("doi", stripped(F.col("title"))))
    return first_by(papers, key, [F.col("date").asc(), F.col("seq").asc()])


def by_first_seen(papers: DataFrame) -> DataFrame:
    return first_by(papers, F.coalesce("doi", F.lower("title")), [F.col("seq").asc()])


def latest_by(df: DataFrame, key: str, order: str, *values: str) -> DataFrame:
    """The last value of each key, in the given order."""
    return df.groupBy(key).agg(*(F.max_by(v, order).alias(v) for v in values))
