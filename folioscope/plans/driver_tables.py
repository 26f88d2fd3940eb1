"""Publications and their like, derived from general-purpose tables, so that every operator can run on those."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The day on which the derived edition ends.
EDITION = "2026-08-10"

PAPERS_SQL = """papers AS (
  SELECT doc_id AS seq, source, split_part(text, chr(10), 1) AS title,
    'A' || (doc_id % 7) || '. Smith' || CASE WHEN doc_id % 4 = 0 THEN '' ELSE ', Bö' || (doc_id % 5) || ' Jones-Müller' END AS authors,
    'https://example.org/doc/' || doc_id AS link, text AS abstract, DATE '2026-08-10' - CAST(doc_id % 12 AS INT) AS date,
    CASE WHEN doc_id % 3 = 0 THEN NULL ELSE '10.1101/2026.08.' || lpad(CAST(1 + doc_id % 12 AS VARCHAR), 2, '0') || '.' || (doc_id // 4) END AS doi
  FROM documents)"""


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, least_bytes: int = 8 << 20) -> DataFrame:
    """Deals a small table evenly to all cores before work that costs much per row: a file of one row group is read by one task, whatever
    its size. A table that gives every core `least_bytes` to read is left as it lies, so nothing large is shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * least_bytes else df


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id")
    return read(spark, sf_dir, "documents").select(
        n.alias("seq"),
        "source",
        F.substring_index("text", "\n", 1).alias("title"),
        F.concat(F.lit("A"), (n % 7).cast("string"), F.lit(". Smith"), F.when(n % 4 == 0, "").otherwise(F.concat(F.lit(", Bö"), (n % 5).cast("string"), F.lit(" Jones-Müller")))).alias("authors"),
        F.concat(F.lit("https://example.org/doc/"), n.cast("string")).alias("link"),
        F.col("text").alias("abstract"),
        F.date_sub(F.lit(EDITION).cast("date"), (n % 12).cast("int")).alias("date"),
        F.when(n % 3 != 0, F.concat(F.lit("10.1101/2026.08."), F.lpad((1 + n % 12).cast("string"), 2, "0"), F.lit("."), F.floor(n / 4).cast("string"))).alias("doi"),
    )


#: What was sent before: a tenth of the documents, by title only or by DOI.
SENT_SQL = "sent AS (SELECT CASE WHEN seq % 20 = 3 THEN title ELSE '' END AS title, '' AS link, CASE WHEN seq % 20 = 13 THEN 'https://doi.org/' || upper(doi) END AS doi FROM papers WHERE seq % 10 = 3)"


def sent(papers: DataFrame) -> DataFrame:
    return papers.where("seq % 10 = 3").select(F.when(F.col("seq") % 20 == 3, F.col("title")).otherwise("").alias("title"), F.lit("").alias("link"), F.when(F.col("seq") % 20 == 13, F.concat(F.lit("https://doi.org/"), F.upper("doi"))).alias("doi"))


VOTES_SQL = """votes AS (
  SELECT user_id, 'User ' || user_id AS title, CAST(sum(CASE WHEN event_type IN ('purchase', 'click') THEN 1 ELSE 0 END) AS BIGINT) AS upvotes,
    CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS downvotes FROM events GROUP BY user_id)"""


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    up, down = F.sum(F.col("event_type").isin("purchase", "click").cast("int")), F.sum((F.col("event_type") == "error").cast("int"))
    rows = read(spark, sf_dir, "events").groupBy("user_id").agg(up.alias("upvotes"), down.alias("downvotes"))
    return rows.select("user_id", F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("title"), F.lit("").alias("summary"), F.lit("").alias("source"), F.lit("").alias("link"), "upvotes", "downvotes")


#: Decisions on documents that have a label.
DECISIONS_SQL = """decisions AS (
  SELECT doc_id AS seq, ' https://example.org/doc/' || CASE WHEN doc_id % 11 = 0 THEN doc_id + 1000000000 ELSE doc_id END AS link,
    CASE WHEN quality = 1 AND toxic = 0 THEN 'regular' WHEN toxic = 1 THEN 'rejected' ELSE 'featured' END AS label FROM labels)"""


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id")
    label = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "regular").when(F.col("toxic") == 1, "rejected").otherwise("featured")
    return read(spark, sf_dir, "labels").select(n.alias("seq"), F.concat(F.lit(" https://example.org/doc/"), F.when(n % 11 == 0, n + 1000000000).otherwise(n).cast("string")).alias("link"), label.alias("label"))
