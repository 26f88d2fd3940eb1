"""Files: candidates, decisions, feedback, archive editions, sidecars and lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions.text import stripped


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of publications, numbered in file order."""
    rows = spark.read.schema(schema.PAPER_JSON).json(path, multiLine=True)
    return rows.withColumn("seq", F.monotonically_increasing_id())


#: A line of an array that has a record a line: what opens, parts and closes the array around a record, if there is one.
_ARRAY_LINE = r"(?s)^\s*(\[?)\s*(,?)\s*(\{.*\})?\s*(,?)\s*(\]?)\s*$"


def json_array(spark: SparkSession, path: str, of: str) -> DataFrame:
    """Records of a file that holds one JSON array.

    A file with a record a line, as `sinks.files` writes it, is read by many tasks, once all its lines have been found to be of that kind; any other
    by one task.
    """
    lines = spark.read.text(path)
    part = lambda n: F.regexp_extract("value", _ARRAY_LINE, n)
    one = lambda n: (part(n) != "").cast("int")
    place = F.struct("_metadata.file_block_start", F.monotonically_increasing_id())
    # one record and no more, as it leaves a place for a zero behind it
    single = F.coalesce(F.json_array_length(F.concat(F.lit("["), part(3), F.lit(",0]"))) == 2, F.lit(False))
    fine = F.rlike("value", F.lit(_ARRAY_LINE)) & ((part(3) == "") | single)
    told = lines.select(F.col("_metadata.file_path").alias("file"), place.alias("place"), fine.alias("fine"), one(1).alias("begins"), (one(2) + one(4)).alias("commas"), one(3).alias("records"), one(5).alias("ends"))
    whole = (F.min("fine") & (F.sum("begins") == 1) & (F.sum("ends") == 1) & (F.min_by("begins", "place") == 1) & (F.max_by("ends", "place") == 1) & (F.sum("commas") == F.greatest(F.sum("records") - 1, F.lit(0))))
    if not told.groupBy("file").agg(whole.alias("whole")).where("NOT whole").isEmpty():
        return spark.read.schema(of).json(path, multiLine=True)
    return lines.select(part(3).alias("one")).where("one <> ''").select(F.from_json("one", of).alias("r")).select("r.*")


def json_lines(spark: SparkSession, path: str, of: str, strict: bool = False) -> DataFrame:
    """One record a line. Strict reading fails on a malformed line; tolerant reading leaves it out."""
    if strict:
        return spark.read.schema(of).json(path, mode="FAILFAST")
    rows = spark.read.schema(f"{of}, _bad string").json(path, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad")
    return rows.where("_bad IS NULL").drop("_bad")


def sent_decisions(spark: SparkSession, folder: str, current: str) -> DataFrame:
    """Selected publications of earlier decision files; the current edition's own file is left out. A file may be a folder of parts."""
    rows = json_lines(spark, f"{folder}/*", schema.DECISION).select("*", F.regexp_extract("_metadata.file_path", r"/(filter_decisions_\d{4}-\d{2}-\d{2}\.jsonl)(?:/[^/]+)?$", 1).alias("file"))
    return rows.where((F.col("file") != "") & (F.col("file") != current) & F.lower("label").isin("featured", "regular")).drop("file")


def rejected_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected decisions as documents, for audits; scoring doesn't learn from them."""
    from ..functions.text import known, strip_markdown

    rows = json_lines(spark, folder, schema.DECISION).where(F.lower("label") == "rejected")
    text = strip_markdown(F.concat_ws(" ", known(F.col("title")), known(F.col("abstract")), known(F.col("source"))))
    return rows.select("title", F.col("link").alias("url"), F.lit("rejected").alias("section"), text.alias("text"), F.lit(1.0).alias("weight")).where("text <> ''")


def feedback(spark: SparkSession, path: str) -> DataFrame:
    """Votes, one row a publication; a file that can't be read as JSON gives none."""
    return spark.read.schema(schema.FEEDBACK).json(path, multiLine=True).select(F.explode("papers").alias("p")).select("p.*")


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) of each edition below a path or glob."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))
    return rows.where(F.lower("file").rlike(r"\.(qmd|md)$"))


def archive_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, line) of editions of any length: a large file is read in parts, by as many tasks.

    `pos` grows along a file. A part's lines are numbered from the byte it begins at; as each line takes a byte or more, no two parts overlap.
    """
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    rows = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), (F.col("_metadata.file_block_start") + row).alias("pos"), F.col("value").alias("line"))
    return rows.where(F.lower("file").rlike(r"\.(qmd|md)$"))


def sidecars(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.SIDECAR).json(path, multiLine=True).withColumn("edition", F.regexp_replace(F.col("_metadata.file_name"), r"\.papers\.json$", ""))


def edition_sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """Sidecars that `sinks.files.sidecars` wrote."""
    return spark.read.schema(f"{schema.SIDECAR}, edition string").json(folder)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that aren't blank, without white space around them."""
    return spark.read.text(path).select(stripped(F.col("value")).alias("value")).where("value <> ''")


def listed_authors(spark: SparkSession, path: str) -> DataFrame:
    """(orcid, name): 'ORCID - name', or a name alone."""
    pattern = r"^(\d{4}-\d{4}-\d{4}-[\dX]{4})\s*-\s*(.+)$"
    v = F.col("value")
    return lines(spark, path).select(F.nullif(F.regexp_extract(v, pattern, 1), F.lit("")).alias("orcid"), F.coalesce(F.nullif(stripped(F.regexp_extract(v, pattern, 2)), F.lit("")), v).alias("name"))


def listed_keys(spark: SparkSession, path: str) -> DataFrame:
    """Lower-cased keys; what follows a # is a comment."""
    key = F.lower(stripped(F.substring_index("value", "#", 1)))
    return spark.read.text(path).select(key.alias("key")).where("key <> ''")


def snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Candidates as they were at each commit, from folders week=.../commit=...: the history of a file as a partitioned table."""
    rows = spark.read.schema(schema.PAPER_JSON).option("basePath", path).json(f"{path}/*/*", multiLine=True)
    return rows.withColumns({k: F.regexp_extract(F.col("_metadata.file_path"), f"{k}=([^/]+)", 1) for k in ("week", "commit")}).withColumn("seq", F.monotonically_increasing_id())
