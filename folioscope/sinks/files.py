"""Writers: tables by Spark; single files, put together from what many tasks wrote, by a data source with a commit; single small documents (an edition, a
status, warnings) from the driver, once they have passed their gates."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StringType, StructField, StructType

from .shared import opened, put_whole, qualified, read_if_there, write_whole

#: Bytes of a part that are read at a time when parts are put together.
PIECE = 4 << 20


@dataclass
class _Part(WriterCommitMessage):
    number: int
    path: str
    rows: int


class OneFileWriter(DataSourceWriter):
    """Tasks write parts beside the file; the commit puts them together, in the order of the tasks, and gives the result the file's name. A job that fails
    leaves an older file as it was."""

    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.begin, self.between, self.end = (options.get(k, "") for k in ("begin", "between", "end"))
        self.parts = f"{self.path}.parts-{uuid.uuid4().hex}"
        fs, folder = opened(self.parts)
        fs.create_dir(folder)

    def write(self, iterator: Iterator[Row]) -> _Part:
        # the folder isn't made here: a task that still runs when its job was aborted finds none, and fails instead of leaving a part
        fs, folder = opened(self.parts)
        context = TaskContext.get()
        path, n = f"{folder}/{context.partitionId():08d}-{context.taskAttemptId()}", 0
        with fs.open_output_stream(path) as out:
            for row in iterator:
                out.write(((self.between if n else "") + (row[0] or "")).encode())
                n += 1
        return _Part(context.partitionId(), path, n)

    def commit(self, messages: list[_Part | None]) -> None:
        fs, _ = opened(self.path)

        def pieces() -> Iterator[bytes]:
            yield self.begin.encode()
            for k, part in enumerate(sorted((m for m in messages if m and m.rows), key=lambda m: m.number)):
                if k:
                    yield self.between.encode()
                with fs.open_input_stream(part.path) as f:
                    while piece := f.read(PIECE):
                        yield piece
            yield self.end.encode()

        write_whole(self.path, pieces())
        self.abort(messages)

    def abort(self, messages: list[_Part | None]) -> None:
        fs, folder = opened(self.parts)
        for _ in range(3):  # a part may be added while the folder is being emptied
            try:
                if fs.get_file_info(folder).type == pafs.FileType.Directory:
                    fs.delete_dir(folder)
                return
            except OSError:
                continue


class OneFile(DataSource):
    """rows.write.format("one_file").options(begin=, between=, end=).mode("overwrite").save(path), for rows of one text column."""

    @classmethod
    def name(cls) -> str:
        return "one_file"

    def writer(self, schema, overwrite):
        return OneFileWriter({k.lower(): v for k, v in dict(self.options).items()})


def _one_file(texts: DataFrame, path: str, **marks: str) -> None:
    spark = texts.sparkSession
    spark.dataSource.register(OneFile)
    texts.write.format("one_file").options(**marks).mode("overwrite").save(qualified(spark, path))


def _json(rows: DataFrame, *columns: str):
    return F.to_json(F.struct(*(columns or rows.columns)), {"ignoreNullFields": "false"})


def json_array_file(rows: DataFrame, path: str) -> None:
    """Rows, in their order, as one file that holds one JSON array."""
    _one_file(rows.select(_json(rows)), path, begin="[", between=",\n", end="]\n")


def json_lines_file(rows: DataFrame, path: str) -> None:
    """Rows, in their order, as one file with a JSON record a line."""
    _one_file(rows.select(F.concat(_json(rows), F.lit("\n"))), path)


def candidate_file(papers: DataFrame, path: str) -> None:
    """The candidates' file: one array, the newest first as `papers` are, dates as text in UTC."""
    json_array_file(papers.withColumn("date", F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).drop("seq"), path)


def whole_files(rows: DataFrame, folder: str) -> int:
    """Writes texts (name, text) as files of a folder; returns how many. A task that runs again writes the same files."""
    where = qualified(rows.sparkSession, folder)

    def write(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, at = opened(where)
        fs.create_dir(at)
        for part in source:
            for name, text in zip(part["name"], part["text"], strict=True):
                if "/" in name:  # a folder below
                    write_whole(f"{where}/{name}", [(text or "").encode()])
                else:
                    put_whole(fs, at, name, [(text or "").encode()])
            yield pd.DataFrame({"n": [len(part)]})

    return rows.select("name", "text").mapInPandas(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def sidecar_files(rows: DataFrame, folder: str) -> int:
    """What each edition's entries are known by, as one array in `<edition>.papers.json`; an edition is of a size that people read."""
    known = rows.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    listed = known.groupBy("edition").agg(F.array_sort(F.collect_list(F.struct("pos", _json(known, "title", "link", "source", "date").alias("one")))).alias("all"))
    text = F.concat(F.lit("["), F.array_join(F.transform("all", lambda x: x["one"]), ",\n"), F.lit("]\n"))
    return whole_files(listed.select(F.concat("edition", F.lit(".papers.json")).alias("name"), text.alias("text")), folder)


def candidates(papers: DataFrame, path: str) -> None:
    """Candidate files: dates as text in UTC."""
    papers.withColumn("date", F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).drop("seq").write.mode("overwrite").json(path)


def stage(papers: DataFrame, path: str, from_date: str, name: str) -> None:
    """A source's result as a partition, so that a restart reads it instead of asking again."""
    writer = papers.withColumns({"from_date": F.lit(from_date), "stage": F.lit(name)}).write.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("from_date", "stage").mode("overwrite").parquet(f"{path}/rows")
    # a stage without rows is done too, so that what it asked isn't asked again; its mark comes last
    write_whole(f"{qualified(papers.sparkSession, path)}/done/{from_date}/{name}", [json.dumps({"from_date": from_date, "stage": name, "schema": papers.schema.json()}).encode()])


def restored(spark: SparkSession, path: str, from_date: str, name: str) -> DataFrame | None:
    """A stage of the current window, with or without rows, or null if it isn't done; stages of other windows are stale."""
    fs, at = opened(f"{qualified(spark, path)}/done/{from_date}/{name}")
    try:
        with fs.open_input_stream(at) as f:
            kind = StructType.fromJson(json.loads(json.loads(f.read())["schema"]))
    except FileNotFoundError:
        return None
    rows = read_if_there(spark, f"{path}/rows", StructType([*kind.fields, StructField("from_date", StringType()), StructField("stage", StringType())]))
    if rows is None:
        return spark.createDataFrame([], kind)
    return rows.where((F.col("from_date") == from_date) & (F.col("stage") == name)).drop("from_date", "stage")


def forget(spark: SparkSession, path: str) -> None:
    """Deletes the stages once the run that they were kept for has ended well."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def scores(rows: DataFrame, path: str) -> None:
    rows.orderBy(F.desc("score"), "title").write.mode("overwrite").json(path)


def json_lines(rows: DataFrame, path: str, by: str | None = None) -> None:
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).json(path)


def final_decisions(rows: DataFrame, path: str, archive: str) -> None:
    """Final decisions as lines, and a copy of each week's in the archive, which later runs of other weeks leave alone."""
    json_lines(rows, path)
    week = rows.sparkSession.read.schema(rows.schema).json(path)  # the copy is of what was written
    week.write.option("partitionOverwriteMode", "dynamic").partitionBy("week").mode("overwrite").json(archive)


def sidecars(rows: DataFrame, folder: str) -> None:
    """What an archive's entries are known by (title, link, source, date), a folder of lines per edition; other editions' stay."""
    known = rows.select("title", "link", "source", F.date_format("date", "yyyy-MM-dd").alias("date"), "edition")
    known.write.option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", False).partitionBy("edition").mode("overwrite").json(folder)


def stored(bodies: DataFrame, folder: str) -> int:
    """Keeps bodies (url, body) as the files that a `web` source with a folder reads; returns how many."""
    return whole_files(bodies.select(F.left(F.sha2("url", 256), F.lit(32)).alias("name"), F.col("body").alias("text")), folder)


def swap(rows: DataFrame, path: str) -> str:
    """A new version beside the old one and a pointer to it, as a table can't be overwritten while it is read. Returns the version's path."""
    version = f"{path}/v-{uuid.uuid4().hex}"
    rows.write.parquet(version)
    spark = rows.sparkSession
    spark.createDataFrame([(version,)], "path string").coalesce(1).write.mode("overwrite").json(f"{path}/current")
    return version


def current(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(spark.read.schema("path string").json(f"{path}/current").first()["path"])


def edition(markdown: DataFrame, path: str) -> None:
    """The one row of `rank.edition_markdown` as a file."""
    write_whole(qualified(markdown.sparkSession, path), [markdown.first()["markdown"].encode()])


def status(path: str, state: str, reason: str = "", **figures: float) -> None:
    write_whole(path, [json.dumps({"status": state, "reason": reason, **figures}, ensure_ascii=False).encode()])


def warnings(path: str, texts: list[str]) -> None:
    fs, at = opened(path)
    if texts:
        write_whole(path, [json.dumps(texts, ensure_ascii=False, indent=1).encode()])
    elif fs.get_file_info(at).type == pafs.FileType.File:
        fs.delete_file(at)
