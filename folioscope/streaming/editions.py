"""Incremental forms: overlapping weekly editions, what was already sent, and running reader preferences.

The same functions serve batch and streaming frames.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, StructField, StructType

from ..functions.dates import first_posted
from ..functions.keys import identity_keys
from ..operators.joins import drop_sent
from ..sinks.shared import read_if_there

#: Buckets that keys are dealt to. State lies by bucket, so a checkpoint holds for this number alone.
BUCKETS = 1024


def weekly_windows(rows: DataFrame, time: str) -> DataFrame:
    """(start, n): rows per window of eight days that starts on a Monday, so a Monday counts for two editions."""
    w = F.window(time, "8 days", "7 days", "4 days")
    return rows.groupBy(w.alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n")


def event_time(papers: DataFrame, late: str = "14 days") -> DataFrame:
    """Publications by the day of their first posting, which must be known before a watermark is set: a revision isn't new."""
    return papers.withColumn("published", first_posted(F.col("doi"), F.col("date")).cast("timestamp")).withWatermark("published", late)


def net_preferences(votes: DataFrame, key: str) -> DataFrame:
    """(key, net): upvotes less twice the downvotes, as running totals (output mode `update` on a stream)."""
    return votes.groupBy(key).agg(F.sum(F.col("upvotes") - 2 * F.col("downvotes")).alias("net"))


def edition_writer(state_path: str, out_path: str, edition: Column) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: drops what an earlier batch sent, writes the rest as `edition=...` partitions, and adds their keys to the state.

    Keys are a table in a shared folder, as they must be kept without end. A batch that runs again leaves the same files: its rows and its keys
    are written under its number, and its own keys are left out of what counts as sent.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        schema = "title string, link string, doi string, batch long"
        state = read_if_there(spark, state_path, schema)  # none before the first batch; a state that can't be read is an error
        sent = spark.createDataFrame([], schema) if state is None else state.where(F.col("batch") < batch_id)
        fresh = drop_sent(batch, sent).withColumn("edition", edition).withColumn("batch", F.lit(batch_id)).persist()
        try:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
            fresh.write.partitionBy("batch", "edition").mode("overwrite").parquet(out_path)
            fresh.select("title", "link", "doi", "batch").write.partitionBy("batch").mode("overwrite").parquet(state_path)
        finally:
            fresh.unpersist()

    return write


def keyed(papers: DataFrame) -> DataFrame:
    """A row for each identity key (`key`) of a publication; one without any has a key of its own."""
    own = F.array(F.concat(F.lit("seq:"), F.col("seq").cast("string")))
    keys = identity_keys(F.col("title"), F.col("link"), F.col("doi"))
    return papers.withColumn("key", F.explode(F.when(F.size(keys) > 0, keys).otherwise(own)))


class _Met(StatefulProcessor):
    """Tells of each row whether its key was met in an earlier batch. Keys come by bucket, as a call for each key costs far more than asking for its state; a key's
    state is one flag in its bucket's map, however many rows it has."""

    def __init__(self, ttl_ms: int | None) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.met = handle.getMapState("met", "key string", "met boolean", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:  # noqa: N802 - the interface's name
        before: dict[str, bool] = {}
        for part in rows:
            for k in part["key"].unique():
                if k not in before:
                    before[k] = self.met.containsKey((k,))
                    self.met.updateValue((k,), (True,))
            yield part.drop(columns="bucket").assign(met=part["key"].map(before).astype(bool))

    def close(self) -> None:
        pass


def with_met(papers: DataFrame, ttl_days: int | None = None) -> DataFrame:
    """A stream's publications, a row for each identity key, with `met`: whether the key came in an earlier batch.

    Only the state of keys that a batch has is read, so a batch costs what it holds, whatever was met before. Without `ttl_days` keys are kept for good.
    """
    rows = keyed(papers)
    out = StructType([*rows.schema.fields, StructField("met", BooleanType())])
    return rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int")).groupBy("bucket").transformWithStateInPandas(_Met(None if ttl_days is None else ttl_days * 86_400_000), out, "append", "processingTime" if ttl_days else "none")


def keyed_editions(papers: DataFrame, out_path: str, edition: Column, checkpoint: str, ttl_days: int | None = None) -> DataStreamWriter:
    """Writes each publication of a stream once, none of whose identity keys an earlier batch had, as `batch=.../edition=...` partitions.

    What was dropped counts as met too: a work that shares a key with it is the same work. Copies within a batch all pass, as duplicates are
    resolved before. A batch that runs again has the state of its start and leaves the same files. `papers` have `published`, the day of their first posting
    (`event_time`). Needs the RocksDB state store, which is set here.
    """
    papers.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    columns = papers.columns

    def write(batch: DataFrame, batch_id: int) -> None:
        # a publication's keys come with the batch that it comes with, each with all its columns
        told = batch.groupBy("seq").agg(F.max("met").alias("met"), *(F.first(c).alias(c) for c in columns if c != "seq"))
        fresh = told.where("NOT met").select(*columns).withColumns({"batch": F.lit(batch_id), "edition": edition})
        fresh.write.option("partitionOverwriteMode", "dynamic").partitionBy("batch", "edition").mode("overwrite").parquet(out_path)

    return with_met(papers, ttl_days).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
