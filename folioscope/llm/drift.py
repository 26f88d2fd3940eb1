"""Drifted schema rewrite: rows are ranked exactly, written as files whose schemas have drifted, and rewritten to one evolved schema by field id.

Ranks. Rows are ordered by unsigned crc32 of the decimal key, then by the key. A histogram over the high bits of the crc32 has a fixed number of
buckets whatever the input; its exclusive prefix sums plus the row_number in a bucket are the ranks, without a global sort. Where one key has
so many rows that its bucket would be too much for a task, the key gets buckets of its own, dealt by the place of its rows, and what stands
before and behind it in the bucket gets others; all of them stay in order, so that the prefix sums hold.

Files. Each file's rows come to one task as a stream, in order, and are written batch by batch: memory is bounded by a batch and a row group. A
file is written beside the folder and moved to its name once it is whole, so that a task which is run again after an executor was lost changes
nothing. The drifted files go only after all rewritten ones stand.

Null key: before all others. Rows of equal keys: by the hash of their other columns, those of a key with very many rows by where they stand.
Repeated rows all count. Nulls in any column stay null. Empty table: no files and no rows. Columns beyond those of the evolved schema are ignored,
whatever their names. A balance that isn't finite is written as NaN, Infinity or -Infinity in the digest.
"""

from __future__ import annotations

import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .lineage import settle, shared_dir

#: Buckets of the histogram: the high 12 bits of the crc32.
BUCKET_BITS = 12
#: A key with more rows than this, and than a 1,024th of all, is dealt to buckets of its own.
HOT_ROWS = 2_000
PARTS = 1_024
#: Rows of a row group, and of a batch that is read again.
GROUP_ROWS = 1 << 16
_ID = b"PARQUET:field_id"


@dataclass(frozen=True)
class Drift:
    """What the bits of a version do to a file: 1 swaps two names, 2 turns the columns after the first round, 4 leaves columns out (with what they
    become), 8 narrows types. `period` and `versions`: crc32 of seed:file_no modulo the first, and 0 from the second on."""

    swapped: tuple[str, str] = ("name", "email")
    missing: dict[str, object] = field(default_factory=lambda: {"nation_id": -1, "source": "none"})
    narrowed: dict[str, str] = field(default_factory=lambda: {"balance": "float32", "nation_id": "int32"})
    seed: int = 42
    period: int = 24
    versions: int = 16

    def version(self, file_no: int) -> int:
        v = zlib.crc32(f"{self.seed}:{file_no}".encode()) % self.period
        return v if v < self.versions else 0

    def columns(self, evolved: pa.Schema, version: int) -> list[tuple[str, pa.Field]]:
        """Name in the evolved schema, and field as stored, of each column of a file of this version."""
        swap = dict([self.swapped, self.swapped[::-1]]) if version & 1 else {}
        out = [(f.name, f.with_name(swap.get(f.name, f.name))) for f in evolved]
        if version & 2:
            out = out[:1] + out[:0:-1]
        if version & 4:
            out = [(n, f) for n, f in out if n not in self.missing]
        if version & 8:
            out = [(n, f.with_type(pa.type_for_alias(self.narrowed[n]))) if n in self.narrowed else (n, f) for n, f in out]
        return out


def evolved_schema(df: DataFrame) -> pa.Schema:
    """A frame's schema in Arrow, all nullable, with Parquet field ids from 1."""
    found = to_arrow_schema(df.schema)
    return pa.schema([pa.field(f.name, f.type, True, {_ID: str(k).encode()}) for k, f in enumerate(found, 1)])


def exact_ranks(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows with rank (from 0, by crc32 of the key, then the key) and n, the number of all rows."""
    names = df.columns
    crc = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(-1))
    # columns of its own are told apart by a prefix that no column of the frame has
    p = "_"
    while any(n.startswith(p) for n in names):
        p += "_"
    rows = df.withColumn(f"{p}crc", crc).withColumn(f"{p}bucket", F.shiftright(F.greatest(f"{p}crc", F.lit(0)), 32 - BUCKET_BITS).cast("int"))
    counts = settle(rows.groupBy(f"{p}bucket").agg(F.count("*").alias(f"{p}count")), within=1 << (BUCKET_BITS + 5))
    n = counts.agg(F.coalesce(F.sum(f"{p}count"), F.lit(0))).first()[0]
    most = max(hot_rows, n // PARTS)
    # at most PARTS buckets and PARTS keys have that many rows
    crowded = [r[0] for r in counts.where(F.col(f"{p}count") > most).select(f"{p}bucket").collect()]
    hot = rows.where(F.col(f"{p}bucket").isin(crowded)).groupBy(f"{p}crc", key).count().where(F.col("count") > most).orderBy(f"{p}crc", key).collect() if crowded else []
    place, part = F.lit(0), F.lit(0)
    if hot:
        rows = settle(rows.withColumn(f"{p}at", F.monotonically_increasing_id()))
        kind = rows.schema[key].dataType
        keys = F.array(*(F.struct(F.lit(c).cast("long").alias("c"), F.lit(k).cast(kind).alias("k")) for c, k, _ in hot))
        own = F.struct(F.col(f"{p}crc").alias("c"), F.col(key).alias("k"))
        position = F.array_position(keys, own)
        parts = F.array(*(F.lit(math.ceil(c * PARTS / n)) for _, _, c in hot))
        crowd = F.col(f"{p}bucket").isin(crowded)
        place = F.when(crowd, 2 * F.size(F.filter(keys, lambda x: x < own)) + (position > 0).cast("int")).otherwise(0)
        part = F.when(crowd & (position > 0), F.pmod(F.col(f"{p}at"), F.element_at(parts, F.greatest(position, F.lit(1)).cast("int"))).cast("int")).otherwise(0)
    rows = rows.withColumn(f"{p}place", place).withColumn(f"{p}part", part)
    cell = [f"{p}bucket", f"{p}place", f"{p}part"]
    filled = rows.groupBy(*cell).agg(F.count("*").alias(f"{p}count")) if hot else counts.select(cell[0], F.lit(0).alias(cell[1]), F.lit(0).alias(cell[2]), f"{p}count")
    # a row for each bucket, of which there are at most 2^BUCKET_BITS + 4 * PARTS: a proven bound for the one task and the broadcast
    before = F.sum(f"{p}count").over(Window.orderBy(*cell).rowsBetween(Window.unboundedPreceding, -1))
    starts = filled.select(*cell, F.coalesce(before, F.lit(0)).alias(f"{p}before"))
    order = [F.col(f"{p}crc"), F.col(key).asc_nulls_first(), F.xxhash64(*(c for c in names if c != key)) if len(names) > 1 else F.lit(0), *([F.col(f"{p}at")] if hot else [])]
    number = F.row_number().over(Window.partitionBy(*cell).orderBy(*order))
    ranked = rows.join(F.broadcast(starts), cell).withColumn("rank", F.col(f"{p}before") + number - 1)
    return ranked.select(*names, "rank", F.lit(n).alias("n"))


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as tasks have to open it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = str(at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at))
    return f"file://{uri[5:]}" if uri.startswith("file:/") and not uri.startswith("file://") else uri


class _Whole:
    """A Parquet file that stands under its name only once it is whole."""

    def __init__(self, path: str, schema: pa.Schema) -> None:
        self.fs, self.path = _filesystem(path)
        folder, _, name = self.path.rpartition("/")
        self.beside = f"{folder}-unfinished"
        self.fs.create_dir(self.beside)
        self.fs.create_dir(folder)
        self.draft = f"{self.beside}/{name}-{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.draft)
        self.writer = pq.ParquetWriter(self.out, schema)

    def __enter__(self) -> pq.ParquetWriter:
        return self.writer

    def __exit__(self, kind: type | None, *_: object) -> None:
        self.writer.close()
        self.out.close()
        if kind is None and not self._there():
            try:
                self.fs.move(self.draft, self.path)
                return
            except OSError:
                if not self._there():  # else another run of this task was faster; it wrote the same rows
                    raise
        self.fs.delete_file(self.draft)

    def _there(self) -> bool:
        return self.fs.get_file_info(self.path).type == pafs.FileType.File


class _Groups:
    """Gathers batches up to a row group."""

    def __init__(self, writer: pq.ParquetWriter, schema: pa.Schema) -> None:
        self.writer, self.schema, self.held, self.rows = writer, schema, [], 0

    def add(self, batch: pa.RecordBatch) -> None:
        self.held.append(batch)
        self.rows += batch.num_rows
        if self.rows >= GROUP_ROWS:
            self.flush()

    def flush(self) -> None:
        if self.held:
            self.writer.write_table(pa.Table.from_batches(self.held, self.schema))
        self.held, self.rows = [], 0


def _tasks(spark: SparkSession, files: int) -> int:
    return max(1, min(files, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)))


FILES = "file_no long, version long, n_rows long, path string, start_columns string"


def write_drifted(ranked: DataFrame, folder: str, drift: Drift | None = None, files: int = 500) -> DataFrame:
    """Writes rows with rank and n, in order, to at most `files` files of drifted schemas: file_no, version, n_rows, path, start_columns of each."""
    drift = drift or Drift()
    evolved = evolved_schema(ranked.drop("rank", "n"))
    names = evolved.names
    where = qualified(ranked.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches)
        file_no = first.column("file_no")[0].as_py()
        version = drift.version(file_no)
        stored = drift.columns(evolved, version)
        schema = pa.schema([f for _, f in stored])
        name = f"{'start' if version else 'file'}-{file_no:06d}.parquet"
        rows, last = 0, -1
        with _Whole(f"{where}/{name}", schema) as writer:
            groups = _Groups(writer, schema)
            for batch in chain([first], batches):
                ranks = batch.column("rank")
                if ranks[0].as_py() <= last or not pc.all(pc.equal(pc.pairwise_diff(pc.cast(ranks, pa.int64())), 1)).as_py() in (True, None):
                    raise ValueError(f"the rows of file {file_no} are not in order")
                last = ranks[-1].as_py()
                columns = [pc.cast(batch.column(n), f.type, safe=False) for n, f in stored]
                groups.add(pa.RecordBatch.from_arrays(columns, schema=schema))
                rows += batch.num_rows
            groups.flush()
        yield pa.RecordBatch.from_pydict({"file_no": [file_no], "version": [version], "n_rows": [rows], "path": [f"{folder}/{name}"], "start_columns": [",".join(schema.names)]})

    placed = ranked.select(F.floor(F.col("rank") / (1 + F.floor(F.col("n") / files))).cast("long").alias("file_no"), "rank", *names)
    dealt = placed.repartition(_tasks(ranked.sparkSession, files), "file_no").sortWithinPartitions("file_no", "rank")
    return dealt.groupBy("file_no").applyInArrow(write, FILES)


def rewrite(started: DataFrame, evolved: pa.Schema, folder: str, drift: Drift | None = None, files: int = 500) -> DataFrame:
    """Turns each drifted file into one of the evolved schema, matching columns by field id. Files of version 0 stay as they are.

    `started` is a settled table of FILES; returned is such a table, with the path of each final file and whether it was rewritten. The drifted
    files are deleted when all rewritten ones stand.
    """
    drift = drift or Drift()
    spark = started.sparkSession
    where = qualified(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.to_pylist():
                if f["version"]:
                    name = f"file-{f['file_no']:06d}.parquet"
                    _evolve(f"{where}/{f['path'].rpartition('/')[2]}", f"{where}/{name}", evolved, drift.missing)
                    f["path"] = f"{folder}/{name}"
                yield pa.RecordBatch.from_pylist([f | {"rewritten": f["version"] != 0}], schema=pa.schema([*batch.schema, pa.field("rewritten", pa.bool_())]))

    # a row a file: so few bytes that they would be put into one task if the number of tasks were left open
    dealt = started.repartition(_tasks(spark, files), "file_no")
    done = settle(dealt.groupBy("file_no").applyInArrow(run, f"{FILES}, rewritten boolean"))
    _delete(spark, f"{folder}/start-*.parquet")
    return done


def _evolve(path: str, to: str, evolved: pa.Schema, missing: dict[str, object]) -> None:
    fs, at = _filesystem(path)
    if fs.get_file_info(at).type != pafs.FileType.File and (there := _filesystem(to))[0].get_file_info(there[1]).type == pafs.FileType.File:
        return  # this task ran before, and what it read is gone
    with fs.open_input_file(at) as source:
        file = pq.ParquetFile(source)
        ids = {f.metadata[_ID]: k for k, f in enumerate(file.schema_arrow)}
        with _Whole(to, evolved) as writer:
            for batch in file.iter_batches(GROUP_ROWS):
                columns = [
                    pc.cast(batch.column(ids[f.metadata[_ID]]), f.type) if f.metadata[_ID] in ids else pa.repeat(pa.scalar(missing.get(f.name), f.type), batch.num_rows)
                    for f in evolved
                ]
                writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=evolved))


def _delete(spark: SparkSession, pattern: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.globStatus(at) or []:
        fs.delete(f.getPath(), False)


DIGESTS = "file_no long, version long, n_rows long, n_nulls long, ids_sha256 string, rows_sha256 string, start_columns string, columns string, path string, rewritten boolean"


def read_back(final: DataFrame, files: int = 500) -> DataFrame:
    """Reads final files as they stand, as streams: their columns, rows, nulls and digests of the first column and of whole rows."""
    spark = final.sparkSession
    schema = pa.schema([("file_no", pa.int64()), ("version", pa.int64()), ("n_rows", pa.int64()), ("n_nulls", pa.int64()), *((c, pa.string()) for c in ("ids_sha256", "rows_sha256", "start_columns", "columns", "path")), ("rewritten", pa.bool_())])
    prefix = qualified(spark, shared_dir(spark)), shared_dir(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.to_pylist():
                yield pa.RecordBatch.from_pylist([f | _digests(f["path"].replace(prefix[1], prefix[0], 1))], schema=schema)

    return final.repartition(_tasks(spark, files), "file_no").groupBy("file_no").applyInArrow(run, DIGESTS)


def _digests(path: str) -> dict:
    fs, at = _filesystem(path)
    ids, rows, n, nulls = hashlib.sha256(), hashlib.sha256(), 0, 0
    with fs.open_input_file(at) as source:
        file = pq.ParquetFile(source)
        for batch in file.iter_batches(GROUP_ROWS):
            if not batch.num_rows:
                continue
            columns = [pc.fill_null(_texts(c), "?") for c in batch.columns]
            ids.update((("," if n else "") + ",".join(columns[0].to_pylist())).encode())
            rows.update((("\n" if n else "") + "\n".join(pc.binary_join_element_wise(*columns, "|").to_pylist())).encode())
            n += batch.num_rows
            nulls += sum(c.null_count for c in batch.columns)
        return {"n_rows": n, "n_nulls": nulls, "ids_sha256": ids.hexdigest(), "rows_sha256": rows.hexdigest(), "columns": ",".join(file.schema_arrow.names)}


def _texts(c: pa.Array) -> pa.Array:
    if pa.types.is_timestamp(c.type):
        c = pc.cast(pc.cast(c, pa.timestamp("us", c.type.tz)), pa.int64())
    if pa.types.is_floating(c.type):
        return pa.array([None if x is None else _scaled(x) for x in c.to_pylist()], pa.string())
    return pc.cast(c, pa.string())


def _scaled(x: float) -> str:
    if not math.isfinite(x):
        return "NaN" if x != x else "Infinity" if x > 0 else "-Infinity"
    return str(math.floor(x * 1048576) if abs(x) < 2.0**53 else int(x) * 1048576)


def new_folder(spark: SparkSession) -> str:
    """A folder under spark.checkpoint.dir that nothing uses yet, and that stays."""
    return f"{shared_dir(spark)}/drifted-{uuid.uuid4().hex}"


def rewritten(df: DataFrame, key: str, folder: str | None = None, drift: Drift | None = None, files: int = 500) -> DataFrame:
    """Ranks, writes and rewrites a frame's rows; the digests of the final files."""
    folder = folder or new_folder(df.sparkSession)
    # not put together into fewer tasks: the files are written and read by the tasks that return their rows
    started = settle(write_drifted(exact_ranks(df, key), folder, drift, files))
    return settle(read_back(rewrite(started, evolved_schema(df), folder, drift, files), files))
