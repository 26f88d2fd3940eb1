"""Tables in the shared folder that the cluster names in spark.checkpoint.dir: results that must not be computed again, whatever is lost later."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterable
from weakref import WeakKeyDictionary

import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Bytes for each task that writes a table of a known size.
FILE_BYTES = 8 << 20
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_LEFT: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder. Where none is set: a temporary one if everything runs on this machine, else an error."""
    if not (path := spark.conf.get("spark.checkpoint.dir", None)):
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
        path = tempfile.mkdtemp(prefix="folioscope-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def settle(df: DataFrame, within: int | None = None, group: int | None = None) -> DataFrame:
    """Writes a frame to the shared folder and reads it again: computed once, whatever executors are lost later.

    A frame known to be no larger than `within` bytes is written by as many tasks as that needs, instead of a small file from each of many.
    `group` bounds the bytes of a row group, but for its last row: a task that reads a table decodes 4,096 rows of a group at a time, which is all of it where rows
    are megabytes, and its writer would hold a hundred rows before it first looked.
    The table goes when it is released, or else with the driver's process.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/settled-{uuid.uuid4().hex}"
    cut = {"parquet.block.size": group, "parquet.page.size.row.check.min": 1} if group else {}
    (df if within is None else df.coalesce(min(max(1, -(-within // FILE_BYTES)), 1 << 16))).write.options(**cut).parquet(path)
    _LEFT[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def scratch(spark: SparkSession) -> str:
    """A path in the shared folder for files of one's own; what is written there goes with the driver's process."""
    path = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
    _LEFT[path] = spark
    return path


def size_of(settled: DataFrame) -> int:
    """Bytes of a settled table's files."""
    return int(str(settled._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system, as tasks can open it (`opened`)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return str(at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at))


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """A file system that Python can use, in a task too, and the path in it. A path without a scheme is this machine's."""
    return pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))


def write_whole(path: str, parts: Iterable[bytes]) -> None:
    """Writes a file that takes its name, and the place of an older one, only once it is whole."""
    fs, at = opened(path)
    folder, _, name = at.rpartition("/")
    fs.create_dir(folder)
    put_whole(fs, folder, name, parts)


def put_whole(fs: pafs.FileSystem, folder: str, name: str, parts: Iterable[bytes]) -> None:
    """The same in a folder that is there, on a file system that was opened before."""
    at = f"{folder}/{name}"
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    try:
        with fs.open_output_stream(draft) as out:
            for part in parts:
                out.write(part)
    except BaseException:
        fs.delete_file(draft)
        raise
    try:
        fs.move(draft, at)
    except OSError:  # where moving doesn't replace
        fs.delete_file(at)
        fs.move(draft, at)


def read_if_there(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame | None:
    """A table, or null if nothing was written there yet. Any other failure to read is an error."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def release(*settled: DataFrame) -> None:
    """Deletes the tables behind frames that `settle` returned; nothing may read them, or what was derived from them and not settled itself, again."""
    for df in settled:
        if path := _PATHS.pop(df, None):
            _delete(path)


def _delete(path: str) -> None:
    spark = _LEFT.pop(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _delete_left() -> None:
    for path, spark in list(_LEFT.items()):
        if spark.sparkContext._jsc is None:  # stopped before; its folder is the session's own to clean
            _LEFT.pop(path)
        else:
            _delete(path)
