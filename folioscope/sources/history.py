"""A file's history in a git repository as a Python data source: a partition per commit, each of which asks git itself for the file as it was.

The repository lies in a folder that all machines share. Which commits there are is asked for once, on the driver: a line a commit.
"""

from __future__ import annotations

import subprocess
from collections.abc import Iterator
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .. import schema

VERSIONS = "commit string, commit_no int, committed timestamp, week date, body string"


def _git(repo: str, *args: str) -> str | None:
    """What git says, or null if it fails, as for a file that a commit hasn't."""
    got = subprocess.run(["git", "-c", "safe.directory=*", "-C", repo, *args], capture_output=True, check=False)
    return got.stdout.decode("utf-8", "replace") if not got.returncode else None


class _Commit(InputPartition):
    def __init__(self, commit: str, number: int, committed: datetime) -> None:
        self.commit, self.number, self.committed = commit, number, committed

    @property
    def week(self) -> date:
        day = self.committed.date()
        return day - timedelta(days=day.weekday())


class HistoryReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = {k.lower(): v for k, v in dict(options).items()}

    def partitions(self) -> list[InputPartition]:
        """The commits that touched the file, in their order; with `weekly` only the last of each week (from Monday, in UTC) in which the file is there."""
        repo, path = self.options["repo"], self.options["file"]
        if (log := _git(repo, "log", "--all", "--reverse", "--format=%H %ct", "--", path)) is None:
            raise ValueError(f"no git repository at {repo}")
        commits = []
        for number, line in enumerate(log.split("\n")):
            if line:
                commit, at = line.split()
                commits.append(_Commit(commit, number, datetime.fromtimestamp(int(at), UTC).replace(tzinfo=None)))
        if self.options.get("weekly") != "true":
            return commits
        last: dict[date, _Commit] = {}
        for c in reversed(commits):
            if c.week not in last and _git(repo, "cat-file", "-e", f"{c.commit}:{path}") is not None:
                last[c.week] = c
        return list(last.values())

    def read(self, partition: _Commit) -> Iterator[tuple]:
        body = _git(self.options["repo"], "show", f"{partition.commit}:{self.options['file']}")
        if body is not None:  # a commit that deleted the file has no version of it
            yield partition.commit, partition.number, partition.committed, partition.week, body


class HistorySource(DataSource):
    """spark.read.format("git_history").options(repo=, file=, weekly=)."""

    @classmethod
    def name(cls) -> str:
        return "git_history"

    def schema(self) -> str:
        return VERSIONS

    def reader(self, schema):
        return HistoryReader(self.options)


def versions(spark: SparkSession, repo: str, file: str, weekly: bool = False) -> DataFrame:
    """VERSIONS of a file, or the last one of each week."""
    spark.dataSource.register(HistorySource)
    return spark.read.format("git_history").options(repo=repo, file=file, weekly=str(weekly).lower()).load()


def snapshots(spark: SparkSession, repo: str, file: str = "papers.json", weekly: bool = True) -> DataFrame:
    """Candidates as each week's last commit had them, as `plans.pipeline.label_history` takes them. A version that isn't a JSON array has none."""
    rows = versions(spark, repo, file, weekly).select(F.date_format("week", "yyyy-MM-dd").alias("week"), "commit", "commit_no", F.from_json("body", f"array<struct<{', '.join(c.replace(' ', ':', 1) for c in schema.PAPER_JSON.split(', '))}>>").alias("papers"))
    return rows.select("week", "commit", "commit_no", F.posexplode("papers").alias("pos", "p")).select("week", "commit", "commit_no", "p.*", (F.col("commit_no").cast("long") * (1 << 32) + F.col("pos")).alias("seq"))


def known_dates(spark: SparkSession, repo: str, file: str = "papers.json") -> DataFrame:
    """(link, title, pos, date) of every publication that any version of the file has, as `plans.pipeline.backfill` takes them; later versions have higher places."""
    rows = snapshots(spark, repo, file, weekly=False)
    return rows.select("link", "title", F.col("seq").alias("pos"), "date")
