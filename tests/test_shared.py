import os

import pytest
from folioscope.sinks import shared
from py4j.protocol import Py4JJavaError


def test_settled_tables_are_written_with_few_tasks_and_released(spark):
    df = spark.range(1000).repartition(4)
    wide, small = shared.settle(df), shared.settle(df, 100)
    assert wide.count() == small.count() == 1000 and 0 < shared.size_of(small) < 1 << 20
    at = small.inputFiles()
    assert len(at) == 1 and len(wide.inputFiles()) == 4
    shared.release(small, wide)
    assert not os.path.exists(at[0].removeprefix("file://"))
    shared.release(small, df)  # nothing is left to delete
    assert shared.settle(df, 1 << 63).count() == 1000


def test_only_what_was_never_written_counts_as_empty(spark, tmp_path):
    assert shared.read_if_there(spark, f"{tmp_path}/none") is None and shared.read_if_there(spark, f"{tmp_path}/none", "a long") is None
    spark.range(3).write.parquet(f"{tmp_path}/some")
    assert shared.read_if_there(spark, f"{tmp_path}/some").count() == 3
    with pytest.raises(Py4JJavaError):
        shared.read_if_there(spark, "nowhere://x/y")


def test_a_cluster_needs_a_shared_folder():
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="share"):
        shared.shared_dir(Session)


def test_files_of_their_own(spark, tmp_path):
    from folioscope.sinks import files as sinks
    from folioscope.sources import files, web

    path = shared.scratch(spark)
    bodies = spark.createDataFrame([("u1", "one"), ("u2", None)], "url string, body string")
    assert sinks.stored(bodies, f"file://{path}") == 2 and sinks.stored(bodies.where("false"), path) == 0
    get = web.file_transport(f"file://{path}")
    assert get("u1") == (200, "one", None) and get("u2") == (200, "", None) and get("u3")[0] == 404

    rows = spark.createDataFrame([("t", "l", "s", "2026-08-03", "e1"), ("t", "l", "s", None, "e2")], "title string, link string, source string, date string, edition string")
    kept = str(tmp_path / "sidecars")
    sinks.sidecars(rows.withColumn("date", rows["date"].cast("date")), kept)
    sinks.sidecars(rows.where("edition = 'e2'").withColumn("date", rows["date"].cast("date")), kept)  # the other edition stays
    assert sorted((r.edition, r.date) for r in files.edition_sidecars(spark, kept).collect()) == [("e1", "2026-08-03"), ("e2", None)]

    final = spark.createDataFrame([("W1", "a"), ("W2", "b")], "week string, link string")
    lines, archive = str(tmp_path / "final"), str(tmp_path / "archive")
    sinks.final_decisions(final, lines, archive)
    sinks.final_decisions(final.where("week = 'W2'"), lines, archive)
    assert [r.week for r in spark.read.json(lines).collect()] == ["W2"] and spark.read.json(archive).count() == 2
