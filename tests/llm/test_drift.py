"""Drifted schema rewrite against a plain version; hot keys, nulls, clashing columns, repeated tasks and files as they stand."""

import datetime
import hashlib
import math
import os
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from folioscope.llm import drift
from folioscope.llm.lineage import settle
from pyspark.sql import functions as F

FIELDS = "client_id long, master_id long, source string, updated_at timestamp_ntz, name string, email string, city string, nation_id long, segment string, balance double"
NAMES = [f.split()[0] for f in FIELDS.split(", ")]
START = datetime.datetime(1970, 1, 1)


def clients(n, seed=3, ids=None):
    r = random.Random(seed)
    maybe = lambda x: None if r.random() < 0.1 else x
    ids = ids or r.sample(range(-5, 10 * n), n)
    return [
        (i, maybe(r.randrange(n)), maybe(r.choice(["web", "crm"])), maybe(datetime.datetime(2024, 1, 1) + datetime.timedelta(microseconds=r.randrange(10**12))), maybe(f"n{i}"), maybe(f"é{i}@x"), maybe("c|d"), maybe(r.randrange(25)), maybe("s"), maybe(r.choice([-0.3, 1e300, 0.1 * i if i else 0.0])))
        for i in ids
    ]


def crc(i):
    return -1 if i is None else zlib.crc32(str(i).encode())


def text(name, x):
    if x is None:
        return "?"
    if name == "updated_at":
        return str((x - START) // datetime.timedelta(microseconds=1))
    if name == "balance":
        return ("NaN" if x != x else "Infinity" if x > 0 else "-Infinity") if not math.isfinite(x) else str(math.floor(1048576 * x) if abs(x) < 2**53 else int(x) * 1048576)
    return str(x)


def expected(rows, files=500):
    rows = sorted(rows, key=lambda x: (crc(x[0]), -(10**30) if x[0] is None else x[0]))
    size, out = 1 + len(rows) // files, {}
    for f in range(-(-len(rows) // size)):
        v = zlib.crc32(f"42:{f}".encode()) % 24
        v = 0 if v > 15 else v
        names = list(NAMES)
        if v & 1:
            names[4], names[5] = names[5], names[4]
        if v & 2:
            names = names[:1] + names[:0:-1]
        if v & 4:
            names = [c for c in names if c not in ("source", "nation_id")]
        own = []
        for x in map(lambda x: dict(zip(NAMES, x, strict=True)), rows[f * size : (f + 1) * size]):
            x |= {"source": "none", "nation_id": -1} if v & 4 else {}
            with np.errstate(over="ignore"):
                x["balance"] = float(np.float32(x["balance"])) if v & 8 and x["balance"] is not None else x["balance"]
            own.append(x)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[f] = (v, len(own), sum(y is None for x in own for y in x.values()), sha(",".join(text("client_id", x["client_id"]) for x in own)), sha("\n".join("|".join(text(c, x[c]) for c in NAMES) for x in own)), ",".join(names), ",".join(NAMES), v != 0)
    return out


def digests(df):
    return {r.file_no: (r.version, r.n_rows, r.n_nulls, r.ids_sha256, r.rows_sha256, r.start_columns, r.columns, r.rewritten) for r in df.collect()}


@pytest.mark.parametrize("n", [0, 1, 7, 499, 500, 1203])
def test_rewrite(spark, n):
    rows = clients(n)
    folder = drift.new_folder(spark)
    got = drift.rewritten(spark.createDataFrame(rows, FIELDS).repartition(3), "client_id", folder)
    assert digests(got) == expected(rows)
    paths = sorted(r.path for r in got.collect())
    assert paths == sorted(os.path.join(folder, f) for f in (os.listdir(folder) if n else []) if not f.startswith("."))
    for p in paths[:3]:
        schema = pq.ParquetFile(p).schema_arrow
        assert schema.names == NAMES and [int(f.metadata[b"PARQUET:field_id"]) for f in schema] == list(range(1, 11)) and all(f.nullable for f in schema)
        assert str(schema.field("nation_id").type) == "int64" and str(schema.field("balance").type) == "double"


def test_fewer_files_and_several_batches(spark):
    rows = clients(3000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        assert digests(drift.rewritten(spark.createDataFrame(rows, FIELDS), "client_id", files=7)) == expected(rows, 7)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_ranks_with_hot_keys(spark):
    ids = [7] * 400 + [None] * 300 + [11] * 5 + list(range(1000, 1500)) + [40] * 150
    df = spark.createDataFrame([(i, k) for k, i in enumerate(ids)], "id long, k long").repartition(5)
    got = drift.exact_ranks(df, "id", hot_rows=20)
    rows = sorted(got.collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in rows] == list(range(len(ids))) and {r.n for r in rows} == {len(ids)}
    assert sorted(r.k for r in rows) == list(range(len(ids)))
    assert [r.id for r in rows] == sorted(ids, key=lambda i: (crc(i), -1 if i is None else i))
    # the ranks of one run hold however often they are asked for
    assert sorted(map(str, got.collect())) == sorted(map(str, got.collect()))


def test_hot_key_neighbours_in_one_bucket(spark):
    """Keys of one bucket before, between and behind two hot ones."""
    bucket = lambda i: crc(i) >> (32 - drift.BUCKET_BITS)
    near = sorted((i for i in range(60_000) if bucket(i) == bucket(1)), key=crc)
    a, b = near[len(near) // 3], near[2 * len(near) // 3]
    ids = near + [a] * 100 + [b] * 90
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(4)
    got = [r.id for r in sorted(drift.exact_ranks(df, "id", hot_rows=30).collect(), key=lambda r: r["rank"])]
    assert got == sorted(ids, key=lambda i: (crc(i), i))


def test_nulls_repeats_and_not_finite(spark):
    rows = clients(40)
    rows += rows[:5] + [(None,) * 10, (None,) * 10] + [(10**6 + k, *(None,) * 8, x) for k, x in enumerate((math.nan, math.inf, -math.inf))]
    assert digests(drift.rewritten(spark.createDataFrame(rows, FIELDS), "client_id", files=4)) == expected(rows, 4)


def test_clashing_columns(spark):
    rows = clients(60)
    df = spark.createDataFrame(rows, FIELDS)
    clash = df.selectExpr("*", "'x' AS rank", "1 AS n", "2 AS file_no", "3 AS _crc", "4 AS _bucket", "5 AS __at", "6 AS c", "7 AS k")
    ranked = drift.exact_ranks(clash.drop("rank", "n"), "client_id")
    assert {"_crc", "_bucket", "__at"} < set(ranked.columns) and ranked.agg(F.max("rank")).first()[0] == 59
    assert digests(drift.rewritten(clash.select(NAMES), "client_id")) == expected(rows)


def test_a_task_that_runs_again_changes_nothing(spark):
    rows = clients(300)
    folder = drift.new_folder(spark)
    df = spark.createDataFrame(rows, FIELDS)
    started = settle(drift.write_drifted(drift.exact_ranks(df, "client_id"), folder))
    drift.write_drifted(drift.exact_ranks(df, "client_id"), folder).collect()
    final = drift.rewrite(started, drift.evolved_schema(df), folder)
    assert digests(drift.read_back(drift.rewrite(started, drift.evolved_schema(df), folder))) == digests(drift.read_back(final)) == expected(rows)
    assert not os.listdir(f"{folder}-unfinished")
