import math
import os
import random

import pytest
from folioscope.llm import pivot_search
from pyspark.sql import functions as F


def brute(rows, k):
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in {(i, tuple(v)) for i, v in fine if i % 10 == 0}:
        best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in fine if j != i and len(w) == len(v))[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("group_bytes", [1 << 25, 2000])
def test_against_brute_force(spark, monkeypatch, group_bytes):
    monkeypatch.setattr(pivot_search, "TILE", 64)
    monkeypatch.setattr(pivot_search, "STEP", 8)
    r = random.Random(group_bytes)
    centers = [[r.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [c + r.gauss(0, 0.1) for c in r.choice(centers)]) for i in range(300)]
    rows += [(1000 + i, list(centers[0])) for i in range(80)] + [(7, [1.0] * 6), (7, [1.0] * 6), (20, [1.0] * 6), (20, [1.0] * 6)]
    rows += [(400, None), (410, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (420, [1.0, float("nan"), 1.0, 1.0, 1.0, 1.0]), (430, [float("inf")] * 6), (None, [1.0] * 6), (440, [1.0, 2.0]), (441, [1.0, 3.0]), (450, [1e6] * 6), (451, [-1e6] * 6), (460, [])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, score int").repartition(4)
    got = sorted((x.query_id, x.rank, x.vec_id, x.score) for x in pivot_search.top_k(df, F.col("id") % 10 == 0, group_bytes=group_bytes).collect())
    assert got == brute(rows, 5)


def test_elimination_and_empty(spark):
    import numpy as np

    r = np.random.default_rng(1)
    v = np.floor(256 * (np.repeat(r.normal(size=(50, 16)), 100, 0) + r.normal(size=(5000, 16)) * 0.02))
    q = pivot_search.Queries(np.arange(20), np.arange(20), v[:20], pivot_search.choose_pivots(v[::7], 16), np.full(20, np.iinfo(np.int64).min), 5)
    for a in range(0, 5000, 500):
        q.meet(np.arange(a, a + 500), v[a : a + 500])
    assert q.evaluated < 20 * 5000 / 3
    df = spark.createDataFrame([(10, [1.0])], "vec_id long, embedding array<float>")
    assert pivot_search.top_k(df, F.col("id") % 10 == 0).count() == 0
    assert pivot_search.top_k(df.limit(0), F.col("id") % 10 == 0).count() == 0


def test_memory_follows_the_chunk_and_not_the_queries():
    import tracemalloc

    import numpy as np

    r = np.random.default_rng(2)
    v = np.floor(256 * r.normal(size=(20_000, 64)) / 8)
    q = pivot_search.Queries(np.arange(len(v)), np.arange(len(v)), v, pivot_search.choose_pivots(v[:500], 48), np.full(len(v), np.iinfo(np.int64).min), 5)
    tracemalloc.start()
    q.meet(np.arange(1024), v[:1024])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no driver tables")
def test_pivots_eliminate_on_the_driver_vectors():
    import numpy as np
    import pyarrow.parquet as pq

    rows = pq.read_table("/root/testdata/sf0.1/embeddings.parquet", columns=["vec_id", "embedding"]).combine_chunks().to_batches()[0]
    ((ids, v),) = pivot_search.vectors(rows.column(0), rows.column(1))
    own = ids % 50 == 0
    least = pivot_search._thresholds(ids[own], v[own], ids, v, 5)
    q = pivot_search.Queries(ids[own], ids[own], v[own], pivot_search.choose_pivots(v, pivot_search.PIVOTS), least, 5)
    for a in range(0, len(ids), pivot_search.TILE):
        q.meet(ids[a : a + pivot_search.TILE], v[a : a + pivot_search.TILE])
    assert q.evaluated < 0.35 * own.sum() * len(ids)
    print(q.evaluated / own.sum() / len(ids))
