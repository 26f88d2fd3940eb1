"""Exact top-k inner products by pivot-table elimination.

Each vector has a row of distances to many pivots, kept as its place in the space that the pivots span and its distance from that space, which
say the same. The row bounds the distance of two vectors from below, and so their inner product from above: places apart and distances from the
space apart, put together, are the largest lower bound that the rows allow, never less than their largest difference. A task meets candidates
in tiles; in each tile a query evaluates candidates in order of their bounds and stops when the next bound can't reach its k-th score. The
first threshold of a query comes from a bounded sample of real candidates, so most of what is far is never evaluated, and nothing is approximate.
A candidate's row costs one product with the pivots, far less than the bounds of a group of queries, so it isn't stored.

Queries are dealt into groups of bounded size; each group is broadcast once and scans all candidates where they lie, so candidates are
never shuffled and no pairs are emitted: a task returns k rows per query at most.

Vectors null, or with null or non-finite components, and null ids take no part. Only vectors of the query's length are its candidates. Ties go to the smaller id. Repeated
rows are candidates each; a repeated query row counts once. Fewer than k candidates: all. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import settle

SCALE, PIVOTS, SAMPLE, TILE, STEP = 256, 48, 2048, 1024, 64
#: Queries that meet a tile at a time, which bounds the memory whatever their number.
CHUNK = 256
#: Bytes of a group of queries, which is broadcast.
GROUP_BYTES = 32 << 20


def vectors(ids: pa.Array, column: pa.Array, scale: int = SCALE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and integer vectors (as doubles) of the rows that take part, one pair for each length of vectors."""
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    ids_null = ids.is_null().to_numpy(zero_copy_only=False)
    ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
    starts = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
    for dim in np.unique(sizes[sizes >= 0]):
        rows = np.flatnonzero((sizes == dim) & ~ids_null)
        v = flat[starts[rows][:, None] + np.arange(dim)]
        fine = np.isfinite(v).all(1)
        if fine.any():
            yield ids[rows[fine]], np.floor(scale * v[fine])


def _exact(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether doubles hold every sum of products of the two."""
    return not a.size or not b.size or a.shape[-1] * np.abs(a).max() * np.abs(b).max() < 2.0**53


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of a with all rows of b."""
    return (a @ b.T).astype(np.int64) if _exact(a, b) else a.astype(np.int64) @ b.astype(np.int64).T


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Vectors of the sample far from each other: each next one is the farthest from those chosen."""
    chosen = [0]
    far = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


@dataclass
class Queries:
    """Queries of one length, their pivot table, and their best scores so far."""

    ids: np.ndarray
    tags: np.ndarray
    v: np.ndarray
    pivots: np.ndarray
    least: np.ndarray  # scores that k real candidates reach
    k: int

    def __post_init__(self) -> None:
        n = len(self.ids)
        self.basis = np.linalg.qr(self.pivots.T)[0]
        self.place, self.apart, self.norms = rows_of(self.v, self.basis)
        self.best = np.full((n, self.k), np.iinfo(np.int64).min)
        self.best_ids = np.full((n, self.k), np.iinfo(np.int64).max)
        self.evaluated = 0

    def meet(self, ids: np.ndarray, v: np.ndarray) -> None:
        """Evaluates a tile of candidates, each query in the order of their bounds until the exact stop."""
        place, apart, norms = rows_of(v, self.basis)
        exact = _exact(self.v, v)
        for at in range(0, len(self.ids), CHUNK):
            own = slice(at, at + CHUNK)
            bound = self.place[own] @ place.T + self.apart[own, None] * apart[None, :]
            bound += 1e-9 * (self.norms[own, None] + norms[None, :] + 1) + 1e-6
            self._meet(np.arange(at, at + len(bound)), bound, ids, v, exact)

    def _meet(self, alive: np.ndarray, bound: np.ndarray, ids: np.ndarray, v: np.ndarray, exact: bool) -> None:
        fine = np.flatnonzero(bound.max(1) >= np.maximum(self.least[alive], self.best[alive, -1]))
        alive, bound = alive[fine], bound[fine]
        order = np.argsort(-bound, axis=1, kind="stable")
        for at in range(0, len(ids), STEP):
            chosen = order[:, at : at + STEP]
            going = np.take_along_axis(bound, chosen[:, :1], 1)[:, 0] >= np.maximum(self.least[alive], self.best[alive, -1])
            if not going.any():
                return
            alive, bound, order, chosen = alive[going], bound[going], order[going], chosen[going]
            met = v[chosen]
            score = (np.matmul(met, self.v[alive][:, :, None])[:, :, 0] if exact else np.einsum("qd,qcd->qc", self.v[alive].astype(np.int64), met.astype(np.int64))).astype(np.int64)
            self.evaluated += score.size
            found = ids[chosen]
            score[found == self.ids[alive][:, None]] = np.iinfo(np.int64).min
            better = np.flatnonzero((score >= np.maximum(self.least[alive], self.best[alive, -1])[:, None]).any(1))
            if not len(better):
                continue
            rows = alive[better]
            scores = np.concatenate([self.best[rows], score[better]], 1)
            names = np.concatenate([self.best_ids[rows], found[better]], 1)
            names[scores == np.iinfo(np.int64).min] = np.iinfo(np.int64).max
            top = np.lexsort((names, np.invert(scores)), axis=1)[:, : self.k]  # -scores - 1, which can't overflow
            self.best[rows] = np.take_along_axis(scores, top, 1)
            self.best_ids[rows] = np.take_along_axis(names, top, 1)


def rows_of(v: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in the space of the pivots, distances from it (rounded up, so that bounds stay bounds), and squared lengths."""
    place, norms = v @ basis, (v**2).sum(1)
    return place, np.sqrt(np.maximum(norms - (place**2).sum(1), 0) + 1e-9 * (norms + 1)), norms


def _thresholds(ids: np.ndarray, v: np.ndarray, sample_ids: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each query within the sample, without its own rows; none if the sample has too few others."""
    none = np.full(len(ids), np.iinfo(np.int64).min)
    if len(sample) <= k:
        return none
    out = none
    for a in range(0, len(ids), CHUNK):
        score = products(v[a : a + CHUNK], sample)
        score[sample_ids[None, :] == ids[a : a + CHUNK, None]] = np.iinfo(np.int64).min
        out[a : a + CHUNK] = np.invert(np.partition(np.invert(score), k - 1, axis=1)[:, k - 1])
    return out


def top_k(vecs: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", n_pivots: int = PIVOTS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every query row."""
    spark = vecs.sparkSession
    rows = vecs.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    sample = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow().combine_chunks()
    samples = {v.shape[1]: (ids, v) for b in sample.to_batches() for ids, v in vectors(b.column(0), b.column(1))}
    pivots = {dim: choose_pivots(v, min(n_pivots, dim)) for dim, (_, v) in samples.items()}
    queries = rows.where(is_query & F.col("id").isNotNull() & F.col("v").isNotNull()).distinct()
    size = queries.agg(F.sum(16 + 8 * F.size("v").cast("long")).alias("n")).first()["n"] or 0
    groups = max(1, -(-size // group_bytes))
    parts = []
    for g in range(groups):
        own = queries.where(F.pmod(F.xxhash64("id", "v"), F.lit(groups)) == g) if groups > 1 else queries
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        # at most about `group_bytes` of queries: a proven bound for the broadcast
        for b in own.toArrow().combine_chunks().to_batches():
            for ids, v in vectors(b.column(0), b.column(1)):
                old = held.get(v.shape[1])
                held[v.shape[1]] = (np.concatenate([old[0], ids]), np.concatenate([old[1], v])) if old else (ids, v)
        shared = spark.sparkContext.broadcast((held, samples, pivots))
        parts.append(rows.mapInArrow(_search(shared, k, g), "query_id long, tag long, vec_id long, score long"))
        if groups > 1:
            parts[-1] = settle(parts[-1])
            shared.destroy()
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    best = Window.partitionBy("query_id", "tag").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(shared, k: int, group: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, samples, pivots = shared.value
        state: dict[int, Queries] = {}
        for batch in source:
            for ids, v in vectors(batch.column(0), batch.column(1)):
                dim = v.shape[1]
                if dim not in held:
                    continue
                if dim not in state:
                    q_ids, q = held[dim]
                    s_ids, s = samples.get(dim, (np.zeros(0, np.int64), np.zeros((0, dim))))
                    tags = (group << 48) + (dim << 32) + np.arange(len(q_ids), dtype=np.int64)  # one for each query row
                    state[dim] = Queries(q_ids, tags, q, pivots.get(dim, np.zeros((0, dim))), _thresholds(q_ids, q, s_ids, s, k), k)
                for a in range(0, len(ids), TILE):
                    state[dim].meet(ids[a : a + TILE], v[a : a + TILE])
        schema = pa.schema([("query_id", pa.int64()), ("tag", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        for q in state.values():
            row, col = np.nonzero(q.best > np.iinfo(np.int64).min)
            yield pa.RecordBatch.from_arrays([pa.array(q.ids[row]), pa.array(q.tags[row]), pa.array(q.best_ids[row, col]), pa.array(q.best[row, col])], schema=schema)

    return run
