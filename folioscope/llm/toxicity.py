"""Toxicity: FTRL-proximal logistic regression over hashed word 1-grams (surface forms and stems), 2-grams and skip-grams.

Each coordinate has its own rate; L1 makes the weights sparse, so what is broadcast is at most 2^DIM_BITS pairs and usually a few hundred.
A feature counts once per text, however often it stands there, so a long text is not outvoted by its length.

Null or empty text: the intercept's score. Null doc_id: not held out, not learned from. Several labels of a document: the
highest. No learnable label: score 0. Repeated documents: each row is scored. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T

DIM_BITS = 20
#: Bytes of the stems that count as 1-grams besides the words: inflected words share them.
STEMS = (4, 5, 6)
#: Labelled rows that the model is fitted on, at most: those with the smallest hash of doc_id.
TRAIN_ROWS = 12_000

_INSIDE = T.byte_set(b"0123456789abcdefghijklmnopqrstuvwxyz'")
_INSIDE[128:] = True


@dataclass(frozen=True)
class Ftrl:
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 2.0
    l2: float = 0.1
    epochs: int = 6


@dataclass(frozen=True)
class Model:
    index: np.ndarray
    weight: np.ndarray
    intercept: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << DIM_BITS, np.float32)
        out[self.index] = self.weight
        return out


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hashed index of every 1-gram (of words and of their stems), 2-gram and 1-skip-2-gram of a string column."""
    raw, offsets = T.utf8(pc.utf8_lower(column.cast(pa.large_string())))
    starts, ends, counts = T.words(raw, offsets, _INSIDE)
    h = T.word_hashes(raw, starts, ends)
    row = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    rows, found = [row], [h]
    for size in STEMS:
        long = ends - starts > size
        rows.append(row[long])
        found.append(T.mix(T.word_hashes(raw, starts[long], starts[long] + size) + T.U64(size)))
    for gap, salt in ((1, 3), (2, 5)):
        if len(h) > gap:
            same = row[gap:] == row[:-gap]
            rows.append(row[gap:][same])
            found.append(T.mix(h[:-gap][same] * T.U64(salt) + h[gap:][same]))
    return np.concatenate(rows), (np.concatenate(found) >> T.U64(64 - DIM_BITS)).astype(np.int32)


def train(labelled: DataFrame, ftrl: Ftrl | None = None) -> Model:
    """Fits rows of (text, label, order); the caller bounds their number. One task streams over them; only non-zero weights leave it."""
    ftrl = ftrl or Ftrl()

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples: list[tuple[np.ndarray, int]] = []
        for batch in source:
            for part in T.steps(batch, "text"):
                row, index = features(part.column("text"))
                pairs = np.unique(row.astype(np.int64) << DIM_BITS | index)
                edges = np.searchsorted(pairs, np.arange(part.num_rows + 1, dtype=np.int64) << DIM_BITS)
                for r, y in enumerate(part.column("label").to_pylist()):
                    examples.append(((pairs[edges[r] : edges[r + 1]] & ((1 << DIM_BITS) - 1)).astype(np.int32), y))
        z, n = np.zeros(1 << DIM_BITS), np.zeros(1 << DIM_BITS)
        z0 = n0 = 0.0

        def intercept(z0: float, n0: float) -> float:
            return -z0 / ((ftrl.beta + np.sqrt(n0)) / ftrl.alpha)

        def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
            return np.where(np.abs(z) <= ftrl.l1, 0.0, -(z - np.sign(z) * ftrl.l1) / ((ftrl.beta + np.sqrt(n)) / ftrl.alpha + ftrl.l2))

        for _ in range(ftrl.epochs):
            for index, y in examples:
                zi, ni = z[index], n[index]
                w = weights(zi, ni)
                w0 = intercept(z0, n0)
                g = 1 / (1 + np.exp(-np.clip(w.sum() + w0, -35, 35))) - y
                after = ni + g * g
                z[index] = zi + g - (np.sqrt(after) - np.sqrt(ni)) / ftrl.alpha * w
                n[index] = after
                z0 += g - (np.sqrt(n0 + g * g) - np.sqrt(n0)) / ftrl.alpha * w0
                n0 += g * g
        w = weights(z, n)
        kept = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(kept, -1), pa.int64()), pa.array(np.append(w[kept], intercept(z0, n0) if examples else -35.0), pa.float64())], ["index", "weight"])

    got = labelled.select("text", F.col("label").cast("int").alias("label"), "order").repartition(1).sortWithinPartitions("order", "text").select("text", "label").mapInArrow(run, "index long, weight double").toPandas()
    if got.empty:
        return Model(np.zeros(0, np.int64), np.zeros(0), -35.0)
    own = got["index"].to_numpy() >= 0
    return Model(got["index"].to_numpy()[own], got["weight"].to_numpy()[own], float(got["weight"].to_numpy()[~own][0]))


def held_out(doc_id: Column, modulus: int = 5, remainder: int = 0) -> Column:
    """Whether crc32 of the id as text leaves this remainder."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """text, label, order of at most `limit` labelled documents that are not held out, a row each: of several texts of a doc_id, the least."""
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("label"))
        .withColumn("order", F.xxhash64("doc_id"))
        .orderBy("order", "doc_id")
        .limit(limit)
    )
    # `limit` rows of three numbers: a proven bound for the broadcast
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"), F.first("order").alias("order")).select("text", "label", "order")


def _scores(part: pa.RecordBatch, weight: np.ndarray, intercept: float) -> np.ndarray:
    row, index = features(part.column("text"))
    hit = np.flatnonzero(weight[index])
    pairs = np.unique(row[hit].astype(np.int64) << DIM_BITS | index[hit])
    total = np.bincount(pairs >> DIM_BITS, weight[pairs & ((1 << DIM_BITS) - 1)], minlength=part.num_rows) + intercept
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the probability of label 1 of every whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = model.dense()
        for batch in source:
            for part in T.steps(batch, "text"):
                yield T.batches({"doc_id": part.column("doc_id"), "score": _scores(part, weight, model.intercept)}, schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows, with all their columns, that score below the threshold."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = model.dense()
        for batch in source:
            for part in T.steps(batch, "text"):
                yield part.filter(pa.array(_scores(part, weight, model.intercept) < threshold))

    return docs.mapInArrow(run, docs.schema)
