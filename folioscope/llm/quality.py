"""Quality: a generalised additive model with pairwise interactions.

Each text becomes a few numbers: shares of kinds of bytes and words, repeats, lines, and the worst block of words for each kind. Features are
binned by quantiles of the training rows; shallow trees, fitted in turns to one feature after the other, add up to a lookup table per feature.
Pairs whose coarse grids explain most of what is left get tables of their own in the same way. A score is a sum of table entries, so that a
batch is scored by one addition of looked-up values per feature and pair, and each table can be read by itself.

Null or empty text: the features of no words. Null doc_id: not held out, not learned from. Several labels of a document: the highest. Several
texts of a document: one, chosen by its features. No learnable label: score 0; labels of one kind only: near that label. Repeated documents:
each row is scored. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .toxicity import held_out

#: Labelled rows that the model is fitted on, at most: those with the smallest hash of doc_id.
TRAIN_ROWS = 20_000
#: Words of a block; the worst block shows what is wrong with a part of a text only.
BLOCK = 32

_UPPER = T.byte_set(bytes(range(65, 91)))
_DIGIT = T.byte_set(bytes(range(48, 58)))
_LETTER = T.byte_set(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
_SPACE = ~T.NOT_SPACE
_MARK = ~(_LETTER | _DIGIT | _SPACE)
_SENTENCE = T.byte_set(b".,;:?!'\"()-")

FEATURES = (
    "log_words", "log_bytes", "word_bytes", "short_words", "upper", "digits", "marks", "odd_marks", "bare_words", "marked_words", "upper_words", "same_as_before",
    "distinct_words", "longest_run", "log_line_bytes", "distinct_lines", "sentence_ends", "worst_bare", "worst_marked", "worst_upper", "worst_same", "worst_distinct",
)


@dataclass(frozen=True)
class Boosting:
    """bins: of a feature; grid: bins of a feature in a pair; cycles: over all features, then over all pairs."""

    bins: int = 64
    grid: int = 16
    cycles: int = 120
    pairs: int = 8
    pair_cycles: int = 60
    rate: float = 0.15
    l2: float = 1.0
    least: float = 2.0


@dataclass(frozen=True)
class Model:
    """edges: upper edges of each feature's bins; tables: a row a feature; pairs: (i, j, table over the coarse grids of i and j)."""

    edges: tuple[np.ndarray, ...]
    tables: tuple[np.ndarray, ...]
    coarse: tuple[np.ndarray, ...]
    pairs: tuple[tuple[int, int, np.ndarray], ...]
    intercept: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sums of looked-up values, for rows of features."""
        bins = [np.searchsorted(e, x[:, k], "left") for k, e in enumerate(self.edges)]
        total = np.full(len(x), self.intercept)
        for b, table in zip(bins, self.tables, strict=True):
            total += table[b]
        for i, j, table in self.pairs:
            total += table[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return total


def features(column: pa.Array) -> np.ndarray:
    """A row of FEATURES for each whole text of a string column."""
    raw, offsets = T.utf8(column)
    n = len(offsets) - 1
    starts, ends, counts = T.words(raw, offsets, T.NOT_SPACE)
    edges = np.append(0, np.cumsum(counts))
    row = np.repeat(np.arange(n), counts)

    def sums(inside: np.ndarray) -> np.ndarray:
        return np.append(0, np.cumsum(inside[raw], dtype=np.int64))

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return part / np.maximum(whole, 1)

    letter, upper, digit, mark = (sums(s) for s in (_LETTER, _UPPER, _DIGIT, _MARK))
    odd = sums(_MARK & ~_SENTENCE)
    text = {k: c[offsets[1:]] - c[offsets[:-1]] for k, c in (("letter", letter), ("upper", upper), ("digit", digit), ("mark", mark), ("odd", odd))}
    word = {k: c[ends] - c[starts] for k, c in (("letter", letter), ("upper", upper), ("digit", digit), ("mark", mark))}
    size = np.diff(offsets)
    hashes = T.word_hashes(raw, starts, ends)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    kinds = {
        "bare": (word["letter"] + word["digit"] == 0),
        "marked": (word["mark"] >= 2) & (word["letter"] + word["digit"] > 0),
        "upper": (word["letter"] >= 2) & (2 * word["upper"] >= word["letter"]),
        "same": same,
    }

    def per_row(flags: np.ndarray) -> np.ndarray:
        c = np.append(0, np.cumsum(flags, dtype=np.int64))
        return c[edges[1:]] - c[edges[:-1]]

    # the first place of each word of a text marks it as new
    order = np.lexsort((np.arange(len(hashes)), hashes, row))
    new = np.zeros(len(hashes), bool)
    if len(hashes):
        new[order[0]] = True
        new[order[1:]] = (hashes[order][1:] != hashes[order][:-1]) | (row[order][1:] != row[order][:-1])

    # blocks of BLOCK words, none across two texts; a rest shorter than half a block joins the block before it
    blocks = np.maximum((counts + BLOCK // 2) // BLOCK, counts > 0).astype(np.int64)
    first = np.append(0, np.cumsum(blocks))
    at = np.repeat(edges[:-1], blocks) + (np.arange(first[-1]) - np.repeat(first[:-1], blocks)) * BLOCK
    of_block = np.repeat(np.arange(n), blocks)
    width = np.diff(np.append(at, edges[-1]))

    def worst(flags: np.ndarray) -> np.ndarray:
        out = np.zeros(n)
        if len(at):
            np.maximum.at(out, of_block, np.add.reduceat(flags.astype(np.int64), at) / width)
        return out

    # runs of one word
    run_at = np.flatnonzero(~same)
    longest = np.zeros(n)
    if len(run_at):
        np.maximum.at(longest, row[run_at], np.diff(np.append(run_at, len(same))))

    line_start, line_end, lines = T.words(raw, offsets, ~T.byte_set(b"\n\r"))
    line = T.word_hashes(raw, line_start, line_end)
    line_row = np.repeat(np.arange(n), lines)
    order = np.lexsort((line, line_row))
    fresh = np.ones(len(line), bool)
    fresh[1:] = (line[order][1:] != line[order][:-1]) | (line_row[order][1:] != line_row[order][:-1])
    distinct_lines = np.bincount(line_row[order][fresh], minlength=n)

    last = raw[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    columns = {
        "log_words": np.log2(1 + counts),
        "log_bytes": np.log2(1 + size),
        "word_bytes": share(np.bincount(row, ends - starts, n), counts),
        "short_words": share(per_row(ends - starts <= 3), counts),
        "upper": share(text["upper"], text["letter"]),
        "digits": share(text["digit"], size),
        "marks": share(text["mark"], size),
        "odd_marks": share(text["odd"], size),
        "bare_words": share(per_row(kinds["bare"]), counts),
        "marked_words": share(per_row(kinds["marked"]), counts),
        "upper_words": share(per_row(kinds["upper"]), counts),
        "same_as_before": share(per_row(same), counts),
        "distinct_words": share(per_row(new), counts),
        "longest_run": np.log2(1 + longest),
        "log_line_bytes": np.log2(1 + share(size, lines)),
        "distinct_lines": share(distinct_lines, lines),
        "sentence_ends": share(per_row(T.byte_set(b".?!")[last]), counts),
        "worst_bare": worst(kinds["bare"]),
        "worst_marked": worst(kinds["marked"]),
        "worst_upper": worst(kinds["upper"]),
        "worst_same": worst(same),
        "worst_distinct": worst(~new),
    }
    return np.column_stack([columns[k] for k in FEATURES]).astype(np.float32)


def _split(g: np.ndarray, h: np.ndarray, boosting: Boosting) -> tuple[float, int]:
    """Best gain of cutting a histogram behind a bin, and that bin; -1 where no cut leaves enough on both sides."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    all_g, all_h = g.sum(), h.sum()
    gain = left_g**2 / (left_h + boosting.l2) + (all_g - left_g) ** 2 / (all_h - left_h + boosting.l2) - all_g**2 / (all_h + boosting.l2)
    gain[(left_h < boosting.least) | (all_h - left_h < boosting.least)] = 0
    if not len(gain) or gain.max() <= 1e-9:
        return 0.0, -1
    return float(gain.max()), int(gain.argmax())


def _tree(g: np.ndarray, h: np.ndarray, boosting: Boosting, depth: int = 2) -> np.ndarray:
    """Leaf values, a bin each, of a tree of at most `depth` levels over a feature's histogram."""
    gain, cut = _split(g, h, boosting) if depth else (0.0, -1)
    if cut < 0:
        return np.full(len(g), -g.sum() / (h.sum() + boosting.l2))
    return np.concatenate([_tree(g[: cut + 1], h[: cut + 1], boosting, depth - 1), _tree(g[cut + 1 :], h[cut + 1 :], boosting, depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray, boosting: Boosting) -> tuple[np.ndarray, float]:
    """Leaf values over a grid: a cut of one feature, then one of the other on either side; and the gain. The better of both orders."""
    best, gain = np.full(g.shape, -g.sum() / (h.sum() + boosting.l2)), 0.0
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        first, cut = _split(a.sum(1), b.sum(1), boosting)
        if cut < 0:
            cut = a.shape[0] // 2 - 1
        total, parts = first, []
        for side in (slice(0, cut + 1), slice(cut + 1, None)):
            more, _ = _split(a[side].sum(0), b[side].sum(0), boosting)
            parts.append(np.broadcast_to(_tree(a[side].sum(0), b[side].sum(0), boosting, 1), a[side].shape))
            total += more
        if total > gain:
            found = np.concatenate(parts)
            best, gain = (found.T if turned else found), total
    return best, gain


def fit(x: np.ndarray, y: np.ndarray, boosting: Boosting | None = None) -> Model:
    """Fits tables to rows of features and labels 0 or 1."""
    o = boosting or Boosting()
    if not len(y):
        zero = np.zeros(0, np.float32)
        return Model((zero,) * x.shape[1], (np.zeros(1),) * x.shape[1], (np.zeros(1, np.int64),) * x.shape[1], (), -35.0)
    edges = tuple(np.unique(np.quantile(x[:, k], np.arange(1, o.bins) / o.bins, method="lower")) for k in range(x.shape[1]))
    bins = [np.searchsorted(e, x[:, k], "left") for k, e in enumerate(edges)]
    widths = [len(e) + 1 for e in edges]
    mean = (y.sum() + 0.5) / (len(y) + 1)
    intercept = float(np.log(mean / (1 - mean)))
    margin = np.full(len(y), intercept)
    tables = [np.zeros(w) for w in widths]

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(o.cycles):
        for k, b in enumerate(bins):
            g, h = slopes()
            step = o.rate * _tree(np.bincount(b, g, widths[k]), np.bincount(b, h, widths[k]), o)
            tables[k] += step
            margin += step[b]

    coarse = tuple(np.arange(w) * min(o.grid, w) // w for w in widths)
    cells = [c[b] for c, b in zip(coarse, bins, strict=True)]
    sizes = [int(c[-1]) + 1 for c in coarse]

    def grids(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = slopes()
        both = cells[i] * sizes[j] + cells[j]
        return (np.bincount(both, v, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j]) for v in (g, h))

    gains = sorted(((_pair_tree(*grids(i, j), o)[1], i, j) for i, j in combinations([k for k, w in enumerate(sizes) if w > 1], 2)), reverse=True)
    chosen = [(i, j) for gain, i, j in gains[: o.pairs] if gain > 0]
    grid = {p: np.zeros((sizes[p[0]], sizes[p[1]])) for p in chosen}
    for _ in range(o.pair_cycles):
        for i, j in chosen:
            step = o.rate * _pair_tree(*grids(i, j), o)[0]
            grid[i, j] += step
            margin += step[cells[i], cells[j]]
    return Model(edges, tuple(tables), coarse, tuple((i, j, t) for (i, j), t in grid.items()), intercept)


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """x and label of at most `limit` labelled documents that are not held out, a row each."""
    chosen = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), 3, 1))
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("label"))
        .withColumn("order", F.xxhash64("doc_id"))
        .orderBy("order", "doc_id")
        .limit(limit)
    )
    # `limit` rows of three numbers: a proven bound for the broadcast. Texts become numbers where they stand, and only those are shuffled.
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "order", "text")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in T.steps(batch, "text"):
                x = pa.FixedSizeListArray.from_arrays(pa.array(features(part.column("text")).ravel()), len(FEATURES)).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), part.column("order"), x], ["doc_id", "label", "order", "x"])

    rows = found.mapInArrow(run, "doc_id long, label int, order long, x array<float>")
    return rows.groupBy("doc_id").agg(F.min("x").alias("x"), F.first("label").alias("label"), F.first("order").alias("order")).select("x", "label", "order")


def train(rows: DataFrame, boosting: Boosting | None = None) -> Model:
    """Fits rows of (x, label, order), whose number the caller bounds, in one task; only the tables leave it."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xs, ys = [np.zeros((0, len(FEATURES)), np.float32)], [np.zeros(0, np.int64)]
        for batch in source:
            xs.append(np.asarray(pc.list_flatten(batch.column("x"))).reshape(-1, len(FEATURES)))
            ys.append(batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64))
        m = fit(np.concatenate(xs), np.concatenate(ys), boosting)
        found = [("edges", k, 0, v) for k, v in enumerate(m.edges)] + [("table", k, 0, v) for k, v in enumerate(m.tables)] + [("coarse", k, 0, v) for k, v in enumerate(m.coarse)]
        found += [("pair", i, j, t.ravel()) for i, j, t in m.pairs] + [("intercept", 0, 0, np.array([m.intercept]))]
        kinds, i, j, values = zip(*found, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([v.astype(np.float64) for v in values], pa.list_(pa.float64()))], ["kind", "i", "j", "value"])

    one = rows.repartition(1).sortWithinPartitions("order", "x").select("x", "label")
    got = one.mapInArrow(run, "kind string, i int, j int, value array<double>").collect()
    if not got:
        return fit(np.zeros((0, len(FEATURES)), np.float32), np.zeros(0, np.int64))
    part = {k: {(r.i, r.j): np.array(r.value) for r in got if r.kind == k} for k in ("edges", "table", "coarse", "pair", "intercept")}
    edges, tables, coarse = (tuple(part[k][i, 0].astype(t) for i in range(len(FEATURES))) for k, t in (("edges", np.float32), ("table", np.float64), ("coarse", np.int64)))
    pairs = tuple((i, j, v.reshape(int(coarse[i][-1]) + 1, int(coarse[j][-1]) + 1)) for (i, j), v in part["pair"].items())
    return Model(edges, tables, coarse, pairs, float(part["intercept"][0, 0][0]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the probability of label 1 of every whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in T.steps(batch, "text"):
                margin = model.margin(features(part.column("text")))
                yield T.batches({"doc_id": part.column("doc_id"), "score": 1 / (1 + np.exp(-np.clip(margin, -35, 35)))}, schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    return score(docs, model).select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
