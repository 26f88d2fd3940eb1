"""SimHash near-duplicates by pivot distance tables.

Every text gets a 64-bit fingerprint of its word shingles. Equal fingerprints collapse to one node first, so thousands of copies
are one row. Each node has a row of Hamming distances to many reference fingerprints (the pivots); two nodes whose rows differ by more
than the radius anywhere can't be within it. The table is swept in the order of its first pivot within cells of nodes that agree
on some of the fingerprint's bit blocks: with `radius` differing bits over k blocks, k - radius blocks agree, so no pair is lost; the
other pivots discard pairs, and survivors are verified. In a dense cell a grid over the distances to two pivots says which rows a row has to be
compared with. A cell yields a star of links at most, never its pairs.

Null or empty text: fingerprint zero, linked like any other. Null doc_id: takes part; a component without any other id
has a null component_id. Repeated rows stay. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .components import components
from .lineage import settle

SHINGLE, SEED, RADIUS, PIVOTS = 3, 42, 3, 24
#: Fingerprints of one cell from which on it is handled as dense, and members that are tried as centers there.
DENSE, CENTERS = 512, 32
_LOWER = bytes(T.LOWER)
_ONES = T.U64(0x0101010101010101)


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    runs = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [words]
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(b" ".join(r), seed) for r in runs], np.uint64))


def majority(h: np.ndarray) -> int:
    """The fingerprint of these hashes."""
    n = len(h)
    padded = np.zeros(-(-n // 255) * 255, np.uint64)
    padded[:n] = h
    counts = np.zeros((8, 8), np.int64)  # byte, bit
    for k in range(8):  # eight bits at a time, each in a byte of its own; 255 of them can't overflow
        sums = ((padded >> T.U64(k)) & _ONES).reshape(-1, 255).sum(1, dtype=np.uint64)
        counts[:, k] = sums.astype("<u8").view(np.uint8).reshape(-1, 8).sum(0)
    return int.from_bytes(np.packbits((counts.ravel() * 2 > n), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in T.steps(batch, "text"):
                raw, offsets = T.utf8(part.column("text"))
                whole, at = raw.tobytes(), offsets.tolist()
                fps = [fingerprint(whole[a:b], shingle, seed) for a, b in zip(at, at[1:], strict=False)]
                yield T.batches({"doc_id": part.column("doc_id"), "fp": np.array(fps, np.uint64).view(np.int64)}, schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints, by rule."""
    return T.mix(np.arange(1, n + 1, dtype=np.uint64) * T.U64(0x9E3779B97F4A7C15))


def blocks_for(nodes: int) -> int:
    """Bit blocks for so many nodes: agreeing blocks leave a few nodes to a cell on average."""
    return 5 if nodes <= 1 << 28 else 6 if nodes <= 1 << 35 else 7


def _cells(fp: Column, blocks: int, radius: int) -> Column:
    """A cell key for each choice of blocks that may agree."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for n, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(n), fp.bitwiseAND(F.lit(signed))))
    return F.array(*keys)


def pivot_grid(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by their distances to the first two pivots, and where each of the 65 x 65 pairs of distances starts in it."""
    code = table[:, 0].astype(np.int64) * 65 + table[:, 1]
    return np.argsort(code, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(code, minlength=65 * 65))])


def grid_slices(starts: np.ndarray, x: int, y: int, radius: int) -> list[tuple[int, int]]:
    """Parts of the grid's order whose distances differ from (x, y) by the radius at most: no row within the radius is elsewhere."""
    low, high = max(y - radius, 0), min(y + radius, 64) + 1
    return [(int(starts[65 * v + low]), int(starts[65 * v + high])) for v in range(max(x - radius, 0), min(x + radius, 64) + 1)]


def _star_links(key: np.ndarray, fp: np.ndarray, radius: int, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of each node to the first of its component, among rows sorted by (key, first pivot's distance)."""
    n = len(fp)
    label = np.arange(n)
    near = table[:, 0].astype(np.int16)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merge() -> None:
        nonlocal held, size
        if not held:
            return
        i, j = (np.concatenate(x) for x in zip(*held, strict=True))
        held, size = [], 0
        while True:
            a, b = label[i], label[j]
            low = np.minimum(a, b)
            if (a == b).all():
                return
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            while (label[label] != label).any():
                label[:] = label[label]

    # a dense cell: whoever is near one of a few members is linked to it; only what stays outside the largest component needs a look at all
    edges = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if n else np.zeros(0, np.int64)
    sparse = np.ones(n, bool)
    for begin, end in zip(edges, [*edges[1:], n][: len(edges)], strict=True):
        if end - begin <= DENSE:
            continue
        sparse[begin:end] = False
        order, starts = pivot_grid(table[begin:end])
        place, own = begin + order, fp[begin + order]

        def around(k: int, place: np.ndarray = place, own: np.ndarray = own, starts: np.ndarray = starts) -> np.ndarray:
            """Rows of the cell within the radius of row k: those that two pivots leave are verified."""
            slices = grid_slices(starts, int(table[k, 0]), int(table[k, 1]), radius)
            close = np.flatnonzero(np.bitwise_count(np.concatenate([own[a:b] for a, b in slices]) ^ fp[k]) <= radius)
            return np.concatenate([place[a:b] for a, b in slices])[close]

        rest = np.arange(begin, end)
        for _ in range(CENTERS):
            close = around(rest[0])
            held.append((np.full(len(close), rest[0]), close))
            rest = rest[np.bitwise_count(fp[rest] ^ fp[rest[0]]) > radius]
            if not len(rest):
                break
        merge()
        names, sizes = np.unique(label[begin:end], return_counts=True)
        for k in begin + np.flatnonzero(label[begin:end] != names[sizes.argmax()]):
            close = around(k)
            held.append((np.full(len(close), k), close))
            size += len(close)
            if size > 4 * n:
                merge()
        merge()
    i = np.flatnonzero(sparse)
    for step in range(1, n):
        i = i[i + step < n]
        i = i[(key[i] == key[i + step]) & (near[i + step] - near[i] <= radius)]
        if not len(i):
            break
        j = i + step
        apart = label[i] != label[j]
        a, b = i[apart], j[apart]
        for c in range(1, table.shape[1]):
            if not len(a):
                break
            fine = np.abs(table[a, c].astype(np.int16) - table[b, c]) <= radius
            a, b = a[fine], b[fine]
        close = np.bitwise_count(fp[a] ^ fp[b]) <= radius
        if close.any():
            held.append((a[close], b[close]))
            size += int(close.sum())
            if size > 4 * n:
                merge()
    merge()
    linked = np.flatnonzero(label != np.arange(n))
    return fp[linked], fp[label[linked]]


def links(nodes: DataFrame, radius: int = RADIUS, blocks: int = 5) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp`: not all pairs, but enough to connect all that are within the radius."""
    refs = pivots()
    first = int(refs[0])
    signed = first - (1 << 64) if first >> 63 else first
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in source:
            if not batch.num_rows:
                continue
            key = np.concatenate([key, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(2).to_numpy().view(np.uint64)])
            alone = np.ones(len(key), bool)
            same = key[1:] == key[:-1]
            alone[1:] &= ~same
            alone[:-1] &= ~same
            k, f = key[~alone], fp[~alone]
            table = np.bitwise_count(f[:, None] ^ refs[None, :])
            a, b = _star_links(k, f, radius, table)
            if len(a):
                yield T.batches({"a": a.view(np.int64), "b": b.view(np.int64)}, schema)
            near = np.bitwise_count(fp ^ refs[0])
            open_ = (key == key[-1]) & (near + radius >= near[-1])
            key, fp = key[open_], fp[open_]

    dealt = nodes.select(F.explode(_cells(F.col("fp"), blocks, radius)).alias("cell"), "fp").withColumn("near", F.bit_count(F.col("fp").bitwiseXOR(F.lit(signed))))
    return dealt.repartition("cell").sortWithinPartitions("cell", "near").select("cell", "near", "fp").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id that links reach) of every row."""
    prints = settle(fingerprints(docs, shingle))
    nodes = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(nodes, radius, blocks_for(nodes.count())))
    # only components of several fingerprints need another look; the rest have their own smallest id
    member = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    least = member.join(nodes, member.node == nodes.fp).groupBy("root").agg(F.min("first").alias("component_id"))
    linked = member.join(least, "root").select(F.col("node").alias("fp"), "component_id")
    # a table of its own, so that both sides of the last join are plain exchanges and Spark may split a fingerprint of many copies
    of = settle(nodes.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id")))
    return prints.join(of, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with all its columns.

    Rows without a doc_id can't be told apart and stay. Rows that repeat a doc_id stay if one of them is to stay.
    """
    found = near_duplicates(docs, shingle, radius)
    gone = found.groupBy("doc_id").agg(F.max(F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))).alias("stays")).where("not stays").select("doc_id")
    return docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
