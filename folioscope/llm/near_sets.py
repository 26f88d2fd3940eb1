"""SimHash near-duplicates of a Jaccard similarity of 0.8 or more, verified on whole sets of word shingles.

A text is the set of its five-word shingles; equal sets collapse to one node first. The first candidates are what the table of pivot distances
(`simhash.links`) finds within `NEAR` bits of 64-bit fingerprints. Fingerprints of sets of this similarity differ in about ten bits, though, a radius that neither bit
blocks nor distances to pivots can index, so what is further apart comes from a prefix filter: two sets with a similarity of
4/5 or more share a shingle among the first fifth of each, under any order of shingles that all texts keep to, so texts meet under those shingles.
Shingles that a sample of the texts, and then the first fifths themselves, show to be common come last in the order; that steers the time, never the
result.
Pairs that meet and may still be similar by their sizes and places are discarded if their fingerprints differ in more than `RADIUS` bits, and survivors
are verified on the whole sets. Where many nodes meet, they are first held against a few centers; after that, all pairs that are not yet in one component
are looked at too.

The radius loses a pair of exactly 0.8 with a chance below one in ten million (each bit differs with a chance of 0.16, on its own); sets of
under `SMALL` shingles, whose bits differ more often, are always verified. With `radius=None` fingerprints discard nothing, and every pair is found for certain.

Null or empty text: the empty set; equal to any other empty set. A text of under five words is one shingle. Null doc_id: takes part; a component
without any other id has a null component_id. Repeated rows stay. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .components import components
from .lineage import release, settle, size_of
from .simhash import RADIUS as NEAR
from .simhash import blocks_for, links, majority

SHINGLE = 5
#: Bits in which fingerprints of similar sets may differ, and the size of a set from which on they are asked.
RADIUS, SMALL = 28, 16
#: Pairs that a task holds before it sends them on without repeats.
PAIRS = 1 << 18
#: Rows of 8 bytes up to which the texts to verify are named by broadcast; beyond, by a shuffled join.
NAMED = 2_000_000
#: Texts in the sample that tells common shingles, how often one must be seen there, and how many are kept (16 bytes each, which are broadcast).
SAMPLE, OFTEN, COMMON = 10_000, 3, 1_000_000
#: Nodes under one shingle from which on they are held against centers first.
DENSE, CENTERS = 16, 2


def _sets(part: pa.RecordBatch) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    raw, offsets = T.utf8(part.column("text"))
    starts, ends, counts = T.words(raw, offsets, T.NOT_SPACE)
    hashes = T.word_hashes(raw, starts, ends, T.LOWER)
    at = 0
    for n in counts.tolist():
        own = hashes[at : at + n]
        at += n
        yield np.unique(T.gram_hashes(own, min(n, SHINGLE))).view(np.int64) if n else np.zeros(0, np.int64)


def _node(grams: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(grams.tobytes()) - (1 << 63)


Common = tuple[np.ndarray, np.ndarray]  # hashes of common shingles, sorted, and about how many texts hold each


def _prefix(grams: np.ndarray, common: Common) -> np.ndarray:
    """The first fifth of a set, the rarest shingles first."""
    known, often = common
    rank = np.zeros(len(grams), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        rank = np.where(known[at] == grams, often[at], 0)
    return grams[np.lexsort((grams, rank))][: len(grams) - (4 * len(grams) + 4) // 5 + 1]


def _counted(docs: DataFrame, common: Broadcast | None) -> DataFrame:
    """gram and n: how many texts hold each shingle, of all their shingles or of their prefixes in an order."""
    schema = pa.schema([("gram", pa.int64()), ("n", pa.int64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in T.steps(batch, "text"):
                own = [s if common is None else _prefix(s, common.value) for s in _sets(part)]
                grams, n = np.unique(np.concatenate([np.zeros(0, np.int64), *own]), return_counts=True)
                yield T.batches({"gram": grams, "n": n}, schema)

    return docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _common(docs: DataFrame) -> Broadcast:
    """What a sample of the texts shows to be common, and then what still stands in the prefixes of many."""
    context = docs.sparkSession.sparkContext

    def most(counted: DataFrame, least: int) -> Common:
        rows = counted.where(F.col("n") >= least).orderBy(F.desc("n"), "gram").limit(COMMON).toArrow()
        return rows.column("gram").to_numpy(), rows.column("n").to_numpy()

    share = max(1, docs.count() // SAMPLE)
    grams, n = most(_counted(docs.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0), None), OFTEN)
    order = np.argsort(grams)
    first = context.broadcast((grams[order], n[order] * share))
    grams, n = (np.concatenate(x) for x in zip(most(_counted(docs, first), DENSE + 1), first.value, strict=True))
    grams, at = np.unique(grams, return_index=True)  # of both, the count over all texts
    first.destroy()
    return context.broadcast((grams, n[at]))


def _prefixes(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text), node, size, fp and prefix (the first shingles in the common order) of every row."""
    common = _common(docs)
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("node", pa.int64()), ("size", pa.int32()), ("fp", pa.int64()), ("prefix", pa.list_(pa.int64()))])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in T.steps(batch, "text"):
                sets = list(_sets(part))
                fps = np.array([majority(s.view(np.uint64)) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
                columns = {"node": [_node(s) for s in sets], "size": [len(s) for s in sets], "fp": fps, "prefix": [_prefix(s, common.value) for s in sets]}
                yield T.batches({"doc_id": part.column("doc_id"), "key": part.column("key"), **columns}, schema)

    return docs.select("doc_id", _key().alias("key"), "text").mapInArrow(run, "doc_id long, key long, node long, size int, fp long, prefix array<long>")


def _key() -> Column:
    return F.xxhash64("text")


def _may(size: np.ndarray, place: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether sets whose first common shingle stands at these places can be similar."""
    return 9 * np.minimum(size[i] - place[i], size[j] - place[j]) >= 4 * (size[i] + size[j])


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_MET = pa.schema([*_PAIR, ("size", pa.int32()), ("place", pa.int32())])


def _by_token(source: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of a batch or more at a time, cut so that a token (the first column; rows are sorted by it) is never parted."""
    held: list[list[np.ndarray]] = []
    for batch in source:
        if not batch.num_rows:
            continue
        new = [c.to_numpy() for c in batch.columns]
        cut = int(np.searchsorted(new[0], new[0][-1])) if new[0][0] != new[0][-1] else 0
        if held and (cut or held[-1][0][-1] != new[0][0]):
            head = [x[:cut] for x in new]
            yield [np.concatenate(x) for x in zip(*held, head, strict=True)]
            held, new = [], [x[cut:] for x in new]
        elif cut:
            yield [x[:cut] for x in new]
            new = [x[cut:] for x in new]
        held.append(new)
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def _meetings(nodes: DataFrame) -> DataFrame:
    """a, b: pairs of nodes that meet. With a size, a is a token that many nodes share and b one of them."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, node, size, place in _by_token(source):
            edges = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            counts = np.diff(np.append(edges, len(token)))
            first, total = np.repeat(edges, counts), np.repeat(counts, counts)
            few = np.flatnonzero((total > 1) & (total <= DENSE))
            pairs = []
            for step in range(1, DENSE):
                few = few[few + step < first[few] + total[few]]
                if not len(few):
                    break
                i = few[_may(size, place, few, few + step)]
                pairs.append((node[i], node[i + step]))
            many = np.flatnonzero(total > DENSE)
            for k in range(CENTERS):  # the first rows of a token have the fewest rare shingles, as has the text that others were copied from
                i = many[_may(size, place, many, first[many] + k)]
                pairs.append((node[first[i] + k], node[i]))
            a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
            a, b = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1) if len(a) else (a, b)
            none = pa.nulls(len(a), pa.int32())
            yield T.batches({"a": a, "b": b, "size": none, "place": none}, _MET)
            if len(many):
                yield T.batches({"a": token[many], "b": node[many], "size": size[many], "place": place[many]}, _MET)

    rows = nodes.select("node", "size", F.posexplode("prefix").alias("place", "token"))
    return rows.repartition("token").sortWithinPartitions("token", "place", "node").select("token", "node", "size", "place").mapInArrow(run, "a long, b long, size int, place int")


def _apart(dense: DataFrame, roots: DataFrame, prints: DataFrame, radius: int) -> DataFrame:
    """Pairs under shared tokens that may be similar and are in different components still."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, node, size, place, fp, root in _by_token(source):
            edges = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            held, size_held = [np.zeros((2, 0), np.int64)], 0
            for begin, end in zip(edges, [*edges[1:], len(token)], strict=True):
                names, label, sizes = np.unique(root[begin:end], return_inverse=True, return_counts=True)
                for k in np.flatnonzero(label != sizes.argmax()):
                    # a pair within the smaller components comes up from both sides; one is enough
                    other = np.flatnonzero((label != label[k]) & ((label == sizes.argmax()) | (np.arange(end - begin) > k)))
                    other = begin + other[_may(size[begin:end], place[begin:end], np.full(len(other), k), other)]
                    other = other[(np.bitwise_count((fp[other] ^ fp[begin + k]).view(np.uint64)) <= radius) | (np.minimum(size[other], size[begin + k]) < SMALL)]
                    me = np.full(len(other), node[begin + k])
                    held.append(np.sort(np.stack([me, node[other]]), axis=0))
                    size_held += len(other)
                    if size_held >= PAIRS:
                        pairs = np.unique(np.concatenate(held, 1), axis=1)
                        yield T.batches({"a": pairs[0], "b": pairs[1]}, _PAIR)
                        held, size_held = [np.zeros((2, 0), np.int64)], 0
            pairs = np.unique(np.concatenate(held, 1), axis=1)
            yield T.batches({"a": pairs[0], "b": pairs[1]}, _PAIR)

    rows = dense.select(F.col("a").alias("token"), F.col("b").alias("node"), "size", "place").join(prints.select("node", "fp"), "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return rows.repartition("token").sortWithinPartitions("token").select("token", "node", "size", "place", "fp", "root").mapInArrow(run, "a long, b long").distinct()


def _near(pairs: DataFrame, nodes: DataFrame, radius: int) -> DataFrame:
    """The pairs whose fingerprints don't rule them out."""
    one, two = (nodes.select(F.col("node").alias(n), F.col("fp").alias(f"fp_{n}"), F.col("size").alias(f"size_{n}")) for n in "ab")
    close = (F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= radius) | (F.least("size_a", "size_b") < SMALL)
    return pairs.join(one, "a").join(two, "b").where(close).select("a", "b")


def _by_pivots(nodes: DataFrame) -> DataFrame:
    """a, b: nodes whose fingerprints the table of pivot distances finds within `NEAR` bits: not all such pairs, but enough to connect them."""
    first = settle(nodes.groupBy("fp").agg(F.min("node").alias("least")))
    one, two = (first.select(F.col("fp").alias(n), F.col("least").alias(f"node_{n}")) for n in "ab")
    near = links(first.select("fp"), NEAR, blocks_for(first.count())).join(one, "a").join(two, "b").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    same = nodes.join(first, "fp").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    return near.unionByName(same).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs with a similarity of 4/5 or more: the common part is 4/9 of both sizes then."""
    one, two = (sets.select(F.col("node").alias(n), F.col("grams").alias(f"of_{n}")) for n in "ab")
    both = pairs.join(one, "a").join(two, "b")
    return both.where(9 * F.size(F.array_intersect("of_a", "of_b")) >= 4 * (F.size("of_a") + F.size("of_b"))).select("a", "b")


def _sets_of(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """node and grams of the nodes that stand in pairs."""
    schema = pa.schema([("node", pa.int64()), ("grams", pa.list_(pa.int64()))])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in T.steps(batch, "text"):
                sets = list(_sets(part))
                yield T.batches({"node": [_node(s) for s in sets], "grams": sets}, schema)

    wanted = settle(nodes.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi").select("key").distinct(), size_of(pairs))
    texts = docs.select("text", _key().alias("key")).join(F.broadcast(wanted) if wanted.count() <= NAMED else wanted, "key", "left_semi")
    sets = settle(texts.select("text").mapInArrow(run, "node long, grams array<long>").groupBy("node").agg(F.first("grams").alias("grams")))
    release(wanted)
    return sets


def near_duplicates(docs: DataFrame, radius: int | None = RADIUS) -> DataFrame:
    """doc_id, node and component_id (the smallest doc_id that links of similar texts reach) of every row."""
    radius = 64 if radius is None else radius  # no fingerprints differ in more
    wide = settle(_prefixes(docs))
    prints = settle(wide.select("doc_id", "node"), size_of(wide) // 4)
    nodes = settle(wide.groupBy("node").agg(F.min("doc_id").alias("first"), F.min("key").alias("key"), F.first("size").alias("size"), F.first("fp").alias("fp")), 2 * size_of(prints))
    met = settle(_meetings(wide.groupBy("node").agg(F.first("size").alias("size"), F.first("prefix").alias("prefix"))))
    release(wide)
    further = _near(met.where("size IS NULL AND a <> b").select("a", "b").distinct(), nodes, radius)
    pairs = settle(_by_pivots(nodes).unionByName(further).distinct())
    sets = _sets_of(docs, nodes, pairs)
    linked = settle(_similar(pairs, sets))
    roots = components(linked, size_of(pairs))
    dense = met.where("size IS NOT NULL")
    if not dense.limit(1).isEmpty():
        member = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
        more = settle(_apart(dense, member, nodes, radius))
        if not more.isEmpty():
            found = _sets_of(docs, nodes, more)
            known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            roots = components(known.unionByName(_similar(more, found)), size_of(more) + size_of(pairs))
            release(found)
        release(more)
    release(pairs, sets, met, linked)
    member = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    least = member.join(nodes, "node").groupBy("root").agg(F.min("first").alias("component_id"))
    named = member.join(least, "root").select("node", "component_id")
    # a table of its own, so that Spark may split a node of many copies in the last join
    of = settle(nodes.select("node", "first").join(named, "node", "left").select("node", F.coalesce("component_id", "first").alias("component_id")), size_of(nodes))
    release(nodes)
    return prints.join(of, "node").select("doc_id", "node", "component_id")


def keep_first(docs: DataFrame, radius: int | None = RADIUS) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with all its columns.

    Rows without a doc_id can't be told apart and stay. Rows that repeat a doc_id stay if one of them is to stay.
    """
    found = near_duplicates(docs, radius)
    gone = found.groupBy("doc_id").agg(F.max(F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))).alias("stays")).where("not stays").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
