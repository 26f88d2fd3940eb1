"""Conversation prefix trie, family first.

Conversations with one base id are a family. Families are dealt by range of that id and stream through their tasks: each conversation is rebuilt
from the first turns of the family's base conversation and its own later turns, and its prefixes are put into a small trie. What a task shuffles
is one row per node of its tries, with counts already combined, never a row per turn and conversation. A node's identity is a chain of digests of
its turns, so texts stay where they are read.

Global nodes are sums of those rows. A node is named by its smallest member and its depth: the nodes that a conversation is the smallest member of
are the lower end of its path, so the trie falls apart into such paths. What hangs below a node is summed along its path by a window, and what
whole paths add to the paths they hang from is sent up from path to path, in as many rounds as paths are nested, not once per ancestor.

Only two things are sequential: the chain of digests of one conversation, and the digest of all ids that end in one node. Both are streams in
bounded memory; the ids arrive as one fragment per task and node. Joins on a parent with very many children are split by Spark.

Null conv_id: the row is part of no conversation. Null role or text: empty. Null turn: before all others. Equal turns: by their digest; repeated
rows all count. A base conversation that isn't there has no turns. A conversation left without turns belongs to the root. Empty table: no nodes.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import release, settle

#: Conversations of a family, and turns that may be taken from its base at most, plus one.
FAMILY = 5
TAKEN = 9
#: Nodes that a task holds before it passes on what it has.
HELD = 50_000
ROOT = bytes(16)

PARTS = "node binary, parent binary, depth long, n long, conv_id long, size long, first_end long, ends string"


def _turn(role: Column, text: Column) -> Column:
    """128 bits of what a turn says."""
    return F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)


def family_nodes(conversations: DataFrame, held: int = HELD) -> DataFrame:
    """Nodes of the families' tries, combined per task: n members seen there, the smallest of them, and the ids that end in the node.

    A node may come from several tasks, and from one more than once; the rows add up. Rows with ends carry no count.
    """
    arrow = pa.schema([("node", pa.binary()), ("parent", pa.binary()), *((c, pa.int64()) for c in ("depth", "n", "conv_id", "size", "first_end")), ("ends", pa.string())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: dict[bytes, list] = {}
        ends: dict[bytes, list[int]] = {}
        ended: list[tuple[int, bytes]] = []
        n_ends = 0
        base = conv = None
        shared: list[tuple[bytes, int]] = []
        at, depth, turn, taken = ROOT, 0, 0, 0

        def count(node: bytes, parent: bytes | None, d: int, size: int) -> None:
            if (x := nodes.get(node)) is None:
                nodes[node] = [parent, d, 1, conv, size]
            else:
                x[2] += 1
                x[3] = min(x[3], conv)

        def push(digest: bytes, size: int) -> None:
            nonlocal at, depth
            parent, depth = at, depth + 1
            at = hashlib.blake2b(parent + digest, digest_size=16).digest()
            count(at, parent, depth, size)

        def begin(c: int) -> None:
            nonlocal conv, at, depth, turn, taken
            conv, at, depth, turn, taken = c, ROOT, 0, 0, zlib.crc32(str(c).encode()) % TAKEN
            count(ROOT, None, 0, 0)
            if c != base:
                for digest, size in shared[:taken]:
                    push(digest, size)

        def close_family() -> None:
            nonlocal n_ends
            for c, node in sorted(ended):
                ends.setdefault(node, []).append(c)
            n_ends += len(ended)
            ended.clear()
            shared.clear()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal n_ends
            rows = [(k, *v, None, None) for k, v in nodes.items()]
            rows += [(k, None, None, None, None, None, v[0], ",".join(map(str, v))) for k, v in ends.items()]
            nodes.clear()
            ends.clear()
            n_ends = 0
            for i in range(0, len(rows), 8192):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i : i + 8192], strict=True), arrow, strict=True)], schema=arrow)

        for batch in source:
            for b, c, digest, size in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if c != conv or b != base:
                    if conv is not None:
                        ended.append((conv, at))
                    if b != base:
                        close_family()
                        base = b
                    begin(c)
                if c == base:
                    if turn < TAKEN - 1:
                        shared.append((digest, size))
                    push(digest, size)
                elif turn >= taken:
                    push(digest, size)
                turn += 1
                if len(nodes) + n_ends >= held:
                    yield from flush()
        if conv is not None:
            ended.append((conv, at))
            close_family()
        yield from flush()

    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), F.col("conv_id").cast("long").alias("conv"), "turn", _turn(role, text).alias("digest"), F.octet_length(text).cast("long").alias("size")
    )
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, "base").sortWithinPartitions("base", F.col("conv") != F.col("base"), "conv", F.col("turn").asc_nulls_first(), "digest")
    return dealt.select("base", "conv", "digest", "size").mapInArrow(run, PARTS)


def _end_digests(parts: DataFrame) -> DataFrame:
    """The digest of all ids that end in a node, from fragments in order."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = sha = None
        done: list[tuple[bytes, str]] = []
        for batch in source:
            for k, ends in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if k != node:
                    if sha:
                        done.append((node, sha.hexdigest()))
                    node, sha = k, hashlib.sha256(ends.encode())
                else:
                    sha.update(f",{ends}".encode())
            if len(done) >= 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["end_node", "ends_sha256"])
                done = []
        if sha:
            done.append((node, sha.hexdigest()))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["end_node", "ends_sha256"])

    found = parts.where(F.col("ends").isNotNull()).select("node", "first_end", "ends")
    return found.repartition("node").sortWithinPartitions("node", "first_end").select("node", "ends").mapInArrow(run, "end_node binary, ends_sha256 string")


def merged_nodes(parts: DataFrame) -> DataFrame:
    """The trie's nodes: conv_id (the smallest member) and depth, which name a node; parent_conv_id, n_convs, n_children, size of the last text, ends_sha256."""
    counts = parts.where(F.col("n").isNotNull()).groupBy("node")
    nodes = settle(counts.agg(F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("size").alias("size")))
    children = nodes.where(F.col("parent").isNotNull()).groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "with_children")
    owners = nodes.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    full = nodes.join(children, F.col("node") == F.col("with_children"), "left").join(_end_digests(parts), F.col("node") == F.col("end_node"), "left")
    # rows of a parent with very many children are split over tasks by the adaptive join
    full = full.join(owners, F.col("parent") == F.col("above"), "left")
    none = hashlib.sha256(b"").hexdigest()
    out = settle(full.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "size", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")))
    release(nodes)
    return out


SUMS = ("n_leaves", "saved_tokens")


def with_subtree_sums(nodes: DataFrame) -> DataFrame:
    """Adds n_leaves and saved_tokens, sums over each node's subtree, to a settled table of merged nodes."""
    own = nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("size"))
    totals = [F.sum(c).alias(c) for c in SUMS]
    # a row for each path: the node it hangs from and what it adds there
    paths = settle(own.groupBy("conv_id").agg(F.min_by("parent_conv_id", "depth").alias("up"), (F.min("depth") - 1).alias("at"), *totals).where(F.col("up").isNotNull()))
    hung = [settle(paths.groupBy(F.col("up").alias("conv_id"), F.col("at").alias("depth")).agg(*totals))]
    where = paths.select("conv_id", "up", "at")
    while not hung[-1].isEmpty():  # a round for each level of paths that hang from paths
        moving = hung[-1].groupBy("conv_id").agg(*totals).join(where, "conv_id")
        hung.append(settle(moving.groupBy(F.col("up").alias("conv_id"), F.col("at").alias("depth")).agg(*totals)))
    added = reduce(DataFrame.unionByName, hung).groupBy(F.col("conv_id").alias("to_conv"), F.col("depth").alias("to_depth")).agg(*(F.sum(c).alias(f"hung_{c}") for c in SUMS))
    full = own.join(added, (F.col("conv_id") == F.col("to_conv")) & (F.col("depth") == F.col("to_depth")), "left")
    below = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    out = full.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *(F.sum(F.col(c) + F.coalesce(f"hung_{c}", F.lit(0))).over(below).alias(c) for c in SUMS), "ends_sha256")
    return out


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    parts = settle(family_nodes(conversations))
    nodes = merged_nodes(parts)
    release(parts)
    return with_subtree_sums(nodes)
