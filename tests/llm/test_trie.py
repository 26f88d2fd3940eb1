"""Prefix trie against a plain version, with families that share turns, copies, absent bases, null columns, hot nodes and nested paths."""

import hashlib
import random
import zlib

from folioscope.llm import trie
from folioscope.llm.lineage import settle

FIELDS = "conv_id long, turn long, role string, text string, base string, node string, depth int, size string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", 1, "x", "x") for r in rows], FIELDS)


def expected(rows):
    convs = {}
    digest = lambda r, x: hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()[:16]
    for c, turn, role, text in rows:
        if c is not None:
            r, x = role or "", text or ""
            convs.setdefault(c, []).append((turn is not None, turn or 0, digest(r, x), (r, x)))
    own = {c: [s for *_, s in sorted(v)] for c, v in convs.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        paths[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, children = {}, {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
            if d:
                children.setdefault(p[: d - 1], set()).add(p[:d])
    out = set()
    for node, cs in members.items():
        below = [u for u in members if u[: len(node)] == node]
        saved = sum((len(members[u]) - 1) * len(u[-1][1].encode()) for u in below if u)
        ends = ",".join(map(str, sorted(c for c in cs if len(paths[c]) == len(node))))
        out.add((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(children.get(node, ())), sum(u not in children for u in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def result(df):
    got = df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()
    assert len(got) == len({(r.conv_id, r.depth) for r in got})
    return {tuple(r) for r in got}


def conversations(seed, n, texts):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-20, 3 * n), n):
        rows += [(c, None if r.random() < 0.05 else t, r.choice(["user", "assistant", None]), r.choice(texts)) for t in range(r.randrange(1, 12))]
    r.shuffle(rows)
    return rows


def test_against_plain(spark):
    for seed, texts in ((1, ["a", "bé", None, ""]), (2, ["a"]), (3, [f"t{k}" for k in range(100)])):
        rows = conversations(seed, 60, texts)
        rows += rows[:20]  # repeated rows all count
        assert result(trie.prefix_trie(frame(spark, rows).repartition(5))) == expected(rows)


def test_flushes_add_up(spark):
    rows = conversations(4, 80, ["a", "b"])
    for held in (1, 7, 100):
        parts = settle(trie.family_nodes(frame(spark, rows), held))
        assert result(trie.with_subtree_sums(trie.merged_nodes(parts))) == expected(rows)


def test_copies_and_a_long_conversation(spark):
    """One conversation under many ids, and one with far more turns than others."""
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 400) for t in range(3)] + [(1003, t, "user", f"{t % 7}") for t in range(600)]
    got = result(trie.prefix_trie(frame(spark, rows)))
    assert got == expected(rows)


def test_nested_paths(spark):
    """Conversation k leaves the path of conversation k - 1 at turn k, so paths hang from paths."""
    rows = []
    for k in range(12):
        path = [f"{min(j, k)}.{j}" for j in range(k + 2)]
        rows += [(5 * k, t, "user", x) for t, x in enumerate(path)]
    assert result(trie.prefix_trie(frame(spark, rows))) == expected(rows)


def test_edges(spark):
    assert trie.prefix_trie(frame(spark, [])).count() == 0
    assert trie.prefix_trie(frame(spark, [(None, 1, "user", "a")])).count() == 0
    rows = [(None, 1, "user", "a"), (3, None, None, None), (3, None, None, None), (4, 0, "user", "x" * 200_000), (0, 0, "user", "a"), (7, 1, "b", "\x00"), (8, 1, "b\x00", "")]
    assert result(trie.prefix_trie(frame(spark, rows))) == expected(rows)
    # a conversation left without turns is a member of the root alone
    gone = next(c for c in range(1, 10**6, 5) if zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(gone, 0, "user", "a")]
    assert result(trie.prefix_trie(frame(spark, rows))) == expected(rows) == {(gone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(gone).encode()).hexdigest())}
