import random
import re

import numpy as np
import pytest
import xxhash
from folioscope.llm import components, simhash


def plain(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    runs = [words[i : i + shingle] for i in range(len(words) - shingle + 1)] or ([words] if words else [])
    h = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64)) if h else 0


def groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def corpus():
    r = random.Random(1)
    vocab = [f"Wörd{i}" for i in range(300)]
    texts = []
    for _ in range(60):
        words = [r.choice(vocab) for _ in range(r.randint(1, 400))]
        texts.append(" ".join(words))
        for _ in range(r.randint(0, 6)):
            words = list(words)
            words[r.randrange(len(words))] = r.choice(vocab)
            texts.append("  ".join(words))
    return texts + ["", None, " \t", "one", "one two", texts[0], texts[0].lower()]


def test_against_brute_force(spark):
    texts = corpus()
    df = spark.createDataFrame([(1000 - i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, fp string").repartition(3)
    got = {r.doc_id: r for r in simhash.near_duplicates(df).collect()}
    prints = {1000 - i: plain(t) for i, t in enumerate(texts)}
    ids = sorted(prints)
    want = groups(ids, [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 3])
    assert {k: r.fp % 2**64 for k, r in got.items()} == prints
    assert {k: r.component_id for k, r in got.items()} == want
    assert len(set(want.values())) < len(ids) - 40


@pytest.mark.parametrize("dense", [simhash.DENSE, 6])
def test_dense_cells(spark, monkeypatch, dense):
    monkeypatch.setattr(simhash, "DENSE", dense)
    monkeypatch.setattr(simhash, "CENTERS", 3)
    r = random.Random(2)
    fps = {0, 2**64 - 1}
    for _ in range(30):
        center = r.getrandbits(64)
        for _ in range(60):
            fps.add(center ^ sum(1 << r.randrange(64) for _ in range(r.randint(0, 5))) % 2**64)
    fps = sorted(fps)
    df = spark.createDataFrame([(f - 2**64 if f >> 63 else f,) for f in fps], "fp long")
    for blocks in (4, 5, 6):
        links = [(x.a % 2**64, x.b % 2**64) for x in simhash.links(df, blocks=blocks).collect()]
        assert groups(fps, links) == groups(fps, [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 3])
        assert len(set(links)) < 20 * len(fps)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 200)] + [(300, 300), (500, 400), (500, 400)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 200)}, 500: 400}


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "x y z w"), (3, "a b c"), (4, None), (4, None)], "doc_id long, text string")
    assert sorted((str(r.doc_id), str(r.component_id)) for r in simhash.near_duplicates(df).collect()) == [("3", "3"), ("4", "4"), ("4", "4"), ("None", "3"), ("None", "None")]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_one_dense_cell_in_place():
    r = random.Random(6)
    fps = {r.getrandbits(16) for _ in range(3000)} | {(1 << 40) | r.getrandbits(9) << 50 for _ in range(50)}
    fp = np.array(sorted(fps), np.uint64)
    table = np.bitwise_count(fp[:, None] ^ simhash.pivots()[None, :])
    order = np.argsort(table[:, 0], kind="stable")
    a, b = simhash._star_links(np.zeros(len(fp), np.int64), fp[order], 3, table[order])
    near = [(int(x), int(y)) for k, x in enumerate(fp) for y in fp[k + 1 :][np.bitwise_count(fp[k + 1 :] ^ x) <= 3]]
    assert groups(sorted(fps), zip(a.tolist(), b.tolist(), strict=True)) == groups(sorted(fps), near)
    assert len(a) < len(fp)


def test_pivot_grid_loses_no_row_within_the_radius():
    r = random.Random(9)
    fps = [r.getrandbits(64) for _ in range(2000)]
    fps += [f ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3))) for f in fps[:500]] + [0, 2**64 - 1, 1, 2**64 - 2]
    fp = np.array(fps, np.uint64)
    table = np.bitwise_count(fp[:, None] ^ simhash.pivots()[None, :])
    order, starts = simhash.pivot_grid(table)
    assert sorted(order) == list(range(len(fp))) and starts[-1] == len(fp)
    seen = 0
    for k in range(len(fp)):
        left = np.concatenate([order[a:b] for a, b in simhash.grid_slices(starts, int(table[k, 0]), int(table[k, 1]), 3)])
        assert set(np.flatnonzero(np.bitwise_count(fp ^ fp[k]) <= 3)) <= set(left)
        seen += len(left)
    assert seen < 0.3 * len(fp) ** 2  # two pivots spare most of the comparisons
