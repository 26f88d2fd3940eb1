import random

import corpus_pipeline
import pytest
from folioscope.llm import near_sets
from test_simhash import groups


def shingles(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    return frozenset(" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def similar(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def corpus():
    r = random.Random(3)
    vocab = [f"Wörd{i}" for i in range(400)]
    say = lambda n: [r.choice(vocab) for _ in range(n)]
    line = say(40)
    texts = []
    for k in range(40):
        words = say(r.randint(5, 300)) + (line if k % 3 == 0 else [])
        for _ in range(r.randint(1, 6)):
            texts.append("  ".join(words))
            words = list(words)
            for _ in range(r.randint(1, max(1, len(words) // 60))):
                words[r.randrange(len(words))] = r.choice(vocab)
    hot = say(120)
    for _ in range(50):  # near copies of one text, and texts that share most of it but are far from each other
        words = list(hot)
        for _ in range(r.randint(1, 5)):
            words[r.randrange(len(words))] = r.choice(vocab)
        texts.append(" ".join(words))
    texts += [" ".join(hot[:60] + say(r.randint(8, 30))) for _ in range(30)]
    return texts + ["", None, " \t", "one", "One", "one two", texts[0], texts[0].upper()]


@pytest.mark.parametrize("dense", [near_sets.DENSE, 3, 10**6])
def test_against_brute_force(spark, monkeypatch, dense):
    monkeypatch.setattr(near_sets, "DENSE", min(dense, 1000))
    texts = corpus()
    sets = {1000 - i: shingles(t) for i, t in enumerate(texts)}
    ids = sorted(sets)
    want = groups(ids, [(a, b) for a in ids for b in ids if a < b and similar(sets[a], sets[b])])
    df = spark.createDataFrame([(1000 - i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, node string").repartition(3)
    assert {x.doc_id: x.component_id for x in near_sets.near_duplicates(df).collect()} == want
    assert len(set(want.values())) < len(ids) - 60
    if dense == near_sets.DENSE:
        assert {x.doc_id: x.component_id for x in near_sets.near_duplicates(df, radius=None).collect()} == want
        assert {x.doc_id for x in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()} == set(want.values())


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "x y z w"), (3, "a b c"), (4, None), (4, None)], "doc_id long, text string")
    assert sorted((str(r.doc_id), str(r.component_id)) for r in near_sets.near_duplicates(df).collect()) == [("3", "3"), ("4", "4"), ("4", "4"), ("None", "3"), ("None", "None")]
    assert near_sets.near_duplicates(df.limit(0)).count() == 0


def test_fingerprints_by_pivots(spark, monkeypatch):
    """Texts within a few bits meet by the table of pivot distances alone; what they share is verified all the same."""
    r = random.Random(5)
    words = [f"w{r.randrange(500)}" for _ in range(900)]
    texts = [" ".join(words), " ".join([*words[:400], "new", *words[401:]]), " ".join(f"w{r.randrange(500)}" for _ in range(900))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    none = spark.createDataFrame([], "a long, b long, size int, place int")
    monkeypatch.setattr(near_sets, "_meetings", lambda nodes: none)
    got = {x.doc_id: x.component_id for x in near_sets.near_duplicates(docs).collect()}
    assert got == {0: 0, 1: 0, 2: 2}
    nodes = spark.createDataFrame([(5, 1), (3, 1), (9, 0b1111), (7, -1)], "node long, fp long")
    assert {(x.a, x.b) for x in near_sets._by_pivots(nodes).collect()} == {(3, 5), (3, 9)}
