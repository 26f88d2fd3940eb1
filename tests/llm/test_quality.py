"""Quality: features against a plain version, tables against the additive formula, interactions, held-out accuracy and edge cases."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from folioscope.llm import quality

WORDS = "the of river stone quietly under many lamps walked home again before winter came slowly".split()


def prose(r, n):
    words = [r.choice(WORDS) for _ in range(n)]
    return " ".join(w + ("." if k % 9 == 8 else "") + ("\n" if k % 31 == 30 else "") for k, w in enumerate(words))


def junk(r, n):
    kind = r.randrange(4)
    words = [r.choice(WORDS) for _ in range(n)]
    if kind == 0:
        return " ".join(f"{w.upper()}!!" for w in words)
    if kind == 1:
        return " | ".join(words)
    if kind == 2:
        return " ".join(w for w in words[: n // 10 + 1] for _ in range(10))
    return " ".join(w + r.choice(["###", "$$$", "%%%"]) for w in words)


TEXTS = ["", None, " \n ", "one", "One two two, three!\nOne two two, three!", "A | B | C ## dd### EE!! é É 12 3.", "x" * 5000, "ab ab " * 100 + "\n\ncd", "日本 語 語"]


def plain(text):
    """The features that can be told in a line each, of one text."""
    raw = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0d]+", raw)
    letters = lambda w: re.findall(rb"[A-Za-z\x80-\xff]", w)
    digits = lambda w: re.findall(rb"[0-9]", w)
    n = max(1, len(words))
    lines = re.findall(rb"[^\n\r]+", raw)
    blocks = max((len(words) + quality.BLOCK // 2) // quality.BLOCK, bool(words))
    cut = [words[k * quality.BLOCK : (k + 1) * quality.BLOCK if k < blocks - 1 else None] for k in range(blocks)]
    upper = lambda w: len(letters(w)) >= 2 and 2 * len(re.findall(rb"[A-Z]", w)) >= len(letters(w))
    bare = lambda w: not letters(w) and not digits(w)
    return {
        "log_words": np.log2(1 + len(words)),
        "short_words": sum(len(w) <= 3 for w in words) / n,
        "upper": len(re.findall(rb"[A-Z]", raw)) / max(1, len(letters(raw))),
        "digits": len(digits(raw)) / max(1, len(raw)),
        "bare_words": sum(map(bare, words)) / n,
        "upper_words": sum(map(upper, words)) / n,
        "same_as_before": sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        "distinct_words": len(set(words)) / n,
        "distinct_lines": len(set(lines)) / max(1, len(lines)),
        "sentence_ends": sum(w[-1:] in b".?!" for w in words) / n,
        "worst_upper": max((sum(map(upper, b)) / len(b) for b in cut), default=0),
        "worst_bare": max((sum(map(bare, b)) / len(b) for b in cut), default=0),
    }


def test_features():
    r = random.Random(5)
    texts = [*TEXTS, *(prose(r, r.randrange(1, 200)) for _ in range(20)), *(junk(r, r.randrange(1, 200)) for _ in range(20))]
    got = quality.features(pa.array(texts))
    for row, text in zip(got, texts, strict=True):
        for name, value in plain(text).items():
            assert row[quality.FEATURES.index(name)] == pytest.approx(value, abs=1e-5), (name, text)
    assert np.isfinite(got).all()
    alone = np.concatenate([quality.features(pa.array([t], pa.string())) for t in texts])
    assert np.array_equal(alone, got)  # a text's features don't depend on its neighbours


def test_scores_are_sums_of_tables():
    r = np.random.default_rng(1)
    x = r.normal(size=(500, 4)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(int)
    m = quality.fit(x, y)
    assert (0, 1) in [(i, j) for i, j, _ in m.pairs]
    assert ((m.margin(x) > 0) == y).mean() > 0.95  # no single feature tells anything here
    for row, got in zip(x[:20], m.margin(x[:20]), strict=True):
        bins = [int((e < v).sum()) for e, v in zip(m.edges, row, strict=True)]
        want = m.intercept + sum(t[b] for t, b in zip(m.tables, bins, strict=True)) + sum(t[m.coarse[i][bins[i]], m.coarse[j][bins[j]]] for i, j, t in m.pairs)
        assert got == pytest.approx(want)


def frames(spark, n=1500):
    r = random.Random(9)
    kinds = [r.random() < 0.8 for _ in range(n)]
    docs = spark.createDataFrame([(i, prose(r, r.randrange(5, 300)) if good else junk(r, r.randrange(5, 300)), "x") for i, good in enumerate(kinds)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(good)) for i, good in enumerate(kinds)], "doc_id long, quality int")
    return docs, labels, kinds


def test_held_out(spark):
    docs, labels, kinds = frames(spark)
    got = quality.classify(docs.repartition(3), quality.train(quality.training_rows(docs, labels))).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(kinds)))
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(len(kinds)) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.predicted == kinds[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_held_out_labels_change_nothing(spark):
    docs, labels, _ = frames(spark, 300)
    turned = labels.withColumn("quality", quality.F.when(quality.held_out(labels.doc_id, 3, 1), 1 - labels.quality).otherwise(labels.quality).cast("int"))
    a, b = (quality.classify(docs, quality.train(quality.training_rows(docs, x))).collect() for x in (labels, turned))
    assert {(r.doc_id, r.score) for r in a} == {(r.doc_id, r.score) for r in b}


def test_bound_and_edges(spark):
    docs, labels, _ = frames(spark, 200)
    assert quality.training_rows(docs.union(docs), labels.union(labels), limit=50).count() == 50
    odd = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(None, "a"), (None, "a"), (1, "again")], "doc_id long, text string")
    some = spark.createDataFrame([(0, 1), (4, 0), (4, 1), (None, 1), (5, None)], "doc_id long, quality int")
    for lab in (some, some.limit(0)):
        rows = quality.classify(odd, quality.train(quality.training_rows(odd, lab))).collect()
        assert len(rows) == len(TEXTS) + 3 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == 0 for r in rows)
    assert quality.classify(odd.limit(0), quality.train(quality.training_rows(odd.limit(0), some))).count() == 0
