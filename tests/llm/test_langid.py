import itertools
import random

import numpy as np
import pyarrow as pa
from folioscope.llm import langid


def slow(scores, switch):
    k = scores.shape[1]
    best = max(itertools.product(range(k), repeat=len(scores)), key=lambda p: sum(scores[i, x] for i, x in enumerate(p)) - switch * sum(a != b for a, b in zip(p, p[1:], strict=False)))
    return sum(scores[i, x] for i, x in enumerate(best)) - switch * sum(a != b for a, b in zip(best, best[1:], strict=False))


def test_viterbi_is_exact(monkeypatch):
    monkeypatch.setattr(langid, "BLOCK", 3)
    r = np.random.default_rng(1)
    counts = np.array([0, 1, 7, 0, 8, 3, 6])
    scores = r.integers(-8, 1, size=(counts.sum(), 3)).astype(np.float32)
    path = langid.viterbi(scores, counts, 3.0)
    at = 0
    for n in counts:
        s, p = scores[at : at + n], path[at : at + n]
        got = sum(s[i, x] for i, x in enumerate(p)) - 3.0 * (p[1:] != p[:-1]).sum()
        assert got == (slow(s, 3.0) if n else 0)
        at += n


def test_viterbi_with_many_languages(monkeypatch):
    monkeypatch.setattr(langid, "BLOCK", 4)
    monkeypatch.setattr(langid, "MATRIX_CELLS", 200 * 200 * 3)
    r = np.random.default_rng(2)
    counts = np.array([23, 1, 0, 9, 40])
    scores = r.integers(-8, 1, size=(counts.sum(), 200)).astype(np.float32)
    path = langid.viterbi(scores, counts, 5.0)
    assert path.min() >= 0 and path.max() > 127
    at = 0
    for n in counts:
        s, p = scores[at : at + n], path[at : at + n]
        best = np.zeros(200)
        for x in s:
            best = np.maximum(best, best.max() - 5.0) + x
        assert sum(s[i, x] for i, x in enumerate(p)) - 5.0 * (p[1:] != p[:-1]).sum() == best.max()
        at += n


def test_training_rows_are_bounded(spark):
    rows = [(8, f"t{i}", f"l{i}") for i in range(500)] + [(i, "x", "en") for i in range(100, 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid.training_rows(df, 1).count() == 1 and langid.training_rows(df, 20).count() == 20
    assert [tuple(x) for x in langid.training_rows(df.where("doc_id = 8")).select("lang", "text").collect()] == [("l0", "t0")]


def test_word_scores_narrow_by_script():
    grams, first, _, script, _ = langid.word_grams(pa.array(["ab вода 日本 12"]))
    r = np.random.default_rng(3)
    table = r.normal(size=(langid.BUCKETS, 3)).astype(np.float32)
    may = np.zeros((len(langid.SCRIPT_NAMES), 3), bool)
    may[langid.SCRIPT_NAMES.index("latin")] = [True, True, False]
    may[langid.SCRIPT_NAMES.index("cyrillic")] = [False, False, True]
    got = langid.word_scores(grams, first, script, langid.Model(("a", "b", "c"), table, may))
    edges = [*first, len(grams)]
    for w, allowed in enumerate(([0, 1], [2], [0, 1, 2])):  # no language has the third word's script: all are candidates
        total = [sum(float(table[g, k]) for g in grams[edges[w] : edges[w + 1]]) for k in range(3)]
        top = max(total[k] for k in allowed)
        want = [max(total[k] - top, -langid.CLIP) if k in allowed else -langid.CLIP for k in range(3)]
        assert np.allclose(got[w], want, atol=1e-4)
    assert len(got) == 3


EN, DE, RU = "the of and with house water street".split(), "der und nicht straße größe wasser haus".split(), "это что вода улица дом человек".split()


def test_documents(spark):
    r = random.Random(2)
    say = lambda w, n: " ".join(r.choice(w) for _ in range(n))
    rows = [(i, say(w, r.randint(5, 60)), g) for i, (w, g) in enumerate([(EN, "en"), (DE, "de"), (RU, "ru")] * 60)]
    rows += [(1000, None, "en"), (1001, " 12 -- ", None), (1002, say(EN, 30) + ". " + say(DE, 50), None), (1003, "вода", None), (1004, say(DE, 20_000), None)]
    df = spark.createDataFrame([(*x, 1.0) for x in rows], "doc_id long, text string, lang string, score double").repartition(3)
    model = langid.train(langid.training_rows(df))
    assert model.langs == ("de", "en", "ru")
    got = {x.doc_id: x for x in langid.classify(df, model).collect()}
    assert all(got[i].lang_pred == g for i, _, g in rows[:180])
    assert [got[i].lang_pred for i in (1000, 1001, 1002, 1003, 1004)] == ["und", "und", "de", "ru", "de"]
    assert got[1000].score == 0 and [s.lang for s in got[1002].spans] == ["en", "de"] and got[1004].score > 0.99
    text = rows[182][1]
    assert text[got[1002].spans[0].start : got[1002].spans[0].end] + ". " == text[: text.index(". ") + 2]
    none = langid.train(langid.training_rows(df.where("doc_id >= 1001")))
    assert {x.lang_pred for x in langid.classify(df, none).collect()} == {"und"}
    assert langid.classify(df.limit(0), model).count() == 0
