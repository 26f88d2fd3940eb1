import math
import random

import numpy as np
import pyarrow as pa
from folioscope.llm import textops as T
from folioscope.llm import toxicity


def plain_features(text):
    """Hashed features of a text, a word at a time."""
    word = lambda w: int(T.word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0])
    mixed = lambda x: int(T.mix(np.array([x % (1 << 64)], np.uint64))[0])
    words, now = [], b""
    for c in (text or "").lower().encode() + b" ":
        if c >= 128 or chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz'":
            now += bytes([c])
        elif now:
            words.append(now)
            now = b""
    out = [word(w) for w in words]
    out += [mixed(word(w[:n]) + n) for w in words for n in (4, 5, 6) if len(w) > n]
    out += [mixed(word(a) * 3 + word(b)) for a, b in zip(words, words[1:], strict=False)]
    out += [mixed(word(a) * 5 + word(b)) for a, b in zip(words, words[2:], strict=False)]
    return {x >> (64 - toxicity.DIM_BITS) for x in out}


def plain_ftrl(rows, f):
    """FTRL-proximal, a coordinate at a time; -1 is the intercept, without penalties."""
    z, n = {}, {}

    def weight(i):
        if i == -1:
            return -z.get(i, 0.0) / ((f.beta + math.sqrt(n.get(i, 0.0))) / f.alpha)
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= f.l1 else -(zi - math.copysign(f.l1, zi)) / ((f.beta + math.sqrt(n.get(i, 0.0))) / f.alpha + f.l2)

    for _ in range(f.epochs):
        for own, y in rows:
            w = {i: weight(i) for i in [*own, -1]}
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - y
            for i in w:
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / f.alpha * w[i]
                n[i] = old + g * g
    return {i: weight(i) for i in z if weight(i)}


def test_against_plain_ftrl(spark):
    r = random.Random(6)
    vocab = [f"word{i}" for i in range(60)] + ["Ärger", "it's", "x"]
    rows = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(1, 15))) + ("! vile thing" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(150)]
    rows += [(150, None, 0), (151, "", 1)]
    for _, text, _ in rows[:20]:
        assert plain_features(text) == set(toxicity.features(pa.array([text]))[1].tolist())
    settings = toxicity.Ftrl(epochs=3)
    df = spark.createDataFrame([(t, y, i) for i, t, y in rows], "text string, label int, order long")
    model = toxicity.train(df, settings)
    want = plain_ftrl([(plain_features(t), y) for _, t, y in rows], settings)
    got = dict(zip(model.index.tolist(), model.weight.tolist(), strict=True))
    assert abs(model.intercept - want.pop(-1)) < 1e-6
    assert set(got) == set(want) and all(abs(got[i] - w) < 1e-6 for i, w in want.items())
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    for x in toxicity.score(docs, model).collect():
        total = model.intercept + sum(want.get(i, 0.0) for i in plain_features(rows[x.doc_id][1]))
        assert abs(x.score - 1 / (1 + math.exp(-total))) < 1e-5


def test_training_rows_are_bounded(spark):
    docs = spark.createDataFrame([(1, f"t{i}") for i in range(500)] + [(i, "x") for i in range(100, 300)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)] * 5 + [(i, 0) for i in range(100, 300)], "doc_id long, toxic int")
    assert toxicity.training_rows(docs, labels, 1).count() == 1 and toxicity.training_rows(docs, labels, 30).count() == 30
    assert [tuple(x) for x in toxicity.training_rows(docs, labels.where("doc_id = 1")).select("text", "label").collect()] == [("t0", 1)]
