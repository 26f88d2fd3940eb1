import random
import re

import pytest
from folioscope.llm import decontam
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items, window):
    grams = {}
    for i, t in items:
        w = tokens(t)
        n = min(window, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[a : a + n]), set()).add(i)
    out = []
    for t in texts:
        w, hit, found = tokens(t), set(), set()
        for n in {len(g) for g in grams}:
            for a in range(len(w) - n + 1):
                if (of := grams.get(tuple(w[a : a + n]))) is not None:
                    hit.update(range(a, a + n))
                    found |= {str(i) for i in of if i is not None}
        out.append((len(w), len(hit), sorted(found), bool(hit)))
    return out


@pytest.mark.parametrize("most", [decontam.BROADCAST_GRAMS, 3])
def test_against_brute_force(spark, most):
    r = random.Random(3)
    vocab = ["the", "a", "ÄRGER", "Word", "x9", "日本", "of", "nd"]
    say = lambda n: "".join(r.choice(vocab) + r.choice([" ", ", ", "\n", "--", "_"]) for _ in range(n))
    items = [(i, say(r.randint(8, 30))) for i in range(12)] + [(50, "Ärger Word"), (51, ""), (52, None), (None, say(12)), (53, "zebra"), (54, items_text := say(15)), (55, items_text)]
    texts = [say(r.randint(0, 60)) for _ in range(40)]
    texts += [say(5) + (t or "") + say(5) for _, t in items] + ["", None, "\x00\x01", "zebra", "Zebra! " * 50, items[0][1] * 3, items[0][1] * 3]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)], "doc_id long, text string, key string, tokens int")
    bench = spark.createDataFrame([(*x, 2) for x in items], "item_id long, text string, doc_id int")
    got = {x.doc_id: (x.n_words, x.n_hit, x["items"], x.contaminated) for x in decontam.contaminated(df, bench, 4, most).collect()}
    assert got == dict(enumerate(brute(texts, items, 4)))
    assert sum(x[3] for x in got.values()) > 20

    # where even the hashes of the items are too many to broadcast
    grams = decontam.item_grams(bench, 4).cache()
    rows = lambda found: sorted((x.doc_id, x.n_words, x.n_hit, x.grams) for x in found.collect())
    assert rows(decontam._join(df, grams, [], 0)) == rows(decontam._scan(df, grams, []))


def test_a_shared_hash_is_no_hit(spark):
    df = spark.createDataFrame([(1, "one two three"), (1, "one two four"), (2, None)], "doc_id long, text string")
    grams = decontam.item_grams(spark.createDataFrame([(7, "one two")], "item_id long, text string"), 2)
    other = grams.withColumn("gram", F.lit("six ten"))  # same hash, other words
    assert [x.n_hit for x in decontam._join(df, grams, []).orderBy("n_hit").collect()] == [0, 2, 2]
    assert [(x.n_hit, x.grams) for x in decontam._join(df, other, []).collect()] == [(0, [])] * 3


@pytest.mark.parametrize("most", [decontam.BROADCAST_GRAMS, 0])
def test_nulls_and_empty(spark, most):
    df = spark.createDataFrame([(None, "zebra"), (None, "zebra"), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "zebra")], "item_id long, text string")
    assert [x.n_hit for x in decontam.contaminated(df, bench, most=most).orderBy("n_hit").collect()] == [0, 1, 1]
    assert [x.n_hit for x in decontam.contaminated(df, bench.limit(0), most=most).collect()] == [0, 0, 0]
    assert decontam.contaminated(df.limit(0), bench, most=most).count() == 0
