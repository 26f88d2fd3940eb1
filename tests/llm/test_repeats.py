import random
import re
from collections import Counter

import pytest
from folioscope.llm import repeats


@pytest.fixture
def short_batches(spark):
    """Many steps of few texts each."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def brute(texts, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def corpus(seed):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)] + ["é", "日本"]
    base = [[r.choice(vocab) for _ in range(r.randint(0, 120))] for _ in range(40)]
    texts = [" ".join(b) for b in base]
    hot = " ".join(r.choice(vocab) for _ in range(50))
    for b in base[:25]:
        c = list(b)
        for _ in range(r.randint(0, 3)):
            if c:
                c[r.randrange(len(c))] = "changed"
        at = r.randint(0, len(c))
        texts.append(" ".join(c[:at]) + "\n" + hot + "\t" + " ".join(c[at:]))
    return texts + ["", None, "one", texts[3], texts[3], "a " * 300, "b\x0bc d " * 60]


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr("folioscope.llm.textops.STEP_BYTES", 2000)
    for window, gram in ((35, 8), (12, 4), (5, 5)):
        texts = corpus(window)
        df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, found int").repartition(5)
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in repeats.remove_repeats(df, window, gram).collect()}
        want = dict(enumerate(brute(texts, window)))
        assert got == want
        assert sum(n for _, n, _ in want.values()) > 500


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, "x " * 80), (5, "y " * 34), (5, "y " * 34)], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.n_removed) for r in repeats.remove_repeats(df).collect()) == [(-1, 80), (5, 0), (5, 0)]
    assert repeats.remove_repeats(df.limit(0)).count() == 0


def test_cut_shards(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD", 3)
    test_against_brute_force(spark, monkeypatch)


def test_frequent_anchors_in_two_rounds(spark, monkeypatch, short_batches):
    """With anchors that count as frequent from two places on, and with few keys for each, so that both rounds have work."""
    for often, salts, shard in ((2, 3, 1024), (1, 2, 3), (5, 50, 2)):
        for name, value in (("OFTEN", often), ("SALTS", salts), ("SHARD", shard)):
            monkeypatch.setattr(repeats, name, value)
        test_against_brute_force(spark, monkeypatch)
    test_nulls_and_empty(spark)


def test_a_frequent_anchor_is_dealt_to_many_tasks(spark, monkeypatch, short_batches):
    monkeypatch.setattr(repeats, "SALTS", 16)
    passage = " ".join(f"p{k}" for k in range(60))
    docs = spark.range(4000).selectExpr("id AS rid", f"concat('a', id, ' ', 'b', id, ' {passage} ', 'c', id) AS text").repartition(8)
    hot = repeats._frequent(docs, 35, 8)
    rows = docs.mapInArrow(repeats._anchor_rows(35, 8, hot, 16), repeats.ROW_DDL).where("sent <> 0").toPandas()
    salted = rows[rows["key"] % 2 != 0]
    assert len(hot) and len(salted) > 0.2 * len(rows) and salted["key"].nunique() >= 15 and salted["key"].value_counts().max() < 0.15 * len(rows)
    # and in the second round an anchor has a row for each of its keys
    again = repeats._sorted(spark.createDataFrame(salted, repeats.ROW_DDL)).mapInArrow(repeats._first_round, repeats.ROW_DDL).where("sent <> 0").toPandas()
    assert again["key"].value_counts().max() <= 16
    removed = repeats.remove_repeats(docs.selectExpr("rid AS doc_id", "text")).select("n_removed").distinct().collect()
    assert [r.n_removed for r in removed] == [60]


def test_suffix_automaton():
    r = random.Random(8)
    texts = [[r.choice([b"a", b"b", b"c"]) for _ in range(r.randint(1, 30))] for _ in range(8)]
    automaton = repeats.SuffixAutomaton()
    for k, t in enumerate(texts):
        automaton.add(t, k % 3 + 1)
    automaton.sum_counts()
    joined = Counter(tuple(t[i:j]) for k, t in enumerate(texts) for _ in range(k % 3 + 1) for i in range(len(t)) for j in range(i + 1, len(t) + 1))
    query = [r.choice([b"a", b"b", b"c", b"d"]) for _ in range(60)]
    for n in (1, 3, 60):
        for end, (size, state) in enumerate(automaton.matches(query, n), 1):
            best = max((k for k in range(end + 1) if k == 0 or tuple(query[end - k : end]) in joined), default=0)
            if best >= n:
                assert size >= n and automaton.count[state] == joined[tuple(query[end - n : end])]
            else:
                assert size == best
