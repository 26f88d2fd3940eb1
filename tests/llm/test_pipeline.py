import random

import corpus_pipeline
from folioscope.llm import bpe, toxicity
from folioscope.llm.queries import tokenizer_path
from test_decontam import brute as leaks
from test_near_sets import shingles, similar
from test_secret_scan import brute as secrets
from test_simhash import groups


def test_stages_against_brute_force(spark, tmp_path):
    r = random.Random(11)
    vocab = [f"w{i}" for i in range(200)]
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    item = say(14)
    texts, toxic = [], {}
    for i in range(300):
        texts.append(say(r.randint(30, 90)) + (" loser idiot moron" if i % 5 == 0 else ""))
        toxic[i] = int(i % 5 == 0)
    near = [len(texts)]  # a text and changed copies of it, each further from it than the one before
    words = say(90).split()
    texts.append(" ".join(words))
    for k in range(8):
        words = list(words)
        words[10 * k + 4] = f"new{k}"
        near.append(len(texts))
        texts.append(" ".join(words))
    texts += [texts[1]] * 3 + [texts[2].replace(" ", "  "), say(9) + " " + item + " " + say(9), say(20) + " token=abcdef123456 " + say(20), None, ""]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long, grams string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in toxic.items()], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    at, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, str(tmp_path))
        at.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {x.doc_id: x for x in at.collect()}
        if name != "bpe":
            assert at.columns == docs.columns
    left = {i: texts[i] for i in seen["toxicity"]}
    assert sum(toxic.get(i, 0) for i in left) <= 2 and len(left) >= len(texts) - 62
    sets = {i: shingles(t) for i, t in left.items()}
    root = groups(sorted(sets), [(a, b) for a in sets for b in sets if a < b and similar(sets[a], sets[b])])
    assert set(seen["simhash_near_dedup"]) == set(root.values())
    # texts between copies and a similarity of 0.8, linked to the next and not to the first
    shares = [len(sets[near[0]] & sets[k]) / len(sets[near[0]] | sets[k]) for k in near[1:]]
    assert 0.8 <= shares[0] < 0.97 and all(x < 0.8 for x in shares[1:]) and {root[k] for k in near} == {root[near[0]]}
    left = sorted(seen["simhash_near_dedup"])
    dirty = {i for i, x in zip(left, leaks([texts[i] for i in left], [(1, item)], 10), strict=True) if x[3]}
    assert dirty and set(seen["benchmark_decontamination"]) == set(left) - dirty
    for i, row in seen["secret_scan"].items():
        want, shift = texts[i], 0
        for a, _, b, _ in secrets(texts[i]):
            want = want[: a + shift] + "[SECRET]" + want[b + shift :]
            shift += 8 - (b - a)
        assert row.text == want and row.n_chars == (None if want is None else len(want))
    assert any("[SECRET]" in (x.text or "") for x in seen["secret_scan"].values())
    engine = bpe.Engine.at(tokenizer_path())
    for i, row in seen["bpe"].items():
        text = seen["secret_scan"][i].text or ""
        assert row.text == text and row.n_tokens == len(engine.plain(text))
    assert {x.doc_id for x in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(seen["bpe"])


def test_toxicity_model(spark):
    r = random.Random(1)
    vocab = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(r.choice(vocab) for _ in range(40)) + (" vile" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(600)] + [(600, None, 0), (601, "", 0)]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, _ in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(toxicity.training_rows(docs, labels))
    got = {x.doc_id: x for x in toxicity.classify(docs, model).collect()}
    import zlib

    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows)
    held = [i for i, _, _ in rows if got[i].held_out]
    assert sum(got[i].predicted == rows[i][2] for i in held) >= 0.97 * len(held)
    assert len(model.index) < 1000 and 0 <= got[600].score == got[601].score < 0.5
    assert max(x.score for x in toxicity.classify(docs, toxicity.train(toxicity.training_rows(docs, labels.limit(0)))).collect()) < 1e-10
    assert toxicity.classify(docs.limit(0), model).count() == 0
