"""Every operator and stage on empty tables, null rows, repeated rows and tables with clashing extra columns."""

import corpus_pipeline
import pytest
from folioscope.llm import bpe, decontam, langid, pii, repeats, secret_scan, simhash, toxicity
from folioscope.llm.queries import tokenizer_path

CLASHING = ["row", "fp", "tokens", "n_hit", "grams", "spans", "score", "component_id", "clean", "base", "rid", "found", "ids", "decoded", "kept", "key", "word", "order", "label"]
FIELDS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", None, None, *(["x"] * len(CLASHING))) for i, t in rows], FIELDS)


ROWS = [(1, "one two three"), (1, "one two three"), (None, None), (None, "one two three"), (2, ""), (3, None), (4, "token=abcdefgh12 a@b.co \x00 日本  "), (5, "x" * 300_000), (6, " \n " * 1000)]


def operators(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    bench = spark.createDataFrame([(1, "two three"), (None, None)], "item_id long, text string")
    return {
        "toxicity": lambda d: toxicity.classify(d, toxicity.train(toxicity.training_rows(d, labels))),
        "language": lambda d: langid.classify(d, langid.train(langid.training_rows(d))),
        "decontamination": lambda d: decontam.contaminated(d, bench),
        "simhash": lambda d: simhash.near_duplicates(d),
        "bpe": lambda d: bpe.encode_decode(d, tokenizer_path()),
        "secrets": lambda d: secret_scan.scan(d),
        "repeats": lambda d: repeats.remove_repeats(d),
        "pii": lambda d: pii.extract(d, pii.learn(d)),
    }


@pytest.mark.parametrize("name", ["toxicity", "language", "decontamination", "simhash", "bpe", "secrets", "repeats", "pii"])
def test_operators_keep_every_row(spark, name):
    run = operators(spark)[name]
    got = run(frame(spark, ROWS).repartition(3)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ROWS)
    assert run(frame(spark, [(None, None)])).count() == 1
    assert run(frame(spark, [])).count() == 0


def test_stages(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nowhere to be found")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows, left in ((ROWS, None), ([(None, None)], 1), ([], 0)):
        at = frame(spark, rows)
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = f"{tmp_path}/{len(rows)}-{k}"
            after = stage(spark, at, str(tmp_path))
            if name != "bpe":
                assert after.dtypes == at.dtypes
            after.write.parquet(out)
            at = spark.read.parquet(out)
        if left is not None:
            assert at.count() == left
        else:
            assert sorted(str(r.doc_id) for r in at.collect()) == ["1", "1", "2", "4", "5", "None", "None"]
