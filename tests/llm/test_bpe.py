import hashlib
import random

import numpy as np
import pytest
import tokenizers
from folioscope.llm import bpe
from folioscope.llm.queries import tokenizer_path
from hypothesis import given, settings
from hypothesis import strategies as st

PATH = tokenizer_path()
TRUE = tokenizers.Tokenizer.from_file(PATH)


def ids(text):
    return TRUE.encode(text, add_special_tokens=False).ids


ALPHABET = st.sampled_from(list("abre'lvstd  \n\t\r\x1c\x85\xa0.,!09_é") + ["'re", "'s", "  ", " ", "日", "ß", "<|endoftext|>", "<|end", "oftext|>", "😀", "́"])


@settings(max_examples=400, deadline=None)
@given(st.lists(ALPHABET, max_size=40).map("".join), st.integers(0, 10**6))
def test_chunks_cut_anywhere_agree_with_whole_texts(text, seed):
    def cuts(piece):
        r = random.Random(seed)
        at = sorted(r.sample(range(len(piece) + 1), min(len(piece), 6)))
        return [piece[a:b] for a, b in zip([0, *at], [*at, len(piece)], strict=True)]

    got, raw = bpe.Engine.at(PATH).encode(text, cuts)
    assert list(got) == ids(text)
    assert raw.decode() == TRUE.decode(ids(text), skip_special_tokens=False) == text


def test_every_plain_character_alike():
    chars = [chr(c) for c in range(0x250)]
    text = "".join(a + b for a in chars for b in " a1.'" + chars[0xA0])
    assert bpe.Engine.at(PATH).plain(text) == ids(text)


def test_chunks_follow_content():
    words = [f"w{i * 7919}" for i in range(3000)]
    body = " ".join(words)
    def cuts(t):
        c = bpe.content_chunks(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0]
        return [t[a:b] for a, b in zip([0, *c], [*c, len(t)], strict=True)]

    one, two = cuts(body), cuts("another start " + body)
    assert len(one) > 5 and len(set(one) & set(two)) >= len(one) - 2


def test_rows(spark):
    texts = ["", None, " ", "a" * 200_000, "x <|endoftext|> y", "Hello there, it's 10 o'clock.\n\n  Fine." * 400, "日本語のテキスト " * 50, "same", "same"]
    df = spark.createDataFrame([(i if i != 7 else None, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = bpe.encode_decode(df, PATH).collect()
    assert len(got) == len(texts)
    want = sorted(hashlib.sha256(np.array(ids(t or ""), "<u4").tobytes()).hexdigest() for t in texts)
    assert sorted(hashlib.sha256(bytes(r.ids)).hexdigest() for r in got) == want
    assert sorted(r.decoded for r in got) == sorted(t or "" for t in texts)
    assert bpe.encode_decode(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("text", ["it're", "a  b", "x'", "\x1c!"])
def test_small(text):
    for k in range(len(text) + 1):
        assert bpe.Engine.at(PATH).encode(text, lambda t, k=k: [t[:k], t[k:]])[0].tolist() == ids(text)


def test_long_runs_are_joined_exactly_and_in_proportion(monkeypatch):
    import time

    r = random.Random(2)
    monkeypatch.setattr(bpe, "LONGEST_WORD", 50)
    for alphabet in ("abc", "a1.é日'", "ab cde", "a b"):
        for n in (49, 150, 1000, 4000):
            text = "".join(r.choice(alphabet) for _ in range(n))
            assert list(bpe.Engine.at(PATH).encode(text, bpe._again)[0]) == ids(text)
    monkeypatch.undo()
    took = []
    for n in (400_000, 1_600_000):
        text = "".join(r.choice("abcdefghij") for _ in range(n))
        began = time.process_time()
        got = bpe.Engine.at(PATH).encode(text, bpe._again)[0]
        took.append(time.process_time() - began)
        assert list(got) == ids(text)
    assert took[1] < 10 * took[0]
