import math
import random
import re
import time

from folioscope.llm import pii

MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda s: [int(c) for c in s if c in "0123456789"]
    text = text or ""
    out = [(m.start(), 0, m.end(), "email") for m in MAIL.finditer(text)]
    out += [(m.start(), 1, m.end(), "ip") for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = digits(m[0])
        if 14 <= len(d) <= 19 and sum(sum(divmod(2 * x, 10)) if k % 2 else x for k, x in enumerate(reversed(d))) % 10 == 0:
            out.append((m.start(), 2, m.end(), "card"))
    out += [(m.start(), 3, m.end(), "phone") for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return [(a, b, k) for a, _, b, k in sorted(out)]


def corpus():
    r = random.Random(4)
    pieces = ["é ", "a@b.c", "x.y+z@mail-1.example.co", "@", "@@a.b", "a@b", ".", "..", " ", "1.2.3.4", "300.1.1.1", "1.2.3.4.5", "007.01.1.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "4", "+1 (555) 123-4567", "+49 30 1", "+1.2.3", "\n", "日", "-", " 5", "٣"]
    return ["".join(r.choice(pieces) for _ in range(r.randint(0, 14))) for _ in range(400)] + ["", None, "1 " * 3000, "9" * 5000 + ".1.1.1"]


def test_against_brute_force(spark):
    texts = corpus()
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, spans string").repartition(4)
    for patterns in (pii.Patterns.of(spark, {}), pii.Patterns.of(spark, {"é": 1.0, "@": 1.0})):
        for row in pii.extract(df, patterns).collect():
            spans = [(s.start, s.end, s.kind) for s in row.spans]
            assert [s for s in spans if s[2] != "context"] == brute(texts[row.doc_id]), repr(texts[row.doc_id])


def test_bootstraps_unseen_identifiers(spark):
    r = random.Random(9)
    words = [f"w{c}" for c in "abcdefghij"]
    say = lambda: " ".join(r.choice(words) for _ in range(8))
    texts = [f"{say()} reach me: u{i}@mail.example {say()}" for i in range(60)]
    texts += [f"{say()} reach me: user-{i}-x77 {say()}" for i in range(5)]
    texts += [f"{say()} build r2d2-{i}xx9 {say()}" for i in range(40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    patterns = pii.learn(df)
    known = {x.pattern for x in patterns.table.collect()}
    assert {"me:", "reach me:"} <= known and "build" not in known
    found = {row.doc_id: [texts[row.doc_id][s.start : s.end] for s in row.spans if s.kind == "context"] for row in pii.extract(df, patterns).collect()}
    assert [found[60 + i] for i in range(5)] == [[f"user-{i}-x77"] for i in range(5)]
    assert not any(found[i] for i in range(65, 105))


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, "a@b.c"), (None, None)], "doc_id long, text string")
    assert sorted(len(x.spans) for x in pii.extract(df, pii.learn(df)).collect()) == [0, 1]
    assert pii.extract(df.limit(0), pii.learn(df.limit(0))).count() == 0


def plain_contexts(text, a, b):
    """Whole words of at most 40 characters beside a place, on its line and 1 to 3 blanks or tabs away."""
    out = []
    blank = lambda s: 1 <= len(s) <= 3 and not s.strip(" \t")
    line = text[:a].split("\n")[-1]
    words = list(re.finditer(r"\S+", line))
    if words and blank(line[words[-1].end() :]) and len(words[-1][0]) <= 40:
        out.append(words[-1][0].lower())
        if len(words) > 1 and blank(line[words[-2].end() : words[-1].start()]) and len(words[-2][0]) <= 40:
            out.append(f"{words[-2][0]} {words[-1][0]}".lower())
    if (m := re.search(r"\S+", text[b:])) and blank(text[b : b + m.start()]) and len(m[0]) <= 40:
        out.append("> " + m[0].lower())
    return out


def plain_learn(texts, support, score, rounds):
    """The scoring of patterns, over lists."""
    places = []
    for t in texts:
        reach = 0
        for a, b, _ in brute(t):
            if a >= reach:
                places.append((t, a, b, True))
                reach = b
    for t in texts:
        own = [(a, b) for a, b, _ in brute(t)]
        places += [(t, a, b, False) for a, b in pii.shaped(t) if not any(x < b and a < y for x, y in own)]
    seeds = {}
    for t, a, b, sure in places:
        for c in plain_contexts(t, a, b) if sure else ():
            seeds[c] = seeds.get(c, 0) + 1
    chosen = {c for c, n in seeds.items() if n >= support}
    graph, totals = {}, dict.fromkeys(chosen, 0)
    for t, a, b, sure in places:
        for c in chosen.intersection(plain_contexts(t, a, b)):
            n, known = graph.get((c, t[a:b]), (0, False))
            graph[c, t[a:b]] = n + 1, known or sure
    for t in texts:
        words = t.lower().split()
        for c in words + ["> " + w for w in words] + [f"{x} {y}" for x, y in zip(words, words[1:], strict=False)]:
            if c in chosen:
                totals[c] += 1
    best = {}
    for _ in range(rounds):
        scores = {}
        for c in chosen:
            own = [(n, 1.0 if known else best.get(i, 0.0)) for (p, i), (n, known) in graph.items() if p == c]
            scores[c] = min(1, sum(n * x for n, x in own) / totals[c]) * min(1, math.log2(1 + len(own)) / math.log2(1 + support))
        best = {}
        for c, i in graph:
            if scores[c] >= score:
                best[i] = max(best.get(i, 0), scores[c])
    return {c: round(s, 9) for c, s in scores.items() if s >= score}


def test_patterns_and_context_spans_against_brute_force(spark, monkeypatch):
    r = random.Random(5)
    words = ["mail", "to:", "Call", "now", "of", "the"]
    thing = lambda i: r.choice([f"u{i}@m.example", f"10.0.{i % 256}.7", f"id-{i}-9xyz", "plain", f"+49 170 {1000000 + i}"])
    texts = [" ".join(f"{r.choice(words)} {r.choice(words)} {thing(i * 7 + k)} {r.choice(['ok', 'the', '(sent)'])}" for k in range(3)) for i in range(120)]
    texts += [f"reach me: u{i}@mail.example (private) so" for i in range(20)] + ["reach me: user-77-x (private)", "about user-78-xy (private)", "me: user-79-xy"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = plain_learn(texts, 8, 0.6, 3)
    assert {"me:", "> (private)"} <= set(want)
    for group in (pii.GROUP, 3):
        monkeypatch.setattr(pii, "GROUP", group)
        patterns = pii.learn(df)
        assert {x.pattern: round(x.score, 9) for x in patterns.table.collect()} == want
        for row in pii.extract(df, patterns).collect():
            t = texts[row.doc_id]
            own = [(a, b) for a, b, _ in brute(t)]
            more = [(a, b) for a, b in pii.shaped(t) if not any(x < b and a < y for x, y in own) and set(want) & set(plain_contexts(t, a, b))]
            assert [(s.start, s.end) for s in row.spans if s.kind == "context"] == more
    assert plain_contexts("about user-78-xy (private)", 6, 16) == ["about", "> (private)"]


def test_one_long_line_takes_time_in_proportion():
    line = "reach me: user-77-x9 and 10.0.0.1 or so, " * 50_000
    began = time.process_time()
    sum(len(pii.contexts(line, a, b)) for a, b in pii.shaped(line))
    short = time.process_time() - began
    began = time.process_time()
    line *= 4
    sum(len(pii.contexts(line, a, b)) for a, b in pii.shaped(line))
    assert time.process_time() - began < 10 * short


def test_what_is_glued_or_cut_is_no_pattern(spark):
    """A sign or word that introduces a few seeds and far more of something else, with and without white space between."""
    texts = [f"see (u{i}@site{i}.com) there" for i in range(20)] + [f"isotopes (carbon-14x{i}) and (batch{i}77) so" for i in range(500)]
    texts += [f"{'w' * 50} u{i}@m.example now" for i in range(12)] + [f"{'w' * 50} figure{i}77 then" for i in range(300)]
    texts += [f'to mailto:v{i}@m.example" or ="x{i}@m.example"' for i in range(15)] + [f'in mailto:list-{i}77 ="item{i}88"' for i in range(300)]
    texts += [f"write me: y{i}@m.example" for i in range(15)] + ["write me: hidden-77-z"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    patterns = pii.learn(df)
    known = {x.pattern: round(x.score, 9) for x in patterns.table.collect()}
    assert {"me:", "write me:"} <= set(known) == set(plain_learn(texts, 8, 0.6, 3)) and not any(w.strip("> ") in ("(", ")", '"', 'mailto:', '="') or "www" in w for w in known)
    found = [(row.doc_id, texts[row.doc_id][s.start : s.end]) for row in pii.extract(df, patterns).collect() for s in row.spans if s.kind == "context"]
    assert found == [(len(texts) - 1, "hidden-77-z")]


def test_contexts_as_said_by_splitting():
    r = random.Random(8)
    pieces = ["a@b.co", "x1234567", " ", "  ", "\t", "    ", "\n", "(", "word", "W" * 40, "W" * 41, "é", "\x85", "\x1f", "."]
    for _ in range(4000):
        text = "".join(r.choice(pieces) for _ in range(r.randrange(1, 12)))
        for a, b, _ in brute(text):
            assert pii.contexts(text, a, b) == plain_contexts(text, a, b), repr(text)
