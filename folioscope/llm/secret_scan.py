"""Secret scans: fixed patterns, and a battery of randomness tests over every token that could be a key.

DataFrame functions only; a text's spans are found inside its own row, so nothing of a text is shuffled.

For each token of 20 or more key characters the encoding is inferred (hex, base32, letters and digits, base64) and tested as a uniform draw
from that alphabet: chi-squared uniformity, runs about the median, serial correlation. A token passes if no test rejects
(Bonferroni over the three). How far it is from ordinary text is its log likelihood ratio; by Markov's inequality exp(-ratio) bounds the
p-value of so extreme a token in ordinary text, whatever its length. Benjamini-Hochberg over those, for each class of
lengths on its own and over all tokens of the corpus, sets the ratio a token must reach. The histogram that BH needs has at most
a few thousand rows whatever the corpus holds.

Null text: empty, no spans. Spans are in code points, end exclusive. Repeated rows and null ids: each row has its own result.
Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FDR, BATTERY = 0.01, 0.001
#: The kinds in the order of their listing; `random` is what the battery adds.
KINDS = ("assign", "access", "hex", "random")

_KEYWORDS = ("password", "passwd", "secret", "token", "api")
_EITHER_CASE = "(?:" + "|".join("".join(c if not c.isalpha() else f"[{c.upper()}{c}]" for c in w) for w in ("password", "passwd", "secret", "token")) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
ASSIGN = _EITHER_CASE + "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{32,}"  # runs are maximal, so a shorter one is dropped either way
TOKEN = "[A-Za-z0-9+/_-]{20,}"

_HEX, _B32 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_B62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
_B64 = _B62 + "+/"

# How often each letter stands in English prose, in percent, from a to z.
LETTERS = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074)
#: Shares of lower-case letters, capitals, digits and signs in ordinary tokens of key characters.
CLASSES = (0.90, 0.04, 0.04, 0.02)

_SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string>>"
_BLOCK = 128


def _none(ddl: str) -> Column:
    return F.array().cast(ddl)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, also where body uses it for each element of an array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, combine: Callable[[Column, Column], Column] | None = None, start: int = 0) -> Column:
    """Sums (or another associative combination) of all elements before each one of an int array, by blocks and blocks of blocks, so that a long array costs
    little more than a short one."""
    combine = combine or (lambda a, v: a + v)

    def add(acc: Column, v: Column) -> Column:
        return F.struct(F.concat(acc["out"], F.array(acc["sum"])).alias("out"), combine(acc["sum"], v).alias("sum"))

    zero = F.struct(_none("array<int>").alias("out"), F.lit(start).alias("sum"))

    def scanned(v: Column, before: Callable[[Column], Column]) -> Column:
        """The scan of an array by its blocks, given how to scan the blocks' sums."""
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _BLOCK).cast("int")), lambda b: F.aggregate(F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK)), zero, add))
        return _let(cut, lambda blocks: F.flatten(F.zip_with(blocks, _let(F.transform(blocks, lambda b: b["sum"]), before), lambda b, o: F.transform(b["out"], lambda x: combine(o, x)))))

    whole = _let(values, lambda v: F.when(F.size(v) > 0, scanned(v, lambda sums: scanned(sums, lambda more: F.aggregate(more, zero, add)["out"]))))
    return F.coalesce(whole, _none("array<int>"))


def _find(rows: DataFrame, name: str, pattern: str, guard: Column, group: int = 0) -> DataFrame:
    """Adds `name`: structs (start, end, word) of every match of a pattern; word is the group's text. `guard` is a cheap necessary condition."""
    text = F.col("text")
    pieces, whole, words = (f"{name}_{x}" for x in ("pieces", "whole", "words"))
    none = _none("array<string>")
    rows = rows.withColumn(whole, F.when(guard, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    some = F.size(whole) > 0
    rows = rows.withColumns({pieces: F.when(some, F.split(text, pattern, -1)).otherwise(none), words: F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(none) if group else F.col(whole)})
    gaps, sizes = F.transform(F.slice(pieces, 1, F.size(whole)), F.length), F.transform(whole, F.length)
    rows = rows.withColumns({f"{name}_gaps": gaps, f"{name}_sizes": sizes})
    rows = rows.withColumn(f"{name}_before", running(F.zip_with(f"{name}_gaps", f"{name}_sizes", lambda a, b: a + b)))
    starts = F.zip_with(f"{name}_before", f"{name}_gaps", lambda a, b: a + b)
    ends = F.zip_with(starts, f"{name}_sizes", lambda a, b: F.struct(a.alias("start"), (a + b).alias("end")))
    spans = F.zip_with(ends, words, lambda s, w: F.struct(s["start"].alias("start"), s["end"].alias("end"), w.alias("word")))
    return rows.withColumn(name, spans).drop(whole, pieces, words, f"{name}_gaps", f"{name}_sizes", f"{name}_before")


def _kind(name: str, least: int) -> Column:
    no = KINDS.index(name)
    kept = F.filter(name, lambda m: F.length(m["word"]) >= least)
    return F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(no).alias("kind_no"), m["end"].alias("end"), F.lit(name).alias("kind")))


def _base(rows: DataFrame) -> DataFrame:
    text = F.col("text")
    low = F.lower(text)
    guard = low.contains(_KEYWORDS[0])
    for w in _KEYWORDS[1:]:
        guard |= low.contains(w)
    rows = _find(rows, "assign", ASSIGN, guard, 1)
    rows = _find(rows, "access", ACCESS, text.contains("AKIA"))
    rows = _find(rows, "hex", HEX, F.lit(True))
    return rows.withColumn("base", F.array_sort(F.concat(_kind("assign", 8), _kind("access", 16), _kind("hex", 32)))).drop("assign", "access", "hex")


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, to about four decimals."""
    z = F.least(F.greatest(z, F.lit(-9.0)), F.lit(9.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def _in(word: Column, signs: str) -> Column:
    return F.length(F.translate(word, signs, "")) == 0


def judge(word: Column) -> Column:
    """Struct of a token's length class, log likelihood ratio against ordinary text (null if it can't be a key), and whether the battery passes."""
    log_q = [math.log(CLASSES[1] * p / 100) for p in LETTERS] + [math.log(CLASSES[0] * p / 100) for p in LETTERS] + [math.log(CLASSES[2] / 10)] * 10 + [math.log(CLASSES[3] / 2)] * 2
    plain = F.translate(word, "-_", "+/")
    hexes = _in(word, _HEX) | _in(word, _HEX.upper())
    alphabet = F.when(hexes, F.lit(_HEX)).when(_in(word, _B32), F.lit(_B32)).when(_in(plain, _B62), F.lit(_B62)).otherwise(F.lit(_B64))
    text = F.when(hexes, F.lower(word)).otherwise(plain)

    def of(x: Column) -> Column:
        text, alphabet, plain = x["text"], x["alphabet"], x["plain"]
        k, n = F.length(alphabet), F.length(text).cast("double")
        counts = F.transform(F.array_distinct(F.split(text, "")), lambda c: (n - F.length(F.replace(text, c, F.lit("")))).cast("double"))
        chi = k / n * F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c) - n
        uniform = _tail((chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n))
        high = F.when(k == 16, F.translate(text, _HEX, "0" * 8 + "1" * 8)).when(k == 32, F.translate(text, _B32, "0" * 16 + "1" * 16)).otherwise(F.translate(text, _B64, "0" * 31 + "1" * 33))
        ones = (n - F.length(F.replace(high, F.lit("1"), F.lit("")))).cast("double")
        turns = (2 * n - F.length(F.replace(high, F.lit("01"), F.lit("0"))) - F.length(F.replace(high, F.lit("10"), F.lit("1")))) + 1
        expected = 2 * ones * (n - ones) / n + 1
        spread = (expected - 1) * (expected - 2) / (n - 1)
        runs = F.when(spread > 0, 2 * _tail(F.abs(turns - expected) / F.sqrt(spread))).otherwise(F.lit(0.0))
        ranks = F.transform(F.split(text, ""), lambda c: F.instr(alphabet, c) - (k + 1) / 2)
        products = F.zip_with(F.slice(ranks, F.lit(1), F.size(ranks) - 1), F.slice(ranks, F.lit(2), F.size(ranks) - 1), lambda a, b: a * b)
        serial = 2 * _tail(F.abs(F.aggregate(products, F.lit(0.0), lambda a, c: a + c)) / F.sqrt(n - 1) / ((k * k - 1) / 12))
        ratio = F.aggregate(F.split(plain, ""), F.lit(0.0), lambda a, c: a - F.log(k.cast("double")) - F.get(F.array(*map(F.lit, log_q)), F.instr(F.lit(_B64), c) - 1))
        passes = 3 * F.least(uniform, runs, serial) >= BATTERY
        return F.struct(F.floor(F.log2(n)).cast("int").alias("class"), F.when(~_in(text, "0123456789"), ratio).alias("ratio"), passes.alias("passes"))

    return _let(F.struct(text.alias("text"), alphabet.alias("alphabet"), plain.alias("plain")), of)


_STEPS = 8  # histogram steps of the ratio, per unit


def _tokens(rows: DataFrame) -> DataFrame:
    rows = _find(rows, "random", TOKEN, F.lit(True))
    return rows.withColumn("random", F.transform("random", lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), judge(m["word"]).alias("found"))))


def thresholds(docs: DataFrame, fdr: float = FDR) -> dict[int, float]:
    """The ratio that a token of each length class must reach, by Benjamini-Hochberg over all tokens of the corpus."""
    words = docs.select(F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(TOKEN), F.lit(0))).alias("word"))
    found = words.select(judge(F.col("word")).alias("f")).select("f.*")
    step = F.floor(F.least(F.greatest(F.coalesce("ratio", F.lit(-1.0)), F.lit(-1.0)), F.lit(500.0)) * _STEPS)
    counts = found.select("class", step.alias("step"), F.col("passes").cast("int").alias("passes")).groupBy("class", "step").agg(F.count("*").alias("n"), F.sum("passes").alias("ok"))
    up = Window.partitionBy("class").orderBy(F.desc("step"))
    ranked = counts.select("class", "step", F.sum("ok").over(up).alias("reached"), F.sum("n").over(Window.partitionBy("class")).alias("all"))
    low = ranked.where(F.exp(-F.col("step") / _STEPS) <= F.col("reached") / F.col("all") * fdr).groupBy("class").agg(F.min("step").alias("step"))
    return {r["class"]: r["step"] / _STEPS for r in low.collect()}  # a row for each power of two of a token's length


def scan(docs: DataFrame, fdr: float = FDR, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns to keep, base and spans: structs (start, kind_no, end, kind) of every row, sorted; spans holds base and what the battery adds."""
    reach = thresholds(docs, fdr)
    rows = docs.select(*keep, *(() if "text" in keep else ("text",))).withColumn("text", F.coalesce("text", F.lit("")))  # null: empty
    rows = _tokens(_base(rows))

    def fine(m: Column) -> Column:
        test = F.lit(False)
        for size, ratio in sorted(reach.items()):
            test = test | ((m["found"]["class"] == size) & (m["found"]["ratio"] >= ratio))
        return F.coalesce(test & m["found"]["passes"], F.lit(False))

    # base spans and tokens that pass, by their starts: a token is clear if no base span before it ends behind its start, and none behind it starts before its end
    no = KINDS.index("random")
    own = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"), F.lit(True).alias("base")))
    found = F.transform(F.filter("random", fine), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lit(False).alias("base")))
    rows = rows.withColumn("both", F.when(F.size(found) == 0, F.array().cast("array<struct<start:int,end:int,base:boolean>>")).otherwise(F.array_sort(F.concat(own, found))))
    rows = rows.withColumn("reached", running(F.transform("both", lambda x: F.when(x["base"], x["end"]).otherwise(F.lit(0))), F.greatest))
    last = (1 << 31) - 1
    rows = rows.withColumn("next", F.reverse(running(F.reverse(F.transform("both", lambda x: F.when(x["base"], x["start"]).otherwise(last))), F.least, last)))
    clear = F.filter(F.arrays_zip("both", "reached", "next"), lambda x: ~x["both"]["base"] & (x["reached"] <= x["both"]["start"]) & (x["next"] >= x["both"]["end"]))
    added = F.transform(clear, lambda m: F.struct(m["both"]["start"].alias("start"), F.lit(no).alias("kind_no"), m["both"]["end"].alias("end"), F.lit("random").alias("kind")))
    return rows.withColumn("added", added).withColumn("spans", F.array_sort(F.concat("base", "added"))).select(*keep, "base", "spans")


def listing(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch of overlapping spans replaced by a mark. Spans are sorted by start."""

    # four bytes a code point: any part of a long text is cut out without counting from its beginning
    def part(wide: Column, start: Column, end: Column) -> Column:
        return F.decode(F.substring(wide, 4 * start + 1, 4 * (end - start)), "UTF-32")

    def body(x: Column) -> Column:
        ends = F.transform(x["spans"], lambda s: s["end"])
        pieces = F.transform(F.arrays_zip(x["spans"].alias("span"), running(ends, F.greatest).alias("reached")), lambda z: F.when(z["span"]["start"] >= z["reached"], F.array(part(x["wide"], z["reached"], z["span"]["start"]), F.lit(mark))).otherwise(_none("array<string>")))
        return F.concat(F.array_join(F.flatten(pieces), ""), part(x["wide"], F.array_max(ends), F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(_let(F.struct(F.encode(text, "UTF-32").alias("wide"), spans.alias("spans")), body))


def without_secrets(docs: DataFrame, fdr: float = FDR, mark: str = "[SECRET]") -> DataFrame:
    """All rows with all their columns; secrets in `text` are replaced by a mark, and n_chars, if there, follows. A null text stays null."""
    found = scan(docs.select(F.struct("*").alias("row"), "text"), fdr, ("row", "text"))
    clean = F.when(F.col("row.text").isNull(), F.lit(None)).otherwise(redact(F.col("text"), F.col("spans"), mark))
    out = found.select("row", clean.alias("clean"))
    changed = {"text": F.col("clean"), "n_chars": F.length("clean").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return out.select(*(changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
