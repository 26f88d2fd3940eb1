"""PII by bootstrapped contextual extraction.

Base patterns (mail addresses, IP addresses, card and phone numbers) give seed entities. What stands next to a seed is a candidate pattern:
one or two words before it, or the word after it, whole and parted from it by white space. Spark counts how often the words of each pattern stand anywhere,
and scores patterns and instances in turns: a pattern by the share of all its occurrences that stand beside something believed to be an entity (less for
thin support; one that never stands as words scores nothing), an instance by the best of its patterns. What is glued to an identifier, such as a bracket or
`mailto:`, and words of over 40 characters are no patterns: both counts are of the same occurrences. Words that stand beside anything, such as articles, so score next to nothing. Patterns above the threshold after the
last turn find identifiers that no base pattern knows; these are added as spans of kind `context`, and base spans stay.

Every pattern that stands beside `SUPPORT` seeds is a candidate, whatever the corpus holds. Tasks get them `GROUP` at a time; more of them mean more
passes over the texts. The pattern-instance graph and the scores stay in Spark.

Null text: empty, no spans. Spans are in code points, end exclusive. Repeated rows and null ids: each row has its own result. Empty table:
no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops as T
from .lineage import release, settle

KINDS = ("email", "ip", "card", "phone", "context")
#: Seeds that a pattern must stand beside to be scored; score it must reach; rounds of scoring.
SUPPORT, SCORE, ROUNDS = 8, 0.6, 3
#: Patterns that go to the tasks at a time, of 81 characters at most.
GROUP = 200_000

# A mail address's first part starts as far left as it can, and a number at its first digit: if that fails, so does every later start. Said
# so, each pattern takes time in proportion to the text.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: An identifier's shape: at least six characters, one of them a digit, a letter or digit at the end.
_TOKEN = re.compile(r"[A-Za-z0-9_#@+./:-]{6,}")
#: Words of a context are whole, of 40 characters at most, and stand on the place's line.
_BEFORE = re.compile(r"(?:(?<!\S)(\S{1,40})[ \t]{1,3})?(?<!\S)(\S{1,40})[ \t]{1,3}$")
_AFTER = re.compile(r"[ \t]{1,3}(\S{1,40})(?!\S)")
#: More than a context can take, so that none begins where a look back was cut off.
_LOOK_BACK = 90
#: What a pattern that stands after its place begins with; no word before a place does, as it would hold white space.
_BEHIND = "> "


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k & 1:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base(text: str) -> list[tuple[int, int, int]]:
    """(start, kind by its place in KINDS, end) of every base match, sorted."""
    out = []
    if "@" in text:
        end, at = 0, text.find("@")
        while at >= 0:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                out.append((start, 0, m.end()))
                end = m.end()
            at = text.find("@", max(at + 1, end))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    out.sort()
    return out


def contexts(text: str, start: int, end: int) -> list[str]:
    """Patterns beside a place, in lower case: the word before it, the two words before it, and the word after it."""
    found = []
    if start and text[start - 1] in " \t":
        least = max(0, start - _LOOK_BACK)
        if m := _BEFORE.search(text[max(least, text.rfind("\n", least, start) + 1) : start]):
            found = [m[2].lower()] if m[1] is None else [m[2].lower(), f"{m[1]} {m[2]}".lower()]
    if (m := _AFTER.match(text, end, end + _LOOK_BACK)) and text[end : m.start(1)].isspace():
        found.append(_BEHIND + m[1].lower())
    return found


def apart(matches: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Places of sorted base matches, of those that overlap the first: a place counts once, whatever kinds it is of."""
    out, reach = [], 0
    for start, _, end in matches:
        if start >= reach:
            out.append((start, end))
            reach = end
    return out


def shaped(text: str) -> Iterator[tuple[int, int]]:
    """Tokens of an identifier's shape."""
    if _DIGIT.search(text):
        for m in _TOKEN.finditer(text):
            word = m[0].rstrip("_#@+./:-")
            first = len(word) - len(word.lstrip("./:-"))
            if len(word) - first >= 6 and _DIGIT.search(word, first):
                yield m.start() + first, m.start() + len(word)


def _clear(text: str, own: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Tokens of an identifier's shape that no base match (sorted) overlaps."""
    at = reach = 0
    for start, end in shaped(text):
        while at < len(own) and own[at][0] < end:
            reach = max(reach, own[at][2])
            at += 1
        if reach <= start:
            yield start, end


def _texts(source: Iterator[pa.RecordBatch]) -> Iterator[list[str]]:
    for batch in source:
        for part in T.steps(batch, "text"):
            yield [t or "" for t in part.column("text").to_pylist()]


def _seeds(docs: DataFrame) -> DataFrame:
    """pattern and n: how often each pattern stands beside a seed."""
    schema = pa.schema([("pattern", pa.string()), ("n", pa.int64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _texts(source):
            counts = Counter(c for text in texts for start, end in apart(base(text)) for c in contexts(text, start, end))
            if counts:
                yield T.batches({"pattern": list(counts), "n": list(counts.values())}, schema)

    return docs.select("text").mapInArrow(run, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))


def _instances(docs: DataFrame, patterns: frozenset[str]) -> DataFrame:
    """pattern, instance (hash), known, n: what each candidate pattern introduces of an identifier's shape; with a null instance, how often the
    pattern stands anywhere."""
    pairs = any(" " in p and not p.startswith(_BEHIND) for p in patterns)
    schema = pa.schema([("pattern", pa.string()), ("instance", pa.int64()), ("known", pa.bool_()), ("n", pa.int64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _texts(source):
            counts: Counter = Counter()
            for text in texts:
                tokens = text.lower().split()
                for c in filter(patterns.__contains__, tokens):
                    counts[c, None, False] += 1
                for c in filter(patterns.__contains__, map(_BEHIND.__add__, tokens)):
                    counts[c, None, False] += 1
                if pairs:
                    for c in filter(patterns.__contains__, map("%s %s".__mod__, zip(tokens, tokens[1:], strict=False))):
                        counts[c, None, False] += 1
                own = base(text)
                places = [(start, end, True) for start, end in apart(own)] + [(start, end, False) for start, end in _clear(text, own)]
                for start, end, known in places:
                    if found := patterns.intersection(contexts(text, start, end)):
                        name = xxhash.xxh64_intdigest(text[start:end]) - (1 << 63)
                        for c in found:
                            counts[c, name, known] += 1
            if counts:
                pattern, instance, known = zip(*counts, strict=True)
                yield T.batches({"pattern": pattern, "instance": instance, "known": known, "n": list(counts.values())}, schema)

    return docs.select("text").mapInArrow(run, "pattern string, instance long, known boolean, n long").groupBy("pattern", "instance").agg(F.max("known").alias("known"), F.sum("n").alias("n"))


@dataclass(frozen=True)
class Patterns:
    """Patterns of high confidence and their scores, as a table (pattern, score) of `size` rows."""

    table: DataFrame
    size: int

    @classmethod
    def of(cls, spark: SparkSession, scores: dict[str, float]) -> Patterns:
        return cls(spark.createDataFrame(list(scores.items()), "pattern string, score double"), len(scores))

    def groups(self) -> Iterator[frozenset[str]]:
        yield from _groups(self.table, self.size)


def _groups(table: DataFrame, size: int) -> Iterator[frozenset[str]]:
    """The patterns of a table, about `GROUP` at a time: a proven bound for what the driver holds and tasks get."""
    n = -(-size // GROUP)
    for k in range(n):
        yield frozenset(r["pattern"] for r in table.where(F.pmod(F.xxhash64("pattern"), F.lit(n)) == k).select("pattern").collect())


def learn(docs: DataFrame, support: int = SUPPORT, score: float = SCORE, rounds: int = ROUNDS) -> Patterns:
    chosen = settle(_seeds(docs).where(F.col("n") >= support).select("pattern"))
    parts = [settle(_instances(docs, group)) for group in _groups(chosen, chosen.count())]
    if not parts:
        return Patterns.of(docs.sparkSession, {})
    seen = reduce(DataFrame.unionByName, parts)
    graph, totals = seen.where("instance IS NOT NULL"), seen.where("instance IS NULL").select("pattern", F.col("n").alias("total"))
    scored = graph.withColumn("belief", F.when(F.col("known"), F.lit(1.0)).otherwise(F.lit(0.0)))
    for k in range(rounds):
        sums = scored.groupBy("pattern").agg(F.sum(F.col("belief") * F.col("n")).alias("sum"), F.count("*").alias("support"))
        thin = F.least(F.lit(1.0), F.log2(1 + F.col("support")) / F.log2(F.lit(1.0 + support)))
        found = settle(sums.join(totals, "pattern").select("pattern", (F.least(F.lit(1.0), F.col("sum") / F.col("total")) * thin).alias("score")))
        if k + 1 < rounds:
            # an instance is as believable as the best pattern that introduces it
            best = graph.join(found, "pattern").groupBy("instance").agg(F.max("score").alias("best"))
            doubtful = F.when(F.col("best") >= score, F.col("best")).otherwise(F.lit(0.0))
            scored = settle(graph.join(best, "instance").withColumn("belief", F.when(F.col("known"), F.lit(1.0)).otherwise(doubtful)))
    sure = settle(found.where(F.col("score") >= score))
    release(chosen, found, *parts)
    return Patterns(sure, sure.count())


def extract(docs: DataFrame, patterns: Patterns) -> DataFrame:
    """doc_id and spans (start, end in code points, kind) of every row, sorted by start, then kind as listed."""
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(span))])
    text_schema = pa.schema([schema[0], ("text", pa.string()), schema[1]])

    def first(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in T.steps(batch, "text"):
                found = [[{"start": a, "end": b, "kind": KINDS[k]} for a, k, b in base(t or "")] for t in part.column("text").to_pylist()]
                yield T.batches({"doc_id": part.column("doc_id"), "text": part.column("text"), "spans": found}, text_schema)

    def more(known: frozenset[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def spans(text: str, held: list[dict]) -> list[dict]:
            own = [(x["start"], KINDS.index(x["kind"]), x["end"]) for x in held]
            sure = [x for x in own if x[1] < 4]
            found = {(a, 4, b) for a, b in _clear(text, sure) if known.intersection(contexts(text, a, b))}
            return [{"start": a, "end": b, "kind": KINDS[k]} for a, k, b in sorted(found.union(own))]

        def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in source:
                for part in T.steps(batch, "text"):
                    found = [spans(t or "", held) for t, held in zip(part.column("text").to_pylist(), part.column("spans").to_pylist(), strict=True)]
                    yield T.batches({"doc_id": part.column("doc_id"), "text": part.column("text"), "spans": found}, text_schema)

        return run

    kind = "doc_id long, text string, spans array<struct<start:int,end:int,kind:string>>"
    rows = docs.select("doc_id", "text").mapInArrow(first, kind)
    for group in patterns.groups():
        rows = rows.mapInArrow(more(group), kind)
    return rows.select("doc_id", "spans")
