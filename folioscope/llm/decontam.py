"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned against every token window of every text.

DataFrame functions only. Windows are looked up by hash where they stand, inside the row of their document; a hit is verified word by
word before it counts. Only documents with hits go on, as a small table without texts, and their distinct lists of hits, not the hits
of each document, are joined with the items, so a passage that stands in a third of all documents is resolved once.

Null text or no words: nothing is hit. Items of fewer words than a window: one window; items without words: none. Null item_id: its windows
hit, but it has no id to list. Repeated rows and ids: each row has its own result. Empty tables: no rows, or no hits. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lineage import settle, size_of

WINDOW = 10
#: Windows in the set that goes to the tasks with their plan, at most; a larger benchmark is joined by hash instead.
BROADCAST_GRAMS = 50_000
#: Hashes that are broadcast for that join, at most (8 bytes each, some 64 MB as a hash table); beyond, the hashes of all windows are shuffled.
BROADCAST_HASHES = 2_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OUTSIDE = "".join(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


def words(text: Column) -> Column:
    """Lower-cased words: runs of digits, ASCII letters and anything beyond ASCII."""
    text = F.coalesce(text, F.lit(""))
    # only A-Z are folded; where all is ASCII, lower() does just that and is much faster
    folded = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    trimmed = F.trim(folded, F.lit(_OUTSIDE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"))


def _starts(tokens: Column, size: int, test: Callable[[Column], Column]) -> Column:
    """Places where a window of `size` words passes the test."""
    return F.when(F.size(tokens) >= size, F.filter(F.sequence(F.lit(0), F.size(tokens) - size), test)).otherwise(F.array().cast("array<int>"))


def _hash(tokens: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*(F.get(tokens, at + k) for k in range(size)))


def _text(tokens: Column, at: Column, size: int) -> Column:
    return F.array_join(F.slice(tokens, at + 1, F.lit(size)), " ")


def _any_of(value: Column, grams: DataFrame, column: str) -> Column:
    """Whether the value is in a column of a bounded table. The set stays in the JVM on its way from the table into the plan."""
    held = grams.agg(F.collect_set(column))._jdf.first().getList(0)
    return type(value)(value._jc.isInCollection(held))


def _test(tokens: Column, size: int, grams: DataFrame) -> Callable[[Column], Column]:
    """Whether one of the grams of `size` words stands at a place: by its first two words, then by hash, then word by word."""

    def test(at: Column) -> Column:
        quick = _any_of(F.xxhash64(F.get(tokens, at), F.get(tokens, at + 1)), grams, "first") if size > 1 else F.lit(True)
        return quick & _any_of(_hash(tokens, at, size), grams, "hash") & _any_of(_text(tokens, at, size), grams, "gram")

    return test


def _span(size: int) -> Callable[[Column], Column]:
    return lambda at: F.struct(at.alias("at"), F.lit(size).alias("size"))


def _cut(tokens: Column, size: int) -> Callable[[Column], Column]:
    return lambda at: _text(tokens, at, size)


def _hashed(tokens: Column, size: int) -> Callable[[Column], Column]:
    return lambda at: F.struct(at.alias("at"), _hash(tokens, at, size).alias("hash"))


def item_grams(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """gram, size (words in it), first (hash of its first two words), hash, and ids of its items."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("tokens")).where(F.size("tokens") > 0)
    size = F.least(F.size("tokens"), F.lit(window))
    spread = items.select("item_id", "tokens", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("tokens") - size)).alias("at"))
    cut = spread.select("item_id", "size", F.slice("tokens", F.col("at") + 1, F.col("size")).alias("w"))
    hashes = reduce(lambda other, n: F.when(F.col("size") == n, _hash(F.col("w"), F.lit(0), n)).otherwise(other), range(1, window + 1), F.lit(0).cast("long"))
    first = F.xxhash64(F.get("w", F.lit(0)), F.get("w", F.lit(1)))
    return cut.select(F.array_join("w", " ").alias("gram"), "size", first.alias("first"), hashes.alias("hash"), "item_id").groupBy("gram", "size", "first", "hash").agg(F.collect_set("item_id").alias("items"))


def _covered(hits: Column) -> Column:
    """Words inside any of the hits, given as structs of (at, size)."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def add(acc: Column, hit: Column) -> Column:
        end = hit["at"] + hit["size"]
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + F.greatest(F.lit(0), end - F.greatest(acc["end"], hit["at"]))).alias("n"))

    return F.aggregate(F.array_sort(hits), start, add)["n"]


def _scan(docs: DataFrame, grams: DataFrame, keep: list[str]) -> DataFrame:
    """doc_id, n_words, n_hit and grams (distinct ones that occur) of every row, for a set of grams small enough to broadcast."""
    tokens = F.col("tokens")
    sizes = _sizes(grams)
    found = [_starts(tokens, size, _test(tokens, size, grams.where(F.col("size") == size))).alias(f"at_{size}") for size in sizes]
    rows = docs.select(*keep, "doc_id", words(F.col("text")).alias("tokens")).select(*keep, "doc_id", "tokens", *found)
    spans = F.concat(F.array().cast("array<struct<at:int,size:int>>"), *(F.transform(f"at_{size}", _span(size)) for size in sizes))
    texts = F.concat(F.array().cast("array<string>"), *(F.transform(f"at_{size}", _cut(tokens, size)) for size in sizes))
    return rows.select(*keep, "doc_id", F.size(tokens).cast("long").alias("n_words"), spans.alias("spans"), F.array_sort(F.array_distinct(texts)).alias("grams")).select(*keep, "doc_id", "n_words", _covered(F.col("spans")).cast("long").alias("n_hit"), "grams")


def _sizes(grams: DataFrame) -> list[int]:
    """Numbers of words of the grams: 1 to `window`."""
    return sorted(r["size"] for r in grams.select("size").distinct().collect())


def _join(docs: DataFrame, grams: DataFrame, keep: list[str], most: int = BROADCAST_HASHES) -> DataFrame:
    """As `_scan`, for any number of grams: windows are exploded as places and hashes, without their words, and joined by hash; only what is found goes on,
    and is verified word by word in the row of its document. Rows with the same id and text have the same hits, so these meet under both."""
    id_ = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id")
    rows = docs.select(*keep, "doc_id", "text", id_, F.xxhash64("text").alias("_rid"))
    tokens = F.col("tokens")
    every = [F.transform(_starts(tokens, size, lambda at: F.lit(True)), _hashed(tokens, size)) for size in _sizes(grams)]
    none = F.array().cast("array<struct<at:int,hash:bigint>>")
    windows = docs.select(id_, F.xxhash64("text").alias("_rid"), words(F.col("text")).alias("tokens")).select("_id", "_rid", F.explode(F.concat(none, *every)).alias("w")).select("_id", "_rid", "w.*")
    hashes = grams.select("hash").distinct()
    found = windows.join(F.broadcast(hashes) if hashes.count() <= most else hashes, "hash", "left_semi")
    # written down, so that its size is known before texts would be shuffled to meet it
    hits = settle(found.join(grams.select("hash", "size", "gram"), "hash").groupBy("_id", "_rid").agg(F.collect_set(F.struct("at", "size", "gram")).alias("hits")))
    listed = F.coalesce("hits", F.array().cast("array<struct<at:int,size:int,gram:string>>"))

    def told(w: Column) -> Column:
        real = F.filter(listed, lambda h: F.array_join(F.slice(w, h["at"] + 1, h["size"]), " ") == h["gram"])
        return F.struct(F.size(w).cast("long").alias("n_words"), real.alias("real"))

    # words are bound by a lambda: a projection of their own might be merged into the filter, which would cut the text once for each hit
    once = F.get(F.transform(F.array(words(F.col("text"))), told), F.lit(0))
    verified = rows.join(hits, ["_id", "_rid"], "left").select(*keep, "doc_id", once.alias("t")).select(*keep, "doc_id", F.col("t.n_words").alias("n_words"), F.col("t.real").alias("real"))
    spans = F.transform("real", lambda h: F.struct(h["at"].alias("at"), h["size"].alias("size")))
    return verified.select(*keep, "doc_id", "n_words", _covered(spans).cast("long").alias("n_hit"), F.array_sort(F.array_distinct(F.transform("real", lambda h: h["gram"]))).alias("grams"))


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: list[str] | None = None, most: int = BROADCAST_GRAMS) -> tuple[DataFrame, DataFrame]:
    """Rows of (columns to keep, doc_id, n_words, n_hit, grams), and the grams with the ids of their items."""
    grams = settle(item_grams(benchmark, window), 2 * window * size_of(benchmark))
    find = _join if grams.count() > most else _scan
    return find(docs, grams, keep or []), grams


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = BROADCAST_GRAMS) -> DataFrame:
    """doc_id, n_words, n_hit, items (ids of items that occur, sorted as strings) and contaminated of every row."""
    rows, grams = scan(docs, benchmark, window, most=most)
    key = F.when(F.size("grams") > 0, F.md5(F.array_join("grams", "\n").cast("binary")))
    rows = settle(rows.withColumn("key", key))
    lists = rows.where("key is not null").groupBy("key").agg(F.first("grams").alias("grams")).select("key", F.explode("grams").alias("gram"))
    items = lists.join(grams.select("gram", F.col("items").alias("of")), "gram").groupBy("key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("of")))).alias("items"))
    # rows without a hit have nothing to join: they are spread instead of meeting under one null key
    spread = rows.withColumn("key", F.coalesce("key", F.concat(F.lit("-"), F.xxhash64("doc_id").cast("string"))))
    none = F.array().cast("array<string>")
    return spread.join(items, "key", "left").select("doc_id", "n_words", "n_hit", F.coalesce("items", none).alias("items"), (F.col("n_hit") > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = BROADCAST_GRAMS) -> DataFrame:
    """The rows, with all their columns, that no window of an item occurs in."""
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    found = scan(rows, benchmark, window, ["row"], most)[0]
    # not a plain filter: Catalyst would push it down to the scan and with it tokenise a text again for each of its words
    kept = found.select(F.explode_outer(F.when(F.col("n_hit") == 0, F.array("row"))).alias("row"))
    return kept.where("row IS NOT NULL").select("row.*")
