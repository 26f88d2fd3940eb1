"""Which texts contain which words, as substrings, by an index instead of comparing every text with every word.

A text that contains a word contains all of the word's 6-grams, so it is enough to look for one: the one that the fewest texts contain. Shorter words are
their own only gram. Grams are as long as that because texts share nearly all shorter ones: what meets would grow with the texts times the words. Texts and words
meet by equality of that gram; what meets is verified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sinks.shared import release, settle
from .tfidf import tasks_for

GRAM = 6
#: Bytes of an index that goes to all tasks, with what a row takes beside its word; beyond, texts and words are shuffled by their grams.
INDEX_BYTES, ROW_BYTES = 64 << 20, 128
#: Bytes of text that a task looks words up in; what it finds takes some hundred times as many.
TEXT_BYTES = 4 << 20


def grams(text: Column, n: int) -> Column:
    """The distinct runs of n characters of a text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), 1))


def _every_gram(df: DataFrame, text: str, sizes: list[int], *columns: str) -> DataFrame:
    """Columns and gram, a row for each of the sizes' grams of each text."""
    found = F.concat(*(grams(F.col(text), n) for n in sizes)) if sizes else F.array().cast("array<string>")
    return df.select(*columns, F.explode(found).alias("gram"))


def anchors(texts: DataFrame, words: DataFrame, text: str) -> DataFrame:
    """(gram, word): the gram of each word that the fewest texts contain; a long word with a gram that no text contains is left out. Words: (w, word), w a number.

    Grams are counted on the map side first, so a gram that all texts contain makes a row per task. A word's grams travel with its number, not with the word.
    """
    short, long = words.where(F.length("word") <= GRAM), words.where(F.length("word") > GRAM)
    if long.isEmpty():
        return short.select(F.col("word").alias("gram"), "word")
    own = long.select("w", F.explode(grams(F.col("word"), GRAM)).alias("gram"))
    counts = _every_gram(texts, text, [GRAM]).groupBy("gram").agg(F.count("*").alias("n_texts"))
    ranked = own.join(counts, "gram", "left").groupBy("w").agg(F.min(F.struct(F.coalesce("n_texts", F.lit(0)).alias("n_texts"), "gram")).alias("best"))
    best = ranked.where("best.n_texts > 0").join(long, "w").select(F.col("best.gram").alias("gram"), "word")
    return short.select(F.col("word").alias("gram"), "word").unionByName(best)


def containing(texts: DataFrame, words: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, word) of every text and every word that it contains, each once. `id_col` tells texts apart; words are a column `word`.

    Null and empty words are in no text here; a null text contains none. Case counts. Where the index goes to all tasks, texts are dealt by id first and
    verified where they stand: they move once, and what they meet doesn't move at all.
    """
    some = settle(words.where(F.coalesce("word", F.lit("")) != "").select("word").distinct().withColumn("w", F.monotonically_increasing_id()))
    named = texts.where(F.col(id_col).isNotNull() & F.col(text).isNotNull()).select(id_col, text)
    index = settle(anchors(named, some, text))
    release(some)
    size, sizes = index.agg(F.coalesce(F.sum(F.octet_length("word") + F.octet_length("gram") + ROW_BYTES), F.lit(0)), F.array_sort(F.collect_set(F.length("gram")))).first()  # six sizes at most
    if size <= INDEX_BYTES:
        dealt = named.repartition(tasks_for(named, text, TEXT_BYTES), id_col)
        met = _every_gram(dealt, text, sizes, id_col, text).join(F.broadcast(index), "gram")
    else:
        pairs = _every_gram(named, text, sizes, id_col).join(index, "gram").select(F.col(id_col).alias("_id"), "word")
        met = named.join(pairs, F.col(id_col) == F.col("_id"))
    return met.where(F.contains(F.col(text), F.col("word"))).select(id_col, "word").distinct()
