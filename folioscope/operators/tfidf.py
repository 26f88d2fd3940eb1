"""TF-IDF scoring against weighted centroids of past selections and of what readers turned down.

Scores and centroids come from blocks of documents (`term_blocks`), of which a term moves once for each block. Where terms are rows, vectors never meet in one place: norms and
document counts are aggregations with map-side sums. Rows meet what is known of their term in two ways: terms that stand in very many documents are few, whatever the corpus, and go to all tasks; the rest is shuffled, and no term of it
has more than a `FREQUENT`th of all rows. Scores depend on the batch, because the document counts do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import bigrams as pairs
from ..functions.text import words
from ..sinks.shared import release, settle
from . import term_blocks

#: A term with more than this part of all rows is frequent. There are fewer frequent terms than that, as each has its share of the rows: a proven bound for
#: a broadcast of some 3 MB.
FREQUENT = 50_000
#: Bytes of text that a task cuts and counts at a time; its table of counts takes some 30 times as many.
TEXT_BYTES = 8 << 20
#: Bytes of words in a block of documents, of whose arrays a task holds some copies at a time; and of a row group of what blocks write, but for its last row.
BLOCK_BYTES, GROUP_BYTES = 2 << 20, 4 << 20


def tasks_for(docs: DataFrame, text_col: str, each: int | None = None) -> int:
    """Tasks that the texts' bytes need, and as many as there are cores at least."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // (each or TEXT_BYTES)))


def term_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bigrams: bool = True) -> DataFrame:
    """(id, term, tf).

    Texts are dealt by id before they are cut: that moves a text once, where counting would move a row for each of its terms, and both the
    counts and a document's norm then aggregate in place. How many tasks they are dealt to is said here, as Spark sizes tasks by what it reads, which is
    a small part of what their counts take.
    """
    # the words are a column of their own, as each text would otherwise be cut once for every use of them
    cut = docs.select(id_col, text_col).repartition(tasks_for(docs, text_col), id_col).select(id_col, words(F.col(text_col)).alias("_words"))
    found = F.concat("_words", pairs(F.col("_words"))) if bigrams else F.col("_words")
    return cut.select(id_col, F.explode(found).alias("term")).groupBy(id_col, "term").agg(F.count("*").alias("tf"))


def document_counts(counts: DataFrame) -> DataFrame:
    """(term, df), as each document has a row per term."""
    return counts.groupBy("term").agg(F.count("*").alias("df"))


def idf(df: DataFrame, n_docs: int, *also: str) -> DataFrame:
    return df.select("term", *also, (F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0).alias("idf"))


def weighted(counts: DataFrame, idf_: DataFrame) -> DataFrame:
    """Adds `v`: (1 + ln tf) times idf, 1 where a term has none."""
    return counts.join(idf_, "term", "left").withColumn("v", (1.0 + F.log("tf")) * F.coalesce("idf", F.lit(1.0))).drop("idf")


def norms(vectors: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return vectors.groupBy(id_col).agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))


def centroid(docs: DataFrame, weights: DataFrame, bigrams: bool = True) -> DataFrame:
    """(term, c): the weighted mean of unit vectors, of length 1 again. Documents: (doc_id, text), of which all count; weights: (doc_id, weight).

    Chosen documents stand in blocks that keep their words; of the others only document counts are sent. So no row is made for a term of a document.
    """
    n_docs, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-size // TEXT_BYTES))
    # a document that has its weight in several rows has as many vectors, of one length together
    given = weights.groupBy("doc_id").agg((F.sum("weight") / F.sqrt(F.count("*"))).alias("p"))

    def blocks(rows: DataFrame, *also: str, held: bool) -> DataFrame:
        # rows of one id are one document
        whole = rows.groupBy("doc_id", *also).agg(F.collect_list("text").alias("texts"))
        cut = whole.select(F.col("doc_id").cast("string").alias("doc"), F.col("p") if also else F.lit(0.0).alias("p"), F.transform("texts", lambda t: words(t)).alias("words"))
        return term_blocks.named_blocks(cut, parts, min(TEXT_BYTES, BLOCK_BYTES), bigrams, held)

    held = settle(blocks(docs.join(given, "doc_id"), "p", held=True), group=GROUP_BYTES)
    others = blocks(docs.join(given.select("doc_id"), "doc_id", "left_anti"), held=False)
    counts = term_blocks.totals(held.unionByName(others).withColumn("b", F.lit(None).cast("array<double>")))
    sums = settle(term_blocks.named_sums(held, counts, n_docs).groupBy("term").agg(F.sum("c").alias("c")))
    release(held)
    length = sums.agg(F.sqrt(F.sum(F.col("c") * F.col("c"))).alias("norm"))
    # one row: the length of the sum
    return sums.join(F.broadcast(length)).select("term", F.when(F.col("norm") > 0, F.col("c") / F.col("norm")).otherwise(F.col("c")).alias("c"))


def by_term(rows: DataFrame, terms: DataFrame, frequent: DataFrame, how: str = "inner", key: str = "term") -> DataFrame:
    """Rows of `rows` with those of `terms` by term and whether the term is `frequent`. `frequent` is the part of `terms` that the bound of FREQUENT holds for."""
    few = F.broadcast(frequent)
    near = rows.join(few, key).withColumn("frequent", F.lit(True))
    rest = rows.join(few.select(key), key, "left_anti").join(terms.join(few.select(key), key, "left_anti"), key, how).withColumn("frequent", F.lit(False))
    return near.unionByName(rest)


def scores(papers: DataFrame, positive: DataFrame, negative: DataFrame, bigrams: bool = True, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, score): cosine with the positive centroid less that with the negative one; 0 without positive documents or common terms.

    papers: (doc_id, text); positive and negative: (doc_id, text, weight). All three count as documents. `frequent` has no part any more: no term's rows meet.
    """
    if positive.isEmpty():
        return papers.select("doc_id", F.lit(0.0).alias("score"))
    row = lambda d, side, p, n: d.select(F.lit(side).alias("side"), "doc_id", "text", p.cast("double").alias("p"), n.cast("double").alias("n"))
    none, weight = F.lit(0.0), F.col("weight")
    every = row(papers, "c", none, none).unionByName(row(positive, "p", weight, none)).unionByName(row(negative, "n", none, weight))
    n_docs, size = every.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-size // TEXT_BYTES))
    # rows of one id are one document; nothing is known to belong to a null id
    gathered = every.groupBy("side", "doc_id").agg(F.sort_array(F.collect_list("text")).alias("texts"), F.sum("p").alias("p"), F.sum("n").alias("n"))
    known = F.col("doc_id").isNotNull()
    docs = settle(gathered.withColumn("doc", F.sha2(F.to_json("texts"), 256)))
    # documents of the same text, of whatever side, have the same vector
    given = lambda c: F.sum(F.when(known, F.col(c)).otherwise(0.0)).alias(c)
    alike = docs.groupBy("doc").agg(F.first("texts").alias("texts"), F.count("*").alias("copies"), F.max((F.col("side") == "c") & known).alias("own"), given("p"), given("n"))
    hashed = F.transform("texts", lambda t: F.transform(words(t), lambda w: F.xxhash64(w)))
    held = settle(term_blocks.blocks(alike.select("doc", "copies", "own", "p", "n", hashed.alias("words")), parts, min(TEXT_BYTES, BLOCK_BYTES), bigrams), group=GROUP_BYTES)
    # the texts, and then the counts, take as much disk as all that follows
    named = settle(docs.where("side = 'c'").select("doc_id", "doc"))
    release(docs)
    vectors = settle(term_blocks.weighted(held, term_blocks.totals(held), n_docs, parts), group=GROUP_BYTES)
    release(held)
    sums = settle(term_blocks.totals(vectors.where("part >= 0")), group=GROUP_BYTES)
    squares = sums.where("block IS NULL").select("a", "b").unionByName(vectors.where("part = -1").select("a", "b"))
    # one row: the lengths of both sums
    lengths = squares.agg(*(F.sqrt(F.sum(F.get(s, F.lit(0)))).alias(f"{s}_norm") for s in "ab"))
    part = lambda s: F.when(F.col(f"{s}_norm") > 0, F.col(s) / F.col(f"{s}_norm")).otherwise(0.0)
    scored = term_blocks.dots(vectors, sums).join(F.broadcast(lengths)).select("doc", (part("a") - part("b")).alias("score"))
    placed = named.join(scored, "doc").drop("doc")
    return papers.select("doc_id").join(placed, "doc_id", "left").select("doc_id", F.coalesce("score", F.lit(0.0)).alias("score"))
