"""Language ID: script ranges narrow the candidates of a word, then Viterbi over per-word scores with a switching penalty labels spans
of mixed-language text.

A word's score for a language is the log-likelihood of its character 3-grams, over languages that were seen with the word's script.
Viterbi is exact and works on blocks of words: max-plus transfer matrices of all blocks of a step at once, then a chain
over blocks, so a very long text takes no more steps than a short one.

Null text, or text without a letter: `und`, score 0, no spans. A word of a script that no language was learned with scores
alike for all. Nothing to learn from: `und`. Ties: the language first in order of name. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .toxicity import held_out

#: Rows that the model is fitted on, at most: those with the smallest hash of doc_id.
TRAIN_ROWS = 8_000
BUCKETS = 1 << 16
BLOCK = 64
#: Cells of the transfer matrices that are held at a time.
MATRIX_CELLS = 1 << 22
#: Log-likelihood that a change of language costs, and the most that one word may say against a language.
SWITCH, CLIP = 12.0, 8.0
#: Share of a language's words that a script must have to be one of its scripts.
SCRIPT_SHARE = 0.01

#: First code points of runs of one script, by name.
SCRIPTS = [(0x00, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"), (0x780, "other"), (0x900, "devanagari"), (0x980, "bengali"), (0xA00, "other"), (0xB80, "tamil"), (0xC00, "other"), (0xE00, "thai"), (0xE80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x30000, "other")]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    table: np.ndarray  # float32, BUCKETS x languages
    scripts: np.ndarray  # bool, scripts x languages


def word_grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram bucket of every character of every word (and of the place after it), first gram, start, end and script of each word, words per row."""
    column = pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))
    lengths = pc.utf8_length(column).to_numpy(zero_copy_only=False)
    cps = np.frombuffer("".join(column.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    inside = _letters()[cps]
    w = np.zeros(len(cps) + 2, bool)
    w[1:-1] = inside
    cut = np.zeros(len(cps) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside & (~w[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside & (~w[2:] | cut[1:])) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    # letters of a word and one place after it, all words in a row
    size = ends - starts + 1
    first = np.cumsum(size) - size
    at = np.arange(int(size.sum())) - np.repeat(first - starts, size)
    c = np.append(cps, 0)[np.minimum(at, len(cps))].astype(np.uint64)
    c[first + size - 1] = 0
    one, two = np.zeros_like(c), np.zeros_like(c)
    one[1:], two[2:] = c[:-1], c[:-2]
    one[first] = 0
    two[first] = 0
    two[np.minimum(first + 1, len(two) - 1)] = 0
    grams = (T.mix((two << T.U64(42)) | (one << T.U64(21)) | c) >> T.U64(48)).astype(np.int32)
    script = _script_of()[np.searchsorted(_script_starts(), cps[starts], "right") - 1] if len(starts) else np.zeros(0, np.int64)
    return grams, first, np.stack([starts, ends]) - np.repeat(offsets[:-1], counts), script, counts


@cache
def _script_starts() -> np.ndarray:
    return np.array([c for c, _ in SCRIPTS])


@cache
def _script_of() -> np.ndarray:
    return np.array([SCRIPT_NAMES.index(n) for _, n in SCRIPTS])


def training_rows(docs: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """text, lang, order of at most `limit` documents with a language that are not held out, a row each: of several rows of a doc_id, the least."""
    named = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), 4, 2))
    chosen = named.select("doc_id").distinct().withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id").limit(limit)
    # `limit` rows of two numbers: a proven bound for the broadcast
    found = named.select("doc_id", "text", "lang").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("least"), F.first("order").alias("order")).select("least.text", "least.lang", "order")


def train(rows: DataFrame) -> Model:
    """Fits rows of (text, lang); the caller bounds their number. Counts leave the task as one row per language."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in source:
            for part in T.steps(batch, "text"):
                grams, first, _, script, n = word_grams(part.column("text"))
                edges = np.concatenate([first, [len(grams)]])[np.concatenate([[0], np.cumsum(n)])]
                words = np.concatenate([[0], np.cumsum(n)])
                for r, lang in enumerate(part.column("lang").to_pylist()):
                    counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    counts[lang] += np.bincount(grams[edges[r] : edges[r + 1]], minlength=BUCKETS)
                    scripts.setdefault(lang, np.zeros(len(SCRIPT_NAMES), np.int64))
                    scripts[lang] += np.bincount(script[words[r] : words[r + 1]], minlength=len(SCRIPT_NAMES))
        for lang in counts:
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([counts[lang].tobytes()]), pa.array([scripts[lang].tobytes()])], ["lang", "counts", "scripts"])

    got = sorted(rows.select("text", "lang").repartition(1).mapInArrow(run, "lang string, counts binary, scripts binary").collect())
    if not got:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool))
    counts = np.stack([np.frombuffer(r.counts, np.int64) for r in got], 1)
    scripts = np.stack([np.frombuffer(r.scripts, np.int64) for r in got], 1)
    table = np.log((counts + 0.5) / (counts.sum(0) + 0.5 * BUCKETS)).astype(np.float32)
    return Model(tuple(r.lang for r in got), table, scripts >= np.maximum(1, SCRIPT_SHARE * scripts.sum(0)))


def word_scores(grams: np.ndarray, first: np.ndarray, script: np.ndarray, model: Model) -> np.ndarray:
    """What each word says for each language: 0 for the best one, down to -CLIP; candidates are the languages of its script."""
    if not len(first):
        return np.zeros((0, len(model.langs)), np.float32)
    out = np.add.reduceat(model.table[grams], first, axis=0)
    may = model.scripts[script]
    may |= ~may.any(1, keepdims=True)
    out = np.where(may, out, -np.inf)
    return np.maximum(out - out.max(1, keepdims=True), -CLIP).astype(np.float32)


def viterbi(scores: np.ndarray, counts: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language of each word; rows of words lie one after the other, counts[r] words each."""
    n, k = scores.shape
    path = np.zeros(n, np.int32)
    if not n or k < 2:
        return path
    counts = counts[counts > 0]
    blocks = -(-counts // BLOCK)
    row = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
    base = np.cumsum(blocks) - blocks
    block, place = base[row] + within // BLOCK, within % BLOCK
    m = int(blocks.sum())
    s = np.zeros((BLOCK, m, k), np.float32)
    s[place, block] = scores
    # chain over the blocks of each row, all first blocks, then all second ones; rows with more blocks come first
    order = np.argsort(-blocks, kind="stable")
    live = np.searchsorted(-blocks[order], -np.arange(blocks.max()), "left")
    turn = np.repeat(np.arange(len(live)), live)
    rows = order[np.arange(m) - np.repeat(np.cumsum(live) - live, live)]
    enter = np.zeros((m, k), np.float32)
    now = np.zeros((len(counts), k), np.float32)
    back = np.zeros((m, k), np.int32)
    step = max(1, MATRIX_CELLS // (k * k))
    for lo in range(0, m, step):
        # transfer matrix of each block: from the language before it to the language of its last word
        at = (base[rows] + turn)[lo : lo + step]
        t = np.where(np.eye(k, dtype=bool), np.float32(0), np.float32(-np.inf))[None].repeat(len(at), 0)
        for j in range(BLOCK):
            t = np.maximum(t, t.max(2, keepdims=True) - switch) + s[j][at][:, None, :]
        edges = np.flatnonzero(np.append(True, np.diff(turn[lo : lo + step]) > 0))
        for a, b in zip(edges, [*edges[1:], len(at)], strict=True):
            r = rows[lo + a : lo + b]
            enter[at[a:b]] = now[r]
            ways = now[r][:, :, None] + t[a:b]
            back[at[a:b]] = ways.argmax(1)
            now[r] = ways.max(1)
    last = np.zeros(m, np.int32)
    end = now.argmax(1).astype(np.int32)
    for b in range(int(blocks.max()) - 1, -1, -1):
        r = order[: live[b]]
        at = base[r] + b
        last[at] = end[r]
        end[r] = back[at, end[r]]
    # within each block, from its entry vector
    v, stays, best = enter, np.zeros((BLOCK, m, k), bool), np.zeros((BLOCK, m), np.int32)
    for j in range(BLOCK):
        best[j] = v.argmax(1)
        other = v.max(1, keepdims=True) - switch
        stays[j] = v >= other
        v = np.maximum(v, other) + s[j]
    found, now = np.zeros((BLOCK, m), np.int32), last
    every = np.arange(m)
    for j in range(BLOCK - 1, -1, -1):
        found[j] = now
        now = np.where(stays[j][every, now], now, best[j])
    return found[place, block]


def label(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred (of most letters), score (its share of the letters) and spans (start, end in code points, lang) of every row."""
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span))])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.langs, "und"], object)
        k = len(model.langs)
        for batch in source:
            for part in T.steps(batch, "text"):
                grams, first, places, script, counts = word_grams(part.column("text"))
                if not k:
                    counts = np.zeros(part.num_rows, np.int64)
                    grams, first, places, script = grams[:0], first[:0], places[:, :0], script[:0]
                path = viterbi(word_scores(grams, first, script, model), counts).astype(np.int64)
                row = np.repeat(np.arange(part.num_rows), counts)
                letters = np.bincount(row * max(k, 1) + path, places[1] - places[0], minlength=part.num_rows * max(k, 1)).reshape(part.num_rows, -1)
                total = letters.sum(1)
                pred = np.where(total > 0, letters.argmax(1), k)
                new = np.ones(len(path), bool)
                new[1:] = (row[1:] != row[:-1]) | (path[1:] != path[:-1])
                at = np.flatnonzero(new)
                stop = np.append(at[1:], len(path))[: len(at)] - 1
                spans = pa.StructArray.from_arrays([pa.array(places[0][at], pa.int32()), pa.array(places[1][stop], pa.int32()), pa.array(names[path[at]], pa.string())], fields=list(span))
                edges = pa.array(np.searchsorted(row[at], np.arange(part.num_rows + 1)), pa.int32())
                yield T.batches({"doc_id": part.column("doc_id"), "lang_pred": pa.array(names[pred], pa.string()), "score": letters.max(1) / np.maximum(total, 1), "spans": pa.ListArray.from_arrays(edges, spans)}, schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score and spans of every row."""
    return label(docs, model).select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score", "spans")
