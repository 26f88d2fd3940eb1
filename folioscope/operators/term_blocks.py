"""Documents and their terms as blocks of arrays, for scores over very many (document, term) rows.

A block holds the counts of some megabytes of text over a vocabulary of its own. What is known of a term in all blocks (document counts, sums) is an exchange: each
block sends a row for each part of the terms' range, a part adds up and answers each block in the order it asked. So a term moves once for a block, not once for a
document, a term of all documents is as small as any, and a task holds one block or one part. Terms are 64-bit hashes: two of a billion terms share one with a
chance of 3 %, and count as one term then.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A row is either a block's documents (part null) or what it asks a part of the terms for.
BLOCK = (
    "block string, part int, doc array<string>, own array<boolean>, p array<double>, n array<double>, entries array<int>, code array<int>, v array<double>, term array<long>, "
    "a array<double>, b array<double>"
)
ANSWER = "block string, part int, a array<double>, b array<double>"
#: The same with terms that keep their words: a term is a word, or two where `second` isn't -1. `a` answers in the order of `first`.
NAMED = "block string, part int, p array<double>, entries array<int>, code array<int>, v array<double>, word array<string>, first array<int>, second array<int>, term array<long>, a array<double>"
_ARROW = {"block": pa.string(), "part": pa.int32(), "doc": pa.list_(pa.string()), "own": pa.list_(pa.bool_()), "term": pa.list_(pa.int64()), "word": pa.list_(pa.string())} | {k: pa.list_(pa.int32()) for k in ("entries", "code", "first", "second")} | {k: pa.list_(pa.float64()) for k in ("p", "n", "v", "a", "b")}


def _table(names: list[str], rows: list[dict]) -> pa.Table:
    def column(name: str) -> pa.Array:
        kind, values = _ARROW[name], [r.get(name) for r in rows]
        if not pa.types.is_list(kind):
            return pa.array(values, kind)
        sizes = [0 if v is None else len(v) for v in values]
        flat = [pa.array(v, kind.value_type) for v in values if v is not None]
        # an offset that is null makes its list null
        ends = np.cumsum([0, *sizes])
        offsets = pa.array(ends, pa.int32(), mask=np.array([v is None for v in values] + [False]))
        return pa.ListArray.from_arrays(offsets, pa.concat_arrays(flat) if flat else pa.array([], kind.value_type), type=kind)

    return pa.table({n: column(n) for n in names})


_BLOCK_NAMES, _ANSWER_NAMES, _NAMED_NAMES = ([c.split()[0] for c in s.split(", ")] for s in (BLOCK, ANSWER, NAMED))


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    found = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    return np.concatenate(found) if found else np.array([])


def _sizes(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.diff(c.offsets.to_numpy()) for c in column.chunks])


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes in their order."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29)))
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return x ^ (x >> np.uint64(31))


def _asked(block: str | None, terms: np.ndarray, parts: int, a: np.ndarray, b: np.ndarray) -> list[dict]:
    """A row for each part of the range of `terms` (in order), with what the block adds to them. Without a block nobody waits for an answer."""
    part = ((terms >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    cuts = np.flatnonzero(np.diff(part)) + 1
    return [{"block": block, "part": int(part[i]), "term": terms[i:j].view(np.int64), "a": a[i:j], "b": b[i:j]} for i, j in zip([0, *cuts], [*cuts, len(terms)], strict=True) if j > i]


def _block(rows: pa.Table, parts: int, bigrams: bool) -> pa.Table:
    outer, inner = rows["words"].combine_chunks(), None
    inner = outer.flatten()
    words = inner.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    text = np.repeat(np.arange(len(inner)), np.diff(inner.offsets.to_numpy()))
    doc = np.repeat(np.arange(len(outer)), np.diff(outer.offsets.to_numpy()))[text]
    if bigrams and len(words):
        at = np.flatnonzero(text[1:] == text[:-1])
        words, doc = np.concatenate([words, _mixed(words[at], words[at + 1])]), np.concatenate([doc, doc[at]])
    terms, code = np.unique(words, return_inverse=True)
    entry, tf = np.unique(doc * max(1, len(terms)) + code, return_counts=True)
    doc, code = np.divmod(entry, max(1, len(terms)))
    name, copies = rows["doc"][0].as_py(), rows["copies"].to_numpy()
    held = {k: rows[k].to_numpy() for k in ("own", "p", "n")} | {"doc": rows["doc"].combine_chunks()}
    counts = np.bincount(code, copies[doc], len(terms))
    own = {"block": name, **held, "entries": np.bincount(doc, minlength=len(outer)), "code": code, "v": 1.0 + np.log(tf), "term": terms.view(np.int64)}
    return _table(_BLOCK_NAMES, [own, *_asked(name, terms, parts, counts, np.zeros(0))])


def _named_block(rows: pa.Table, parts: int, bigrams: bool, held: bool) -> pa.Table:
    outer = rows["words"].combine_chunks()
    inner = outer.flatten()
    told = inner.flatten().dictionary_encode()
    word, first = told.dictionary, told.indices.to_numpy().astype(np.int64)
    text = np.repeat(np.arange(len(inner)), np.diff(inner.offsets.to_numpy()))
    doc = np.repeat(np.arange(len(outer)), np.diff(outer.offsets.to_numpy()))[text]
    second = np.full(len(first), -1)
    if bigrams and len(first):
        at = np.flatnonzero(text[1:] == text[:-1])
        first, second, doc = np.concatenate([first, first[at]]), np.concatenate([second, first[at + 1]]), np.concatenate([doc, doc[at]])
    made, code = np.unique(first * (len(word) + 1) + second + 1, return_inverse=True)
    first, second = np.divmod(made, len(word) + 1)
    hashes = pd.util.hash_array(word.to_numpy(zero_copy_only=False), categorize=False)
    # an index of -1 takes the last hash, which isn't used then
    terms = np.where(second == 0, hashes[first], _mixed(hashes[first], hashes[second - 1])) if len(made) else np.zeros(0, np.uint64)
    order = np.argsort(terms)
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    terms, first, second, code = terms[order], first[order], second[order] - 1, place[code]
    entry, tf = np.unique(doc * max(1, len(terms)) + code, return_counts=True)
    doc, code = np.divmod(entry, max(1, len(terms)))
    name = rows["doc"][0].as_py() if held else None
    asked = _asked(name, terms, parts, np.bincount(code, minlength=len(terms)).astype(float), np.zeros(0))
    own = {"block": name, "p": rows["p"].to_numpy(), "entries": np.bincount(doc, minlength=len(outer)), "code": code, "v": 1.0 + np.log(tf), "word": word, "first": first, "second": second}
    return _table(_NAMED_NAMES, [own, *asked] if held else asked)


def _cut(docs: DataFrame, size: int, block: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """What `block` makes of so many bytes of rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            step = max(1, batch.num_rows * size // max(1, batch.nbytes))
            for i in range(0, batch.num_rows, step):
                held.append(batch.slice(i, step))
                n += held[-1].nbytes
                if n >= size:
                    yield from block(pa.Table.from_batches(held)).to_batches()
                    held, n = [], 0
        if held:
            yield from block(pa.Table.from_batches(held)).to_batches()

    return docs.mapInArrow(run, schema)


def blocks(docs: DataFrame, parts: int, size: int, bigrams: bool) -> DataFrame:
    """BLOCK rows of documents (doc, copies, own, p, n, words: an array of hashes for each text), with document counts asked for. `size`: bytes of words a block."""
    return _cut(docs, size, lambda rows: _block(rows, parts, bigrams), BLOCK)


def named_blocks(docs: DataFrame, parts: int, size: int, bigrams: bool, held: bool) -> DataFrame:
    """NAMED rows of documents (doc, p, words: an array of words for each text), with document counts asked for; if not `held`, with what they add to these alone."""
    return _cut(docs, size, lambda rows: _named_block(rows, parts, bigrams, held), NAMED)


def _totals(rows: pa.Table) -> pa.Table:
    terms, inverse = np.unique(_flat(rows["term"]), return_inverse=True)
    sums = {k: np.bincount(inverse, _flat(rows[k]), len(terms)) for k in "ab" if len(_flat(rows[k]))}
    ends = np.cumsum(_sizes(rows["term"]))
    out = [{"block": block, "part": part, **{k: s[inverse[i:j]] for k, s in sums.items()}} for block, part, i, j in zip(rows["block"].to_pylist(), rows["part"].to_pylist(), [0, *ends[:-1]], ends, strict=True) if block is not None]
    squares = {k: np.array([np.sum(s * s)]) for k, s in sums.items()}
    return _table(_ANSWER_NAMES, [*out, {"part": rows["part"][0].as_py(), **squares}])


def totals(asked: DataFrame) -> DataFrame:
    """ANSWER rows: for each row in which a block asks a part, the sums over all blocks in the order of its terms; and one without a block with the part's sums of squares."""
    return asked.where("part IS NOT NULL").select("block", "part", "term", "a", "b").groupBy("part").applyInArrow(_totals, ANSWER)


def _answered(answers: pa.Table, *names: str) -> list[np.ndarray]:
    ordered = answers.sort_by("part")
    return [_flat(ordered[k]) for k in names]


def weighted(held: DataFrame, counts: DataFrame, n_docs: int, parts: int) -> DataFrame:
    """BLOCK rows with unit vectors, which ask for the sums of those of weight `p` and `n`. A term of one document alone asks nobody: it is in no other vector,
    and only its square counts, in a row of part -1."""

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        if not block.num_rows:
            return _table(_BLOCK_NAMES, [])
        (known,) = _answered(answers, "a")
        terms, code, entries = _flat(block["term"]).view(np.uint64), _flat(block["code"]), _flat(block["entries"])
        doc = np.repeat(np.arange(len(entries)), entries)
        v = _flat(block["v"]) * (np.log((1.0 + n_docs) / (1.0 + known)) + 1.0)[code]
        length = np.sqrt(np.bincount(doc, v * v, len(entries)))
        v = v / np.where(length > 0, length, 1.0)[doc]
        name = block["block"][0].as_py()
        a, b = (np.bincount(code, v * _flat(block[k])[doc], len(terms)) for k in ("p", "n"))
        shared = known > 1
        alone = {"block": name, "part": -1, "term": np.zeros(0), "a": np.array([np.sum(a[~shared] ** 2)]), "b": np.array([np.sum(b[~shared] ** 2)])}
        # what the dot product needs: candidates' entries of terms that others have
        own = _flat(block["own"]).astype(bool)
        kept = own[doc] & shared[code]
        place = np.cumsum(shared) - 1
        candidates = {"block": name, "doc": block["doc"].combine_chunks().flatten().filter(pa.array(own)), "entries": np.bincount(doc[kept], minlength=len(own))[own], "code": place[code[kept]], "v": v[kept]}
        return _table(_BLOCK_NAMES, [candidates, alone, *_asked(name, terms[shared], parts, a[shared], b[shared])])

    return held.where("part IS NULL").groupBy("block").cogroup(counts.where("block IS NOT NULL").groupBy("block")).applyInArrow(run, BLOCK)


def dots(held: DataFrame, sums: DataFrame) -> DataFrame:
    """(doc, a, b): the dot products of candidates with both sums."""

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        entries, code, v = (_flat(block[k]) if block.num_rows else np.zeros(0, int) for k in ("entries", "code", "v"))
        doc = np.repeat(np.arange(len(entries)), entries)
        found = [np.bincount(doc, v * s[code], len(entries)) for s in _answered(answers, "a", "b")] if len(code) else [np.zeros(len(entries))] * 2
        names = block["doc"].combine_chunks().flatten() if block.num_rows else pa.array([], pa.string())
        return pa.table({"doc": names, "a": found[0], "b": found[1]})

    return held.where("part IS NULL").groupBy("block").cogroup(sums.where("block IS NOT NULL").groupBy("block")).applyInArrow(run, "doc string, a double, b double")


def named_sums(held: DataFrame, counts: DataFrame, n_docs: int) -> DataFrame:
    """(term, c): for each block and term the sum of its documents' unit vectors, each with its weight `p`."""

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        if not block.num_rows:
            return pa.table({"term": pa.array([], pa.string()), "c": pa.array([], pa.float64())})
        (known,) = _answered(answers, "a")
        entries, code, first, second = (_flat(block[k]) for k in ("entries", "code", "first", "second"))
        doc = np.repeat(np.arange(len(entries)), entries)
        v = _flat(block["v"]) * (np.log((1.0 + n_docs) / (1.0 + known)) + 1.0)[code]
        length = np.sqrt(np.bincount(doc, v * v, len(entries)))
        c = np.bincount(code, v / length[doc] * _flat(block["p"])[doc], len(first))
        word = block["word"].combine_chunks().flatten()
        two = second >= 0
        names = word.take(pa.array(first))
        pairs = pc.binary_join_element_wise(names, word.take(pa.array(second, mask=~two)), "_")
        return pa.table({"term": pc.if_else(pa.array(two), pairs, names), "c": pa.array(c, pa.float64())})

    return held.where("part IS NULL").groupBy("block").cogroup(counts.where("block IS NOT NULL").groupBy("block")).applyInArrow(run, "term string, c double")
