"""Substring dedup by suffix automata of reference shards: removes every word covered by a window of `window` words whose word sequence also
starts elsewhere.

The reference is the corpus itself, which no broadcast can hold, so its shards are content-defined and texts are routed to them:

1. every window is represented by its anchor, the least hash among its `gram`-word runs (leftmost on ties), so equal windows have
   equal anchors. About one word in fifteen is an anchor. Anchors that occur once in the corpus are dropped;
2. a shard is what surrounds one shared anchor: the stretches of words whose windows it represents, from all texts. A suffix automaton of the
   shard's distinct stretches, weighted by their occurrences, is built, and the stretches are streamed through it: where the longest match
   covers a window and its state occurs at least twice, the window is repeated. Here words are compared, not hashes;
3. a shard of more stretches than `SHARD` is cut; what one cut can't decide on its own meets once more under its window's
   64-bit hash, and there equal hashes count as equal windows;
4. repeated windows come back to their document as bit masks, and the maximal spans they cover are removed.

Before any shuffle a task settles what repeats within its own step of texts and sends one representative, so a passage that
stands in a third of all documents costs one row per step, not one per document. Anchors that a sample of the texts shows to be frequent are dealt
to `SALTS` keys each: anchors meet in two rounds, the second with a row for each of those keys, and a frequent anchor's stretches make as many cut
shards. The sample steers the time, never the result. Texts are shuffled once; both joins read that exchange.

Null text: no words. Fewer words than a window: kept whole. Repeated rows: repeated windows like any other. Null doc_id: kept.
Rows that share doc_id and text share their result. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .lineage import settle

WINDOW, GRAM = 35, 8
#: Stretches of one shard, at most; an automaton of so many takes a few tens of MB.
SHARD = 1024
#: Texts of the sample, in how many places of it an anchor is frequent, how many such anchors are told apart at most, and keys for each.
SAMPLE, OFTEN, FREQUENT, SALTS = 10_000, 64, 100_000, 256
_PLACE_BITS = 30  # words that one step may hold; the other bits of an anchor's hash decide which gram is least

ROW = pa.schema([("key", pa.int64()), ("rid", pa.int64()), ("pos", pa.int32()), ("sent", pa.int64()), ("known", pa.int64()), ("words", pa.binary())])
ROW_DDL = "key long, rid long, pos int, sent long, known long, words binary"


class SuffixAutomaton:
    """A suffix automaton of several word sequences, with the number of places where each state's words end."""

    def __init__(self) -> None:
        self.to: list[dict[bytes, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, to: dict[bytes, int], link: int) -> int:
        self.to.append(to)
        self.length.append(length)
        self.link.append(link)
        self.count.append(0)
        return len(self.to) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """A state for the shorter ones of q's sequences, those that continue p's longest."""
        part = self._state(self.length[p] + 1, dict(self.to[q]), self.link[q])
        self.link[q] = part
        while p >= 0 and self.to[p].get(word) == q:
            self.to[p][word] = part
            p = self.link[p]
        return part

    def add(self, words: Sequence[bytes], weight: int = 1) -> None:
        to, link, length, count = self.to, self.link, self.length, self.count
        last = 0
        for word in words:
            known = to[last].get(word)
            if known is not None:
                last = known if length[known] == length[last] + 1 else self._split(last, word, known)
            else:
                new = self._state(length[last] + 1, {}, 0)
                p = last
                while p >= 0 and word not in to[p]:
                    to[p][word] = new
                    p = link[p]
                if p >= 0:
                    q = to[p][word]
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, word, q)
                last = new
            count[last] += weight

    def sum_counts(self) -> None:
        """Once all is added: a suffix ends wherever a longer sequence does."""
        for s in sorted(range(1, len(self.to)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[s]] += self.count[s]
        self.count[0] = 0

    def matches(self, words: Sequence[bytes], window: int) -> Iterator[tuple[int, int]]:
        """Matching statistics: after each word, the length of the longest match that ends there, and its state. Past `window` words
        only the last `window` are followed."""
        to, link, length = self.to, self.link, self.length
        state = size = 0
        for word in words:
            while state and word not in to[state]:
                state = link[state]
                size = length[state]
            if (following := to[state].get(word)) is not None:
                state, size = following, size + 1
            while state and length[link[state]] >= window:
                state = link[state]
            yield min(size, length[state]), state
            size = min(size, length[state])


class Step:
    """Words of a step of texts, and the anchor of each of their windows."""

    def __init__(self, part: pa.RecordBatch, window: int, gram: int) -> None:
        self.raw, self.offsets = T.utf8(part.column("text"))
        starts, ends, self.counts = T.words(self.raw, self.offsets, T.NOT_SPACE)
        self.starts, self.ends = starts, ends
        self.base = np.cumsum(self.counts) - self.counts
        self.hashes = T.word_hashes(self.raw, starts, ends)
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)
        n = len(starts)
        self.grams = T.gram_hashes(self.hashes, gram)
        if n < window:
            self.windows = self.anchors = np.zeros(0, np.int64)
            return
        low = T.U64((1 << _PLACE_BITS) - 1)
        least = (self.grams & ~low) | np.arange(len(self.grams), dtype=np.uint64)
        span, have = window - gram + 1, 1
        while have < span:  # least over `have` grams from each place on, doubled until it covers a window
            more = min(have, span - have)
            least = np.minimum(least[: len(least) - more], least[more:])
            have += more
        self.windows = np.flatnonzero(self.row[: n - window + 1] == self.row[window - 1 :])
        self.anchors = (least[self.windows] & low).astype(np.int64)


def _spread(rid: np.ndarray) -> np.ndarray:
    return T.mix(rid.view(np.uint64)).view(np.int64)


def _keys(anchors: np.ndarray, rid: np.ndarray, hot: np.ndarray, salts: int) -> np.ndarray:
    """Keys of anchors: even ones; of those in `hot`, which is sorted, one of `salts` odd ones by document."""
    even = anchors & ~1
    if not len(hot):
        return even
    frequent = hot[np.minimum(np.searchsorted(hot, even), len(hot) - 1)] == even
    salt = (_spread(rid).view(np.uint64) % T.U64(salts)) + T.U64(1)
    return np.where(frequent, T.mix(even.view(np.uint64) + salt * T.U64(0x9E3779B97F4A7C15)).view(np.int64) | 1, even)


def _frequent(rows: DataFrame, window: int, gram: int) -> np.ndarray:
    """Sorted even keys of the anchors that stand in many places of a sample of the texts."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in T.steps(batch, "text"):
                step = Step(part, window, gram)
                key, n = np.unique(step.grams[np.unique(step.anchors)].view(np.int64) & ~1, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

    share = max(1, rows.count() // SAMPLE)
    some = rows.where(F.pmod(F.xxhash64("rid"), F.lit(share)) == 0).select("text").mapInArrow(run, "key long, n long")
    many = some.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= OFTEN).orderBy(F.desc("n"), "key").limit(FREQUENT)  # 8 bytes each
    return np.sort(np.array([r["key"] for r in many.collect()], np.int64))


def _anchor_rows(window: int, gram: int, hot: np.ndarray, salts: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in T.steps(batch, "text"):
                step = Step(part, window, gram)
                at = np.unique(step.anchors)
                if not len(at):
                    continue
                key, rid = step.grams[at].view(np.int64), part.column("rid").to_numpy()[step.row[at]]
                pos = at - step.base[step.row[at]]
                _, first, which, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                multi = count[which] > 1
                is_first = np.zeros(len(at), bool)
                is_first[first] = True
                send = ~multi | is_first  # one representative of what repeats within the step
                dealt = np.where(send, _keys(key, rid, hot, salts), _spread(rid))
                # a salted row carries what its key was
                words = pa.array([k.tobytes() if s and d & 1 else b"" for k, s, d in zip(key & ~1, send, dealt, strict=True)] if len(hot) else [b""] * len(at), pa.binary())
                yield T.batches({"key": dealt, "rid": rid, "pos": pos, "sent": send.astype(np.int64), "known": multi.astype(np.int64), "words": words}, ROW)

    return run


def _first_round(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Salted anchors sorted by key: of equal keys one goes on under the anchor's own key, and where there are several, all are known to repeat."""
    before: tuple[int, int, int, bool] | None = None  # key, rid and pos of the last row, and whether it was the first of its key
    for batch in source:
        if not batch.num_rows:
            continue
        key, rid, pos, known = (batch.column(c).to_numpy() for c in ("key", "rid", "pos", "known"))
        first = np.append(before is None or before[0] != key[0], key[1:] != key[:-1])
        own = np.frombuffer(b"".join(batch.column("words").to_pylist()), np.int64)
        rest = np.flatnonzero(~first)
        # the first row of a key is known to repeat once there is a second one
        second = np.flatnonzero(~first & np.append(before is not None and before[3], first[:-1]))
        head_rid, head_pos = (np.where(second > 0, x[second - 1], 0 if before is None else b) for x, b in ((rid, before and before[1]), (pos, before and before[2])))
        known_rid, known_pos = np.concatenate([rid[rest], head_rid]), np.concatenate([pos[rest], head_pos])
        n, m = int(first.sum()), len(known_rid)
        columns = {"key": np.concatenate([own[first], _spread(known_rid.astype(np.int64))]), "rid": np.concatenate([rid[first], known_rid]), "pos": np.concatenate([pos[first], known_pos]), "sent": np.append(np.ones(n, np.int64), np.zeros(m, np.int64)), "known": np.concatenate([known[first], np.ones(m, np.int64)])}
        yield T.batches({**columns, "words": pa.array([b""] * (n + m), pa.binary())}, ROW)
        before = int(key[-1]), int(rid[-1]), int(pos[-1]), bool(first[-1])


def _window_rows(window: int, gram: int, hot: np.ndarray, salts: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in T.steps(batch, "text"):
                step = Step(part, window, gram)
                if not len(step.windows):
                    continue
                lists = part.column("found")
                shared = np.zeros(len(step.row), bool)
                row = np.repeat(np.arange(part.num_rows), np.asarray(lists.value_lengths().fill_null(0)))
                shared[step.base[row] + lists.flatten().to_numpy()] = True
                mine = shared[step.anchors]
                windows, anchors = step.windows[mine], step.anchors[mine]
                if not len(windows):
                    continue
                hashes = T.run_hashes(step.hashes, windows, windows + window)
                _, first, which, count = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
                multi = count[which] > 1
                again = np.flatnonzero(multi)
                original = windows[first[which[again]]]
                for k in range(window):  # the same hashes of all words, not just the same hash of the window
                    multi[again] &= step.hashes[windows[again] + k] == step.hashes[original + k]
                is_first = np.zeros(len(windows), bool)
                is_first[first] = True
                send = ~multi | is_first
                # windows with one anchor stand side by side
                head = np.flatnonzero(np.append(True, (anchors[1:] != anchors[:-1]) | (windows[1:] - windows[:-1] > window)))
                bit = np.int64(1) << (windows - np.repeat(windows[head], np.diff(np.append(head, len(windows)))))
                sent = np.add.reduceat(np.where(send, bit, 0), head)
                known = np.add.reduceat(np.where(multi, bit, 0), head)
                last = np.maximum.reduceat(np.where(send, windows, -1), head)
                whole = step.raw.tobytes()
                begin, end = step.starts[windows[head]].tolist(), step.ends[np.maximum(last, 0) + window - 1].tolist()
                words = [whole[a:b] if n >= 0 else b"" for a, b, n in zip(begin, end, last.tolist(), strict=True)]
                rid = part.column("rid").to_numpy()[step.row[windows[head]]]
                key = np.where(sent != 0, _keys(step.grams[anchors[head]].view(np.int64), rid, hot, salts), _spread(rid))
                yield T.batches({"key": key, "rid": rid, "pos": windows[head] - step.base[step.row[windows[head]]], "sent": sent, "known": known, "words": pa.array(words, pa.binary())}, ROW)

    return run


_MARK = pa.schema([("rid", pa.int64()), ("pos", pa.int32()), ("mask", pa.int64())])


def _shared_keys(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key to (rid, pos, mask): a sent row repeats if its neighbour has its key; what was known before passes. Holds one row."""
    held: pa.Table | None = None

    def judged(table: pa.Table, whole: int) -> Iterator[pa.RecordBatch]:
        key, sent, known = (table.column(c).to_numpy() for c in ("key", "sent", "known"))
        at = np.flatnonzero(sent)
        same = key[at[1:]] == key[at[:-1]]
        repeated = np.zeros(len(key), bool)
        repeated[at[1:][same]] = True
        repeated[at[:-1][same]] = True
        keep = np.flatnonzero(repeated | (known != 0))
        keep = keep[keep < whole]
        if len(keep):
            mask = np.where(repeated, sent | known, known)[keep]
            yield T.batches({"rid": table.column("rid").to_numpy()[keep], "pos": table.column("pos").to_numpy()[keep], "mask": mask}, _MARK)

    before: int | None = None  # key of the last sent row that has gone out
    for batch in source:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]).drop_columns(["words"])
        if held is not None:
            table = pa.concat_tables([held, table])
        table = _known_from(table.combine_chunks(), before)
        yield from judged(table, table.num_rows - 1)
        sent = table.column("sent").to_numpy()[:-1]
        if sent.any():
            before = int(table.column("key").to_numpy()[:-1][np.flatnonzero(sent)[-1]])
        held = table.slice(table.num_rows - 1)
    if held is not None:
        yield from judged(_known_from(held.combine_chunks(), before), held.num_rows)


def _known_from(table: pa.Table, before: int | None) -> pa.Table:
    """Sent rows whose key went out before are repeated."""
    if before is None:
        return table
    key, sent, known = (table.column(c).to_numpy() for c in ("key", "sent", "known"))
    known = np.where((sent != 0) & (key == before), known | sent, known)
    return table.set_column(table.column_names.index("known"), "known", pa.array(known))


def _shard(rows: list[tuple], window: int) -> list[int]:
    """Masks of repeated windows of a shard's rows (sent, known, words), by its suffix automaton."""
    groups: dict[tuple[bytes, ...], list[int]] = {}
    for k, (_, _, words) in enumerate(rows):
        groups.setdefault(tuple(words.split()), []).append(k)
    masks = [known for _, known, _ in rows]
    if len(groups) == 1:  # all the same: an automaton would say so too
        if len(rows) > 1:
            masks = [sent | known for sent, known, _ in rows]
        return masks
    automaton = SuffixAutomaton()
    for words, own in groups.items():
        automaton.add(words, len(own))
    automaton.sum_counts()
    count = automaton.count
    states = {words: [state for size, state in automaton.matches(words, window) if size >= window] for words in groups}
    # a window that repeats elsewhere in its own step counts as repeated for all
    flagged = {states[words][b] for words, own in groups.items() for k in own if rows[k][1] & rows[k][0] for b in _bits(rows[k][1] & rows[k][0])}
    for words, own in groups.items():
        found = sum(1 << b for b, state in enumerate(states[words]) if count[state] > 1 or state in flagged)
        for k in own:
            masks[k] |= found & rows[k][0]
    return masks


def _bits(mask: int) -> list[int]:
    return [b for b in range(mask.bit_length()) if mask >> b & 1]


def _shards(window: int, most: int):
    """Rows sorted by anchor to rows for `_shared_keys`: decided windows pass; undecided ones of a shard that was cut go on by their hash."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {c: [] for c in ROW.names}

        def put(key: int, rid: int, pos: int, sent: int, known: int) -> None:
            for c, v in zip(ROW.names, (key, rid, pos, sent, known, b""), strict=True):
                out[c].append(v)

        def settle(rows: list[tuple], cut: bool) -> None:
            gone: set[int] = set()
            for (rid, pos, sent, _, words), mask in zip(rows, _shard([r[2:] for r in rows], window), strict=True):
                if mask:
                    put(rid, rid, pos, 0, mask)
                if cut:
                    tokens = words.split()
                    for b in _bits(sent):
                        key = xxhash.xxh64_intdigest(b" ".join(tokens[b : b + window])) - (1 << 63)
                        if mask >> b & 1:  # repeated here already; one of them is enough to tell other shards
                            if key in gone:
                                continue
                            gone.add(key)
                        put(key, rid, pos + b, 1, mask >> b & 1)

        def flush() -> pa.RecordBatch:
            out["key"] = np.where(np.array(out["sent"], np.int64) != 0, np.array(out["key"], np.int64), _spread(np.array(out["rid"], np.int64)))
            batch = T.batches(out, ROW)
            for c in out:
                out[c] = []
            return batch

        key, held, cut = None, [], False
        for batch in source:
            for k, rid, pos, sent, known, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not sent:
                    put(k, rid, pos, 0, known)
                    continue
                if k != key:
                    if held:
                        settle(held, cut)
                    key, held, cut = k, [], bool(k & 1)  # a frequent anchor's shards are cut
                elif len(held) >= most:
                    cut = True
                    settle(held, cut)
                    held = []
                held.append((rid, pos, sent, known, words))
            if len(out["key"]) >= 20_000:
                yield flush()
        if held:
            settle(held, cut)
        if out["key"]:
            yield flush()

    return run


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key")


def _marks(rows: DataFrame) -> DataFrame:
    return _sorted(rows).mapInArrow(_shared_keys, "rid long, pos int, mask long")


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, joined by a space) of every row."""
    if not gram <= window <= gram + 62:
        raise ValueError("a window's starts around one anchor must fit a 64-bit mask")
    rows = docs.select(F.xxhash64("doc_id", "text").alias("rid"), "doc_id", "text")
    hot = _frequent(rows, window, gram)
    found = rows.select("rid", "text").mapInArrow(_anchor_rows(window, gram, hot, SALTS), ROW_DDL)
    if len(hot):
        found = settle(found)
        salted = (F.col("sent") != 0) & (F.col("key").bitwiseAND(1) == 1)
        found = found.where(~salted).unionByName(_sorted(found.where(salted)).mapInArrow(_first_round, ROW_DDL))
    anchors = _marks(found)
    places = anchors.groupBy("rid").agg(F.collect_list("pos").alias("found"))
    some = rows.join(places.hint("shuffle_hash"), "rid").select("rid", "doc_id", "text", "found")
    shards = _sorted(some.mapInArrow(_window_rows(window, gram, hot, SALTS), ROW_DDL)).mapInArrow(_shards(window, SHARD), ROW_DDL)
    masks = _marks(shards)
    removed = masks.groupBy("rid").agg(F.collect_list(F.struct("pos", "mask")).alias("found"))
    out = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in T.steps(batch, "text"):
                raw, offsets = T.utf8(part.column("text"))
                whole, at = raw.tobytes(), offsets.tolist()
                total, gone, kept = [], [], []
                lists = part.column("found")
                lengths = np.asarray(lists.value_lengths().fill_null(0))
                flat = lists.flatten()
                pos, mask = (flat.field(k).to_numpy() for k in (0, 1))
                edges = np.concatenate([[0], np.cumsum(lengths)])
                for r in range(part.num_rows):
                    words = whole[at[r] : at[r + 1]].split()
                    n = len(words)
                    total.append(n)
                    if lengths[r]:
                        p, m = pos[edges[r] : edges[r + 1]], mask[edges[r] : edges[r + 1]].view(np.uint64)
                        bits = np.unpackbits(m.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                        own, bit = np.nonzero(bits)
                        first = np.unique(p[own] + bit)
                        change = np.zeros(n + 1, np.int32)
                        change[first] += 1
                        change[first + window] -= 1
                        keep = np.cumsum(change[:-1]) == 0
                        words = list(compress(words, keep.tolist()))
                    gone.append(n - len(words))
                    kept.append(b" ".join(words).decode("utf-8", "replace"))
                yield T.batches({"doc_id": part.column("doc_id"), "n_words": total, "n_removed": gone, "kept": kept}, out)

    joined = rows.join(removed.hint("shuffle_hash"), "rid", "left").select("rid", "doc_id", "text", "found")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
