"""Byte-level BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over words cuts texts where the content says so, so equal passages of different documents give equal chunks;
a chunk is encoded and decoded once per task's memo. Where two chunks meet at a place that is not certainly a pre-token
boundary, the join is repaired: text is pre-tokenised from the last certain boundary of the left chunk until a boundary
agrees with one of the right chunk, and that stretch is encoded again.

Why a repaired join is exact: the pre-tokeniser's pattern never looks behind and at most three characters past a pre-token's start or
one past its end, so what it does from a boundary on depends only on the text from there on, and merges stay within a pre-token.

Null text: empty, no tokens. Texts of any length: whole. Rows keep their number and doc_id, repeated or null ones too.
Other columns are ignored.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import textops as T

#: A cut follows a word where the hash of it and its three predecessors is 0 modulo this.
WORDS_A_CHUNK = 96
#: A stretch of more bytes without white space is cut by position; joins there are repaired.
LONGEST_WORD = 1 << 16
#: Bytes of chunks that each of two generations of the memo holds.
MEMO_BYTES = 6 << 20
#: Below this code point the two libraries' character classes are known to agree; chunks with others use the reference library.
PLAIN_BELOW = "ɐ"
#: White space as both libraries' patterns see it.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


class Engine:
    """Encodes text as the tokenizer file defines it. One for each Python worker and file."""

    made: dict[tuple[str, int], Engine] = {}

    def __init__(self, path: str, memo_bytes: int = MEMO_BYTES) -> None:
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        byte_of = {c: b for b, c in _byte_characters().items()}
        self.bytes_of = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        ranks = {}
        for token, i in vocab.items():
            if token not in self.special:
                ranks[raw := bytes(byte_of[c] for c in token)] = i
                self.bytes_of[i] = raw
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.pattern = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
        self.fast = tiktoken.Encoding("own", pat_str=r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+", mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.young: dict[str, tuple[array, bytes]] = {}
        self.old: dict[str, tuple[array, bytes]] = {}
        self.held = self.encoded = self.reused = 0
        self.memo_bytes = memo_bytes

    @classmethod
    def at(cls, path: str) -> Engine:
        import os

        key = (path, os.getpid())
        if key not in cls.made:
            cls.made[key] = cls(path)
        return cls.made[key]

    @cached_property
    def slow(self):
        """The reference library's tokenizer; loaded only if a text needs it."""
        import tokenizers

        made = tokenizers.Tokenizer.from_file(self.path)
        made.no_truncation()
        made.no_padding()
        return made

    def plain(self, text: str) -> list[int]:
        """Token ids of a text without special tokens."""
        if text.isascii() or (max(text) < PLAIN_BELOW and "\x85" not in text):  # U+0085 is white space to one of them only
            return self.fast.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids

    def decode(self, ids: Iterable[int]) -> bytes:
        of = self.bytes_of
        return b"".join([of[i] for i in ids])

    def chunk(self, text: str) -> tuple[array, bytes]:
        """Ids of a chunk and what they decode to, from the memo if it was seen before."""
        if (got := self.young.get(text)) is not None:
            self.reused += 1
            return got
        if (got := self.old.get(text)) is None:
            ids = self.plain(text)
            got = array("I", ids), self.decode(ids)
            self.encoded += 1
        else:
            self.reused += 1
        self.young[text] = got
        self.held += len(text)
        if self.held > self.memo_bytes:
            self.old, self.young, self.held = self.young, {}, 0
        return got

    def joined(self, left: str, ids: array, right: str, more: array) -> array:
        """Ids of left + right from the ids of both; `ids` starts at a true boundary."""
        if not right or not left or (right[0] in SPACE and left[-1] not in SPACE):
            return ids + more
        sure = self._sure(left)
        theirs = {len(left) + m.end() for m in self.pattern.finditer(right)}
        text, agreed, between = left + right, len(left) + len(right), []
        for m in self.pattern.finditer(text, sure):
            between += self.plain(m[0])
            if m.end() in theirs:
                agreed = m.end()
                break
        keep = self._cut(ids, len(left[:sure].encode()))
        skip = self._cut(more, len(right[: agreed - len(left)].encode()))
        return ids[:keep] + array("I", between) + more[skip:]

    def _cut(self, ids: array, size: int) -> int:
        """How many ids make up the first `size` bytes."""
        at = 0
        for k, i in enumerate(ids):
            if at >= size:
                return k
            at += len(self.bytes_of[i])
        return len(ids)

    def encode(self, text: str, cuts: Callable[[str], list[str]]) -> tuple[array, bytes]:
        """Ids of a text and what they decode to. `cuts` splits a text into chunks, which may be cut anywhere."""
        ids = array("I")
        out: list[bytes] = []
        at = 0
        for m in [*(self.split.finditer(text) if self.split and any(s in text for s in self.special) else ()), None]:
            for got, raw in self._pieces(cuts(text[at : m.start() if m else len(text)])):
                ids += got
                out.append(raw)
            if m:
                ids.append(self.special[m[0]])
                out.append(m[0].encode())
                at = m.end()
        return ids, b"".join(out)

    def _pieces(self, chunks: list[str]) -> Iterator[tuple[array, bytes]]:
        """Ids and bytes of the chunks, joined. What lies before the last certain boundary goes out at once, so a join looks at the tail only.

        Where the tail is a single pre-token longer than `LONGEST_WORD`, chunks are gathered until they are as long as the tail: the work of all
        joins then stays in proportion to the text.
        """
        tail, held, gathered, size = "", (array("I"), b""), [], 0

        def join() -> tuple[array, bytes]:
            nonlocal tail, held, gathered, size
            right = "".join(gathered)
            more = self.chunk(right)[0] if len(gathered) == 1 else array("I", self.plain(right))
            ids, text = self.joined(tail, held[0], right, more), tail + right
            sure = self._sure(text)
            keep = self._cut(ids, len(text[:sure].encode()))
            tail, held, gathered, size = text[sure:], (ids[keep:], self.decode(ids[keep:])), [], 0
            return ids[:keep], self.decode(ids[:keep])

        for text in filter(None, chunks):
            last = gathered[-1] if gathered else tail
            if last and not (text[0] in SPACE and last[-1] not in SPACE):
                gathered.append(text)
                size += len(text)
                if size >= len(tail) or len(tail) <= LONGEST_WORD:
                    yield join()
                continue
            if gathered:
                yield join()
            if tail:
                yield held
            tail, held = text, self.chunk(text)
        if gathered:
            yield join()
        if tail:
            yield held

    def _sure(self, text: str) -> int:
        """The last boundary of a text, read from a true one on, that whatever follows can't move."""
        sure, last = 0, len(text) - 3
        for m in self.pattern.finditer(text):
            if m.end() > last:
                break
            sure = m.end()
        return sure


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 ones for themselves, the rest from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


def content_chunks(raw: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """Byte offsets, within each row, after which a chunk ends. They depend on the words just before them only."""
    starts, ends, counts = T.words(raw, offsets, T.NOT_SPACE)
    out: list[list[int]] = [[] for _ in counts]
    if not len(starts):
        return out
    grams = T.gram_hashes(T.word_hashes(raw, starts, ends), 4)
    row = np.repeat(np.arange(len(counts)), counts)
    hit = np.flatnonzero(grams % T.U64(WORDS_A_CHUNK) == 0) + 3
    hit = hit[row[hit] == row[hit - 3]]
    for r, e in zip(row[hit].tolist(), (ends[hit] - offsets[row[hit]]).tolist(), strict=True):
        out[r].append(e)
    for k in np.flatnonzero(ends - starts > LONGEST_WORD).tolist():
        r, base = int(row[k]), int(offsets[row[k]])
        for at in range(int(starts[k]) + LONGEST_WORD, int(ends[k]), LONGEST_WORD):
            while raw[at] & 0xC0 == 0x80:  # not within a character
                at -= 1
            out[r].append(at - base)
        out[r].sort()
    return out


def encode_decode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit integers) and decoded (string) of every whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = Engine.at(tokenizer_path)
        for batch in source:
            for part in T.steps(batch, "text"):
                raw, offsets = T.utf8(part.column("text"))
                whole, at = raw.tobytes(), offsets.tolist()
                ids, texts = [], []
                for r, ends in enumerate(content_chunks(raw, offsets)):
                    own = whole[at[r] : at[r + 1]]
                    ends = [0, *ends, len(own)]
                    chunks = [own[a:b].decode() for a, b in zip(ends, ends[1:], strict=False)]
                    if any(s.encode() in own for s in engine.special):
                        got, text = engine.encode(own.decode(), lambda piece: _again(piece))
                    else:
                        got, text = array("I"), []
                        for i, b in engine._pieces(chunks):
                            got += i
                            text.append(b)
                        text = b"".join(text)
                    ids.append(np.frombuffer(got, "u4").astype("<u4").tobytes() if got else b"")
                    texts.append(text.decode("utf-8", "replace"))
                yield T.batches({"doc_id": part.column("doc_id"), "ids": ids, "decoded": texts}, schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary, decoded string")


def _again(text: str) -> list[str]:
    raw = np.frombuffer(own := text.encode(), np.uint8)
    ends = [0, *content_chunks(raw, np.array([0, len(raw)]))[0], len(own)]
    return [own[a:b].decode() for a, b in zip(ends, ends[1:], strict=False)]
