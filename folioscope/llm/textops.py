"""Vectorised text primitives over Arrow string columns, shared by the operators of this subpackage.

Everything works on the UTF-8 bytes of a whole Arrow column at once: words, word hashes and the hash of any run of
consecutive words, without a Python object per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one vectorised step handles; a single longer text makes a step of its own.
STEP_BYTES = 1 << 20

U64 = np.uint64
_K = U64(0x9E3779B97F4A7C15 | 5)
_K_INVERSE = U64(pow(int(_K), -1, 1 << 64))


def table(path_dir: str, name: str) -> str:
    return f"{path_dir}/{name}.parquet"


def steps(batch: pa.RecordBatch, column: str, most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about `most` bytes, so that memory follows the step and not the batch."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(at, to - at)
        at = to
    _give_back()


@cache
def _trim() -> Callable[[int], int]:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # another C library than glibc
        return lambda pad: 0


def _give_back() -> None:
    """Returns what allocators hold on to: a worker that Spark keeps for later tasks would otherwise keep the most it ever used."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; a null row has no bytes."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    column = pa.concat_arrays([column]) if column.offset else column
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def byte_set(text: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(text)] = True
    return out


#: Words are runs of anything but the space and the five control characters U+0009 to U+000D.
NOT_SPACE = ~byte_set(b" \t\n\x0b\x0c\r")
#: Bytes with A-Z turned into a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word and, per row, the number of words. A word never spans two rows."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    w = np.zeros(len(raw) + 2, bool)
    w[1:-1] = inside[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(w[1:-1] & (~w[:-2] | cut[:-1]))
    ends = np.flatnonzero(w[1:-1] & (~w[2:] | cut[1:])) + 1
    edges = np.searchsorted(starts, offsets)
    return starts, ends, np.diff(edges)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS
    if len(_POWERS[0]) < n:
        n = max(n, 1 << 20, 2 * len(_POWERS[0]))
        up, down = np.full(n, _K, U64), np.full(n, _K_INVERSE, U64)
        up[0] = down[0] = 1
        np.multiply.accumulate(up, out=up)
        np.multiply.accumulate(down, out=down)
        _POWERS = up, down
    return _POWERS


_POWERS: tuple[np.ndarray, np.ndarray] = (np.zeros(0, U64), np.zeros(0, U64))
_BYTES = mix(np.arange(1, 257, dtype=U64) * _K)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each run; equal runs hash alike wherever they stand."""
    up, down = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    return run_hashes((_BYTES if fold is None else _BYTES[fold])[raw], starts, ends)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of n consecutive words from each word on, across rows too; the caller drops those that cross."""
    starts = np.arange(max(0, len(hashes) - n + 1))
    return run_hashes(hashes, starts, starts + n)


def batches(columns: dict[str, pa.Array | np.ndarray | list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in schema], schema=schema)
