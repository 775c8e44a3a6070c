"""Vectorised text kernel: words, word hashes and shingles of a whole Arrow batch in numpy.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, which in UTF-8 is the same as the
runs of code points other than those.  Hashes are 64-bit and the same in every process.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_rng = np.random.Generator(np.random.PCG64(20240607))
BYTE = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U)
BASE = U(0x9E3779B97F4A7C15)
BASE_INV = U(pow(int(BASE), -1, 2**64))
STEP = U(0xD6E8FEB86659FD93)
_powers: dict[str, np.ndarray] = {}


def release() -> None:
    """Give freed memory back, so that a worker that waits for its next task doesn't hold it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run):
    """A function over batches that gives its memory back at the end of its partition."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (splitmix's constants)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", BASE), ("down", BASE_INV)):
            x = np.full(size, base, U)
            x[0] = 1
            _powers[name] = np.cumprod(x, dtype=U)
    return _powers["up"][:n], _powers["down"][:n]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def spans(offsets: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of documents of about ``size`` bytes together; a longer document is its own run."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        yield a, b
        a = b


class Words:
    """Words of some documents: ``start``/``end`` byte positions, ``first[d]:first[d+1]`` of document d."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = data = LOWER[data] if lower else data
        self.offsets = offsets
        word = ~SPACE[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        head = word.copy()
        head[1:] &= ~word[:-1] | cut[1:-1]
        tail = word.copy()
        tail[:-1] &= ~word[1:] | cut[1:-1]
        self.start = np.flatnonzero(head)
        self.end = np.flatnonzero(tail) + 1
        self.first = np.searchsorted(self.start, offsets)

    def hashes(self) -> np.ndarray:
        up, down = _power(len(self.data) + 1)
        run = np.zeros(len(self.data) + 1, U)
        np.cumsum(BYTE[self.data] * up[:-1], out=run[1:])
        return mix((run[self.end] - run[self.start]) * down[self.start] + (self.end - self.start).astype(U) * STEP)


def windows(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word windows and their offsets by document; a shorter document has none."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(len(first), np.int64)
    x = hashes[:n].copy()
    for i in range(1, k):
        x *= STEP
        x += hashes[i : n + i]
    x = mix(x + U(k))
    counts = np.maximum(np.diff(first) - k + 1, 0)
    offs = np.concatenate(([0], np.cumsum(counts)))
    take = np.repeat(first[:-1] - offs[:-1], counts) + np.arange(offs[-1])
    return x[take], offs


def shingle_sets(column: pa.Array, k: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text, A-Z lower-cased.

    A text of fewer than k words has one shingle, the whole sequence; without words, none.
    """
    data, offsets = buffers(column)
    for a, b in spans(offsets):
        lo = offsets[a]
        words = Words(data[lo : offsets[b]], offsets[a : b + 1] - lo, lower=True)
        hashes, first = words.hashes(), words.first
        sh, offs = windows(hashes, first, k)
        for d in range(b - a):
            x, n = sh[offs[d] : offs[d + 1]], int(first[d + 1] - first[d])
            if len(x) > 1:
                x = np.sort(x)
                x = x[np.concatenate(([True], x[1:] != x[:-1]))]
            elif 0 < n < k:
                x = np.array([whole(hashes[first[d] : first[d + 1]])], U)
            yield a + d, x


def whole(hashes: np.ndarray) -> np.uint64:
    """Hash of a whole short sequence of words; its length is part of it."""
    x = np.zeros(1, U)
    for h in hashes:
        x = x * STEP + h
    return mix(x + U(len(hashes)))[0]


def binary(parts: np.ndarray) -> pa.Array:
    """A binary column of the rows of a two-dimensional array."""
    width = parts.shape[1] * parts.itemsize
    offs = (np.arange(len(parts) + 1, dtype=np.int32) * width).tobytes()
    return pa.Array.from_buffers(pa.binary(), len(parts), [None, pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(parts).tobytes())])


def runs(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(words, first) of some documents: words are maximal runs of the bytes that ``keep`` marks, A-Z lower-cased.

    Words ``first[d]:first[d+1]`` are those of document d.  Their bytes are packed without a loop over words.
    """
    data = LOWER[data]
    word = keep[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    head = word.copy()
    head[1:] &= ~word[:-1] | cut[1:-1]
    start = np.flatnonzero(head)
    at = np.append(np.cumsum(word)[start] - 1, np.count_nonzero(word))
    kind, size = (pa.binary(), np.int32) if len(data) < 2**31 else (pa.large_binary(), np.int64)
    words = pa.Array.from_buffers(kind, len(start), [None, pa.py_buffer(at.astype(size).tobytes()), pa.py_buffer(data[word].tobytes())])
    return words, np.searchsorted(start, offsets)


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(number of each word, the distinct words), compared by their bytes."""
    d = words.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until they hold ``size`` bytes."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.nbytes
        if n >= size:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)
