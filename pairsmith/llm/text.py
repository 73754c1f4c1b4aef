"""Words and their hashes, for a whole Arrow column at once.

Words are runs of bytes other than blank and 0x09 to 0x0D. A word hash is a polynomial over its bytes modulo
2**64, scrambled; it depends on the word alone.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19  # text handled at a time; bounds the temporary arrays, not the result
BASE = np.uint64(0x9E3779B97F4A7C15)

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
#: All of ASCII but letters and digits, for words without punctuation.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the splitmix64 finaliser); one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        back = np.uint64(pow(int(BASE), -1, 1 << 64))
        _powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, BASE), dtype=np.uint64)])
        _inverse = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, back), dtype=np.uint64)])
    return _powers, _inverse


class Words:
    """The words of a column of texts.

    ``hashes``: one per word; ``first``: for each text the index of its first word, and one entry more at the
    end; ``data``, ``starts``, ``ends``: the bytes, and where each word lies in them.
    """

    def __init__(self, column: pa.Array, lower: bool = False, separator: np.ndarray = _SEPARATOR):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column, "").cast(pa.large_string())
        n = len(column)
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        inside = ~separator[data]
        start, end = inside.copy(), inside.copy()
        if len(data):
            edge = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
            start[1:] &= ~inside[:-1]
            start[edge] = inside[edge]
            end[:-1] &= ~inside[1:]
            end[edge - 1] = inside[edge - 1]
        self.data, self.lower = data, lower
        self.starts, self.ends = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        out = np.empty(len(self.starts), np.uint64)
        a = 0
        while a < len(out):
            base = self.starts[a]
            b = max(a + 1, int(np.searchsorted(self.starts, base + SLICE_BYTES)))
            part = self.data[base:self.ends[b - 1]]
            powers, inverse = _power_tables(len(part) + 1)
            codes = (_LOWER[part] if self.lower else part).astype(np.uint64) + np.uint64(1)
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(codes * powers[:len(part)], out=total[1:])
            s, e = self.starts[a:b] - base, self.ends[a:b] - base
            out[a:b] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64))
            a = b
        return out

    def __len__(self) -> int:
        return len(self.first) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive words; those across two texts are the caller's to leave out."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, factor = np.zeros(n, np.uint64), np.uint64(1)
    for i in range(size):
        out += hashes[i:i + n] * factor
        factor = np.uint64(int(factor) * int(BASE) % (1 << 64))
    return mix(out + np.uint64(size))


def owners(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all windows of ``size`` words that lie within one text, and the text of each."""
    n = np.maximum(np.diff(first) - size + 1, 0)
    text = np.repeat(np.arange(len(n)), n)
    ahead = np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else np.zeros(0, np.int64)
    return np.arange(len(text)) - ahead[text] + first[:-1][text], text


def release() -> None:
    """Give the memory that this process holds and doesn't use back to the system. A worker process lives on after a
    task and would keep all that any of its tasks needed at once."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library only
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of text; a longer text stands alone, whole. Before the first
    and after the last one unused memory is given back."""
    release()
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total, a = np.cumsum(size), 0
        while a < batch.num_rows:
            done = total[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(total, done + limit, "right")))
            yield batch.slice(a, b - a)
            a = b
    release()


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every ``size`` consecutive values: each is the last one rolled on by one value."""
    powers, inverse = _power_tables(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers[:len(hashes)], out=total[1:])
    n = len(hashes) - size + 1
    return (total[size:] - total[:n]) * inverse[:n]
