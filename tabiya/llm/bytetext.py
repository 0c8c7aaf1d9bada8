"""Vectorised tokens, hashes and windows over UTF-8 Arrow buffers.

An Arrow string column is one byte buffer with offsets. Tokens are maximal
runs of bytes of one class, so word boundaries, 64-bit word hashes and
rolling window hashes of a whole batch are a few numpy passes; no Python
string is made for a word that is not looked at again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_RNG = np.random.Generator(np.random.Philox(20240229))
_TABLE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_WINDOW_BASE = 0xD6E8FEB86659FD93 | 1
#: Bytes hashed at once: bounds the temporary 64-bit arrays whatever a text's length.
BLOCK = 1 << 21


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _POW.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        have = _POW[base] = (_powers(base, size), _powers(pow(base, -1, 1 << 64), size))
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1)."""
    return ((x >> U64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def class_table(*runs: bytes) -> np.ndarray:
    """Byte -> class number (1 for the first run of bytes and so on, 0 for separators)."""
    out = np.zeros(256, np.uint8)
    for k, run in enumerate(runs, 1):
        out[np.frombuffer(run, np.uint8)] = k
    return out


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
HIGH = bytes(range(128, 256))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lowering A-Z.
WORD = class_table(b"0123456789abcdefghijklmnopqrstuvwxyz" + HIGH)
#: ``[^\x20\x09-\x0D]+``.
FIELD = class_table(bytes(b for b in range(256) if b != 32 and not 9 <= b <= 13))
#: letters: a-z and every byte of a non-ASCII character.
LETTER = class_table(b"abcdefghijklmnopqrstuvwxyz" + HIGH)


@dataclass
class Tokens:
    buf: np.ndarray      # lower-cased bytes
    starts: np.ndarray   # byte position of each token
    ends: np.ndarray
    first: np.ndarray    # token number of each text's first token, with the total at the end

    def bytes_of(self, i: int) -> bytes:
        return self.buf[self.starts[i]:self.ends[i]].tobytes()

    def doc(self) -> np.ndarray:
        """Text number of each token."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most ``limit`` bytes together (a longer text is alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def tokens(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool = True) -> Tokens:
    """Tokens of the texts ``offsets`` cuts ``buf`` into."""
    low = LOWER[buf] if lower else buf
    if not len(low):
        z = np.zeros(0, np.int64)
        return Tokens(low, z, z, np.zeros(len(offsets), np.int64))
    cls = table[low]
    edge = np.empty(len(low) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(cls[1:], cls[:-1], out=edge[1:-1])
    edge[offsets] = True
    cut = np.flatnonzero(edge)
    inside = cls[cut[:-1]] > 0
    starts, ends = cut[:-1][inside], cut[1:][inside]
    return Tokens(low, starts, ends, np.searchsorted(starts, offsets))


def spans_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans in ascending order that do not overlap."""
    out = np.empty(len(starts), U64)
    i, n = 0, len(starts)
    while i < n:
        base = starts[i]
        j = max(int(np.searchsorted(ends, base + BLOCK, side="right")), i + 1)
        part = buf[base:ends[j - 1]]
        up, down = powers(_BASE, len(part) + 1)
        total = np.empty(len(part) + 1, U64)
        total[0] = 0
        np.cumsum(_TABLE[part] * up[:len(part)], out=total[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((total[b] - total[a]) * down[a] + (b - a).astype(U64))
        i = j
    return out


def window_hash(word: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive word hashes (one value per possible start)."""
    n = len(word) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    for k in range(width):  # width passes, no wrap-around of powers to undo
        out *= U64(_WINDOW_BASE)
        out += word[k:k + n]
    return mix(out)


def doc_windows(first: np.ndarray, width: int) -> np.ndarray:
    """Token numbers at which a window of ``width`` tokens lies inside one text."""
    counts = np.maximum(np.diff(first) - width + 1, 0)
    out = np.arange(int(counts.sum()), dtype=np.int64)
    return out + np.repeat(first[:-1] - (np.cumsum(counts) - counts), counts)
