"""Words and byte hashes of an Arrow column of texts, whole arrays at a time.

A word is a run of digits, of letters a-z and of characters above U+007F, after lower-casing
A-Z; in UTF-8 that is a test per byte. Hashes are polynomials over bytes modulo 2^64, taken
from prefix sums, so that the hash of any stretch costs two reads.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes of text worked on at once. One document is never split.
CHUNK_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[ord("0") : ord("9") + 1] = _IS_WORD[ord("a") : ord("z") + 1] = _IS_WORD[0x80:] = True


class Powers:
    """Powers of an odd base and of its inverse, as far as they were needed yet."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, CHUNK_BYTES + 1)
            self.up, self.down = (self._powers(b, n) for b in (self.base, self.inverse))

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


_POWERS = Powers(_BASE)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all others."""
    return _mix(h.copy())


def _mix(h: np.ndarray) -> np.ndarray:
    """The same in place."""
    spare = h >> np.uint64(30)
    h ^= spare
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= np.right_shift(h, np.uint64(27), out=spare)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= np.right_shift(h, np.uint64(31), out=spare)
    return h


def prefix_hashes(data: np.ndarray, powers: Powers | None = None) -> np.ndarray:
    powers = powers or _POWERS
    powers.reach(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    terms = out[1:]
    terms[:] = data
    terms += np.uint64(1)
    terms *= powers.up[: len(data)]
    np.cumsum(terms, out=terms)
    return out


def stretch_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers | None = None) -> np.ndarray:
    """Hashes of data[start:end]; equal stretches have equal hashes wherever they stand."""
    h = prefix[ends]
    h -= prefix[starts]
    h *= (powers or _POWERS).down[starts]
    return _mix(h)


def rolling_hashes(prefix: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all stretches of one width, by start."""
    h = prefix[width:] - prefix[:-width]
    h *= _POWERS.down[: len(h)]
    return _mix(h)


@dataclass
class Chunk:
    """Documents first..first+n of a batch: their bytes, one after another."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The column's texts as UTF-8, null as empty, about `limit` bytes at a time."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, raw_offsets, raw = column.buffers()
    offsets = np.frombuffer(raw_offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        own = offsets[first : last + 1]
        yield Chunk(first, data[own[0] : own[-1]], own - own[0])
        first = last


@dataclass
class Words:
    """data: lower-cased bytes; starts, ends: of each word; first: of each document's words,
    with the number of all words at the end."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        return stretch_hashes(prefix_hashes(self.data), self.starts, self.ends)

    def document(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words_of(chunk: Chunk) -> Words:
    data = _LOWER[chunk.data]
    inside = _IS_WORD[data]
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return Words(data, none, none, np.zeros(chunk.n + 1, dtype=np.int64))
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = chunk.offsets[:-1][np.diff(chunk.offsets) > 0]
    begins[edges] = inside[edges]
    edges = edges[1:] - 1  # last bytes of the documents before
    ends[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, chunk.offsets))
