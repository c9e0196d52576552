"""Words of whole batches of texts as 64-bit hashes, computed on the byte buffers.

A word is a run of bytes other than ASCII white space; A-Z count as a-z. The hash is a polynomial over the bytes, mixed; it
depends on the word alone, so any task gives the same word the same hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# freed buffers go back to the system, not to a pool: workers are kept and several run beside one JVM
pa.set_memory_pool(pa.system_memory_pool())

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CHUNK = 1 << 19  # bytes handled at once; a longer text is one chunk of its own


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (a bijection)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))  # a value per byte
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << n.bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS


@dataclass
class Words:
    """The words of some texts: ``first[d]:first[d + 1]`` are those of text d, as hashes and as byte ranges of ``data``."""

    data: np.ndarray
    bounds: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    sums: np.ndarray  # running polynomial over the lower-cased bytes

    def hash_of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges, the same as a word with these bytes has."""
        return mix((self.sums[ends] - self.sums[starts]) * _powers(len(self.data) + 1)[1][starts])

    def __len__(self) -> int:
        return len(self.first) - 1

    def owner(self) -> np.ndarray:
        """The text of every word."""
        return np.repeat(np.arange(len(self)), np.diff(self.first))


def words(data: np.ndarray, bounds: np.ndarray) -> Words:
    """``bounds`` are the byte offsets of the texts in ``data``, one more than texts, from 0."""
    n = len(data)
    low = LOWER[data]
    inside = ~SPACE[low]
    before = np.empty(n, bool)
    before[1:] = inside[:-1]
    edges = bounds[:-1][bounds[:-1] < n]
    before[edges] = False
    if n:
        before[0] = False
    after = np.empty(n, bool)
    after[:-1] = before[1:]
    if n:
        after[-1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~(after & np.append(inside[1:], False))) + 1 if n else starts
    power, inverse = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[low] * power[:n], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * inverse[starts])
    return Words(data, bounds, np.searchsorted(starts, bounds), starts, ends, hashes, total)


def chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) for runs of texts of about ``size`` bytes; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, stop, data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
        row = stop


def word_hash(text: str) -> int:
    """The hash of one word."""
    data = np.frombuffer(text.encode(), np.uint8)
    return int(words(data, np.array([0, len(data)])).hashes[0])


def chain(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for equally long columns of hashes, order included."""
    h = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        h = mix(h * _U(_INVERSE) + part)
    return h


def places(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of ``k`` words begin that stay inside their text, and the offset of each text's runs."""
    n, count = int(first[-1]), np.diff(first)
    begin = np.arange(max(0, n - k + 1))
    ok = np.repeat(first[1:], count)[:len(begin)] - begin >= k
    return begin[ok], np.concatenate([[0], np.cumsum(np.maximum(count - k + 1, 0))])


def runs(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words, and the offset of each text's runs; a text of fewer words has none."""
    begin, offsets = places(w.first, k)
    return (chain([w.hashes[begin + i] for i in range(k)]) if len(begin) else np.zeros(0, np.uint64)), offsets
