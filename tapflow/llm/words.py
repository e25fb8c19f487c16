"""Words of many texts at once: numpy over the UTF-8 bytes of an Arrow column, no loop over words.

A word is a maximal run of bytes of a class. A byte of 128 or more is always part of a character
outside ASCII, so classes of ASCII characters plus "everything else" hold for bytes as for characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20  # bytes whose hash terms are held at once
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Which of the 256 bytes belong to the class: all of 128 and more, and the given ranges, ends included."""
    members = np.zeros(256, bool)
    members[128:] = True
    for first, last in ranges:
        members[first : last + 1] = True
    return members


#: A-Z to a-z, all else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

ALNUM = byte_class((48, 57), (97, 122))
NOT_SPACE = byte_class((0, 8), (14, 31), (33, 127))


class Flat(NamedTuple):
    """Texts one after the other: text i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Word w is data[starts[w]:ends[w]]; text i has the words first[i] to first[i + 1]."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def flat(column: pa.Array) -> Flat:
    """The bytes of a string column; a null has none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    n = len(column)
    if n == 0 or data is None:
        return Flat(np.zeros(0, np.uint8), np.zeros(n + 1, np.int64))
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    bytes_ = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return Flat(bytes_, offsets - offsets[0])


def pieces(texts: Flat, limit: int = 4 << 20) -> Iterator[tuple[int, Flat]]:
    """Runs of whole texts of about `limit` bytes, with the index of the first; a longer text is a piece alone."""
    n, at = len(texts.offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(texts.offsets, texts.offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), n)
        low, high = texts.offsets[at], texts.offsets[to]
        yield at, Flat(texts.data[low:high], texts.offsets[at : to + 1] - low)
        at = to


def words_of(texts: Flat, members: np.ndarray) -> Words:
    """All words, none reaching over the border of two texts."""
    n = len(texts.data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(texts.offsets), np.int64))
    inside = members[texts.data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    borders = texts.offsets[texts.offsets < n]
    begins[borders] = inside[borders]
    over = inside.copy()
    over[:-1] &= ~inside[1:]
    last = texts.offsets[texts.offsets > 0] - 1
    over[last] = inside[last]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(over) + 1
    return Words(starts, ends, np.searchsorted(starts, texts.offsets))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        n = max(n, BLOCK + 1)
        for i, base in enumerate((int(_ODD), pow(int(_ODD), -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * _MIX
    h = h ^ (h >> np.uint64(32))
    h = h * _MIX
    return h ^ (h >> np.uint64(32))


def hashes(data: np.ndarray, starts: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
    """A 64-bit hash of each span of bytes, for each array of ends: polynomials from running sums."""
    out = [np.empty(len(starts), np.uint64) for _ in ends]
    at = 0
    while at < len(starts):
        to = max(int(np.searchsorted(starts, starts[at] + BLOCK, "right")), at + 1)
        low, high = int(starts[at]), int(max(e[to - 1] for e in ends))
        up, down = _powers_to(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
        s = starts[at:to] - low
        for one, end in zip(out, ends, strict=True):
            one[at:to] = mixed((sums[end[at:to] - low] - sums[s]) * down[s])
        at = to
    return out


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values, sorted; a place of each, not always the first; the number of each place's value among them."""
    order = np.argsort(values)  # faster than the stable sort that first places need
    ordered = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(values), np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[new], order[new], number


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indexes starts[i] .. starts[i] + sizes[i] of all i, one after the other."""
    total = int(sizes.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    begin = np.cumsum(sizes) - sizes
    return np.arange(total) + np.repeat(starts - begin, sizes)
