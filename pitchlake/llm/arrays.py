"""Whole texts as flat numpy arrays: what the operators share inside their tasks.

A batch of texts is one byte array with offsets, cut into slices of bounded size so that
temporaries stay small however long a text is. Null counts as the empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that part words: tab, line feed, vertical tab, form feed, carriage return, space.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SLICE = 1 << 21
_PRIME = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_PRIME), -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets of the texts in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("" if not pa.types.is_binary(column.type) else b"").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    start, n = column.offset, len(column)
    ends = np.frombuffer(offsets, np.int64)[start:start + n + 1] if n else np.zeros(1, np.int64)
    body = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, ends - ends[0]


def slices(data: np.ndarray, offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Byte ranges of at most about ``limit``; a longer text is cut before a white-space byte."""
    at, end = 0, len(data)
    while at < end:
        to = min(at + limit, end)
        if to < end:
            whole = offsets[np.searchsorted(offsets, to, "right") - 1]
            if whole > at:
                to = int(whole)
            else:
                text_end = int(offsets[np.searchsorted(offsets, at, "right")])
                to = min(to, text_end)
                while to < text_end and not SPACE[data[to]]:  # a word is never cut
                    gap = np.flatnonzero(SPACE[data[to:min(to + limit, text_end)]])
                    to = to + int(gap[0]) if len(gap) else min(to + limit, text_end)
        yield at, to
        at = to


def words(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data[lo:hi]``; a text's end also ends a word."""
    part = np.ones(hi - lo + 2, bool)
    part[1:-1] = SPACE[data[lo:hi]]
    starts = ~part[1:-1] & part[:-2]
    ends = ~part[1:-1] & part[2:]
    inner = offsets[np.searchsorted(offsets, lo, "right"):np.searchsorted(offsets, hi, "left")] - lo
    inner = inner[(inner > 0) & (inner < hi - lo)]
    starts[inner] |= ~part[inner + 1]
    ends[inner - 1] |= ~part[inner]
    return np.flatnonzero(starts) + lo, np.flatnonzero(ends) + lo + 1


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the prime and of its inverse, modulo 2**64."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        with np.errstate(over="ignore"):
            _powers[size] = tuple(
                np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, p, np.uint64))])
                for p in (_PRIME, _INVERSE)
            )
    return _powers[size]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of ``data[s:e]`` for each span, from one running sum."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power(len(data))
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * _MIX
        h = (h ^ (h >> np.uint64(29))) * _MIX
        return h ^ (h >> np.uint64(32))


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the n + 1 offsets of the texts in these."""
    hashes, firsts = [], []
    for lo, hi in slices(data, offsets):
        starts, ends = words(data, offsets, lo, hi)
        own = LOWER[data[lo:hi]] if lower else data[lo:hi]
        hashes.append(span_hashes(own, starts - lo, ends - lo))
        firsts.append(starts)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(firsts), offsets)


def runs(offsets: np.ndarray) -> np.ndarray:
    """The text of each element, from the offsets."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def shingle_hashes(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each n words in a row that stay in one text, and the index of the first word."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        out = hashes[:len(hashes) - n + 1].copy()
        for k in range(1, n):
            out = out * _PRIME + hashes[k:len(hashes) - n + 1 + k]
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(hashes))
    at = np.flatnonzero(left[:len(out)] >= n)
    return mix(out[at]), at


def dense(arrays: list[np.ndarray], dtype) -> pa.Array:
    """One binary value for each array."""
    return pa.array([np.ascontiguousarray(a, dtype).tobytes() for a in arrays], pa.binary())
