"""Whole text batches as numpy arrays: spans of words, their hashes, windows over them.

A column of texts is one byte buffer with offsets. Every separator the operators use is ASCII, so
bytes of 0x80 and above always belong to words and UTF-8 never has to be decoded.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: ``[^\x20\x09-\x0D]+`` and ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` as one flag per byte.
UNSPACED = np.ones(256, dtype=bool)
UNSPACED[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

#: Bytes (or words) hashed at once; bounds the memory of the sums below.
BLOCK = 1 << 18

#: Odd bases of the polynomial hashes and their inverses modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)

LENGTH_FACTOR, MASK = 0xA0761D6478BD642F, (1 << 64) - 1

_POWERS: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def flatten(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside`` bytes, and each text's first run."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    flags = inside[data]
    opens, closes = flags.copy(), flags.copy()
    opens[1:] &= ~flags[:-1]
    closes[:-1] &= ~flags[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    opens[cuts] = flags[cuts]
    closes[cuts - 1] = flags[cuts - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, grown on demand."""
    size = 1 << max(n - 1, 1).bit_length()
    if (base, size) not in _POWERS:
        inverse = pow(base, -1, 1 << 64)
        made = []
        for b in (base, inverse):
            row = np.full(size, b, np.uint64)
            row[0] = 1
            made.append(np.multiply.accumulate(row))
        _POWERS.clear() if len(_POWERS) > 8 else None
        _POWERS[base, size] = (made[0], made[1])
    return _POWERS[base, size]


def hash_spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for each span; spans may overlap, starts ascend.

    Prefix sums of a polynomial: a span is a difference of two sums, times a power of the base's
    inverse. Worked in blocks, so memory is bounded by BLOCK and the longest span.
    """
    base = BASES[which]
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        to = max(at + 1, int(np.searchsorted(starts, low + BLOCK)))
        high = int(ends[at:to].max())
        up, down = _powers(base, high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((values[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(LENGTH_FACTOR)
        at = to
    return mix(out)


def prefix_sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What ``hash_from`` needs to hash any span of a short buffer at once."""
    up, down = _powers(BASES[0], len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
    return sums, down


def hash_from(sums: tuple[np.ndarray, np.ndarray], starts: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the spans of one length, equal to those of ``hash_spans``."""
    total, down = sums
    return mix((total[starts + length] - total[starts]) * down[starts] + np.uint64(length * LENGTH_FACTOR & MASK))


def hash_words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and each text's first word."""
    starts, ends, first = spans(data, offsets, inside)
    return hash_spans(data, starts, ends, which), first


def windows(first: np.ndarray, length: int, short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and end word of each run of ``length`` words within one text.

    ``short``: a text of fewer words, but not none, is one shorter run.
    """
    counts = np.diff(first)
    n = np.maximum(counts - length + 1, (counts > 0).astype(np.int64) if short else 0)
    text = np.repeat(np.arange(len(counts)), n)
    begin = np.concatenate([[0], np.cumsum(n)])
    start = np.arange(begin[-1]) - np.repeat(begin[:-1] - first[:-1], n)
    return text, start, np.minimum(start + length, first[1:][text])


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The integers ``start .. start + count - 1`` of each pair, one after the other."""
    total = np.cumsum(counts)
    if not len(total):
        return np.empty(0, np.int64)
    return np.arange(total[-1]) + np.repeat(starts - (total - counts), counts)
