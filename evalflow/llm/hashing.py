"""Hashes of words and shingles over the bytes of many texts at once, in numpy.

A word's hash is the sum of a random 64-bit number per byte value, times powers of an
odd number by place, all modulo 2**64: prefix sums over a whole batch give every word
at once. Upper and lower case A-Z share a number, so lower-casing costs nothing.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

_SPACES = bytes([32, *range(9, 14)])
_BASE = 0x9E3779B97F4A7C15
#: Bytes whose prefix sums are held at once; longer texts are still taken whole.
CHUNK_BYTES = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in order; by sorting, which is several times faster than by a table."""
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    value = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    value[65:91] = value[97:123]
    space = np.zeros(256, bool)
    space[list(_SPACES)] = True
    value[space] = 0
    return value, space


@lru_cache(4)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    def table(base: int) -> np.ndarray:
        out = np.ones(1 << bits, np.uint64)
        have, factor = 1, base
        while have < len(out):
            out[have : 2 * have] = out[:have] * np.uint64(factor)
            have, factor = 2 * have, factor * factor % 2**64
        return out

    return table(_BASE), table(pow(_BASE, -1, 2**64))


def _hash_chunk(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    value, _ = _tables()
    power, inverse = _powers(max(12, int(len(data)).bit_length()))
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = (data == 32) | (data - np.uint8(9) < 5)
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edge[::2], edge[1::2]
    total = np.zeros(len(data) + 1, np.uint64)
    each = value.take(data.astype(np.intp))  # much faster than by bytes
    each *= power[: len(data)]
    np.cumsum(each, out=total[1:])
    total = total.take(edge)
    sums = (total[1::2] - total[::2]) * inverse.take(starts)
    return mix(sums + (ends - starts).astype(np.uint64)), starts, ends


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column without nulls, one text after the other, and where each begins."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    begin = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[begin[0] : begin[-1]], begin - begin[0]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of stretches of bytes as they are; stretches are not empty and in order."""
    power, inverse = _powers(max(12, int(len(data)).bit_length()))
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * power[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def _parts(column: pa.Array):
    """Runs of texts as bytes with their words: hash, start, end, and how many each text has."""
    data, begin = text_bytes(column)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(begin, begin[row] + CHUNK_BYTES, "right")) - 1)
        # a blank after each text, so that no word runs into the next text
        part = np.insert(data[begin[row] : begin[end]], begin[row + 1 : end + 1] - begin[row], 32)
        found, starts, ends = _hash_chunk(part)
        edges = begin[row : end + 1] - begin[row] + np.arange(end - row + 1)
        yield part, found, starts, ends, np.diff(np.searchsorted(starts, edges))
        row = end


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the first word of each text (and the end)."""
    hashes, counts = [], []
    for _, found, _, _, count in _parts(column):
        hashes.append(found)
        counts.append(count)
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    return np.concatenate(hashes), np.r_[0, np.cumsum(np.concatenate(counts))]


def gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given stretches of an array behind each other, and where each begins (and the end)."""
    begin = np.r_[0, np.cumsum(sizes)]
    return data[np.arange(begin[-1]) + np.repeat(starts - begin[:-1], sizes)], begin


def lowered(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def _first_seen(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values as they come first, where that is, and the number of each value; by a table, without sorting."""
    found = pa.array(values).dictionary_encode()
    same = found.indices.to_numpy()
    first = np.empty(len(found.dictionary), np.int64)
    first[same[::-1]] = np.arange(len(same))[::-1]
    return found.dictionary.to_numpy(), first, same


def distinct_words(column: pa.Array, weight: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of the texts in lower case, each with the summed weight of its texts."""
    _, words, total = dealt_words(column, weight)
    return words, total


def dealt_words(column: pa.Array, weight: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The upper 16 bits of the hashes of the distinct words, in order, the words in lower case, their summed weights."""
    seen, words, sums, row = [], [], [], 0
    for part, found, starts, ends, counts in _parts(column):
        share = np.repeat(weight[row : row + len(counts)], counts)
        row += len(counts)
        key, first, same = _first_seen(found)
        flat, begin = gathered(part, starts[first], ends[first] - starts[first])
        seen.append(key)
        words.append((lowered(flat), np.diff(begin)))
        sums.append(np.bincount(same, share, len(key)))
    if not seen:
        return np.empty(0, np.uint16), pa.array([], pa.binary()), np.empty(0, np.int64)
    flat, sizes = np.concatenate([w for w, _ in words]), np.concatenate([n for _, n in words])
    keys, first, same = _first_seen(np.concatenate(seen))
    total = np.bincount(same, np.concatenate(sums), len(first)).astype(np.int64)
    high = (keys >> np.uint64(48)).astype(np.uint16)
    order = np.argsort(high, kind="stable")
    first = first[order]
    at = np.r_[0, np.cumsum(sizes)]
    flat, begin = gathered(flat, at[first], sizes[first])
    return high[order], binary_array(flat, begin), total[order]


def binary_array(flat: np.ndarray, begin: np.ndarray) -> pa.Array:
    """An Arrow binary column over stretches that lie behind each other."""
    return pa.Array.from_buffers(
        pa.binary(), len(begin) - 1, [None, pa.py_buffer(begin.astype("<i4")), pa.py_buffer(np.ascontiguousarray(flat))]
    )


def shingle_hashes(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``size`` words of each text, sorted, and where each text's begin.

    A text with fewer words has one shingle, its whole sequence; one without words none.
    """
    words, first = word_hashes(column)
    count = np.diff(first)
    n = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    at = np.r_[0, np.cumsum(n)]
    text = np.repeat(np.arange(len(n)), n)
    start = first[text] + np.arange(at[-1]) - at[text]
    length = np.minimum(count[text], size)
    value = mix(length.astype(np.uint64))
    full = bool((length == size).all())
    for k in range(size):
        if full:
            value = mix(value * np.uint64(_BASE) + words[start + k])
        else:
            inside = length > k
            step = words[np.where(inside, start + k, 0)]
            value = np.where(inside, mix(value * np.uint64(_BASE) + step), value)
    for a, b in zip(at.tolist(), at[1:].tolist()):
        value[a:b].sort()
    fresh = np.r_[True, (value[1:] != value[:-1]) | (text[1:] != text[:-1])] if len(value) else np.empty(0, bool)
    value, text = value[fresh], text[fresh]
    return value, np.searchsorted(text, np.arange(len(n) + 1))
