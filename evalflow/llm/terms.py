"""Words of many texts at once, as 64-bit keys, for any set of separating bytes.

A batch of texts becomes one run of bytes with a separating byte after each text, cut at
separators into stretches of about ``CHUNK_BYTES``, so that the working arrays stay small
however long a text is. Keys do not tell ``A``-``Z`` from ``a``-``z``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from evalflow.llm.hashing import _powers, _tables, mix, text_bytes

CHUNK_BYTES = 1 << 20


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the bytes of the given ranges, ends included."""
    found = np.zeros(256, bool)
    for low, high in ranges:
        found[low : high + 1] = True
    return found


#: All ASCII characters but letters and digits; every byte of other scripts belongs to a word.
NOT_ALNUM = byte_set((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


@dataclass(frozen=True)
class Words:
    """Words in order: their key, where they lie in ``data``, and the text each belongs to."""

    data: np.ndarray
    keys: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    first: np.ndarray  # the first word of each text, and the end


def joined(column: pa.Array, between: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts with the byte ``between`` behind each, and where each begins (and the end)."""
    data, begin = text_bytes(column)
    return np.insert(data, begin[1:], between), begin + np.arange(len(begin))


def keyed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    power, inverse = _powers(max(12, int(len(data)).bit_length()))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * power[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def words(column: pa.Array, gap: np.ndarray) -> Words:
    """The words of a text column without nulls: longest runs of bytes outside ``gap``."""
    between = int(np.flatnonzero(gap)[0])
    data, begin = joined(column, between)
    values = _tables()[0].copy()
    values[gap] = 0
    keys, starts, ends, at = [], [], [], 0
    while at < len(data):
        end = min(at + CHUNK_BYTES, len(data))
        while end < len(data):  # on to the next separator
            cut = np.flatnonzero(gap[data[end : end + CHUNK_BYTES]])
            if len(cut):
                end += int(cut[0]) + 1
                break
            end = min(end + CHUNK_BYTES, len(data))
        part = data[at:end]
        edge = np.flatnonzero(np.diff(np.r_[True, gap[part], True]))
        a, b = edge[::2], edge[1::2]
        keys.append(keyed(part, a, b, values))
        starts.append(a + at)
        ends.append(b + at)
        at = end
    none = np.empty(0, np.int64)
    start = np.concatenate(starts or [none])
    first = np.searchsorted(start, begin)
    text = np.repeat(np.arange(len(begin) - 1), np.diff(first))
    return Words(data, np.concatenate(keys or [np.empty(0, np.uint64)]), start, np.concatenate(ends or [none]), text, first)


def key_of(word: str, gap: np.ndarray = NOT_ALNUM) -> int:
    """The key of one word."""
    return int(words(pa.array([word]), gap).keys[0])


def looked_up(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The place of each key among the known ones, which are sorted; -1 for others."""
    if not len(known):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, at, -1)


def slices(batch: pa.RecordBatch, size: int = 4 << 20):
    """The batch in parts of about ``size`` bytes of its text; a longer text is a part of its own."""
    begin = text_bytes(batch.column("text"))[1]
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(begin, begin[row] + size, "right")) - 1)
        yield batch.slice(row, end - row)
        row = end
