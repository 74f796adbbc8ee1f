"""Totals of hashed keys over a whole table, given back to each block of rows.

Rows are dealt into blocks of a few MB. A block asks for the totals of its distinct keys;
requests go by ranges of the key to the tasks that add them up; answers go back to the
block, whose rows then see, for each of their keys, the total over the table. A key
that stands in a third of all rows is one entry per block, so no task gets all its
rows. Keys travel in sorted, packed arrays: as 48 bits of the hash in about four bytes each
(`short`, where a rare collision does no harm), or whole in about six.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalflow.llm.common import ship

#: Text that a block holds, and text whose keys are added up in one task.
BLOCK_BYTES = 4 << 20
PART_BYTES = 16 << 20

_HIGH, _LOW = np.uint64(48), np.uint64(16)


def short(keys: np.ndarray) -> np.ndarray:
    """The hashes with all but their upper 48 bits cleared."""
    return keys >> _LOW << _LOW


def _packed(array: np.ndarray, kind: str) -> bytes:
    return zlib.compress(array.astype(kind).tobytes(), 1)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


def _edges(parts: int) -> np.ndarray:
    """First value of the upper 16 bits of each part's keys, and the end."""
    return -(-np.arange(parts + 1) * 65536 // parts)


@dataclass(frozen=True)
class Sizes:
    blocks: int
    parts: int


def sizes(docs: DataFrame, block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES) -> Sizes:
    """As many blocks and parts as the text needs."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return Sizes(max(1, -(-total // block_bytes)), max(1, min(65536, -(-total // part_bytes))))


def blocked(docs: DataFrame, size: Sizes) -> DataFrame:
    """The rows with the block each belongs to; rows of one id part by their texts."""
    return docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(size.blocks)))


Keys = Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]
_ASKED = pa.schema(
    [("block", pa.int64()), ("part", pa.int32()), ("highs", pa.binary()), ("lows", pa.binary()), ("counts", pa.binary())]
)
_TOLD = pa.schema(
    [("block", pa.int64()), ("part", pa.int32()), ("mask", pa.binary()), ("totals", pa.binary()), ("first", pa.int64())]
)
_ASKED_SQL = "block long, part int, highs binary, lows binary, counts binary"
_TOLD_SQL = "block long, part int, mask binary, totals binary, first long"


def _ask(keys: Keys, parts: int, brief: bool):
    edges = _edges(parts)

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        found, counts = keys(table)
        high = (found >> _HIGH).astype(np.int64)
        cut = np.searchsorted(high, edges)
        rows = []
        for part, (a, b) in enumerate(zip(cut.tolist(), cut[1:].tolist())):
            if b > a:
                first = int(edges[part])
                highs = np.bincount(high[a:b] - first, minlength=int(edges[part + 1]) - first)
                lows = (found[a:b] >> _LOW).astype("<u4").tobytes()
                if not brief:
                    lows += found[a:b].astype("<u2").tobytes()
                rows.append((block, part, _packed(highs, "<u4"), lows, _packed(counts[a:b], "<u4")))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ASKED)] if rows else
                                    [pa.array([], f.type) for f in _ASKED], schema=_ASKED)

    return run


def _restored(highs: bytes, lows: bytes, first: int) -> np.ndarray:
    high = _unpacked(highs, "<u4")
    n = int(high.sum())
    keys = np.repeat(np.arange(len(high), dtype=np.uint64) + np.uint64(first), high) << _HIGH
    keys |= np.frombuffer(lows, "<u4", n).astype(np.uint64) << _LOW
    if len(lows) > 4 * n:
        keys |= np.frombuffer(lows, "<u2", n, 4 * n)
    return keys


def _add_up(parts: int, least: int):
    edges = _edges(parts)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        part = table.column("part")[0].as_py()
        blocks = table.column("block").to_pylist()
        keys, counts = [], []
        for highs, lows, count in zip(*(table.column(c).to_pylist() for c in ("highs", "lows", "counts"))):
            keys.append(_restored(highs, lows, int(edges[part])))
            counts.append(_unpacked(count, "<u4"))
        length = [len(k) for k in keys]
        flat = np.concatenate(keys)
        del keys
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        start = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
        total = np.add.reduceat(np.concatenate(counts).astype(np.int64)[order], start)
        spread = np.empty(len(flat), np.int64)
        spread[order] = np.repeat(total, np.diff(np.r_[start, len(flat)]))
        del flat
        asked_first = np.zeros(len(order), bool)
        asked_first[order[start]] = True
        rows, at = [], 0
        for block, n in zip(blocks, length):
            mine, own = spread[at : at + n], asked_first[at : at + n]
            at += n
            mask = mine >= least
            packed = zlib.compress(np.packbits(mask).tobytes(), 1)
            rows.append((block, part, packed, _packed(np.minimum(mine[mask], 2**32 - 1), "<u4"), int((own & mask).sum())))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _TOLD)], schema=_TOLD)

    return run


def _totals(found: np.ndarray, told: pa.Table, parts: int) -> tuple[np.ndarray, int]:
    """Totals of the block's keys, 0 where below the least, and the keys this block was the first to ask for."""
    edges = _edges(parts)
    cut = np.searchsorted(found >> _HIGH, edges)
    out, first = np.zeros(len(found), np.int64), 0
    for row in told.to_pylist():
        a, b = cut[row["part"]], cut[row["part"] + 1]
        mask = np.unpackbits(np.frombuffer(zlib.decompress(row["mask"]), np.uint8), count=b - a).astype(bool)
        out[a:b][mask] = _unpacked(row["totals"], "<u4")
        first += row["first"]
    return out, first


def with_totals(
    docs: DataFrame,
    size: Sizes,
    keys: Keys,
    use: Callable[[pa.Table, np.ndarray, np.ndarray, int], pa.Table],
    schema: str,
    least: int = 1,
) -> DataFrame:
    """``use(rows of a block, its keys, their totals, keys first asked for here)`` over all blocks.

    ``keys(rows)`` gives a block's distinct short keys in order and what each adds.
    Totals under ``least`` come as 0.
    """
    ship(docs.sparkSession)
    parts = size.parts
    rows = blocked(docs, size)
    asked = rows.groupBy("block").applyInArrow(_ask(keys, parts, least > 1), _ASKED_SQL)
    told = asked.groupBy("part").applyInArrow(_add_up(parts, least), _TOLD_SQL)

    def answer(table: pa.Table, replies: pa.Table) -> pa.Table:
        found, _ = keys(table)
        totals, first = _totals(found, replies, parts)
        return use(table, found, totals, first)

    return rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(answer, schema)
