"""Packing token pieces into sequences of fixed capacity by sums of squares.

A piece goes where the sum, over residual gaps, of the squared number of open
sequences with that gap becomes smallest: into an open sequence, or a new one. This
keeps the gaps spread out, so that later pieces find a sequence they fill exactly.

Pieces are dealt into groups of about ``GROUP_PIECES`` by a hash of their content,
and each group is packed on its own, longest piece first. What groups leave
open is packed again, many groups' leftovers together, by sums of squares and by best fit (the
smallest gap that takes the piece), and the better new arrangement is taken where it needs fewer sequences. The number of groups follows the number of
pieces, so no task grows with the table.

Defined results: a null or empty text is one piece with the end id alone; repeated rows
are packed as often as they stand there; ties in length go by document and piece; an
empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalflow.llm.bpe import encoder, slices, word_vocabulary
from evalflow.llm.common import ship, text_rows, written

CAPACITY = 4096
END_ID = 1
#: Pieces that are packed together; more of them waste less but take one task longer.
GROUP_PIECES = 8192
#: Groups whose open sequences are packed again together.
GROUPS_AGAIN = 32

_PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
    ]
)


def _cut(path: str, capacity: int, end_id: int, with_ids: bool):
    end, step = end_id.to_bytes(4, "little"), 4 * capacity

    def run(batches):
        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            for first, texts in slices(batch.column("text")):
                rows = []
                for doc, ids in zip(docs[first:], encoder(path).encode(texts)):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), step)):
                        part = ids[at : at + step]
                        rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECE)]
                yield pa.RecordBatch.from_arrays(columns, schema=_PIECE)

    return run


def pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Each document's ids and the end id, cut where they exceed the capacity."""
    ship(docs.sparkSession)
    rows = text_rows(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    found = rows.mapInArrow(_cut(path, capacity, end_id, with_ids), schema)
    return found if with_ids else found.drop("ids")


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, in the given order."""
    open_count = np.zeros(capacity + 1, np.int64)  # by gap
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = 0
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    none = np.iinfo(np.int64).max
    for i, size in enumerate(lengths.tolist()):
        # Change of the sum of squares for each gap that takes the piece.
        here = open_count[size:]
        change = 2 * (open_count[: len(here)] - here) + 2
        change[0] = 1 - 2 * here[0]  # filled up: nothing stays open
        change[here == 0] = none
        best = int(change.argmin())
        fresh = 2 * int(open_count[capacity - size]) + 1 if size < capacity else 0
        if change[best] <= fresh:
            gap = best + size
            target = by_gap[gap].pop()
            open_count[gap] -= 1
        else:
            gap, target = capacity, used
            used += 1
        sequence[i], offset[i] = target, capacity - gap
        if gap > size:
            open_count[gap - size] += 1
            by_gap[gap - size].append(target)
    return sequence, offset


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, in the given order: where the gap is the smallest that takes it."""
    is_open = np.zeros(capacity + 1, bool)  # by gap
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = 0
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, size in enumerate(lengths.tolist()):
        gap = size + int(is_open[size:].argmax())
        if is_open[gap]:
            target = by_gap[gap].pop()
            is_open[gap] = bool(by_gap[gap])
        else:
            gap, target = capacity, used
            used += 1
        sequence[i], offset[i] = target, capacity - gap
        if gap > size:
            is_open[gap - size] = True
            by_gap[gap - size].append(target)
    return sequence, offset


_ORDER = ["length", "doc_id", "piece", "ids_crc32"]


def _pack_group(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(_ORDER, ascending=[False, True, True, True], kind="stable")
        sequence, pdf["offset"] = place(pdf["length"].to_numpy(), capacity)
        pdf["sequence_id"] = pdf["grp"] * 2**32 + sequence
        fill = pdf.groupby("sequence_id")["length"].transform("sum")
        pdf["open"] = fill < capacity - capacity // 100
        return pdf

    return run


def _pack_again(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(_ORDER, ascending=[False, True, True, True], kind="stable")
        lengths = pdf["length"].to_numpy()
        sequence, offset = min(place(lengths, capacity), best_fit(lengths, capacity), key=lambda found: found[0].max())
        if len(np.unique(sequence)) < pdf["sequence_id"].nunique():
            pdf["offset"] = offset
            pdf["sequence_id"] = 2**61 + pdf["again"] * 2**32 + sequence
        return pdf

    return run


def pack(cut: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces with the sequence each goes into and its place there."""
    ship(cut.sparkSession)
    cut = written(cut, "pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in cut.schema]
    schema = ", ".join([*kept, "grp long", "sequence_id long", "offset long", "open boolean"])
    # the number of the row in the written pieces keeps equal rows from meeting in one group
    dealt = cut.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))
    first = written(dealt.groupBy("grp").applyInPandas(_pack_group(capacity), schema), "packed")
    rounds = -(-groups // GROUPS_AGAIN)
    left = first.filter("open").withColumn("again", F.pmod("grp", F.lit(rounds)))
    second = left.groupBy("again").applyInPandas(_pack_again(capacity), schema + ", again long").drop("again")
    return first.filter("not open").unionByName(second).drop("grp", "open")


def op2_best_fit_packing(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    """All documents in sequences of at most 4096 tokens, a row for each piece."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(pieces(docs, path or word_vocabulary()))


QUERIES = {"op2_best_fit_packing": op2_best_fit_packing}
