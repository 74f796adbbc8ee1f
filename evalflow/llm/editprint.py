"""Document fingerprints by a randomised edit embedding.

A walk reads a text from its first character. At every step a random bit, shared by all
texts and fixed by the step and the character read, says whether the walk stays
or goes on to the next character. What it reads, step by step, is the embedding: after
an edit two walks fall into step again, so a few edits change few of its places, and
edit distance becomes Hamming distance. The random bits repeat after ``PERIOD`` steps.

The fingerprint samples the embedding at ``SLOTS`` steps, the same for texts of like
length: slot k takes the step below the walk's length with the least value of
a random order of its own. Each slot is a byte, the hash of the characters read from there on.
Likeness is the share of equal slots. ``search`` finds like fingerprints by bands of
slots and verifies each candidate by its likeness.

Whole texts are walked, at some tens of nanoseconds a character.

Defined results: a null or empty text has a fingerprint of zeros; equal texts, repeated
rows among them, have equal fingerprints; rows with one id follow each other by text;
a table of one row is its own next document; an empty table gives an empty one; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evalflow.llm.common import by_id, partitions, ship, text_rows, written
from evalflow.llm.hashing import mix

SLOTS = 128
PERIOD = 4096
#: Characters that a slot's byte stands for.
WINDOW = 4
#: 42 bands of three slots meet for all but a 270th of the pairs with half of their slots equal.
BAND_SLOTS = 3
#: Prints of one band that one task pairs with queries; fuller bands are split.
BAND_PRINTS = 10_000

_STEP = np.uint64(0x9E3779B97F4A7C15)


class _Waits(dict):
    """By character: how far each step of the period goes until the walk has left it."""

    def __missing__(self, char: str) -> bytes:
        code = ord(char)
        kind = code if code < 1024 else 1024 + code % 1024
        steps = np.arange(PERIOD, dtype=np.uint64) + np.uint64(kind * PERIOD)
        leaves = np.flatnonzero(mix(steps * _STEP) >> np.uint64(63))
        ahead = np.r_[leaves, leaves[0] + PERIOD]
        wait = ahead[np.searchsorted(ahead, np.arange(PERIOD))] - np.arange(PERIOD) + 1
        found = self[char] = np.minimum(wait, 255).astype(np.uint8).tobytes()
        return found


class _Slots:
    """The step that each slot samples, by the length of the walk."""

    def __init__(self):
        self.known = 0
        self.least = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
        self.records: list[list[int]] = [[] for _ in range(SLOTS)]
        self.table = np.empty((SLOTS, 0), np.int64)

    def _extend(self, length: int) -> None:
        while self.known < length:
            steps = np.arange(self.known, self.known + (1 << 16), dtype=np.uint64)
            for k in range(SLOTS):
                order = mix(steps * _STEP + mix(np.array([k + 1], np.uint64)))
                run = np.minimum.accumulate(np.minimum(order, self.least[k]))
                new = np.flatnonzero(np.r_[run[0] < self.least[k], run[1:] < run[:-1]])
                self.records[k] += (new + self.known).tolist()
                self.least[k] = run[-1]
            self.known += len(steps)
        width = max(map(len, self.records))
        self.table = np.array([r + [np.iinfo(np.int64).max] * (width - len(r)) for r in self.records], np.int64)

    def steps(self, length: int) -> np.ndarray:
        if length > self.known:
            self._extend(length)
        return self.table[np.arange(SLOTS), (self.table < length).sum(axis=1) - 1]


_waits, _slots = _Waits(), _Slots()


def walk(text: str, at: int = 0) -> list[int]:
    """The step at which the walk has left each character."""
    waits, last = _waits, PERIOD - 1
    return [at := at + waits[c][at & last] for c in text]


def sample(text: str, left: np.ndarray) -> bytes:
    """The fingerprint of a text whose characters are left at the given steps."""
    if not text:
        return bytes(SLOTS)
    codes = np.r_[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), np.zeros(WINDOW, "<u4")]
    at = np.searchsorted(left, _slots.steps(int(left[-1])), "right")
    value = np.zeros(SLOTS, np.uint64)
    for k in range(WINDOW):
        value = mix(value * _STEP + codes[at + k])
    return (value >> np.uint64(56)).astype(np.uint8).tobytes()


def fingerprint(text: str) -> bytes:
    return sample(text, np.array(walk(text), np.int64))


def likeness(a: bytes, b: bytes) -> float:
    return float((np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)).mean())


def _print_batches(batches):
    for batch in batches:
        prints = [fingerprint(t) for t in batch.column("text").to_pylist()]
        yield batch.drop_columns(["text"]).append_column("fingerprint", pa.array(prints, pa.binary()))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, fingerprint binary)`` of every row."""
    ship(docs.sparkSession)
    rows = text_rows(docs, (id_column,), text)
    kind = rows.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(_print_batches, f"`{id_column}` {kind}, fingerprint binary")


def _slots_equal(a, b):
    pairs = F.transform(
        F.sequence(F.lit(1), F.lit(SLOTS)),
        lambda i: (F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1))).cast("int"),
    )
    return F.aggregate(pairs, F.lit(0), lambda t, x: t + x) / SLOTS


def search(queries: DataFrame, prints: DataFrame, least: float = 0.5, band_slots: int = BAND_SLOTS) -> DataFrame:
    """Fingerprints like those of the queries: ``(query, fingerprint, likeness)``, distinct.

    Rows with equal fingerprints are one here; a join on the fingerprint gives their ids.
    Candidates share a band of ``band_slots`` slots; each is verified once. No registered query
    searches.
    """

    def bands(df: DataFrame, name: str) -> DataFrame:
        each = [
            F.concat(F.lit(b).cast("string"), F.lit(":"), F.hex(F.substring("fingerprint", b + 1, band_slots)))
            for b in range(0, SLOTS - band_slots + 1, band_slots)  # whole bands only
        ]
        distinct = df.select("fingerprint").distinct()
        return distinct.select(F.col("fingerprint").alias(name), F.explode(F.array(*each)).alias("band"))

    filed, asked = bands(prints, "fingerprint"), bands(queries, "query")
    splits = filed.groupBy("band").agg(F.ceil(F.count("*") / BAND_PRINTS).cast("int").alias("splits")).filter("splits > 1")
    of_band = F.coalesce("splits", F.lit(1))
    filed = filed.join(splits, "band", "left").withColumn("split", F.pmod(F.xxhash64("fingerprint"), of_band).cast("int"))
    asked = asked.join(splits, "band", "left").withColumn("split", F.explode(F.sequence(F.lit(0), of_band - 1)))
    pairs = asked.drop("splits").join(filed.drop("splits"), ["band", "split"]).select("query", "fingerprint").distinct()
    return pairs.withColumn("likeness", _slots_equal(F.col("query"), F.col("fingerprint"))).filter(
        F.col("likeness") >= least
    )


_RESULT = [
    ("doc_id", pa.int64()),
    ("n_chars", pa.int64()),
    ("edited_sha256", pa.string()),
    ("fingerprint", pa.binary()),
    ("edited_fingerprint", pa.binary()),
    ("near_edited", pa.float64()),
    ("near_next", pa.float64()),
]
_STREAM = pa.schema([*_RESULT, ("kind", pa.int32()), ("place", pa.int64()), ("text", pa.string())])
_STREAM_SQL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double, kind int, place long, text string"
)
_DONE, _HEAD, _TAIL = 0, 1, 2


def _edited(doc, text: str, left: np.ndarray, mark: bytes, after: str, after_mark: bytes) -> tuple:
    cut = len(text) // 4
    kept = len(text) - cut
    new = after[:cut]
    edited = text[:kept] + new
    more = walk(new, int(left[kept - 1]) if kept else 0)
    edited_mark = sample(edited, np.r_[left[:kept], np.array(more, np.int64)])
    digest = hashlib.sha256(edited.encode()).hexdigest()
    return doc, len(text), digest, mark, edited_mark, likeness(mark, edited_mark), likeness(mark, after_mark)


def _follow(batches):
    """Each row with the next one; the first and the last row go on with their texts."""
    place = TaskContext.get().partitionId()
    before, rows, held = None, [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _STREAM)], schema=_STREAM)

    for arrived in batches:
        for doc, text in zip(arrived.column("doc_id").to_pylist(), arrived.column("text").to_pylist()):
            left = np.array(walk(text), np.int64)
            mark = sample(text, left)
            if before is None:
                rows.append((doc, len(text), None, mark, None, None, None, _HEAD, place, text))
            else:
                rows.append((*_edited(*before, text, mark), _DONE, place, None))
            before = (doc, text, left, mark)
        if rows:
            yield batch()
            rows.clear()
    if before is not None:
        doc, text, _, mark = before
        rows.append((doc, len(text), None, mark, None, None, None, _TAIL, place, text))
        yield batch()


def _meet(batches):
    for batch in batches:
        rows = []
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "text", "fingerprint", "next_text", "next_print")]
        for doc, text, mark, after, after_mark in zip(*columns):
            rows.append(_edited(doc, text, np.array(walk(text), np.int64), mark, after, after_mark))
        if rows:
            schema = pa.schema(_RESULT)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of the text that ends like the next document begins.

    Rows are dealt out by ranges of the id and walked in order. Only the first and last
    row of a range meet rows of another: they are kept with their texts, two a task, and
    matched in a second step.
    """
    ship(docs.sparkSession)
    rows = text_rows(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    ordered = rows.repartitionByRange(partitions(docs.sparkSession), *by_id(rows)).sortWithinPartitions("doc_id", "text")
    stream = written(ordered.mapInArrow(_follow, _STREAM_SQL), "walks")
    columns = [name for name, _ in _RESULT]
    heads = stream.filter(F.col("kind") == _HEAD).select(
        "place", F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print")
    )
    # two rows a task: the one ordering over all of them is over so few
    order = heads.select(
        "place",
        F.coalesce(F.lead("place").over(Window.orderBy("place")), F.min("place").over(Window.partitionBy())).alias(
            "next_place"
        ),
    )
    tails = stream.filter(F.col("kind") == _TAIL).select("place", "doc_id", "text", "fingerprint")
    met = (
        tails.join(order, "place")
        .join(heads.withColumnRenamed("place", "next_place"), "next_place")
        .select("doc_id", "text", "fingerprint", "next_text", "next_print")
        .mapInArrow(_meet, ", ".join(_STREAM_SQL.split(", ")[: len(columns)]))
    )
    return stream.filter(F.col("kind") == _DONE).select(*columns).unionByName(met)


def op9_edit_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, as hexadecimal."""
    found = edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


QUERIES = {"op9_edit_fingerprints": op9_edit_fingerprints}
