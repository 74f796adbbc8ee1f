"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its words and its runs of five bytes, in lower case and with
punctuation as blanks, hashed; a term counts once a text. Of these the model takes the
terms whose presence differs between the labels beyond chance. To the sum of their weights
it adds, for every two terms of a text, the product of their factors: an insult beside a
mention of a group can weigh more than the two apart, which additive weights miss.

The model is learned on at most ``TOXIC_ROWS`` and ``CLEAN_ROWS`` labelled texts, those with
the least hash of the id and text; whole texts are read both to learn and to score. Scores
use the text alone.

Defined results: a null or empty text has no term and gets the model's bias; a
document with several labels counts as toxic if one says so, a null label is none; repeated
rows are scored alike; without labels of both kinds the score is the share of toxic ones
(0 without any); an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalflow.llm.common import crc_bucket, ship, text_rows
from evalflow.llm.hashing import _hash_chunk, distinct, mix, text_bytes

HELD_OUT_MODULUS = 5
TERM_BITS = 20
RUN_BYTES = 5
TOXIC_ROWS, CLEAN_ROWS = 4000, 8000
#: Least texts a term stands in, and least G statistic of its presence against the label.
LEAST_TEXTS, LEAST_G = 4, 15.0
FACTORS = 8
EPOCHS = 12
BATCH_TEXTS = 128
RATE, DECAY = 0.08, 1e-4
_CHUNK = 1 << 19
_TEXTS_AT_ONCE = 256


def _plain() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    for b in range(128):
        if not chr(b).isalnum():
            table[b] = 32
    table[65:91] = table[97:123]
    return table


_PLAIN = _plain()


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed terms of all texts, as often as they stand, and the text of each."""
    data, begin = text_bytes(column)
    found, owners, row = [], [], 0
    shift = np.uint64(64 - TERM_BITS)
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(begin, begin[row] + _CHUNK, "right")) - 1)
        # a blank before and after each text
        part = np.insert(data[begin[row] : begin[end]], begin[row : end + 1] - begin[row], 32)
        part = _PLAIN[part]
        edges = begin[row : end + 1] - begin[row] + np.arange(end - row + 1)
        owner = np.repeat(np.arange(row, end, dtype=np.int32), np.diff(edges))
        words, starts, _ = _hash_chunk(part)
        found.append((words >> shift).astype(np.int32))
        owners.append(owner[np.minimum(starts, len(owner) - 1)])
        if len(part) >= RUN_BYTES:
            runs = np.zeros(len(part) - RUN_BYTES + 1, np.uint64)
            for k in range(RUN_BYTES):
                runs |= part[k : k + len(runs)].astype(np.uint64) << np.uint64(8 * k)
            first = np.arange(len(runs))
            inside = owner[np.minimum(first, len(owner) - 1)]
            whole = first + RUN_BYTES - 1 <= edges[inside - row + 1]
            found.append((mix(runs[whole] + np.uint64(1)) >> shift).astype(np.int32))
            owners.append(inside[whole])
        row = end
    if not found:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    return np.concatenate(found), np.concatenate(owners)


def presence(term: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each term once a text, texts in order."""
    key = distinct(owner.astype(np.int64) << 32 | term)
    return (key & 0xFFFFFFFF).astype(np.int64), key >> 32


@dataclass(frozen=True)
class Machine:
    """Which terms are used (-1: not), their weights and factors, and the bias."""

    place: np.ndarray
    weight: np.ndarray
    factor: np.ndarray
    bias: float

    def margins(self, term: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        sums = np.bincount(owner, self.weight[term], texts)
        pairs = np.zeros(texts)
        for f in range(self.factor.shape[1]):
            v = self.factor[term, f]
            pairs += np.bincount(owner, v, texts) ** 2 - np.bincount(owner, v * v, texts)
        return self.bias + sums + pairs / 2

    def scores(self, column: pa.Array) -> np.ndarray:
        found = []
        for row in range(0, len(column), _TEXTS_AT_ONCE):  # terms take many times the text
            part = column.slice(row, _TEXTS_AT_ONCE)
            term, owner = terms(part)
            at = self.place[term]
            used = at >= 0
            at, owner = presence(at[used], owner[used])
            found.append(1 / (1 + np.exp(-np.clip(self.margins(at, owner, len(part)), -30, 30))))
        return np.concatenate(found) if found else np.empty(0)


def chosen(toxic: np.ndarray, clean: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Terms whose presence, counted by label, depends on the label by a G test."""
    g = np.zeros(len(toxic))
    share = (toxic + clean) / (n1 + n0)
    for a, n in ((toxic, n1), (clean, n0)):
        for seen, expected in ((a, n * share), (n - a, n * (1 - share))):
            g += 2 * np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-9)), 0)
    return np.flatnonzero((toxic + clean >= LEAST_TEXTS) & (g >= LEAST_G))


def fit(column: pa.Array, label: np.ndarray) -> Machine:
    """Learned by adaptive gradient steps over shuffled texts, both labels weighing the same."""
    n1 = int(label.sum())
    if not 0 < n1 < len(label):
        share = n1 / max(1, len(label))
        bias = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
        return Machine(np.full(1 << TERM_BITS, -1, np.int32), np.zeros(1), np.zeros((1, FACTORS)), bias)
    # some texts at a time, twice: all their terms would not fit
    counts = np.zeros((2, 1 << TERM_BITS))
    for row in range(0, len(label), _TEXTS_AT_ONCE):
        term, owner = presence(*terms(column.slice(row, _TEXTS_AT_ONCE)))
        for kind in (0, 1):
            counts[kind] += np.bincount(term[label[owner + row] == kind], minlength=1 << TERM_BITS)
    picked = chosen(counts[1], counts[0], n1, len(label) - n1)
    place = np.full(1 << TERM_BITS, -1, np.int32)
    place[picked] = np.arange(len(picked))
    parts = []
    for row in range(0, len(label), _TEXTS_AT_ONCE):
        term, owner = terms(column.slice(row, _TEXTS_AT_ONCE))
        at = place[term]
        at, owner = presence(at[at >= 0], owner[at >= 0])
        parts.append((at.astype(np.int32), (owner + row).astype(np.int32)))
    at, owner = (np.concatenate(x) for x in zip(*parts))
    begin = np.searchsorted(owner, np.arange(len(label) + 1))
    order = np.random.default_rng(4)
    size = max(1, len(picked))
    weight, factor, bias = np.zeros(size), order.normal(0, 0.01, (size, FACTORS)), 0.0
    weight_sum, factor_sum, bias_sum = np.full(size, 1e-8), np.full((size, FACTORS), 1e-8), 1e-8
    worth = np.where(label == 1, len(label) / (2 * n1), len(label) / (2 * (len(label) - n1)))
    for _ in range(EPOCHS):
        shuffled = order.permutation(len(label))
        for start in range(0, len(label), BATCH_TEXTS):
            texts = shuffled[start : start + BATCH_TEXTS]
            counts = begin[texts + 1] - begin[texts]
            own = np.repeat(np.arange(len(texts)), counts)
            t = at[np.arange(counts.sum()) + np.repeat(begin[texts] - np.r_[0, np.cumsum(counts)[:-1]], counts)]
            v = factor[t]
            sums = np.zeros((len(texts), FACTORS))
            np.add.at(sums, own, v)
            squares = np.bincount(own, (v * v).sum(axis=1), len(texts))
            margin = bias + np.bincount(own, weight[t], len(texts)) + ((sums**2).sum(axis=1) - squares) / 2
            miss = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label[texts]) * worth[texts] / len(texts)
            used, same = np.unique(t, return_inverse=True)
            step = np.bincount(same, miss[own], len(used)) + DECAY * weight[used] / len(texts)
            weight_sum[used] += step**2
            weight[used] -= RATE * step / np.sqrt(weight_sum[used])
            steps = np.zeros((len(used), FACTORS))
            np.add.at(steps, same, miss[own][:, None] * (sums[own] - v))
            steps += DECAY * factor[used] / len(texts)
            factor_sum[used] += steps**2
            factor[used] -= RATE / 4 * steps / np.sqrt(factor_sum[used])
            total = miss.sum()
            bias_sum += total**2
            bias -= RATE * total / np.sqrt(bias_sum)
    return Machine(place, weight, factor, float(bias))


def training_rows(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """The bounded sample: ``(text, toxic)`` of labelled rows where ``learn`` holds."""
    known = labels.filter("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    keys = docs.filter(learn).select("doc_id", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("order"))
    drawn = keys.join(known.select("doc_id", "toxic"), "doc_id")
    counts = {bool(r[0]): r[1] for r in drawn.groupBy(F.col("toxic") != 0).count().collect()}  # two rows

    def least(toxic: bool, rows: int) -> DataFrame:
        """The rows with the least hash, out of about twice as many with a small one."""
        share = min(1.0, 2 * rows / max(1, counts.get(toxic, 0)))
        small = F.pmod("order", F.lit(1 << 40))
        near = drawn.filter(((F.col("toxic") != 0) == F.lit(toxic)) & (small < int(share * (1 << 40))))
        return near.orderBy(small, "doc_id").limit(rows)

    parts = [least(True, TOXIC_ROWS), least(False, CLEAN_ROWS)]
    # equal rows are drawn by number: one row a text, and how often it was drawn
    picked = parts[0].unionByName(parts[1]).groupBy("doc_id", "order").agg(F.max("toxic").alias("toxic"), F.count("*").alias("times"))
    texts = text_rows(docs).withColumn("order", F.xxhash64("doc_id", "text"))
    # at most as many as the sample, once the copies of a row have met
    sample = texts.join(F.broadcast(picked), ["doc_id", "order"]).dropDuplicates(["doc_id", "order"])
    sample = sample.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return sample.orderBy("toxic", "order", "doc_id").select("text", (F.col("toxic") != 0).cast("int").alias("toxic"))


def learn_model(docs: DataFrame, labels: DataFrame, learn: Column) -> Machine:
    rows = training_rows(docs, labels, learn).toArrow()
    if not len(rows):
        return fit(pa.array([], pa.string()), np.empty(0, np.int64))
    rows = rows.combine_chunks()
    return fit(rows.column("text").chunk(0), rows.column("toxic").to_numpy().astype(np.int64))


def _score_batches(model):
    def run(batches):
        machine = model.value
        for batch in batches:
            yield batch.drop_columns(["text"]).append_column("score", pa.array(machine.scores(batch.column("text"))))

    return run


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """``(doc_id, score)`` of every row."""
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(machine)  # of the size that TERM_BITS gives
    rows = text_rows(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(_score_batches(model), "doc_id long, score double")


def _keep_batches(model, least: float):
    def run(batches):
        machine = model.value
        for batch in batches:
            text = pc.fill_null(batch.column("text"), "")
            yield batch.filter(pa.array(machine.scores(text) < least))

    return run


def filter_documents(docs: DataFrame, machine: Machine, least: float = 0.5) -> DataFrame:
    """The rows that score below ``least``, all columns as they are."""
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(machine)
    return docs.mapInArrow(_keep_batches(model, least), docs.schema)


def not_held_out() -> Column:
    return crc_bucket(F.col("doc_id"), HELD_OUT_MODULUS) != 0


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents; learned without the fifth that the checksum holds out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return scored(docs, learn_model(docs, labels, not_held_out())).select(
        "doc_id",
        (~not_held_out()).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


QUERIES = {"op4_toxicity": op4_toxicity}
