"""Ranked lexical search by dense blocked matrix products.

The query items are dealt into chunks of a bounded number of (item, term) entries; each chunk
is one search over all documents. Documents are read once per chunk and keep, as postings,
how often each of the chunk's terms stands in them; corpus statistics come from the postings
of all documents. A task then takes tiles of documents against tiles of items: the terms
of an item tile, numbered densely, give a matrix of weights (items x terms) and a matrix of
impacts (terms x documents), multiplied in float64 a block of terms at a time. Weights and
impacts are whole numbers whose block sums stay below 2**53, so that products are exact;
blocks are added as integers. Of each tile every document with at least the k-th score
stays, so ties are never cut; they are settled by ``doc_id`` when tiles and tasks are merged.

Score of a document: the sum over the item's distinct terms of
``weight * (10**9 * tf div (1000 * tf + 8 * m))`` with
``weight = floor(1000 * ln((2N + 2) / (2 df + 1)))`` and ``m = 10 + (90 * n * N) div L``.

Defined results: a null or empty text has no term and is never found; rows of one ``item_id``
(null among them) are one item with the terms of all; items without a term have no
result; repeated documents are found each, in ranks of their own; a null ``doc_id`` comes
last among equal scores; empty tables give an empty one; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evalflow.llm.common import ship, text_rows, written
from evalflow.llm.terms import NOT_ALNUM, looked_up, slices, words

TOP = 10
#: (item, term) entries of a chunk: what the driver and every task hold of the items.
CHUNK_ENTRIES = 1 << 18
#: Sides of the tiles.
ITEM_TILE, TERM_TILE, DOC_TILE = 256, 2048, 1024
#: The largest impact, 10**9 * tf / (1000 * tf), and the bound of exact sums in float64.
_IMPACT, _EXACT = 10**6, 2**53


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            found = words(part.column("text"), NOT_ALNUM)
            pairs = np.unique(np.stack([found.text.astype(np.uint64), found.keys]), axis=1)
            item = part.column("item_id").take(pa.array(pairs[0].astype(np.int64)))
            yield pa.RecordBatch.from_arrays([item, pa.array(pairs[1].view(np.int64))], ["item_id", "term"])


def item_terms(items: DataFrame) -> DataFrame:
    """``(item_id, term)``: the distinct terms of each item, by key."""
    kind = items.schema["item_id"].dataType.simpleString()
    return text_rows(items, ("item_id",)).mapInArrow(_term_batches, f"item_id {kind}, term long").distinct()


def chunks(entries: DataFrame, most: int) -> Iterator[DataFrame]:
    """The entries dealt by item into parts of ``most`` at most; an item is never cut."""
    hashed = F.xxhash64("item_id")
    modulus = max(1, -(-2 * entries.count() // most))
    sizes = entries.groupBy(F.pmod(hashed, F.lit(modulus)).alias("part"))
    waiting = [(r["part"], modulus, r["n"], r["items"]) for r in _sized(sizes)]
    while waiting:
        part, modulus, n, items = waiting.pop()
        mine = entries.filter(F.pmod(hashed, F.lit(modulus)) == part)
        if n <= most or items == 1:
            yield mine
        else:
            halves = mine.groupBy(F.pmod(hashed, F.lit(2 * modulus)).alias("part"))
            waiting += [(r["part"], 2 * modulus, r["n"], r["items"]) for r in _sized(halves)]


def _sized(groups) -> list:
    return groups.agg(F.count("*").alias("n"), F.countDistinct(F.struct("item_id")).alias("items")).collect()


def _postings(known: np.ndarray):
    """Of each document: its length in terms, and the known terms it holds with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = words(part.column("text"), NOT_ALNUM)
                at = looked_up(found.keys, known)
                hit = at >= 0
                pair, count = np.unique(found.text[hit] * max(1, len(known)) + at[hit], return_counts=True)
                text, term = pair // max(1, len(known)), pair % max(1, len(known))
                begin = pa.array(np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(found.first)),
                        pa.ListArray.from_arrays(begin, pa.array(term.astype(np.int32))),
                        pa.ListArray.from_arrays(begin, pa.array(count)),
                    ],
                    ["doc_id", "n", "terms", "counts"],
                )

    return run


@dataclass(frozen=True)
class ItemTile:
    """Items of a tile by number, and their entries over the tile's own terms."""

    first: int
    count: int
    terms: np.ndarray  # the chunk's term of each local one, in order
    item: np.ndarray
    local: np.ndarray


def item_tiles(item: np.ndarray, term: np.ndarray, count: int) -> list[ItemTile]:
    order = np.argsort(item, kind="stable")
    item, term = item[order], term[order]
    tiles = []
    for first in range(0, count, ITEM_TILE):
        a, b = np.searchsorted(item, [first, first + ITEM_TILE])
        own, local = np.unique(term[a:b], return_inverse=True)
        tiles.append(ItemTile(first, min(ITEM_TILE, count - first), own, item[a:b] - first, local))
    return tiles


def length_share(n: np.ndarray, total_docs: int, total_terms: int) -> np.ndarray:
    """``10 + (90 * n * N) div L``, past 64 bits where need be."""
    if len(n) and 90 * int(n.max()) * total_docs >= 2**63:
        return np.array([10 + 90 * x * total_docs // total_terms for x in n.tolist()], np.int64)
    return 10 + 90 * n * total_docs // total_terms


def tile_scores(tile: ItemTile, weight: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int):
    """Scores (items x documents) of one tile of items and one of documents, exact."""
    at = looked_up(term, tile.terms)
    known = at >= 0
    at, doc, impact = at[known], doc[known], impact[known]
    scores = np.zeros((tile.count, docs), np.int64)
    for first in range(0, len(tile.terms), TERM_TILE):
        width = min(TERM_TILE, len(tile.terms) - first)
        here, mine = (at >= first) & (at < first + width), (tile.local >= first) & (tile.local < first + width)
        impacts = np.zeros((width, docs))
        impacts[at[here] - first, doc[here]] = impact[here]
        weights = np.zeros((tile.count, width))
        weights[tile.item[mine], tile.local[mine] - first] = weight[tile.terms[tile.local[mine]]]
        scores += (weights @ impacts).astype(np.int64)
    return scores


class Best:
    """The k best documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        none = np.empty(0, np.int64)
        self.rows = (none, none, np.empty(0, bool), none)

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """Take in a tile of scores of the items from ``first`` on."""
        bound = self.least[first : first + len(scores)]
        if scores.shape[1] > self.k:
            bound = np.maximum(bound, np.partition(scores, -self.k, axis=1)[:, -self.k])
        item, doc = np.nonzero(scores >= bound[:, None])
        new = (item + first, scores[item, doc], null[doc], ids[doc])
        item, score, null, ids = (np.concatenate(pair) for pair in zip(self.rows, new))
        order = np.lexsort((ids, null, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        order = order[rank < self.k]
        item = item[rank < self.k]
        self.rows = (item, score[order], null[order], ids[order])
        full = rank[rank < self.k] == self.k - 1
        self.least[item[full]] = self.rows[1][full]


def _search(tiles: list[ItemTile], weight: np.ndarray, names: pa.Array, total: tuple[int, int], k: int):
    if len(weight) and int(weight.max()) * _IMPACT * TERM_TILE >= _EXACT:
        raise ValueError("weights too large for exact products; take a smaller TERM_TILE")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(names), k)
        for batch in batches:
            for at in range(0, batch.num_rows, DOC_TILE):
                part = batch.slice(at, DOC_TILE)
                terms, counts = part.column("terms"), part.column("counts")
                doc = np.repeat(np.arange(part.num_rows), np.diff(terms.offsets.to_numpy()))
                tf = counts.flatten().to_numpy()
                share = length_share(part.column("n").to_numpy(), *total)[doc]
                impact = 1_000_000_000 * tf // (1000 * tf + 8 * share)
                ids = part.column("doc_id")
                null = np.asarray(ids.is_null())
                ids = ids.fill_null(0).to_numpy()
                for tile in tiles:
                    scores = tile_scores(tile, weight, doc, terms.flatten().to_numpy(), impact, part.num_rows)
                    best.add(tile.first, scores, ids, null)
        item, score, null, ids = best.rows
        yield pa.RecordBatch.from_arrays(
            [names.take(pa.array(item)), pa.array(ids, mask=null), pa.array(score)], ["item_id", "doc_id", "score"]
        )

    return run


def _search_chunk(docs: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    mine = entries.toArrow().combine_chunks()  # bounded by the chunk
    names = mine.column("item_id").combine_chunks().dictionary_encode("encode")
    term_keys = mine.column("term").to_numpy().view(np.uint64)
    known, term = np.unique(term_keys, return_inverse=True)
    tiles = item_tiles(names.indices.to_numpy(), term, len(names.dictionary))
    posted = written(
        docs.mapInArrow(_postings(known), "doc_id long, n long, terms array<int>, counts array<long>"), "postings"
    )
    corpus = posted.agg(F.count_if(F.col("n") > 0).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
    held = np.zeros(len(known), np.int64)
    for row in posted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        held[row["term"]] = row["count"]
    weight = np.array([math.floor(1000 * math.log((2 * corpus["N"] + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)
    kind = entries.schema["item_id"].dataType.simpleString()
    search = _search(tiles, weight, names.dictionary, (corpus["N"], max(1, corpus["L"])), k)
    found = posted.filter(F.size("terms") > 0).mapInArrow(search, f"item_id {kind}, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP, most: int = CHUNK_ENTRIES) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of each item.

    ``docs`` needs ``doc_id`` (a whole number) and ``text``, ``items`` ``item_id`` and ``text``.
    """
    spark = docs.sparkSession
    ship(spark)
    entries = written(item_terms(items), "item-terms")
    texts = text_rows(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    out = None
    for chunk in chunks(entries, most):
        found = _search_chunk(texts, chunk, k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        kind = entries.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return out


def op12_ranked_search(spark, sf_dir: str) -> DataFrame:
    """The ten best documents of the whole table for each benchmark item."""
    return ranked_search(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"),
    )


_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

SQL = {
    "op12_ranked_search": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
len AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM d WHERE len(w) > 0),
g AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM len),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
tf AS (
  SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS t FROM d)
  WHERE t IN (SELECT t FROM q) GROUP BY ALL),
wt AS (
  SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, g GROUP BY t, docs),
s AS (
  SELECT q.item_id, tf.r, sum(wt.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
  FROM q JOIN tf ON q.t = tf.t JOIN wt ON wt.t = tf.t JOIN len ON len.r = tf.r, g GROUP BY ALL),
k AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
  FROM s JOIN len ON s.r = len.r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10""",
}
QUERIES = {"op12_ranked_search": op12_ranked_search}
