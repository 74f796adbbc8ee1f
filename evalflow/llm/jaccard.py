"""Similarity join of documents on word shingles: rare-first prefixes, verified once.

1. Document frequencies. Blocks of documents learn the frequency of each of their
   shingles in the whole table (`blocks`). A shingle of one document alone cannot be
   shared, so only those of frequency two or more are kept, rarest first; the others
   stand before them in the order as a mere number.
2. Prefixes. Two sets of size n and m with the similarity wanted share a shingle among the
   first ``n - ceil(0.75 n) + 1`` of each, rarest first. Documents whose prefix holds
   unshared shingles alone have no partner and leave here: most do.
3. Equal sets become one class, named by a hash of the set.
4. Groups. The classes whose prefix holds a shingle form its bucket; buckets with the same
   smallest class are joined to one group, so that a class travels about once
   although it stands in many buckets. A group with too many classes or shingles for a task
   is dealt into chunks, first each by itself, then every two chunks together.
5. In a group, pairs come from an index over prefix shingles and pass the length, positional
   and suffix filters; every such pair is verified exactly, once: in the group of the first prefix
   shingle it shares. A group gives how many documents each class links with, and the
   smallest class that these links connect it to, never its pairs.
6. Components over all groups (`components`), named by their smallest document.

Shingles are compared by 64-bit hash. Frequencies come by 48 bits of it, which only
affects the order and what is kept, not what is compared.

Defined results: documents without words have no shingles and link with nothing;
repeated rows are documents with equal sets, and rows of one id with different texts documents
of their own; a null id links like any other and is left out of the naming of components; an
empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalflow.llm import blocks
from evalflow.llm.common import ship, text_rows, unused, written
from evalflow.llm.components import components
from evalflow.llm.hashing import shingle_hashes

WORDS = 5
#: Least similarity, as a fraction of whole numbers: intersection / union >= 3 / 4.
NEED, OF = 3, 4
#: Classes of one group that are compared in one task, and shared shingles that they hold together.
CHUNK_CLASSES = 2000
CHUNK_SHINGLES = 4_000_000
#: Ranges of the hash by which the suffix filter counts.
_RANGES = 32
#: Partners of a class that are verified at a time.
_VERIFIED = 1024


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)


def _keys(words: int):
    def run(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        values, _ = shingle_hashes(_column(table, "text"), words)
        return np.unique(blocks.short(values), return_counts=True)

    return run


def prefix_size(n):
    """How many of the first shingles must hold a shared one."""
    return n - -(-n * NEED // OF) + 1


_DOCUMENT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("digest", pa.binary()),
        ("prefix", pa.int32()),
        ("shingles", pa.list_(pa.int64())),
    ]
)


def _shared(words: int):
    """Per document its size and, where it can have a partner, its shared shingles, rarest first."""

    def run(table: pa.Table, found: np.ndarray, totals: np.ndarray, _: int) -> pa.Table:
        ids = _column(table, "doc_id").to_pylist()
        values, begin = shingle_hashes(_column(table, "text"), words)
        frequency = totals[np.searchsorted(found, blocks.short(values))]
        rows = []
        for doc, a, b in zip(ids, begin.tolist(), begin[1:].tolist()):
            n, f = b - a, frequency[a:b]
            common = np.flatnonzero(f >= 2)
            prefix = prefix_size(n) - (n - len(common))
            if n == 0 or prefix <= 0:
                rows.append((doc, n, None, None, None))
                continue
            own = values[a:b]
            order = common[np.lexsort((own[common], f[common]))]
            digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
            rows.append((doc, n, digest, prefix, own[order].view(np.int64)))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _DOCUMENT)], schema=_DOCUMENT)

    return run


class _Group:
    """The classes of a group in one task."""

    def __init__(self, table: pa.Table):
        n = _column(table, "n").to_numpy()
        rep = _column(table, "rep").to_numpy()
        order = np.lexsort((rep, n))
        table = table.take(pa.array(order))
        self.copies = _column(table, "copies").to_numpy()
        self.n, self.rep = n[order], rep[order]
        lists = _column(table, "shingles")
        self.begin = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values.to_numpy()
        self.begin, flat = self.begin - self.begin[0], flat[self.begin[0] : self.begin[-1]]
        _, self.flat = np.unique(flat, return_inverse=True)
        self.prefix = _column(table, "prefix").to_numpy()
        self.side = _column(table, "side").to_numpy() if "side" in table.column_names else None
        self.component = np.arange(len(n))
        mine = _column(table, "mine")
        _, span = np.unique(np.r_[flat, mine.values.to_numpy()], return_inverse=True)
        self.here = np.zeros(span.max() + 1 if len(span) else 0, bool)
        self.here[span[len(flat) :]] = True
        # the group's own shingles are shingles of its classes, so both numberings agree
        size = np.diff(self.begin)
        self.alone = self.n - size
        owner = np.repeat(np.arange(len(size)), size)
        ranges = (flat.view(np.uint64) >> np.uint64(11)) % np.uint64(_RANGES)
        self.ranges = np.bincount(owner * _RANGES + ranges.astype(np.int64), minlength=len(size) * _RANGES)
        self.ranges = self.ranges.reshape(len(size), _RANGES).astype(np.int32)
        place = np.arange(len(flat)) - self.begin[owner]
        at = np.flatnonzero((place < self.prefix[owner]) & self.here[self.flat])
        at = at[np.argsort(self.flat[at], kind="stable")]
        self.post_doc, self.post_place = owner[at], place[at]
        self.post_begin = np.searchsorted(self.flat[at], np.arange(len(self.here) + 1))
        self.mark = np.zeros(len(self.here), bool)

    def shingles(self, x: int) -> np.ndarray:
        return self.flat[self.begin[x] : self.begin[x + 1]]

    def gather(self, docs: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first ``size`` shingles of each document in one array, and where each begins."""
        start = np.r_[0, np.cumsum(size)]
        at = np.arange(start[-1]) + np.repeat(self.begin[docs] - start[:-1], size)
        return self.flat[at], start

    def candidates(self, x: int) -> np.ndarray:
        """Smaller or equal classes that pass the filters, from the other chunk where there are two."""
        own = self.shingles(x)[: self.prefix[x]]
        places = np.flatnonzero(self.here[own])
        least = np.searchsorted(self.n, -(-self.n[x] * NEED // OF))  # length
        found, mine, theirs = [], [], []
        for p in places.tolist():
            a, b = self.post_begin[own[p]], self.post_begin[own[p] + 1]
            docs = self.post_doc[a:b]
            lo, hi = np.searchsorted(docs, (least, x))
            if hi > lo:
                found.append(docs[lo:hi])
                theirs.append(self.post_place[a + lo : a + hi])
                mine.append(np.full(hi - lo, p))
        if not found:
            return np.empty(0, np.int64)
        docs, first = np.unique(np.concatenate(found), return_index=True)
        mine, theirs = np.concatenate(mine)[first], np.concatenate(theirs)[first]
        ok = np.ones(len(docs), bool)
        if self.side is not None:
            ok = self.side[docs] != self.side[x]
        need = -(-NEED * (self.n[x] + self.n[docs]) // (NEED + OF))
        left = np.minimum(
            self.n[x] - self.alone[x] - mine, self.n[docs] - self.alone[docs] - theirs
        )  # from the shared one on
        ok &= left >= need  # positional
        docs, mine, need = docs[ok], mine[ok], need[ok]
        if len(docs):  # suffix: what ranges of the hash can share at most
            ok = np.minimum(self.ranges[docs], self.ranges[x]).sum(axis=1) >= need
            docs, mine = docs[ok], mine[ok]
        others = own[~self.here[own]]
        if len(docs) and len(others):  # a shared shingle further in front: another group's pair
            place_of = {int(s): p for p, s in enumerate(own.tolist()) if not self.here[s]}
            self.mark[others] = True
            flat, start = self.gather(docs, np.minimum(self.prefix[docs], np.diff(self.begin)[docs]))
            hits = np.flatnonzero(self.mark[flat])
            self.mark[others] = False
            if len(hits):
                which = np.searchsorted(start, hits, "right") - 1
                place = np.array([place_of[s] for s in flat[hits].tolist()])
                earlier = np.zeros(len(docs), bool)
                earlier[which[place < mine[which]]] = True
                docs = docs[~earlier]
        return docs

    def verified(self, x: int, docs: np.ndarray) -> np.ndarray:
        """Those of ``docs`` that are similar to ``x``."""
        own = self.shingles(x)
        self.mark[own] = True
        size = np.diff(self.begin)[docs]
        flat, start = self.gather(docs, size)
        sums = np.r_[0, np.cumsum(self.mark[flat])]
        common = sums[start[1:]] - sums[start[:-1]]
        self.mark[own] = False
        return docs[common * (NEED + OF) >= NEED * (self.n[x] + self.n[docs])]

    def linked(self) -> np.ndarray:
        """Of each class the copies of those similar to it; ``component`` holds what the links connect."""
        total = np.zeros(len(self.n), np.int64)
        for x in range(len(self.n)):
            docs = self.candidates(x)
            for at in range(0, len(docs), _VERIFIED):
                found = self.verified(x, docs[at : at + _VERIFIED])
                total[x] += self.copies[found].sum()
                total[found] += self.copies[x]
                met = np.unique(self.component[np.r_[found, x]])
                if len(met) > 1:
                    self.component[np.isin(self.component, met)] = met[0]
        return total

    def smallest(self) -> np.ndarray:
        """The smallest class of each one's component."""
        _, same = np.unique(self.component, return_inverse=True)
        least = np.full(len(self.n), np.iinfo(np.int64).max)
        np.minimum.at(least, same, self.rep)
        return least[same]


_LINKED_SQL = "rep long, linked long, low long"


def _link(table: pa.Table) -> pa.Table:
    group = _Group(table)
    linked = group.linked()
    return pa.Table.from_arrays([pa.array(group.rep), pa.array(linked), pa.array(group.smallest())], ["rep", "linked", "low"])


def document_sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Sizes of all documents; digest and shared shingles of those that can have a partner."""
    rows = text_rows(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    schema = "doc_id long, n long, digest binary, prefix int, shingles array<long>"
    found = blocks.with_totals(rows, blocks.sizes(rows), _keys(words), _shared(words), schema, least=2)
    return written(found, "sets")


def _dealt_groups(classes: DataFrame, chunk_classes: int, chunk_shingles: int) -> DataFrame:
    """The classes of each group, and the chunk of the group that each is dealt into."""
    ship(classes.sparkSession)
    posts = classes.select(
        "rep", F.size("shingles").alias("size"), F.explode(F.slice("shingles", F.lit(1), F.col("prefix"))).alias("shingle")
    )
    buckets = posts.groupBy("shingle").agg(F.min("rep").alias("leader"), F.count("*").alias("k")).filter("k > 1")
    members = (
        posts.join(buckets.drop("k"), "shingle")
        .groupBy("leader", "rep")
        .agg(F.first("size").alias("size"), F.collect_list("shingle").alias("mine"))
    )
    members = written(members, "groups")
    wanted = F.greatest(F.ceil(F.count("*") / chunk_classes), F.ceil(F.sum("size") / chunk_shingles))
    chunks = members.groupBy("leader").agg(F.least(wanted, F.count("*")).cast("int").alias("chunks"))
    return members.join(chunks, "leader").withColumn("side", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))


def class_links(classes: DataFrame, chunk_classes: int = CHUNK_CLASSES, chunk_shingles: int = CHUNK_SHINGLES) -> DataFrame:
    """``(rep, linked, low)`` of classes ``(rep, n, prefix, shingles, copies)``, a row for each task a class is in.

    ``linked`` counts the copies of other classes similar to it that were found there, ``low`` is the
    smallest class that links found there connect it to.
    """
    dealt = _dealt_groups(classes, chunk_classes, chunk_shingles)
    full = classes.select("rep", "n", "prefix", "shingles", "copies")
    alone = dealt.select("leader", F.col("side").alias("chunk"), "rep", "mine").join(full, "rep")
    inside = alone.groupBy("leader", "chunk").applyInArrow(_link, _LINKED_SQL)
    cells = (
        dealt.filter("chunks > 1")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .filter("other <> side")
        .withColumn("low", F.least("side", "other"))
        .withColumn("high", F.greatest("side", "other"))
        .select("leader", "low", "high", "rep", "mine", "side")
        .join(full, "rep")
        .groupBy("leader", "low", "high")
        .applyInArrow(_link, _LINKED_SQL)
    )
    return written(inside.unionByName(cells), "links")


def near_duplicates(
    docs: DataFrame, words: int = WORDS, chunk_classes: int = CHUNK_CLASSES, chunk_shingles: int = CHUNK_SHINGLES
) -> DataFrame:
    """Per row its set's size, the smallest document that links lead to, and with how many other rows it links."""
    sets = document_sets(docs, words)
    classes = written(
        sets.filter("digest is not null")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("least"),
            F.first("n").alias("n"),
            F.first("prefix").alias("prefix"),
            F.first("shingles").alias("shingles"),
            F.count("*").alias("copies"),
        )
        .withColumn("rep", F.xxhash64("digest")),
        "classes",
    )
    links = class_links(classes, chunk_classes, chunk_shingles)
    linked = links.groupBy("rep").agg(F.sum("linked").alias("linked"))
    found = written(components(links.filter("rep <> low"), "rep", "low"), "class-components")
    smallest = (
        classes.select("rep", "least")
        .join(found.withColumnRenamed("node", "rep"), "rep")
        .groupBy("component")
        .agg(F.min("least").alias("smallest"))
    )
    by_class = found.join(smallest, "component").select(F.col("node").alias("rep"), "smallest")
    named = (
        classes.select("digest", "rep", "least", "copies")
        .join(by_class, "rep", "left")
        .join(linked, "rep", "left")
        .select(
            "digest",
            F.coalesce("smallest", "least").alias("component"),
            (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    some = sets.filter("digest is not null").select("doc_id", "n", "digest").join(named, "digest", "left")
    rest = sets.filter("digest is null").select(
        "doc_id", "n", F.lit(None).cast("long").alias("component"), F.lit(0).cast("long").alias("n_links")
    )
    return some.select("doc_id", "n", "component", "n_links").unionByName(rest).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"), "n_links"
    )


def one_of_each(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One row of each component, all columns as they are: that of the smallest ``doc_id``.

    A row is told by its id and text: rows of one id with other texts are documents of their own,
    and rows that agree in both stay once. A null id comes after all others.
    """
    hashed = [F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit("")))]
    rows = docs.select("doc_id", F.xxhash64(*hashed).alias("row"))
    named = near_duplicates(docs.select(F.xxhash64(*hashed).alias("doc_id"), "text"), words)
    named = named.select(F.col("doc_id").alias("row"), "component_id").distinct()
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    first = rows.join(named, "row").groupBy("component_id").agg(F.min(order).alias("first"))
    row = unused("__row", docs.columns)
    kept = first.select(F.col("first.row").alias(row))
    return docs.withColumn(row, F.xxhash64(*hashed)).join(kept, row, "left_semi").dropDuplicates([row]).drop(row)


def op1_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components and link counts of all documents: five words, similarity 0.75."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


SQL = {
    "op1_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL),
e AS MATERIALIZED (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, m.y) AS component_id,
  coalesce(l.n_links, 0)::BIGINT AS n_links
FROM w LEFT JOIN n ON w.doc_id = n.doc_id
LEFT JOIN (SELECT x, min(y) AS y FROM r GROUP BY x) m ON w.doc_id = m.x
LEFT JOIN (SELECT x, count(*) AS n_links FROM e GROUP BY x) l ON w.doc_id = l.x""",
}
QUERIES = {"op1_ngram_jaccard_join": op1_ngram_jaccard_join}
