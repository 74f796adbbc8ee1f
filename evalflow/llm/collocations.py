"""Collocations by Toivonen's method: sample, negative border, expansion until closed.

Texts are cut at punctuation and line ends into pieces and those at blanks into words; a phrase
is a run of one to ``LONGEST`` words within a piece, and is frequent when it stands at least
``least`` times among the documents of its language.

1. *Encode.* Each task writes blocks of words: a block's distinct words, and its pieces as
   numbers of those words. Later passes read blocks, not texts.
2. *Sample.* Pieces drawn by hash, ``sample_words`` words in expectation, propose the words and
   pairs found in them (the threshold of so small a sample is one occurrence).
3. *Full pass.* Over all blocks, every word is counted, and every longer phrase whose two
   shorter parts (without its first, without its last word) are both proposed: these are the
   proposed phrases and the negative border, as far as they occur at all.
4. *Expansion.* Frequent phrases that were not proposed are border failures. They join the
   proposed ones, and a further pass counts the phrases that come into reach by
   them and were not counted before; until no failure is left. Every frequent phrase
   is then counted, exactly, whatever the sample was.

Proposed phrases are held as a bit map of fixed size, which every task gets; a false hit
only makes a pass count a phrase too many. Counts are added up within a block, then by ranges of
the phrase's 64-bit key, so a phrase in a third of all rows is one entry per block. For every
frequent phrase one of its blocks is asked for its text and parts.

Defined results: a null or empty text has no words; a null language is ``und``; repeated rows
count again; equal scores go by count, then by the bytes of the phrase; an empty table gives an
empty one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evalflow.llm.common import ship, written
from evalflow.llm.hashing import binary_array, gathered, lowered, mix
from evalflow.llm.terms import byte_set, slices, words

LONGEST, LEAST, INSIDE_PERCENT, TOP = 3, 10, 50, 2000
SAMPLE_WORDS = 4_000_000
#: Bytes of text a block holds, words whose phrases are added up in one task, bits of a map.
BLOCK_BYTES, PART_WORDS, MAP_BITS = 6 << 20, 1_000_000, 1 << 26
NO_LANGUAGE = "und"

_BREAK = byte_set((0x0A, 0x0D))
_BREAK[list(b".,;:!?")] = True
_GAP = _BREAK | byte_set((0x20, 0x20), (0x09, 0x09))
_STEP = np.uint64(0x9E3779B97F4A7C15)


# -- blocks


def _keys(lang: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of a word in its language."""
    return mix(word * _STEP + lang)


def _lang_key(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


class _Block:
    """Words of some texts, gathered until there are enough for a row."""

    def __init__(self):
        self.size, self.parts = 0, []

    def add(self, part: pa.RecordBatch) -> None:
        found = words(part.column("text"), _GAP)
        langs = part.column("lang").dictionary_encode()
        lang_keys = np.array([_lang_key(x) for x in langs.dictionary.to_pylist()], np.uint64)
        lang = langs.indices.to_numpy()[found.text]
        key = _keys(lang_keys[lang], found.keys)
        breaks = np.r_[0, np.cumsum(_BREAK[found.data])][found.starts]
        fresh = (breaks[1:] != breaks[:-1]) | (found.text[1:] != found.text[:-1])
        own, first, at = np.unique(key, return_index=True, return_inverse=True)
        flat, begin = gathered(found.data, found.starts[first], found.ends[first] - found.starts[first])
        names = langs.dictionary.take(pa.array(lang[first]))
        self.parts.append((own, at, np.r_[True, fresh][: len(at)], lowered(flat), np.diff(begin), names))
        self.size += len(found.data)

    def row(self, number: int) -> tuple:
        keys = np.concatenate([p[0] for p in self.parts])
        own, first, same = np.unique(keys, return_index=True, return_inverse=True)
        shift = np.r_[0, np.cumsum([len(p[0]) for p in self.parts])]
        at = np.concatenate([same[p[1] + s] for p, s in zip(self.parts, shift)])
        starts = np.concatenate([p[2] for p in self.parts])
        sizes = np.concatenate([p[4] for p in self.parts])
        begin = np.r_[0, np.cumsum(sizes)]
        flat, _ = gathered(np.concatenate([p[3] for p in self.parts]), begin[first], sizes[first])
        names = pa.concat_arrays([p[5].cast(pa.string()) for p in self.parts]).take(pa.array(first)).dictionary_encode()
        counts = np.bincount(names.indices.to_numpy()[at], minlength=len(names.dictionary))
        self.size, self.parts = 0, []
        lang = names.indices.to_numpy().astype("<u4").tobytes()
        packed = [_packed(own.tobytes()), _packed(at.astype("<u4").reshape(-1, 1).view(np.uint8).T.tobytes()), np.packbits(starts).tobytes()]
        packed += [flat.tobytes(), _packed(sizes[first].astype("<u4").tobytes()), _packed(lang)]
        return (number, len(at), len(own), *packed, names.dictionary.to_pylist(), counts.tolist())


_BLOCK_SQL = (
    "block long, size long, distinct long, keys binary, places binary, starts binary, letters binary, lengths binary,"
    " langs binary, lang array<string>, lang_words array<long>"
)
_BLOCK = pa.schema(
    [("block", pa.int64()), ("size", pa.int64()), ("distinct", pa.int64())]
    + [(name, pa.binary()) for name in ("keys", "places", "starts", "letters", "lengths", "langs")]
    + [("lang", pa.list_(pa.string())), ("lang_words", pa.list_(pa.int64()))]
)


def _packed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], size, "zstd", asbytes=True), kind) if size else np.empty(0, kind)


def _encode(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number = _Block(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch):
                block.add(part)
                if block.size >= block_bytes:
                    yield _batch([block.row(number)], _BLOCK)
                    number += 1
        if block.parts:
            yield _batch([block.row(number)], _BLOCK)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The texts (``text``, ``lang``) as blocks of numbered words, written once."""
    rows = docs.select(
        F.coalesce(F.col("text"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang")
    )
    return written(rows.mapInArrow(_encode(block_bytes), _BLOCK_SQL), "phrase-blocks")


@dataclass(frozen=True)
class Phrases:
    """The runs of 1, 2 and 3 words of a block: keys by the word they begin at."""

    keys: list[np.ndarray]
    begin: list[np.ndarray]


def phrases(keys: np.ndarray, places: np.ndarray, starts: np.ndarray) -> Phrases:
    word = keys[places]
    found, begin = [word], [np.arange(len(word))]
    for _ in range(LONGEST - 1):
        at = begin[-1]
        # both parts stand, and the second does not begin a piece
        size = len(begin)
        on = at[at + size < len(word)]
        on = on[~starts[on + size]]
        shorter = np.zeros(len(word), np.uint64)
        shorter[at] = found[-1]
        found.append(mix(shorter[on] * _STEP + word[on + size]))
        begin.append(on)
    return Phrases(found, begin)


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys = _unpacked(row["keys"], np.uint64)
    places = _unpacked(row["places"], np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1)
    return keys, places, np.unpackbits(np.frombuffer(row["starts"], np.uint8), count=row["size"]).astype(bool)


# -- bit maps of proposed phrases


@dataclass(frozen=True)
class BitMap:
    """A set of keys that may hold more than it was given, never less."""

    bits: np.ndarray

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at = keys & np.uint64(len(self.bits) * 8 - 1)
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bit_map(keys: DataFrame, most: int = MAP_BITS) -> BitMap:
    """Map of the ``key`` column: a power of two of bits, 16 a key, ``most`` at most."""
    n = keys.count()
    size = 1 << max(10, min(most.bit_length() - 1, (16 * n).bit_length()))
    place = F.col("key").bitwiseAND(F.lit(size - 1))
    cells = (
        keys.select(F.shiftright(place, 6).alias("cell"), F.expr("shiftleft(1L, cast(key & 63 as int))").alias("bit"))
        .groupBy("cell")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()  # at most a row for each 64 bits of the map
    )
    bits = np.zeros(size // 64, np.int64)
    bits[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
    return BitMap(bits.view(np.uint8))


# -- counting

_ENTRIES = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("level", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_ENTRIES_SQL = "part int, block long, level int, keys binary, counts binary"
_COUNTED = pa.schema([("level", pa.int32()), ("key", pa.int64()), ("a", pa.int64()), ("block", pa.int64())])
_COUNTED_SQL = "level int, key long, a long, block long"


def _drawn(row: dict, starts: np.ndarray, rate: float) -> np.ndarray:
    """Words of the pieces that the sample takes."""
    piece = np.cumsum(starts) - 1
    seed = mix(np.array([row["block"]], np.uint64) * _STEP + np.uint64(1))
    order = mix(np.arange(piece[-1] + 1 if len(piece) else 0, dtype=np.uint64) * _STEP + seed)
    return (order < np.uint64(min(rate, 1) * (2**64 - 2**11)))[piece] if rate < 1 else np.ones(len(piece), bool)


def _wanted(found: Phrases, size: int, now: list[BitMap], before: list[BitMap] | None, rate: float | None, drawn) -> list[np.ndarray]:
    """Which runs of each length a pass counts."""
    if rate is not None:
        return [found.keys[k][drawn[found.begin[k]]] for k in range(LONGEST - 1)]
    out = [found.keys[0] if before is None else found.keys[0][:0]]
    for k in range(1, LONGEST):
        reach = []
        for maps in (now, before):
            if maps is not None:
                held = np.zeros(size + 1, bool)
                held[found.begin[k - 1]] = maps[k - 1].holds(found.keys[k - 1])
                reach.append(held[found.begin[k]] & held[found.begin[k] + 1])
        out.append(found.keys[k][reach[0] & ~reach[1] if before is not None else reach[0]])
    return out


def _tally(parts: int, now: Broadcast | None, before: Broadcast | None, rate: float | None):
    edges = [(p << 64) // parts for p in range(1, parts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, places, starts = _opened(row)
                found = phrases(keys, places, starts)
                drawn = _drawn(row, starts, rate) if rate is not None else None
                wanted = _wanted(found, len(places), now and now.value, before and before.value, rate, drawn)
                for level, mine in enumerate(wanted, 1):
                    mine, count = np.unique(mine, return_counts=True)
                    cut = np.r_[0, np.searchsorted(mine, np.array(edges, np.uint64)), len(mine)]
                    out = [
                        (part, row["block"], level, *_entries(mine[a:b], count[a:b]))
                        for part, (a, b) in enumerate(zip(cut.tolist(), cut[1:].tolist()))
                        if b > a
                    ]
                    if out:
                        yield _batch(out, _ENTRIES)

    return run


def _entries(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted keys as byte planes of their distances: the upper planes are nearly empty."""
    steps = np.diff(keys, prepend=np.uint64(0)).reshape(-1, 1).view(np.uint8).T
    return _packed(steps.tobytes()), _packed(counts.astype("<u4").reshape(-1, 1).view(np.uint8).T.tobytes())


def _restored(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps = _unpacked(keys, np.uint8).reshape(8, -1).T.copy().view(np.uint64).reshape(-1)
    return np.cumsum(steps, dtype=np.uint64), _unpacked(counts, np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1)


def _add_up(least: int):
    def run(table: pa.Table) -> pa.Table:
        out = []
        for level in range(1, LONGEST + 1):
            mine = table.filter(pc.equal(table.column("level"), level)).sort_by("block")
            if not mine.num_rows:
                continue
            pairs = [_restored(k, c) for k, c in zip(mine.column("keys").to_pylist(), mine.column("counts").to_pylist())]
            block = np.repeat(mine.column("block").to_numpy(), [len(k) for k, _ in pairs])
            keys, counts = np.concatenate([k for k, _ in pairs]), np.concatenate([c for _, c in pairs])
            del pairs
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            total = np.add.reduceat(counts[order].astype(np.int64), start)
            held = np.diff(np.r_[start, len(keys)])
            keep = total >= least
            start, total, held = start[keep], total[keep], held[keep]
            # any of its blocks, dealt evenly, tells what the phrase is
            asked = block[order[start + (mix(keys[start]) % held.astype(np.uint64)).astype(np.int64)]]
            columns = [np.full(len(start), level, np.int32), keys[start].view(np.int64), total, asked]
            out.append(pa.Table.from_arrays([pa.array(c) for c in columns], schema=_COUNTED))
        return pa.concat_tables(out)

    return run


def counted(
    table: DataFrame, total: int, least: int, now: Broadcast | None, before: Broadcast | None, rate: float | None = None
) -> DataFrame:
    """``(level, key, a, block)`` of the phrases a pass wants that stand ``least`` times."""
    parts = max(1, -(-total // PART_WORDS))
    rows = table.select("block", "size", "keys", "places", "starts")
    asked = rows.mapInArrow(_tally(parts, now, before, rate), _ENTRIES_SQL)
    return written(asked.groupBy("part").applyInArrow(_add_up(least), _COUNTED_SQL), "phrase-counts")


def _maps(spark: SparkSession, proposed: DataFrame) -> Broadcast:
    """Maps of the proposed words and pairs."""
    return spark.sparkContext.broadcast([bit_map(proposed.filter(F.col("level") == level)) for level in range(1, LONGEST)])


@dataclass(frozen=True)
class Mined:
    """Frequent phrases with their exact counts, and how many full passes it took."""

    table: DataFrame
    frequent: DataFrame
    passes: int


def mine(docs: DataFrame, least: int = LEAST, sample_words: int = SAMPLE_WORDS, block_bytes: int = BLOCK_BYTES) -> Mined:
    """All frequent phrases of one to three words, by key."""
    spark = docs.sparkSession
    ship(spark)
    table = blocks(docs, block_bytes)
    total = table.agg(F.sum("size")).first()[0] or 0
    rate = min(1.0, sample_words / max(1, total))
    proposed = counted(table, min(total, sample_words), 1, None, None, rate).select("level", "key")
    now, before, frequent, passes = _maps(spark, proposed), None, None, 0
    while True:
        new = counted(table, total, least, now, before)
        frequent = new if frequent is None else frequent.unionByName(new)
        passes += 1
        failed = new.filter(F.col("level") < LONGEST).select("level", "key").join(proposed, ["level", "key"], "left_anti")
        failed = written(failed, "border-failures")
        if failed.isEmpty():
            return Mined(table, frequent, passes)
        proposed = proposed.unionByName(failed)
        now, before = _maps(spark, proposed), now


# -- what the keys stand for

_TOLD = pa.schema(
    [("level", pa.int32()), ("key", pa.int64()), ("lang", pa.string()), ("phrase", pa.string()), ("parts", pa.list_(pa.int64()))]
)
_TOLD_SQL = "level int, key long, lang string, phrase string, parts array<long>"


def _tell(table: pa.Table, asked: pa.Table) -> pa.Table:
    """Language, words and parts of the phrases asked of a block."""
    if not table.num_rows or not asked.num_rows:
        return _TOLD.empty_table()
    row = table.slice(0, 1).to_pylist()[0]
    keys, places, starts = _opened(row)
    found = phrases(keys, places, starts)
    letters, lengths = np.frombuffer(row["letters"], np.uint8), _unpacked(row["lengths"], "<u4").astype(np.int64)
    begin, langs = np.r_[0, np.cumsum(lengths)], _unpacked(row["langs"], "<u4")
    by_start = []
    for k in range(LONGEST - 1):
        key = np.zeros(len(places), np.uint64)
        key[found.begin[k]] = found.keys[k]
        by_start.append(key)
    out = []
    for level in range(2, LONGEST + 1):
        mine = asked.filter(pc.equal(asked.column("level"), level)).column("key").to_numpy().view(np.uint64)
        if not len(mine):
            continue
        own, first = np.unique(found.keys[level - 1], return_index=True)
        at = found.begin[level - 1][first[np.searchsorted(own, mine)]]
        word = np.stack([places[at + k] for k in range(level)], axis=1).reshape(-1).astype(np.int64)
        size = lengths[word] + 1  # each word and a blank
        flat = np.full(int(size.sum()), 32, np.uint8)
        text, place = gathered(letters, begin[word], lengths[word])
        flat[np.arange(len(text)) + np.repeat(np.arange(len(word)), lengths[word])] = text
        ends = np.cumsum(size.reshape(-1, level).sum(axis=1))
        names = binary_array(flat, np.r_[0, ends]).cast(pa.string())
        parts = []  # first part and rest of every cut
        for k in range(1, level):
            parts += [by_start[k - 1][at], by_start[level - k - 1][at + k]]
        parts = np.stack(parts, axis=1).view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(mine) + 1, dtype=np.int32) * parts.shape[1]), pa.array(parts.reshape(-1)))
        lang = pa.array(row["lang"]).take(pa.array(langs[word.reshape(-1, level)[:, 0]]))
        columns = [pa.array(np.full(len(mine), level, np.int32)), pa.array(mine.view(np.int64)), lang, pc.utf8_rtrim(names, " "), lists]
        out.append(pa.Table.from_arrays(columns, schema=_TOLD))
    return pa.concat_tables(out) if out else _TOLD.empty_table()


def candidates(mined: Mined) -> tuple[DataFrame, DataFrame]:
    """``(level, key, lang, phrase, a, cuts)`` of the longer frequent phrases, ``cuts`` with the counts
    of both parts; and ``(level, key, lang, phrase, parts)``."""
    longer = mined.frequent.filter("level > 1")
    told = (
        mined.table.groupBy("block")
        .cogroup(longer.select("level", "key", "block").groupBy("block"))
        .applyInArrow(_tell, _TOLD_SQL)
    )
    told = written(told, "phrase-texts")
    halves = told.select("level", "key", F.posexplode("parts").alias("place", "part"))
    halves = halves.withColumn(
        "part_level",
        F.when(F.col("place") % 2 == 0, F.floor(F.col("place") / 2) + 1).otherwise(F.col("level") - F.floor(F.col("place") / 2) - 1).cast("int"),
    )
    counts = mined.frequent.select(F.col("level").alias("part_level"), F.col("key").alias("part"), F.col("a").alias("f"))
    cuts = (
        halves.join(counts, ["part_level", "part"])
        .groupBy("level", "key", F.floor(F.col("place") / 2).cast("int").alias("k"))
        .agg(F.max(F.when(F.col("place") % 2 == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("place") % 2 == 1, F.col("f"))).alias("r"))
    )
    cuts = cuts.groupBy("level", "key").agg(F.collect_list(F.struct("k", "l", "r")).alias("cuts"))
    return told.drop("parts").join(longer.select("level", "key", "a"), ["level", "key"]).join(cuts, ["level", "key"]), told


def collocations(
    docs: DataFrame, top: int = TOP, least: int = LEAST, sample_words: int = SAMPLE_WORDS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Each language's phrases of highest score (``text``, ``lang``)."""
    mined = mine(docs, least, sample_words, block_bytes)
    found, told = candidates(mined)
    scored = found.withColumn(
        "cut",
        F.expr(
            "array_min(transform(cuts, c -> struct("
            "(cast(a as decimal(19,0)) * cast(a as decimal(19,0)) * cast(1000000 as decimal(7,0)))"
            " div (cast(c.l as decimal(19,0)) * cast(c.r as decimal(19,0))) as score, c.k as k, c.l as l, c.r as r)))"
        ),
    )
    # a phrase of two words inside one of three that stands nearly as often
    inside = (
        told.filter(F.col("level") == LONGEST)
        .select("level", "key", F.explode("parts").alias("part"))
        .join(mined.frequent.select("level", "key", F.col("a").alias("longer")), ["level", "key"])
        .groupBy(F.col("part").alias("key"))
        .agg(F.max("longer").alias("longer"))
        .withColumn("level", F.lit(2))
    )
    kept = scored.join(inside, ["level", "key"], "left").filter(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(INSIDE_PERCENT) * F.col("a"))
    )
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = kept.select("lang", "phrase", "a", "cut").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    n = (
        mined.table.select(F.explode(F.arrays_zip("lang", "lang_words")).alias("x"))
        .groupBy(F.col("x.lang").alias("lang"))
        .agg(F.sum("x.lang_words").alias("n"))
    )
    return ranked.join(n, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").alias("score"),
    )


def op13_collocations(spark, sf_dir: str) -> DataFrame:
    """Collocations of every language over the whole table."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang"))


SQL = {
    "op13_collocations": r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_extract_all(t, '[^.,;:!?\x0A-\x0D]+')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
c AS (
  SELECT lang, unnest(w) AS x, unnest(w[2:]) AS y, unnest(w[3:]) AS z FROM w),
gram AS (
  SELECT lang, [x] AS g, 1 AS k FROM c WHERE x IS NOT NULL
  UNION ALL SELECT lang, [x, y], 2 FROM c WHERE y IS NOT NULL
  UNION ALL SELECT lang, [x, y, z], 3 FROM c WHERE z IS NOT NULL),
f AS MATERIALIZED (SELECT lang, g, k, count(*)::BIGINT AS a FROM gram GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
parts AS MATERIALIZED (
  SELECT lang, g, a, cut, g[1 : cut] AS head, g[cut + 1 :] AS tail FROM f, range(1, 3) x(cut) WHERE k > 1 AND cut < k),
cuts AS (
  SELECT p.lang, p.g, p.a, cut, l.a AS l, r.a AS r, 1000000::HUGEINT * p.a * p.a // (l.a::HUGEINT * r.a) AS score
  FROM parts p JOIN f l ON l.lang = p.lang AND l.g = p.head JOIN f r ON r.lang = p.lang AND r.g = p.tail),
best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, g[i : i + 1] AS g, max(a) AS longer FROM f, range(1, 3) x(i) WHERE k = 3 GROUP BY ALL),
kept AS (
  SELECT best.*, array_to_string(best.g, ' ') AS phrase FROM best LEFT JOIN longer ON best.lang = longer.lang AND best.g = longer.g
  WHERE longer IS NULL OR len(best.g) = 3 OR 100 * longer < 50 * a)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n,
       score::BIGINT AS score
FROM kept JOIN n ON kept.lang = n.lang
QUALIFY rank <= 2000""",
}
QUERIES = {"op13_collocations": op13_collocations}
