"""Token files: ids under a static range asymmetric numeral system with shared tables.

Ids are written in ascending order of the document. A *block* holds the ids of whole
documents, about ``BLOCK_TOKENS`` of them, and is coded by itself: its tokens are dealt over
``LANES`` interleaved coders that share one stream of 32-bit words. All blocks use the same
frequency table, counted over every id of the corpus and scaled to ``2**SCALE_BITS``; it
stands in the folder once. A file ends with an index of its blocks: the place of each, its
length, how many tokens, and checksums of the coded bytes and of the ids. Each entry is a
checkpoint: blocks are decoded in any order, by any task.

A file::

    "EFT1" | blocks | index (JSON, zlib) | length of the index, 4 bytes | "EFT1"
    block: documents (8-byte ids, 8-byte counts) | lane states (8 bytes each) | words (4 bytes each)

all little-endian; ``tables.bin`` holds the scaled frequency of each id, 4 bytes each.

Defined results: a null or empty text has the end id alone; rows with one id follow
each other by text, a null id comes first; an empty table gives no file and no rows; other
columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evalflow.llm.bpe import PLAIN, ChunkTable, MergeRules, slices
from evalflow.llm.common import by_id, fresh_folder, partitions, ship, text_rows, written
from evalflow.llm.files import Reader, Writer

MAGIC = b"EFT1"
END_ID = 0
BLOCK_TOKENS = 1 << 16
LANES = 1024
SCALE_BITS = 20

_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_SCALE = np.uint64(SCALE_BITS)


# Fixed value: the pattern that byte-level vocabularies cut texts by.
_PRETOKENS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
).findall


class ByteEncoder:
    """Ids as the tokenizers library gives them, from a table of the chunks between single blanks.

    No token crosses a blank between two other characters: it can only begin one. Texts
    with blanks beside other white space, with special tokens, or with letters beyond
    Latin go through the library as a whole.
    """

    _beside = re.compile(r" \s|\s ").search

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        self.vocabulary = self._library.get_vocab_size(with_added_tokens=True)
        rules = MergeRules(model["vocab"], model["merges"])
        self._table = ChunkTable(rules, self._words, blank=True)

    def _words(self, chunk: bytes) -> list[bytes]:
        return [w.encode() for w in _PRETOKENS(chunk.decode())]

    def _encode_plain(self, texts: list[bytes]) -> list[bytes]:
        data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.r_[0, np.cumsum(sizes)]
        opens = data == 32
        opens[begin[:-1][sizes > 0]] = True
        starts = np.flatnonzero(opens)
        ends = np.r_[starts[1:], len(data)]
        return self._table.encode(data, starts, ends, np.searchsorted(starts, begin))

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [PLAIN(t) is not None and self._beside(t) is None and "<|" not in t for t in texts]
        found = iter(self._encode_plain([t.encode() for t, p in zip(texts, plain) if p]))
        whole = self._library.encode_batch_fast([t for t, p in zip(texts, plain) if not p], add_special_tokens=False)
        rest = iter([np.array(e.ids, "<u4").tobytes() for e in whole])
        return [next(found) if p else next(rest) for p in plain]


_encoders: dict[str, ByteEncoder] = {}


def byte_encoder(path: str) -> ByteEncoder:
    if path not in _encoders:
        _encoders[path] = ByteEncoder(path)
    return _encoders[path]


def byte_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# -- coding of blocks -------------------------------------------------------------------


def scaled(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Frequencies that sum to ``2**bits``, at least one for every id that occurs."""
    total, goal = int(counts.sum()), 1 << bits
    if (counts > 0).sum() > goal:
        raise ValueError("more ids than the scale has room for")
    if not total:
        return np.zeros(len(counts), np.uint32)
    out = np.where(counts > 0, np.maximum(1, np.floor(counts * (goal / total))), 0).astype(np.int64)
    over = int(out.sum()) - goal
    for i in np.argsort(-out, kind="stable"):
        if over <= 0:
            break
        take = min(over, int(out[i]) - 1)
        out[i] -= take
        over -= take
    out[int(np.argmax(out))] -= over
    return out.astype(np.uint32)


class Tables:
    """What coding needs of the frequencies."""

    def __init__(self, frequency: np.ndarray):
        self.frequency = frequency.astype(np.uint64)
        self.begin = np.r_[0, np.cumsum(self.frequency)[:-1]].astype(np.uint64)
        self.most = self.frequency << np.uint64(63 - SCALE_BITS)
        self._symbol: np.ndarray | None = None

    @property
    def symbol(self) -> np.ndarray:
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.frequency), dtype=np.uint32), self.frequency.astype(np.int64))
        return self._symbol


def encode_block(ids: np.ndarray, tables: Tables, lanes: int = LANES) -> tuple[np.ndarray, np.ndarray]:
    """Final states and the shared words. The last row of lanes is filled up with the last id."""
    rows = -(-len(ids) // lanes)
    grid = np.r_[ids, np.full(rows * lanes - len(ids), ids[-1], ids.dtype)].reshape(rows, lanes)
    state = np.full(lanes, _LOW, np.uint64)
    words: list[np.ndarray] = []
    for row in grid[::-1]:
        full = state >= tables.most[row]
        if full.any():
            words.append(state[full].astype(np.uint32))
            state[full] >>= _WORD
        else:
            words.append(np.empty(0, np.uint32))
        share = tables.frequency[row]
        quotient, remainder = np.divmod(state, share)
        state = (quotient << _SCALE) + remainder + tables.begin[row]
    return state, np.concatenate(words[::-1])


def decode_block(state: np.ndarray, words: np.ndarray, count: int, tables: Tables) -> np.ndarray:
    lanes = len(state)
    state = state.copy()
    out = np.empty((-(-count // lanes), lanes), np.uint32)
    mask, at = np.uint64((1 << SCALE_BITS) - 1), 0
    words = words.astype(np.uint64)
    for row in out:
        slot = state & mask
        row[:] = tables.symbol[slot]
        state = tables.frequency[row] * (state >> _SCALE) + slot - tables.begin[row]
        need = np.flatnonzero(state < _LOW)
        if len(need):
            state[need] = state[need] << _WORD | words[at : at + len(need)]
            at += len(need)
    return out.reshape(-1)[:count]


# -- blocks of ids ------------------------------------------------------------------------

_BLOCK = pa.schema(
    [("place", pa.int64()), ("block", pa.int64()), ("docs", pa.binary()), ("counts", pa.binary()), ("ids", pa.binary())]
)
_BLOCK_SQL = "place long, block long, docs binary, counts binary, ids binary"
_NULL_ID = -(2**63)


def _blocks(path: str, end_id: int, block_tokens: int):
    """Blocks of ids from rows in order; ``place`` is the range the task has."""

    def run(batches):
        place, block = TaskContext.get().partitionId(), 0
        encoder = byte_encoder(path)
        kind = "<u2" if encoder.vocabulary <= 65536 else "<u4"
        end = np.array([end_id], "<u4").tobytes()
        docs: list[int] = []
        held: list[bytes] = []
        size = 0

        def take() -> pa.RecordBatch:
            counts = np.array([len(x) // 4 for x in held], "<i8")
            ids = np.frombuffer(b"".join(held), "<u4").astype(kind)
            row = (place, block, np.array(docs, "<i8").tobytes(), counts.tobytes(), ids.tobytes())
            docs.clear()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCK)], schema=_BLOCK)

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for first, texts in slices(batch.column("text")):
                for doc, ids in zip(names[first:], encoder.encode(texts)):
                    docs.append(_NULL_ID if doc is None else doc)
                    held.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= block_tokens:
                        yield take()
                        block, size = block + 1, 0
        if docs:
            yield take()

    return run


def _count(vocabulary: int, kind: str):
    def run(batches):
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                total += np.bincount(np.frombuffer(ids.as_buffer(), kind), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    return run


def frequencies(blocks: DataFrame, vocabulary: int) -> np.ndarray:
    """Scaled frequency of every id over all blocks; the driver gets one row per id of the vocabulary."""
    kind = "<u2" if vocabulary <= 65536 else "<u4"
    rows = blocks.select("ids").mapInArrow(_count(vocabulary, kind), "id long, n long").groupBy("id").agg(F.sum("n"))
    counts = np.zeros(vocabulary, np.int64)
    for i, n in rows.collect():
        counts[i] = n
    return scaled(counts)


def _write_files(folder: str, frequency: np.ndarray, kind: str):
    def run(batches):
        tables = Tables(frequency)
        out, index, key = None, [], None

        def close():
            data = zlib.compress(json.dumps(index).encode())
            out.write(data + len(data).to_bytes(4, "little") + MAGIC)
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{key[0]:08d}-{key[1]:010d}.eft"])], ["path"])

        for batch in batches:
            for place, block, docs, counts, ids in zip(*(batch.column(f.name).to_pylist() for f in _BLOCK)):
                if out is not None and (place, block) != (index[-1]["place"], index[-1]["block"] + 1):
                    yield close()
                    out = None
                if out is None:
                    key, index = (place, block), []
                    out = Writer(f"{folder}/{place:08d}-{block:010d}.eft")
                    out.write(MAGIC)
                tokens = np.frombuffer(ids, kind)
                state, words = encode_block(tokens.astype(np.int64), tables)
                data = docs + counts + state.astype("<u8").tobytes() + words.astype("<u4").tobytes()
                index.append(
                    {
                        "place": place,
                        "block": block,
                        "at": out.write(data),
                        "length": len(data),
                        "docs": len(docs) // 8,
                        "tokens": len(tokens),
                        "lanes": LANES,
                        "crc": zlib.crc32(data),
                        "ids_crc": zlib.crc32(tokens.astype("<u4").tobytes()),
                    }
                )
        if out is not None:
            yield close()

    return run


def write_token_files(
    docs: DataFrame, folder: str, path: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """Writes the files of a corpus and ``tables.bin`` to ``folder``; gives their paths."""
    spark = docs.sparkSession
    ship(spark)
    rows = text_rows(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    ordered = rows.repartitionByRange(partitions(spark), *by_id(rows)).sortWithinPartitions("doc_id", "text")
    blocks = written(ordered.mapInArrow(_blocks(path, end_id, block_tokens), _BLOCK_SQL), "blocks")
    vocabulary = byte_encoder(path).vocabulary
    frequency = frequencies(blocks, vocabulary)
    table = Writer(f"{folder}/tables.bin")
    table.write(frequency.astype("<u4").tobytes())
    table.close()
    kind = "<u2" if vocabulary <= 65536 else "<u4"
    return written(blocks.mapInArrow(_write_files(folder, frequency, kind), "path string"), "files")


_ENTRY_SQL = (
    "path string, place long, block long, at long, length long, docs long, tokens long, lanes long, crc long, ids_crc long"
)


def _read_index(batches):
    for batch in batches:
        for path in batch.column("path").to_pylist():
            file = Reader(path)
            tail = file.read(file.size - 8, 8)
            if tail[4:] != MAGIC or file.read(0, 4) != MAGIC:
                raise ValueError(f"{path}: not a token file")
            length = int.from_bytes(tail[:4], "little")
            entries = json.loads(zlib.decompress(file.read(file.size - 8 - length, length)))
            file.close()
            yield pa.RecordBatch.from_pylist([{"path": path} | e for e in entries])


_DOC = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
    ]
)
_DOC_SQL = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


def _decode(tables_path: str, with_ids: bool):
    def run(batches):
        file = Reader(tables_path)
        tables = Tables(np.frombuffer(file.read(0, file.size), "<u4"))
        file.close()
        for batch in batches:
            for e in batch.to_pylist():
                file = Reader(e["path"])
                data = file.read(e["at"], e["length"])
                file.close()
                if zlib.crc32(data) != e["crc"]:
                    raise ValueError(f"{e['path']}: block {e['block']} is damaged")
                n, lanes = e["docs"], e["lanes"]
                docs, counts = np.frombuffer(data, "<i8", 2 * n).reshape(2, n)
                state = np.frombuffer(data, "<u8", lanes, 16 * n)
                words = np.frombuffer(data, "<u4", offset=16 * n + 8 * lanes)
                ids = decode_block(state, words, e["tokens"], tables).astype("<u4").tobytes()
                if zlib.crc32(ids) != e["ids_crc"]:
                    raise ValueError(f"{e['path']}: block {e['block']} decodes to other ids")
                ends = np.cumsum(counts)
                begin = ends - counts
                parts = [ids[4 * a : 4 * b] for a, b in zip(begin.tolist(), ends.tolist())]
                columns = [
                    pa.array([None if d == _NULL_ID else d for d in docs.tolist()], pa.int64()),
                    begin + e["block_start"],
                    counts,
                    [zlib.crc32(p) for p in parts],
                    parts if with_ids else [None] * n,
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _DOC)], schema=_DOC)

    return run


def read_token_files(files: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """Documents of the files ``path``, in their order: ``start`` counts all ids before."""
    spark = files.sparkSession
    ship(spark)
    entries = written(files.mapInArrow(_read_index, _ENTRY_SQL), "index")
    places = entries.groupBy("place").agg(F.sum("tokens").alias("tokens"))
    places = places.select(
        "place", F.coalesce(F.sum("tokens").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base")
    )  # one row per range of documents
    starts = (
        entries.withColumn(
            "within",
            F.coalesce(
                F.sum("tokens").over(
                    Window.partitionBy("place").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .join(places, "place")
        .withColumn("block_start", F.col("base") + F.col("within"))
    )
    found = starts.repartition(partitions(spark), "path", "block").mapInArrow(
        _decode(f"{folder}/tables.bin", with_ids), _DOC_SQL
    )
    return found if with_ids else found.drop("ids")


def op8_token_files(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    """All documents written to token files and read back: place, length and checksum of each."""
    folder = fresh_folder(spark, "tokens")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_token_files(write_token_files(docs, folder, path or byte_vocabulary()), folder)


QUERIES = {"op8_token_files": op8_token_files}
