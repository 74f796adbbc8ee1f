"""BPE encoding and decoding by batched merge rounds over flat arrays.

The symbols of many words lie in one flat array. In a round every word merges its
pair of lowest rank, at all places where the pair stands (left to right where they
overlap); ranks come from a binary search over the sorted pair keys, and only pairs
beside a merge are looked up again. A merged symbol can only take part in pairs of
higher rank, since each symbol has one rule that makes it and the rule stands after
those of its parts; merging all places at once therefore gives what one merge at a
time gives. Rules that break this order are refused.

Texts are cut at spaces first: no token crosses one, so a chunk between spaces always
has the same ids. Chunks seen lately are kept with their ids (a bounded number, for
speed alone) under 64-bit hashes, so that whole batches are looked up and put together as arrays.

Defined results: a null or empty text has no ids and decodes to the empty text; equal
rows give equal rows; an empty table gives an empty one; only the named columns are
read. Ids are little-endian unsigned 32-bit integers in a binary column.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalflow.llm.common import ship, text_rows
from evalflow.llm.hashing import gathered, span_hashes

_NO_RANK = np.int32(2**31 - 1)

#: Chunks whose ids a worker keeps; beyond these it starts anew.
KEPT_CHUNKS = 2_000_000
KEPT_ODD = 200_000
#: Characters that are handled together.
BATCH_CHARS = 2_000_000

#: Printable characters up to Latin Extended-B: their case, composition and classes
#: have long been fixed. Texts with others go through the library's normalizer.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-ɏ]*").fullmatch

_BLANK = 32
_BLANKS = re.compile(r"[\t\n\r]")
_SPACE = np.isin(np.arange(256), [9, 10, 13, 32])
#: Marks that stand alone after a word.
_POINT = np.isin(np.arange(256), list(b".,;:!?|"))


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in printable}
    rest = [b for b in range(256) if b not in shown]
    return [shown[b] if b in shown else chr(256 + rest.index(b)) for b in range(256)]


class MergeRules:
    """Pair keys in order, with the rank and the result of each."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str = ""):
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.result = np.array([vocab[a + b] for a, b in pairs], np.int32)
        made = np.full(max(vocab.values()) + 1, -1, np.int64)
        made[self.result] = np.arange(len(pairs))
        rank = np.arange(len(pairs))
        if len(set(self.result.tolist())) < len(pairs) or (made[left] >= rank).any() or (made[right] >= rank).any():
            raise ValueError("each symbol needs one rule, after the rules of its parts")
        key = left << 32 | right
        order = np.argsort(key)
        self.keys, self.ranks = key[order], rank[order].astype(np.int32)
        signs = byte_symbols()
        self.inner = np.array([vocab[s] for s in signs], np.int32)
        self.last = np.array([vocab[s + suffix] for s in signs], np.int32)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NO_RANK)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as bytes; words are not empty."""
        data = np.frombuffer(b"".join(words), np.uint8)
        flat, counts = self.encode_flat(data, np.fromiter(map(len, words), np.int64, len(words)))
        ends = (4 * np.cumsum(counts)).tolist()
        data = flat.astype("<u4").tobytes()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def encode_flat(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that lie behind each other, and how many each word has."""
        if not len(lengths):
            return np.empty(0, np.int32), np.empty(0, np.int64)
        symbols = self.inner[data]
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.last[data[ends - 1]]
        word = np.repeat(np.arange(len(lengths)), lengths)
        rank = np.full(len(symbols), _NO_RANK, np.int32)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside] = self.rank_of(symbols[inside], symbols[inside + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[starts, len(word)])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            open_ = lowest != _NO_RANK
            if not open_.all():
                done.append((word[~open_], symbols[~open_]))
                word, symbols, rank, lowest = word[open_], symbols[open_], rank[open_], lowest[open_]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == lowest)
            new_run = np.r_[True, np.diff(at) != 1]
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            symbols[at] = self.result[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            place = at - np.arange(len(at))
            word, symbols, rank = word[keep], symbols[keep], rank[keep]
            for p in (place, place[place > 0] - 1):
                follows = (p + 1 < len(word)) & (word[np.minimum(p + 1, len(word) - 1)] == word[p])
                rank[p] = _NO_RANK
                p = p[follows]
                rank[p] = self.rank_of(symbols[p], symbols[p + 1])
        word = np.concatenate([w for w, _ in done])
        order = np.argsort(word, kind="stable")
        return np.concatenate([s for _, s in done])[order], np.bincount(word, minlength=len(lengths))


def _letters(data: np.ndarray) -> np.ndarray:
    """Marks the bytes of texts up to Latin Extended-B that belong to no letter."""
    odd = (data < 128) & ~(((data | 32) >= 97) & ((data | 32) <= 122))
    odd |= data == 0xC2  # signs and spaces of Latin-1
    sign = (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    odd[:-1] |= sign
    return odd


class ChunkTable:
    """Ids of the chunks seen so far: sorted hashes, and where each chunk's ids stand.

    Chunks are looked up, learned and put together as arrays. A chunk of letters, or of
    letters and one mark, needs no pattern; ``split`` cuts the others into words.
    """

    def __init__(self, rules: MergeRules, split, blank: bool):
        self._rules, self._split, self._blank = rules, split, blank
        self._clear()

    def _clear(self) -> None:
        self._keys, self._places = np.empty(0, np.uint64), np.empty(0, np.int64)
        self._new_keys, self._new_places = np.empty(0, np.uint64), np.empty(0, np.int64)
        self._begin, self._count, self._used = np.empty(0, np.int64), np.empty(0, np.int64), 0
        self._ids = np.empty(1 << 16, np.int32)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Entry of each key, -1 where it has none."""
        out = np.full(len(keys), -1, np.int64)
        for known, places in ((self._keys, self._places), (self._new_keys, self._new_places)):
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                out = np.where(known[at] == keys, places[at], out)
        return out

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        """Adds chunks that lie in ``data``; their keys are in order."""
        odd = np.r_[0, np.cumsum(_letters(data))]
        ends = starts + sizes
        lead = starts + (self._blank & (data[starts] == _BLANK) & (sizes > 1))
        last = data[ends - 1]
        point = _POINT[last] & (ends - lead > 1)
        plain = odd[ends - point] == odd[lead]
        # words of plain chunks, then those that the pattern finds in the others
        flat, _ = gathered(data, starts[plain], (sizes - point)[plain])
        cut = [self._split(bytes(data[a:b])) for a, b in zip(starts[~plain].tolist(), ends[~plain].tolist())]
        words = [w for c in cut for w in c]
        lengths = np.r_[(sizes - point)[plain], np.fromiter(map(len, words), np.int64, len(words))]
        ids, counts = self._rules.encode_flat(np.r_[flat, np.frombuffer(b"".join(words), np.uint8)], lengths)
        # ids of each chunk: of its words, and of the mark behind a plain one
        owner = np.r_[np.flatnonzero(plain), np.repeat(np.flatnonzero(~plain), [len(c) for c in cut])]
        marked = np.flatnonzero(plain & point)
        owner_of_id = np.r_[np.repeat(owner, counts), marked]
        ids = np.r_[ids, self._rules.last[last[marked]]]
        order = np.argsort(owner_of_id, kind="stable")
        count = np.bincount(owner_of_id, minlength=len(keys))
        if self._used + len(ids) > len(self._ids):
            self._ids = np.r_[self._ids[: self._used], np.empty(max(len(ids), self._used), np.int32)]
        self._ids[self._used : self._used + len(ids)] = ids[order]
        entries = np.arange(len(self._begin), len(self._begin) + len(keys))
        self._begin = np.r_[self._begin, self._used + np.r_[0, np.cumsum(count)[:-1]].astype(np.int64)]
        self._count = np.r_[self._count, count]
        self._used += len(ids)
        keys, entries = np.r_[self._new_keys, keys], np.r_[self._new_places, entries]
        if len(keys) * 4 > len(self._keys):  # few large sorts instead of one a batch
            keys, entries = np.r_[self._keys, keys], np.r_[self._places, entries]
            order = np.argsort(keys)
            self._keys, self._places = keys[order], entries[order]
            keys, entries = keys[:0], entries[:0]
        order = np.argsort(keys)
        self._new_keys, self._new_places = keys[order], entries[order]

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> list[bytes]:
        """Ids of texts whose chunks are given; ``first`` is the first chunk of each text (and the end)."""
        if not len(starts):
            return [b""] * (len(first) - 1)
        keys, at, same = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        entry = self._find(keys)
        new = entry < 0
        if len(self._begin) + new.sum() > KEPT_CHUNKS:
            self._clear()
            new[:] = True
        if new.any():
            self._learn(keys[new], data, starts[at[new]], (ends - starts)[at[new]])
            entry = self._find(keys)
        entry = entry[same]
        flat, begin = gathered(self._ids, self._begin[entry], self._count[entry])
        flat = flat.astype("<u4").tobytes()
        edges = (4 * begin[first]).tolist()
        return [flat[a:b] for a, b in zip(edges, edges[1:])]


class WordEncoder:
    """A vocabulary of lower-case words with ends, as its tokenizer file describes it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self._library = Tokenizer.from_file(path)
        self._rules = MergeRules(model["vocab"], model["merges"], model["end_of_word_suffix"] or "")
        self._split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self._byte = {s: b for b, s in enumerate(byte_symbols())}
        self._special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._cut = re.compile("(" + "|".join(map(re.escape, self._special)) + ")")
        self._table = ChunkTable(self._rules, self._words, blank=False)
        self._odd: dict[str, bytes] = {"": b""}  # chunks that need the library's normalizer
        tokens = {i: t for t, i in (model["vocab"] | self._special).items()}
        self._tokens = [tokens.get(i, "") for i in range(max(tokens) + 1)]

    def _words(self, chunk: bytes) -> list[bytes]:
        return [w.encode() for w in self._split.findall(chunk.decode())]

    def _room(self, kept: dict[str, bytes], wanted: set[str]) -> set[str]:
        """The chunks yet to encode; with too many kept, only those in use stay."""
        missing = wanted - kept.keys()
        if len(kept) + len(missing) > KEPT_ODD:
            used = {c: kept[c] for c in wanted - missing}
            kept.clear()
            kept.update(used)
            kept[""] = b""
        return missing

    def _learn_odd(self, wanted: set[str]) -> None:
        kept, library = self._odd, self._library
        parts: list[tuple[str, list[bytes | int]]] = []
        for chunk in self._room(kept, wanted):
            found: list[bytes | int] = []
            for i, part in enumerate(self._cut.split(chunk)):
                if i % 2:
                    found.append(self._special[part])
                elif part:
                    shown = library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(part))
                    found += [bytes(map(self._byte.__getitem__, w)) for w, _ in shown]
            parts.append((chunk, found))
        words = list({w for _, found in parts for w in found if not isinstance(w, int)})
        ids = dict(zip(words, self._rules.encode(words)))
        for chunk, found in parts:
            kept[chunk] = b"".join([w.to_bytes(4, "little") if isinstance(w, int) else ids[w] for w in found])

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        lowered = [t.lower().encode() for t in texts]
        data = np.frombuffer(b"\n".join(lowered) + b"\n", np.uint8)
        edge = np.flatnonzero(np.diff(np.r_[True, _SPACE[data], True]))
        starts, ends = edge[::2], edge[1::2]
        text_ends = np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1)
        return self._table.encode(data, starts, ends, np.r_[0, np.searchsorted(starts, text_ends)])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text without special tokens around it."""
        plain = [PLAIN(t) is not None and "<|" not in t for t in texts]
        found = iter(self._encode_plain([t for t, p in zip(texts, plain) if p]))
        cut = [[] if p else _BLANKS.sub(" ", t).split(" ") for t, p in zip(texts, plain)]
        self._learn_odd(set().union(*cut))
        return [next(found) if p else b"".join(map(self._odd.__getitem__, c)) for c, p in zip(cut, plain)]

    def decode(self, ids: list[bytes]) -> list[str]:
        """What the tokenizer's decode gives, special tokens kept: tokens joined by spaces."""
        token = self._tokens.__getitem__
        return [" ".join(map(token, np.frombuffer(x, "<u4").tolist())) for x in ids]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One per Python worker and file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def slices(column: pa.Array, size: int = BATCH_CHARS) -> Iterator[tuple[int, list]]:
    """Runs of a text or binary column that hold about ``size`` bytes, with their first row."""
    offsets = np.r_[0, np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))]
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, column.slice(at, end - at).to_pylist()
        at = end


def _encode_batches(path: str):
    def run(batches):
        for batch in batches:
            rest = batch.drop_columns(["text"])
            for first, texts in slices(batch.column("text")):
                ids = pa.array(encoder(path).encode(texts), pa.binary())
                yield rest.slice(first, len(texts)).append_column("ids", ids)

    return run


def _decode_batches(path: str):
    def run(batches):
        for batch in batches:
            for first, ids in slices(batch.column("ids")):
                texts = pa.array(encoder(path).decode(ids), pa.string())
                yield batch.slice(first, len(ids)).append_column("decoded", texts)

    return run


def encode(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` and the ids of the text, by the tokenizer file at ``path``."""
    ship(docs.sparkSession)
    rows = text_rows(docs, keep, text)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(_encode_batches(path), f"{fields}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The encoded rows with the decoded text beside them."""
    ship(encoded.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(_decode_batches(path), f"{fields}, decoded string")


def round_trip(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, the ids and the text decoded from them: encoded and decoded in one pass."""
    ship(docs.sparkSession)
    rows = text_rows(docs, keep, text)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")

    def both(batches):
        return _decode_batches(path)(_encode_batches(path)(batches))

    return rows.mapInArrow(both, f"{fields}, ids binary, decoded string")


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_bpe_round_trip(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    """Token count, and digests of the ids and of the decoded text, of every document."""
    path = path or word_vocabulary()
    both = round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return both.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES = {"op3_bpe_round_trip": op3_bpe_round_trip}
