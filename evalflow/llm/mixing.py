"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is a sequence of words (lower-cased A-Z) and an end; each of these tokens is predicted
after the one before, and every text is read from its first token to its last:

* A bit says whether the word is new, that is, stands nowhere in the texts learned from. Its
  probability is what really happened so far after words as frequent as the one before.
* A known token has a class, 16 bits of its hash. Each bit has two predictors: how often it
  was 0 and 1 after the same bits of a class anywhere, and after the same bits behind the same token
  before. Their log odds are summed with weights from a set that is chosen by what was seen
  behind the token before (the gate), and the sum is refined by a table of what really
  happened at that sum (an adaptive probability map). Weights, map and the table of new
  words learn from every step of 4096 tokens right after it was predicted. Within its class a token has
  its share of the class's tokens.
* A new word is spelled: its bytes and a closing blank, each byte as eight bits, high bits first,
  mixed alike from the last one, two, three and four bytes of the word and all of it so far.
  These bits do not look beyond the word, so each distinct word is spelled once.

A text that was learned from is scored as if each of its tokens, when its turn comes, had
stood once less: else every text would be known by heart, and only what stands elsewhere too
(or earlier or later in it) makes it likelier.

1. `vocabulary`: the words of all documents and their counts in those learned from; each batch of
   texts packs its words by ranges of their hash, which are added up apart.
2. `context_counts`: how often each byte stands after each context within words, summed over the
   whole vocabulary, every word as often as it stands. Blocks of words ask by ranges of the
   context's hash and are told all bytes after their contexts; the bits' counts are sums of those.
3. `word_scores`: blocks of words, in the order of their hash, are spelled and learned from.
   What blocks and parts tell each other is made and taken apart for all messages of a block or part at once.
4. `score_documents`: blocks of documents ask for their words' counts and spellings, and for the
   counts of their classes' bits after nothing and after the token before; these go by ranges of
   the context's hash. Classes after nothing and after the most frequent tokens (`frequent_tokens`) are asked
   by their two bytes, the second with the first in its context, so such a token's followers part
   over many tasks. There are as many contexts as the corpus has, with whole numbers as counts. A block is told
   what each class it asked for counts, and what turns off on the way to it toward classes that it did not
   ask for; the other counts of bits are sums of those. Then each block reads its texts, in the order of id and text.

Contexts within words are compared by 56 bits of hash, those of classes by 44, where a rare
collision adds up two contexts. Weights and maps start afresh in each block of words or documents, so
equal texts of different blocks differ a little in score; nothing goes to the driver or to all tasks but totals.

Defined results: a null or empty text is the end alone; repeated rows are scored and,
where learned from, counted as often as they stand; without any document to learn from the
base score counts V = N = 0; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import math
import struct
import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalflow.llm import blocks
from evalflow.llm.common import crc_bucket, ship, text_rows, written
from evalflow.llm.hashing import binary_array, dealt_words, gathered, mix, text_bytes, word_hashes

HELD_OUT_MODULUS, HELD_OUT = 7, 2

ORDERS = 5
#: Bytes of vocabulary in a block that asks for its contexts, and whose contexts are added up in one task.
WORD_BYTES = 512 << 10
PART_BYTES = 512 << 10
#: Text of a block that asks for scores.
BLOCK_BYTES = 6 << 20
#: Text whose distinct words are added up in one task.
VOCABULARY_BYTES = 64 << 20
TEXT_PART_BYTES = 8 << 20

GATES = 32
MAP_STEPS = 33
#: Bits between two updates of the weights, and how far an update goes.
UPDATE_BITS = 4096
RATE = 0.05
#: Tokens of texts between two updates, and how far those go.
UPDATE_TOKENS = 4096
TEXT_RATE = 0.5
#: Sums that bits add to by turns: bits side by side mostly share a gate, and adding up would wait for the one before.
_LANES = 4
#: Weight of the map's own centre among what was seen.
MAP_PRIOR = 20.0
_CHUNK = 1 << 14
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BLANK = 32
_BYTE = np.uint64(8)
#: Bits of a key of a class: the context above, the class, and spare ones below.
_CONTEXT, _SPARE = np.uint64(20), np.uint64(4)
#: A token's class is the upper 16 bits of its hash; an end has a hash of its own.
_CLASS = np.uint64(48)
END = mix(np.array([0x656E64], np.uint64))[0]
#: Arrays travel compressed by this; it takes a tenth of the time of zlib.
_CODEC = pa.Codec("zstd", 1)
#: Bytes from which on compressing pays.
_FEW = 128
#: Keys of messages that are taken apart at once.
_BATCH = 1 << 15
#: The eight bits of each byte, high ones first; how many bits numbers have; where the map
#: of a byte's bits begins, by the bits before, those of bits that are 1 behind all others.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)
_STARTS = MAP_STEPS * (np.arange(32) // 2 + 16 * (np.arange(32) & 1))
_LENGTH = np.frexp(np.arange(65536))[1].astype(np.uint8)
_MAPS = MAP_STEPS * ((1 << np.arange(8) | np.arange(256)[:, None] >> np.arange(8, 0, -1)) + 256 * _BITS.astype(np.int64))


# -- words as bits ------------------------------------------------------------------------


class Bits:
    """The bytes of some words, and of each its word and each order's context with the byte itself below."""

    def __init__(self, words: pa.Array):
        begin = np.frombuffer(words.buffers()[1], "<i4")[words.offset : words.offset + len(words) + 1].astype(np.int64)
        data = np.frombuffer(words.buffers()[2], np.uint8)[begin[0] : begin[-1]]
        begin = begin - begin[0]
        text = np.insert(data, begin[1:], _BLANK)
        first = begin[:-1] + np.arange(len(words))
        size = np.diff(begin) + 1
        self.first, self.size = first, size
        word = np.repeat(np.arange(len(words)), size)
        place = np.arange(len(text)) - first[word]
        recent = np.zeros(len(text), np.uint64)
        for back in range(1, 5):
            seen = np.r_[np.zeros(min(back, len(text)), np.uint8), text[:-back]].astype(np.uint64)
            recent |= np.where(place >= back, seen, 0).astype(np.uint64) << np.uint64(8 * (back - 1))
        contexts = [mix(recent & np.uint64(256**k - 1) | np.uint64(k << 40)) for k in range(1, 5)]
        contexts.append(mix(self._so_far(text, first, word) ^ np.uint64(5 << 40)))
        self.text = text
        self.keys = [c >> _BYTE << _BYTE | text for c in contexts]
        self.word = word

    @staticmethod
    def _so_far(text: np.ndarray, first: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Hash of the bytes of the word before each byte."""
        value = (text.astype(np.uint64) + np.uint64(1)) * _STEP
        power = np.empty(len(text), np.uint64)
        power[:1] = 1
        have, factor = 1, 0x2545F4914F6CDD1D
        while have < len(text):
            more = min(have, len(text) - have)
            power[have : have + more] = power[:more] * np.uint64(factor)
            have, factor = have + more, factor * factor % 2**64
        total = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(value * power, out=total[1:])
        back = np.ones(len(text), np.uint64)
        have, factor = 1, pow(0x2545F4914F6CDD1D, -1, 2**64)
        while have < len(text):
            more = min(have, len(text) - have)
            back[have : have + more] = back[:more] * np.uint64(factor)
            have, factor = have + more, factor * factor % 2**64
        return (total[:-1] - total[first[word]]) * back[first[word]]


def _chunks(words: pa.Array):
    """Runs of words with about ``_CHUNK`` bytes."""
    ends = np.frombuffer(words.buffers()[1], "<i4")[words.offset : words.offset + len(words) + 1]
    row = 0
    while row < len(words):
        end = max(row + 1, int(np.searchsorted(ends, int(ends[row]) + _CHUNK, "right")) - 1)
        yield row, words.slice(row, end - row)
        row = end


# -- the vocabulary -----------------------------------------------------------------------


_PACKED_WORDS_SQL = "part int, words binary, sizes binary, counts binary"
_PACKED_WORDS = pa.schema([("part", pa.int32())] + [(name, pa.binary()) for name in ("words", "sizes", "counts")])


def _distinct(parts: int):
    def run(batches):
        for batch in batches:
            high, words, counts = dealt_words(batch.column("text"), batch.column("learn").to_numpy(zero_copy_only=False))
            flat, begin = text_bytes(words)
            edges = np.searchsorted(high, -(-np.arange(parts + 1) * 65536 // parts))
            part = np.flatnonzero(edges[1:] > edges[:-1])
            edges = np.r_[edges[part], len(high)]
            at = begin[edges].tolist()
            packed = [_shrunk(flat[a:b].tobytes()) for a, b in zip(at, at[1:])]
            sizes = np.diff(begin)
            yield from _table([part, packed, _planes(sizes, edges), _planes(counts, edges)], _PACKED_WORDS).to_batches()

    return run


def _summed_words(table: pa.Table) -> pa.Table:
    flat = np.frombuffer(b"".join(map(_grown, table.column("words").to_pylist())), np.uint8)
    sizes, counts = (_all(map(_from_planes, table.column(c).to_pylist()))[0].astype(np.int64) for c in ("sizes", "counts"))
    words = pa.table({"word": binary_array(flat, np.r_[0, np.cumsum(sizes)]), "n": counts})
    summed = words.group_by("word", use_threads=False).aggregate([("n", "sum")])
    return pa.table({"word": summed.column("word"), "n": summed.column("n_sum")})


def vocabulary(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """Distinct words of ``(text, learn 0 or 1)`` and how often they stand in rows to learn from.

    Each batch of texts packs its words by ranges of their hash; ``parts`` of those are added up apart.
    """
    ship(rows.sparkSession)
    if parts is None:
        parts = blocks.sizes(rows, part_bytes=VOCABULARY_BYTES).parts
    texts = rows.select("text", F.col("learn").cast("long").alias("learn"))
    packed = texts.mapInArrow(_distinct(parts), _PACKED_WORDS_SQL)
    return written(packed.groupBy("part").applyInArrow(_summed_words, "word binary, n long"), "vocabulary")


# -- counts of contexts ---------------------------------------------------------------------

_ASKED_CONTEXTS_SQL = "block long, part int, keys binary, counts binary"
_CONTEXTS = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _binary(rows: pa.Table | pa.RecordBatch) -> pa.Array:
    words = _column(rows, "word") if isinstance(rows, pa.Table) else rows.column("word")
    return words.cast(pa.binary())


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each one's counts."""
    rows = pa.table({"key": keys, "n": counts}).group_by("key", use_threads=False).aggregate([("n", "sum")])
    keys, counts = rows.column("key").to_numpy(), rows.column("n_sum").to_numpy()
    order = np.argsort(keys)
    return keys[order], counts[order]


def _shrunk(data: bytes) -> bytes:
    """The bytes, compressed where that makes many of them fewer, and their number."""
    packed = _CODEC.compress(data, asbytes=True) if len(data) >= _FEW else data
    return (packed if len(packed) < len(data) else data) + len(data).to_bytes(4, "little")


def _grown(data: bytes) -> bytes:
    size = int.from_bytes(data[-4:], "little")
    return data[:-4] if len(data) == size + 4 else _CODEC.decompress(data[:-4], size, asbytes=True)


def _packed(numbers: np.ndarray) -> bytes:
    """The numbers' bytes by place, all lowest ones first: places that are mostly zero take next to nothing."""
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return _shrunk(np.ascontiguousarray(planes).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_grown(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def _context_rows(rows) -> pa.Table:
    """Rows of ``(block, part, keys in order, counts)``; the keys travel as steps from one to the next."""
    rows = [(b, p, _packed(np.diff(k, prepend=np.uint64(0))), _packed(n)) for b, p, k, n in rows]
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_CONTEXTS)], schema=_CONTEXTS)


def _context_arrays(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    return [
        (np.cumsum(_unpacked(k), dtype=np.uint64), _unpacked(n).astype(np.int64))
        for k, n in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist())
    ]


def _stretches(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of values in order the distinct ones, and where each begins (and the end)."""
    begin = np.r_[0, np.flatnonzero(values[1:] != values[:-1]) + 1][: len(values)]
    return values[begin], np.r_[begin, len(values)]


def _ask_contexts(parts: int):
    def run(table: pa.Table) -> pa.Table:
        weight = _column(table, "n").to_numpy()
        found = [(row, Bits(words)) for row, words in _chunks(_binary(table))]
        own = [np.tile(weight[row + bits.word], ORDERS) for row, bits in found]
        keys, counts = _added(np.concatenate([k for _, bits in found for k in bits.keys]), np.concatenate(own))
        block, at = table.column("block")[0].as_py(), _cut(keys, parts).tolist()
        return _context_rows((block, p, keys[a:b], counts[a:b]) for p, (a, b) in enumerate(zip(at, at[1:])) if b > a)

    return run


def _tell_contexts(asked: pa.Table) -> pa.Table:
    """To each block all bytes that stand after the contexts it asked for, and how often."""
    own = _context_arrays(asked)
    keys, counts = _added(np.concatenate([k for k, _ in own]), np.concatenate([n for _, n in own]))
    context, begin = _stretches(keys >> _BYTE)
    part, rows = asked.column("part")[0].as_py(), []
    for block, (mine, _) in zip(asked.column("block").to_pylist(), own):
        place = np.searchsorted(context, _stretches(mine >> _BYTE)[0])
        at, _ = gathered(np.arange(len(keys)), begin[place], begin[place + 1] - begin[place])
        rows.append((block, part, keys[at], counts[at]))
    return _context_rows(rows)


def context_counts(dealt: DataFrame, parts: int) -> DataFrame:
    """``(block, part, keys, counts)``: the contexts of each block of words ``(block, word, n)``, counted in all."""
    asked = dealt.groupBy("block").applyInArrow(_ask_contexts(parts), _ASKED_CONTEXTS_SQL)
    return asked.groupBy("part").applyInArrow(_tell_contexts, _ASKED_CONTEXTS_SQL)


def _narrow(total: int) -> type:
    return np.uint32 if total < 2**32 else np.int64


def _parted_at(keys: np.ndarray, bits: int) -> np.ndarray:
    """Of each key in order, from how many bits behind the context on it does not begin like the one before."""
    parted = np.zeros(len(keys), np.uint8)
    turned = keys[1:] ^ keys[:-1]
    shared = bits - _LENGTH.take((turned & np.uint64(2**bits - 1)).astype(np.intp))
    parted[1:] = np.where(turned >> np.uint64(bits) > 0, 0, shared + 1)
    return parted


def _levels(parted: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """By depth the keys that are the first to begin with one bit more, and whether they are so with as many bits."""
    at = [np.flatnonzero(parted <= depth + 1) for depth in range(bits)]
    return [(each, parted[each] <= depth) for depth, each in enumerate(at)]


def _joined_counts(counts: np.ndarray, leads: np.ndarray) -> np.ndarray:
    """Counts of what begins alike, from those of the one or two that go on from it; the first of them leads."""
    total = counts[leads]
    follows = np.flatnonzero(~leads)
    total[follows - np.arange(1, len(follows) + 1)] += counts[follows]
    return total


def _taken(keys: np.ndarray, counts: np.ndarray, bits: int = 8) -> np.ndarray:
    """(bits + 1, keys): of each distinct key in order, how often its context stands and its first one to all bits after that."""
    taken = np.empty((bits + 1, len(keys)), _narrow(int(counts.sum())))
    taken[bits] = counts
    parted = _parted_at(keys, bits)
    for depth, (_, leads) in reversed([*enumerate(_levels(parted, bits))]):
        counts = _joined_counts(counts, leads)
        np.take(counts.astype(taken.dtype), np.cumsum(parted <= depth) - 1, out=taken[depth], mode="clip")
    return taken


def _odds(depths: np.ndarray, own: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, bits) log odds of bits, without the ``own`` time; (bits, rows) how often each and the other one came.

    ``depths`` counts by depth, a column for each row: one depth after the other, no loops over a few numbers.
    """
    same = (depths[1:] - own.astype(depths.dtype)).astype(np.float32)
    other = (depths[:-1] - depths[1:]).astype(np.float32)
    toward = np.log((same + np.float32(0.4)) / (other + np.float32(0.4)))
    odds = np.ascontiguousarray(toward.T)
    odds *= bits * np.float32(2) - np.float32(1)
    return odds, same, other


class Contexts:
    """What a block of words was told: keys in order, and counts of their bits."""

    def __init__(self, told: pa.Table):
        own = _context_arrays(told)
        order = np.argsort([int(k[0]) for k, _ in own])
        self.keys = np.concatenate([own[i][0] for i in order])  # parts are ranges of the keys
        self.taken = _taken(self.keys, np.concatenate([own[i][1] for i in order]))


# -- mixing -----------------------------------------------------------------------------------


def _log2(x: np.ndarray) -> np.ndarray:
    """Logarithms of float32 numbers from 1, rounded down: their exponents."""
    return (x.view(np.int32) >> 23) - 127


def _squash(x):
    return 1 / (1 + np.exp(-np.clip(x, -12, 12)))


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of wanted keys; each distinct one is asked once, in order, which is several times faster than as they come."""
    found = pa.array(wanted).dictionary_encode()
    each = found.dictionary.to_numpy()
    order = np.argsort(each)
    at = np.empty(len(each), np.int64)
    at[order] = np.searchsorted(keys, each[order])
    return at[found.indices.to_numpy()]


class Used:
    """Keys that are used in texts to learn from (``own`` 1) or in others (0), numbered in order."""

    def __init__(self, keys: int, *places: tuple[np.ndarray, np.ndarray]):
        marks = np.zeros(2 * keys, bool)
        for place, own in places:
            marks[place * 2 + own] = True
        self.number = np.cumsum(marks, dtype=np.int32) - np.int32(1)
        self.marks = marks

    def numbers(self, place: np.ndarray, own: np.ndarray) -> np.ndarray:
        return self.number[place * 2 + own]

    def within(self, begin: int, end: int):
        """Chunks of those among a range of keys: numbers, keys, ``own``."""
        rows = np.flatnonzero(self.marks[2 * begin : 2 * end])
        first = int(self.number[2 * begin + rows[0]]) if len(rows) else 0
        for at in range(0, len(rows), _CHUNK):
            pick = rows[at : at + _CHUNK]
            yield slice(first + at, first + at + len(pick)), begin + (pick >> 1), pick & 1

    def __len__(self) -> int:
        return int(self.number[-1]) + 1 if len(self.number) else 0


class Mixer:
    """Weights by gate and a map of what happened at each sum: both predict first, then learn."""

    def __init__(self, weights: np.ndarray, maps: int, rate: float):
        self.weights, self.rate = np.ascontiguousarray(weights.T, np.float32), rate
        self.lanes = np.empty((len(self.weights), 0), np.int64)  # places of each predictor's weights, by turns
        self.hits = np.tile(_squash(np.arange(MAP_STEPS) / 2 - 8) * MAP_PRIOR, maps)
        self.seen = np.full(maps * MAP_STEPS, MAP_PRIOR)

    def log10(self, odds: np.ndarray, gate: np.ndarray, at: np.ndarray, bit: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Of bits, log10 of the probability each had; then those with a weight are learned from.

        ``odds`` has a row for each predictor, ``at`` is where the map to use begins, or for bits that are 1 that
        place behind all maps; bits and weights are float32.
        """
        predictors, gates = self.weights.shape
        if self.lanes.shape[1] < len(gate):
            self.lanes = (np.arange(len(gate)) % _LANES * predictors + np.arange(predictors)[:, None]) * gates
        each = gate + self.lanes[:, : len(gate)]
        parts = np.concatenate([self.weights] * _LANES).take(each)
        parts *= odds
        total = np.add.reduce(parts, axis=0)
        mixed = np.clip(total, -12, 12)
        np.exp(np.negative(mixed, out=mixed), out=mixed)
        mixed += 1
        np.divide(1, mixed, out=mixed)
        total += 8
        total *= 2
        np.clip(np.rint(total, out=total), 0, MAP_STEPS - 1, out=total)
        index = at + total.astype(np.int32)
        mapped = (self.hits / self.seen).astype(np.float32)
        p = np.concatenate([mapped, mapped]).take(index)
        p += mixed
        p *= np.float32(0.5)
        p -= 1 - bit
        np.clip(np.abs(p, out=p), np.float32(2**-16), np.float32(1 - 2**-16), out=p)
        came = np.bincount(index, weight, 2 * len(self.seen)).reshape(2, -1)
        learned = came[0] + came[1]
        if gates * MAP_STEPS == len(self.seen):  # each gate has its map
            share = learned.reshape(gates, -1).sum(axis=1)
        else:
            share = np.bincount(gate, weight, gates)
        share = np.maximum(share, 1)
        miss = np.subtract(bit, mixed, out=mixed)
        miss *= weight
        np.multiply(odds, miss, out=parts)
        wrong = np.bincount(each.reshape(-1), parts.reshape(-1), _LANES * predictors * gates)
        self.weights += self.rate * wrong.reshape(_LANES, predictors, gates).sum(axis=0) / share
        self.hits += came[1]
        self.seen += learned
        return np.log10(p, out=p)


def _score_words(table: pa.Table, told: pa.Table) -> pa.Table:
    """Every word is scored as a new one, then learned from if it stands in texts to learn from."""
    table = table.take(pa.array(np.argsort(word_hashes(_binary(table))[0], kind="stable")))
    contexts = Contexts(told)
    mixer = Mixer(np.full((GATES, ORDERS), 0.3), 256, RATE)
    learned = (_column(table, "n").to_numpy() > 0).astype(np.int32)
    chunks = [(row, Bits(words)) for row, words in _chunks(_binary(table))]
    own = np.concatenate([learned[row + bits.word] for row, bits in chunks])
    text = np.concatenate([bits.text for _, bits in chunks]).astype(np.intp)
    ends = np.cumsum([len(bits.text) for _, bits in chunks]).tolist()
    first = np.concatenate([bits.first + at for at, (_, bits) in zip([0, *ends], chunks)])
    places = [_find(contexts.keys, np.concatenate([bits.keys[k] for _, bits in chunks])) for k in range(ORDERS)]
    del chunks
    used = Used(len(contexts.keys), *((place, own) for place in places))
    odds, gate_of = np.empty((len(used), 8), np.float32), np.empty((len(used), 8), np.uint8)
    for rows, key, less in used.within(0, len(contexts.keys)):
        bits = _BITS.take((contexts.keys[key] & np.uint64(255)).astype(np.int64), axis=0)
        odds[rows], same, other = _odds(contexts.taken.take(key, axis=1), less, bits)
        gate_of[rows] = np.minimum(_log2(same + other + 1), 7).T
    places = np.stack([used.numbers(place, own) for place in places])
    log = np.empty((len(text), 8), np.float32)
    for begin, end in zip([0, *ends], ends):
        for byte in range(begin, end, UPDATE_BITS // 8):  # words come in the order of their hash
            pick = slice(byte, min(byte + UPDATE_BITS // 8, end))
            at = places[:, pick]
            gate = (gate_of.take(at[-1], axis=0) * 4 + gate_of.take(at[-2], axis=0) // 2).astype(np.int64)
            log[pick] = mixer.log10(
                odds.take(at, axis=0).reshape(ORDERS, -1),
                gate.reshape(-1),
                _MAPS.take(text[pick], axis=0).reshape(-1),
                _BITS.take(text[pick], axis=0).reshape(-1).astype(np.float32),
                np.repeat(own[pick], 8).astype(np.float32),
            ).reshape(-1, 8)
    scores = np.add.reduceat(log.astype(np.float64).sum(axis=1), first)
    return table.select(["word", "n"]).append_column("score", pa.array(scores))


def word_scores(words: DataFrame) -> DataFrame:
    """``(word, n, score)``: log10 probability of the bytes and closing blank of each word as a new one."""
    ship(words.sparkSession)
    size = words.agg(F.sum(F.octet_length("word") + 1)).first()[0] or 0
    blocks, parts = max(1, -(-size // WORD_BYTES)), max(1, -(-size // PART_BYTES))
    dealt = words.withColumn("block", F.pmod(F.xxhash64("word"), F.lit(blocks)))
    told = context_counts(dealt, parts)
    scored = dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        _score_words, "word binary, n long, score double"
    )
    return written(scored, "scores")


# -- classes of tokens --------------------------------------------------------------------------


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and the place of each value among them."""
    found = pa.array(values).dictionary_encode()
    each = found.dictionary.to_numpy()
    order = np.argsort(each)
    rank = np.empty(len(each), np.int32)
    rank[order] = np.arange(len(each), dtype=np.int32)
    return each[order], rank[found.indices.to_numpy()]


def _numbered_pairs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes in order, and the place of each code among them; sorted with their own places below them."""
    bits = len(codes).bit_length()
    if int(codes.max(initial=0)).bit_length() + bits < 64:
        ordered = np.sort(codes << bits | np.arange(len(codes)))
        ordered, order = ordered >> bits, ordered & ((1 << bits) - 1)
    else:
        order = np.argsort(codes)
        ordered = codes[order]
    fresh = np.ones(len(codes), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(codes), np.int32)
    place[order] = np.cumsum(fresh, dtype=np.int32) - 1
    return ordered[fresh], place


def _grouped(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the sum of each one's weights, a row that has it, and each row's place among them."""
    order = np.argsort(keys)
    ordered = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    start = np.flatnonzero(fresh)
    place = np.empty(len(keys), np.int32)
    place[order] = np.cumsum(fresh, dtype=np.int32) - 1
    return ordered[start], np.add.reduceat(weight[order], start), order[start], place


def _after(context: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """44 bits of the context, then the class; the lowest bits stay empty."""
    return context >> _CONTEXT << _CONTEXT | kind << _SPARE


def _two_bytes(context: np.ndarray, kind: np.ndarray, weight: np.ndarray):
    """Distinct keys of the first and second byte of a class after a context, their weights, each row's two places.

    They are keys of classes with the other byte empty, the second ones after the context and the first byte.
    """
    high, low = kind >> _BYTE, kind & np.uint64(255)
    context = mix(context)
    second, n, row, place = _grouped(_after(mix(context + (high + np.uint64(1)) * _STEP), low), weight)
    first, m, _, above = _grouped(_after(context[row], high[row] << _BYTE), n)
    return np.r_[first, second], np.r_[m, n], np.stack([above[place], place + np.int32(len(first))])


def frequent_tokens(words: DataFrame, ends: int, total: int, parts: int) -> np.ndarray:
    """Hashes, in order, of the tokens that are a part's share of those learned from: ``parts`` at most."""
    often = [bytes(r.word) for r in words.filter(F.col("n") * parts > total).select("word").collect()]
    found, _ = word_hashes(pa.array(often, pa.binary()))
    return np.sort(np.r_[found, END] if ends * parts > total else found)


class Tokens:
    """The tokens of some texts: words by their hash and an end to each, with the class of each token.

    ``keys`` are the distinct keys of the classes after nothing and after the token before, those
    after nothing and after ``frequent`` tokens byte by byte; ``counts`` how often they stand in
    texts to learn from. ``places`` (4, tokens) tells where the bits of both bytes of each token's class
    are, alone and behind the token before, when each key has two rows of them.
    """

    def __init__(self, table: pa.Table, frequent: np.ndarray = np.empty(0, np.uint64)):
        words, first = word_hashes(_column(table, "text"))
        self.distinct, words = _numbered(words)
        self.first = first + np.arange(len(first))
        self.own = np.repeat(_column(table, "learn").to_numpy(), np.diff(self.first))
        end = len(self.distinct)  # an end has the number behind those of the words
        self.token = np.insert(words.astype(np.intp), first[1:], end)
        self.is_end = self.token == end
        every = np.r_[self.distinct, END]
        kind = every >> _CLASS
        self.kind = kind.astype(np.uint16).take(self.token)
        weight = np.bincount(kind.astype(np.int64), np.bincount(self.token, self.own, len(every)), 65536).astype(np.int64)
        stands = np.zeros(65536, bool)
        stands[kind.astype(np.int64)] = True
        classes = np.flatnonzero(stands)
        if not len(self.token):
            classes = classes[:0]
        keys, counts, places = _two_bytes(np.full(len(classes), END ^ _STEP), classes.astype(np.uint64), weight[classes])
        alone = places[:, np.cumsum(stands)[kind.astype(np.int64)] - 1] if len(classes) else places
        # tokens before by their contexts; frequent ones stand behind all others
        often = np.isin(every, frequent)
        context = np.where(often, every, mix(every) >> _CONTEXT)
        order = np.lexsort((context, often))
        fresh = np.r_[True, context[order[1:]] != context[order[:-1]]] | often[order]
        rank = np.empty(len(every), np.int64)
        rank[order] = np.cumsum(fresh) - 1
        ranked = every[order[fresh]]
        rest = int(rank[~often].max(initial=-1)) + 1
        before = np.r_[end, self.token[:-1]][: len(self.token)]  # a text begins after an end
        pairs, place = _numbered_pairs(rank.take(before) << 16 | self.kind)
        n = np.bincount(place, self.own, len(pairs)).astype(np.int64)
        split = int(np.searchsorted(pairs, rest << 16))
        after, kind = ranked[pairs >> 16], (pairs & 65535).astype(np.uint64)
        plain = _after(mix(after[:split]), kind[:split])
        more, m, two = _two_bytes(after[split:], kind[split:], n[split:])
        few, counts = np.r_[keys, more], np.r_[counts, m]
        order = np.argsort(few, kind="stable")
        few, counts = few[order], counts[order]
        at = np.searchsorted(plain, few)
        self.keys, self.counts = np.insert(plain, at, few), np.insert(n[:split], at, counts)
        number = np.empty(len(few) + split, np.int32)  # the place of each key: first of those by bytes, then of the others
        number[order] = at + np.arange(len(few))
        number[len(few) :] = np.arange(split) + np.cumsum(np.bincount(at, minlength=split + 1))[:split]
        behind = np.empty((2, len(pairs)), np.int32)
        behind[:, :split] = np.arange(split) + len(few)
        behind[:, split:] = two + np.int32(len(keys))
        odd = np.array([[0], [1]], np.int32)
        alone, behind = number[alone] * 2 + odd, number[behind] * 2 + odd
        self.places = np.concatenate([alone.take(self.token, axis=1), behind.take(place.astype(np.intp), axis=1)])


class Told:
    """What a block of texts was told: of each class used, how often it stands and the odds and cells of its 16 bits.

    A class is used in texts to learn from or in others, which differ by the time that it stands less.
    """

    def __init__(self, tokens: Tokens):
        self.tokens = tokens
        key = tokens.places >> 1
        self.used = Used(len(tokens.keys), *((k, tokens.own) for k in key))
        self.number = [self.used.numbers(k, tokens.own) for k in key]
        self.odds = np.empty((len(self.used), 16), np.float32)
        self.cells = np.empty((len(self.used), 16), np.uint8)
        self.stood = np.empty(len(self.used), np.int64)

    def fill(self, begin: int, depths: np.ndarray) -> None:
        """The counts by depth of the keys from ``begin`` on."""
        for rows, key, own in self.used.within(begin, begin + depths.shape[1]):
            kind = (self.tokens.keys[key] >> _SPARE).astype(">u2")
            bits = np.unpackbits(kind.view(np.uint8).reshape(-1, 2), axis=1)
            counts = depths.take(key - begin, axis=1)
            self.odds[rows], same, other = _odds(counts, own, bits)
            gate = np.minimum(_log2(same + other + 1), 7).astype(np.uint8)
            gate *= 2
            gate += np.minimum(same, other) == 0
            gate *= 2
            np.add(gate.T, bits, out=self.cells[rows])
            self.stood[rows] = counts[16] - own

    def join(self) -> None:
        """Classes told byte by byte get their first byte beside the second."""
        for first, second in (self.number[:2], self.number[2:]):
            apart = np.flatnonzero(first != second)
            beside = np.full(len(self.used), -1, np.int32)
            beside[second[apart]] = first[apart]
            second = np.flatnonzero(beside >= 0)
            first = beside[second]
            self.odds[second, :8], self.cells[second, :8] = self.odds[first, :8], self.cells[first, :8]
        self.number = self.number[1::2]

    def bits(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Odds by both contexts and the cells of the 16 bits of some tokens' classes, and how often the class stands."""
        alone, behind = self.number[0][pick], self.number[1][pick]
        odds = self.odds.take(np.stack([alone, behind]), axis=0).reshape(2, -1)
        return odds, self.cells.take(behind, axis=0).reshape(-1), self.stood[alone]


def _token_scores(tokens: Tokens, told: Told, stands: np.ndarray, spelled: np.ndarray) -> np.ndarray:
    """log10 probability of each token after the one before, the texts read in order.

    ``stands`` is how often each token stands in texts to learn from, ``spelled`` its score as a new word.
    """
    left = stands - tokens.own
    new = (left <= 0) & ~tokens.is_end
    steps = np.minimum(np.log2(np.maximum(np.roll(stands, 1) - tokens.own, 0) + 1), 15).astype(np.int64)
    flag = steps * 2 + np.roll(new, 1)
    came = flag + 32 * new
    trust = np.arange(2 * 8) // 2 / (np.arange(2 * 8) // 2 + 0.5)
    mixer = Mixer(np.stack([1 - trust, trust], axis=1), 16, TEXT_RATE)  # a map for each gate
    hits, seen = np.full(32, 0.5), np.ones(32)
    scores = np.empty(len(new))
    for at in range(0, len(new), UPDATE_TOKENS):
        pick = slice(at, at + UPDATE_TOKENS)
        p = hits / seen
        score = np.log10(np.r_[1 - p, p]).take(came[pick])
        own = tokens.own[pick]
        hits += np.bincount(flag[pick], own * new[pick], 32)
        seen += np.bincount(flag[pick], own, 32)
        scores[pick] = score + spelled[pick]
        known = at + np.flatnonzero(~new[pick])
        odds, cell, n = told.bits(known)
        bit, cell = (cell & 1).astype(np.float32), cell.astype(np.intp)
        weight = np.broadcast_to(tokens.own[known].astype(np.float32)[:, None], (len(known), 16)).reshape(-1)
        log = mixer.log10(odds, cell >> 1, _STARTS.take(cell), bit, weight)
        in_class = np.maximum(left[known], 0) + tokens.is_end[known]
        share = np.log10(np.maximum(in_class, 1) / np.maximum(n + (tokens.kind[known] == END >> _CLASS), 1))
        scores[known] = score[known - at] + log.reshape(-1, 16).sum(axis=1) + share
    return scores


# -- documents ----------------------------------------------------------------------------------

_ASKED = pa.schema(
    [("block", pa.int64()), ("part", pa.int32()), ("keys", pa.binary()), ("classes", pa.binary()), ("counts", pa.binary())]
)
_ASKED_SQL = "block long, part int, keys binary, classes binary, counts binary"
_KNOWN_SQL = "part int, keys binary, counts binary, scores binary"
_REPLY = pa.schema(
    [("block", pa.int64()), ("part", pa.int32())]
    + [(name, pa.binary()) for name in ("counts", "scores", "left", "some", "lost")]
)
_REPLY_SQL = "block long, part int, counts binary, scores binary, left binary, some binary, lost binary"


def _table(columns: list, schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


# Messages are made and read many at once: there are as many as blocks times parts, so that of a
# large corpus each is small. ``edges`` tells where each begins in the values of all, and the end.


def _planes(numbers: np.ndarray, edges: np.ndarray) -> list[bytes]:
    """As many bytes of each number of a message as its largest needs, the lowest of all first."""
    full = np.flatnonzero(edges[1:] > edges[:-1])
    most = np.zeros(len(edges) - 1, np.int64)
    if len(full):
        most[full] = np.maximum.reduceat(numbers, edges[full])
    sizes = np.array([1, 2, 4, 8])[np.searchsorted([2**8, 2**16, 2**32], most, "right")].tolist()
    lowest, out = numbers.astype(np.uint8), []
    for size, a, b in zip(sizes, edges.tolist(), edges[1:].tolist()):
        flat = lowest[a:b] if size == 1 else numbers[a:b].astype(f"<u{size}").view(np.uint8).reshape(-1, size).T
        out.append(bytes([size]) + _shrunk(flat.tobytes()))
    return out


def _from_planes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_grown(data[1:]), np.uint8)
    size = data[0]
    return planes if size == 1 else np.ascontiguousarray(planes.reshape(size, -1).T).view(f"<u{size}").reshape(-1)


def _all(pieces) -> tuple[np.ndarray, np.ndarray]:
    """Arrays behind each other, and their edges."""
    pieces = [np.empty(0, np.uint8), *pieces]
    return np.concatenate(pieces), np.cumsum([len(piece) for piece in pieces])


def _batches(edges: np.ndarray):
    """Runs of messages with about ``_BATCH`` values, few enough to stay in a cache."""
    row = 0
    while row < len(edges) - 1:
        end = max(row + 1, int(np.searchsorted(edges, edges[row] + _BATCH, "right")) - 1)
        yield row, end
        row = end


def _beginnings(keys: np.ndarray, edges: np.ndarray):
    """Of the keys of messages, each in order: from how many bits on they part, its levels, and which losses are told.

    The last is a bit for each key and depth: whether the key is the first of its message to begin with
    one bit more, and none there shares its beginning with that bit turned.
    """
    parted = _parted_at(keys >> _SPARE, 16)
    parted[edges[:-1][edges[:-1] < len(keys)]] = 0
    levels = _levels(parted, 16)
    sole = parted[:, None] <= np.arange(16, dtype=np.uint8)
    for depth, (at, leads) in enumerate(levels):
        sole[at[np.flatnonzero(~leads) - 1], depth] = False
    return parted, levels, sole


def _losses(keys: np.ndarray, edges: np.ndarray, place: np.ndarray, left: np.ndarray, lost: np.ndarray):
    """Counts by bit as what is left after all, where a bit loses any of the one before, and how many, by message.

    Keys that begin alike tell their common bits once, and where they part nothing: each loses what the other has.
    What each key has left and loses by depth stands at its ``place`` in ``left`` and ``lost``.
    """
    losing, losses = [], []
    for row, end in _batches(edges):
        own = edges[row : end + 1]
        span = slice(own[0], own[-1])
        own = own - own[0]
        _, _, sole = _beginnings(keys[span], own)
        told = lost.take(place[span], axis=0)[sole]
        some = told > 0
        told, at = told[some], [0]
        for a, b in zip(own.tolist(), own[1:].tolist()):
            at.append(at[-1] + np.count_nonzero(sole[a:b]))
            losing.append(_shrunk(np.packbits(some[at[-2] : at[-1]]).tobytes()))
        losses += _planes(told, np.cumsum([0, *(np.count_nonzero(some[a:b]) for a, b in zip(at, at[1:]))]))
    return _planes(left[place], edges), losing, losses


def _depths(keys: np.ndarray, edges: np.ndarray, left: list[bytes], some: list[bytes], lost: list[bytes]) -> np.ndarray:
    """(17, keys): how often each key's context and its first bits stand, from messages with the losses."""
    left, _ = _all(map(_from_planes, left))
    lost, _ = _all(map(_from_planes, lost))
    depths = np.empty((17, len(keys)), _narrow(int(left.sum(dtype=np.int64) + lost.sum(dtype=np.int64))))
    depths[16] = count = left.astype(depths.dtype)
    parted, levels, sole = _beginnings(keys, edges)
    told = [np.count_nonzero(sole[a:b]) for a, b in zip(edges.tolist(), edges[1:].tolist())]
    losing, _ = _all(np.unpackbits(np.frombuffer(_grown(bits), np.uint8), count=n) for bits, n in zip(some, told))
    each = np.zeros((len(keys), 16), depths.dtype)
    sole[sole] = losing
    each[sole] = lost
    each = np.ascontiguousarray(each.T)
    for depth in range(15, -1, -1):
        at, leads = levels[depth]
        count = _joined_counts(count + each[depth].take(at), leads)
        np.take(count, np.cumsum(parted <= depth) - 1, out=depths[depth], mode="clip")
    return depths


def _from_losses(keys: np.ndarray, left: bytes, some: bytes, lost: bytes) -> np.ndarray:
    """(2 * keys, 9): the counts of one message up to eight bits, and from eight on, as ``Tokens.places`` tells where."""
    depths = _depths(keys, np.array([0, len(keys)]), [left], [some], [lost])
    return np.stack([depths[:9].T, depths[8:].T], axis=1).reshape(-1, 9)


def _joined(*pieces: bytes) -> bytes:
    return struct.pack(f"<{len(pieces)}I", *map(len, pieces)) + b"".join(pieces)


def _parted(data: bytes, pieces: int) -> list[bytes]:
    ends = [*accumulate(struct.unpack_from(f"<{pieces}I", data), initial=4 * pieces)]
    return [data[a:b] for a, b in zip(ends, ends[1:])]


def _steps_packed(values: np.ndarray, edges: np.ndarray, raw: int) -> list[bytes]:
    """Values in order as steps from one to the next: the lowest bytes of each as they are, the others in planes."""
    step = np.diff(values, prepend=np.uint64(0))
    begin = edges[:-1][edges[:-1] < len(values)]
    step[begin] = values[begin]
    low = np.ascontiguousarray(step.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :raw]).tobytes()
    high = _planes(step >> np.uint64(8 * raw), edges)
    return [_joined(low[raw * a : raw * b], each) for a, b, each in zip(edges.tolist(), edges[1:].tolist(), high)]


def _steps_unpacked(data: list[bytes], raw: int) -> tuple[np.ndarray, np.ndarray]:
    pieces = [_parted(each, 2) for each in data if each]
    high, _ = _all(_from_planes(each) for _, each in pieces)
    low = b"".join(each for each, _ in pieces)
    step = np.zeros((len(high), 8), np.uint8)
    step[:, :raw] = np.frombuffer(low, np.uint8).reshape(-1, raw)
    total = np.cumsum(step.view("<u8").reshape(-1) | high.astype(np.uint64) << np.uint64(8 * raw), dtype=np.uint64)
    pieces = iter(pieces)
    sizes = np.array([len(next(pieces)[0]) // raw if each else 0 for each in data], np.int64)
    edges = np.r_[0, np.cumsum(sizes)]
    return total - np.repeat(np.r_[np.uint64(0), total][edges[:-1]], sizes), edges


def _keys_packed(keys: np.ndarray, edges: np.ndarray) -> list[bytes]:
    """Keys of classes: each context once, with how many classes it has and the steps from one to the next."""
    context, kind = keys >> _CONTEXT, (keys >> _SPARE).astype(np.uint16)
    fresh = np.ones(len(keys), bool)
    fresh[1:] = context[1:] != context[:-1]
    fresh[edges[:-1][edges[:-1] < len(keys)]] = True
    start = np.flatnonzero(fresh)
    step = np.where(fresh, kind, np.diff(kind, prepend=np.uint16(0)))
    of = np.searchsorted(start, edges)
    sizes = _planes(np.diff(np.r_[start, len(keys)]), of)
    return [_joined(*each) for each in zip(_steps_packed(context[start], of, 3), sizes, _planes(step, edges))]


def _keys_unpacked(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pieces = [_parted(each, 3) for each in data]
    context, of = _steps_unpacked([each[0] for each in pieces], 3)
    size = _all(_from_planes(each[1]) for each in pieces)[0].astype(np.int64)
    step, edges = _all(_from_planes(each[2]) for each in pieces)
    kind = np.cumsum(step, dtype=np.uint64)
    begin = np.cumsum(size) - size
    if len(begin):
        kind -= np.repeat(np.r_[np.uint64(0), kind[begin[1:] - 1]], size)
    return np.repeat(context, size) << _CONTEXT | kind << _SPARE, edges


def _squeezed(batches):
    """Texts travel compressed."""
    for batch in batches:
        for row in range(0, batch.num_rows, 500):
            rows = batch.slice(row, 500)
            text = rows.column("text").cast(pa.binary()).to_pylist()
            text = pa.array([_CODEC.compress(t, asbytes=True) + len(t).to_bytes(4, "little") for t in text], pa.binary())
            yield rows.set_column(rows.schema.get_field_index("text"), "text", text)


def _text(data: bytes) -> bytes:
    """A text that came compressed, by zlib or by zstd with its size behind; their first bytes differ."""
    if data[:1] == b"\x78":
        return zlib.decompress(data)
    return _CODEC.decompress(data[:-4], int.from_bytes(data[-4:], "little"), asbytes=True)


def _with_texts(table: pa.Table) -> pa.Table:
    """The rows with their texts, in the order in which they are read."""
    text = pa.array([_text(t) for t in table.column("text").to_pylist()], pa.large_binary())
    table = table.set_column(table.schema.get_field_index("text"), "text", text)
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _cut(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part's keys begin in sorted keys."""
    high = (keys >> np.uint64(32)).astype(np.int64)
    return np.searchsorted(high, -(-np.arange(parts + 1) * 2**32 // parts))


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)


def _ask(parts: int, frequent: np.ndarray = np.empty(0, np.uint64)):
    def run(table: pa.Table) -> pa.Table:
        tokens = Tokens(_with_texts(table), frequent)
        cut, edge = _cut(tokens.distinct, parts), _cut(tokens.keys, parts)
        part = np.flatnonzero((cut[1:] > cut[:-1]) | (edge[1:] > edge[:-1]))
        cut, edge = np.r_[cut[part], cut[-1]], np.r_[edge[part], edge[-1]]
        asked = _keys_packed(tokens.keys, edge), _planes(tokens.counts, edge)
        block = np.full(len(part), table.column("block")[0].as_py())
        return _table([block, part, _steps_packed(tokens.distinct, cut, 5), *asked], _ASKED)

    return run


def _by_part(parts: int):
    def run(batches):
        for batch in batches:
            keys, _ = word_hashes(_binary(batch))
            order = np.argsort(keys)
            keys = keys[order]
            counts = batch.column("n").to_numpy(zero_copy_only=False)[order].astype("<i8")
            scores = batch.column("score").to_numpy(zero_copy_only=False)[order].astype("<f8")
            cut = _cut(keys, parts).tolist()
            rows = [
                (p, keys[a:b].tobytes(), counts[a:b].tobytes(), scores[a:b].tobytes())
                for p, (a, b) in enumerate(zip(cut, cut[1:]))
                if b > a
            ]
            if rows:
                kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["part", "keys", "counts", "scores"]
                )

    return run


def _reply(asked: pa.Table, known: pa.Table) -> pa.Table:
    def joined(name: str, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(known.column(name).to_pylist()), kind)

    keys = joined("keys", "<u8")
    order = np.argsort(keys)
    keys, counts, scores = keys[order], joined("counts", "<i8")[order], joined("scores", "<f8")[order]
    stood, _ = _all(_from_planes(n) for n in asked.column("counts").to_pylist())
    classes, edges = _keys_unpacked(asked.column("classes").to_pylist())
    every, total = _added(classes, stood.astype(np.int64))
    taken = _taken(every >> _SPARE, total, 16)
    left, lost = taken[16].copy(), np.empty((len(every), 16), taken.dtype)
    for a in range(0, len(every), _CHUNK):
        lost[a : a + _CHUNK] = (taken[:-1, a : a + _CHUNK] - taken[1:, a : a + _CHUNK]).T
    del taken, total, stood
    told = _losses(classes, edges, np.searchsorted(every, classes), left, lost)
    wanted, cut = _steps_unpacked(asked.column("keys").to_pylist(), 5)
    at = np.searchsorted(keys, wanted)
    counts = counts[at]
    rare = counts < 2  # others are never new
    of = np.r_[0, np.cumsum(rare)][cut].tolist()
    scores = scores[at[rare]].astype("<f4")
    spelled = [scores[a:b].tobytes() for a, b in zip(of, of[1:])]
    return _table([_column(asked, "block"), _column(asked, "part"), _planes(counts, cut), spelled, *told], _REPLY)


_DOC_SQL = "doc_id long, learn long, octets long, tokens long, known long, base double, score double"


def _sum_up(parts: int, ends: int, frequent: np.ndarray):
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        table = _with_texts(table)
        tokens = Tokens(table, frequent)
        told, replies = Told(tokens), replies.sort_by("part")
        counts, scores, *messages = (replies.column(c).to_pylist() for c in _REPLY.names[2:])
        counts = _all(map(_from_planes, counts))[0].astype(np.int64)
        scores, rare = np.zeros(len(counts), np.float32), np.frombuffer(b"".join(scores), "<f4")
        scores[counts < 2] = rare
        edges = np.r_[_cut(tokens.keys, parts)[replies.column("part").to_numpy()], len(tokens.keys)]
        for row, end in _batches(edges):
            span, own = slice(edges[row], edges[end]), edges[row : end + 1] - edges[row]
            told.fill(span.start, _depths(tokens.keys[span], own, *(m[row:end] for m in messages)))
        told.join()
        counts, scores = np.r_[counts, ends], np.r_[scores, np.float32(0)]
        stands, spelled, base = (of.take(tokens.token) for of in (counts, scores, np.log10(counts + 1.0)))
        score = _token_scores(tokens, told, stands, spelled)
        size = np.diff(tokens.first)
        doc = np.repeat(np.arange(len(size)), size)

        def summed(values: np.ndarray) -> np.ndarray:  # text by text: no rounding from its neighbours
            return np.bincount(doc, values, len(size))

        return pa.Table.from_arrays(
            [
                _column(table, "doc_id"),
                _column(table, "learn"),
                pc.binary_length(_column(table, "text")).cast(pa.int64()),
                pa.array(size, pa.int64()),
                pa.array(summed(stands > 0).astype(np.int64), pa.int64()),
                pa.array(summed(base), pa.float64()),
                pa.array(summed(score), pa.float64()),
            ],
            ["doc_id", "learn", "octets", "tokens", "known", "base", "score"],
        )

    return run


def score_documents(docs: DataFrame, learn) -> DataFrame:
    """Base and model scores of all rows, learned from those where ``learn`` holds.

    ``bits_per_byte`` spreads the model's bits over the text's bytes; an empty text has none.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        learn.cast("long").alias("learn"),
    )
    ends = rows.agg(F.sum("learn")).first()[0] or 0
    size = blocks.sizes(rows, BLOCK_BYTES, TEXT_PART_BYTES)
    words = vocabulary(rows, -(-size.parts * TEXT_PART_BYTES // VOCABULARY_BYTES))
    scored = word_scores(words)
    total = words.agg(F.sum("n"), F.sum((F.col("n") > 0).cast("long"))).first()
    tokens, distinct = (total[0] or 0) + ends, (total[1] or 0) + (ends > 0)
    frequent = frequent_tokens(words, ends, tokens, size.parts)
    dealt = blocks.blocked(rows, size).mapInArrow(_squeezed, "doc_id long, text binary, learn long, block long")
    asked = dealt.groupBy("block").applyInArrow(_ask(size.parts, frequent), _ASKED_SQL)
    known = scored.mapInArrow(_by_part(size.parts), _KNOWN_SQL)
    replies = asked.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(_reply, _REPLY_SQL)
    found = dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        _sum_up(size.parts, ends, frequent), _DOC_SQL
    )
    found = written(found, "documents")
    floor = math.log10(tokens + distinct + 1)
    return found.select(
        "doc_id",
        (F.col("learn") == 0).alias("held_out"),
        F.col("tokens").alias("n_tokens"),
        F.col("known").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("tokens") * F.lit(floor)).alias("base_score"),
        "score",
        F.when(F.col("octets") > 0, -F.col("score") * F.lit(math.log2(10)) / F.col("octets")).alias("bits_per_byte"),
    )


def op7_context_mixing(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents; those with checksum remainder 2 are held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score_documents(docs, crc_bucket(F.col("doc_id"), HELD_OUT_MODULUS) != HELD_OUT)


QUERIES = {"op7_context_mixing": op7_context_mixing}
