"""Encoding, packing and token files against the tokenizers library and exact round trips."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_cases import TEXTS
from evalflow.llm import bpe, packing, tokenfiles
from evalflow.llm.common import fresh_folder

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def odd_texts(n=600):
    pick = random.Random(5)
    ranges = [(32, 127), (128, 592), (0, 12288), (0, 131071)]
    out = ["", " ", "  a  b ", "a <|endoftext|><|startoftext|> b", "'S 'T 'LL it's", "x" * 3000, "aaaa " * 40, "a\x1cb\x85c\xa0d"]
    for _ in range(n):
        chars = [chr(pick.randrange(*pick.choice(ranges))) for _ in range(pick.randrange(25))]
        out.append("".join(chars).encode("utf-8", "ignore").decode())
    return out


def test_word_encoder_equals_library(monkeypatch):
    library, texts = Tokenizer.from_file(WORD), odd_texts()
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    ours = bpe.WordEncoder(WORD)
    ids = ours.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == expected
    assert ours.decode(ids) == library.decode_batch(expected, skip_special_tokens=False)
    monkeypatch.setattr(bpe, "KEPT_CHUNKS", 50)  # whatever is kept
    small = bpe.WordEncoder(WORD)
    assert [small.encode([t])[0] for t in texts] == ids


def test_merges_out_of_order_are_refused():
    signs = {s: i for i, s in enumerate(bpe.byte_symbols())}
    with pytest.raises(ValueError):
        bpe.MergeRules(signs | {"abc": 256, "bc": 257}, [["a", "bc"], ["b", "c"]])


def test_round_trip_rows(odd_docs, no_docs):
    library = Tokenizer.from_file(WORD)
    rows = bpe.decode(bpe.encode(odd_docs, WORD), WORD).collect()
    assert len(rows) == len(TEXTS)
    expected = sorted((str(i), library.encode(t or "", add_special_tokens=False).ids) for i, t in TEXTS)
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in rows) == expected
    assert bpe.encode(no_docs, WORD).count() == 0


def pieces_by_hand():
    library = Tokenizer.from_file(WORD)
    for i, t in TEXTS:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            yield i, k, at, len(part), zlib.crc32(part.tobytes())


def check_packing(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packing(odd_docs, no_docs):
    rows = packing.pack(packing.pieces(odd_docs, WORD)).collect()
    key = lambda x: tuple(map(str, x))
    ours = sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key)
    assert ours == sorted(pieces_by_hand(), key=key)
    total = sum(r.length for r in rows)
    assert check_packing(rows, 4096) <= -(-total // 4096) + 1
    assert packing.pack(packing.pieces(no_docs, WORD)).count() == 0


def test_packing_many_groups(spark):
    sizes = np.random.default_rng(3).integers(1, 65, 5000).tolist()
    cut = spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate(sizes)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = packing.pack(cut, capacity=64, group_pieces=500).collect()
    assert sorted(r.doc_id for r in rows) == list(range(5000))
    assert check_packing(rows, 64) <= 1.02 * sum(sizes) / 64 + 2


def test_leftovers_are_packed_the_better_way():
    """Whatever pieces a group gets: what is open after it is packed closely once more."""
    for seed in range(20):
        sizes = np.random.default_rng(100 + seed).integers(1, 65, 500)
        pieces = pd.DataFrame({"doc_id": range(500), "piece": 0, "ids_crc32": 0, "length": sizes, "again": 0})
        pieces["sequence_id"], pieces["offset"] = pieces["doc_id"], 0
        packed = packing._pack_again(64)(pieces)
        assert sorted(packed.doc_id) == list(range(500))
        assert check_packing(packed.itertuples(), 64) <= 1.05 * sizes.sum() / 64 + 2


def test_equal_rows_do_not_meet_in_one_group(spark):
    row = (None, 0, 0, 1, 7)
    cut = spark.createDataFrame([row] * 4000, "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = packing.pack(cut, capacity=64, group_pieces=500).collect()
    groups = Counter(r.sequence_id >> 32 for r in rows)
    assert len(rows) == 4000 and max(groups.values()) < 1000
    assert check_packing(rows, 64) <= 4000 // 64 + 2


def test_place_minimises_squares():
    """Every placement leaves the least sum of squared counts of open gaps, by trying all."""
    capacity, sizes = 12, np.random.default_rng(1).integers(1, 13, 300)
    sequence, offset = packing.place(sizes, capacity)
    fill = {}

    def squares(f):
        gaps = [capacity - x for x in f.values() if x < capacity]
        return sum(gaps.count(g) ** 2 for g in set(gaps))

    for size, s, at in zip(sizes.tolist(), sequence.tolist(), offset.tolist()):
        options = [squares(fill | {k: v + size}) for k, v in fill.items() if v + size <= capacity]
        options.append(squares(fill | {"new": size}))
        assert fill.get(s, 0) == at
        fill[s] = at + size
        assert squares(fill) == min(options)


def test_block_round_trip():
    order = np.random.default_rng(2)
    ids = np.minimum(order.zipf(1.3, 30000), 5000) - 1
    frequency = tokenfiles.scaled(np.bincount(ids, minlength=5001))
    assert frequency.sum() == 1 << tokenfiles.SCALE_BITS and (frequency > 0).sum() == len(set(ids.tolist()))
    tables = tokenfiles.Tables(frequency)
    for part in (ids, ids[:1], ids[:1023], ids[:1025]):
        state, words = tokenfiles.encode_block(part, tables)
        assert (tokenfiles.decode_block(state, words, len(part), tables) == part).all()
    state, words = tokenfiles.encode_block(ids, tables)
    share = np.bincount(ids) / len(ids)
    best = -(share[share > 0] * np.log2(share[share > 0])).sum() * len(ids) / 8
    assert 4 * len(words) < 1.03 * best


def test_token_files(spark, odd_docs, no_docs):
    library = Tokenizer.from_file(BYTE)
    folder = fresh_folder(spark, "tokens")
    files = tokenfiles.write_token_files(odd_docs, folder, BYTE, block_tokens=50)
    rows = tokenfiles.read_token_files(files, folder, with_ids=True).orderBy("start").collect()
    ordered = sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    start = 0
    assert len(rows) == len(ordered)
    for r, (i, t) in zip(rows, ordered):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        assert r.ids == ids.tobytes()
        start += len(ids)
    empty = fresh_folder(spark, "tokens")
    assert tokenfiles.read_token_files(tokenfiles.write_token_files(no_docs, empty, BYTE), empty).count() == 0


def test_byte_encoder_equals_library():
    library, texts = Tokenizer.from_file(BYTE), odd_texts()
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in tokenfiles.ByteEncoder(BYTE).encode(texts)] == expected


def test_damaged_block_is_noticed(spark, odd_docs):
    folder = fresh_folder(spark, "tokens")
    files = tokenfiles.write_token_files(odd_docs, folder, BYTE)
    path = files.first()["path"].removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    data[60] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="damaged"):
        tokenfiles.read_token_files(files, folder).collect()


def test_op3_digests(spark, tmp_path, odd_docs):
    odd_docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    library = Tokenizer.from_file(WORD)
    for r in bpe.op3_bpe_round_trip(spark, str(tmp_path)).filter("doc_id = 6").collect():
        ids = library.encode(dict(TEXTS)[6], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
