"""Quality rules, near copies, fingerprints and scores against brute force."""

import gzip
import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter
from types import SimpleNamespace

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from compare import difference
from evalflow.llm import editprint, hashing, jaccard, mixing, rules, toxicity, warc
from evalflow.llm.common import crc_bucket
from evalflow.llm.components import components
from llm_cases import TEXTS

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def table(docs, tmp_path, name="documents"):
    path = f"{tmp_path}/{name}.parquet"
    docs.write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/*.parquet'")
    return con


# -- quality rules


def junk():
    pick = random.Random(2)
    word = lambda: "".join(pick.choice("abcdefghij") for _ in range(pick.randrange(2, 9)))
    good = [" ".join(word() for _ in range(120)) for _ in range(4)]
    lines = [" ".join(word() for _ in range(8)) for _ in range(12)]
    return [
        *good,
        " ".join(w + "***" for w in good[0].split()),
        " ".join(w.upper() + "!!" for w in good[1].split()),
        "\n".join(lines + lines[:9]),  # many lines again
        "Der " * 300,
        " ".join(["a b c", *good[2].split()[:60], "a b c", "b c a b c"]),
        "1 2 3 " * 30 + good[3],
        "x" * 4000 + " " + good[3],
        "\x0b".join(good[0].split()[:55]) + " y",
    ]


def test_quality_counts(spark, tmp_path, odd_docs, no_docs):
    rows = [(100 + i, t) for i, t in enumerate(junk())]
    docs = odd_docs.select("doc_id", "text").filter("doc_id is not null").distinct()
    docs = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    con = table(docs, tmp_path)
    bad, (ours, theirs, _, _) = difference(
        spark, con, rules.op10_quality_rules, rules.SQL["op10_quality_rules"], str(tmp_path)
    )
    assert bad is None and ours == theirs > 0
    verdicts = {r.doc_id: r.kept for r in rules.quality_counts(docs).collect()}
    assert [verdicts[100 + i] for i in range(4)] == [True] * 4
    assert not any(verdicts[100 + i] for i in range(4, 8))
    assert rules.quality_counts(no_docs).count() == rules.filter_documents(no_docs).count() == 0


def test_cascade_order_never_changes_a_verdict(spark, odd_docs):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*junk(), None])], "doc_id long, text string")
    found = {r.doc_id for r in rules.filter_documents(docs).collect()}
    for order in (rules.RULES, rules.RULES[::-1]):
        kept = docs.filter(rules.verdict(F.coalesce("text", F.lit("")), order))
        assert {r.doc_id for r in kept.collect()} == found
    assert found == {r.doc_id for r in rules.quality_counts(docs).filter("kept").collect()}
    assert rules.filter_documents(odd_docs).columns == odd_docs.columns


def test_no_python_in_the_plan(odd_docs):
    plan = rules.quality_counts(odd_docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# -- near copies


def near_texts():
    """Families of edited copies, sharing passages across families."""
    pick = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    common = [pick.choice(vocabulary) for _ in range(60)]
    texts = []
    for family in range(12):
        base = [pick.choice(vocabulary) for _ in range(pick.randrange(5, 160))] + common[: pick.randrange(60)]
        for _ in range(pick.choice([1, 2, 5, 30])):
            words = list(base)
            for _ in range(pick.randrange(4)):
                words[pick.randrange(len(words))] = pick.choice(vocabulary)
            texts.append(" ".join(words))
    return texts + texts[:9] + ["", None, "a b", "A  b", "lone"]


def brute_components(rows, words=5):
    sets = {}
    for i, t in rows:
        w = [x.lower() for x in (t or "").encode().split()]
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()}
    name, links = {i: i for i in sets}, dict.fromkeys(sets, 0)
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = sorted((name[a], name[b]))
                name = {k: x if v == y else v for k, v in name.items()}
    return {i: (len(sets[i]), name[i], links[i]) for i in sets}


@pytest.mark.parametrize("chunk, shingles", [(4000, 10**9), (7, 10**9), (4000, 500)])
def test_near_duplicates(spark, chunk, shingles):
    """Components, and every link, also between documents that other links connect already."""
    texts = near_texts()
    ids = random.Random(1).sample(range(10_000), len(texts))
    rows = list(zip(ids, texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.near_duplicates(docs, chunk_classes=chunk, chunk_shingles=shingles).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in found} == brute_components(rows)
    assert max(r.n_links for r in found) > 20


def test_row_without_id_connects(spark):
    """A text without an id links two others, which are not similar themselves."""
    word = [f"w{i}" for i in range(104)]
    ends = [["a"] * 14 + word[14:], word[:90] + ["b"] * 14]
    rows = [(7, " ".join(ends[0])), (None, " ".join(word)), (9, " ".join(ends[1]))]
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id, r.n_links) for r in found) == [(0, 7, 2), (7, 7, 1), (9, 7, 1)]


def test_near_duplicate_sql(spark, tmp_path, odd_docs, no_docs):
    docs = odd_docs.filter("doc_id is not null").select("doc_id", "text").distinct()
    con = table(docs, tmp_path)
    bad, _ = difference(spark, con, jaccard.op1_ngram_jaccard_join, jaccard.SQL["op1_ngram_jaccard_join"], str(tmp_path))
    assert bad is None
    rows = jaccard.near_duplicates(odd_docs).collect()
    assert len(rows) == len(TEXTS)
    assert {r.component_id for r in rows if r.doc_id in (1, 5, 9)} == {1}
    assert jaccard.near_duplicates(no_docs).count() == 0
    kept = jaccard.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 2, 3, 4, 6, 7, 8]
    assert kept.filter("doc_id is null").count() == 1


def test_components(spark):
    pick = random.Random(3)
    links = [(pick.randrange(300), pick.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1040)]
    name = {x: x for p in links for x in p}
    for a, b in links:
        x, y = sorted((name[a], name[b]))
        name = {k: x if v == y else v for k, v in name.items()}
    loose = {x for x in name if all(x not in p or p[0] == p[1] for p in links)}
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {k: v for k, v in name.items() if k not in loose}


def test_word_hashes():
    texts = [t or "" for _, t in TEXTS] + ["\x0b\x0ca b", "ß SS ss"]
    hashes, first = hashing.word_hashes(pa.array(texts))
    seen = {}
    for i, t in enumerate(texts):
        words = [w.lower() for w in t.encode().split()]
        assert first[i + 1] - first[i] == len(words)
        for w, h in zip(words, hashes[first[i] : first[i + 1]].tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    words, counts = hashing.distinct_words(pa.array(texts), np.arange(len(texts)))
    expected = Counter()
    for i, t in enumerate(texts):
        for w in t.encode().split():
            expected[w.lower()] += i
    assert dict(zip(words.to_pylist(), counts.tolist())) == dict(expected)


# -- fingerprints


def test_edited_fingerprints(spark, odd_docs, no_docs):
    rows = editprint.edited_fingerprints(odd_docs).collect()
    ordered = sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    expected = Counter()
    for k, (i, t) in enumerate(ordered):
        t, after = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        edited = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        a, b, c = (editprint.fingerprint(x) for x in (t, edited, after))
        digest = hashlib.sha256(edited.encode()).hexdigest()
        expected[(i, len(t), digest, a, b, editprint.likeness(a, b), editprint.likeness(a, c))] += 1
    found = Counter(
        (r.doc_id, r.n_chars, r.edited_sha256, bytes(r.fingerprint), bytes(r.edited_fingerprint), r.near_edited, r.near_next)
        for r in rows
    )
    assert found == expected
    assert editprint.edited_fingerprints(no_docs).count() == 0
    one = editprint.edited_fingerprints(odd_docs.filter("doc_id = 7")).first()
    assert one.near_next == 1.0


def test_fewer_edits_are_nearer():
    pick = random.Random(6)
    text = "".join(pick.choice("abcdefgh ijklm nopq") for _ in range(4000))
    near = []
    for edits in (0, 2, 20, 400):
        new = list(text)
        for _ in range(edits):
            at = pick.randrange(len(new))
            new[at : at + 1] = pick.choice([[], ["x"], ["y", new[at]]])
        near.append(editprint.likeness(editprint.fingerprint(text), editprint.fingerprint("".join(new))))
    assert near[0] == 1.0 and near == sorted(near, reverse=True) and near[1] > 0.7 and near[3] < 0.4


@pytest.mark.parametrize("full", [10_000, 20])
def test_search_at_its_own_threshold(spark, monkeypatch, full):
    """Of pairs with just half of their slots equal nearly all are found, also in split bands."""
    monkeypatch.setattr(editprint, "BAND_PRINTS", full, raising=False)
    pick = random.Random(6)
    asked, filed = [], []
    for _ in range(300):
        one = bytearray([7, 7, 7, 7, *(pick.randrange(256) for _ in range(editprint.SLOTS - 4))])
        two = bytearray(one)
        for at in pick.sample(range(editprint.SLOTS), editprint.SLOTS // 2):
            two[at] ^= 1 + pick.randrange(255)
        asked.append((bytes(one),))
        filed.append((bytes(two),))
    found = editprint.search(*(spark.createDataFrame(x, "fingerprint binary") for x in (asked, filed))).collect()
    pairs = [(bytes(r.query), bytes(r.fingerprint)) for r in found]
    assert len(pairs) == len(set(pairs))
    assert sum((a, b) in set(pairs) for (a,), (b,) in zip(asked, filed)) >= 290


def test_search_finds_like_fingerprints(spark):
    pick = random.Random(9)
    texts = ["".join(pick.choice("abcdefgh ijk") for _ in range(600)) for _ in range(60)]
    texts += [t[:550] + "zz" + t[552:] for t in texts[:40]] + texts[:5]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    prints = editprint.fingerprints(docs).cache()
    pairs = {(bytes(r.query), bytes(r.fingerprint)) for r in editprint.search(prints.filter("doc_id % 20 = 0"), prints).collect()}
    marks = [editprint.fingerprint(t) for t in texts]
    wanted = {(q, m) for q in marks[::20] for m in marks if editprint.likeness(q, m) >= 0.5}
    assert len(pairs & wanted) >= 0.9 * len(wanted) and pairs <= wanted


# -- toxicity


def toxic_docs(spark, n=500):
    pick = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{pick.randrange(300)}" for _ in range(60)]
        insult, group = pick.random() < 0.5, pick.random() < 0.5
        words += ["blockhead"] * insult + ["villagers"] * group
        pick.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(insult and group)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_pairs_of_terms_are_learned(spark):
    """Neither term is toxic alone: only the pair is."""
    docs, labels = toxic_docs(spark)
    machine = toxicity.learn_model(docs, labels, toxicity.not_held_out())
    rows = toxicity.scored(docs, machine).join(labels, "doc_id").filter(~toxicity.not_held_out()).collect()
    assert sum((r.score >= 0.5) == (r.toxic == 1) for r in rows) >= 0.93 * len(rows)


def test_toxicity_odd_rows(odd_docs, no_docs, spark):
    docs, labels = toxic_docs(spark, 200)
    machine = toxicity.learn_model(docs, labels.unionByName(labels.limit(5)), F.lit(True))
    rows = toxicity.scored(odd_docs, machine).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3, 4)}) == 1
    assert toxicity.scored(no_docs, machine).count() == 0
    kept = toxicity.filter_documents(odd_docs, machine)
    assert kept.columns == odd_docs.columns
    none = toxicity.learn_model(odd_docs, labels.filter("toxic > 5"), F.lit(True))
    assert {round(r.score, 6) for r in toxicity.scored(odd_docs, none).collect()} == {0.0}


# -- scores


def test_base_score_and_model(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(mixing.blocks, "BLOCK_BYTES", 2000)
    learn = crc_bucket(F.col("doc_id"), 7) != 2
    rows = mixing.score_documents(odd_docs, learn).collect()
    words = lambda t: [w.lower() for w in (t or "").encode().split()]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    count = Counter(w for i, t in TEXTS if not held(i) for w in words(t))
    ends = sum(not held(i) for i, _ in TEXTS)
    tokens, distinct = sum(count.values()) + ends, len(count) + 1
    expected = Counter()
    for i, t in TEXTS:
        base = sum(math.log10((count[w] + 1) / (tokens + distinct + 1)) for w in words(t))
        base += math.log10((ends + 1) / (tokens + distinct + 1))
        known = sum(w in count for w in words(t)) + 1
        expected[(i, held(i), len(words(t)) + 1, known, tokens, round(base, 6))] += 1
    found = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    assert found == expected
    assert all(r.score < 0 for r in rows)
    assert mixing.score_documents(no_docs, learn).count() == 0


def test_word_scores_are_probabilities(spark):
    """All words of two letters and longer ones share what is left: sums stay below one."""
    texts = [(i, "ab ab ab ba abc " * 5) for i in range(30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("learn", F.lit(1))
    known = mixing.vocabulary(docs)
    every = [bytes([a]) + bytes([b]) for a in range(97, 123) for b in range(97, 123)]
    unseen = spark.createDataFrame([(w, 0) for w in every if w not in (b"ab", b"ba")], "word binary, n long")
    rows = mixing.word_scores(known.unionByName(unseen)).collect()
    score = {bytes(r.word): 10**r.score for r in rows}
    assert sum(score.values()) < 1
    assert score[b"ab"] > score[b"ba"] > score[b"zz"]


def test_context_counts_are_whole_numbers_over_all_blocks(spark):
    """Counts past what 24 and 32 bits hold stay exact, and every context has its own entry."""
    pick = random.Random(3)
    words = {"".join(pick.choice("abcd") for _ in range(pick.randrange(1, 7))).encode(): pick.randrange(5) for _ in range(400)}
    words |= {b"aa": 2**24 + 1, b"ab": 1, b"zz": 2**33 + 3, b"zy": 1, "é".encode(): 2}
    expected = Counter()
    for word, n in words.items():
        spelled = word + b" "
        for i in range(len(spelled)):
            for k in range(1, 5):
                expected[k, spelled[max(0, i - k) : i].rjust(k, b"\0"), spelled[i]] += n
            expected[5, spelled[:i], spelled[i]] += n
    names = {}
    for word in words:
        spelled = word + b" "
        for k, keys in enumerate(mixing.Bits(pa.array([word], pa.binary())).keys, 1):
            for i, key in enumerate(keys.tolist()):
                context = spelled[:i] if k == 5 else spelled[max(0, i - k) : i].rjust(k, b"\0")
                assert names.setdefault((k, context, spelled[i]), key) == key
    assert len(set(names.values())) == len(names) == len(expected)
    rows = spark.createDataFrame([(i % 3, w, n) for i, (w, n) in enumerate(words.items())], "block long, word binary, n long")
    told = mixing.context_counts(rows, 4).toArrow()
    for block in range(3):
        contexts = [pair for pair in mixing._context_arrays(told.filter(pc.equal(told.column("block"), block)))]
        found = dict(zip(np.concatenate([k for k, _ in contexts]).tolist(), np.concatenate([n for _, n in contexts]).tolist()))
        mine = {w for i, w in enumerate(words) if i % 3 == block}
        wanted = {key >> 8 for w in mine for keys in mixing.Bits(pa.array([w], pa.binary())).keys for key in keys.tolist()}
        assert found == {names[x]: n for x, n in expected.items() if names[x] >> 8 in wanted}


def test_word_scores_do_not_depend_on_blocks_being_small(spark, monkeypatch):
    """A word that only one block holds is scored with what all blocks counted."""
    monkeypatch.setattr(mixing, "WORD_BYTES", 40)
    monkeypatch.setattr(mixing, "PART_BYTES", 60)
    rows = [(f"w{i:03d}".encode(), 50) for i in range(60)] + [(b"w06", 0), (b"q06", 0)]
    score = {bytes(r.word): r.score for r in mixing.word_scores(spark.createDataFrame(rows, "word binary, n long")).collect()}
    assert len(score) == 62 and score[b"w06"] > score[b"q06"] + 1


def test_order_of_words_and_second_copies_count(spark, monkeypatch):
    """The base score is the same for any order of the words, and a learned text that stands twice is likelier."""
    monkeypatch.setattr(mixing, "BLOCK_BYTES", 3000)
    pick = random.Random(6)
    chain = lambda n: [f"w{(n + i) % 40}" for i in range(30)]
    own = lambda: ["".join(pick.choice("abcdefgh") for _ in range(6)) for _ in range(30)]
    texts = {i: chain(pick.randrange(40)) for i in range(150)} | {i: own() for i in range(150, 200)}
    texts[199] = texts[198]
    texts[1000] = chain(7)
    texts[1001] = texts[1000][::-1]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    rows = {r.doc_id: r for r in mixing.score_documents(docs, F.col("doc_id") < 1000).collect()}
    assert math.isclose(rows[1000].base_score, rows[1001].base_score)
    assert rows[1000].score > rows[1001].score + 20
    once = [rows[i].bits_per_byte for i in range(150, 198)]
    assert max(rows[198].bits_per_byte, rows[199].bits_per_byte) < 0.6 * min(once)


def test_class_counts_are_whole_numbers_over_all_blocks():
    """Each token is told how often its class stands, alone and behind the token before, in all blocks."""
    pick = random.Random(8)
    blocks, expected = [], Counter()
    for block in range(3):
        texts = [" ".join(pick.choice("abcdefghijkl") for _ in range(pick.randrange(30))) for _ in range(9)]
        packed = [zlib.compress(t.encode()) for t in texts]
        learn = [1, 1, 0] * 3
        columns = [pa.array([block] * 9), pa.array(range(9)), pa.array(packed, pa.binary()), pa.array(learn)]
        blocks.append(pa.Table.from_arrays(columns, ["block", "doc_id", "text", "learn"]))
        for text, learned in zip(texts, learn):
            words = ["", *text.split(), ""]
            expected.update([w for w in words[1:] if learned])
            expected.update([p for p in zip(words, words[1:]) if learned])
    asked = pa.concat_tables([mixing._ask(4)(b) for b in blocks])
    known = pa.table({"part": pa.array([], pa.int32()), **{c: pa.array([], pa.binary()) for c in ("keys", "counts", "scores")}})
    asked = asked.set_column(2, "keys", pa.array([b""] * asked.num_rows, pa.binary()))
    replies = [r for p in range(4) for r in mixing._reply(asked.filter(pc.equal(asked.column("part"), p)), known).to_pylist()]
    for number, block in enumerate(blocks):
        table = mixing._with_texts(block)
        tokens = mixing.Tokens(table)
        mine = sorted((r for r in replies if r["block"] == number), key=lambda r: r["part"])
        keys = np.split(tokens.keys, mixing._cut(tokens.keys, 4)[1:-1])
        told = [(keys[r["part"]], r["left"], r["some"], r["lost"]) for r in mine]
        taken = np.concatenate([mixing._from_losses(*t) for t in told])
        words = [w for t in table.column("text").to_pylist() for w in ["", *t.decode().split()]][1:] + [""]
        before = ["", *words[:-1]]
        assert taken[tokens.places[1], 8].tolist() == [expected[w] for w in words]
        assert taken[tokens.places[3], 8].tolist() == [expected[p] for p in zip(before, words)]
        assert (taken[tokens.places[3], 0] == taken[tokens.places[2], 8]).all()
        total = sum(n for w, n in expected.items() if isinstance(w, str))
        assert (taken[tokens.places[0], 0] == total).all()


@pytest.mark.parametrize("often", [0, 5])
def test_class_counts_travel_once(often):
    """Contexts are asked once with their classes, and bits that follow from other classes asked for are not told."""
    pick = random.Random(4)
    words = ["".join(pick.choice("abcdefgh") for _ in range(5)) for _ in range(3000)]
    texts = [[words[min(int(pick.paretovariate(0.6)), 3000) - 1] for _ in range(400)] for _ in range(240)]
    word, *_ = mixing.word_hashes(pa.array(words, pa.binary()))
    kind = {w: h >> 48 for w, h in zip(words, word.tolist())} | {"": int(mixing.END) >> 48}
    before_and_class = lambda t: [(a, kind[b]) for a, b in zip(["", *t], [*t, ""])]
    expected = Counter(pair for t in texts for pair in before_and_class(t))
    frequent = np.sort(np.r_[word[:often], mixing.END])[: often and often + 1]
    packed = [zlib.compress(" ".join(t).encode()) for t in texts]
    columns = [pa.array(range(240)), pa.array(packed, pa.binary()), pa.array([1] * 240)]
    table = pa.Table.from_arrays(columns, ["doc_id", "text", "learn"])
    blocks = [table.slice(80 * b, 80).append_column("block", pa.array([b] * 80)) for b in range(3)]
    known = pa.table({"part": pa.array([], pa.int32()), **{c: pa.array([], pa.binary()) for c in ("keys", "counts", "scores")}})
    asked = pa.concat_tables([mixing._ask(2, *([frequent] if often else []))(b) for b in blocks])
    asked = asked.set_column(2, "keys", pa.array([b""] * asked.num_rows, pa.binary()))
    replies = pa.concat_tables([mixing._reply(asked.filter(pc.equal(asked.column("part"), p)), known) for p in range(2)])
    size = lambda t, names: sum(pc.sum(pc.binary_length(t.column(c))).as_py() for c in names)
    assert size(asked, ("classes", "counts")) < 0.9 * 240 * 401
    assert size(replies, ("left", "some", "lost")) < 0.45 * 240 * 401
    for number, block in enumerate(blocks):
        tokens = mixing.Tokens(mixing._with_texts(block), *([frequent] if often else []))
        keys = np.split(tokens.keys, mixing._cut(tokens.keys, 2)[1:-1])
        mine = sorted((r for r in replies.to_pylist() if r["block"] == number), key=lambda r: r["part"])
        taken = np.concatenate([mixing._from_losses(keys[r["part"]], r["left"], r["some"], r["lost"]) for r in mine])
        pairs = [p for t in texts[80 * number : 80 * number + 80] for p in before_and_class(t)]
        assert taken[tokens.places[3], 8].tolist() == [expected[p] for p in pairs]
        before = Counter(a for a, _ in expected.elements())
        assert taken[tokens.places[2], 0].tolist() == [before[a] for a, _ in pairs]


def _small_block():
    """A block of texts, and what its words are known to be."""
    pick = random.Random(12)
    some = ["a", "bb", *("".join(pick.choice("abcdefgh") for _ in range(3)) for _ in range(300))]
    texts = [" ".join(some[min(int(pick.paretovariate(0.7)), 302) - 1] for _ in range(60)) for _ in range(40)]
    packed = [zlib.compress(t.encode()) for t in texts]
    columns = [pa.array([0] * 40), pa.array(range(40)), pa.array(packed, pa.binary()), pa.array([1, 1, 1, 0] * 10)]
    block = pa.Table.from_arrays(columns, ["block", "doc_id", "text", "learn"])
    count = Counter(w for t, learned in zip(texts, [1, 1, 1, 0] * 10) for w in t.split() if learned)
    words = sorted({w for t in texts for w in t.split()})
    scores = pa.array([-1.5 - i for i in range(len(words))])
    known = pa.RecordBatch.from_arrays(
        [pa.array([w.encode() for w in words], pa.binary()), pa.array([count[w] for w in words]), scores], ["word", "n", "score"]
    )
    return block, known


def _scored(block, known, parts, frequent):
    """The block's scores by way of that many parts, and how many calls were made for it."""
    calls = Counter()
    watch = lambda _, event, called: calls.update([event in ("call", "c_call")])
    dealt = pa.Table.from_batches([*mixing._by_part(parts)([known])])
    sys.setprofile(watch)
    try:
        asked = mixing._ask(parts, frequent)(block)
        own = [pc.equal(t.column("part"), p) for p in range(parts) for t in (asked, dealt)]
        sys.setprofile(None)
        pairs = [(asked.filter(a), dealt.filter(d)) for a, d in zip(own[::2], own[1::2])]
        replies = pa.concat_tables([mixing._reply(*pair) for pair in pairs if pair[0].num_rows])
        sys.setprofile(watch)
        found = mixing._sum_up(parts, 30, frequent)(block, replies)
    finally:
        sys.setprofile(None)
    return found, calls[True], replies.num_rows


def test_scores_do_not_depend_on_parts_and_small_messages_are_read_together():
    """The messages of a block are as many as parts: what is done for each must not be what is done for a block."""
    block, known = _small_block()
    hashes, _ = mixing.word_hashes(pa.array([b"a", b"bb"], pa.binary()))
    for frequent in (np.empty(0, np.uint64), np.sort(np.r_[hashes, mixing.END])):
        one, few, _ = _scored(block, known, 1, frequent)
        many, more, messages = _scored(block, known, 500, frequent)
        assert messages > 200
        assert one.equals(many)
        assert more - few < 120 * messages


def test_one_reply_serves_many_small_blocks():
    """A part is asked by as many blocks as the corpus has: their messages are answered together."""
    block, known = _small_block()
    dealt = pa.Table.from_batches([*mixing._by_part(1)([known])])
    rows = [mixing._ask(1)(block.slice(i % 40, 1).set_column(0, "block", pa.array([i]))) for i in range(200)]
    made = []
    for asked in (rows[0], pa.concat_tables(rows)):
        calls = Counter()
        sys.setprofile(lambda _, event, called: calls.update([event in ("call", "c_call")]))
        try:
            replies = mixing._reply(asked, dealt)
        finally:
            sys.setprofile(None)
        made.append(calls[True])
    assert replies.column("block").to_pylist() == list(range(200))
    assert made[1] - made[0] < 199 * 120


def test_mixing_by_hand():
    """Weights by gate, the map of each and its bits, one after the other in plain Python."""
    pick = np.random.default_rng(4)
    n, gates = 5000, 3
    odds = pick.normal(size=(2, n)).astype(np.float32) * 3
    gate, bit = pick.integers(0, gates, n), pick.integers(0, 2, n)
    weight = (pick.random(n) < 0.8).astype(np.float32)
    mixer = mixing.Mixer(np.full((gates, 2), 0.4), gates, 0.5)
    weights = np.full((gates, 2), 0.4)
    hits = {(g, s): 20 / (1 + math.exp(8 - s / 2)) for g in range(gates) for s in range(33)}
    seen = dict.fromkeys(hits, 20.0)
    for at in (slice(0, 2000), slice(2000, 2001), slice(2001, n)):  # a step learns behind all that it predicts
        begin = 33 * (gate + gates * bit)
        found = mixer.log10(odds[:, at], gate[at], begin[at], bit[at].astype(np.float32), weight[at])
        wrong, share, came = np.zeros((gates, 2)), np.zeros(gates), []
        for x, g, b, w, log in zip(odds[:, at].T, gate[at].tolist(), bit[at].tolist(), weight[at].tolist(), found.tolist()):
            total = float(x @ weights[g])
            mixed, step = 1 / (1 + math.exp(-min(12, max(-12, total)))), min(32, max(0, round((total + 8) * 2)))
            p = (mixed + hits[g, step] / seen[g, step]) / 2
            assert math.isclose(log, math.log10(p if b else 1 - p), rel_tol=1e-2, abs_tol=1e-3)
            wrong[g] += w * (b - mixed) * x
            share[g] += w
            came.append((g, step, b * w, w))
        weights += 0.5 * wrong / np.maximum(share, 1)[:, None]
        for g, step, b, w in came:
            hits[g, step] += b
            seen[g, step] += w
    assert np.allclose(mixer.weights.T, weights, rtol=1e-3)
    assert abs(mixer.seen.sum() - sum(seen.values())) < 1e-6


def test_vocabulary_is_added_up_by_parts(spark):
    """Batches hand on their words packed, a row for each part; equal words of different batches meet."""
    pick = random.Random(2)
    texts = [(" ".join(pick.choice(["Ab", "c", "ü", "x" * 300, "d\te"]) for _ in range(pick.randrange(9))), i % 3 > 0) for i in range(90)]
    rows = spark.createDataFrame([(t, int(n)) for t, n in texts], "text string, learn int").repartition(7)
    expected = Counter()
    for text, learned in texts:
        for word in text.encode().split():
            expected[word.lower()] += learned
    for parts in (1, 5, 300):
        found = [(bytes(r.word), r.n) for r in mixing.vocabulary(rows, parts).collect()]
        assert len(found) == len(expected) and dict(found) == expected
    packed = [b for b in mixing._distinct(300)(pa.table({"text": [t for t, _ in texts], "learn": [1] * 90}).to_batches())]
    assert 0 < sum(b.num_rows for b in packed) <= len(expected)
    assert mixing.vocabulary(rows.limit(0), 3).count() == 0


def test_frequent_tokens_are_those_of_a_parts_share(spark):
    words = spark.createDataFrame([(b"the", 50), (b"of", 25), (b"rare", 5), (b"unseen", 0)], "word binary, n long")
    hashes, _ = mixing.word_hashes(pa.array([b"the", b"of"], pa.binary()))
    assert mixing.frequent_tokens(words, 20, 100, 4).tolist() == hashes[:1].tolist()
    assert mixing.frequent_tokens(words, 20, 100, 6).tolist() == sorted([*hashes.tolist(), int(mixing.END)])
    assert len(mixing.frequent_tokens(words.limit(0), 0, 0, 4)) == 0


# -- archives


@pytest.mark.parametrize("size", [64 << 20, 3000])
def test_archives(spark, tmp_path, size):
    pick = random.Random(5)
    long = ["<p>" + "".join(pick.choice("abcé ") for _ in range(1500)) + "</p>" for _ in range(5)]
    rows = [(i, f"http://x.example/{i}?q=ä b", pick.choice([*long, "short", "", None]), 7) for i in range(60)]
    rows += [(3, None, long[0], 7), (3, None, long[0], 7)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    files = warc.write_archives(pages, f"file://{tmp_path}/warc{size}", archive_bytes=size)
    con = table(pages, tmp_path, "pages")
    expected = Counter(con.execute(warc.SQL["op5_warc"]).fetchall())
    for range_bytes in (1 << 20, 777):
        found = warc.read_archives(files, range_bytes=range_bytes).collect()
        assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == expected
        by_digest = {hashlib.sha1((h or "").encode()).hexdigest(): (h or "").encode() for _, _, h, _ in rows}
        assert all(bytes(r.payload) == by_digest[r.payload_digest] for r in found if r.record_type == "response")
    assert warc.read_archives(warc.write_archives(pages.limit(0), f"file://{tmp_path}/none")).count() == 0


def test_repeated_write_replaces_nothing(tmp_path, monkeypatch):
    """Two attempts of a task with its rows in another order: the listing of either reads back whole."""
    monkeypatch.setattr(warc, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    names = ["page_id", "url", "html", "digest", "refers_to"]
    rows = [(i, "u", h := f"page {i} " * (i % 90), hashlib.sha1(h.encode()).hexdigest(), None) for i in range(120)]
    listings = []
    for order in (rows, rows[::-1]):
        batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*order)], names)
        listings.append([r for b in warc._write(f"file://{tmp_path}/w", 4000)([batch]) for r in b.to_pylist()])
    assert len(listings[0]) > 3 and not {r["path"] for r in listings[0]} & {r["path"] for r in listings[1]}
    for listing in listings:
        pages = [p["page_id"] for r in listing for c in warc.records(r["path"], 0, r["size"]) if (p := warc.parsed(c))]
        assert sorted(pages) == list(range(120))


def test_header_is_decoded_whole(tmp_path):
    """A member that only begins like a record is none."""
    whole = warc._member([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:page:1>"), ("WARC-Target-URI", "u" * 5000)], b"x")
    lines = b"WARC/1.1 is a format\r\n\r\n", b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: 1\r\nContent-Length: one\r\n\r\n", b"WARC/1.1"
    for place, (data, expected) in enumerate([(whole, True), *((gzip.compress(x), False) for x in lines), (whole[:30], False)]):
        path = tmp_path / f"{place}.gz"
        path.write_bytes(data)
        part = warc._Range(f"file://{path}", 0, len(data))
        assert part.header_at(0) is expected
        part.close()


def test_damaged_member_costs_only_itself(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 200) for i in range(20)], "page_id long, url string, html string")
    files = warc.write_archives(pages.coalesce(1), f"file://{tmp_path}/w")
    path = files.first()["path"].removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    at = len(data) // 2
    data[at : at + 8] = b"\x1f\x8b\x08\x00junk"
    open(path, "wb").write(data)
    found = {warc.parsed(c)["page_id"] for c in warc.records(path, 0, len(data)) if warc.parsed(c)}
    assert len(found) in (18, 19)


def test_rows_of_one_id_are_kept_apart(spark):
    words = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    a, b = (" ".join(w) for w in words)
    rows = [(5, a), (5, b), (7, a), (8, b), (9, b + " more"), (None, a + " end"), (5, a), (None, "x y"), (3, "x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("__row", F.lit(1))
    found = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in jaccard.near_duplicates(docs).collect()}
    assert found[(7, 36)] == found[(8, 36)] == found[(9, 37)] == 5 and found[(3, 1)] == 3
    kept = sorted((r["doc_id"], r["text"]) for r in jaccard.one_of_each(docs).collect())
    assert kept == [(3, "x y"), (5, a), (5, b)]


def test_a_row_without_id_connects_others(spark):
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base), " ".join([*base, "p1", "p2", "p3", "p4", "p5", "p6", "p7"]), " ".join([*base, *(f"p{i}" for i in range(1, 21))])]
    rows = [(10, texts[0]), (None, texts[1]), (11, texts[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs).collect()} == {10: 10, None: 10, 11: 10}
    assert [r["doc_id"] for r in jaccard.one_of_each(docs).collect()] == [10]


def test_the_toxicity_sample_grows_with_its_rows_alone(spark):
    rows = [(1, "same text")] * 300 + [(i, f"text {i}") for i in range(2, 202)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 202)], "doc_id long, toxic int")
    sample = toxicity.training_rows(docs, labels, F.lit(True))
    assert sample.count() == 500 and sample.where("text = 'same text'").count() == 300
