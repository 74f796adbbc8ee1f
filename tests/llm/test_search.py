"""Ranked search, licence scan and collocations against SQL and plain Python."""

import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from compare import difference
from evalflow.llm import collocations, lexical, licenses, terms
from evalflow.llm.common import written

LONG = " ".join(f"w{i % 977}" for i in range(300_000))  # one text of some 1.7 million bytes


def tables(tmp_path, **frames):
    con = duckdb.connect()
    for name, frame in frames.items():
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    return con


def test_words_of_any_separators():
    import pyarrow as pa

    old, terms.CHUNK_BYTES = terms.CHUNK_BYTES, 16
    try:
        found = terms.words(pa.array(["Ab, c-9", "", "xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx ÄÖ é", "ab"]), terms.NOT_ALNUM)
    finally:
        terms.CHUNK_BYTES = old
    spelled = [bytes(found.data[a:b]).decode() for a, b in zip(found.starts, found.ends)]
    assert spelled == ["Ab", "c", "9", "x" * 41, "ÄÖ", "é", "ab"]
    assert found.first.tolist() == [0, 3, 3, 6, 7] and found.keys[0] == found.keys[-1]


# -- ranked search


@pytest.fixture
def ranked(spark, odd_docs):
    pick = random.Random(3)
    rows = [(200 + i, " ".join(pick.choices("alpha beta gamma delta one two three four".split(), k=pick.randrange(1, 30)))) for i in range(60)]
    rows += [(50 - i % 20, "beta gamma BETA, x") for i in range(40)]  # ties, and rows of one id
    rows += [(300, LONG), (None, "beta gamma BETA, x")]
    docs = odd_docs.select("doc_id", "text", "block", "score").unionByName(
        spark.createDataFrame(rows, "doc_id long, text string").withColumns({"block": F.lit("b"), "score": F.lit(2.0)})
    )
    items = [(1, "Beta; gamma"), (2, None), (3, ""), (4, "nowhere"), (5, "w1 w976 x"), (5, "one ÄÖ"), (None, "two é"), (6, LONG), (6, LONG)]
    return docs, spark.createDataFrame(items, "item_id int, text string").withColumn("rank", F.lit(7))


@pytest.mark.parametrize("most", [1 << 18, 3])
def test_search_is_that_of_sql(spark, tmp_path, ranked, most, monkeypatch):
    docs, items = ranked
    monkeypatch.setattr(lexical, "DOC_TILE", 7)
    con = tables(tmp_path, documents=docs, benchmark=items)
    run = lambda s, _: lexical.ranked_search(docs, items, most=most)
    bad, (ours, theirs, _, _) = difference(spark, con, run, lexical.SQL["op12_ranked_search"], None)
    assert bad is None and ours == theirs > 30


def test_search_tiles(spark, tmp_path, ranked, monkeypatch):
    import numpy as np

    entries = [(i, t, 1 + (i * t) % 9) for i in range(5) for t in range(7) if (i + t) % 3]
    item, term = (np.array(x) for x in list(zip(*entries))[:2])
    weight = np.arange(1, 8)
    doc, has, impact = np.array([0, 0, 1, 2, 2, 2]), np.array([0, 3, 6, 1, 2, 6]), np.array([5, 7, 11, 2, 3, 4])
    want = [[sum(weight[t] * v for d, t, v in zip(doc, has, impact) if d == j and (i + t) % 3) for j in range(3)] for i in range(5)]
    for width, height in ((2048, 256), (2, 2)):
        monkeypatch.setattr(lexical, "TERM_TILE", width)
        monkeypatch.setattr(lexical, "ITEM_TILE", height)
        tiles = lexical.item_tiles(item, term, 5)
        got = np.concatenate([lexical.tile_scores(t, weight, doc, has, impact, 3) for t in tiles])
        assert got.tolist() == want


def test_search_of_nothing(spark, no_docs, ranked):
    docs, items = ranked
    assert lexical.ranked_search(no_docs, items).count() == 0
    assert lexical.ranked_search(docs, items.limit(0)).count() == 0
    assert lexical.ranked_search(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_lengths_past_64_bits():
    import numpy as np

    n, docs, total = np.array([10**9, 3]), 10**12, 10**15
    assert lexical.length_share(n, docs, total).tolist() == [10 + 90 * 10**9 * docs // total, 10]


# -- licences


def test_licenses(spark, tmp_path, odd_docs, no_docs):
    mit = licenses.TEMPLATES[12].text
    gpl = licenses.TEMPLATES[8].text
    rows = [
        (100, f"Foo bar. {mit.upper()}. The end"),
        (101, mit.replace("obtaining", "who is obtaining")),  # words between
        (102, mit.replace("without restriction", "without limits")),  # a mandatory phrase is missing
        (103, " ".join(reversed(gpl.split()))),
        (104, f"{gpl}\n{gpl} MIT license, Apache LICENSE, cc-by cc by GNU general  public license"),
        (105, LONG + " Licensed under CC BY-NC 4.0. " + LONG),
        (106, "cc"),
        (107, "by cc"),
        (108, "the and of the license under a free software"),
        (109, "This work is licensed under the GNU General Public License, version 3."),
        (109, "This work is licensed under the GNU General Public License, version 3."),
        (110, " ".join(gpl.split()[:20])),
    ]
    docs = odd_docs.select("doc_id", "text", "score").unionByName(
        spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit(1.0))
    )
    con = tables(tmp_path, documents=docs)
    bad, (ours, theirs, _, _) = difference(
        spark, con, lambda s, _: licenses.licenses(docs), licenses.SQL["op11_license_scan"], None
    )
    assert bad is None and ours == theirs == docs.count()
    found = {r["doc_id"]: r for r in licenses.licenses(docs).collect()}
    assert found[100]["labels"] == "mit" and found[100]["score"] == 1.0 and found[100]["n_base"] == 0
    assert found[101]["labels"] == "mit" and found[102]["labels"] == ""
    assert found[103]["labels"] == "" and found[104]["base_labels"] == "apache,cc-by,gpl,mit"
    assert found[105]["labels"] == "cc-by,cc-by-nc" and found[109]["labels"] == "gpl,gpl-3.0"
    assert licenses.licenses(no_docs).count() == 0


# -- collocations


def brute_force(rows, least=10, top=2000):
    import re

    f, n = Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang if lang is not None else "und"] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang if lang is not None else "und", tuple(words[i : i + k])] += 1
    out = []
    for (lang, g), a in f.items():
        if len(g) == 1 or a < least:
            continue
        cuts = [(10**6 * a * a // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        longer = [x for (o, h), x in f.items() if o == lang and len(g) == 2 and len(h) == 3 and x >= least and g in (h[:2], h[1:])]
        if not any(100 * x >= 50 * a for x in longer):
            out.append((lang, score, a, " ".join(g), f[lang, g[:k]], f[lang, g[k:]], n[lang]))
    found = []
    for lang in {x[0] for x in out}:
        mine = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[1], -x[2], x[3].encode()))
        found += [(lang, i, x[3], x[2], x[4], x[5], x[6], x[1]) for i, x in enumerate(mine[:top], 1)]
    return sorted(found)


@pytest.fixture(scope="module")
def prose():
    pick = random.Random(11)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(400):
        text = " ".join(pick.choices(words, [1 / (k + 1) for k in range(40)], k=30)) + pick.choice([". ", ", ", "\n", " "])
        text += pick.choice(["New York City is", "new\tyork city hall", "of the; of the", "Änderung über alles", "a\x0bb c"])
        rows.append((text, pick.choice(["en", "de", None, "und"])))
    rows += [(None, "en"), ("", "en"), (" \t ", None), ("x y " * 3000, "zz"), ("x y " * 3000, "zz"), ("one", "en"), ("rare pair " * 9, "en")]
    return rows


@pytest.mark.parametrize("sample_words,block_bytes", [(10**9, 1 << 24), (60, 1 << 24), (60, 700), (0, 1 << 24)])
def test_collocations(spark, prose, sample_words, block_bytes, monkeypatch):
    monkeypatch.setattr(collocations, "PART_WORDS", 5000)
    docs = spark.createDataFrame([(t, x, 1, b"k") for t, x in prose], "text string, lang string, rank int, key binary")
    found = collocations.collocations(docs, sample_words=sample_words, block_bytes=block_bytes)
    got = sorted(tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == brute_force(prose) and len(got) > 100


def test_border_failures_lead_to_further_passes(spark, prose):
    docs = spark.createDataFrame(prose, "text string, lang string")
    whole = collocations.mine(docs, sample_words=10**9)
    small = collocations.mine(docs, sample_words=60)
    assert whole.passes == 1 and small.passes > 1
    rows = lambda m: {tuple(r) for r in m.frequent.select("level", "key", "a").collect()}
    assert rows(whole) == rows(small)


def test_collocations_of_nothing(spark, prose):
    docs = spark.createDataFrame(prose, "text string, lang string")
    for frame in (docs.limit(0), docs.filter("text = ''"), docs.filter("text is null")):
        assert collocations.collocations(frame).count() == 0


def test_scores_past_64_bits(spark):
    """The score's arithmetic on counts whose products need more than 64 bits."""
    row = spark.sql(
        "select (cast(a as decimal(19,0)) * cast(a as decimal(19,0)) * cast(1000000 as decimal(7,0)))"
        " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) as s from values (9000000000L, 12345678901L, 9876543210L) t(a, l, r)"
    ).first()
    assert row["s"] == 10**6 * 9000000000**2 // (12345678901 * 9876543210)


def test_bit_maps_hold_all_they_were_given(spark):
    import numpy as np

    keys = np.random.default_rng(1).integers(-(2**63), 2**63, 5000)
    rows = written(spark.createDataFrame([(int(k),) for k in keys], "key long"), "keys")
    for most in (1 << 26, 1 << 12):
        held = collocations.bit_map(rows, most)
        assert held.holds(keys.view(np.uint64)).all() and len(held.bits) * 8 <= most
