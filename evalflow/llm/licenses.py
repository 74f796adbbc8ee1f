"""Licence notices by a positional index of rare words.

The words of the licence templates form an index: the places at which each stands in each
template. Their document frequencies over the whole corpus give every word a weight (IDF,
in thousandths). A text looks up, for each template, the ``ANCHORS`` words of highest weight it
shares with it; an anchor at place ``p`` of the text and ``q`` of the template votes for the
relative position ``p - q``, and positions on which ``VOTES`` different anchors agree are
alignments. An alignment holds when the template's words found at their place, give or take
``DRIFT``, carry ``LEAST_PERCENT`` of its weight, and every mandatory phrase of the template
stands there word for word. Beside that the plain phrases of ``BASE`` are counted.

Defined results: a null or empty text has no words, no label and score 0; every row is its own
result, repeated ones alike; places may overlap; an empty table gives an empty one; other
columns are ignored. Words equal in weight are taken in alphabetical order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalflow.llm.common import ship, text_rows
from evalflow.llm.terms import NOT_ALNUM, key_of, looked_up, slices, words

ANCHORS, VOTES, DRIFT, LEAST_PERCENT = 6, 3, 2, 70
#: Score of a text in which only a plain phrase stands.
PHRASE_SCORE = 0.5


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    mandatory: tuple[str, ...]


# Phrases and labels of the contract, and wording of public licences.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
TEMPLATES = (
    Template(
        "agpl",
        "you can redistribute it and or modify it under the terms of the gnu affero general public license"
        " as published by the free software foundation",
        ("gnu affero general public license",),
    ),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        ("in compliance with the license",),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted"
        " provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template(
        "cc-by",
        "this work is licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution",),
    ),
    Template(
        "cc0",
        "has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide"
        " under copyright law",
        ("public domain", "under copyright law"),
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the"
        " gnu general public license as published by the free software foundation",
        ("gnu general public license", "free software foundation"),
    ),
    Template(
        "gpl-3.0",
        "this work is licensed under the gnu general public license version 3",
        ("gnu general public license version 3",),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee"
        " is hereby granted",
        ("with or without fee",),
    ),
    Template(
        "lgpl",
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license"
        " as published by the free software foundation",
        ("gnu lesser general public license",),
    ),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and"
        " associated documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    Template("mit", "released under the mit license", ("mit license",)),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license",),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
)


class Index:
    """Words of templates and phrases in alphabetical order, and where they stand."""

    def __init__(self, templates: tuple[Template, ...], base: tuple[tuple[str, str], ...]):
        phrases = [p for t in templates for p in t.mandatory] + [p for p, _ in base]
        self.templates, self.base = templates, base
        self.words = sorted({w for text in [t.text for t in templates] + phrases for w in text.split()})
        number = {w: i for i, w in enumerate(self.words)}
        self.sequences = [np.array([number[w] for w in t.text.split()]) for t in templates]
        self.mandatory = [[np.array([number[w] for w in p.split()]) for p in t.mandatory] for t in templates]
        self.phrases = [np.array([number[w] for w in p.split()]) for p, _ in base]
        keys = np.array([key_of(w) for w in self.words], np.uint64)
        self._order = np.argsort(keys)
        self._keys = keys[self._order]

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for words of no template."""
        at = looked_up(keys, self._keys)
        return np.where(at >= 0, self._order[at], -1)


@dataclass
class Scan:
    """The known words of some texts, by text and place."""

    index: Index
    number: np.ndarray  # of every word
    text: np.ndarray
    place: np.ndarray  # within its text
    first: np.ndarray  # first word of each text, and the end

    @classmethod
    def of(cls, index: Index, column: pa.Array) -> Scan:
        found = words(column, NOT_ALNUM)
        return cls(index, index.numbers(found.keys), found.text, np.arange(len(found.text)) - found.first[found.text], found.first)

    def runs(self, phrase: np.ndarray) -> np.ndarray:
        """Words at which the phrase begins, all within one text."""
        last = len(self.number) - len(phrase) + 1
        start = np.flatnonzero(self.number[: max(0, last)] == phrase[0])
        for step, word in enumerate(phrase[1:].tolist(), 1):
            start = start[self.number[start + step] == word]
        return start[self.text[start] == self.text[start + len(phrase) - 1]]

    def held(self) -> np.ndarray:
        """Texts x words: whether the text holds the word."""
        out = np.zeros((len(self.first) - 1, len(self.index.words)), bool)
        known = self.number >= 0
        out[self.text[known], self.number[known]] = True
        return out

    def alignments(self, t: int, held: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text and relative position of the alignments with template ``t``."""
        sequence = self.index.sequences[t]
        own = np.unique(sequence)
        own = own[np.lexsort((own, -weight[own]))]
        anchor = np.zeros(held.shape, bool)
        anchor[:, own] = held[:, own] & (np.cumsum(held[:, own], axis=1) <= ANCHORS)
        enough = anchor.sum(axis=1) >= VOTES
        hit = np.flatnonzero(self.number >= 0)
        hit = hit[enough[self.text[hit]]]
        hit = hit[anchor[self.text[hit], self.number[hit]]]
        votes = []
        for q, word in enumerate(sequence.tolist()):
            mine = hit[self.number[hit] == word]
            votes.append(np.stack([self.text[mine], self.place[mine] - q, np.full(len(mine), word)]))
        votes = np.concatenate(votes, axis=1)
        text, at, word = votes[:, np.lexsort(votes[::-1])]
        new = np.r_[True, (text[1:] != text[:-1]) | (at[1:] != at[:-1])] if len(text) else np.empty(0, bool)
        other = new | np.r_[True, word[1:] != word[:-1]] if len(text) else new
        group = np.cumsum(new) - 1
        agree = np.bincount(group, other) >= VOTES if len(text) else np.empty(0, bool)
        return text[new][agree], at[new][agree]

    def shares(self, t: int, text: np.ndarray, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Weight of the template's words that stand at their place, give or take the drift."""
        found = np.zeros(len(text), np.int64)
        begin, end = self.first[text], self.first[text + 1]
        for q, word in enumerate(self.index.sequences[t].tolist()):
            there = np.zeros(len(text), bool)
            for step in range(-DRIFT, DRIFT + 1):
                place = begin + at + q + step
                inside = (place >= begin) & (place < end)
                there[inside] |= self.number[place[inside]] == word
            found += there * weight[word]
        return found

    def holds(self, t: int, text: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether every mandatory phrase stands within the alignment."""
        good = np.ones(len(text), bool)
        low = self.first[text] + at - DRIFT
        high = self.first[text] + at + len(self.index.sequences[t]) + DRIFT
        low, high = np.maximum(low, self.first[text]), np.minimum(high, self.first[text + 1])
        for phrase in self.index.mandatory[t]:
            start = self.runs(phrase)
            after = np.searchsorted(start, low)
            good &= np.r_[start, np.iinfo(np.int64).max][after] <= high - len(phrase)
        return good


def _counted(index: Index):
    """Texts that hold each word, and under -1 all texts, summed over a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(len(index.words), np.int64), 0
        for batch in batches:
            for part in slices(batch):
                total += Scan.of(index, part.column("text")).held().sum(axis=0)
                texts += part.num_rows
        number = np.r_[-1, np.arange(len(total))].astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(np.r_[texts, total])], ["word", "n"])

    return run


def weights(docs: DataFrame, index: Index) -> np.ndarray:
    """``1 + floor(1000 * ln((N + 1) / (df + 1)))`` of each word, over all documents."""
    counts = docs.select("text").mapInArrow(_counted(index), "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    held = {r["word"]: r["n"] for r in counts.collect()}  # a row per word of the templates
    total = held.get(-1, 0)
    return np.array([1 + math.floor(1000 * math.log((total + 1) / (held.get(i, 0) + 1))) for i in range(len(index.words))], np.int64)


_FOUND = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def _found(index: Index, weight: np.ndarray):
    names = sorted({label for _, label in index.base} | {t.label for t in index.templates})

    def joined(mark: np.ndarray) -> pa.Array:
        kinds, which = np.unique(mark, axis=0, return_inverse=True)
        text = [",".join(n for n, on in zip(names, row) if on) for row in kinds.tolist()]
        return pa.array(text, pa.string()).take(pa.array(which.reshape(-1)))

    def scanned(part: pa.RecordBatch) -> pa.RecordBatch:
        scan = Scan.of(index, part.column("text"))
        n = part.num_rows
        count, low, high = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
        plain = np.zeros((n, len(names)), bool)
        for phrase, (_, label) in zip(index.phrases, index.base):
            start = scan.runs(phrase)
            text, place = scan.text[start], scan.place[start]
            count += np.bincount(text, minlength=n)
            np.minimum.at(low, text, place)
            np.maximum.at(high, text, place)
            plain[text, names.index(label)] = True
        score, all_labels = np.where(count > 0, PHRASE_SCORE, 0.0), plain.copy()
        held = scan.held()
        for t, template in enumerate(index.templates):
            whole = int(weight[index.sequences[t]].sum())
            text, at = scan.alignments(t, held, weight)
            found = scan.shares(t, text, at, weight)
            good = (100 * found >= LEAST_PERCENT * whole) & scan.holds(t, text, at)
            np.maximum.at(score, text[good], found[good] / whole)
            all_labels[text[good], names.index(template.label)] = True
        none = count == 0
        columns = [pa.array(np.diff(scan.first)), pa.array(count), pa.array(low, mask=none), pa.array(high, mask=none)]
        columns += [joined(plain), joined(all_labels), pa.array(score)]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", *(c.split()[0] for c in _FOUND.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from map(scanned, slices(batch))

    return run


def licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, base: tuple[tuple[str, str], ...] = BASE) -> DataFrame:
    """Labels, places and score of every document (``doc_id``, ``text``)."""
    ship(docs.sparkSession)
    index, texts = Index(templates, base), text_rows(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(_found(index, weights(texts, index)), f"doc_id {kind}, {_FOUND}")


def op11_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licence labels of every document of the table."""
    return licenses(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


#: The templates once more, for SQL: label, text, mandatory phrases.
_SQL_TEMPLATES = """
(0, 'agpl', 'you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation', ['gnu affero general public license']),
(1, 'apache-2.0', 'licensed under the apache license version 2 0', ['apache license', 'version 2 0']),
(2, 'apache-2.0', 'you may not use this file except in compliance with the license you may obtain a copy of the license at', ['in compliance with the license']),
(3, 'bsd', 'redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met', ['redistribution and use in source and binary forms']),
(4, 'cc-by-nc', 'licensed under cc by nc 4 0', ['cc by nc']),
(5, 'cc-by-sa', 'licensed under cc by sa 4 0', ['cc by sa']),
(6, 'cc-by', 'this work is licensed under a creative commons attribution 4 0 international license', ['creative commons attribution']),
(7, 'cc0', 'has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law', ['public domain', 'under copyright law']),
(8, 'gpl', 'this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation', ['gnu general public license', 'free software foundation']),
(9, 'gpl-3.0', 'this work is licensed under the gnu general public license version 3', ['gnu general public license version 3']),
(10, 'isc', 'permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted', ['with or without fee']),
(11, 'lgpl', 'you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation', ['gnu lesser general public license']),
(12, 'mit', 'permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction', ['permission is hereby granted free of charge', 'without restriction']),
(13, 'mit', 'released under the mit license', ['mit license']),
(14, 'mpl-2.0', 'this source code form is subject to the terms of the mozilla public license v 2 0', ['mozilla public license']),
(15, 'unlicense', 'this is free and unencumbered software released into the public domain', ['free and unencumbered software'])
"""

SQL = {
    "op11_license_scan": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
w AS (SELECT r, unnest(w) AS w, unnest(range(len(w))) AS p FROM d),
b(phrase, label) AS (VALUES ('gnu general public license', 'gpl'), ('apache license', 'apache'), ('cc by', 'cc-by'), ('mit license', 'mit')),
t(t, label, body, mandatory) AS (VALUES {_SQL_TEMPLATES}),
phrases AS (SELECT phrase FROM b UNION SELECT unnest(mandatory) FROM t),
pw AS (SELECT phrase, len(string_split(phrase, ' ')) AS size, unnest(string_split(phrase, ' ')) AS w,
              unnest(range(len(string_split(phrase, ' ')))) AS k FROM phrases),
runs AS (
  SELECT w.r, pw.phrase, w.p - pw.k AS p, any_value(size) AS size
  FROM w JOIN pw ON w.w = pw.w GROUP BY w.r, pw.phrase, w.p - pw.k HAVING count(*) = any_value(size)),
base AS (
  SELECT r, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, list(DISTINCT label) AS labels
  FROM runs JOIN b ON runs.phrase = b.phrase GROUP BY r),
tw AS (SELECT t, unnest(string_split(body, ' ')) AS w, unnest(range(len(string_split(body, ' ')))) AS q FROM t),
known AS (SELECT w FROM tw UNION SELECT w FROM pw),
df AS (SELECT w, count(DISTINCT r) AS df FROM w SEMI JOIN known USING (w) GROUP BY w),
wt AS (
  SELECT known.w, 1 + floor(1000 * ln(((SELECT count(*) FROM d) + 1) / (coalesce(df, 0) + 1)))::BIGINT AS weight
  FROM known LEFT JOIN df ON known.w = df.w),
held AS (SELECT DISTINCT w.r, tw.t, w.w FROM w JOIN tw ON w.w = tw.w),
anchors AS (
  SELECT r, t, w FROM (
    SELECT held.*, row_number() OVER (PARTITION BY r, t ORDER BY weight DESC, w) AS k FROM held JOIN wt USING (w))
  WHERE k <= 6),
aligned AS (
  SELECT a.r, a.t, w.p - tw.q AS o FROM anchors a JOIN w ON w.r = a.r AND w.w = a.w JOIN tw ON tw.t = a.t AND tw.w = a.w
  GROUP BY ALL HAVING count(DISTINCT a.w) >= 3),
total AS (SELECT t, sum(weight)::BIGINT AS whole, count(*) AS size FROM tw JOIN wt USING (w) GROUP BY t),
cover AS (
  SELECT r, t, o, sum(weight)::BIGINT AS found FROM (
    SELECT DISTINCT a.r, a.t, a.o, tw.q, wt.weight
    FROM aligned a JOIN tw ON tw.t = a.t JOIN wt ON wt.w = tw.w
    JOIN w ON w.r = a.r AND w.w = tw.w AND w.p BETWEEN a.o + tw.q - 2 AND a.o + tw.q + 2)
  GROUP BY r, t, o),
good AS (
  SELECT c.r, c.t, c.found / whole AS share, label
  FROM cover c JOIN total ON total.t = c.t JOIN t ON t.t = c.t
  WHERE 100 * found >= 70 * whole AND len(mandatory) = (
    SELECT count(DISTINCT runs.phrase) FROM runs
    WHERE runs.r = c.r AND list_contains(t.mandatory, runs.phrase) AND runs.p >= c.o - 2 AND runs.p + runs.size <= c.o + total.size + 2)),
ours AS (SELECT r, list(DISTINCT label) AS labels, max(share) AS share FROM good GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(ours.labels, [])))), ',') AS labels,
       greatest(coalesce(share, 0.0), CASE WHEN n_base > 0 THEN 0.5 ELSE 0.0 END)::DOUBLE AS score
FROM d LEFT JOIN base ON d.r = base.r LEFT JOIN ours ON d.r = ours.r""",
}
QUERIES = {"op11_license_scan": op11_license_scan}
