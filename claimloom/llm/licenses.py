"""License scans by a positional index of rare tokens.

Templates are licence notices cut where names and years may stand. A first pass counts in how many documents each of
their words stands; from these counts every template has its words of the highest inverse document frequency, and the
index holds their places in the template. A file's words are looked up there. Each hit of a template's rarest word
says where the template would begin; its postings are intersected with those of the template's other rare words by
relative position, a few words of drift allowed. What is left is verified: the mandatory key phrases must stand at their
places, and the words that are there must hold most of the template's weight. Phrases of up to three words have
all their words in the index and no drift, so they are found exactly where they stand word for word.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import add_columns, map_arrow, table
from claimloom.llm.words import word_lists

RARE, SHARE, BLOCK_WORDS = 3, 0.7, 1 << 16


@dataclass(frozen=True)
class Template:
    """A label's notice, the key phrases that must stand in it, and by how many words they may drift."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    drift: int = 2
    base: bool = False

    @property
    def words(self) -> list[bytes]:
        return [w for words in word_lists(self.text) for w in words]

    def key_places(self) -> list[tuple[int, list[bytes]]]:
        """(place in the template, words) of each key phrase."""
        own, out = self.words, []
        for key in self.keys:
            words = Template("", key).words
            out.append((next(i for i in range(len(own)) if own[i : i + len(words)] == words), words))
        return out


#: Phrases that are counted place by place (fixed values).
BASE = [Template("cc-by", "cc by", drift=0, base=True), Template("gpl", "general public license", drift=0, base=True), Template("reserved", "all rights reserved", drift=0, base=True)]
#: Notices of public licences (fixed values).
NOTICES = [
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.", ("without warranties or conditions of any kind",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("source and binary forms",)),
    Template("bsd-3-clause", "may be used to endorse or promote products derived from this software without specific prior written permission", ("endorse or promote products",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
    Template("cc0-1.0", "CC0 1.0 Universal", drift=0),
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Template("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", ("gnu general public license", "free software foundation")),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee",)),
    Template("lgpl", "GNU Lesser General Public License", ("lesser general public license",)),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
]


def word_weight(documents: int, df: int) -> int:
    """A word's inverse document frequency in thousandths, one at least."""
    return math.floor(1000 * math.log((documents + 1) / (df + 1))) + 1


def document_frequencies(docs: DataFrame, words: Iterable[bytes], text_col: str = "text") -> tuple[int, dict[bytes, int]]:
    """The number of documents, and in how many of them each of `words` stands; one row a word goes to the driver."""
    wanted = frozenset(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, dict.fromkeys(wanted, 0)
        for batch in batches:
            n += batch.num_rows
            for text in batch.column(0):
                own: set[bytes] = set()
                for words in word_lists(text.as_py()):
                    own.update(wanted.intersection(words))
                for w in own:
                    seen[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array([None, *seen], pa.binary()), pa.array([n, *seen.values()], pa.int64())], names=["word", "docs"])

    found = {r["word"]: r["docs"] for r in map_arrow(docs.select(F.col(text_col).cast("string")), run, "word binary, docs long").groupBy("word").agg(F.sum("docs").alias("docs")).collect()}
    return found.pop(None, 0), {bytes(w): n for w, n in found.items()}


class Index:
    """The positional index of the templates' rare words."""

    def __init__(self, templates: list[Template], documents: int, df: dict[bytes, int], rare: int = RARE, share: float = SHARE):
        self.templates, self.share = templates, share
        self.words = [t.words for t in templates]
        self.keys = [t.key_places() for t in templates]
        self.weights = [[word_weight(documents, df.get(w, 0)) for w in words] for words in self.words]
        # Of each template the places of its rare words, rarest first; ties by place.
        self.rare = [sorted(range(len(w)), key=lambda q: (-w[q], q))[:rare] for w in self.weights]
        self.postings: dict[bytes, list[int]] = {}  # word: templates that it is rare in
        for t, places in enumerate(self.rare):
            for q in places:
                self.postings.setdefault(self.words[t][q], []).append(t)
        self.span = max(len(w) for w in self.words) + max(t.drift for t in templates)

    def begins(self, t: int, places: dict[bytes, np.ndarray]) -> np.ndarray:
        """Where template t may begin: its rarest word's places, intersected with the other rare words' by relative position."""
        drift, words = self.templates[t].drift, self.words[t]
        first, *others = self.rare[t]
        at = places[words[first]] - first
        for q in others:
            held = places[words[q]] - q
            at = at[np.searchsorted(held, at - drift) < np.searchsorted(held, at + drift, side="right")]
        return at

    def verified(self, t: int, words: list[bytes], at: int) -> float | None:
        """The share of template t's weight that stands at `at`, or null without its key phrases or under the least share."""
        drift = self.templates[t].drift
        for place, key in self.keys[t]:
            low = at + place - drift
            if not any(words[i : i + len(key)] == key for i in range(max(0, low), low + 2 * drift + 1)):
                return None
        there = sum(n for q, (w, n) in enumerate(zip(self.words[t], self.weights[t])) if w in words[max(0, at + q - drift) : max(0, at + q + drift + 1)])
        share = there / sum(self.weights[t])
        return share if share >= self.share else None

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """The number of words, and (template, first word, share) of every place found; long texts in blocks with the reach of a template."""
        held: list[bytes] = []
        base, done, n, out = 0, -self.span, 0, []  # held[0]'s place in the text; places before `done` are settled

        def settle(upto: int) -> None:
            places: dict[bytes, list[int]] = {}
            for i, w in enumerate(held):
                if w in self.postings:
                    places.setdefault(w, []).append(i)
            arrays = {w: np.array(p) for w, p in places.items()}
            for t in sorted({t for w in arrays for t in self.postings[w]}):
                if all(self.words[t][q] in arrays for q in self.rare[t]):
                    for at in np.unique(self.begins(t, arrays)).tolist():
                        if done <= base + at < upto and (share := self.verified(t, held, at)) is not None:
                            out.append((t, base + at, share))

        for words in word_lists(text):
            n += len(words)
            held += words
            if len(held) > BLOCK_WORDS:
                settle(upto := n - self.span)
                done = upto
                drop = max(0, upto - self.span - base)
                del held[:drop]
                base += drop
        settle(n + self.span)
        return n, out


FOUND = "array<struct<label: string, first_word: bigint, n_words: int, share: double, base: boolean>>"


def scan_licenses(docs: DataFrame, templates: list[Template] | None = None, text_col: str = "text") -> DataFrame:
    """docs with `n_words` and `licenses`: label, first word, words, share of the weight and base of every place found.

    Words are runs of digits, letters and all that isn't ASCII, with A-Z made small; null and empty texts have none and
    nothing is found in them. Places are in the order of their first word; places of one word are of different
    templates. A notice with drift may begin a few words before the text. Every row stays, repeated ones too; other
    columns pass through, ones named like these two are replaced. An empty table gives an empty one.
    """
    templates = [*BASE, *NOTICES] if templates is None else templates
    vocabulary = {w for t in templates for w in t.words}
    documents, df = document_frequencies(docs, vocabulary, text_col)

    def start():
        index = Index(templates, documents, df)

        def made(texts):
            counts, places = [], []
            for text in texts:
                n, found = index.scan(text)
                counts.append(n)
                places.append([{"label": templates[t].label, "first_word": at, "n_words": len(index.words[t]), "share": share, "base": templates[t].base} for at, t, share in sorted((at, t, share) for t, at, share in found)])
            return [counts, places]

        return made

    return add_columns(docs, [text_col], f"n_words long, licenses {FOUND}", start)


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence words, base places and labels of every document; score is the largest share of a notice's weight, 0 without any."""
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("licenses", lambda x: x["base"])
    starts = F.transform(base, lambda x: x["first_word"])
    names = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda x: x["label"]))), ",")
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"), names(base).alias("base_labels"), names(F.col("licenses")).alias("labels"),
        F.round(F.coalesce(F.array_max(F.transform("licenses", lambda x: x["share"])), F.lit(0.0)), 6).alias("score"),
    )


def _oracle() -> str:
    """The scan in DuckDB: words by place, templates' rare words by count, candidates by joins on relative position."""
    templates = [*BASE, *NOTICES]
    quote = lambda words: "[" + ", ".join(f"'{w.decode()}'" for w in words) + "]"
    rows = ",\n    ".join(f"({i}, '{t.label}', {t.drift}, {str(t.base).lower()}, {quote(t.words)})" for i, t in enumerate(templates))
    keys = ",\n    ".join(f"({i}, {k}, {place}, {quote(words)})" for i, t in enumerate(templates) for k, (place, words) in enumerate(t.key_places()))
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
t(t, label, drift, base, ws) AS (VALUES
    {rows}),
k(t, k, place, ws) AS (VALUES
    {keys}),
q AS (SELECT t, drift, unnest(ws) AS word, unnest(range(0, len(ws))) AS place FROM t),
p AS (SELECT doc_id, word, pos FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(0, len(ws))) AS pos FROM d) WHERE word IN (SELECT word FROM q)),
v AS (SELECT word, count(DISTINCT doc_id) AS df FROM p GROUP BY word),
w AS (SELECT q.*, 1 + CAST(floor(1000 * ln(((SELECT count(*) FROM d) + 1) / (coalesce(df, 0) + 1))) AS BIGINT) AS weight FROM q LEFT JOIN v USING (word)),
r AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY weight DESC, place) AS rk, count(*) OVER (PARTITION BY t) AS size, sum(weight) OVER (PARTITION BY t) AS total FROM w),
c AS (SELECT DISTINCT doc_id, t, drift, pos - place AS beg FROM r JOIN p USING (word) WHERE rk = 1),
i AS (
  SELECT c.doc_id, c.t, c.drift, c.beg FROM c JOIN r ON r.t = c.t AND r.rk <= {RARE} JOIN p ON p.doc_id = c.doc_id AND p.word = r.word AND p.pos BETWEEN c.beg + r.place - c.drift AND c.beg + r.place + c.drift
  GROUP BY c.doc_id, c.t, c.drift, c.beg HAVING count(DISTINCT r.rk) = least({RARE}, any_value(r.size))),
y AS (
  SELECT i.doc_id, i.t, i.drift, i.beg FROM i JOIN d USING (doc_id) LEFT JOIN k ON k.t = i.t GROUP BY i.doc_id, i.t, i.drift, i.beg
  HAVING bool_and(k.t IS NULL OR len(list_filter(range(greatest(0, i.beg + k.place - i.drift), i.beg + k.place + i.drift + 1), lambda x: d.ws[x + 1 : x + len(k.ws)] = k.ws)) > 0)),
h AS (
  SELECT DISTINCT y.doc_id, y.t, y.beg, r.place, r.weight, r.total
  FROM y JOIN r ON r.t = y.t JOIN p ON p.doc_id = y.doc_id AND p.word = r.word AND p.pos BETWEEN y.beg + r.place - y.drift AND y.beg + r.place + y.drift),
z AS (SELECT doc_id, t, beg, sum(weight) / any_value(total) AS share FROM h GROUP BY doc_id, t, beg),
f AS (SELECT doc_id, label, base, beg, share FROM z JOIN t USING (t) WHERE share >= {SHARE})
SELECT d.doc_id, CAST(any_value(len(d.ws)) AS BIGINT) AS n_words, count(*) FILTER (base) AS n_base, min(beg) FILTER (base) AS first_word, max(beg) FILTER (base) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels, coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, round(coalesce(max(share), 0), 6) AS score
FROM d LEFT JOIN f ON f.doc_id = d.doc_id GROUP BY d.doc_id
"""


ORACLE = _oracle()
