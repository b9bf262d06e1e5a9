"""License scans by a positional index of rare words.

Templates are passages of public licences as word sequences, each with a key phrase that is
mandatory. Document frequencies of all template words come from one pass over the corpus; the index then
holds, for every ``SEGMENT`` words of a template, the positions of its ``RARE_WORDS`` rarest (highest
IDF), so a file that quotes one segment is found as well as one that quotes all.

A file looks up its words in the index. A posting says where the template would begin; postings are
intersected by that relative place: a place is a candidate if at least ``AGREE`` different indexed words
say so, within ``SLACK`` words, so that a copy with words left out, added or changed
is found. A candidate stands if the words of the key phrase follow each other there, and the
agreement holds about the very place of the key phrase. Its coverage is the share, weighted by IDF, of template words
that stand in their places (shifted by up to SLACK words, in runs of ``RUN`` at least); its span reaches from the first
to the last of them.

The base phrases are templates that are all key phrase: every word is indexed, and all postings must agree
exactly, so each place of the phrase is found and nothing else.

Rows: a null or empty text has no words and no labels; repeated rows are scanned
each; a null doc_id is scanned; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import LOWER, Flat, flat_slices, hash_word, span_hash, tokens_of

#: Words of a segment, and its rare words that are indexed.
SEGMENT, RARE_WORDS = 12, 3
#: Different indexed words that must agree on a place, and by how many words they may differ.
AGREE, SLACK = 3, 6
#: Words in a row that count away from the key phrase's own place.
RUN = 3

# Fixed values: (label, text, where its key phrase begins, words of the key phrase).
BASE = (
    ("mit", "mit license", 0, 2),
    ("apache", "apache license", 0, 2),
    ("gpl", "general public license", 0, 3),
)
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", 0, 7),
    ("mit", "released under the mit license", 0, 5),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", 3, 2),
    ("apache-2.0", "apache license version 2 0", 0, 5),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", 19, 4),
    ("gpl", "this work is licensed under the gnu general public license version", 6, 4),
    ("gpl-3", "gnu general public license version 3", 0, 6),
    ("gpl-2", "gnu general public license version 2", 0, 6),
    ("lgpl", "gnu lesser general public license", 0, 5),
    ("agpl", "gnu affero general public license", 0, 5),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", 0, 8),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 0, 9),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", 11, 3),
    ("epl", "eclipse public license", 0, 3),
    ("cc-by-nc", "licensed under cc by nc 4 0", 2, 3),
    ("cc-by-sa", "licensed under cc by sa 4 0", 2, 3),
    ("cc-by", "creative commons attribution 4 0 international license", 0, 3),
    ("unlicense", "this is free and unencumbered software released into the public domain", 0, 6),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so "
        "subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software "
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement "
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software "
        "or the use or other dealings in the software",
        75, 9,
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies "
        "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness "
        "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits "
        "whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
        40, 6,
    ),
    (
        "bsd",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution "
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission "
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
        0, 7,
    ),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied "
        "see the license for the specific language governing permissions and limitations under the license",
        31, 7,
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version of the license or at your option any later version "
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details "
        "you should have received a copy of the gnu general public license along with this program",
        41, 11,
    ),
    (
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at",
        17, 10,
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary "
        "for any purpose commercial or non commercial and by any means",
        11, 7,
    ),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software "
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions "
        "the origin of this software must not be misrepresented you must not claim that you wrote the original software",
        60, 8,
    ),
)


@dataclass
class Template:
    label: str
    base: bool
    words: list[bytes]
    hashes: np.ndarray
    weights: np.ndarray  # IDF of each word
    rare: list[int]  # positions that are indexed
    key: tuple[int, int]  # where the key phrase begins, and its words
    agree: int  # indexed words that must agree


def template_words() -> list[str]:
    return sorted({w for _, text, _, _ in BASE + TEMPLATES for w in text.split()})


@dataclass
class Words:
    """Words of a Flat: span, hash, row, and number inside the row."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    docs: np.ndarray
    first: np.ndarray  # of each row, its first word; one more at the end

    @classmethod
    def of(cls, flat: Flat) -> Words:
        tokens = tokens_of(flat)
        word = tokens.is_word
        starts, ends, docs = tokens.starts[word], tokens.ends[word], tokens.docs[word]
        return cls(starts, ends, span_hash(LOWER[flat.data], starts, ends), docs, np.searchsorted(docs, np.arange(len(flat) + 1)))


def document_frequencies(docs: DataFrame) -> tuple[int, dict[str, int]]:
    """Documents, and in how many each template word stands."""
    words = template_words()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array([hash_word(w) for w in words], np.uint64)
        order = np.argsort(table)
        total, rows = np.zeros(len(words), np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for flat in flat_slices(batch.column(0)):
                w = Words.of(flat)
                at = np.minimum(np.searchsorted(table, w.hashes, sorter=order), len(words) - 1)
                which = order[at]
                hit = table[which] == w.hashes
                seen = np.unique(w.docs[hit] * len(words) + which[hit])
                total += np.bincount(seen % len(words), minlength=len(words))
        yield pa.RecordBatch.from_arrays([pa.array([*words, ""]), pa.array([*total.tolist(), rows], pa.int64())], names=["word", "n"])

    counts = docs.select(F.col("text").cast("string")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r["word"]: r["n"] for r in counts.collect()}  # as many rows as there are template words
    return found.pop("", 0), found


def build_templates(n_docs: int, frequencies: dict[str, int]) -> list[Template]:
    """The templates whose key phrase has words of the corpus alone, with what is indexed of them."""
    out = []
    idf = lambda w: float(np.log((n_docs + 1) / (frequencies.get(w, 0) + 0.5)))
    for base, (label, text, begin, length) in [(True, t) for t in BASE] + [(False, t) for t in TEMPLATES]:
        words = text.split()
        if not all(frequencies.get(w, 0) for w in words[begin : begin + length]):
            continue
        rare = list(range(len(words)))
        if not base:
            rare = []
            for at in range(0, len(words), SEGMENT):
                here = [i for i in range(at, min(at + SEGMENT, len(words))) if frequencies.get(words[i], 0)]  # others find nothing
                rare += sorted(here, key=lambda i: (-idf(words[i]), i))[:RARE_WORDS]
        if not rare:
            continue
        agree = len(words) if base else min(AGREE, len(rare))
        weights = np.maximum([idf(w) for w in words], 1e-6)
        out.append(Template(label, base, [w.encode() for w in words], np.array([hash_word(w) for w in words], np.uint64), weights, sorted(rare), (begin, length), agree))
    return out


def _candidates(t: Template, docs: np.ndarray, begins: np.ndarray, offsets: np.ndarray, slack: int) -> np.ndarray:
    """Intersect postings by place: (doc, least begin, largest begin) of the stretches in which
    enough different words agree. Two rows of stretches, half a stretch apart: each place with its slack is whole in one."""
    width = 4 * slack + 2
    found = []
    for shift in (0, width // 2) if slack else (0,):
        stretch = (begins + shift) // width if slack else begins
        each = np.unique(np.stack([docs, stretch, offsets]), axis=1)
        places, agree = np.unique(each[:2], axis=1, return_counts=True)
        doc, stretch = places[:, agree >= t.agree]
        low = stretch * width - shift if slack else stretch
        found.append(np.stack([doc, low, low + (width - 1 if slack else 0)]))
    return np.concatenate(found, axis=1)


def _with_key(w: Words, flat: Flat, t: Template, candidates: np.ndarray) -> list[tuple[int, int]]:
    """(doc, begin) of the places in candidates where the key phrase stands."""
    first, length = t.key
    steps = np.arange(int(candidates[2, 0] - candidates[1, 0]) + 1)
    docs = np.repeat(candidates[0], len(steps))
    begins = (candidates[1][:, None] + steps).reshape(-1)
    inside = (begins + first >= w.first[docs]) & (begins + first + length <= w.first[docs + 1])
    docs, begins = docs[inside], begins[inside]
    for i in range(first, first + length):
        same = w.hashes[begins + i] == t.hashes[i]
        docs, begins = docs[same], begins[same]
    places = np.unique(np.stack([docs, begins]), axis=1).T.tolist()
    word = lambda at: LOWER[flat.data[w.starts[at] : w.ends[at]]].tobytes()
    return [(d, b) for d, b in places if all(word(b + i) == t.words[i] for i in range(first, first + length))]


def _covered(w: Words, t: Template, doc: int, begin: int, slack: int) -> tuple[float, int, int]:
    """Coverage of a template at a place, and the first and last word of its span."""
    n, covered, at_words = len(t.words), np.zeros(len(t.words), bool), []
    for step in range(-slack, slack + 1):
        at = np.arange(begin + step, begin + step + n)
        stands = (at >= w.first[doc]) & (at < w.first[doc + 1])
        stands[stands] = w.hashes[at[stands]] == t.hashes[stands]
        if step:  # runs of RUN words only
            run = np.convolve(stands, np.ones(RUN, int), "valid") == RUN if n >= RUN else np.zeros(0, bool)
            stands = np.convolve(run, np.ones(RUN, int)) > 0 if len(run) else np.zeros(n, bool)
        if stands.any():
            covered |= stands
            at_words += [at[stands][0], at[stands][-1]]
    return float(t.weights[covered].sum() / t.weights.sum()), int(min(at_words)), int(max(at_words))


def matches(flat: Flat, templates: list[Template]) -> tuple[np.ndarray, list[list[tuple[str, bool, int, int, int, float]]]]:
    """Number of words of each row, and its matches (label, base, first word of the key phrase,
    first and last word of the span, coverage)."""
    w = Words.of(flat)
    found: list[list[tuple[str, bool, int, int, int, float]]] = [[] for _ in range(len(flat))]
    index = np.unique(np.array([t.hashes[i] for t in templates for i in t.rare], np.uint64))
    if not len(index) or not len(w.hashes):
        return np.diff(w.first), found
    which = np.minimum(np.searchsorted(index, w.hashes), len(index) - 1)
    hits = np.flatnonzero(index[which] == w.hashes)
    hits = hits[np.argsort(which[hits], kind="stable")]  # by word, then by place
    bounds = np.searchsorted(which[hits], np.arange(len(index) + 1))
    postings = lambda h: hits[bounds[(k := int(np.searchsorted(index, h)))] : bounds[k + 1]]
    for t in templates:
        places = [postings(t.hashes[i]) for i in t.rare]
        offsets = np.repeat(np.array(t.rare), [len(p) for p in places])
        at = np.concatenate(places)
        if len(np.unique(offsets)) < t.agree:
            continue
        slack = 0 if t.base else SLACK
        docs, begins = w.docs[at], at - offsets
        candidates = _candidates(t, docs, begins, offsets, slack)
        if not candidates.shape[1]:
            continue
        order = np.lexsort((begins, docs))
        docs, begins, offsets = docs[order], begins[order], offsets[order]
        far = np.int64(len(w.hashes) + len(t.words) + 4 * slack + 4)  # more than any two places of a document differ by
        line = docs * (2 * far) + begins
        for doc, begin in _with_key(w, flat, t, candidates):
            low, high = np.searchsorted(line, [doc * 2 * far + begin - slack, doc * 2 * far + begin + slack + 1])
            if len(np.unique(offsets[low:high])) < t.agree:
                continue
            coverage, first, last = _covered(w, t, doc, begin, slack)
            found[doc].append((t.label, t.base, begin + t.key[0] - int(w.first[doc]), first - int(w.first[doc]), last - int(w.first[doc]), coverage))
    return np.diff(w.first), found


_SCHEMA = "doc_id long, n_words long, matches array<struct<label:string,base:boolean,first_word:bigint,span_first:bigint,span_last:bigint,coverage:double>>"


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, matches): every place of a template's key phrase, with label, span and coverage."""
    templates = build_templates(*document_frequencies(docs))
    kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("first_word", pa.int64()), ("span_first", pa.int64()), ("span_last", pa.int64()), ("coverage", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("label", "base", "first_word", "span_first", "span_last", "coverage")
        for batch in batches:
            sizes, found = [], []
            for flat in flat_slices(batch.column(1)):
                n, own = matches(flat, templates)
                sizes += n.tolist()
                found += [[dict(zip(names, m)) for m in row] for row in own]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, kind)], names=["doc_id", "n_words", "matches"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, _SCHEMA)


def license_labels(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    base = F.filter("matches", lambda m: m.base)
    names = lambda m: F.array_join(F.sort_array(F.array_distinct(F.transform(m, lambda x: x.label))), ",")
    rows = scan(docs).withColumn("found", base)
    return rows.select(
        "doc_id",
        "n_words",
        F.size("found").cast("long").alias("n_base"),
        F.array_min(F.transform("found", lambda m: m.first_word)).alias("first_word"),
        F.array_max(F.transform("found", lambda m: m.first_word)).alias("last_word"),
        names(F.col("found")).alias("base_labels"),
        names(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m.coverage)), F.lit(0.0)).alias("score"),
    )
