"""License scans: base phrases, and an exact set-similarity join of text blocks with notice templates.

A block matches a template when it holds at least ``CONTAINMENT`` of the template's distinct words. Blocks are lines, and
stretches over line breaks of as many words as the template has, for notices that are wrapped. Template words are
ordered by their frequency in the whole corpus, rarest first; a block qualifies only through a word in the template's
prefix (its first n - need + 1 words), must be long enough (length filter), and the words left after the first shared
one must suffice (positional filter); what remains is verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import textvec as tv
from tradewind.llm.shared import texts

CONTAINMENT = 0.8

#: Base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Notices of public licenses and the labels of the method. A notice that another one holds four fifths of
#: (CC BY-NC, LGPL) cannot be told from it at this threshold and is not listed.
TEMPLATES = [
    ("gpl-notice", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl-notice",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation",
    ),
    ("apache-notice", "Licensed under the Apache License, Version 2.0."),
    ("apache-notice", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License"),
    ("mit-notice", "Released under the MIT License."),
    (
        "mit-notice",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files, to deal in the Software without restriction",
    ),
    (
        "mit-notice",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    ),
    (
        "isc-notice",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ),
    (
        "bsd-notice",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met",
    ),
    (
        "bsd-notice",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission",
    ),
    ("zlib-notice", "In no event will the authors be held liable for any damages arising from the use of this software"),
    ("boost-notice", "Distributed under the Boost Software License, Version 1.0"),
    ("cc-by-notice", "Licensed under CC BY 4.0."),
    ("cc-by-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0-notice", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense-notice", "This is free and unencumbered software released into the public domain"),
    ("mpl-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("epl-notice", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"),
    ("warranty-disclaimer", "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    (
        "warranty-disclaimer",
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    ),
    ("all-rights-reserved", "All rights reserved."),
]


def _hashes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return tv.words(tv.Run(0, raw, np.array([0, len(raw)])), tv.ALNUM).hash


def word_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Occurrences in all texts of each hash of the (sorted, bounded) vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for run in tv.runs(batch.column("text")):
                h = tv.words(run, tv.ALNUM).hash
                at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
                total += np.bincount(at[vocabulary[at] == h], minlength=len(vocabulary))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(vocabulary))), pa.array(total)], ["word", "n"])

    found = np.zeros(len(vocabulary), np.int64)
    for word, n in docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n")).collect():
        found[word] = n
    return found


class Index:
    """Templates as ascending ranks of the global order, with prefixes by rank."""

    def __init__(self, templates: list[tuple[str, str]], vocabulary: np.ndarray, often: np.ndarray, containment: float):
        rank = np.empty(len(vocabulary), np.int64)
        rank[np.lexsort((vocabulary, often))] = np.arange(len(vocabulary))
        self.vocabulary, self.rank = vocabulary, rank
        self.labels = [label for label, _ in templates]
        self.words = [sorted({int(rank[np.searchsorted(vocabulary, x)]) for x in _hashes(text)}) for _, text in templates]
        self.need = [int(np.ceil(containment * len(w) - 1e-9)) for w in self.words]
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for t, w in enumerate(self.words):
            for pos, r in enumerate(w[: len(w) - self.need[t] + 1]):
                self.prefix.setdefault(r, []).append((t, pos))
        self.length = [len(_hashes(text)) for _, text in templates]
        self.member, self.rare = (np.zeros((len(templates), len(vocabulary)), bool) for _ in range(2))
        for t, w in enumerate(self.words):
            self.member[t, w] = True
            self.rare[t, w[: len(w) - self.need[t] + 1]] = True
        self.starts = np.zeros(len(vocabulary), bool)
        self.starts[list(self.prefix)] = True
        self.quick = np.zeros(1 << 16, bool)
        self.quick[(vocabulary & tv.U(0xFFFF)).astype(int)] = True

    def ranks(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are template words, and their ranks."""
        at = np.flatnonzero(self.quick[(h & tv.U(0xFFFF)).astype(np.int64)])
        near = np.minimum(np.searchsorted(self.vocabulary, h[at]), len(self.vocabulary) - 1)
        ok = self.vocabulary[near] == h[at]
        return at[ok], self.rank[near[ok]]

    def matches(self, block: list[int]) -> list[tuple[int, float]]:
        """(template, containment) of all templates that a block of ascending ranks meets."""
        found, tried = [], set()
        for pos, r in enumerate(block):
            for t, tpos in self.prefix.get(r, ()):
                need, own = self.need[t], self.words[t]
                if t in tried or len(block) < need:
                    continue
                tried.add(t)
                if min(len(block) - pos, len(own) - tpos) < need:
                    continue
                both = len(set(own).intersection(block))
                if both >= need:
                    found.append((t, both / len(own)))
        return found

    def wrapped(self, at: np.ndarray, ranks: np.ndarray, line: np.ndarray, end: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(first, last, template, containment) of blocks over line breaks, as indices into the template words.

        ``at``: the words' places; ``line``: their lines; ``end``: where their documents end. A block starts at a word
        of its template, which loses none; of blocks of a template that overlap the best counts.
        """
        found = []
        for t, own in enumerate(self.words):
            mine = np.flatnonzero(self.member[t][ranks])
            p, r = at[mine], ranks[mine]
            lo, hi = np.arange(len(p)), np.searchsorted(p, np.minimum(p + self.length[t], end[mine]))
            rare = np.concatenate(([0], np.cumsum(self.rare[t][r])))
            free, last = -1, None
            for k in np.flatnonzero((hi - lo >= self.need[t]) & (rare[hi] > rare[lo]) & (line[mine[hi - 1]] != line[mine])).tolist():
                both = len(set(r[k : hi[k]].tolist()))
                if both < self.need[t] or (p[k] < free and both / len(own) <= last[3]):
                    continue
                if p[k] < free:
                    found.pop()
                last = (int(mine[k]), int(mine[hi[k] - 1]), t, both / len(own))
                found.append(last)
                free = p[k] + self.length[t]
        return found


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, str] | None = None,
    templates: list[tuple[str, str]] | None = None,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks.

    Words are letters, digits and non-ASCII characters, A-Z lower-cased. n_base: all places where a phrase's words
    stand consecutively; first_word and last_word: smallest and largest of those places (else null). labels: base
    labels and those of matching templates, distinct, sorted, comma-joined. score: the largest containment of a
    template by a block, 0 without one. blocks: (line, label, containment) of all template matches, those over line
    breaks by their first line, and only where none of their lines alone holds as much of the template.
    Null or empty text: zeros, nulls and empty strings. Null id: kept as null. Repeated rows: one result each. Empty
    input: empty result. Templates and phrases are short lists and travel with the task.
    A very long text is read whole. Other columns, also those named like results, are not read.
    """
    phrases, templates = phrases if phrases is not None else PHRASES, templates if templates is not None else TEMPLATES
    docs = texts(docs, id_col, text_col)
    vocabulary = np.unique(np.concatenate([_hashes(text) for _, text in templates])) if templates else np.zeros(1, tv.U)
    index = Index(templates, vocabulary, word_frequencies(docs, vocabulary), containment)
    sought = [(_hashes(p), label) for p, label in phrases.items()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in tv.runs(batch.column("text")):
                w, lines = tv.words(run, tv.ALNUM), tv.words(run, tv.LINES)
                first = w.firsts(run.n)
                base: dict[int, list[tuple[int, str]]] = {}
                for h, label in sought:
                    at = np.flatnonzero(w.hash == h[0])
                    for k in range(1, len(h)):
                        at = at[at + k < len(w.hash)]
                        at = at[(w.hash[at + k] == h[k]) & (w.doc[at + k] == w.doc[at])]
                    for x in at.tolist():
                        base.setdefault(int(w.doc[x]), []).append((x - int(first[w.doc[x]]), label))
                blocks: dict[int, list[dict]] = {}
                at, ranks = index.ranks(w.hash)
                line = np.searchsorted(lines.start, w.start[at], side="right") - 1
                edge = np.flatnonzero(np.diff(line, prepend=-1)) if len(line) else np.zeros(0, int)
                hot = np.flatnonzero(np.logical_or.reduceat(index.starts[ranks], edge)) if len(edge) else []
                edge = np.append(edge, len(line))
                alone: dict[tuple[int, int], float] = {}
                breaks = np.flatnonzero(run.data == 10)

                def meet(at_line: int, t: int, share: float) -> None:
                    d = int(lines.doc[at_line])
                    number = int(np.subtract(*np.searchsorted(breaks, (lines.start[at_line], run.offsets[d]))))
                    blocks.setdefault(d, []).append({"line": number, "label": index.labels[t], "containment": share})

                for b in hot:
                    lo, hi = edge[b], edge[b + 1]
                    for t, share in index.matches(np.unique(ranks[lo:hi]).tolist()):
                        alone[int(line[lo]), t] = share
                        meet(line[lo], t, share)
                for lo, hi, t, share in index.wrapped(at, ranks, line, first[w.doc[at] + 1]):
                    if all(alone.get((x, t), 0.0) < share for x in range(int(line[lo]), int(line[hi]) + 1)):
                        meet(line[lo], t, share)
                rows = []
                for d in range(run.n):
                    own, met = base.get(d, []), blocks.get(d, [])
                    labels = {label for _, label in own}
                    places = [x for x, _ in own]
                    every, score = labels | {m["label"] for m in met}, max((m["containment"] for m in met), default=0.0)
                    rows.append(
                        (
                            len(own),
                            min(places, default=None),
                            max(places, default=None),
                            ",".join(sorted(labels)),
                            ",".join(sorted(every)),
                            score,
                            met,
                        ),
                    )
                block = pa.struct([("line", pa.int64()), ("label", pa.string()), ("containment", pa.float64())])
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(block)]
                own = [batch.column("doc_id").slice(run.first, run.n), pa.array(np.diff(first))]
                cols = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*own, *cols],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        scan,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "blocks array<struct<line:long,label:string,containment:double>>",
    )


def _sql() -> str:
    """The same rows in DuckDB SQL: every phrase at every place, every template against every line, and against as many
    words as it has from each of its words on."""
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    upper = "".join(map(chr, range(65, 91)))
    words = lambda text: "regexp_extract_all(translate('" + text + f"', '{upper}', '{upper.lower()}'), '{pattern}')"
    phrases = ", ".join(f"('{label}', {words(p)})" for p, label in PHRASES.items())
    templates = ", ".join(f"({i}, '{label}', list_distinct({words(t)}), len({words(t)}))" for i, (label, t) in enumerate(TEMPLATES))
    return f"""
with d as (select row_number() over () as r, doc_id, translate(coalesce(text, ''), '{upper}', '{upper.lower()}') as t from documents),
w as (select r, doc_id, t, regexp_extract_all(t, '{pattern}') as w from d),
ph(label, p) as (values {phrases}), tp(id, label, t, n) as (values {templates}), tw as (select *, unnest(t) as word from tp),
spot as materialized (select r, w, unnest(range(0, len(w))) as i from w),
hit as (select r, i, label from spot, ph where w[i + 1] = p[1] and w[i + 1 : i + len(p)] = p),
base as (select r, count(*) as n, min(i) as lo, max(i) as hi, list(distinct label) as ls from hit group by r),
line as (select r, list_distinct(regexp_extract_all(l, '{pattern}')) as lw from (select r, unnest(string_split(t, chr(10))) as l from w)),
met as (select r, label, len(list_intersect(lw, tp.t)) / len(tp.t) as share from line, tp
  where len(list_intersect(lw, tp.t)) >= ceil({CONTAINMENT} * len(tp.t) - 1e-9)),
part as (select r, label, t, list_distinct(w[i + 1 : i + n]) as pw from spot join tw on word = w[i + 1]),
ow as (select r, label, len(list_intersect(pw, t)) / len(t) as share from part
  where len(list_intersect(pw, t)) >= ceil({CONTAINMENT} * len(t) - 1e-9)),
best as (select r, max(share) as score, list(distinct label) as ls from (select * from met union all select * from ow) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_base, cast(lo as bigint) as first_word, cast(hi as
  bigint) as last_word,
  coalesce(array_to_string(list_sort(base.ls), ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.ls, []), coalesce(best.ls, [])))), ','), '') as labels,
    cast(coalesce(score, 0) as double) as score
from w left join base using (r) left join best using (r)
"""


SQL = _sql()
