"""Substring deduplication by line hashing.

Texts are cut into lines, and lines at sentence ends; each unit's normalised words are hashed, digests are grouped over
the whole corpus, and the earliest occurrence (by document id, then position) is the one that stays. Of the later ones
those go that stand in a run: a single sentence or heading may come back by chance, so consecutive repeated units are
judged together, by the words of the whole run. Offsets are those of the original.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import textvec as tv
from tradewind.llm.shared import save, texts

#: A passage that was pasted into other text shares its first and last sentence with its surroundings; what is whole of
#: a passage of 50 words has about 30.
MIN_RUN_WORDS = 30
ENDS = b".!?"

_END = np.zeros(256, bool)
_END[np.frombuffer(ENDS, np.uint8)] = True
_KEY = "k1 long, k2 long, pos long, h1 long, h2 long"


@dataclass
class Units:
    """Units in order: document, first word and the one after the last, and where the unit's extent starts in bytes.
    An extent reaches to that of the next unit: it has the white space and blank lines after the unit."""

    doc: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    start: np.ndarray
    words: tv.Words

    def firsts(self, n: int) -> np.ndarray:
        return np.searchsorted(self.doc, np.arange(n + 1))


def cut(run: tv.Run) -> Units:
    """A unit ends with its line, or at a word that ends in one of ``ENDS`` unless that is the first word of its line or
    the word before ends so too (abbreviations, shouting)."""
    w = tv.words(run, tv.LOWER)
    n = len(w.doc)
    if not n:
        none = np.zeros(0, np.int64)
        return Units(none, none, none, none, w)
    breaks = np.flatnonzero(run.data == 10)
    upto = np.searchsorted(breaks, w.start)
    new_doc = np.ones(n, bool)
    new_doc[1:] = w.doc[1:] != w.doc[:-1]
    new_line = new_doc.copy()
    new_line[1:] |= upto[1:] > np.searchsorted(breaks, w.end[:-1])
    ends = _END[run.data[w.end - 1]]
    closes = ends & ~new_line
    closes[1:] &= ~ends[:-1]
    new = new_line
    new[1:] |= closes[:-1]
    lo = np.flatnonzero(new)
    after_break = np.where(upto[lo] > 0, breaks[np.maximum(upto[lo] - 1, 0)] + 1, 0) if len(breaks) else np.zeros(len(lo), np.int64)
    after_word = np.where(new_doc[lo], run.offsets[w.doc[lo]], w.end[np.maximum(lo - 1, 0)])
    return Units(w.doc[lo], lo, np.append(lo[1:], n), np.maximum(after_break, after_word), w)


def digests(run: tv.Run, u: Units) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each unit: its words with A-Z lower-cased and one blank between them."""
    inside = tv.LOWER.inside[run.data]
    keep = np.append(inside, False)
    keep[u.words.end] = True
    plain = np.append(np.where(inside, tv.LOWER.folded(run.data), 32), 32).astype(np.uint8)[keep]
    at = np.concatenate(([0], np.cumsum(keep)))
    start, end = at[u.words.start[u.lo]], at[u.words.end[u.hi - 1]]
    return tuple(tv.span_hashes(plain, start, end, seed).view(np.int64) for seed in (1, 2))


def units(docs: DataFrame) -> DataFrame:
    """Rows (k1, k2, pos, h1, h2) of all units."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in tv.runs(batch.column("text")):
                u = cut(run)
                at = pa.array(run.first + u.doc)
                pos = np.arange(len(u.doc)) - u.firsts(run.n)[u.doc]
                keys = [batch.column(k).take(at) for k in ("k1", "k2")]
                yield pa.RecordBatch.from_arrays([*keys, *map(pa.array, (pos, *digests(run, u)))], ["k1", "k2", "pos", "h1", "h2"])

    return docs.select("k1", "k2", "text").mapInArrow(each, _KEY)


def _runs(gone: np.ndarray, words: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(first, one after the last) of the runs of consecutive positions in ``gone`` that have ``least`` words."""
    if not len(gone):
        return []
    gone = np.sort(gone)
    edge = np.flatnonzero(np.diff(gone, prepend=gone[0] - 2) > 1)
    total = np.add.reduceat(words[gone], edge)
    last = gone[np.append(edge[1:], len(gone)) - 1]
    return [(a, b + 1) for a, b, n in zip(gone[edge].tolist(), last.tolist(), total.tolist(), strict=True) if n >= least]


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_run_words: int = MIN_RUN_WORDS) -> DataFrame:
    """One row per input row: doc_id, n_units, n_repeated, n_removed, removed (array of start, end), removed_spans, clean_text.

    Units are lines with a word, cut further at sentence ends; their words are compared lower-cased (A-Z) and without
    regard to white space, whatever their number. Of equal units the one with the smallest (doc_id, position) stays in
    the corpus. Others go, also within one document, if they stand in a run of such units with at least
    ``min_run_words`` words together; 1 removes all of them. n_repeated counts units that are not the one that stays,
    n_removed those of them that go; spans are one per run: code points of the original text,
    end exclusive, up to where the next unit starts; ``clean_text`` is all the rest, unchanged. Null or empty text: no
    units, clean_text ''. Null id: ranked first. Rows that repeat both id and text count as one document and get the
    same result. Empty input: empty result.
    A very long text is read whole. Other columns, also those named like results, are not read.
    """
    docs = texts(docs, id_col, text_col).withColumn("k1", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("k2", F.xxhash64("text"))
    every = units(docs)
    place = F.struct("k1", "k2", "pos")
    # A place that comes twice is that of a repeated row. Stored, so that the join below deals out both of its sides and
    # Spark can split the rows of a very common unit.
    first = every.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    first = save(first.select("h1", "h2", "first"), "repeated")
    gone = every.join(first, ["h1", "h2"]).where(place != F.col("first")).groupBy("k1", "k2").agg(F.collect_set("pos").alias("gone"))
    out = docs.join(gone, ["k1", "k2"], "left").select("doc_id", "text", "gone")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = batch.column("gone").to_pylist()
            for run in tv.runs(batch.column("text")):
                u, raw = cut(run), run.data.tobytes()
                first, size = u.firsts(run.n), u.hi - u.lo
                rows: dict[str, list] = {"n_repeated": [], "n_removed": [], "removed": [], "removed_spans": [], "clean_text": []}
                for i in range(run.n):
                    lo, hi, text_end = first[i], first[i + 1], int(run.offsets[i + 1])
                    starts = [*u.start[lo:hi].tolist(), text_end]
                    spans, kept, at, chars, n = [], [], int(run.offsets[i]), 0, 0
                    for a, b in _runs(np.array(gone[run.first + i] or [], np.int64), size[lo:hi], min_run_words):
                        part = raw[at : starts[a]].decode()
                        begin = chars + len(part)
                        chars = begin + len(raw[starts[a] : starts[b]].decode())
                        spans.append({"start": begin, "end": chars})
                        kept.append(part)
                        at, n = starts[b], n + b - a
                    kept.append(raw[at:text_end].decode())
                    rows["n_repeated"].append(len(gone[run.first + i] or []))
                    rows["n_removed"].append(n)
                    rows["removed"].append(spans)
                    rows["removed_spans"].append(",".join(f"{x['start']}:{x['end']}" for x in spans))
                    rows["clean_text"].append("".join(kept))
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string(), pa.string()]
                own = [batch.column("doc_id").slice(run.first, run.n), pa.array(np.diff(first), pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [*own, *(pa.array(c, k) for c, k in zip(rows.values(), kinds, strict=True))],
                    ["doc_id", "n_units", *rows],
                )

    return out.mapInArrow(
        rebuild,
        "doc_id long, n_units long, n_repeated long, n_removed long, removed array<struct<start:long,end:long>>, removed_spans string, clean_text string",
    )


_BLANK, _WORD = r"[\x20\x09\x0B-\x0D]", r"[^\x20\x09-\x0D]"


def sql(min_run_words: int = MIN_RUN_WORDS) -> str:
    """The same rows in DuckDB SQL, without the array of spans. chr(57344), a private character, marks where units end."""
    return rf"""
with d as (select doc_id, coalesce(text, '') as text, row_number() over () as r from documents),
s as (select r, doc_id, text, string_split(replace(regexp_replace(text, '([^\x20\x09-\x0D.!?]{_BLANK}+{_WORD}*[.!?])({_BLANK})', '\1' ||
  chr(57344) || '\2', 'g'),
             chr(10), chr(10) || chr(57344)), chr(57344)) as s from d),
p as (select r, doc_id, text, unnest(range(1, len(s) + 1)) as i, s from s),
q as (select r, doc_id, text, i, s[i] as piece, coalesce(sum(length(s[i])) over (partition by r order by i rows between unbounded preceding
  and 1 preceding), 0) as start,
             count(*) filter (regexp_matches(s[i], '{_WORD}')) over (partition by r order by i rows unbounded preceding) as u from p),
e as (select r, doc_id, text, u, min(start) as start, max(start + length(piece)) as stop, string_agg(piece, '' order by i) as extent from q
  group by 1, 2, 3, 4),
w as (select *, regexp_extract_all(translate(extent, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}+') as words
  from e),
g as (select *, len(words) as n, u > 0 and row_number() over (partition by array_to_string(words, ' ')
  order by u = 0, doc_id nulls first, text, u) > 1 as again from w),
b as (select *, count(*) filter (not again) over (partition by r order by u rows unbounded preceding) as island from g),
x as (select *, again and sum(n) filter (again) over (partition by r, island) >= {min_run_words} as gone from b),
y as (select r, string_agg(span, ',' order by start) as spans from (select r, min(start) as start, cast(min(start) as bigint) || ':' ||
  cast(max(stop) as bigint) as span from x where gone group by r, island) group by r)
select doc_id, cast(count(*) filter (u > 0) as bigint) as n_units, cast(count(*) filter (again) as bigint) as n_repeated,
  cast(count(*) filter (gone) as bigint) as n_removed,
  coalesce(any_value(spans), '') as removed_spans,
       coalesce(string_agg(extent, '' order by u) filter (not gone), '') as clean_text
from x left join y using (r) group by r, doc_id
"""


SQL = sql()
