"""Source divergence audit: how far the term shares of each source are from those of the others of its language.

Chunk factorization: texts are cut at white space only, and chunks are counted per document. A row per (language, chunk)
has the counts by source, and, for the rule that a term must be in some documents of the language, in how many documents
the chunk is and which are the first and the last: with at most two, these are all of them. Rows of a chunk meet, so each
globally distinct chunk is cut into terms once; its terms take over the chunk's counts and are added up by (language,
term). Rows are merged in tasks before each shuffle, so a very common chunk or term costs a row per task.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.llm import textvec as tv
from tradewind.llm.shared import save

#: A term must be in three documents of its language. Other numbers need more than a first and a last document.
MIN_DOCUMENTS = 3
RANKS = 200
SCALE = 1_000_000_000
#: Sources of one tile and terms of one block: what a task of the pair part holds.
TILE, BLOCK = 64, 8192
#: Counts that a task adds up before it hands them on.
HELD = 600_000

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}

#: ``codes`` and ``counts``: one long for each source that has the chunk or term.
_ROWS = "lang string, {} string, docs long, low long, high long, codes binary, counts binary"


def _longs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The longs in a binary column, one after the other, and how many each row has."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return raw.view(np.int64) if len(raw) else np.zeros(0, np.int64), np.diff(at) // 8


def _binary(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes) * 8)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(values.astype(np.int64))])


class _Merger:
    """Adds up rows of one (language, name): counts by source, and whether one, two or more documents have it."""

    def __init__(self, name: str):
        self.name, self.size = name, 0
        self.parts: list[tuple] = []

    def add(self, lang: pa.Array, name: pa.Array, docs: np.ndarray, low: np.ndarray, high: np.ndarray, codes: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> None:
        self.parts.append((lang, name, docs, low, high, codes, counts, sizes))
        self.size += len(codes)

    def merged(self) -> pa.RecordBatch:
        """All rows so far, one per language and name, in that order."""
        parts, self.parts, self.size = self.parts, [], 0
        lang = pa.chunked_array([p[0] for p in parts], pa.string()).combine_chunks().dictionary_encode()
        name = pa.chunked_array([p[1] for p in parts], pa.string()).combine_chunks().dictionary_encode()
        docs, low, high, codes, counts, sizes = (np.concatenate([p[i] for p in parts]) for i in range(2, 8))
        key = lang.indices.to_numpy().astype(np.int64) * (len(name.dictionary) + 1) + name.indices.to_numpy()
        keys, first, group = np.unique(key, return_index=True, return_inverse=True)
        # Counts by group and source.
        of = np.repeat(group, sizes)
        order = np.lexsort((codes, of))
        of, codes, counts = of[order], codes[order], counts[order]
        new = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(codes, prepend=-1) != 0))
        summed = np.add.reduceat(counts, new) if len(new) else counts
        # Documents: a row of at most two names them all.
        many = np.bincount(group, docs >= MIN_DOCUMENTS, len(keys)) > 0
        named = np.concatenate((group, group)), np.concatenate((low, high))
        order = np.lexsort((named[1], named[0]))
        which, doc = named[0][order], named[1][order]
        distinct = np.bincount(which, (np.diff(which, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0), len(keys)).astype(np.int64)
        ends = np.searchsorted(which, np.arange(len(keys) + 1))
        return pa.RecordBatch.from_arrays(
            [
                lang.dictionary.take(pa.array(lang.indices.to_numpy()[first])),
                name.dictionary.take(pa.array(name.indices.to_numpy()[first])),
                pa.array(np.where(many, MIN_DOCUMENTS, np.minimum(distinct, MIN_DOCUMENTS))),
                pa.array(doc[ends[:-1]]),
                pa.array(doc[ends[1:] - 1]),
                _binary(codes[new], (sized := np.bincount(of[new], minlength=len(keys)))),
                _binary(summed, sized),
            ],
            ["lang", self.name, "docs", "low", "high", "codes", "counts"],
        )


def _sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, 50_000):
        yield batch.slice(at, 50_000)


def _chunks(held: int) -> Callable:
    """lang, code (of the source), row, text to chunk rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = _Merger("chunk")
        for batch in batches:
            for run in tv.runs(batch.column("text"), 4 * tv.CHUNK):
                part = batch.slice(run.first, run.n)
                words = pc.ascii_split_whitespace(part.column("text"))
                owner, flat = pc.list_parent_indices(words).to_numpy(), pc.list_flatten(words).dictionary_encode()
                full, codes = flat.dictionary, flat.indices.to_numpy()
                # Per document: each distinct chunk with its count.
                key, n = np.unique(owner.astype(np.int64) * (len(full) + 1) + codes, return_counts=True)
                doc, chunk = np.divmod(key, len(full) + 1)
                some = pc.not_equal(full, "").to_numpy(zero_copy_only=False)[chunk] if len(full) else np.zeros(0, bool)
                doc, chunk, n = doc[some], chunk[some], n[some]
                row, one = part.column("row").to_numpy()[doc], np.ones(len(doc), np.int64)
                merger.add(part.column("lang").take(pa.array(doc)), full.take(pa.array(chunk)), one, row, row, part.column("code").to_numpy()[doc], n, one)
                if merger.size > held:
                    yield from _sliced(merger.merged())
        if merger.parts:
            yield from _sliced(merger.merged())

    return count


def chunk_terms(chunk: str) -> dict[str, int]:
    """The terms of a chunk with their counts."""
    found = TERM.findall(chunk.translate(LOWER))
    return {t: found.count(t) for t in found} if len(found) > 1 else dict.fromkeys(found, 1)


def _terms(held: int) -> Callable:
    """Chunk rows in order of the chunk to term rows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger, last = _Merger("term"), (None, {})
        for batch in batches:
            chunk = batch.column("chunk").dictionary_encode()
            # The chunk that the last batch ended with may go on.
            found = [last[1] if c == last[0] else chunk_terms(c) for c in chunk.dictionary.to_pylist()]
            if len(batch):
                last = (batch.column("chunk")[-1].as_py(), found[chunk.indices[-1].as_py()])
            each = np.array([len(f) for f in found], np.int64)[(at := chunk.indices.to_numpy())]
            # Row i of the batch stands for each of its chunk's terms.
            names, times = [t for f in found for t in f], np.array([k for f in found for k in f.values()], np.int64)
            start = np.concatenate(([0], np.cumsum([len(f) for f in found])))[at]
            rows = np.repeat(np.arange(len(batch)), each)
            place = np.repeat(start, each) + np.arange(len(rows)) - np.repeat(np.cumsum(each) - each, each)
            codes, sizes = _longs(batch.column("codes"))
            counts, _ = _longs(batch.column("counts"))
            begin, size = (np.cumsum(sizes) - sizes)[rows], sizes[rows]
            entry = np.repeat(begin, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            take = lambda c: batch.column(c).to_numpy()[rows]  # noqa: B023, E731
            term = pa.array(names, pa.string()).take(pa.array(place))
            merger.add(batch.column("lang").take(pa.array(rows)), term, take("docs"), take("low"), take("high"), codes[entry], counts[entry] * np.repeat(times[place], size) if len(rows) else counts[:0], size)
            if merger.size > held:
                yield from _sliced(merger.merged())
        if merger.parts:
            yield from _sliced(merger.merged())

    return cut


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Term rows in order of language and term, merged, to those with MIN_DOCUMENTS documents."""
    merger, names = _Merger("term"), ["lang", "term", "of_lang", "codes", "counts"]

    def kept(found: pa.RecordBatch) -> pa.RecordBatch:
        counts, sizes = _longs(found.column("counts"))
        ends = np.cumsum(sizes)
        sums = np.concatenate(([0], np.cumsum(counts)))
        out = pa.RecordBatch.from_arrays([found.column(0), found.column(1), pa.array(sums[ends] - sums[ends - sizes]), found.column(5), found.column(6)], names)
        return out.filter(pc.greater_equal(found.column("docs"), MIN_DOCUMENTS))

    def add(batch: pa.RecordBatch) -> None:
        codes, sizes = _longs(batch.column("codes"))
        merger.add(*(batch.column(i) for i in range(2)), *(batch.column(i).to_numpy() for i in range(2, 5)), codes, _longs(batch.column("counts"))[0], sizes)

    for batch in batches:
        if not len(batch):
            continue
        add(batch)
        found, last = merger.merged(), (batch.column(0)[-1], batch.column(1)[-1])
        open_ = pc.and_(pc.equal(found.column(0), last[0]), pc.equal(found.column(1), last[1]))
        yield kept(found.filter(pc.invert(open_)))
        # The last term may go on in the next batch: what is known of it is one row.
        add(found.filter(open_))
    if merger.parts:
        yield kept(merger.merged())


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per term and source."""
    for batch in batches:
        codes, sizes = _longs(batch.column("codes"))
        rows = pa.array(np.repeat(np.arange(len(batch)), sizes))
        columns = [batch.column(c).take(rows) for c in ("lang", "term", "of_lang")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(codes), pa.array(_longs(batch.column("counts"))[0])], ["lang", "term", "of_lang", "code", "n"])


def _by_tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Term rows cut by the tile of their sources."""
    for batch in batches:
        codes, sizes = _longs(batch.column("codes"))
        row = np.repeat(np.arange(len(batch)), sizes)
        tile = codes % batch.column("tiles").to_numpy()[row]
        order = np.lexsort((tile, row))
        row, tile = row[order], tile[order]
        new = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(tile, prepend=-1) != 0))
        size = np.diff(np.append(new, len(row)))
        columns = [batch.column(c).take(pa.array(row[new])) for c in ("lang", "block", "tiles", "term")]
        values = [_binary(x[order], size) for x in (codes, _longs(batch.column("counts"))[0])]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(tile[new]), *values], ["lang", "block", "tiles", "term", "tile", "codes", "counts"])


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (n + v)); in decimals, as such products do not fit a long; null without terms."""
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.when(v > 0, _div(scaled, (n + v).cast("decimal(20,0)")) + 1)


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares are at most SCALE + 1, so the square fits a long."""
    return _div((p - q) * (p - q), q)


def _shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``share`` of counts, ``total`` being n + v; as whole numbers of any size where products do not fit a long."""
    if counts.max(initial=0) >= np.iinfo(np.int64).max // SCALE - 1:
        counts, total = counts.astype(object), total.astype(object)
    return (1 + SCALE * (counts + 1) // total).astype(np.int64)


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Sums of ``gap`` over the terms for each row of ``p`` against each row of ``q``."""
    return np.stack([((row - q) ** 2 // q).sum(axis=1) for row in p])


_PAIR = "lang string, source string, item string, value long, seen long"


def _tile_pair(key: tuple, rows: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """All pairs of sources between two tiles over one block of terms."""
    groups = groups.sort_values("code").reset_index(drop=True)
    kinds, terms = pd.factorize(rows["term"])
    counts = np.zeros((len(groups), len(terms)), np.int64)
    if len(rows):
        sizes = rows["codes"].str.len().to_numpy() // 8
        line = np.searchsorted(groups["code"].to_numpy(), np.frombuffer(b"".join(rows["codes"]), np.int64))
        counts[line, np.repeat(kinds, sizes)] = np.frombuffer(b"".join(rows["counts"]), np.int64)
    shares = _shares(counts, np.maximum(groups["n_group"] + groups["v"], 1).to_numpy()[:, None])
    names, tile = groups["source"].to_numpy(object), groups["tile"].to_numpy()
    pairs, sums = [], [np.zeros(0, np.int64)]
    for a, b in {(key[2], key[3]), (key[3], key[2])}:
        left, right = np.flatnonzero(tile == a), np.flatnonzero(tile == b)
        if len(left) and len(right):
            apart = left[:, None] != right
            pairs += [(s, t) for s in names[left] for t in names[right] if s != t]
            sums.append(_gaps(shares[left], shares[right])[apart])
    found = pd.DataFrame({"lang": key[0], "source": [s for s, _ in pairs], "item": [t for _, t in pairs]}, dtype=object)
    return found.assign(value=np.concatenate(sums), seen=len(terms))


def divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    ranks: int = RANKS,
    tile: int = TILE,
    block: int = BLOCK,
    held: int = HELD,
) -> DataFrame:
    """lang, source, part, item, value, rank: how each (language, source) group differs from its language.

    Terms are runs of letters (ASCII ones, A-Z lower-cased, and all beyond ASCII); a language keeps those in at least
    three of its documents. A group gives each kept term the share p = 1 + floor(10^9 (count + 1) / (N + V)), also those
    that it does not have; the gap of p to another share q is floor((p - q)^2 / q). Part ``pair``: every other source of
    the language, with the sum of gaps to its shares over all kept terms. Part ``term``: the group's terms with a larger
    share than in the whole language and their gaps, the ``ranks`` largest. Equal values are ranked by item.

    Every row of ``docs`` is a document. Null text, language or source: empty. Empty texts and such without a term still
    make their group known; a language without kept terms has pairs of value 0. Texts of any length are cut whole.
    Repeated rows are documents of their own. Empty table: empty result. Other columns are not read.
    """
    text, lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text_col, lang_col, source_col))
    names = save(docs.select(lang.alias("lang"), source.alias("source")).distinct(), "divergence-groups")
    # Sources go by a number; one that two of them share is looked for, and then another numbering taken.
    seed = 0
    coded = lambda c: F.xxhash64(c, F.lit(seed)).bitwiseAND(F.lit((1 << 63) - 1))
    while not names.select("source").distinct().groupBy(coded(F.col("source")).alias("code")).count().where("count > 1").isEmpty():
        seed += 1
    rows = docs.select(lang.alias("lang"), coded(source).alias("code"), text.alias("text"), F.monotonically_increasing_id().alias("row"))
    chunks = rows.mapInArrow(_chunks(held), _ROWS.format("chunk")).repartition("chunk").sortWithinPartitions("chunk")
    found = chunks.mapInArrow(_terms(held), _ROWS.format("term")).repartition("lang", "term").sortWithinPartitions("lang", "term")
    terms = save(found.mapInArrow(_kept, "lang string, term string, of_lang long, codes binary, counts binary"), "divergence-terms")
    cells = terms.mapInArrow(_cells, "lang string, term string, of_lang long, code long, n long")

    # Sizes: V and N of each language, N of each group. These tables have a row a language or group; joins go by size.
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("of_lang").alias("n_lang"))
    langs = names.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(langs, "lang", "left").na.fill(0, ["v", "n_lang"])
    tiles, blocks = F.ceil(F.col("sources") / tile).cast("int"), F.greatest(F.ceil(F.col("v") / block), F.lit(1)).cast("int")
    langs = save(langs.withColumns({"tiles": tiles, "blocks": blocks}), "divergence-languages")
    groups = names.withColumn("code", coded(F.col("source"))).join(cells.groupBy("lang", "code").agg(F.sum("n").alias("n_group")), ["lang", "code"], "left")
    groups = groups.join(langs, "lang").na.fill(0, ["n_group"]).withColumn("tile", F.col("code") % F.col("tiles"))
    groups = save(groups.withColumn("none", share(F.lit(0), F.col("n_group"), F.col("v"))), "divergence-sizes")

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    p, q = share(F.col("n"), F.col("n_group"), F.col("v")), share(F.col("of_lang"), F.col("n_lang"), F.col("v"))
    more = cells.join(groups.drop("none", "tile", "tiles"), ["lang", "code"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
    more = more.where("p > q").select("lang", "source", "item", gap(F.col("p"), F.col("q")).alias("value"))
    more = more.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= ranks)

    # Pairs: sources in tiles, terms in blocks; each task has two tiles and a block.
    pair = (F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles").cast("long") - 1)).alias("other")
    dealt = terms.join(langs, "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
    dealt = dealt.select("lang", "block", "tiles", "term", "codes", "counts")
    dealt = dealt.mapInArrow(_by_tile, "lang string, block int, tiles int, term string, tile long, codes binary, counts binary").select("*", others)
    each = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("*", others)
    met = dealt.groupBy("lang", "block", *pair).cogroup(each.groupBy("lang", "block", *pair))
    sums = met.applyInPandas(_tile_pair, _PAIR).groupBy("lang", "source", "item").agg(F.sum("value").alias("sum"), F.sum("seen").alias("seen"))
    # Terms that neither of a pair's tiles has: both have the share of a count of 0.
    own = groups.select("lang", "source", "v", F.col("none").alias("p0"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("none").alias("q0"))
    pairs = sums.join(own, ["lang", "source"]).join(other, ["lang", "item"])
    rest = F.when(F.col("v") > F.col("seen"), (F.col("v") - F.col("seen")) * gap(F.col("p0"), F.col("q0"))).otherwise(0)
    pairs = pairs.select("lang", "source", "item", (F.col("sum") + rest).alias("value")).withColumn("rank", F.row_number().over(by_value))
    pairs, more = pairs.withColumn("part", F.lit("pair")), more.withColumn("part", F.lit("term"))
    return pairs.unionByName(more).select("lang", "source", "part", "item", "value", "rank")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), found AS (
  SELECT row, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term FROM found GROUP BY lang, term HAVING count(DISTINCT row) >= 3
), sizes AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), cells AS (
  SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY ALL
), groups_ AS (
  SELECT lang, source, coalesce(any_value(v), 0) AS v, coalesce(any_value(total), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN sizes USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM cells GROUP BY ALL) USING (lang, source)
  GROUP BY lang, source
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + g.v) AS p
  FROM groups_ g JOIN kept k USING (lang) LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), whole AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM cells GROUP BY ALL) JOIN sizes USING (lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(any_value(x.value), 0) AS value
  FROM groups_ a JOIN groups_ b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT s.lang, s.source, t.source AS item, sum((s.p - t.p) * (s.p - t.p) // t.p) AS value FROM shares s JOIN shares t ON s.lang = t.lang AND s.term = t.term GROUP BY ALL) x
    ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  GROUP BY ALL
), terms AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term', item, CAST(value AS BIGINT), CAST(rank AS INTEGER)
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms) WHERE rank <= 200
"""
