"""Benchmark decontamination: SimHash over item-sized windows.

For each benchmark item, windows of the item's number of words slide over a text; a window's 256-bit SimHash over its
weighted shingles is looked up in a multi-index, and the exact weighted similarity of the shingle sets verifies what is
within the radius. The index has a table per byte of the fingerprint: under each value the items whose byte differs from
it in at most ``NEAR`` bits. Fingerprints within the radius differ in more than ``NEAR`` bits in at most
radius // (NEAR + 1) bytes, so a window looks up its 32 bytes, and an item that is found less often than the other
bytes are is beyond the radius (of random pairs some 99 in 100 are).

The documents are read once, however many items there are. A bit table of fixed size tells which stretches of a text may
hold an item's shingle; these meet the table of shingles and their counts by a join. Windows whose shingles that some
item holds weigh less than the similarity asks for are like no item; the others are fingerprinted and meet the items of
their length in shards of the index. Weights are whole numbers, so sums along a text are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import textvec as tv
from tradewind.llm.shared import discard, save, texts

SHINGLE, SIMILARITY, RADIUS, BLOCK_ITEMS = 5, 0.8, 66, 4000
BITS, NEAR, UNIT = 256, 2, 1 << 24
#: The bit table: bits a shingle, least and most bits in all (powers of two), probes; bytes of a row of it.
SLOTS, LEAST, MOST, PROBES, SEGMENT = 64, 19, 28, 3, 1 << 15
#: A shard of windows has about so many rows and bytes; fingerprints are summed for so many windows at once.
SHARD_ROWS, SHARD_BYTES, PIECE, VOTES = 500, 8_000_000, 5_000, 4_000_000
_SALTS = tv.mix(np.arange(1, BITS // 64 + 1, dtype=tv.U) * tv.U(0x9E3779B97F4A7C15))
OUT = "doc_id long, text_key long, item_id long, start_word long, end_word long, hamming long, similarity double"
ITEMS = "item_no long, item_id long, n int, k int, shingles array<long>"
STRETCHES = "doc_no long, doc_id long, text_key long, words long, first long, hashes binary, hits array<struct<k: int, at: int, shingle: long>>"
WINDOWS = (
    "doc_no long, doc_id long, text_key long, words long, n int, first long, shingles binary, weights binary, starts binary, prints binary"
)


@dataclass
class Index:
    """Fingerprints of items; for each byte the items near each of its 256 values, and where each value's items begin."""

    prints: np.ndarray
    near: list[np.ndarray]
    at: list[np.ndarray]


def rolled(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words."""
    out = h[: max(len(h) - k + 1, 0)].copy()
    for i in range(1, k):
        out = tv.pair(out, h[i : i + len(out)])
    return out


def _bits(x: np.ndarray, salts: np.ndarray = _SALTS) -> np.ndarray:
    """``BITS`` columns (64 for each salt) of +1 and -1."""
    each = tv.mix(x[:, None] ^ salts)
    return np.unpackbits(each.view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    """Fingerprints as rows of bytes."""
    return np.packbits(sums > 0, axis=1)


def _cut(text: str | None, size: int) -> tuple[int, np.ndarray]:
    """Words and distinct shingles of an item."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    h = tv.words(tv.Run(0, raw, np.array([0, len(raw)])), tv.ALNUM).hash
    return len(h), np.unique(rolled(h, min(size, len(h)))) if len(h) else h


def weigh(total: int, held: np.ndarray) -> np.ndarray:
    """log(1 + items / items with the shingle) in whole units, so what many items share counts less."""
    return np.rint(np.log1p(total / np.maximum(held, 1)) * UNIT).astype(np.int64)


def _print(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The fingerprint of a set."""
    return _pack((_bits(shingles) * weights[:, None]).sum(axis=0)[None])[0]


def index_of(prints: np.ndarray) -> Index:
    """The multi-index of these fingerprints."""
    values = np.arange(256, dtype=np.uint8)
    near, at = [], []
    for byte in range(prints.shape[1]):
        value, item = np.nonzero(np.bitwise_count(values[:, None] ^ prints[:, byte]) <= NEAR)
        near.append(item)
        at.append(np.searchsorted(value, np.arange(257)))
    return Index(prints, near, at)


def build(items: list[tuple[int, str]], size: int = SHINGLE) -> Index | None:
    """The index of a few items at hand, weighted among themselves."""
    sets = [own for n, own in (_cut(text, size) for _, text in items) if n]
    if not sets:
        return None
    values, held = np.unique(np.concatenate(sets), return_counts=True)
    return index_of(np.stack([_print(own, weigh(len(sets), held[np.searchsorted(values, own)])) for own in sets]))


def _voted(index: Index, prints: np.ndarray, items: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, place in ``items``) of the pairs that are found under enough bytes: all within the radius and few more."""
    n, found = len(index.prints), []
    place = np.full(n, -1)
    place[items] = np.arange(len(items))
    step = max(1, VOTES // max(n, 1))
    for lo in range(0, len(prints), step):
        part = prints[lo : lo + step]
        votes = np.zeros(len(part) * n, np.uint8)
        for byte in range(prints.shape[1]):
            at, value = index.at[byte], part[:, byte].astype(int)
            many = at[value + 1] - at[value]
            ends = np.cumsum(many)
            # Under one byte a pair is found once.
            posted = index.near[byte][np.arange(int(ends[-1])) - np.repeat(ends - many - at[value], many)]
            votes[np.repeat(np.arange(len(part)) * n, many) + posted] += 1
        pairs = np.flatnonzero(votes >= prints.shape[1] - radius // (NEAR + 1))
        found.append(np.stack([pairs // n + lo, place[pairs % n]]))
    w, i = np.concatenate(found, axis=1) if found else np.zeros((2, 0), int)
    return w[i >= 0], i[i >= 0]


def _within(index: Index, prints: np.ndarray, items: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, item, distance) of all fingerprints within the radius, found through the index."""
    w, i = _voted(index, prints, items, radius)
    far = np.bitwise_count(prints[w] ^ index.prints[items[i]]).sum(axis=1).astype(int)
    ok = far <= radius
    return w[ok], items[i[ok]], far[ok]


def before(x: np.ndarray) -> np.ndarray:
    """Where the same value stood last, or -1."""
    out, order = np.full(len(x), -1), np.argsort(x, kind="stable")
    same = x[order][1:] == x[order][:-1]
    out[order[1:][same]] = order[:-1][same]
    return out


def sums(values: np.ndarray, last: np.ndarray, span: int) -> np.ndarray:
    """For each start the sum of whole-number ``values`` over ``span`` places, equal ones (``before``) counted once.

    A place counts again in the windows that begin at or before its last occurrence: these are a range of starts, so
    what is too much is a running sum as well, and repeats cost no more than other places.
    """
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.int64)
    np.cumsum(values, axis=0, out=total[1:])
    out = total[span:] - total[:-span]
    lo, hi = np.maximum(np.arange(len(values)) - span + 1, 0), np.minimum(last, len(out) - 1)
    again = np.flatnonzero(hi >= lo)
    if len(again):
        extra = np.zeros((len(out) + 1, *values.shape[1:]), np.int64)
        np.add.at(extra, lo[again], values[again])
        np.subtract.at(extra, hi[again] + 1, values[again])
        out -= np.cumsum(extra, axis=0)[:-1]
    return out


def fingerprints(sh: np.ndarray, weights: np.ndarray, span: int, starts: np.ndarray) -> np.ndarray:
    """The fingerprints of the windows at ``starts`` (sorted), by running sums over pieces of each stretch of starts."""
    out = []
    for part in np.split(starts, np.flatnonzero(np.diff(starts) > span) + 1):
        pieces = np.split(part, np.flatnonzero(np.diff((part - part[0]) // PIECE)) + 1)
        for piece in pieces:
            lo, hi = piece[0], piece[-1] + span
            x, w, last = sh[lo:hi], weights[lo:hi, None], before(sh[lo:hi])
            # 64 columns at a time bound memory.
            packed = [_pack(sums(_bits(x, salt[None]) * w, last, span)[piece - lo]) for salt in _SALTS]
            out.append(np.concatenate(packed, axis=1))
    return np.concatenate(out)


def _slots(x: np.ndarray, bits: int) -> np.ndarray:
    """The places of shingles in a table of 2 ** bits bits, one row a probe."""
    return np.stack([(tv.mix(x + tv.U(p)) >> tv.U(64 - bits)).astype(np.int64) for p in range(PROBES)])


def _items(benchmark: DataFrame, size: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for no, item, text in zip(*(batch.column(c).to_pylist() for c in ("item_no", "item_id", "text")), strict=True):
                n, own = _cut(text, size)
                if n:
                    row = [[no], [item], [n], [min(size, n)], [own.view(np.int64).tolist()]]
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, kinds, strict=True)], ["item_no", "item_id", "n", "k", "shingles"])

    rows = benchmark.where("text is not null and text != ''")
    rows = rows.select(F.monotonically_increasing_id().alias("item_no"), F.col("item_id").cast("long").alias("item_id"), "text")
    return rows.mapInArrow(cut, ITEMS)


def _bit_table(held: DataFrame, bits: int) -> np.ndarray:
    """Bits of all shingles that an item holds, as bytes: at most 2 ** MOST bits (32 MB) for any benchmark."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("shingle").to_numpy(zero_copy_only=False).view(tv.U)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_slots(x, bits)))], ["slot"])

    def fill(table: pa.Table) -> pa.Table:
        slots = table.column("slot").to_numpy()
        own = np.zeros(SEGMENT * 8, bool)
        own[slots % (SEGMENT * 8)] = True
        return pa.table({"segment": pa.array([int(slots[0]) // (SEGMENT * 8)], pa.int64()), "bits": pa.array([np.packbits(own).tobytes()], pa.binary())})

    slots = held.select("shingle").mapInArrow(place, "slot long").distinct()
    segments = slots.groupBy(F.shiftright("slot", (SEGMENT * 8).bit_length() - 1)).applyInArrow(fill, "segment long, bits binary")
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in segments.toLocalIterator():
        out[r.segment * SEGMENT : (r.segment + 1) * SEGMENT] = np.frombuffer(r.bits, np.uint8)
    return out


def _stretches(docs: DataFrame, table: np.ndarray, bits: int, lengths: list[int], longest: int) -> DataFrame:
    """Stretches of texts around places whose shingle the bit table knows, as word hashes: every window that holds such
    a place lies within one."""
    shipped = docs.sparkSession.sparkContext.broadcast(table)

    @tv.lean
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value
        for batch in batches:
            rows: list[tuple] = []
            for run in tv.runs(batch.column("text")):
                w = tv.words(run, tv.ALNUM)
                first = w.firsts(run.n)
                places = []
                for k in lengths:
                    sh = rolled(w.hash, k)
                    at = np.flatnonzero(w.doc[: len(sh)] == w.doc[k - 1 :]) if len(sh) else np.zeros(0, int)
                    for p in range(PROBES):
                        slot = (tv.mix(sh[at] + tv.U(p)) >> tv.U(64 - bits)).astype(np.int64)
                        at = at[(known[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1]
                    places.append(np.stack([at, np.full(len(at), k), sh[at].view(np.int64)]))
                every = np.concatenate(places, axis=1)
                every = every[:, np.argsort(every[0], kind="stable")]
                doc, at = w.doc[every[0]], every[0]
                new = np.flatnonzero((np.diff(doc) != 0) | (np.diff(at) > 2 * longest)) + 1
                for part in np.split(np.arange(len(at)), new) if len(at) else []:
                    d = int(doc[part[0]])
                    lo, hi = max(int(first[d]), int(at[part[0]]) - longest), min(int(first[d + 1]), int(at[part[-1]]) + longest)
                    hits = [{"k": k, "at": a, "shingle": s} for a, k, s in zip((at[part] - lo).tolist(), *every[1:, part].tolist(), strict=True)]
                    rows.append((run.first + d, int(first[d + 1] - first[d]), lo - int(first[d]), w.hash[lo:hi].tobytes(), hits))
            row, *cols = zip(*rows, strict=True) if rows else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.struct([("k", pa.int32()), ("at", pa.int32()), ("shingle", pa.int64())]))]
            of = [batch.column(c).take(pa.array(row, pa.int64())) for c in ("doc_no", "doc_id", "text_key")]
            names = ["doc_no", "doc_id", "text_key", "words", "first", "hashes", "hits"]
            yield pa.RecordBatch.from_arrays([*of, *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names)

    return docs.withColumn("doc_no", F.monotonically_increasing_id()).mapInArrow(scan, STRETCHES)


def _windows(stretches: DataFrame, total: int, size: int, similarity: float) -> DataFrame:
    """A row per stretch and item length: its windows that some item may be like, with fingerprints. ``hits`` are the
    places whose shingle some item holds, with the number of items and their lengths."""

    def look(row: dict) -> Iterator[tuple]:
        h, hits = np.frombuffer(row["hashes"], tv.U), row["hits"]
        at, k, held = (np.array([x[c] for x in hits]) for c in ("at", "k", "held"))
        worth = weigh(total, held)
        for n in sorted({n for x in hits for n in x["lengths"]}):
            size_n, reach = min(size, n), min(n, row["words"])
            sh, span = rolled(h, size_n), reach - size_n + 1
            if len(sh) < span:
                continue
            weights, shared = np.full(len(sh), weigh(total, np.array(1))), np.zeros(len(sh), np.int64)
            weights[at[k == size_n]] = worth[k == size_n]
            own = np.array([n in x["lengths"] for x in hits])
            shared[at[own]] = worth[own]
            last = before(sh)
            most = sums(shared, last, span)
            starts = np.flatnonzero((most > 0) & (most >= similarity * sums(weights, last, span) * (1 - 1e-12)))
            if len(starts):
                prints = fingerprints(sh, weights, span, starts)
                lo, hi = starts[0], starts[-1] + span
                yield n, row["first"] + int(lo), sh[lo:hi].tobytes(), weights[lo:hi].tobytes(), (starts - lo).tobytes(), prints.tobytes()

    @tv.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                rows = list(look(one.to_pylist()[0]))
                if rows:
                    of = [one.column(c).take(pa.array([0] * len(rows))) for c in ("doc_no", "doc_id", "text_key", "words")]
                    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
                    cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                    names = ["doc_no", "doc_id", "text_key", "words", "n", "first", "shingles", "weights", "starts", "prints"]
                    yield pa.RecordBatch.from_arrays([*of, *cols], names)

    return stretches.mapInArrow(run, WINDOWS)


def _verified(windows: pa.Table, items: pa.Table, total: int, size: int, similarity: float, radius: int) -> Iterator[tuple]:
    """(row, item, first word, distance, similarity) of the best window of each run of matching windows."""
    each = items.to_pylist()
    sets = [np.array(x["shingles"], np.int64).view(tv.U) for x in each]
    worth = [weigh(total, np.array(x["held"])) for x in each]
    index = index_of(np.stack([_print(s, w) for s, w in zip(sets, worth, strict=True)]))
    for at in range(windows.num_rows):
        row = windows.slice(at, 1).to_pylist()[0]
        sh, weights, starts = (np.frombuffer(row[c], t) for c, t in (("shingles", tv.U), ("weights", np.int64), ("starts", np.int64)))
        prints = np.frombuffer(row["prints"], np.uint8).reshape(-1, BITS // 8)
        w, i, far = _within(index, prints, np.arange(len(sets)), radius)
        if not len(w):
            continue
        span, last = min(row["n"], row["words"]) - min(size, row["n"]) + 1, before(sh)
        whole = sums(weights, last, span)
        for item in np.unique(i).tolist():
            own = i == item
            a, d = starts[w[own]], far[own]
            shared = sums(np.where(np.isin(sh, sets[item]), weights, 0), last, span)[a]
            union = whole[a] + worth[item].sum() - shared
            ok = shared >= similarity * union * (1 - 1e-12)
            a, d, alike = a[ok], d[ok], shared[ok] / union[ok]
            for part in np.split(np.arange(len(a)), np.flatnonzero(np.diff(a) > 1) + 1) if len(a) else []:
                b = part[np.argmax(alike[part])]
                yield at, item, row["first"] + int(a[b]), int(d[b]), float(alike[b])


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    size: int = SHINGLE,
    radius: int = RADIUS,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """One row per document, item and run of matching windows: doc_id, text_key, item_id, start_word, end_word,
    hamming, similarity (of the best window; words count from 0, end exclusive).

    Words are letters, digits and non-ASCII characters with A-Z lower-cased. Shingles have ``size`` words (an item with
    fewer has its whole sequence as one). A window matches at weighted Jaccard similarity >= ``similarity`` within
    Hamming distance ``radius``; a text with fewer words than the item is one window. Items of a length are dealt into
    shards of about ``block_items``, and windows of that length meet each; results do not depend on it.
    Null or empty text or item: matches nothing. Null ids: kept as null. Repeated rows: results each. Empty input or
    benchmark: empty result.
    A very long text is read whole. Other columns, also those named like results, are not read.
    Of equally similar windows of a run the first counts.
    """
    spark = docs.sparkSession
    items = save(_items(benchmark, size), "leak-items")
    total, longest, lengths = items.agg(F.count(F.lit(1)), F.max("n"), F.collect_set("k")).first()
    if not total:
        return spark.createDataFrame([], OUT)
    each = items.select("item_no", "n", "k", F.explode("shingles").alias("shingle"))
    held = save(each.groupBy("k", "shingle").agg(F.count(F.lit(1)).alias("held"), F.collect_set("n").alias("lengths")), "leak-shingles")
    bits = min(max((held.count() * SLOTS - 1).bit_length(), LEAST), MOST)
    stretches = save(_stretches(texts(docs, id_col, text_col), _bit_table(held, bits), bits, sorted(lengths), longest), "leak-stretches")

    hits = stretches.select("doc_no", "first", F.inline("hits")).join(held, ["k", "shingle"])
    hits = hits.groupBy("doc_no", "first").agg(F.collect_list(F.struct("at", "k", "held", "lengths")).alias("hits"))
    windows = save(_windows(stretches.drop("hits").join(hits, ["doc_no", "first"]), total, size, similarity), "leak-windows")
    discard(stretches)

    # Lengths of items are different numbers whose sum is at most the benchmark's words, so these are few rows (at most
    # the root of twice the words): shards of items and shares of windows of each length.
    weight = F.sum(F.length("shingles") + F.length("weights") + F.length("prints"))
    deal = (
        items.groupBy("n")
        .agg(F.ceil(F.count(F.lit(1)) / block_items).cast("int").alias("shards"))
        .join(
            windows.groupBy("n").agg(
                F.greatest(F.ceil(F.count(F.lit(1)) / SHARD_ROWS), F.ceil(weight / SHARD_BYTES)).cast("int").alias("shares"),
            ),
            "n",
        )
    )
    deal = F.broadcast(deal)
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    weighed = each.join(held.drop("lengths"), ["k", "shingle"]).groupBy("item_no")
    weighed = weighed.agg(F.collect_list("shingle").alias("shingles"), F.collect_list("held").alias("held"))
    weighed = items.select("item_no", "item_id", "n").join(weighed, "item_no").join(deal, "n")
    weighed = weighed.withColumn("shard", F.pmod(F.xxhash64("item_no"), "shards").cast("int")).withColumn("share", upto("shares"))
    met = windows.join(deal, "n")
    met = met.withColumn("share", F.pmod(F.xxhash64("doc_no", "first"), "shares").cast("int")).withColumn("shard", upto("shards"))

    def verify(left: pa.Table, right: pa.Table) -> pa.Table:
        found = list(_verified(left, right, total, size, similarity, radius)) if left.num_rows and right.num_rows else []
        row, item, start, far, alike = zip(*found, strict=True) if found else [()] * 5
        one = left.take(pa.array(row, pa.int64()))
        ends = [min(a + n, m) for a, n, m in zip(start, one.column("n").to_pylist(), one.column("words").to_pylist(), strict=True)]
        return pa.table(
            {
                "doc_id": one.column("doc_id"),
                "text_key": one.column("text_key"),
                "item_id": right.column("item_id").take(pa.array(item, pa.int64())),
                "start_word": pa.array(start, pa.int64()),
                "end_word": pa.array(ends, pa.int64()),
                "hamming": pa.array(far, pa.int64()),
                "similarity": pa.array(alike, pa.float64()),
            },
        )

    keys = ["n", "shard", "share"]
    # Columns of ``deal`` get new names on one side: a cogroup tells its two sides apart by them.
    met, weighed = met.drop("shards", "shares"), weighed.drop("shards", "shares").select(F.col("n").alias("n"), "item_id", "shingles", "held", "shard", "share")
    return met.groupBy(*keys).cogroup(weighed.groupBy(*keys)).applyInArrow(verify, OUT)
