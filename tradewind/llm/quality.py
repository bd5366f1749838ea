"""Quality rules: an isolation forest over rule statistics.

Every text is read once for its rule statistics. Isolation trees split random features at random values; a document
that few splits set apart (a short mean path) is anomalous. The cut-off comes from all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import textvec as tv
from tradewind.llm.shared import fold, save, texts

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_punct", "n_digits", "n_lone"]
TREES, ROWS_PER_TREE, SEED, MAX_FALSE = 100, 256, 7, 0.005

_SYMBOL, _UPPER, _PUNCT, _DIGIT, _LEAD, _LETTER = (np.zeros(256, bool) for _ in range(6))
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_UPPER[65:91] = True
_DIGIT[48:58] = True
_PUNCT[np.frombuffer(b"!?.,;:\"'()[]{}-_/\\", np.uint8)] = True
_LEAD[:128] = _LEAD[192:] = True
_LETTER[48:58] = _LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def _span_sums(mask: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(mask)))
    return sums[end] - sums[start]


def _counts(run: tv.Run) -> list[np.ndarray]:
    n, w, lines = run.n, tv.words(run, tv.PLAIN), tv.words(run, tv.LINES)
    lo, hi = run.offsets[:-1], run.offsets[1:]
    filled = np.searchsorted(w.start, lines.end) > np.searchsorted(w.start, lines.start)
    doc, key = lines.doc[filled], lines.hash[filled]
    _, first, seen = np.unique(tv.pair(key, doc.astype(tv.U)), return_index=True, return_counts=True)
    dup = tv.per_doc(doc[first], n, seen - 1)
    covered = np.zeros(len(w.doc), bool)
    if len(w.doc) > 2:
        three = tv.pair(tv.pair(tv.pair(w.hash[:-2], w.hash[1:-1]), w.hash[2:]), w.doc[:-2].astype(tv.U))
        at = np.flatnonzero(w.doc[:-2] == w.doc[2:])
        _, back, seen = np.unique(three[at], return_inverse=True, return_counts=True)
        often = at[seen[back] > 1]
        for k in range(3):
            covered[often + k] = True
    return [
        tv.per_doc(w.doc, n),
        tv.per_doc(w.doc, n, _span_sums(_LEAD[run.data], w.start, w.end)),
        _span_sums(_SYMBOL[run.data], lo, hi),
        dup,
        tv.per_doc(w.doc[covered], n),
        tv.per_doc(doc, n),
        *(_span_sums(mask[run.data], lo, hi) for mask in (_UPPER, _PUNCT, _DIGIT)),
        tv.per_doc(w.doc[_span_sums(_LETTER[run.data], w.start, w.end) == 0], n),
    ]


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key and the counts in ``COUNTS`` of each row's whole text (null text: all counts 0)."""

    @tv.lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in tv.runs(batch.column("text")):
                own = [batch.column(c).slice(run.first, run.n) for c in ("doc_id", "text_key")]
                yield pa.RecordBatch.from_arrays([*own, *map(pa.array, _counts(run))], ["doc_id", "text_key", *COUNTS])

    return texts(docs, id_col, text_col).mapInArrow(count, "doc_id long, text_key long, " + ", ".join(f"{c} long" for c in COUNTS))


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    """Scale-free features, so that length and language alone make nothing anomalous."""
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    lines = np.maximum(c["n_lines"], 1)
    return np.stack(
        [
            np.sqrt(c["n_symbols"] / chars),
            c["n_repeat_words"] / words,
            c["n_dup_lines"] / lines,
            np.minimum(c["word_chars"] / words, 20.0),
            np.sqrt(c["n_upper"] / chars),
            np.sqrt(c["n_punct"] / chars),
            np.sqrt(c["n_digits"] / chars),
            c["n_lone"] / words,
        ],
        axis=1,
    )


def _c(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    m = np.maximum(n - 1, 1)
    return np.where(n > 2, 2 * (np.log(m) + 0.5772156649015329) - 2 * m / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def grow(good: np.ndarray, box: np.ndarray, trees: int = TREES, per_tree: int = ROWS_PER_TREE, seed: int = SEED) -> dict[str, np.ndarray]:
    """Isolation trees as arrays: feature (-1: leaf), cut, left child, path length at the leaf.

    Trees hold rows of ``good``; a node cuts its part of ``box`` (the smallest and largest value of each feature in the
    whole sample), so that space which only bad rows fill is set apart after few splits even where good rows never vary.
    """
    rng, depth = np.random.default_rng(seed), int(np.ceil(np.log2(max(per_tree, 2))))
    feature, cut, left, path, roots = [], [], [], [], []

    def node() -> int:
        feature.append(-1), cut.append(0.0), left.append(0), path.append(0.0)
        return len(feature) - 1

    for _ in range(trees):
        own = good[rng.permutation(len(good))[:per_tree]]
        roots.append(node())
        open_nodes = [(roots[-1], own, box[0].copy(), box[1].copy(), 0)]
        while open_nodes:
            at, x, lo, hi, d = open_nodes.pop()
            wide = np.flatnonzero(hi > lo)
            if d >= depth or len(x) < 2 or not len(wide):
                path[at] = d + float(_c(len(x)))
                continue
            f = int(rng.choice(wide))
            feature[at], cut[at] = f, float(rng.uniform(lo[f], hi[f]))
            under, low_hi, high_lo = x[:, f] < cut[at], hi.copy(), lo.copy()
            low_hi[f] = high_lo[f] = cut[at]
            left[at] = node()
            node()
            open_nodes += [(left[at], x[under], lo, low_hi, d + 1), (left[at] + 1, x[~under], high_lo, hi, d + 1)]
    return {
        "feature": np.array(feature),
        "cut": np.array(cut),
        "left": np.array(left),
        "path": np.array(path),
        "roots": np.array(roots),
        "norm": np.array(float(_c(np.array(min(per_tree, max(len(good), 2))))) or 1.0),
    }


def anomaly(forest: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """2 ** -(mean path / expected path): near 1 for what is set apart early."""
    total, every = np.zeros(len(x)), np.arange(len(x))
    for root in forest["roots"]:
        at = np.full(len(x), root)
        while (inner := forest["feature"][at] >= 0).any():
            i, here = every[inner], at[inner]
            at[i] = forest["left"][here] + (x[i, forest["feature"][here]] >= forest["cut"][here])
        total += forest["path"][at]
    return np.exp2(-total / len(forest["roots"]) / forest["norm"])


def threshold(seen: list[tuple[int, int, int]], max_false: float = MAX_FALSE) -> float:
    """From (score in ten-thousandths, quality, rows): the cut-off with the most low-quality rows at or above it while
    at most ``max_false`` of the good rows are, in the middle of the gap to the next lower score; 2.0 (nothing is
    rejected) without rows of both kinds."""
    good, bad = (sum(n for _, q, n in seen if q == k) for k in (1, 0))
    best, cut, g, b = 0.0, 2.0, 0, 0
    rows: dict[int, list[int]] = {}
    for score, q, n in seen:
        rows.setdefault(score, [0, 0])[q == 1] += n
    scores = sorted(rows, reverse=True) if good and bad else []
    for score, below in zip(scores, [*scores[1:], 0], strict=False):
        b, g = b + rows[score][0], g + rows[score][1]
        if g <= max_false * good and b / bad - g / good > best:
            best, cut = b / bad - g / good, (score + below) / 2e4
    return cut


def _sample(rows: DataFrame, limit: int) -> pd.DataFrame:
    """The ``limit`` rows with the smallest hash of their id. A bound on the hash, from the number of rows, keeps all but
    about a tenth more from being sorted and sent to the driver."""
    share = min(1.0, 1.1 * limit / max(rows.count(), 1))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32))
    return rows.where(place < F.lit(int(share * (1 << 32)))).orderBy(place, *rows.columns).limit(limit).toPandas()


def held_out(docs: DataFrame, labels: DataFrame, folds: int = 5, **options) -> DataFrame:
    """(quality, rows, kept): what is kept of the labelled rows of one fold (by crc32 of the id) when trees and cut-off
    come from the labels of all others."""
    own = fold(F.col("doc_id"), folds) == 0
    judged = quality(docs, labels.where(~own), **options).select("doc_id", "kept")
    marks = labels.where(own & F.col("quality").isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    return (
        judged.join(marks, "doc_id")
        .groupBy("quality")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("kept").cast("long")).alias("kept"))
    )


def quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    trees: int = TREES,
    per_tree: int = ROWS_PER_TREE,
    max_false: float = MAX_FALSE,
) -> DataFrame:
    """One row per input row: doc_id, text_key (xxhash64 of the text), ``COUNTS``, base_failed, score (anomaly, 0 to 1), cut_off, kept.

    ``base_failed``: under 50 words, or over half of the words in repeated three-word windows. ``kept``: not base_failed
    and score under the cut-off. The forest grows from a bounded sample, ``trees * per_tree`` labelled rows (those with
    the smallest hash of their id; of all rows when none of the sample is labelled good); statistics and scores cover every row, and the
    cut-off comes from every labelled row (a histogram of scores in ten-thousandths, so at most 20,002 rows).
    Null or empty text: all counts 0, base_failed. Null id: scored like any row, never labelled. Repeated rows: one
    result each. A label that is null or repeated with another value counts once per row. Empty input: empty result.
    A very long text is read whole. Other columns, also those named like results, are not read.
    Rows of equal hash are taken into the sample by their other columns.
    """
    stats = save(rule_statistics(docs, id_col, text_col), "quality")
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(
        "quality in (0, 1)",
    )
    labelled = save(stats.join(marks, "doc_id"), "labelled")
    limit = trees * per_tree
    rows = _sample(labelled.select("doc_id", *COUNTS, "quality"), limit)
    if not (rows["quality"] == 1).any():
        rows = _sample(stats.select("doc_id", *COUNTS, F.lit(1).alias("quality")), limit)
    forest = None
    if len(rows):
        x = features({c: rows[c].to_numpy() for c in COUNTS})
        forest = grow(x[(rows["quality"] == 1).to_numpy()], np.stack([x.min(axis=0), x.max(axis=0)]), trees, per_tree)

    @tv.lean
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features({c: batch.column(c).to_numpy(zero_copy_only=False) for c in COUNTS})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(anomaly(forest, x))], [*batch.schema.names, "score"])

    schema = ", ".join(f"{c} long" for c in ["doc_id", "text_key", *COUNTS])
    scored = stats.mapInArrow(score, f"{schema}, score double") if forest else stats.withColumn("score", F.lit(0.0))
    seen = labelled.select("doc_id", "text_key", *COUNTS, F.col("quality").cast("long"))
    if forest:
        seen = seen.mapInArrow(score, f"{schema}, quality long, score double")
        cut = threshold(
            [tuple(r) for r in seen.groupBy(F.floor(F.col("score") * 10000).cast("int").alias("s"), "quality").count().collect()],
            max_false,
        )
    else:
        cut = 2.0
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        scored.withColumn("base_failed", failed)
        .withColumn("cut_off", F.lit(cut))
        .withColumn("kept", ~failed & (F.floor(F.col("score") * 10000) < F.lit(cut * 10000)))
    )
