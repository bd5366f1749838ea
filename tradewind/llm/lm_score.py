"""Language-model scoring by deleted interpolation.

The probability of a token after its predecessor mixes maximum-likelihood estimates of the bigram, the unigram and the
uniform distribution; the mixture weights depend on how often the context was seen (powers of two) and are learned by
expectation-maximisation on counts that a held-out part of the training documents has, while the estimates come from
the other part. The final estimates use all training documents.

Counts are exchanged in blocks of documents: each block sends its distinct words and bigrams (sorted 64-bit hashes) to
parts of the key space, each part adds up what all blocks have of a key and answers every block with the totals of
its keys, in the same order. So a key costs one row of a block, not one row an occurrence, and no key gathers rows.
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

FOLDS, TEST_FOLD, EM_FOLD, BUCKETS, ROUNDS = 7, 2, 5, 24, 30
ROWS_PER_BLOCK, CHARS_PER_PART, STEPS = 1000, 12_000_000, 8
START, END = tv.U(0x5EED0000000000A1), tv.U(0x5EED0000000000E7)


def tokens(run: tv.Run) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, token hash, hash of the token before) of all words and ends; the first follows the start mark."""
    w = tv.words(run, tv.LOWER)
    n = len(w.hash) + run.n
    doc, token = np.empty(n, np.int64), np.empty(n, tv.U)
    at = np.arange(len(w.hash)) + w.doc
    ends = w.firsts(run.n)[1:] + np.arange(run.n)
    doc[at], token[at] = w.doc, w.hash
    doc[ends], token[ends] = np.arange(run.n), END
    before = np.empty(n, tv.U)
    before[1:] = token[:-1]
    before[np.concatenate(([0], ends[:-1] + 1))] = START
    return doc, token, before


def _block(texts: pa.Array, train: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct words (with the start mark as context) and bigrams of a block, with counts in training and EM rows."""
    every: list[list[np.ndarray]] = [[], [], [], [], [], []]
    for run in tv.runs(texts):
        doc, token, before = tokens(run)
        rows = run.first + doc
        t, h = train[rows], held[rows]
        # The start mark counts once per document, as a context only.
        first = run.first + np.arange(run.n)
        for i, x in enumerate(
            (
                np.concatenate((token, np.full(run.n, START))),
                np.concatenate((t, train[first])),
                np.concatenate((h, held[first])),
                tv.pair(before, token),
                t,
                h,
            ),
        ):
            every[i].append(x)
    out = []
    for keys, t, h in (every[:3], every[3:]):
        k, back = np.unique(np.concatenate(keys), return_inverse=True)
        out += [k, *(np.bincount(back, np.concatenate(c), len(k)).astype(np.int64) for c in (t, h))]
    return tuple(out)


def _parts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part's keys begin among sorted keys: parts are equal ranges of the hash space."""
    edges = np.array([(p << 64) // parts for p in range(1, parts)], dtype=object).astype(tv.U) if parts > 1 else np.zeros(0, tv.U)
    return np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))


def _pack(counts: np.ndarray) -> bytes:
    """Counts as one byte each; those of 255 and more follow in full."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<u8").tobytes()


def _unpack(packed: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(packed, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(packed, "<u8", offset=n).astype(np.int64)
    return out


def _requests(docs: DataFrame, parts: int) -> DataFrame:
    """One row per block, kind (0: words, 1: bigrams) and part: its keys and their counts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            edges = np.concatenate((np.flatnonzero(np.diff(blocks, prepend=blocks[0] - 1)), [len(blocks)]))
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                own = batch.slice(lo, hi - lo)
                # A block may come in several batches; ``piece`` tells them apart by their first row.
                piece = int(own.column("row")[0].as_py())
                train, held = (own.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("train", "held"))
                rows: list[tuple] = []
                # All rows with their counts; the EM rows once more, without, so that they can be read on their own.
                for em, some in ((False, own), (True, own.filter(pa.array(held)))):
                    if not some.num_rows:
                        continue
                    none = np.zeros(some.num_rows, bool)
                    found = _block(some.column("text"), none if em else train, none if em else held)
                    first = int(some.column("row")[0].as_py()) if em else piece
                    for kind in (0, 1):
                        keys, t, h = found[3 * kind : 3 * kind + 3]
                        cuts = _parts(keys, parts)
                        for p, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
                            if b > a:
                                rows.append(
                                    (int(blocks[lo]), first, em, kind, p, keys[a:b].astype("<u8").tobytes(), _pack(t[a:b]), _pack(h[a:b])),
                                )
                kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    ["block", "piece", "em", "kind", "part", "keys", "train", "held"],
                )

    return docs.mapInArrow(ask, "block long, piece long, em boolean, kind int, part int, keys binary, train binary, held binary")


def _check(keys: np.ndarray) -> int:
    """A sum over keys: it tells whether an answer is to the keys that a second read of the documents gives."""
    return int(tv.mix(keys.astype(tv.U)).sum(dtype=tv.U).view(np.int64))


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    """Adds up one part of the key space and answers each request in its order; a last row has the part's sums."""
    sizes = [len(k) // 8 for k in group["keys"]]
    keys = np.frombuffer(b"".join(group["keys"]), "<u8")
    _, back = np.unique(keys, return_inverse=True)
    totals = [
        np.bincount(back, np.concatenate([_unpack(x, n) for x, n in zip(group[c], sizes, strict=True)])).astype(np.int64)
        for c in ("train", "held")
    ]
    at = np.concatenate(([0], np.cumsum(sizes)))
    out = group[["block", "piece", "em", "kind", "part"]].copy()
    out["n"] = sizes
    out["check"] = [_check(keys[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    for c, total in zip(("train", "held"), totals, strict=True):
        each = total[back]
        # EM counts go only to those who asked for them.
        out[c] = [_pack(each[a:b]) if c == "train" or em else b"" for a, b, em in zip(at[:-1], at[1:], group["em"], strict=True)]
    out["known"] = out["tokens"] = 0
    row = {
        "block": -1,
        "piece": 0,
        "em": False,
        "kind": group["kind"].iloc[0],
        "part": group["part"].iloc[0],
        "n": 0,
        "check": 0,
        "train": b"",
        "held": b"",
        "known": int((totals[0] > 0).sum()),
        "tokens": int(totals[0].sum()),
    }
    return pd.concat([out, pd.DataFrame([row])], ignore_index=True)


ANSWER = "block long, piece long, em boolean, kind int, part int, n long, check long, train binary, held binary, known long, tokens long"


class _Counts:
    """A piece's keys, recomputed, with the answered totals."""

    def __init__(self, column: pa.Array, answers: pd.DataFrame, only_train_rest: bool):
        n = len(column)
        keys = _block(column, np.zeros(n, bool), np.zeros(n, bool))
        answers = answers.sort_values(["kind", "part"])
        self.keys, self.counts = [], []
        for kind in (0, 1):
            own = answers[answers["kind"] == kind]
            c = np.concatenate([_unpack(x, n) for x, n in zip(own["train"], own["n"], strict=True)])
            if only_train_rest:
                c = c - np.concatenate([_unpack(x, n) for x, n in zip(own["held"], own["n"], strict=True)])
            at = np.concatenate(([0], np.cumsum(own["n"].to_numpy())))
            mine = keys[3 * kind]
            if len(c) != len(mine) or any(_check(mine[a:b]) != x for a, b, x in zip(at[:-1], at[1:], own["check"], strict=True)):
                raise RuntimeError("the documents changed between two reads: score a stored table")
            self.keys.append(keys[3 * kind])
            self.counts.append(c)

    def of(self, kind: int, keys: np.ndarray) -> np.ndarray:
        return self.counts[kind][np.searchsorted(self.keys[kind], keys)]


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(np.log2(context + 1.0)).astype(np.int64), BUCKETS - 1)


def learn(cells: list[tuple[int, int, int, int]], uniform: float, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (bigram, unigram, uniform) by context bucket, by EM over held-out cells (bucket, bigram estimate and
    unigram estimate as steps of 1 / ``STEPS`` of a power of two below 1, or -1 for zero, tokens). A bucket without
    held-out tokens takes the weights of the next lower one; the lowest has no bigram."""
    value = lambda q: np.where(q < 0, 0.0, np.exp2(-np.maximum(q, 0) / STEPS))
    weights = np.tile([0.0, 0.9, 0.1], (BUCKETS, 1))
    every = np.array(cells, np.int64).reshape(-1, 4)
    for b in range(BUCKETS):
        own = every[every[:, 0] == b]
        if not len(own):
            weights[b] = weights[b - 1] if b else weights[b]
            continue
        p = np.stack([value(own[:, 1]), value(own[:, 2]), np.full(len(own), uniform)], axis=1)
        w = np.array([0.6, 0.3, 0.1]) if b else np.array([0.0, 0.9, 0.1])
        for _ in range(rounds):
            share = p * w
            share = share / share.sum(axis=1, keepdims=True) * own[:, 3:]
            w = (share.sum(axis=0) + [0.0, 0.0, 1e-6]) / (share.sum() + 1e-6)
        weights[b] = w
    return weights


def _pieces(group: pd.DataFrame, answers: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, pd.DataFrame]]:
    """The rows of each piece of a block, with its answers: pieces are runs of rows from their first row on."""
    starts = np.sort(answers["piece"].unique())
    group = group.sort_values("row")
    which = np.searchsorted(starts, group["row"].to_numpy(), side="right") - 1
    for i, s in enumerate(starts):
        yield group[which == i], answers[answers["piece"] == s]


def lm_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    test_fold: int = TEST_FOLD,
    em_fold: int = EM_FOLD,
) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens: words between ASCII white space with A-Z lower-cased, then one end. Documents whose crc32 of the id as text
    modulo 7 is ``test_fold`` are held out; all others train (those of ``em_fold`` also give the EM counts).
    base_score: sum of log10((c + 1) / (N + V + 1)) with c the token's training count, N all and V distinct training
    tokens. score: log10 probability of the text under the interpolated bigram model with V + 1 outcomes.
    Null or empty text: the end alone is scored. Null id: its text counts as ''. Repeated rows: each trains and is
    scored. No training rows at all: every probability is uniform. Empty input: empty result.
    The rows are read twice and must come in the same partitions again (any stored table does): each answer carries a
    sum of the keys that were asked for, so a change raises an error.
    A very long text is read whole. Other columns, also those named like results, are not read.
    """
    docs = texts(docs, id_col, text_col).select("doc_id", "text", fold(F.col("doc_id"), FOLDS).alias("fold"))
    docs = (
        docs.withColumn("train", F.col("fold") != test_fold)
        .withColumn("held", F.col("fold") == em_fold)
        .withColumn("row", F.monotonically_increasing_id())
    )
    docs = docs.withColumn("block", F.floor(F.col("row") / ROWS_PER_BLOCK).cast("long"))
    of = lambda c: F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0))
    chars, starts, heard = docs.agg(F.sum(F.length("text")), of("train"), of("held")).first()
    parts = max(1, -(-int(chars or 0) // CHARS_PER_PART))
    answers = save(_requests(docs, parts).groupBy("kind", "part").applyInPandas(_answer, ANSWER), "lm-counts")
    sums = answers.where("block = -1 and kind = 0").agg(F.sum("known"), F.sum("tokens")).first()
    # The start mark is a context, no token: it is known once and occurs once per training document.
    known, total = (sums[0] or 0) - (1 if starts else 0), (sums[1] or 0) - starts
    replies = answers.where("block >= 0").drop("known", "tokens")

    # EM counts: cells of the held-out bigrams, from estimates without their documents.
    rest = max(total, 1)

    def cells(key: tuple, group: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        found = []
        for rows, mine in _pieces(group, own):
            column = pa.array(rows["text"], pa.large_string())
            counts = _Counts(column, mine, True)
            for run in tv.runs(column):
                _, token, before = tokens(run)
                both, one, context = counts.of(1, tv.pair(before, token)), counts.of(0, token), counts.of(0, before)
                step = lambda x, n: np.where(x > 0, np.rint(-STEPS * np.log2(np.maximum(x, 1) / np.maximum(n, 1))), -1).astype(np.int64)
                found.append(np.stack([_bucket(context), step(both, context), step(one, rest)], axis=1))
        if not found:
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("bucket", "two", "one", "n")})
        at, n = np.unique(np.concatenate(found), axis=0, return_counts=True)
        return pd.DataFrame({"bucket": at[:, 0], "two": at[:, 1], "one": at[:, 2], "n": n})

    weights = np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))
    if total:
        weights = np.tile([0.0, 0.9, 0.1], (BUCKETS, 1))
    if heard and total:
        table = (
            docs.where("held")
            .groupBy("block")
            .cogroup(replies.where("em").groupBy("block"))
            .applyInPandas(cells, "bucket long, two long, one long, n long")
        )
        weights = learn([tuple(r) for r in table.groupBy("bucket", "two", "one").agg(F.sum("n")).collect()], 1.0 / (known + 1))

    def score(key: tuple, group: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        out = []
        for rows, mine in _pieces(group, own):
            column = pa.array(rows["text"], pa.large_string())
            counts = _Counts(column, mine, False)
            for run in tv.runs(column):
                doc, token, before = tokens(run)
                both, one, context = counts.of(1, tv.pair(before, token)), counts.of(0, token), counts.of(0, before)
                w = weights[_bucket(context)]
                p = w[:, 0] * both / np.maximum(context, 1) + w[:, 1] * one / max(total, 1) + w[:, 2] / (known + 1)
                base = np.log10((one + 1) / (total + known + 1))
                r = rows.iloc[run.first : run.first + run.n]
                columns = {
                    "doc_id": r["doc_id"],
                    "held_out": ~r["train"].astype(bool),
                    "n_tokens": tv.per_doc(doc, run.n),
                    "n_known": tv.per_doc(doc, run.n, one > 0),
                    "train_tokens": total,
                }
                out.append(
                    pd.DataFrame(columns | {"base_score": np.bincount(doc, base, run.n), "score": np.bincount(doc, np.log10(p), run.n)}),
                )
        return pd.concat(out, ignore_index=True).astype({"doc_id": "Int64"})

    return (
        docs.groupBy("block")
        .cogroup(replies.where("not em").groupBy("block"))
        .applyInPandas(
            score,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )
