"""Token counts by a linear longest-match automaton.

Greedy longest-match pieces of a word are counted without building them: a trie over the vocabulary has, at each node,
a failure link (where matching goes on once no longer piece is possible) and the number of pieces popped on the way.
Every byte of a word is read once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from tradewind.llm import textvec as tv
from tradewind.llm.bpe import byte_letters
from tradewind.llm.shared import texts

MAX_VOCABULARY = 2_000_000


def byte_vocabulary(path: str) -> tuple[list[bytes], list[bytes]]:
    """Pieces of a byte-level vocabulary file: those that start a word (after a space), those that go on in it."""
    letters = byte_letters()
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    pieces = [bytes(letters[c] for c in piece) for piece in vocab if all(c in letters for c in piece)]
    return [p for p in pieces if p[:1] == b" "], [p for p in pieces if p[:1] != b" "]


@dataclass
class Automaton:
    """next: node * 256 + byte to node. fail: node to node (-1: no piece fits). popped: pieces popped by that link."""

    next: dict[int, int]
    fail: list[int]
    popped: list[int]
    inner: int

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest match; 1 (the unknown piece) where some rest has none."""
        step, fail, popped = self.next, self.fail, self.popped
        at = n = 0
        for byte in word:
            while (to := step.get(at << 8 | byte)) is None:
                if fail[at] < 0:
                    return 1
                n += popped[at]
                at = fail[at]
            at = to
        while at not in (0, self.inner):
            if fail[at] < 0:
                return 1
            n += popped[at]
            at = fail[at]
        return n


def compile_automaton(start: list[bytes], inner: list[bytes]) -> Automaton:
    """``start``: pieces at the start of a word; ``inner``: pieces after it. Node 0 is the start, node 1 the rest."""
    step: dict[int, int] = {}
    whole, above = [False, False], [(-1, 0), (-1, 0)]
    for root, pieces in ((0, start), (1, inner)):
        for piece in pieces:
            at = root
            for byte in piece:
                to = step.get(at << 8 | byte)
                if to is None:
                    to = len(whole)
                    step[at << 8 | byte] = to
                    whole.append(False)
                    above.append((at, byte))
                at = to
            if piece:
                whole[at] = True
    fail, popped = [-1] * len(whole), [0] * len(whole)
    depth = [0] * len(whole)
    for node in range(2, len(whole)):
        depth[node] = depth[above[node][0]] + 1
    for node in sorted(range(2, len(whole)), key=depth.__getitem__):
        if whole[node]:
            fail[node], popped[node] = 1, 1
            continue
        parent, byte = above[node]
        at, n = fail[parent], popped[parent]
        while at >= 0 and (at << 8 | byte) not in step:
            n, at = n + popped[at], fail[at]
        if at >= 0:
            fail[node], popped[node] = step[at << 8 | byte], n
    return Automaton(step, fail, popped, 1)


def ship(spark: SparkSession, start: list[bytes], inner: list[bytes]) -> Broadcast:
    """The compiled automaton on all executors; a vocabulary is bounded, and its bound is checked."""
    if len(start) + len(inner) > MAX_VOCABULARY:
        raise ValueError(f"more than {MAX_VOCABULARY} pieces")
    return spark.sparkContext.broadcast(compile_automaton(start, inner))


class _Counts(dict):
    """Counts of words met before; forgets all when full, which bounds memory and changes no result."""

    def __init__(self, automaton: Automaton, most: int = 400_000):
        super().__init__()
        self.automaton, self.most = automaton, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        found = self.automaton.count(b" " + word)
        if len(word) <= 64:
            self[word] = found
        return found


def token_counts(docs: DataFrame, start: list[bytes], inner: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_tokens, max_word_tokens of the whole text.

    Words stand between ASCII white space; each is matched with one space before it. Null or empty text: zeros. Null
    id: kept as null. Repeated rows: one result each. Empty input: empty result. Words of any length are read once.
    A very long text is read whole. Other columns, also those named like results, are not read.
    """
    shipped = ship(docs.sparkSession, start, inner)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Counts(shipped.value)
        for batch in batches:
            for run in tv.runs(batch.column("text")):
                w, raw = tv.words(run, tv.PLAIN), run.data.tobytes()
                keys, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
                spans = zip(w.start[first].tolist(), w.end[first].tolist(), strict=True)
                each = np.fromiter((known[raw[s:e]] for s, e in spans), np.int64, len(keys))[back] if len(keys) else np.zeros(0, np.int64)
                most = np.zeros(run.n, np.int64)
                np.maximum.at(most, w.doc, each)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(run.first, run.n),
                        pa.array(tv.per_doc(w.doc, run.n)),
                        pa.array(tv.per_doc(w.doc, run.n, each)),
                        pa.array(most),
                    ],
                    ["doc_id", "n_words", "n_tokens", "max_word_tokens"],
                )

    return texts(docs, id_col, text_col).mapInArrow(count, "doc_id long, n_words long, n_tokens long, max_word_tokens long")
