"""Byte-pair encoding and decoding by a tokenization automaton.

The automaton's states are the last token read; an arc is labelled by the token it reads and leads to that token's
state, so (state, label) has one target or none. It starts with an arc for every byte from every state and grows by one
merge gadget per merge (u, v) -> w, in order of rank: every path u, v gives way to an arc w - in from wherever u could
be read, on to wherever v could go - and the arc v from state u is cut. A table of all states and labels would have
billions of entries; a gadget changes one of them, the rest of its row and column are those it inherits. So the table
has the cut entries, and an entry that is not there is the one it inherits from, down to bytes.

Words are read byte by byte. Which tokens end at a byte comes from a second table, a trie of all labels with links to
the longest shorter one; of these tokens exactly one continues the path of the text before it, as every text has one
encoding, so that each byte moves on to one state and nothing is ever taken back. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tradewind.llm import textvec as tv
from tradewind.llm.shared import texts

#: Fixed value: how byte-level vocabularies split texts into words before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_MERGES = 1_000_000


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 as itself, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Automaton:
    """Tokens by id, built from single bytes by successive merge gadgets."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]], most_arcs: int = 300_000):
        most = max(labels, default=0) + 1
        self.labels = labels
        #: Rank of the merge that made a token; -1: a byte, -2: none has yet.
        self.born, self.left, self.right = [-2] * most, [-1] * most, [-1] * most
        self.size = [len(labels.get(t, b"")) for t in range(most)]
        #: Table of arcs: (state, label) cut by the gadget of this rank.
        self.cut: dict[int, int] = {}
        self.arcs: dict[int, bool] = {}
        self.older_arcs: dict[int, bool] = {}
        self.most_arcs = most_arcs
        #: Table of labels: (node, byte) to node; the token of a node, or -1.
        self.step: dict[int, int] = {}
        self.token: list[int] = [-1]
        for t, label in labels.items():
            if len(label) == 1:
                self.born[t] = -1
                self._spell(t)
        for rank, (u, v, w) in enumerate(merges):
            self._gadget(rank, u, v, w)
        self._link()

    def _spell(self, t: int) -> None:
        at = 0
        for byte in self.labels[t]:
            to = self.step.get(at << 8 | byte)
            if to is None:
                to = self.step[at << 8 | byte] = len(self.token)
                self.token.append(-1)
            at = to
        self.token[at] = t

    def _gadget(self, rank: int, u: int, v: int, w: int) -> None:
        if self.born[u] < -1 or self.born[v] < -1 or self.born[w] > -2:
            raise ValueError(f"merge {rank} does not make a new token of two known ones")
        # The path u, v exists unless an earlier merge cut it; then no text ever reads w.
        reached = self._inherited(u, v, rank - 1)
        self.cut[u << 32 | v] = rank
        self.born[w], self.left[w], self.right[w] = rank, u, v
        if reached:
            self._spell(w)

    def _link(self) -> None:
        """For each node the node of its longest proper end that is in the trie, and of its longest end that is a token."""
        below: dict[int, list[tuple[int, int]]] = {}
        for key, to in self.step.items():
            below.setdefault(key >> 8, []).append((key & 255, to))
        self.fail, self.ends = [0] * len(self.token), [0] * len(self.token)
        level = [0]
        while level:
            after = []
            for node in level:
                for byte, to in below.get(node, ()):
                    at = self.fail[node]
                    while node and at and at << 8 | byte not in self.step:
                        at = self.fail[at]
                    self.fail[to] = self.step.get(at << 8 | byte, 0) if node else 0
                    self.ends[to] = to if self.token[to] >= 0 else self.ends[self.fail[to]]
                    after.append(to)
            level = after

    def _inherited(self, a: int, b: int, at: int) -> bool:
        """The table's entry for state a and label b after the gadgets up to rank ``at``."""
        cut, born = self.cut, self.born
        while True:
            if cut.get(a << 32 | b, at + 1) <= at:
                return False
            if born[a] < 0 and born[b] < 0:
                return True
            if born[b] >= born[a]:
                # b came last: it is read from wherever its first part could be read, its own cut made.
                at, b = born[b], self.left[b]
            else:
                # a came last: it goes on wherever its second part went just before the cut.
                at, a = born[a] - 1, self.right[a]

    def arc(self, state: int, label: int) -> bool:
        """The table's entry; of those met before, the last ``most_arcs`` to twice as many are kept."""
        if len(self.arcs) >= self.most_arcs:
            self.older_arcs = dict(self.arcs)
            self.arcs.clear()
        found = self.older_arcs.get(state << 32 | label)
        if found is None:
            found = self._inherited(state, label, len(self.cut))
        self.arcs[state << 32 | label] = found
        return found

    def encode(self, word: bytes) -> list[int]:
        """The labels of the path that spells the word, in time proportional to its length."""
        step, token, fail, ends, size, arcs = self.step, self.token, self.fail, self.ends, self.size, self.arcs
        states = [-1]
        node = 0
        for i, byte in enumerate(word, 1):
            while (to := step.get(node << 8 | byte)) is None:
                node = fail[node]
            node = to
            at = ends[node]
            while True:
                t = token[at]
                before = states[i - size[t]]
                if before < 0:
                    break
                ok = arcs.get(before << 32 | t)
                if ok or (ok is None and self.arc(before, t)):
                    break
                at = ends[fail[at]]
            states.append(t)
        path, i = [], len(word)
        while i:
            path.append(states[i])
            i -= size[states[i]]
        return path[::-1]


class Vocabulary:
    """A byte-level vocabulary: the automaton, the tokens that stand for whole strings, and decoding labels."""

    def __init__(self, model: dict):
        letters = byte_letters()
        ids = model["model"]["vocab"]
        labels = {i: bytes(letters[c] for c in piece) for piece, i in ids.items() if all(c in letters for c in piece)}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["model"]["merges"]]
        if len(pairs) > MAX_MERGES:
            raise ValueError(f"more than {MAX_MERGES} merges")
        self.automaton = Automaton(labels, [(ids[u], ids[v], ids[u + v]) for u, v in pairs])
        self.special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        self.labels = labels | {i: s.encode() for s, i in self.special.items()}
        self.words = regex.compile(SPLIT)
        self.known = _Known(self.automaton)
        self.at_special = regex.compile(
            "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)),
        ) if self.special else None

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; the strings of special tokens become those tokens."""
        if self.at_special is None or not self.at_special.search(text):
            return b"".join(map(self.known.__getitem__, self.words.findall(text)))
        out, at = [], 0
        for m in self.at_special.finditer(text):
            out += map(self.known.__getitem__, self.words.findall(text[at : m.start()]))
            out.append(self.special[m[0]].to_bytes(4, "little"))
            at = m.end()
        out += map(self.known.__getitem__, self.words.findall(text[at:]))
        return b"".join(out)

    def forget(self) -> None:
        """Keep the vocabulary alone, nothing of the texts that were read."""
        for kept in (self.known, self.known.older, self.automaton.arcs, self.automaton.older_arcs):
            kept.clear()

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs, one after the other; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


class _Known(dict):
    """Encodings of the last ``most`` to twice as many distinct words; which they are changes no result.

    When full, all become older ones, and what were older ones go: a word that is used now and then stays, and the many
    that come once take little memory.
    """

    def __init__(self, automaton: Automaton, most: int = 200_000):
        super().__init__()
        self.automaton, self.most = automaton, most
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        out = self.older.get(word)
        if out is None:
            out = np.array(self.automaton.encode(word.encode()), "<u4").tobytes()
        if len(word) <= 64:
            self[word] = out
        return out


@lru_cache(maxsize=1)
def compiled(model: str) -> Vocabulary:
    """Once per Python worker; the vocabulary file's text is bounded by ``MAX_MERGES``."""
    return Vocabulary(json.loads(model))


def bpe(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids (little-endian unsigned 32-bit), decoded (the text again).

    ``model_path``: a byte-level vocabulary file with merges, read by the driver and sent to the executors. Whole texts
    are encoded. Null or empty text: no ids, decoded ''. Null id: kept as null. Repeated rows: one result each. Empty
    input: empty result.
    A very long text is read whole. Other columns, also those named like results, are not read.
    """
    with open(model_path, encoding="utf-8") as f:
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())

    @tv.lean
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = compiled(shipped.value)
        for batch in batches:
            column = batch.column("text")
            for run in tv.runs(column):
                ids = [vocabulary.encode(t) for t in column.slice(run.first, run.n).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(run.first, run.n),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array([vocabulary.decode(x) for x in ids], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )
        vocabulary.forget()

    return (
        texts(docs, id_col, text_col)
        .select("doc_id", "text")
        .mapInArrow(encode, "doc_id long, n_tokens long, ids binary, decoded string")
    )
