"""Words of whole Arrow text batches as numpy arrays.

The tasks of several operators need words, their positions and a 64-bit hash of each word. Here that is array
arithmetic over the UTF-8 bytes of a batch: separators come from a 256-entry table, and a word's hash takes in eight
bytes a step, mixed at each step (so no word is a sum of parts that others share); words of over ``LONG`` bytes are
hashed by BLAKE2b. All separators are ASCII, so words never cut a code point. A batch is handled in runs of documents
of about ``CHUNK`` bytes, which bounds memory; a single longer text makes its own run and is handled whole.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import wraps
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK, LONG = 1 << 20, 512
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """An ordered pair of hashes as one hash."""
    return mix(a * U(0xD6E8FEB86659FD93) + mix(b + U(0x632BE59BD9B4E019)))


@dataclass(frozen=True)
class Alphabet:
    """Which bytes belong to words, and what each byte counts as (None: itself)."""

    inside: np.ndarray
    same: np.ndarray | None

    def folded(self, data: np.ndarray) -> np.ndarray:
        return data if self.same is None else self.same[data]


def alphabet(separators: bytes, lower: bool) -> Alphabet:
    inside = np.ones(256, bool)
    inside[np.frombuffer(separators, np.uint8)] = False
    if not lower:
        return Alphabet(inside, None)
    same = np.arange(256, dtype=np.uint8)
    same[65:91] += 32
    return Alphabet(inside, same)


#: Words between ASCII white space; the same with A-Z lower-cased; letters, digits and non-ASCII lower-cased; lines.
PLAIN = alphabet(SPACES, lower=False)
LOWER = alphabet(SPACES, lower=True)
ALNUM = alphabet(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), lower=True)
LINES = alphabet(b"\n", lower=False)


_TAIL = np.array([(1 << (8 * k)) - 1 for k in range(9)], U)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the bytes in each span; they depend on those bytes and the seed alone."""
    size = end - start
    h = mix(size.astype(U) * U(0x9E3779B97F4A7C15) + U(seed ^ 0x2545F4914F6CDD1D))
    n = len(data)
    # Eight bytes from every position on.
    eight = np.ndarray((n + 1,), "<u8", np.concatenate((data, np.zeros(8, np.uint8))), strides=(1,))
    open_ = np.flatnonzero((size > 0) & (size <= LONG))
    step = 0
    while len(open_):
        part = eight[start[open_] + step] & _TAIL[np.minimum(size[open_] - step, 8)]
        h[open_] = mix(h[open_] ^ part)
        step += 8
        open_ = open_[size[open_] > step]
    salt = (seed % (1 << 64)).to_bytes(8, "little")
    for i in np.flatnonzero(size > LONG).tolist():
        h[i] = int.from_bytes(blake2b(data[start[i] : end[i]].tobytes(), digest_size=8, key=salt).digest(), "little")
    return h


@dataclass
class Run:
    """Some documents of a batch: their rows, bytes, and each one's first byte (and the end)."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def firsts(self, n: int) -> np.ndarray:
        """The index of each document's first word, and the number of words."""
        return np.searchsorted(self.doc, np.arange(n + 1))


def runs(column: pa.Array | pa.ChunkedArray, chunk: int = CHUNK) -> Iterator[Run]:
    """Consecutive documents of the column, about ``chunk`` bytes at a time; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + chunk, side="right")) - 1)
        yield Run(lo, raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
        lo = hi


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def lean(task: Task) -> Task:
    """The task of a ``mapInArrow``, which at its end gives back what its arrays took.

    Workers stay for later tasks, and allocators keep what was freed: it would count as the executor's memory, beside
    what the JVM then needs for its own sorts.
    """

    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)

    return run


def words(run: Run, abc: Alphabet) -> Words:
    """All words of a run, in order."""
    n = len(run.data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(0, U))
    inside = abc.inside[run.data]
    border = np.zeros(n + 1, bool)
    border[run.offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = True, ~inside[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, ~inside[1:]
    start = np.flatnonzero(inside & (before | border[:-1]))
    end = np.flatnonzero(inside & (after | border[1:])) + 1
    found = span_hashes(abc.folded(run.data), start, end)
    return Words(np.searchsorted(run.offsets[1:], start, side="right"), start, end, found)


def hash_of(word: bytes, abc: Alphabet) -> int:
    """The hash that ``words`` gives to this single word."""
    return int(words(Run(0, np.frombuffer(word, np.uint8), np.array([0, len(word)])), abc).hash[0])


def shingles(w: Words, size: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every ``size``-word shingle; a document with fewer words has its whole sequence as one."""
    total = len(w.doc)
    if not total:
        return w.doc, w.hash
    firsts = w.firsts(n)
    count = np.diff(firsts)
    rolled = w.hash.copy()
    for k in range(1, size):
        rolled[: total - k] = pair(rolled[: total - k], w.hash[k:])
    whole = np.flatnonzero(np.arange(total) + size <= firsts[w.doc + 1])
    docs, hashes = [w.doc[whole]], [rolled[whole]]
    for length in range(1, size):
        few = np.flatnonzero(count == length)
        if len(few):
            h = w.hash[firsts[few]]
            for k in range(1, length):
                h = pair(h, w.hash[firsts[few] + k])
            docs.append(few)
            hashes.append(mix(h + U(length)))
    doc, found = np.concatenate(docs), np.concatenate(hashes)
    order = np.argsort(doc, kind="stable")
    return doc[order], found[order]


def per_doc(doc: np.ndarray, n: int, weight: np.ndarray | None = None) -> np.ndarray:
    """Counts, or sums of whole numbers, by document."""
    return np.bincount(doc, weights=weight, minlength=n)[:n].astype(np.int64)
