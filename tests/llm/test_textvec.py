import random
import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tradewind.llm import textvec as tv

ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SPACE = re.compile("[^\x20\x09-\x0d]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def found(texts, abc, chunk):
    out = [[] for _ in texts]
    for run in tv.runs(pa.array(texts, pa.string()), chunk):
        raw = run.data.tobytes()
        w = tv.words(run, abc)
        for d, s, e, h in zip(w.doc.tolist(), w.start.tolist(), w.end.tolist(), w.hash.tolist(), strict=True):
            out[run.first + d].append((raw[s:e].decode(), h))
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), max_size=8))
def test_words_are_those_of_the_pattern(texts):
    texts = [t if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    for abc, pattern, fold in ((tv.PLAIN, SPACE, False), (tv.LOWER, SPACE, True), (tv.ALNUM, ALNUM, True)):
        got = found(texts, abc, 16)
        hashes = {}
        for t, ws in zip(texts, got, strict=True):
            want = pattern.findall(lower(t or "") if fold else (t or ""))
            assert [lower(w) if fold else w for w, _ in ws] == want
            for w, h in ws:
                assert hashes.setdefault(lower(w) if fold else w, h) == h
        assert len(set(hashes.values())) == len(hashes)


def test_hash_does_not_depend_on_place():
    rng = random.Random(1)
    ws = ["".join(rng.choice("abcXYZé9") for _ in range(rng.randint(1, 12))) for _ in range(300)]
    a = found([" ".join(ws)], tv.LOWER, 1 << 20)[0]
    b = found(ws, tv.LOWER, 64)
    assert [h for _, h in a] == [x[0][1] for x in b]


def test_shingles_of_short_and_long_texts():
    texts = ["a b c d e f", "a b", "b a", "", None, "a b c d e"]
    sets = {}
    for run in tv.runs(pa.array(texts, pa.string())):
        doc, h = tv.shingles(tv.words(run, tv.LOWER), 5, run.n)
        for d, x in zip(doc.tolist(), h.tolist(), strict=True):
            sets.setdefault(d, set()).add(x)
    assert {k: len(v) for k, v in sets.items()} == {0: 2, 1: 1, 2: 1, 5: 1}
    assert sets[5] < sets[0] and sets[1] != sets[2]


def test_words_that_a_polynomial_cannot_tell_apart_differ():
    flip = str.maketrans("ab", "ba")
    a = "a"
    while len(a) < 4096:
        a += a.translate(flip)
    texts = [x for n in (8, 64, 256, 512, 1024, 4096) for x in (a[:n], a[:n].translate(flip))]
    for abc in (tv.PLAIN, tv.LOWER, tv.ALNUM, tv.LINES):
        got = found(texts, abc, 1 << 20)
        assert [x[0][0] for x in got] == texts and len({x[0][1] for x in got}) == len(texts)


def test_long_and_short_words_hash_by_their_bytes_alone():
    for n in (1, 7, 8, 9, 16, 511, 512, 513, 5000):
        w = "é" * (n // 2) + "x" * (n % 2)
        hs = {h for text in (w, f"{w} y", f"zzz {w}", f"é\t{w}\n") for x, h in found([text], tv.LOWER, 1 << 20)[0] if x == w}
        assert len(hs) == 1
    a, b = found(["x" * 600, "x" * 601], tv.LOWER, 1 << 20)
    assert a[0][1] != b[0][1]
