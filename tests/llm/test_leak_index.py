"""Decontamination through its index: sums that count repeats once, a large benchmark, null and clashing columns."""

import random

import numpy as np
import pytest

from tradewind.llm import decontaminate


@pytest.mark.parametrize("span", [1, 2, 5, 30])
@pytest.mark.parametrize("kinds", [1, 3, 40])
def test_sums_count_equal_places_once(span, kinds):
    rng = np.random.default_rng(span * 100 + kinds)
    x, worth = rng.integers(0, kinds, 60), rng.integers(1, 1 << 40, kinds)
    got = decontaminate.sums(worth[x], decontaminate.before(x), span)
    assert got.tolist() == [int(worth[np.unique(x[a : a + span])].sum()) for a in range(60 - span + 1)]


def test_fingerprints_are_those_of_the_sets():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 30, 400).astype(np.uint64)
    worth = rng.integers(1, 1 << 24, 30)
    starts = np.array([0, 1, 2, 7, 200, 201, 380])
    got = decontaminate.fingerprints(x, worth[x.astype(int)], 20, starts)
    for a, p in zip(starts.tolist(), got, strict=True):
        own = np.unique(x[a : a + 20])
        assert (p == decontaminate._print(own, worth[own.astype(int)])).all()


def test_a_large_benchmark(spark, frame, monkeypatch):
    """30,000 items, of which many share their first words; every 100th stands in a text, one of them in many."""
    # A bit table that is too small only lets more through.
    monkeypatch.setattr(decontaminate, "MOST", 19)
    rng = random.Random(4)
    items = [(i, " ".join([*("please answer the question below in one word".split() if i % 3 == 0 else ()), *(f"t{rng.randint(0, 10**7)}" for _ in range(16))])) for i in range(30_000)]
    pad = lambda: " ".join(f"p{rng.randint(0, 900)}" for _ in range(25))
    rows = [(i, f"{pad()} {items[i][1]} {pad()}", "s") for i in range(0, 30_000, 100)]
    rows += [(50_000 + i, f"{pad()} {items[7][1]} {pad()}", "s") for i in range(1500)]
    rows += [(90_000 + i, f"{pad()} please answer the question below in one word {pad()}", "s") for i in range(300)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    out = decontaminate.contaminated(frame(rows), bench).collect()
    want = {(i, i) for i in range(0, 30_000, 100)} | {(50_000 + i, 7) for i in range(1500)}
    assert {(r.doc_id, r.item_id) for r in out} == want and len(out) == len(want)
    assert {(r.start_word, r.hamming, r.similarity) for r in out} == {(25, 0, 1.0)}


def test_null_ids_and_repeated_rows(spark, frame):
    passage = " ".join(f"q{i}" for i in range(20))
    rows = [(None, f"a {passage} b", "s"), (1 << 60, passage, "s"), (1 << 60, passage, "s"), (3, None, "s"), (4, "", "s")]
    bench = spark.createDataFrame([(None, passage), (5, None), (6, "")], "item_id bigint, text string")
    out = decontaminate.contaminated(frame(rows), bench).collect()
    assert sorted((tuple(r)[0], r.item_id, r.start_word, r.end_word) for r in out if r.doc_id is not None) == [(1 << 60, None, 0, 20)] * 2
    assert [(r.start_word, r.end_word) for r in out if r.doc_id is None] == [(1, 21)]
