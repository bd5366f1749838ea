"""Decontamination does not depend on how the benchmark is cut into blocks, nor on a text being as long as the item."""

import random

import pytest

from tradewind.llm import decontaminate


@pytest.fixture(scope="module")
def near_the_limit():
    rng = random.Random(11)
    shared = [f"s{i}" for i in range(12)]
    items = [(i, " ".join(shared + [f"q{i}x{j}" for j in range(18)])) for i in range(12)]
    rows = []
    for i, t in items:
        for cut in range(1, 8):
            w = t.split()
            rows.append((100 * i + cut, " ".join([*w[:-cut], *(f"z{rng.randint(0, 999)}" for _ in range(cut + 30))]), "s"))
            rows.append((5000 + 100 * i + cut, " ".join(w[:-cut]), "s"))
    return items, rows


def test_every_block_size_gives_the_same(spark, frame, near_the_limit):
    items, rows = near_the_limit
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = [sorted((tuple(r) for r in decontaminate.contaminated(frame(rows), bench, block_items=b).collect()), key=repr) for b in (2000, 5, 2)]
    assert found[0] == found[1] == found[2]


def test_an_item_cut_short_is_found(spark, frame, near_the_limit):
    items, rows = near_the_limit
    out = decontaminate.contaminated(frame(rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    got = {(r.doc_id, r.item_id): (r.start_word, r.end_word) for r in out}
    assert all(got[5000 + 100 * i + 1, i] == (0, 29) for i, _ in items)
    assert (5007, 0) not in got
