"""Substring deduplication has no floor of words for a unit: short lines that repeat in a long enough run go too."""

import random

from tradewind.llm import queries, substring_dedup


def test_short_lines_are_compared(spark, frame, tmp_path):
    menu = [f"{w} {i}" for i, w in enumerate("home page shop cart login help search news about jobs press contact legal terms privacy".split())]
    rows = [(300, "\n".join(["own words of the first one", *menu]), "a"), (301, "\n".join([*(f" {x.upper()} " for x in menu), "own words of the second"]), "b"), (302, "home 0\npage 1\n" * 2, "b")]
    frame(rows).write.parquet(f"file://{tmp_path}/documents.parquet")
    by = {r.doc_id: r for r in queries.op6_substring_dedup(spark, f"file://{tmp_path}").collect()}
    assert by[300].n_removed == 0
    assert (by[301].n_removed, by[301].clean_text) == (15, "own words of the second")
    # Four words that come back are no passage.
    assert (by[302].n_units, by[302].n_removed, by[302].clean_text) == (4, 0, rows[2][1])


def test_passages_inside_lines_are_caught_and_others_left(frame):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9)))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(4, 12))).capitalize() + "."
    passages = [" ".join(sentence() for _ in range(10)) for _ in range(4)]
    rows, planted = [], set()
    for i in range(200):
        t = [*sentence().split(), *" ".join(sentence() for _ in range(20)).split()]
        if i % 5 == 0:
            # In the middle of a sentence.
            at = rng.randrange(len(t))
            t[at:at] = passages[i // 5 % 4].split()
            planted.add(i)
        rows.append((i, " ".join(t), "s"))
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(frame(rows)).collect()}
    assert {i for i, r in got.items() if r.n_removed} == planted - {0, 5, 10, 15}
    text = dict((i, t) for i, t, _ in rows)
    for i in planted - {0, 5, 10, 15}:
        out, at = [], 0
        for x in got[i].removed:
            out.append(text[i][at : x.start])
            at = x.end
        assert "".join([*out, text[i][at:]]) == got[i].clean_text
        cut = " ".join(text[i][x.start : x.end] for x in got[i].removed)
        assert len(cut.split()) >= 30 and " ".join(cut.split()) in " ".join(passages[i // 5 % 4].split())


def test_lines_whose_words_differ_in_order_of_letters_only_differ(frame):
    # Words and lines in Thue-Morse order: equal under sums of powers modulo 2 ** 64.
    a = "a"
    flip = str.maketrans("ab", "ba")
    while len(a) < 2048:
        a += a.translate(flip)
    b = a.translate(flip)
    got = substring_dedup.substring_dedup(frame([(1, a, "s"), (2, b, "s"), (3, " ".join(a), "s"), (4, " ".join(b), "s")])).collect()
    assert [r.n_removed for r in got] == [0, 0, 0, 0]
