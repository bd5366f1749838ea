import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, n_words string, component_id int"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text, source), with extra columns whose names clash with results."""

    def make(rows):
        return spark.createDataFrame([(i, t, "xx", s, len(t) if t is not None else None, None, "clash", 7) for i, t, s in rows], SCHEMA).repartition(3)

    return make


WORDS = [f"w{i}" for i in range(60)] + ["Été", "naïve", "The", "the,", "日本語", "x" * 300]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """A small corpus with nulls, empties, copies, near copies, shared lines, ties, and one very long text."""
    rng = random.Random(5)
    rows, base = [], prose(rng, 120)
    shared = ["All rights reserved here today folks.", "  Cookie notice: accept all of them now ", "Follow us"]
    for i in range(60):
        lines = [prose(rng, rng.randint(3, 40)) for _ in range(rng.randint(1, 6))]
        if i % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), shared[i % 2])
        if i % 4 == 0:
            lines.append(shared[2])
        rows.append((i, "\n".join(lines), f"s{i % 13}"))
    for i in range(60, 80):
        w = base.split()
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = "edit" + str(rng.randint(0, 9))
        rows.append((i, " ".join(w), f"s{i % 7}"))
    rows += [(i, base, f"s{i % 5}") for i in range(80, 90)]
    rows += [(90, None, "s1"), (91, "", None), (92, " \n\t ", "s2"), (93, "one two", "s3"), (94, "One TWO", "s3"), (95, "\n\nx\n\n", None)]
    rows += [(96, prose(rng, 30_000).replace(" w7 ", "\n"), "s9"), (97, "z" * 50_000, "s9")]
    rows += [(98, "repeated row of some words here now", "s1")] * 2 + [(None, "no id but words in here as well", "s2")]
    return rows
