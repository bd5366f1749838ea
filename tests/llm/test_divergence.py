"""Source divergence against counts in memory and against SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from tradewind.llm import divergence

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, term string, value int, chunk string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    words = ["Hello", "hello,", "(hello)", "naïve-Bayes", "É", "é", "a1b", "x_y", "日本語", "THE", "the", "the.", "http://a.b/c?d=e", "ſ", "K"]
    words += [f"rare{i}" for i in "abcdefghijklmnop"]
    out = []
    for i in range(120):
        text = " ".join(rng.choice(words) + rng.choice(["", "", ",", "!", "'s"]) for _ in range(rng.randint(0, 25)))
        out.append((i, text.replace(" ", rng.choice([" ", "\n", "\t", "\x0b"])), rng.choice(["en", "en", "de"]), f"s{min(rng.randint(0, 9), 5)}"))
    out += [(200, None, "en", "nothing"), (201, "", None, None), (202, "123 456", "xx", "a"), (203, "one two", "xx", "b"), (None, "hello", "en", None)]
    out += [(204, "thrice! thrice? thrice", "fr", "a"), (205, "thrice", "fr", "a"), (206, "only, in-two", "fr", "a"), (207, "in two (only)", "fr", "a")]
    # Three documents of one source, each with another form of the word; two documents with three forms.
    out += [(210 + i, w, "it", "a") for i, w in enumerate(["uno", "uno,", "Uno."])] + [(213, "due due,", "it", "a"), (214, "due. due", "it", "a")]
    out += [(220, "again it", "it", "b")] * 2 + [(221, "again " * 4000 + "z" * 5000, "it", "c")]
    return out


def expected(rows, ranks):
    found = [(lang or "", source or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(divergence.LOWER)))) for _, text, lang, source in rows]
    df = Counter((lang, t) for lang, _, c in found for t in c)
    count = defaultdict(Counter)
    for lang, source, c in found:
        count[lang, source] += Counter({t: n for t, n in c.items() if df[lang, t] >= 3})
    for lang in {k[0] for k in count}:
        kept = [t for (x, t), n in df.items() if x == lang and n >= 3]
        whole = sum((count[k] for k in count if k[0] == lang), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (c.total() + len(kept)) for t in kept}  # noqa: B023, E731
        q = share(whole)
        mine = {s: share(count[x, s]) for x, s in list(count) if x == lang}
        for s, p in mine.items():
            pairs = [(sum((p[t] - o[t]) ** 2 // o[t] for t in kept), other) for other, o in mine.items() if other != s]
            terms = [((p[t] - q[t]) ** 2 // q[t], t) for t in kept if count[lang, s][t] and p[t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, ranks)):
                for rank, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    yield (lang, s, part, item, value, rank)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 1, "clash", 7, "c") for i, t, lang, s in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize(("tile", "block", "held"), [(64, 8192, 400_000), (2, 4, 30), (1, 1, 1)])
def test_divergence_equals_counts(spark, rows, tile, block, held):
    got = [tuple(r) for r in divergence.divergence(frame(spark, rows), ranks=5, tile=tile, block=block, held=held).collect()]
    assert sorted(got) == sorted(expected(rows, 5))


def test_sql_agrees_and_empty(spark, rows):
    df = frame(spark, rows)
    documents = df.toPandas()  # noqa: F841
    assert sorted(tuple(r) for r in divergence.divergence(df).collect()) == sorted(duckdb.sql(divergence.SQL).fetchall())
    assert divergence.divergence(df.limit(0)).count() == 0


def test_large_counts_stay_exact(spark):
    n, v = 9 * 10**15, 7
    df = spark.createDataFrame([(n, 3 * n, v)], "n bigint, total bigint, v bigint")
    from pyspark.sql import functions as F

    got = df.select(divergence.share(F.col("n"), F.col("total"), F.col("v")).alias("p")).first().p
    assert got == 1 + 10**9 * (n + 1) // (3 * n + v)
