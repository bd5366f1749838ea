"""Merkle manifests against trees built in memory, and against SQL."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tradewind.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, root int, pos int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, more=0):
    i, text, lang, source, n = row
    values = (i, source, lang, None if n is None else n + more, text)
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """(root, the siblings with their sides of each leaf)."""
    ways, level, at = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(level) > 1:
        for leaf, i in enumerate(at):
            ways[leaf].append((level[i ^ 1], "l" if i & 1 else "r") if i ^ 1 < len(level) else ("", "-"))
        level = [h("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], ways


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    out = [(i, f"text {i} é" * rng.randint(0, 5), rng.choice(["en", "en", "en", "de"]), f"s{i % 3}", rng.randint(0, 99)) for i in range(150)]
    out += [(200, None, "fr", None, None), (201, "", None, "", 3), (None, "no id", "en", "s", 1), (None, "no id 2", None, "s", 1)]
    out += [(300, "twice", "en", "s", 5)] * 2 + [(300, "same id", "en", "s", 5), (301, "z" * 100_000, "日本", "s", 100_000)]
    out += [(400 + i, "x", "lone" + str(i), "s", 1) for i in range(9)] + [(500 + i, "x", "four", "s", 1) for i in range(4)]
    return out


def expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        group = sorted(by[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[lang] = (group, *tree([leaf_of(r) for r in group]))
    root, ways = tree([trees[x][1] for x in langs])
    for lang, up in zip(langs, ways, strict=True):
        group, subroot, own = trees[lang]
        for row, way in zip(group, own, strict=True):
            way = way + up
            hit = row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            at = leaf_of(row, int(hit))
            for other, side in way:
                at = h(other + at if side == "l" else at + other)
            yield (row[0], leaf_of(row), subroot, root, "".join(x for x, _ in way), "".join(s for _, s in way), at, not hit)


@pytest.mark.parametrize("height", [1, 2, 5, merkle.HEIGHT])
def test_manifest_equals_trees(spark, rows, height):
    df = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], SCHEMA).repartition(4)
    got = [tuple(r) for r in merkle.manifest(df, merkle.off_by_one(), height=height).collect()]
    assert sorted(got, key=repr) == sorted(expected(rows), key=repr)


def test_one_row_and_none(spark):
    df = spark.createDataFrame([(1, "a", "en", "s", 1, "x", 1, 2)], SCHEMA)
    one = merkle.manifest(df).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof == one.sides == "" and one.verified
    assert merkle.manifest(df.limit(0)).count() == 0


def test_sql_agrees(spark, rows):
    keep = [r for r in rows if r[0] is not None]
    df = spark.createDataFrame([(*r, "clash", 1, 2) for r in keep], SCHEMA)
    docs = df.toPandas()[["doc_id", "text", "lang", "source", "n_chars"]]  # noqa: F841
    con = duckdb.connect()
    con.sql("create view documents as select doc_id, text, lang, source, cast(n_chars as bigint) as n_chars from docs")
    out = merkle.manifest(df, merkle.off_by_one(), height=2).drop("sides").withColumn("proof", F.sha2("proof", 256))
    assert sorted(tuple(r) for r in out.collect()) == sorted(con.sql(merkle.SQL).fetchall())
