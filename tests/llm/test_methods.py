"""What the methods add to the base results, against plain versions."""

import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from tradewind.llm import bpe, line_dedup, lm_score, minhash_dedup, quality, secret_scan, token_counts

SPACE = re.compile("[^\x20\x09-\x0d]+")


def lower(t):
    return t.translate({c: c + 32 for c in range(65, 91)})


def test_two_texts_under_one_id_are_judged_apart(frame):
    words = lambda tag, n: " ".join(f"{tag}{i}" for i in range(n))
    a, b = words("a", 80), words("b", 60)
    rows = [(7, a + " tail", "s"), (7, b, "s"), (3, a, "s"), (3, a, "s"), (9, a + " tail", "s"), (9, b, "t"), (8, None, "s"), (8, "", "s")]
    out = minhash_dedup.near_duplicates(frame(rows)).collect()
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept, r.first) for r in out)
    assert got == [(3, 76, 3, True, True), (3, 76, 3, True, True), (7, 56, 7, True, True), (7, 77, 3, False, False), (8, 0, 8, True, True), (8, 0, 8, True, True), (9, 56, 7, False, False), (9, 77, 3, False, False)]
    kept = corpus_pipeline.near_duplicates(frame([]).sparkSession, frame(rows), "").collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == sorted([(3, a), (7, b), (8, ""), (8, "")])
    # Two like texts under the smallest id: one of them stays.
    kept = corpus_pipeline.near_duplicates(frame([]).sparkSession, frame([(1, a, "s"), (1, a + " tail", "s"), (2, a, "s")]), "").collect()
    assert len(kept) == 1 and kept[0].doc_id == 1


def test_candidates_at_low_similarity_are_few():
    at = lambda s, percent: (1 - (1 - s**minhash_dedup.K) ** minhash_dedup.collection_size(percent)) ** 2
    assert at(0.85, 85) > 0.9999 - 1e-9 and at(0.80, 80) > 0.9999 - 1e-9 and at(0.3, 85) < 0.07


def brute_score(rows):
    """The same model with dictionaries."""
    fold = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 for i, _, _ in rows]
    tokens = [[*SPACE.findall(lower(t or "")), "<end>"] for _, t, _ in rows]

    def count(folds):
        one, two = collections.Counter(), collections.Counter()
        for t, f in zip(tokens, fold, strict=True):
            if f in folds:
                one.update(["<start>", *t])
                two.update(zip(["<start>", *t], t, strict=False))
        return one, two

    every, rest = {0, 1, 3, 4, 5, 6}, {0, 1, 3, 4, 6}
    one, two = count(every)
    n = sum(c for w, c in one.items() if w != "<start>")
    v = len(one) - 1
    bucket = lambda c: min(math.ceil(math.log2(c + 1)), lm_score.BUCKETS - 1)
    # Held-out cells come from estimates without the held-out rows.
    one_r, two_r = count(rest)
    step = lambda x, m: round(-lm_score.STEPS * math.log2(x / m)) if x else -1
    cells = collections.Counter()
    for t, f in zip(tokens, fold, strict=True):
        if f == lm_score.EM_FOLD:
            for a, b in zip(["<start>", *t], t, strict=False):
                cells[bucket(one_r[a]), step(two_r[a, b], one_r[a]), step(one_r[b], n)] += 1
    weights = lm_score.learn([(*k, c) for k, c in cells.items()], 1 / (v + 1))
    out = []
    for t in tokens:
        total = 0.0
        for a, b in zip(["<start>", *t], t, strict=False):
            w = weights[bucket(one[a])]
            total += math.log10(w[0] * two[a, b] / max(one[a], 1) + w[1] * one[b] / n + w[2] / (v + 1))
        out.append(total)
    return out


def test_lm_score_equals_the_plain_model(frame, corpus):
    rows = [r for r in corpus if r[0] is not None and r[0] != 98]
    got = {r.doc_id: r.score for r in lm_score.lm_scores(frame(rows)).collect()}
    for (i, _, _), want in zip(rows, brute_score(rows), strict=True):
        assert got[i] == pytest.approx(want, rel=1e-6), i


def test_em_finds_the_weights_that_make_held_out_counts_likeliest():
    cells = [(4, 8, 40, 60), (4, -1, 24, 30), (4, 16, 80, 10)]
    w = lm_score.learn(cells, 1e-3, rounds=300)[4]
    value = lambda q: 0.0 if q < 0 else 2.0 ** (-q / lm_score.STEPS)
    like = lambda w: sum(n * math.log(w[0] * value(a) + w[1] * value(b) + w[2] * 1e-3 + 1e-300) for _, a, b, n in cells)
    rng = np.random.default_rng(0)
    assert like(w) >= max(like(x) for x in rng.dirichlet([1, 1, 1], 3000)) - 1e-3


def test_secret_links_equal_all_pairs(frame, corpus):
    rng = random.Random(12)
    pieces = ["password: hunter2222", "AKIA" + "ABCDEFGH12345678", "0123456789abcdef01234567", "https://api.example.com/v1", "client_id = robot7", "aB3" + "xYz9" * 10, "user_name: someone"]
    rows = list(corpus)
    for i in range(150):
        t = " ".join(x for _ in range(rng.randint(1, 6)) for x in (rng.choice(pieces), "word " * rng.choice([0, 1, 20, 38, 39, 40, 45, 90])))
        rows.append((1000 + i, t, "s"))
    needs = {"opaque": {"identifier", "endpoint"}, "identifier": {"secret"}, "endpoint": {"secret"}}
    role = {"assign": "secret", "access": "identifier", "hex": "secret", "endpoint": "endpoint", "identifier": "identifier", "opaque": "secret"}
    # The rules again, one pattern a kind, tried on whole texts.
    any_case = re.ASCII | re.IGNORECASE
    strong = {
        "assign": (re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", any_case), lambda m: len(m[1]) >= 6),
        "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    }
    weak = {
        "endpoint": (re.compile(r"[a-z][a-z0-9+]{1,15}://[A-Za-z0-9._~:@/?#%&=+-]{4,}"), lambda m: True),
        "identifier": (re.compile(r"""(?:client|access|account|user)[_-]?(?:id|key|name)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}""", any_case), lambda m: True),
        "opaque": (re.compile("[A-Za-z0-9+/_-]{32,}={0,2}"), lambda m: all(re.search(c, m[0]) for c in ("[0-9]", "[A-Z]", "[a-z]"))),
    }

    def parts(t):
        sure = [(m.start(), m.end(), kind) for kind, (p, ok) in strong.items() for m in p.finditer(t) if ok(m)]
        more = [(m.start(), m.end(), kind) for kind, (p, ok) in weak.items() for m in p.finditer(t) if ok(m)]
        more = [x for x in more if not any(s < x[1] and x[0] < e for s, e, _ in sure)]
        return sorted(sure + more, key=lambda x: (x[0], secret_scan.KINDS.index(x[2])))

    def brute(t):
        found, out = parts(t or ""), []
        for s, e, kind in found:
            near = {role[k] for a, _, k in found if abs(a - s) <= secret_scan.SCOPE}
            if kind in ("assign", "access", "hex") or near & needs[kind]:
                out.append(f"{kind}:{s}:{e}")
        return ",".join(out), sum(x.split(":")[0] in needs for x in out)

    got = sorted((repr(r.doc_id), r.spans, r.n_linked) for r in secret_scan.secret_scan(frame(rows)).collect())
    assert got == sorted((repr(i), *brute(t)) for i, t, _ in rows)
    assert len({n for *_, n in got}) > 3


def test_paths_of_the_forest_by_walking_each_tree():
    rng = np.random.default_rng(3)
    good, x = rng.normal(size=(400, 8)), rng.normal(size=(60, 8)) * 3
    forest = quality.grow(good, np.stack([x.min(axis=0), x.max(axis=0)]), trees=20, per_tree=64)
    want = []
    for row in x:
        total = 0.0
        for root in forest["roots"]:
            at = root
            while forest["feature"][at] >= 0:
                at = forest["left"][at] + int(row[forest["feature"][at]] >= forest["cut"][at])
            total += forest["path"][at]
        want.append(2 ** (-total / 20 / forest["norm"]))
    got = quality.anomaly(forest, x)
    assert np.allclose(got, want)
    # Far from all good rows, paths are short.
    assert quality.anomaly(forest, np.full((1, 8), 50.0))[0] > np.median(quality.anomaly(forest, good))


def test_held_out_labels(spark, frame):
    rng = random.Random(2)
    clean = [(i, " ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, 10**6):x}" for _ in range(rng.randint(60, 200))) + ".", "s") for i in range(400)]
    junk = [(i, " ".join(f"{rng.randint(0, 10**6):x}{rng.choice(['###', '***', '&&&'])}" for _ in range(120)), "s") for i in range(400, 480)]
    labels = spark.createDataFrame([(i, int(i < 400), 0) for i in range(480)], "doc_id bigint, quality int, toxic int")
    got = {r.quality: (r.rows, r.kept) for r in quality.held_out(frame([*clean, *junk]), labels).collect()}
    assert got[0][0] > 5 and got[0][1] == 0
    assert got[1][0] > 50 and got[1][1] >= 0.95 * got[1][0]


def test_empty_tables_and_rows_without_text(spark, frame, tmp_path):
    none = frame([]).limit(0)
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    start, inner = token_counts.byte_vocabulary(vocabulary)
    assert token_counts.token_counts(none, start, inner).count() == 0 and bpe.bpe(none, vocabulary).count() == 0
    assert line_dedup.rewrite(none).count() == 0
    d = f"file://{tmp_path}"
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, d).count() == 0, name
    bare = frame([(None, None, None), (None, "", None), (1, None, None), (1, None, None)])
    for name, stage in corpus_pipeline.STAGES:
        want = {"quality_rules": 0, "minhash_dedup": 3}.get(name, 4)
        assert stage(spark, bare, d).count() == want, name
