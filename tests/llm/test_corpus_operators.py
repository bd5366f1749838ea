"""Operators that compare rows with each other, against plain versions."""

import math
import random
import re
import zlib

import duckdb
import pyarrow as pa
import pytest

from tradewind.llm import decontaminate, line_dedup, lm_score, minhash_dedup, substring_dedup
from tradewind.llm import textvec as tv

SPACE = re.compile("[^\x20\x09-\x0d]+")


def lower(t):
    return t.translate({c: c + 32 for c in range(65, 91)})


def sql_rows(rows, sql):
    con = duckdb.connect()
    table = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string()), "source": pa.array([r[2] for r in rows], pa.string())})
    con.register("documents", table)
    out = con.sql(sql)
    return out.columns, sorted(out.fetchall(), key=repr)


def test_line_dedup_equals_sql(frame, corpus):
    # Many sites around the threshold, so that both the estimate and the exact count decide.
    extra = [(300 + i, f"only {i} of its own and some more words {i * i}\nedge {n} of it\n more {i + n} text here {i}", f"e{i}") for n in (8, 9, 10, 11, 12, 30) for i in range(n)]
    # Whole copies on as many sites as make a line boilerplate, and on one less.
    extra += [(500 + 20 * n + i, f"a story told {n}\non {n} sites", f"c{i}") for n in (9, 10) for i in range(n)]
    rows = [*corpus, *extra]
    out = line_dedup.line_dedup(frame(rows))
    cols, want = sql_rows(rows, line_dedup.SQL)
    assert out.columns == cols
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want
    assert any(r[3] for r in want) and all(r[2] == r[3] for r in want)
    assert line_dedup.line_dedup(frame([]).limit(0)).count() == 0


def test_line_rewrite_keeps_columns_and_rows(frame, corpus):
    extra = [(300 + i, f"boiler line\nown text number {i} " + "w " * i, f"e{i}") for i in range(12)]
    docs = frame([*corpus, *extra])
    out = line_dedup.rewrite(docs)
    assert out.schema == docs.schema or [f.name for f in out.schema] == [f.name for f in docs.schema]
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(corpus) + 12
    assert got[300].text == "own text number 0 " and got[300].n_chars == len(got[300].text)
    assert got[90].text is None


def test_substring_dedup_equals_sql(frame, corpus):
    long = " ".join(f"passage{i}" for i in range(60))
    many = ". ".join(" ".join(f"s{i}x{j}" for j in range(9)) for i in range(8)) + ". "
    rows = [*corpus, (301, f"start\n{long}\nend", "a"), (302, f"{long.upper()} \n{long}\n", "a"), (303, long, "b"), (304, "é é é é é é\n  é é  é é é é\ntail", "b")]
    rows += [(305, f"Own words, {many}and so on", "b"), (306, f" \n Mr. X. {many}\n\n{many}", "c"), (307, f"é {many[:-60]}?! Yes. No! {many[:200]}\x0b!", "c"), (308, "A! B! C! D! " * 30, "c"), (309, "A!! B! C! D! " * 30, "c")]
    out = substring_dedup.substring_dedup(frame(rows))
    cols, want = sql_rows(rows, substring_dedup.SQL)
    # A row that repeats id and text is one document here, and two rows in the SQL; they are compared apart.
    got = sorted((tuple(r) for r in out.drop("removed").where("doc_id is null or doc_id <> 98").collect()), key=repr)
    assert out.drop("removed").columns == cols
    assert got == [r for r in want if r[0] != 98]
    # Without a floor every unit but the first of its kind goes, and with it n_repeated says what is left.
    bare = substring_dedup.substring_dedup(frame(rows), min_run_words=1).drop("removed")
    _, all_of = sql_rows(rows, substring_dedup.sql(1))
    assert sorted((tuple(r) for r in bare.where("doc_id is null or doc_id <> 98").collect()), key=repr) == [r for r in all_of if r[0] != 98]
    assert all(r[2] == r[3] for r in all_of) and any(r[2] > r[3] for r in want)
    twice = [r for r in out.where("doc_id = 98").collect()]
    assert len(twice) == 2 and all(r.n_removed == 0 for r in twice)
    by = {r.doc_id: r for r in out.where("doc_id > 300").collect()}
    assert (by[302].n_removed, by[302].removed_spans, by[302].clean_text) == (2, f"0:{2 * len(long) + 3}", "")
    # In 305 the passage's first sentence begins with other words, so it occurs first in the second copy of 306.
    assert by[305].n_removed == 0 and by[306].n_removed == 14 and by[307].n_removed > 0
    text = dict((i, t) for i, t, _ in rows)[306]
    assert [text[x.start : x.end].split()[0] for x in by[306].removed] == ["s1x0", "s1x0"] and by[306].removed[1].end == len(text)
    assert substring_dedup.substring_dedup(frame([]).limit(0)).count() == 0


def shingle_set(t, size=5):
    w = SPACE.findall(lower(t or ""))
    if not w:
        return set()
    return {tuple(w)} if len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def brute_components(rows, percent):
    sets = {i: shingle_set(t) for i, t, _ in rows if i is not None}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a_, b_ = find(a), find(b)
                top[max(a_, b_)] = min(a_, b_)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(n, seed, length=150, edits=14):
    rng = random.Random(seed)
    base = [f"b{rng.randint(0, 9999)}" for _ in range(length)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randint(0, 40)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("percent", "seed"), [(85, 1), (80, 2)])
def test_near_duplicates_lose_no_link(frame, corpus, percent, seed):
    rows = [r for r in corpus if r[0] is not None] + [(400 + i, t, "s") for i, t in enumerate(near_copies(120, seed))]
    want = brute_components(rows, percent)
    out = minhash_dedup.near_duplicates(frame(rows), percent=percent).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_shingles, r.component_id) == want[r.doc_id], r.doc_id
        assert r.kept == (r.doc_id == r.component_id)
    assert len({c for _, c in want.values()}) < len(want)


def test_near_duplicates_edge_rows(frame):
    out = minhash_dedup.near_duplicates(frame([(None, "a b c d e f", "s"), (3, "a b c d e f", "s"), (2, None, "s"), (1, " ", "s"), (5, "x", "s"), (4, "X", "s")])).collect()
    by = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out}
    assert by == {None: (2, None, True), 3: (2, 3, True), 2: (0, 2, True), 1: (0, 1, True), 5: (1, 4, False), 4: (1, 4, True)}
    assert minhash_dedup.near_duplicates(frame([]).limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    n = 200
    links = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(1001, 1000), (1002, 1001)], "a bigint, b bigint")
    got = {r.node: r.component for r in minhash_dedup.components(links).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000, 1002: 1000}


def brute_lm(rows):
    tokens = [[*SPACE.findall(lower(t or "")), None] for _, t, _ in rows]
    fold = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 for i, _, _ in rows]
    count = {}
    for t, f in zip(tokens, fold, strict=True):
        for w in t if f != 2 else ():
            count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    base = [sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in t) for t in tokens]
    return [(i, f == 2, len(t), sum(w in count for w in t), n, round(b, 6)) for (i, _, _), t, f, b in zip(rows, tokens, fold, base, strict=True)]


def test_lm_counts_and_base(frame, corpus):
    got = lm_score.lm_scores(frame(corpus)).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == sorted(brute_lm(corpus), key=repr)
    assert all(r.score < 0 for r in got)


def test_lm_model_beats_the_base_on_held_out_rows(frame):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        w = [rng.choice("abcd")]
        for _ in range(60):
            # After each word mostly one follower: what a bigram model can learn.
            w.append(chr(ord(w[-1]) + 1) if rng.random() < 0.8 and w[-1] < "z" else rng.choice("abcdefghij"))
        rows.append((i, " ".join(w), "s"))
    out = lm_score.lm_scores(frame(rows)).where("held_out").collect()
    per = lambda c: sum(r[c] for r in out) / sum(r.n_tokens for r in out)
    assert per("score") > per("base_score") + 0.3
    # A text that follows the pattern is likelier than the same words shuffled.
    a, b = "a b c d e f g h i j", "j a i b h c g d f e"
    s = {r.doc_id: r.score for r in lm_score.lm_scores(frame([*rows, (9000, a, "s"), (9001, b, "s")])).where("doc_id >= 9000").collect()}
    assert s[9000] > s[9001]


def test_lm_probabilities_sum_to_one():
    weights = lm_score.learn([(0, -1, 8, 5), (3, 4, 16, 50), (3, -1, 24, 20), (9, 0, 40, 7)], 0.01)
    assert all(abs(w.sum() - 1) < 1e-9 and (w >= 0).all() for w in weights)
    assert weights[3][0] > 0.3 and weights[0][0] == 0


def test_lm_edges(frame):
    out = lm_score.lm_scores(frame([(4, None, "s")])).collect()
    assert (out[0].n_tokens, out[0].score < 0.0 or out[0].score == 0.0) == (1, True)
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    out = lm_score.lm_scores(frame([(held, "a b", "s")])).collect()
    assert (out[0].train_tokens, out[0].n_known, out[0].score) == (0, 0, 0.0)
    assert lm_score.lm_scores(frame([]).limit(0)).count() == 0


def alnum(t):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(t or ""))


def brute_leaks(rows, items, limit=0.8, size=5):
    sets = {i: (len(w := alnum(t)), {tuple(w[k : k + min(size, len(w))]) for k in range(len(w) - min(size, len(w)) + 1)}) for i, t in items if alnum(t)}
    df = {}
    for _, s in sets.values():
        for x in s:
            df[x] = df.get(x, 0) + 1
    weight = lambda x: math.log1p(len(sets) / df.get(x, 1))
    out = set()
    for i, t, _ in rows:
        w = alnum(t)
        for item, (n, s) in sets.items():
            k = min(size, n)
            for a in range(len(w) - n + 1):
                own = {tuple(w[b : b + k]) for b in range(a, a + n - k + 1)}
                if not own & s:
                    continue
                both = sum(map(weight, own & s))
                if both >= limit * (sum(map(weight, own | s))) * (1 - 1e-12):
                    out.add((i, item))
    return out


def test_decontamination(spark, frame, corpus):
    rng = random.Random(8)
    items = [(i, " ".join(f"q{rng.randint(0, 200)}" for _ in range(rng.randint(12, 40)))) for i in range(25)] + [(25, "tiny item"), (26, None), (27, ""), (28, "loop loop loop loop loop loop loop loop loop")]
    rows = [r for r in corpus if len(r[1] or "") < 20_000]
    rows.append((890, "z" * 50_000 + " v" * 20_000 + f" {items[2][1]} " + "tiny item x " * 3000, "s"))
    for i in range(25):
        w = items[i][1].split()
        pad = " ".join(f"p{rng.randint(0, 500)}" for _ in range(50))
        rows.append((500 + i, f"{pad} {' '.join(w).upper()}, {pad}", "s"))
        if len(w) > 30:
            rows.append((600 + i, f"{pad} {' '.join([*w[:-1], 'changed'])} {pad}", "s"))
        rows.append((700 + i, f"{pad} {' '.join(w[: len(w) // 2])} {pad}", "s"))
    rows += [(800, "a tiny. ITEM here", "s"), (801, items[3][1] + " " + items[4][1] + " x " + items[3][1], "s"), (802, "loop " * 40, "s")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute_leaks(rows, items)
    for block in (2000, 7):
        out = decontaminate.contaminated(frame(rows), bench, block_items=block)
        assert {(r.doc_id, r.item_id) for r in out.collect()} == want
    assert {(500 + i, i) for i in range(25)} <= want and (802, 28) in want
    three = [r for r in decontaminate.contaminated(frame(rows), bench).where("doc_id = 801 and item_id = 3").collect()]
    assert len(three) == 2 and {r.similarity for r in three} == {1.0}
    assert decontaminate.contaminated(frame([]).limit(0), bench).count() == 0
    assert decontaminate.contaminated(frame(rows), bench.limit(0)).count() == 0


@pytest.mark.parametrize("radius", [66, 40, 0])
def test_multi_index_finds_all_within_the_radius(radius):
    import numpy as np

    rng = np.random.default_rng(1)
    index = decontaminate.build([(i, " ".join(f"m{rng.integers(0, 50)}" for _ in range(20))) for i in range(40)])
    prints = rng.integers(0, 256, (2000, 32), dtype=np.uint8)
    # Fingerprints of items with up to 90 flipped bits.
    near = np.unpackbits(index.prints[rng.integers(0, 40, 2000)], axis=1)
    for row, n in zip(near, rng.integers(0, 90, 2000), strict=True):
        row[rng.permutation(256)[:n]] ^= 1
    both = np.concatenate([prints, np.packbits(near, axis=1)])
    w, i, far = decontaminate._within(index, both, np.arange(40), radius)
    d = np.bitwise_count(both[:, None] ^ index.prints[None]).sum(axis=2)
    assert {(int(a), int(b)) for a, b in zip(w, i, strict=True)} == {(int(a), int(b)) for a, b in zip(*np.nonzero(d <= radius), strict=True)}
    assert (far == d[w, i]).all()
    # Random pairs are nearly all ruled out before distances are computed.
    assert len(decontaminate._voted(index, prints, np.arange(40), radius)[0]) < 0.05 * len(prints) * 40


def test_fingerprints_of_similar_windows_are_within_the_radius():
    import numpy as np

    rng = np.random.default_rng(5)
    far = []
    for _ in range(300):
        n = int(rng.integers(10, 60))
        own = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        weight = rng.uniform(0.7, 6.0, n)
        # As much replaced as similarity 0.8 allows.
        order, cut = rng.permutation(n), 0
        while cut < n and 0.8 * (weight.sum() + weight[order[: cut + 1]].sum()) <= weight.sum() - weight[order[: cut + 1]].sum():
            cut += 1
        other = own.copy()
        other[order[:cut]] = rng.integers(0, 1 << 63, cut, dtype=np.uint64)
        a, b = (decontaminate._pack((decontaminate._bits(x) * weight[:, None]).sum(axis=0)[None])[0] for x in (own, other))
        far.append(int(np.bitwise_count(a ^ b).sum()))
    assert max(far) <= decontaminate.RADIUS
