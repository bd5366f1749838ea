import random
import re
from collections import Counter

import duckdb
import public_tokenizers
import pyarrow as pa
from test_corpus_operators import brute_components, brute_leaks
from tokenizers import Tokenizer

import corpus_pipeline
from tradewind.llm import line_dedup, quality
from tradewind.llm.shared import save


def test_stages_in_order(spark, frame, corpus, tmp_path):
    rng = random.Random(4)
    words = lambda n: " ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, 10**6):x}" for _ in range(n))
    passage = words(30)
    clean = [(i, "\n".join(words(40) for _ in range(3)), f"s{i % 15}") for i in range(1000, 1100)]
    clean = [(i, f"shared boilerplate of all sites\n{t}" if i % 2 else t, s) for i, t, s in clean]
    copies = [(i, clean[0][1], "s1") for i in range(1100, 1110)] + [(1110, clean[1][1].replace("\n", " \n "), "s2")]
    leak = [(1200, f"{words(60)} {passage} {words(60)}", "s3")]
    junk = [(i, " ".join(f"{rng.randint(0, 10**6):x}###" for _ in range(120)), "s4") for i in range(1300, 1320)]
    d = f"file://{tmp_path}"
    docs = frame([*clean, *copies, *leak, *junk, (1400, None, "s1"), (1401, "", None), (1000, clean[0][1], clean[0][2])])
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i < 1300), 0) for i in [*range(1000, 1100, 2), *range(1300, 1320, 2)]], "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "minhash_dedup", "decontamination", "bpe"]
    kept, now = {}, spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = save(stage(spark, now, d), name)
        assert sorted(now.columns) == sorted(docs.columns)
        kept[name] = {r.doc_id: r.text for r in now.collect()}
    assert set(range(1000, 1111)) | {1200} == set(kept["quality_rules"])
    assert kept["line_dedup"][1003] == dict((i, t) for i, t, _ in clean)[1003].split("\n", 1)[1]
    assert set(kept["minhash_dedup"]) == set(range(1000, 1100)) | {1200}
    assert set(kept["decontamination"]) == set(range(1000, 1100))
    out = corpus_pipeline.run(spark, d).collect()
    assert len(out) == 100 and all(r.n_tokens * 4 == len(r.ids) for r in out)


def test_each_stage_does_what_a_plain_version_does(spark, frame, corpus, tmp_path):
    """Every stage on what the one before it kept: rows in and out compared with brute force."""
    rng = random.Random(14)
    d = f"file://{tmp_path}"
    passage = " ".join(f"q{rng.randint(0, 200)}" for _ in range(25))
    extra = [(2000 + i, f"{' '.join(f'x{rng.randint(0, 3000)}' for _ in range(70))}\nfollow this site on all channels\n{passage if i % 9 == 0 else 'end'}", f"s{i}") for i in range(60)]
    extra += [(2100 + i, extra[i][1] + f" x{i}" * (i % 2), "copies") for i in range(10, 16)]
    rows = [r for r in corpus if len(r[1] or "") < 20_000] + extra
    frame(rows).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i < 2050), 0) for i in range(2000, 2060)], "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    now = spark.read.parquet(f"{d}/documents.parquet")
    rows_of = lambda df: sorted(((r.doc_id, r.text, r.source) for r in df.collect()), key=repr)
    stage = dict(corpus_pipeline.STAGES)
    step = lambda name: save(stage[name](spark, now, d), name)

    before, now = rows_of(now), step("quality_rules")
    kept = {(r.doc_id, r.text_key): r.kept for r in quality.quality(frame(before), spark.read.parquet(f"{d}/labels.parquet")).collect()}
    words = lambda t: len((t or "").split())

    def base_failed(t):
        w = re.findall("[^\x20\x09-\x0d]+", t or "")
        three = Counter(zip(w, w[1:], w[2:], strict=False))
        again = {k + x for k, x3 in enumerate(zip(w, w[1:], w[2:], strict=False)) if three[x3] > 1 for x in range(3)}
        return len(w) < 50 or 100 * len(again) > 50 * len(w)

    # What the base rule rejects goes whatever the forest says; what is kept is unchanged.
    assert {r for r in before if base_failed(r[1])}.isdisjoint(rows_of(now)) and set(rows_of(now)) <= set(before)
    assert any(not base_failed(r[1]) for r in before) and any(base_failed(r[1]) for r in before)
    assert len(rows_of(now)) == sum(1 for r in quality.quality(frame(before), spark.read.parquet(f"{d}/labels.parquet")).collect() if r.kept)
    assert all(words(t) >= 50 for _, t, _ in rows_of(now)) and any(kept.values())

    before, now = rows_of(now), step("line_dedup")
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([r[0] for r in before], pa.int64()), "text": [r[1] for r in before], "source": pa.array([r[2] for r in before], pa.string())}))
    clean = {r[0]: r[1] for r in con.sql(f"select doc_id, clean_text from ({line_dedup.SQL})").fetchall()}
    assert rows_of(now) == sorted(((i, clean[i], s) for i, _, s in before), key=repr) and clean != {i: t for i, t, _ in before}

    before, now = rows_of(now), step("minhash_dedup")
    top = brute_components(before, 80)
    assert rows_of(now) == sorted(((i, t, s) for i, t, s in before if i is None or top[i][1] == i), key=repr) and len(rows_of(now)) < len(before)

    before, now = rows_of(now), step("decontamination")
    leaks = {i for i, _ in brute_leaks(before, [(1, passage)])}
    assert rows_of(now) == [r for r in before if r[0] not in leaks] and leaks

    library, out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), stage["bpe"](spark, now, d).collect()
    want = {i: library.encode(t or "", add_special_tokens=False).ids for i, t, _ in rows_of(now)}
    assert {r.doc_id: r.n_tokens for r in out} == {i: len(x) for i, x in want.items()}
    assert all(bytes(r.ids) == b"".join(x.to_bytes(4, "little") for x in want[r.doc_id]) for r in out)
