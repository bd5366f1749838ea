"""Operators that judge each row by itself, against plain versions."""

import hashlib
import re
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tradewind.llm import bpe, license_scan, quality, secret_scan, token_counts

ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SPACE = re.compile("[^\x20\x09-\x0d]+")
SYMBOLS = set("#*$%&|<>")


def lower(t):
    return t.translate({c: c + 32 for c in range(65, 91)})


def by_text(df, docs):
    """Results are compared as multisets of rows, as ids repeat and may be absent."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_license_scan(frame, corpus):
    rows = [*corpus, (200, "x\nThis work is Licensed under the GNU general   PUBLIC license, version 3.\nMIT LICENSE mit license", "a"), (201, "CC-BY 4.0 and cc by", "a"), (202, "Licensed, under the Apache thing: License; Version (2)", "b"), (203, "rights all RESERVED", "b"), (204, "cc\nby", "b")]

    def brute(i, t, _):
        t = t or ""
        w = ALNUM.findall(lower(t))
        places = [(k, label) for p, label in license_scan.PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        labels, best = {x for _, x in places}, 0.0
        for line in t.split("\n"):
            have = set(ALNUM.findall(lower(line)))
            for label, text in license_scan.TEMPLATES:
                want = set(ALNUM.findall(lower(text)))
                share = len(want & have) / len(want)
                if share >= license_scan.CONTAINMENT:
                    labels, best = labels | {label}, max(best, share)
        at = [k for k, _ in places]
        return (i, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})), ",".join(sorted(labels)), best)

    got = by_text(license_scan.license_scan(frame(rows)).drop("blocks"), rows)
    assert got == sorted((brute(*r) for r in rows), key=repr)
    assert license_scan.license_scan(frame([]).limit(0)).count() == 0


def test_secret_scan(frame, corpus):
    key, hexed = "AKIA" + "ABCDEFGH12345678", "0123456789abcdef01234567"
    opaque = "aB3" + "xYz9" * 10
    rows = [
        *corpus,
        (200, f'é password: "hunter22" api-key=zz API_KEY = abcdef {hexed} {key}', "a"),
        (201, f"token = {hexed}x secret=short passwd:12345 PASSWORD=longer=", "a"),
        (202, f"{opaque} alone", "a"),
        (203, f"client_id = robot7 then {opaque} at https://api.example.com/v1", "a"),
        (204, f"{opaque} " + "word " * 100 + " https://api.example.com/v1", "a"),
        (205, f"AKIAshort {key}x {key.lower()}", "a"),
        (206, "ſecret=abcdefgh toKen=abcdefgh", "a"),
    ]
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)

    def brute(i, t, _):
        t = t or ""
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        return (i, *(sum(k == n for _, k, _ in spans) for n in range(3)), ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans)))

    out = secret_scan.secret_scan(frame(rows))
    assert by_text(out.select("doc_id", "n_assign", "n_access", "n_hex", "base_spans"), rows) == sorted((brute(*r) for r in rows), key=repr)
    linked = {r.doc_id: r for r in out.where("doc_id >= 200").collect()}
    assert linked[202].n_linked == 0 and linked[202].spans == ""
    assert linked[203].n_linked == 3 and [x.kind for x in linked[203].found] == ["identifier", "opaque", "endpoint"]
    assert linked[204].n_linked == 0
    assert secret_scan.secret_scan(frame([]).limit(0)).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    return public_tokenizers.path("byte_bpe_50k.json")


def test_bpe_equals_the_library(frame, corpus, vocabulary):
    rows = [*corpus, (200, "a <|endoftext|> b<|endoftext|><|endoftext|>", "x"), (201, "'s 're  \n\n  x y 　 z ", "x"), (202, "aaaaaaaaaaaaaaaaaaaaaaaa" * 50, "x"), (203, "👩‍👩‍👧 café ÿ \x00\x7f", "x")]
    t = Tokenizer.from_file(vocabulary)

    def brute(i, text, _):
        ids = t.encode(text or "", add_special_tokens=False).ids
        return (i, len(ids), bytearray(struct.pack(f"<{len(ids)}I", *ids)), t.decode(ids, skip_special_tokens=False))

    assert by_text(bpe.bpe(frame(rows), vocabulary), rows) == sorted((brute(*r) for r in rows), key=repr)


def test_merge_gadgets_on_a_small_alphabet():
    import itertools

    labels = {0: b"a", 1: b"b", 2: b"aa", 3: b"ab", 4: b"aab", 5: b"ba", 6: b"aaaa"}
    merges = [(0, 0, 2), (0, 1, 3), (2, 1, 4), (1, 0, 5), (2, 2, 6)]
    automaton = bpe.Automaton(labels, merges)
    ranks = {(u, v): (r, w) for r, (u, v, w) in enumerate(merges)}

    def merge(word):
        ids = [0 if c == "a" else 1 for c in word]
        while True:
            best = min(((ranks[p][0], i) for i, p in enumerate(itertools.pairwise(ids)) if p in ranks), default=None)
            if best is None:
                return ids
            ids[best[1] : best[1] + 2] = [merges[best[0]][2]]

    for n in range(1, 11):
        for word in itertools.product("ab", repeat=n):
            assert automaton.encode("".join(word).encode()) == merge(word), word


def test_each_byte_moves_the_automaton_to_one_state(vocabulary):
    import random

    with open(vocabulary, encoding="utf-8") as f:
        a = bpe.compiled(f.read()).automaton
    by_label = {a.labels[t]: t for t in a.token if t >= 0}
    rng = random.Random(6)
    for _ in range(300):
        word = "".join(rng.choice(["the", "ing", "a", "b", "ee", " ", "é", "日", "0", "XY"]) for _ in range(rng.randint(1, 30))).encode()
        path = a.encode(word)
        assert b"".join(a.labels[t] for t in path) == word
        # Of all tokens that end the word, one alone goes on from the encoding of what is before it.
        ends = [by_label[word[i:]] for i in range(len(word)) if word[i:] in by_label]
        assert [t for t in ends if len(word) == a.size[t] or a.arc(a.encode(word[: -a.size[t]])[-1], t)] == path[-1:]


def test_token_counts(frame, corpus, vocabulary):
    start, inner = token_counts.byte_vocabulary(vocabulary)
    starts, inners = set(start), set(inner)

    def pieces(word, longest=130):
        n, at, have = 0, 0, starts
        while at < len(word):
            end = next((e for e in range(min(len(word), at + longest), at, -1) if word[at:e] in have), None)
            if end is None:
                return 1
            n, at, have = n + 1, end, inners
        return n

    def brute(i, t, _):
        each = [pieces(b" " + w.encode()) for w in SPACE.findall(t or "")]
        return (i, len(each), sum(each), max(each, default=0))

    assert by_text(token_counts.token_counts(frame(corpus), start, inner), corpus) == sorted((brute(*r) for r in corpus), key=repr)


def test_longest_match_with_unknown_pieces():
    a = token_counts.compile_automaton([b"ab", b"abcde", b"c"], [b"c", b"cd", b"de", b"f"])
    for word, want in ((b"abcde", 1), (b"abcdf", 3), (b"abcd", 2), (b"abde", 2), (b"c", 1), (b"x", 1), (b"abx", 1), (b"", 0), (b"abcfde", 4)):
        assert a.count(word) == want, word


def test_rule_statistics(frame, corpus):
    rows = [*corpus, (200, "a b c a b c\n\na b c a b c\n \nx # $$ |", "s"), (201, "Ä é\x0bü", "s")]

    def brute(i, t, _):
        t = t or ""
        w = SPACE.findall(t)
        windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        seen = {}
        for x in windows:
            seen[x] = seen.get(x, 0) + 1
        covered = {k + j for k, x in enumerate(windows) if seen[x] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if SPACE.search(x)]
        n_words = len(w)
        return (i, n_words, sum(map(len, w)), sum(c in SYMBOLS for c in t), len(lines) - len(set(lines)), len(covered))

    got = by_text(quality.rule_statistics(frame(rows)).select("doc_id", *quality.COUNTS[:5]), rows)
    assert got == sorted((brute(*r) for r in rows), key=repr)


def test_quality_keeps_clean_and_rejects_junk(spark, frame, corpus):
    import random

    rng = random.Random(2)
    # Words that hardly repeat, so that no rule but the trees can tell.
    clean = [(i, " ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, 10**6):x}" for _ in range(120)) + ".", "s") for i in range(1000, 1200)]
    junk = [(i, " ".join(f"{rng.randint(0, 10**6):x}###" for _ in range(120)), "s") for i in range(1200, 1240)]
    docs, marks = frame([*corpus, *clean, *junk]), [(i, int(i < 1200), 0) for i in range(1000, 1240, 2)]
    labels = spark.createDataFrame([*marks, (None, 1, 0), (5, None, None)], "doc_id bigint, quality int, toxic int")
    out = {r.doc_id: r for r in quality.quality(docs, labels).where("doc_id >= 1000").collect()}
    assert all(out[i].kept for i in range(1000, 1200)) and not any(out[i].kept for i in range(1200, 1240))
    assert not any(r.base_failed for r in out.values())
    none = quality.quality(docs, labels.limit(0)).collect()
    assert len(none) == len(corpus) + 240 and all(r.kept != r.base_failed for r in none)
    assert quality.quality(frame([]).limit(0), labels).count() == 0


def test_threshold_bounds_lost_good_rows():
    seen = [(9000, 0, 50), (8000, 1, 1), (8000, 0, 30), (7000, 1, 100), (7000, 0, 20)]
    assert quality.threshold(seen, 0.02) == 0.75
    assert quality.threshold(seen, 0.001) == 0.85
    assert quality.threshold([(1, 1, 5)]) == 2.0


def test_digest():
    assert secret_scan.digest("") == hashlib.sha256(b"").hexdigest()
