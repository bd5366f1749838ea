"""Notices that are wrapped over lines."""

import random
import re
import textwrap

from tradewind.llm import license_scan

ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(t):
    return t.translate({c: c + 32 for c in range(65, 91)})


def want(text):
    """(label, best containment) over all lines and all stretches of a template's length."""
    w, found = ALNUM.findall(lower(text or "")), {}
    lines = [set(ALNUM.findall(lower(x))) for x in (text or "").split("\n")]
    for label, t in license_scan.TEMPLATES:
        words = ALNUM.findall(lower(t))
        own, n = set(words), len(words)
        for have in lines + [set(w[k : k + n]) for k in range(len(w))]:
            share = len(own & have) / len(own)
            if share >= license_scan.CONTAINMENT:
                found[label] = max(found.get(label, 0.0), share)
    return found


def test_wrapped_notices_are_found(frame, corpus):
    rng, rows = random.Random(4), list(corpus)
    for i, (_, t) in enumerate(license_scan.TEMPLATES):
        for j, width in enumerate((12, 30, 70)):
            for k, mark in enumerate(("", "# ", " * ")):
                words = t.split()
                if j == 1:
                    words[rng.randrange(len(words))] = "changed"
                body = textwrap.wrap("Some words go before it here. " + " ".join(words) + " And some after it.", width)
                rows.append((1000 + 100 * i + 10 * j + k, "\n".join(mark + x for x in body), "s"))
    rows.append((9000, "\n\n".join(["Released under", "the MIT", "License."] * 2), "s"))
    got = license_scan.license_scan(frame(rows)).where("doc_id is not null").collect()
    text = {i: t for i, t, _ in rows}
    for r in got:
        found = want(text[r.doc_id])
        assert {b.label for b in r.blocks} == set(found), r.doc_id
        assert r.score == max(found.values(), default=0.0), r.doc_id
    by = {r.doc_id: r for r in got}
    mit = next(i for i, (_, t) in enumerate(license_scan.TEMPLATES) if t.startswith("Permission"))
    assert "mit-notice" in by[1000 + 100 * mit + 21].labels and by[1000 + 100 * mit + 21].score == 1.0
    assert [(b.line, b.label) for b in by[9000].blocks] == [(0, "mit-notice"), (6, "mit-notice")]
