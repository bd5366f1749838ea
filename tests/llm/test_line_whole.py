"""Boilerplate goes in every document, also where it makes up most of the text."""

import corpus_pipeline
from tradewind.llm import line_dedup, queries

NAV = ["home shop contact imprint and more of the navigation", "all rights reserved by the owner of this site"]


def whole_rows():
    pages = [(i, "\n".join([*NAV, f"own {i}"]), f"s{i}") for i in range(12)]
    copies = [(100 + i, "a story told\non many sites", f"c{i}") for i in range(10)]
    few = [(200 + i, "\n".join(NAV), f"f{i}") for i in range(2)]
    return [*pages, *copies, *few, (300, "\n".join([NAV[0], "a story told", "x"]), None)]


def test_pages_of_mostly_boilerplate_lose_it(spark, frame, tmp_path):
    frame(whole_rows()).write.parquet(f"file://{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op2_line_dedup(spark, f"file://{tmp_path}").collect()}
    assert all((got[i].n_boilerplate, got[i].n_removed, got[i].clean_text) == (2, 2, f"own {i}") for i in range(12))
    # A text on ten sites counts for one of them, so its lines are no boilerplate; its own navigation goes all the same.
    assert all((got[100 + i].n_boilerplate, got[100 + i].n_removed) == (0, 0) for i in range(10))
    assert all((got[200 + i].n_removed, got[200 + i].clean_text) == (2, "") for i in range(2))
    assert got[300].clean_text == "a story told\nx"


def test_the_pipeline_stage_does_the_same(spark, frame):
    got = {r.doc_id: r for r in corpus_pipeline.lines(spark, frame(whole_rows()), "").collect()}
    assert all((got[i].text, got[i].n_chars) == (f"own {i}", len(f"own {i}")) for i in range(12))
    assert got[100].text == "a story told\non many sites" and got[200].text == "" and got[300].text == "a story told\nx"


def test_a_copied_page_loses_its_boilerplate(spark, frame):
    pages = [(i, f"{NAV[0]}\nown {i}", f"s{i}") for i in range(12)]
    copies = [(100 + i, f"{NAV[0]}\na story\ntold", f"c{i}") for i in range(30)]
    got = {r.doc_id: r for r in line_dedup.line_dedup(frame([*pages, *copies])).collect()}
    assert all((got[100 + i].n_removed, got[100 + i].clean_text) == (1, "a story\ntold") for i in range(30))


def test_a_text_of_very_many_lines(spark, frame):
    rows = [(i, "\n".join(["menu"] * 20_000 + [f"own {i}"] + [f"line {i} {k}" for k in range(180_000)] if i == 0 else ["menu", f"own {i}"]), f"s{i}") for i in range(11)]
    r = line_dedup.line_dedup(frame(rows)).where("doc_id = 0").first()
    assert (r.n_lines, r.n_removed) == (200_001, 20_000) and r.clean_text.startswith("own 0\nline 0 0\n")
