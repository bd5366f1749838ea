"""Line numbers of license blocks, also in a text of very many lines."""

from tradewind.llm import license_scan


def test_lines_of_blocks(frame):
    notice = dict(license_scan.TEMPLATES)["mit-notice"]
    rows = [(1, f"a\n\n{notice}\nb", "s"), (2, notice, "s"), (3, "\n".join([notice, "plain"] * 20_000), "s")]
    got = {r.doc_id: [x.line for x in r.blocks if x.label == "mit-notice"] for r in license_scan.license_scan(frame(rows)).collect()}
    assert got[1] == [2] and got[2] == [0] and sorted(set(got[3])) == list(range(0, 40_000, 2))
