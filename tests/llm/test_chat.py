"""Chat windows against a plain version that walks turn by turn."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tradewind.llm import chat, token_counts
from tradewind.llm.queries import op11_chat_format, vocabulary_path

SCHEMA = "conv_id bigint, turn bigint, role string, text string, loss string, formatted int"
PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", chat.START, chat.SEP, chat.END, "\\", "<", "[", "|", ">", "a\nb", "é", "日本 "]


@pytest.fixture(scope="module")
def pieces():
    return token_counts.byte_vocabulary(vocabulary_path())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["the", "word", "Übung", "x" * 40, "[INST]", "</s>"]) for _ in range(n))
    out = []
    for c in range(12):
        if c % 3 == 0:
            out.append((c, 0, "system", text(8)))
        out += [(c, t, "assistant" if t % 2 else "user", text(rng.choice([1, 5, 20, 60]))) for t in range(1, rng.randint(2, 25))]
    out += [(20, t, "user" if t % 2 else "assistant", text(10)) for t in range(300)]
    out += [(21, 0, "system", text(400)), (21, 1, "user", text(3)), (21, 2, "assistant", text(900)), (21, 3, "assistant", text(3))]
    out += [(22, 1, "assistant", None), (22, None, None, "no turn or role"), (22, 2, "system", "late"), (22, 2, "assistant", "tie")]
    out += [(None, 5, "user", "no id"), (None, 4, "assistant", ""), (23, 1, "assistant", " " * 5000), (23, 2, "user", "".join(PIECES))]
    out += [(24, 1, "assistant", "twice")] * 2 + [(25, 1, "assistant", text(6000).replace("word", "\n"))]
    return out


def plain(rows, costs, budget, history, section):
    """Windows as chat_windows states them, without prefix sums."""
    found = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = [(r[2] or "", r[3] or "") for r in turns]
        cost = [costs[t[1]] for t in turns]
        before = [sum(cost[:i]) for i in range(len(turns))]
        at = 0
        while at < len(turns):
            head = [0] if turns[0][0] == "system" and at > 0 else []
            spent = sum(cost[i] for i in head)
            allowed = min(history, budget - spent - cost[at])
            past = []
            i = at - 1
            while i >= len(head) and sum(cost[j] for j in past) + cost[i] <= allowed:
                past.insert(0, i)
                i -= 1
            new = [at]
            spent += sum(cost[j] for j in past) + cost[at]
            while (n := new[-1] + 1) < len(turns) and before[n] // section == before[at] // section and spent + cost[n] <= budget:
                new.append(n)
                spent += cost[n]
            found[conv, at] = (len(new), len(head) + len(past), spent, [turns[j] for j in head + past + new])
            at = new[-1] + 1
    return found


@pytest.mark.parametrize(("long", "sizes"), [(1 << 40, (90, 30, 400)), (0, (90, 30, 400)), (2000, (60, 60, 60)), (0, (1024, 256, 65536))])
def test_windows_equal_plain(spark, rows, pieces, long, sizes):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(5)
    counted = token_counts._Counts(token_counts.compile_automaton(*pieces))
    cost = lambda t: max(sum(counted[w] for w in t.encode().split()), len(t.encode()) // chat.BYTES_PER_TOKEN) + chat.MARKS
    want = plain(rows, {r[3] or "": cost(r[3] or "") for r in rows}, *sizes)
    got = chat.chat_windows(df, *pieces, *sizes, long=long).collect()
    assert {(r.conv_id, r.first_turn): (r.n_turns, r.n_repeated, r.n_tokens, chat.parse(r.formatted)) for r in got} == want
    assert len(got) == len(want)
    for r in got:
        learnt = [t for role, t in chat.parse(r.formatted)[r.n_repeated :] if role == "assistant"]
        assert [chat.unescape(r.formatted[x.start : x.end]) for x in r.loss] == learnt


@pytest.mark.parametrize("long", [1 << 40, 0])
def test_read_back(spark, rows, pieces, long):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(5)
    got = {r.conv_id: r for r in chat.read_back(df, *pieces, 90, 30, 400, long).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        turns = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        learnt = "".join(x[3] or "" for x in turns if x[2] == "assistant")
        said = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in turns)
        assert (r.n_turns, r.loss_chars) == (len(turns), len(learnt))
        assert (r.turns_sha256, r.loss_sha256) == tuple(hashlib.sha256(x.encode()).hexdigest() for x in (said, learnt))
        assert r.formatted_chars >= len(said) - 2 * len(turns)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*PIECES, "s>", "INST]", "|x|>", "SYS>>"]), max_size=12).map("".join))
def test_escapes_are_reversible(text):
    safe = chat.escape(text)
    assert chat.unescape(safe) == text
    assert not any(c in safe for c in PIECES[:9])
    assert chat.parse(f"{chat.START}{safe}{chat.SEP}{safe}{chat.END}") == [(text, text)]


def test_empty_and_given_tables(spark, pieces):
    none = spark.createDataFrame([], SCHEMA)
    assert chat.chat_windows(none, *pieces).count() == 0
    assert chat.read_back(none, *pieces).count() == 0
    sf = "/root/testdata/sf0.001"
    got = op11_chat_format(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id").distinct().count() + 1
    mine = next(r for r in got if r.conv_id == -7)
    assert mine.loss_sha256 == hashlib.sha256(b"</s>[INST] ok [/INST]").hexdigest()
