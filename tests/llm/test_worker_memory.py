"""What Python workers hold once a task has ended."""

import random

import public_tokenizers
import pyarrow as pa

from tradewind.llm import bpe
from tradewind.llm import textvec as tv


def test_workers_keep_nothing_of_the_texts(spark, frame):
    path, rng = public_tokenizers.path("byte_bpe_50k.json"), random.Random(3)
    docs = frame([(i, " ".join(f"{rng.randrange(10**9):x}" for _ in range(50)), "s") for i in range(300)])
    assert bpe.bpe(docs, path).where("n_tokens > 0").count() == 300
    with open(path, encoding="utf-8") as f:
        model = f.read()

    def held(batches):
        for _ in batches:
            v = bpe.compiled(model)
            yield pa.RecordBatch.from_arrays([pa.array([len(v.known) + len(v.automaton.arcs)])], ["n"])

    assert {r.n for r in spark.range(0, 40, 1, 4).mapInArrow(held, "n long").collect()} == {0}


def test_encodings_are_bounded_and_stay_right():
    letters = {v: k for k, v in bpe.byte_letters().items()}
    ids = {letters[b]: b for b in range(256)} | {"ab": 256, "abc": 257, "ca": 258}
    v = bpe.Vocabulary({"model": {"vocab": ids, "merges": ["a b", "ab c", "c a"]}})
    v.known.most = v.automaton.most_arcs = 20
    plain = bpe.Vocabulary({"model": {"vocab": ids, "merges": ["a b", "ab c", "c a"]}})
    rng, most = random.Random(1), 0
    for _ in range(2000):
        text = " ".join("".join(rng.choice("abcd") for _ in range(rng.randint(1, 6))) for _ in range(5)) + " abc"
        assert v.encode(text) == plain.encode(text) and v.decode(v.encode(text)) == text
        most = max(most, len(v.known) + len(v.known.older), len(v.automaton.arcs) + len(v.automaton.older_arcs))
    # The word that comes in each text is still held, though the many others have filled the store again and again.
    assert 20 < most <= 40 and (" abc" in v.known or " abc" in v.known.older)
    v.forget()
    assert not v.known and not v.known.older and not v.automaton.arcs and not v.automaton.older_arcs


def test_lean_passes_every_batch_on():
    batches = [pa.RecordBatch.from_arrays([pa.array([i])], ["x"]) for i in range(3)]
    assert list(tv.lean(lambda found: (b for b in found))(iter(batches))) == batches and list(tv.lean(iter)(iter([]))) == []
