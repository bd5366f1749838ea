"""Chat formatting in windows of a token budget.

A conversation becomes windows of whole turns. Prefix sums of the turns' token counts choose each window's span: the
system turn, a limited stretch of the turns before (history, seen again but not learnt again), then as many new turns
as the budget allows. The loss mask covers the texts of new assistant turns, so each is learnt once.

A new window also begins wherever the tokens so far pass a multiple of ``SECTION``. So sections need nothing of each
other but the system turn and the history, and a conversation that is too long for one task is cut into them by prefix
sums over ranges; the windows are the same either way.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.functions.ranks import numbered
from tradewind.llm import textvec as tv
from tradewind.llm.shared import save
from tradewind.llm.token_counts import _Counts, ship

BUDGET, HISTORY = 1024, 256
SECTION = 64 * BUDGET
#: Tokens of the three marks and the role of a turn; and bytes that count as a token at least, as white space has no pieces.
MARKS, BYTES_PER_TOKEN = 4, 16
#: Conversations beyond so many bytes, or beyond the MOST_LONG-th part of all, are cut into sections. At most MOST_LONG exist.
LONG, MOST_LONG = 64 << 20, 1_000_000
BLOCK = 1 << 16

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Control strings of the template and of other common chat formats. Inside texts each has a backslash
#: after its first character; one that has backslashes there already gets one more.
CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\]|</?SYS>>|\|[A-Za-z0-9_]+\|>)")
ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\]|</?SYS>>|\|[A-Za-z0-9_]+\|>)")

_TURN = "conv_id long, place long, kind int, section long, role string, text string, cost long"
_WINDOW = "conv_id long, first_turn long, n_turns long, n_repeated long, n_tokens long, formatted string, loss array<struct<start:long,end:long>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_WINDOW_TYPES = [pa.int64()] * 5 + [pa.string(), _SPANS]
_WINDOW_NAMES = ["conv_id", "first_turn", "n_turns", "n_repeated", "n_tokens", "formatted", "loss"]


def escape(text: str) -> str:
    return CONTROL.sub(r"\1\\\2\3", text) if "<" in text or "[" in text else text


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text) if "\\" in text else text


@dataclass
class Turn:
    role: str
    text: str
    cost: int


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a window."""
    found = []
    for part in formatted.split(START)[1:]:
        role, text = part.split(SEP)
        found.append((unescape(role), unescape(text.removesuffix(END))))
    return found


def spans(costs: np.ndarray, first: int, system: int, budget: int, history: int) -> Iterator[tuple[int, int, int]]:
    """(from, new, end) of each window over ``costs``: turns from..new are history, new..end are new. New turns begin
    at ``first``; ``system``: the cost of a system turn that every window also has, or -1 where turn 0 is that turn."""
    sums = np.concatenate(([0], np.cumsum(costs)))
    lowest, new = 0, first
    while new < len(costs):
        if system < 0 < new:
            lowest, room = 1, budget - int(costs[0])
        else:
            room = budget - max(system, 0)
        allowed = min(history, room - int(costs[new]))
        begin = max(int(np.searchsorted(sums, sums[new] - allowed)), lowest) if allowed > 0 else new
        end = max(int(np.searchsorted(sums, sums[begin] + room, side="right")) - 1, new + 1)
        yield begin, new, end
        new = end


@dataclass
class Section:
    """Turns of one section of a conversation: the system turn if it stands before, history, new turns."""

    key: tuple
    place: int = 0
    system: Turn | None = None
    past: list[Turn] = field(default_factory=list)
    new: list[Turn] = field(default_factory=list)

    def windows(self, budget: int, history: int) -> Iterator[tuple]:
        turns = self.past + self.new
        costs = np.array([t.cost for t in turns], np.int64)
        leads = self.place == 0 and turns[0].role == "system"
        system = -1 if leads else self.system.cost if self.system else 0
        for begin, new, end in spans(costs, len(self.past), system, budget, history):
            head = [turns[0]] if leads and new > 0 else [self.system] if self.system else []
            parts, loss, at = [], [], 0
            for i, turn in enumerate(head + turns[begin:end], begin - len(head)):
                role, text = escape(turn.role), escape(turn.text)
                start = at + len(START) + len(role) + len(SEP)
                at = start + len(text) + len(END)
                parts += [START, role, SEP, text, END]
                if i >= new and turn.role == "assistant":
                    loss.append({"start": start, "end": start + len(text)})
            cost = int(costs[begin:end].sum()) + sum(t.cost for t in head)
            yield (self.key[0], self.place + new - len(self.past), end - new, new - begin + len(head), cost, "".join(parts), loss)

    def next(self, history: int) -> Section:
        """The section that follows in the same conversation."""
        lead = self.new[0] if self.place == 0 and self.new and self.new[0].role == "system" else None
        turns = self.past + (self.new[1:] if lead else self.new)
        keep, cost = len(turns), 0
        while keep and cost + turns[keep - 1].cost <= history:
            keep -= 1
            cost += turns[keep].cost
        return Section(self.key, self.place + len(self.new), lead or self.system, turns[keep:])


def _costs(column: pa.Array, known: _Counts) -> np.ndarray:
    """Tokens of each turn: pieces of its words by longest match, but one per BYTES_PER_TOKEN bytes at least; and marks."""
    found = []
    for run in tv.runs(column):
        w, raw = tv.words(run, tv.PLAIN), run.data.tobytes()
        keys, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
        each = np.fromiter((known[raw[s:e]] for s, e in zip(w.start[first].tolist(), w.end[first].tolist(), strict=True)), np.int64, len(keys))
        pieces = tv.per_doc(w.doc, run.n, each[back]) if len(keys) else np.zeros(run.n, np.int64)
        found.append(np.maximum(pieces, np.diff(run.offsets) // BYTES_PER_TOKEN) + MARKS)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _formatter(budget: int, history: int, section: int, counter: Callable[[], _Counts]) -> Callable:
    """Turns in order, those of a section together, to windows. A turn's section is given or follows from its costs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, now, spent = None, None, 0
        out: list[tuple] = []
        chars = 0

        def sent() -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _WINDOW_TYPES, strict=True)], _WINDOW_NAMES)

        for batch in batches:
            given = batch.column("section").null_count < len(batch)
            if given:
                costs = batch.column("cost").to_pylist()
            else:
                known = known or counter()
                costs = _costs(batch.column("text"), known).tolist()
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "section", "kind", "place", "role", "text")]
            for conv, part, kind, place, role, text, cost in zip(*columns, costs, strict=True):
                key = (conv, part)
                if now is None or now.key != key:
                    done, now, spent = now, Section(key), 0
                elif not given and spent // section != (spent - last) // section:
                    done, now = now, now.next(history)
                else:
                    done = None
                if done and done.new:
                    for window in done.windows(budget, history):
                        out.append(window)
                        chars += len(window[5])
                        if chars > tv.CHUNK:
                            yield sent()
                            out, chars = [], 0
                turn = Turn(role, text, cost)
                if kind == 0:
                    now.system = turn
                elif kind == 1:
                    now.past.append(turn)
                else:
                    if given and not now.new:
                        now.place = place
                        now.past = Section(key, 1, None, now.past).next(history).past
                    now.new.append(turn)
                    last, spent = cost, spent + cost
        if now and now.new:
            out += now.windows(budget, history)
        if out:
            yield sent()

    return run


@dataclass
class Windows:
    """Windows of ordinary conversations (those of one stand together, in order) and of long ones (anywhere)."""

    ordinary: DataFrame
    long: DataFrame | None


def _windows(turns: DataFrame, start: list[bytes], inner: list[bytes], budget: int, history: int, section: int, long: int, id_col: str, order_col: str, role_col: str, text_col: str) -> Windows:
    if not 0 <= history <= section or budget < 1:
        raise ValueError("history must be from 0 to the section's size, the budget positive")
    shipped = ship(turns.sparkSession, start, inner)
    make = _formatter(budget, history, section, lambda: _Counts(shipped.value))
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((role_col, "role"), (text_col, "text"))]
    rows = turns.select(F.col(id_col).cast("long").alias("conv_id"), F.col(order_col).alias("turn"), *text)
    order = ["conv_id", "turn", "role", "text"]

    # Few conversations can be long: at most MOST_LONG have more than that part of all bytes.
    sizes = rows.groupBy("conv_id").agg(F.sum(F.octet_length("text") + F.octet_length("role") + 64).alias("bytes"))
    sizes = save(sizes, "chat-sizes")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    far = sizes.where(F.col("bytes") > max(long, total // MOST_LONG)).select(F.col("conv_id").alias("far"), F.lit(True).alias("is_far"))
    some = not far.isEmpty()
    if some:
        far = F.broadcast(save(far, "chat-long-ids"))
        is_far = rows["conv_id"].eqNullSafe(far["far"])
    none = {c: F.lit(None).cast(t) for c, t in (("place", "long"), ("section", "long"), ("cost", "long"))}
    plain = (rows.join(far, is_far, "left_anti") if some else rows).repartition("conv_id").sortWithinPartitions(*order)
    plain = plain.withColumns(none | {"kind": F.lit(2)}).select([c.split()[0] for c in _TURN.split(", ")])
    ordinary = plain.mapInArrow(make, _WINDOW)
    if not some:
        return Windows(ordinary, None)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Counts(shipped.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_costs(batch.column("text"), known))], [*batch.schema.names, "cost"])

    counted = rows.join(far, is_far, "left_semi")
    counted = save(counted.mapInArrow(count, f"conv_id long, turn {dict(rows.dtypes)['turn']}, role string, text string, cost long"), "chat-long")
    at = save(numbered(counted, order, "at", start=0), "chat-long-placed").withColumn("block", F.floor(F.col("at") / BLOCK))
    # Prefix sums: within blocks of rows, then over blocks.
    blocks = at.groupBy("conv_id", "block").agg(F.sum("cost").alias("sum"), F.min("at").alias("from"))
    upto = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumns({"before": F.coalesce(F.sum("sum").over(upto), F.lit(0)), "zero": F.min("from").over(Window.partitionBy("conv_id"))})
    blocks = blocks.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "before", "zero")
    placed = at.join(blocks, at["conv_id"].eqNullSafe(F.col("c")) & (at["block"] == F.col("b")))
    inside = Window.partitionBy("conv_id", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    spent = F.col("before") + F.coalesce(F.sum("cost").over(inside), F.lit(0))
    placed = placed.select("conv_id", (F.col("at") - F.col("zero")).alias("place"), "role", "text", "cost", spent.alias("spent"))
    placed = save(placed.withColumn("section", F.floor(F.col("spent") / section)), "chat-long-turns")
    fresh = placed.withColumn("kind", F.lit(2))
    # History comes from the section before, as it is no longer than a section.
    past = placed.where(F.col("spent") >= (F.col("section") + 1) * section - history).where((F.col("place") > 0) | (F.col("role") != "system"))
    past = past.withColumns({"section": F.col("section") + 1, "kind": F.lit(1)})
    lead = placed.where((F.col("place") == 0) & (F.col("role") == "system")).drop("section")
    later = placed.where("section > 0").select(F.col("conv_id").alias("c"), "section").distinct()
    lead = lead.join(later, lead["conv_id"].eqNullSafe(F.col("c"))).drop("c").withColumn("kind", F.lit(0))
    columns = [c.split()[0] for c in _TURN.split(", ")]
    dealt = fresh.select(columns).unionByName(past.select(columns)).unionByName(lead.select(columns))
    dealt = dealt.repartition("conv_id", "section").sortWithinPartitions("conv_id", "section", "kind", "place")
    return Windows(ordinary, dealt.mapInArrow(make, _WINDOW))


def chat_windows(
    turns: DataFrame,
    start: list[bytes],
    inner: list[bytes],
    budget: int = BUDGET,
    history: int = HISTORY,
    section: int = SECTION,
    long: int = LONG,
    id_col: str = "conv_id",
    order_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per window: conv_id, first_turn, n_turns, n_repeated, n_tokens, formatted, loss.

    first_turn: place of the first new turn, from 0; n_turns: new turns; n_repeated: turns before them in the window (the
    system turn, history); formatted: each turn as start mark, role, mark, text, end mark, control strings in role and
    text escaped; loss: (start, end) in code points of new assistant texts. A new turn that does not fit alone has a
    window of its own, whole. ``start`` and ``inner``: the pieces that turns are counted by.

    Turns go by ``order_col`` (null first), equal ones by role and text; repeated rows are turns of their own. Null role
    or text: empty. Null id: a conversation like any other. Very long texts: never cut. Empty table: empty result. Other
    columns are not read.
    """
    found = _windows(turns, start, inner, budget, history, section, long, id_col, order_col, role_col, text_col)
    return found.ordinary if found.long is None else found.ordinary.unionByName(found.long)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows in order to one row per conversation; digests run along, nothing else is kept."""
    rows: list[tuple] = []
    now = None

    def closed() -> tuple:
        return (now[0], now[1], now[2], now[3].hexdigest(), now[4], now[5].hexdigest(), now[6])

    def sent() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _READ_TYPES, strict=True)], _READ_NAMES)

    for batch in batches:
        for conv, repeated, formatted, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "n_repeated", "formatted", "loss")), strict=True):
            if now is None or now[0] != conv:
                if now:
                    rows.append(closed())
                    if len(rows) >= 10_000:
                        yield sent()
                        rows = []
                now = [conv, 0, 0, sha256(), 0, sha256(), 0]
            now[1] += 1
            for role, text in parse(formatted)[repeated:]:
                now[2] += 1
                now[3].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            for span in loss:
                learnt = unescape(formatted[span["start"] : span["end"]])
                now[4] += len(learnt)
                now[5].update(learnt.encode("utf-8", "surrogatepass"))
            now[6] += len(formatted)
    if now:
        rows.append(closed())
    if rows:
        yield sent()


_READ = "conv_id long, n_windows long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_READ_NAMES = [c.split()[0] for c in _READ.split(", ")]
_READ_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]


def read_back(turns: DataFrame, start: list[bytes], inner: list[bytes], budget: int = BUDGET, history: int = HISTORY, section: int = SECTION, long: int = LONG) -> DataFrame:
    """One row per conversation, read from its windows: conv_id, n_windows, n_turns, turns_sha256 (role, line feed, text,
    line feed of each turn), loss_chars, loss_sha256 (all text under the loss mask, unescaped), formatted_chars.

    A digest is taken in order. Ordinary conversations are read where they were formatted, without another shuffle; the
    windows of a long one pass through one task, a window at a time. Rows as ``chat_windows`` states.
    """
    found = _windows(turns, start, inner, budget, history, section, long, "conv_id", "turn", "role", "text")
    out = found.ordinary.mapInArrow(_read, _READ)
    if found.long is None:
        return out
    return out.unionByName(found.long.repartition("conv_id").sortWithinPartitions("conv_id", "first_turn").mapInArrow(_read, _READ))
