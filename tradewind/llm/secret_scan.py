"""Secret scans with multipart credential linking.

Strong secrets (assignments, access keys, long hex) are reported wherever they stand. Weak parts - identifiers,
opaque strings and endpoints - are reported only when a complementary part starts within the same scope: an interval
join over each document's parts, as window frames over the start positions, so no pairs are made.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.llm import textvec as tv
from tradewind.llm.shared import save, texts

SCOPE = 200

#: The base patterns (hex as runs of at least 24, which is the same).
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: The method's weak parts.
ENDPOINT = re.compile(r"[a-z][a-z0-9+]{1,15}://[A-Za-z0-9._~:@/?#%&=+-]{4,}")
IDENTIFIER = re.compile(r"""(?i:client|access|account|user)(?i:[_-]?(?:id|key|name))["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}""", re.ASCII)
OPAQUE = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
KINDS = ["assign", "access", "hex", "endpoint", "identifier", "opaque"]
#: What each kind stands for in a credential.
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "endpoint": "endpoint", "identifier": "identifier", "opaque": "secret"}


#: What a text must have for each pattern to match at all: found on the bytes of a whole run at once.
_COLON, _HEX, _OPAQUE = (np.zeros(256, bool) for _ in range(3))
_COLON[[58, 61]] = True
_HEX[48:58] = _HEX[97:103] = True
_OPAQUE[48:58] = _OPAQUE[65:91] = _OPAQUE[97:123] = _OPAQUE[[43, 45, 47, 95]] = True
_ASSIGNED = ("password", "passwd", "secret", "token", "api_key", "apikey")
_NAMED = ("client", "access", "account", "user")


def _with_run(run: tv.Run, mask: np.ndarray, least: int) -> np.ndarray:
    """Which documents have ``least`` bytes of the mask in a row."""
    inside = np.flatnonzero(mask[run.data])
    if not len(inside):
        return np.zeros(run.n, bool)
    doc = np.searchsorted(run.offsets[1:], inside, side="right")
    edge = np.flatnonzero((np.diff(inside, prepend=-2) > 1) | (np.diff(doc, prepend=-1) > 0))
    long = np.diff(np.append(edge, len(inside))) >= least
    out = np.zeros(run.n, bool)
    out[doc[edge[long]]] = True
    return out


def possible(run: tv.Run) -> np.ndarray:
    """Columns: an assignment or name (a colon or equals sign), a hex run, an opaque run."""
    return np.stack([_with_run(run, _COLON, 1), _with_run(run, _HEX, 24), _with_run(run, _OPAQUE, 32)], axis=1)


def parts(text: str, assigned: bool = True, hexed: bool = True, opaque: bool = True) -> list[tuple[int, int, int]]:
    """(start, end, index in KINDS) of all strong and weak parts, in code points, ordered.

    The flags tell which patterns the text can match at all."""
    found, weak = [], []
    if assigned:
        low = text.lower()
        if any(w in low for w in _ASSIGNED):
            found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        if any(w in low for w in _NAMED):
            weak += [(m.start(), m.end(), 4) for m in IDENTIFIER.finditer(text)]
        if "://" in text:
            weak += [(m.start(), m.end(), 3) for m in ENDPOINT.finditer(text)]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if hexed:
        found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    if opaque:
        weak += [
            (m.start(), m.end(), 5)
            for m in OPAQUE.finditer(text) if re.search("[0-9]", m[0]) and re.search("[A-Z]", m[0]) and re.search("[a-z]", m[0])
        ]
    strong, at = sorted(found), 0
    reach = np.maximum.accumulate([e for _, e, _ in strong]).tolist() if strong else []
    for s, e, k in sorted(weak):
        while at < len(strong) and reach[at] <= s:
            at += 1
        # A weak part that overlaps a strong one adds nothing.
        if at == len(strong) or strong[at][0] >= e:
            found.append((s, e, k))
    return sorted(found, key=lambda x: (x[0], x[2], x[1]))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_spans, spans, n_linked, found.

    base_spans: strong parts as kind:start:end (code points, end exclusive), by start and then kind, comma-joined.
    spans: those and the weak parts linked with a complementary part: an opaque string with an identifier or endpoint,
    an identifier with a secret, an endpoint with a secret, starting at most ``scope`` code points apart. found: the
    same as an array of (kind, start, end). n_linked: weak parts reported.
    Null or empty text: zeros and empty strings. Null id: kept as null. Repeated rows: one result each. Empty input:
    empty result.
    A very long text is read whole. Other columns, also those named like results, are not read.
    """
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, parts array<struct<start:long,end:long,kind:int>>"
    part = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for run in tv.runs(column):
                rows = []
                for text, (assigned, hexed, opaque) in zip(column.slice(run.first, run.n).to_pylist(), possible(run).tolist(), strict=True):
                    found = parts(text, assigned, hexed, opaque)
                    strong = [x for x in found if x[2] < 3]
                    counts = [sum(k == i for *_, k in strong) for i in range(3)]
                    # Without a weak part there is nothing to link.
                    keep = found if len(found) > len(strong) else []
                    rows.append((*counts, joined(strong), [{"start": s, "end": e, "kind": k} for s, e, k in keep]))
                cols = zip(*rows, strict=True)
                kinds = [pa.int64()] * 3 + [pa.string(), part]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(run.first, run.n), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "parts"],
                )

    # Stored once: what follows reads spans, never the texts again.
    scanned = save(texts(docs, id_col, text_col).select("doc_id", "text").mapInArrow(scan, schema), "secrets")
    plain = scanned.where("size(parts) = 0").select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        "base_spans",
        F.col("base_spans").alias("spans"),
        F.lit(0).cast("long").alias("n_linked"),
    )
    # The interval join: within a document, frames of ``scope`` around each start say which roles are near.
    mixed = scanned.where("size(parts) > 0").withColumn("row", F.monotonically_increasing_id())
    rows = mixed.select("row", "doc_id", "n_assign", "n_access", "n_hex", "base_spans", F.inline("parts"))
    role = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (i, ROLE[k])]), F.col("kind"))
    near = Window.partitionBy("row").orderBy("start").rangeBetween(-scope, scope)
    rows = rows.withColumn("role", role)
    for r in ("secret", "identifier", "endpoint"):
        rows = rows.withColumn(r, F.max((F.col("role") == r).cast("int")).over(near))
    linked = F.when(F.col("kind") == 5, (F.col("identifier") == 1) | (F.col("endpoint") == 1)).otherwise(F.col("secret") == 1)
    rows = rows.where((F.col("kind") < 3) | linked)
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    span = F.struct("start", "kind", "end", F.concat_ws(":", name, "start", "end").alias("span"))
    grouped = rows.groupBy("row").agg(
        F.sort_array(F.collect_list(span)).alias("all"),
        F.sum((F.col("kind") > 2).cast("long")).alias("n_linked"),
    )
    back = (
        mixed.drop("parts")
        .join(grouped, "row", "left")
        .select(
            "doc_id",
            "n_assign",
            "n_access",
            "n_hex",
            "base_spans",
            F.coalesce(F.array_join(F.col("all.span"), ","), F.col("base_spans")).alias("spans"),
            F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        )
    )
    out = plain.unionByName(back)
    return out.withColumn(
        "found",
        F.transform(
            F.filter(F.split("spans", ","), lambda x: x != ""),
            lambda x: F.struct(
                F.split(x, ":")[0].alias("kind"),
                F.split(x, ":")[1].cast("long").alias("start"),
                F.split(x, ":")[2].cast("long").alias("end"),
            ),
        ),
    )


def digest(spans: str) -> str:
    """What the query reports for base_spans."""
    return hashlib.sha256(spans.encode()).hexdigest()
