"""Near-duplicate documents by MinHash with tensored banding.

Two collections of ``m`` small hashes are computed per document, each of ``k`` minhashes; the key of table (i, j) joins
hash i of the first with hash j of the second. So m * m tables of 2k minhashes each cost 2mk minhashes instead of
2mk * m. Two documents meet in a table only if they share both hashes, so hashes that one document alone has are left
out before keys are formed. Documents that meet in a table are candidates; full shingle sets confirm them.

No group is expanded into all its pairs. Documents with equal sets are one class, known by a number of its own. Buckets
of up to ``SMALL_BUCKET`` classes give their pairs; in larger ones every class is compared with the smallest. Where such
a bucket then still holds several components, the remaining links among its members come from an exact prefix join:
shingles ordered by frequency, the rarest of each set as prefix, so that common shingles of a large group never meet.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm import textvec as tv
from tradewind.llm.shared import discard, save, texts

SHINGLE, PERCENT, K, MISS, SEED, SMALL_BUCKET, COARSE, PARITIES, ORDER = 5, 80, 3, 1e-4, 11, 16, 1 << 20, 1024, 1 << 18


def collection_size(percent: int, k: int = K, miss: float = MISS) -> int:
    """Hashes a collection needs so that a pair at the threshold meets in no table with probability ``miss`` at most:
    11 at 85 percent, 14 at 80."""
    return math.ceil(math.log(miss / 2) / math.log(1 - (percent / 100) ** k)) if percent < 100 else 1


def _hashes(m: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 63, 2 * m * k, dtype=np.uint64) * tv.U(2) + tv.U(1), rng.integers(0, 1 << 63, 2 * m * k, dtype=np.uint64)


def _sets(run: tv.Run, size: int) -> list[np.ndarray]:
    """Each document's distinct shingle hashes, sorted."""
    doc, found = tv.shingles(tv.words(run, tv.LOWER), size, run.n)
    at = np.searchsorted(doc, np.arange(run.n + 1))
    return [np.unique(found[at[i] : at[i + 1]]) for i in range(run.n)]


def _parities(sets: list[np.ndarray]) -> np.ndarray:
    """A row of bits for each set, as 64-bit words."""
    place = (np.concatenate(sets) >> tv.U(17)) % tv.U(PARITIES)
    at = np.repeat(np.arange(len(sets)), [len(s) for s in sets]) * PARITIES + place.astype(np.int64)
    odd = np.bincount(at, minlength=len(sets) * PARITIES).reshape(len(sets), PARITIES) % 2
    return np.packbits(odd.astype(bool), axis=1).view(tv.U)


def _may(n_a: Column, n_b: Column, differ: Column, percent: int) -> Column:
    """Whether sets of these sizes that differ in at least so many shingles can reach the threshold."""
    both = n_a + n_b
    return ((both - differ) * (100 + percent) >= 2 * percent * both) & (F.least(n_a, n_b) * 100 >= percent * F.greatest(n_a, n_b))


def possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and parities do not rule out: sets differ wherever their parities do. A row of bits is
    a small part of a set, so few pairs are left whose sets have to meet."""
    side = lambda x: classes.select(F.col("class").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    each = F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(each, F.lit(0), lambda total, x: total + x)
    return pairs.join(side("b"), "b").join(side("a"), "a").where(_may(F.col("n_a"), F.col("n_b"), differ, percent)).select("a", "b")


def signatures(docs: DataFrame, size: int, m: int, k: int) -> DataFrame:
    """doc_id, text_key, n_shingles, a 128-bit digest of the set (d1, d2), the 2m small hashes (``halves``), and whether
    the set has an odd number of shingles in each of ``PARITIES`` hash classes (``bits``)."""
    a, b = _hashes(m, k)
    schema = "doc_id long, text_key long, n_shingles long, d1 long, d2 long, halves array<long>, bits array<long>"

    @tv.lean
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in tv.runs(batch.column("text")):
                sets = _sets(run, size)
                n = np.array([len(s) for s in sets])
                digest, halves = np.zeros((2, run.n), tv.U), np.zeros((run.n, 2 * m), tv.U)
                bits = np.concatenate([_parities(sets[i : i + 1000]) for i in range(0, run.n, 1000)])
                full = np.flatnonzero(n)
                if len(full):
                    every, starts = np.concatenate(sets), np.concatenate(([0], np.cumsum(n)))[full]
                    for t, salt in enumerate((0x51ED270B9F3A7C11, 0x2545F4914F6CDD1D)):
                        digest[t, full] = tv.mix(np.add.reduceat(tv.mix(every ^ tv.U(salt)), starts))
                    for h in range(2 * m):
                        key = np.full(len(full), h, tv.U)
                        for x in range(h * k, h * k + k):
                            key = tv.pair(key, np.minimum.reduceat(every * a[x] + b[x], starts))
                        halves[full, h] = key
                lists = [pa.ListArray.from_arrays(np.arange(run.n + 1) * x.shape[1], x.ravel().view(np.int64)) for x in (halves, bits)]
                own = [batch.column(c).slice(run.first, run.n) for c in ("doc_id", "text_key")]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(n), *(pa.array(d.view(np.int64)) for d in digest), *lists],
                    ["doc_id", "text_key", "n_shingles", "d1", "d2", "halves", "bits"],
                )

    return docs.select("doc_id", "text_key", "text").mapInArrow(sign, schema)


def _shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """class and its sorted shingle hashes as bytes, from (class, text)."""

    @tv.lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in tv.runs(batch.column("text")):
                found = pa.array([s.tobytes() for s in _sets(run, size)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("class").slice(run.first, run.n), found], ["class", "shingles"])

    return docs.select("class", "text").mapInArrow(cut, "class long, shingles binary")


def _of(docs: DataFrame, classes: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Shingle sets of the classes in ``wanted`` (class), each from the text of its first document.

    Most texts are not wanted, and texts are what is large: before they are dealt out for the join, a coarse filter
    drops those whose id falls into none of ``COARSE`` hash groups that a wanted id is in. It has at most that many
    rows whatever the input, so it can be broadcast, and only ever lets too many through.
    """
    first = classes.join(wanted.distinct(), "class", "left_semi").select("class", "first.doc_id", "first.text_key")
    group = F.pmod(F.xxhash64("doc_id"), F.lit(COARSE))
    groups = F.broadcast(first.select(group.alias("__group")).distinct())
    some = docs.withColumn("__group", group).join(groups, "__group", "left_semi").drop("__group")
    # A repeated row is read once.
    return _shingle_sets(some.join(first, ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"]), size)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, with a > b) whose full sets have 100 * intersection >= percent * union."""

    @tv.lean
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("sa"), batch.column("sb"), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (left, right))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda x: sets.select(F.col("class").alias(x), F.col("shingles").alias(f"s{x}"))
    joined = pairs.join(side("b"), "b").join(side("a"), "a")
    return joined.select("a", "b", "sa", "sb").mapInArrow(confirm, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of the links (a, b): the smallest node reachable.

    In each round every node points to its smallest smaller neighbour, pointers are followed to the end of their tree
    by doubling, and the links that are left between different trees are those of a smaller graph. Only whether rows
    are left comes to the driver.
    """
    plain = lambda a, b: [F.greatest(a, b).alias("a"), F.least(a, b).alias("b")]
    links = save(links.where("a <> b").select(*plain("a", "b")).distinct(), "links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    found = save(nodes.select("node", F.col("node").alias("component")), "components")
    while not links.isEmpty():
        tree = save(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")), "trees")
        moved = True
        while moved:
            up = tree.select(F.col("node").alias("label"), F.col("label").alias("next"))
            step = save(
                tree.join(up, "label", "left").select(
                    "node",
                    F.coalesce("next", "label").alias("label"),
                    F.col("next").isNotNull().alias("moved"),
                ),
                "trees",
            )
            moved = not step.where("moved").isEmpty()
            discard(tree)
            tree, path = step.select("node", "label"), step.work_path
            tree.work_path = path
        top = lambda x: tree.select(F.col("node").alias(x), F.col("label").alias(f"of_{x}"))
        merged = save(
            found.join(top("component"), "component", "left").select("node", F.coalesce("of_component", "component").alias("component")),
            "components",
        )
        ends = (
            links.join(top("a"), "a", "left")
            .join(top("b"), "b", "left")
            .select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
        )
        rest = save(ends.where("a <> b").select(*plain("a", "b")).distinct(), "links")
        discard(found, links, tree)
        found, links = merged, rest
    discard(links)
    return found


def _rest(sets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs among ``sets`` (class, component, shingles) of different components: an exact prefix join.

    A pair that reaches the threshold shares a shingle between the first n - ceil(2pn / (1 + p)) + 1 of the smaller set
    and the first n - ceil(pn) + 1 of the larger one, in any order of shingles that both follow. The order is by how
    often the shingle's hash class (of ``ORDER``, so the counts have a fixed size) occurs: rarest first keeps the
    shingles that a whole group shares out of the prefixes of sets that are not linked with it. Within a group whose
    members differ by a little more than the threshold allows, prefixes still meet; there the parities tell.
    """
    place = lambda found: ((found >> tv.U(23)) % tv.U(ORDER)).astype(np.int64)
    tokens = lambda batch: [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("shingles")]

    @tv.lean
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, n = np.unique(place(np.concatenate(tokens(batch))), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], ["place", "n"])

    often = np.zeros(ORDER, np.int64)
    counted = sets.select("shingles").mapInArrow(tally, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    often[counted["place"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    shipped = sets.sparkSession.sparkContext.broadcast(often)
    words = [f"m{w}" for w in range(PARITIES // 64)]
    own = ["class", "component", *words]

    @tv.lean
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                found = tokens(part)
                size = np.array([len(x) for x in found])
                take = size - -(-percent * size // 100) + 1
                first = [x[np.lexsort((x, shipped.value[place(x)]))[:k]] for x, k in zip(found, take.tolist(), strict=True)]
                at = np.repeat(np.arange(len(size)), take)
                pos = np.arange(len(at)) - np.repeat(np.cumsum(take) - take, take)
                columns = [part.column(c).take(pa.array(at)) for c in own]
                more = [pa.array(size[at]), pa.array(pos), pa.array(np.concatenate(first).view(np.int64))]
                yield pa.RecordBatch.from_arrays([*columns, *more], [*own, "n", "pos", "shingle"])

    bits = classes.select("class", *[F.get("bits", w).alias(m) for w, m in enumerate(words)])
    schema = ", ".join(f"{c} long" for c in [*own, "n", "pos", "shingle"])
    probe = sets.join(bits, "class").select(*own, "shingles").mapInArrow(prefixes, schema)
    probe = save(probe, "prefixes")
    mixed = (
        probe.groupBy("shingle")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"))
        .where("least != most")
        .select("shingle")
    )
    probe = probe.join(mixed, "shingle", "left_semi")
    index = probe.where(F.col("pos") < F.col("n") - F.ceil(F.lit(2 * percent) * F.col("n") / (100 + percent)) + 1)
    x, y = index.alias("x"), probe.alias("y")
    larger = (F.col("y.n") > F.col("x.n")) | ((F.col("y.n") == F.col("x.n")) & (F.col("y.class") != F.col("x.class")))
    # What follows the shared shingle in both orders bounds the intersection.
    enough = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) * (100 + percent) >= percent * (
        F.col("x.n") + F.col("y.n")
    )
    differ = sum((F.bit_count(F.col(f"x.{m}").bitwiseXOR(F.col(f"y.{m}"))) for m in words), F.lit(0))
    enough = enough & _may(F.col("x.n"), F.col("y.n"), differ, percent)
    apart = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.component") != F.col("y.component"))
    met = x.join(y, apart & larger & enough)
    return met.select(F.greatest("x.class", "y.class").alias("a"), F.least("x.class", "y.class").alias("b")).distinct()


def _met(classes: DataFrame, m: int) -> DataFrame:
    """(key, class, least, n) of all classes that meet another in the table key: the smallest of them and how many."""
    halves = classes.select("class", F.posexplode("halves").alias("h", "half"))
    shared = save(halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("half"), "halves")
    of = lambda side: F.collect_list(F.when(side, F.col("half")))
    live = halves.join(shared, "half", "left_semi").groupBy("class").agg(of(F.col("h") < m).alias("x"), of(F.col("h") >= m).alias("y"))
    # A hash names its place in its collection, so a pair of hashes names its table.
    tables = F.flatten(F.transform("x", lambda i: F.transform("y", lambda j: F.xxhash64(i, j))))
    keys = save(live.select("class", F.explode(tables).alias("key")), "keys")
    buckets = save(keys.groupBy("key").agg(F.min("class").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    met = save(keys.join(buckets, "key").select("key", "class", "least", "n"), "met")
    discard(shared, keys, buckets)
    return met


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    size: int = SHINGLE,
    k: int = K,
    miss: float = MISS,
) -> DataFrame:
    """One row per input row: doc_id, text_key, n_shingles, component_id, kept, first.

    A document's set: the distinct ``size``-word shingles of its whole text, words between ASCII white space with A-Z
    lower-cased; with fewer words, the whole sequence. Documents are linked when 100 * intersection >= percent * union
    on full sets, and a component is what links connect; component_id is its smallest doc_id, kept where that is the
    own one. first: kept, and of several texts under that id the one with the smallest text_key. A pair at similarity s
    is a candidate with probability (1 - (1 - s**k)**m)**2 or more, with m from ``collection_size``: at least
    1 - ``miss`` at the threshold; equal sets always meet.
    Null or empty text: an empty set, linked with nothing, kept. Null id: no links, component_id null, kept. Rows that
    share a doc_id are judged each by its own text. Repeated rows: the same result each. Empty input: empty result.
    A very long text is read whole. Other columns, also those named like results, are not read.
    """
    docs, m = texts(docs, id_col, text_col), collection_size(percent, k, miss)
    signed = save(signatures(docs, size, m, k), "signatures")
    named = signed.where("doc_id is not null and n_shingles > 0")
    # Numbered as they are written, so the number stays.
    classes = named.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "text_key")).alias("first"), *[F.first(c).alias(c) for c in ("n_shingles", "halves", "bits")])
    classes = save(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    # The hashes of a class are those of all its rows.
    rows = save(signed.drop("halves", "bits"), "rows")
    discard(signed)
    met = _met(classes, m)
    star = met.where(F.col("class") > F.col("least")).select(F.col("class").alias("a"), F.col("least").alias("b"))
    small = met.where(F.col("n") <= SMALL_BUCKET).select("key", "class")
    both = (F.col("x.key") == F.col("y.key")) & (F.col("x.class") > F.col("y.class"))
    among = small.alias("x").join(small.alias("y"), both).select(F.col("x.class").alias("a"), F.col("y.class").alias("b"))
    met_once = save(star.union(among).distinct(), "met-once")
    pairs = save(possible(met_once, classes, percent), "candidates")
    ends = pairs.select(F.col("a").alias("class")).union(pairs.select("b"))
    links = save(verified(pairs, _of(docs, classes, ends, size), percent), "confirmed")
    found = components(links)

    # A large bucket is still split where a member's component is not that of its smallest; pairs are distinct over all
    # tables, and all members that meet such a smallest one go on.
    large = save(met.where(F.col("n") > SMALL_BUCKET).select("class", "least").distinct(), "large")
    discard(met_once, pairs, met)
    own = large.join(found.withColumnRenamed("node", "class"), "class", "left").select(
        "class",
        "least",
        F.coalesce("component", "class").alias("component"),
    )
    head = found.select(F.col("node").alias("least"), F.col("component").alias("of_least"))
    split = own.join(head, "least", "left").where(F.col("component") != F.coalesce("of_least", "least")).select("least").distinct()
    members = save(own.join(split, "least", "left_semi").select("class", "component").distinct(), "members")
    if not members.isEmpty():
        sets = save(
            members.join(_of(docs, classes, members.select("class"), size), "class").select("class", "component", "shingles"),
            "sets",
        )
        rest = save(_rest(sets, classes, percent), "candidates")
        more = save(verified(rest, sets, percent), "confirmed")
        discard(sets, rest)
        if not more.isEmpty():
            discard(found)
            found = components(links.union(more))
        discard(more)

    # Every row follows its class.
    each = (
        classes.select("class", "d1", "d2", "first")
        .join(found.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    least = each.groupBy("component").agg(F.min("first").alias("least"))
    label = save(each.join(least, "component").select("d1", "d2", "least"), "labels")
    discard(links, large, members, classes, found)
    out = rows.join(label, ["d1", "d2"], "left")
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    out = out.withColumn("component_id", F.when(linked, F.col("least.doc_id")).otherwise(F.col("doc_id")))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    first = kept & (~linked | (F.col("text_key") == F.col("least.text_key")))
    return out.select("doc_id", "text_key", "n_shingles", "component_id", kept.alias("kept"), first.alias("first"))


#: The same rows in DuckDB SQL, for ids that do not repeat: every pair that shares a shingle, and all that links reach.
SQL = r"""
with recursive d as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') as w from documents),
s as materialized (select distinct r, array_to_string(w[i : i + 4], ' ') as x
  from (select r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from d where len(w) > 0)),
n as (select r, count(*) as n from s group by r),
m as (select a.r as a, b.r as b, count(*) as k from s a join s b on a.x = b.x and a.r <> b.r join d on d.r = a.r join d e on e.r = b.r
  where d.doc_id is not null and e.doc_id is not null group by 1, 2),
l as materialized (select a, b from m join n x on x.r = a join n y on y.r = b where 100 * k >= 85 * (x.n + y.n - k)),
c(a, b) as (select r, r from d union select c.a, l.b from c join l on l.a = c.b),
o as (select c.a, min(doc_id) as least from c join d on d.r = c.b group by 1)
select doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, least as component_id, coalesce(doc_id = least, true) as kept from d
  join o on o.a = d.r left join n using (r)
"""
